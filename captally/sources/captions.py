"""SRC-1 caption CSV, SRC-2 caption token file, PRJ-1 header lower-casing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.functions.text import image_of_key
from captally.sources.csv_records import csv_records


def lower_header(df: DataFrame) -> DataFrame:
    """PRJ-1: lower-case every column name (``Image,Caption`` works)."""
    return df.toDF(*[c.lower() for c in df.columns])


CSV = {"quote": '"', "escape": '"', "mode": "FAILFAST", "nullValue": "", "emptyValue": ""}


def read_captions(spark: SparkSession, path: str, split: bool = True) -> DataFrame:
    """SRC-1: CSV with a header -> (image, caption, pos).

    Quotes are doubled inside quoted fields and captions may hold newlines.
    Every column is read as a string (no inference).  Rows with an empty image or caption
    are dropped (a missing caption cannot be scored or written as JSON); the
    literal text ``NA`` stays text.  ``pos`` grows in file order.  A row with
    another number of fields than the header is an error.

    Large files are read by byte ranges (``csv_records``), which expects quotes
    in quoted fields only; ``split=False`` leaves files with stray quotes to Spark's own
    multi-line reader, a task a file.
    """
    reader = spark.read.options(header=True, inferSchema=False, multiLine=not split, **CSV)
    raw = reader.csv(path)
    df = lower_header(raw)
    missing = {"image", "caption"} - set(df.columns)
    if missing:
        raise ValueError(f"caption file lacks column(s) {sorted(missing)}")
    if split:
        fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in df.columns)
        row = F.from_csv("text", fields, {**CSV, "maxCharsPerColumn": "-1"})
        df = csv_records(spark, path).select(row.alias("r"), F.col("line").alias("pos")).select("r.image", "r.caption", "pos")
    else:
        df = df.select("image", "caption", F.monotonically_increasing_id().alias("pos"))
    return df.where(F.col("image").isNotNull() & (F.col("image") != "")).where(F.col("caption").isNotNull() & (F.col("caption") != ""))


def parse_token_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC-2 parser: ``image#k<TAB>caption`` lines -> (image, pos, caption).

    A key without ``#k`` keeps the whole key as image and gets a null pos.
    """
    parts = F.split(F.col(value), "\t", 2)
    key = F.get(parts, 0)
    num = F.when(F.instr(key, "#") > 0, F.substring_index(key, "#", -1))
    return lines.select(
        image_of_key(key).alias("image"),
        num.try_cast(T.IntegerType()).alias("pos"),
        F.get(parts, 1).alias("caption"),
    ).where(F.col("caption").isNotNull())


def read_caption_tokens(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: headerless TSV token file -> (image, pos, caption)."""
    return parse_token_lines(spark.read.text(path))
