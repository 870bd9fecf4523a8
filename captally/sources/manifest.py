"""SRC-3 split manifest reader and PRJ-3 raw references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENTENCE = T.StructType([T.StructField("raw", T.StringType())])
IMAGE = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("sentences", T.ArrayType(SENTENCE)),
    ]
)
MANIFEST_SCHEMA = T.StructType([T.StructField("images", T.ArrayType(IMAGE))])


def raw_references(sentences) -> Column:
    """PRJ-3: ``sentences[].raw`` as ``array<string>`` (null -> empty)."""
    col = F.col(sentences) if isinstance(sentences, str) else sentences
    return F.transform(F.coalesce(col, F.array().cast(T.ArrayType(SENTENCE))), lambda s: s["raw"])


def manifest_rows(manifest: DataFrame) -> DataFrame:
    """Flatten a manifest table (column ``images``) to one row per image.

    Returns (ordinal, filename, split, refs).  ``ordinal`` is the image's
    place in the manifest list.
    """
    return manifest.select(F.posexplode("images").alias("ordinal", "img")).select(
        F.col("ordinal").cast("long").alias("ordinal"),
        F.col("img.filename").alias("filename"),
        F.col("img.split").alias("split"),
        raw_references(F.col("img.sentences")).alias("refs"),
    )


def read_split_manifest(spark: SparkSession, path: str, document: bool = True) -> DataFrame:
    """SRC-3: split manifest -> (ordinal, filename, split, refs).

    ``document=True`` reads files of one JSON object ``{"images": [...]}`` each;
    such a file is read by one task.  ``document=False`` reads the sharded form,
    JSON lines of one image each, which is split among tasks and has no
    ``ordinal``.  The schema is explicit and a malformed file is an error.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if document:
        return manifest_rows(reader.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path))
    return reader.schema(IMAGE).json(path).select("filename", "split", raw_references("sentences").alias("refs"))
