"""Records of quoted CSV files of any size, read by byte ranges (SRC-1).

Lines are read split: a large file is many tasks.  A line may lie inside a
quoted field, so one aggregate counts lines and quotes per byte range; their
running totals (one entry a range, on the driver) say at which line a range
starts and whether inside quotes.  Each task then walks its range from that
state: complete records leave it whole, and only the lines of records that
cross into another range are put together by a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
LINES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("line", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("whole", T.BooleanType()),
        T.StructField("starts", T.BooleanType()),
    ]
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def range_starts(lines: DataFrame) -> dict[tuple[str, int], tuple[int, int, int, int, int]]:
    """(file, block) -> (first line of it, quotes open there, lines, quotes, first line of the file): one entry a byte range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    per_block = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.sum(quotes).alias("q"))
    out, line, open_, now, first = {}, 0, 0, None, 0
    for file, block, n, q in sorted(tuple(r) for r in per_block.collect()):
        if file != now:
            now, open_, first = file, 0, line
        out[(file, block)] = (line, open_, n, q, first)
        line += n
        open_ = (open_ + q) % 2
    return out


class Walk:
    """The state of a task inside one byte range."""

    def __init__(self, file: str, block: int, start: tuple) -> None:
        self.file, self.block = file, block
        self.line, self.open, self.n, self.q, self.first = start
        self.seen = self.quotes = 0
        self.held: list[tuple[int, str, bool]] = []  # lines of the record that is open

    def take(self, values: pa.Array, out: list) -> None:
        quotes = pc.count_substring(values, QUOTE).to_numpy(zero_copy_only=False).astype(np.int64)
        after = (self.open + np.cumsum(quotes)) % 2
        before = np.append(self.open, after[:-1])
        single = (before == 0) & (after == 0)
        at = self.line + self.seen + np.arange(len(values))
        plain = np.flatnonzero(single)
        out.append((at[plain], values.take(pa.array(plain)), True, True))
        for i in np.flatnonzero(~single).tolist():
            self.held.append((int(at[i]), values[i].as_py(), bool(before[i] == 0)))
            if after[i] == 0:
                self.close(out, whole=self.held[0][2])
        self.seen += len(values)
        self.quotes += int(quotes.sum())
        self.open = int(after[-1])

    def close(self, out: list, whole: bool) -> None:
        """Pass on the held lines: joined if the record began in this range, else one by one."""
        held, self.held = self.held, []
        if whole:
            out.append((np.array([held[0][0]]), pa.array(["\n".join(t for _, t, _ in held)]), True, True))
        else:
            for line, text, starts in held:
                out.append((np.array([line]), pa.array([text]), False, starts))

    def finish(self, out: list) -> None:
        if (self.seen, self.quotes) != (self.n, self.q):
            raise ValueError(f"{self.file} changed while it was read")
        if self.held:
            self.close(out, whole=False)


def _walked(starts: dict):
    def run(batches):
        walk = None
        names = LINES.names

        def emit(out: list):
            for at, text, whole, begins in out:
                if len(at):
                    flag = lambda v, n=len(at): pa.array(np.full(n, v))
                    yield pa.RecordBatch.from_arrays([pa.array([walk.file] * len(at)), pa.array(at), text.cast(pa.string()), flag(whole), flag(begins)], names=names)

        for b in batches:
            files, blocks = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            new = np.array([True] + [files[i] != files[i - 1] or blocks[i] != blocks[i - 1] for i in range(1, len(files))], bool)
            cuts = np.append(np.flatnonzero(new), len(files)).tolist() if len(files) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                key = (files[lo], int(blocks[lo]))
                out: list = []
                if walk is None or (walk.file, walk.block) != key:
                    if walk is not None:
                        walk.finish(out)
                        yield from emit(out)
                        out = []
                    walk = Walk(*key, starts.value[key])
                walk.take(b.column(2).slice(lo, hi - lo), out)
                yield from emit(out)
        if walk is not None:
            out = []
            walk.finish(out)
            yield from emit(out)

    return run


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text): the records of CSV files below their header lines, in no order; ``line`` numbers all lines.

    A header is one line.  Quotes are expected in quoted fields only: doubled inside them, as RFC 4180 has it.
    """
    lines = _lines(spark, path)
    starts = range_starts(lines)
    headers = [(first,) for first in {s[4] for s in starts.values()}]
    walked = lines.mapInArrow(_walked(spark.sparkContext.broadcast(starts)), LINES)
    whole = walked.where("whole").select("file", "line", "text")
    # Lines of records that cross byte ranges: a few a range.
    record = F.last(F.when(F.col("starts"), F.col("line")), ignorenulls=True).over(Window.partitionBy("file").orderBy("line"))
    crossing = walked.where("not whole").withColumn("record", record)
    parts = F.sort_array(F.collect_list(F.struct("line", "text")))
    joined = crossing.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    every = whole.unionByName(joined.select("file", F.col("record").alias("line"), "text"))
    every = every.join(F.broadcast(spark.createDataFrame(headers, "line long")), "line", "left_anti")
    return every.select("file", "line", F.regexp_replace("text", "\r$", "").alias("text")).where(F.col("text") != "")
