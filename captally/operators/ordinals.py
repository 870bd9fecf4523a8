"""Dense positions in a total order without a single-partition window.

``row_number()`` over an un-partitioned window moves every row into one
task.  ``ordinals`` instead range-partitions and sorts, records each row's
partition and place inside it, writes that once to the checkpoint folder
(so the numbering never depends on a re-run), then adds the running count of
the earlier partitions (one number per partition, broadcast back).

Built on it: WIN-1 ``image_ordinal``, WIN-2 ``annotation_ids``; SRT-1
``sort_images`` is a plain global sort.  LIM-1 ``slice_images`` and JN-4
``at_positions`` find their rows by selection (``operators.selection``) and number no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captally.operators.materialize import cut
from captally.operators.selection import nth_keys, slice_keys


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordinals(df: DataFrame, order: Sequence[str], out: str = "ordinal") -> DataFrame:
    """Add ``out``: 0-based position of each row in the order of ``order``.

    ``order`` must be a total order (unique) for the result to be
    deterministic.
    """
    order = list(order)
    ranged = df.repartitionByRange(_partitions(df), *order).sortWithinPartitions(*order)
    pid = F.spark_partition_id()
    placed = ranged.select(
        "*",
        pid.alias("_pid"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_local"),
    )
    placed = cut(placed, "ordinals")
    # One count per range partition: a list bounded by the partition count,
    # so it is the one thing brought to the driver (turned into offsets there).
    counts = sorted(tuple(r) for r in placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    running, rows = 0, []
    for pid, n in counts:
        rows.append((pid, running))
        running += n
    offsets = df.sparkSession.createDataFrame(rows or [(0, 0)], "_pid int, _off long")
    return (
        placed.join(F.broadcast(offsets), "_pid")
        .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
        .drop("_pid", "_local", "_off")
    )


def sort_images(df: DataFrame) -> DataFrame:
    """SRT-1: ascending by image name (binary order = code-point order)."""
    return df.orderBy("image")


def image_ordinal(images: DataFrame, by: str | None = "split") -> DataFrame:
    """WIN-1: 0-based position of each image in name order, within ``by``.

    Computed as the global position over (by, image) minus the first
    position of the group, so a big group never sits in one task.
    """
    if by is None:
        return ordinals(images, ["image"], "ordinal")
    ranked = ordinals(images, [by, "image"], "_g")
    starts = ranked.groupBy(by).agg(F.min("_g").alias("_start"))
    return ranked.join(starts, by).withColumn("ordinal", F.col("_g") - F.col("_start")).drop("_g", "_start")


def annotation_ids(refs: DataFrame) -> DataFrame:
    """WIN-2: dense annotation id over (image order, reference position)."""
    return ordinals(refs, ["image", "pos"], "id")


def slice_images(images: DataFrame, lo: int, hi: int | None, unique: bool = False) -> DataFrame:
    """LIM-1: images at sorted positions [lo, hi) (hi None = open-ended) with their ``ordinal``.

    The ends are found by selection; only the slice is sorted and written.
    ``unique`` says that there is one row per image already.
    """
    names = images.select("image")
    found = slice_keys(names if unique else cut(names.distinct(), "images"), "image", lo, hi)
    return ordinals(found, ["image"], "ordinal").withColumn("ordinal", F.col("ordinal") + lo)


def at_positions(df: DataFrame, positions: Sequence[int], ordinal: str = "ordinal", key: str = "image") -> DataFrame:
    """JN-4: one row per requested position, in request order (``slot``).

    Without a column ``ordinal`` positions are those of the ascending order of
    ``key`` (unique), found by selection.  ``found`` is false, and the other
    columns null, for a position past the end.
    """
    spark = df.sparkSession
    wanted = spark.createDataFrame([(int(p), i) for i, p in enumerate(positions)], f"{ordinal} long, slot int")
    if ordinal not in df.columns:
        # One row per requested position: small by what was asked for.
        df = df.join(F.broadcast(nth_keys(df, key, positions, ordinal)), key)
    there = df.join(F.broadcast(wanted.select(ordinal).distinct()), ordinal, "left_semi").withColumn("found", F.lit(True))
    return wanted.join(there, ordinal, "left").withColumn("found", F.coalesce("found", F.lit(False))).orderBy("slot")
