"""Train/val/test splits: manifest labels (SPL-1) and positional cuts (SPL-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captally.operators.ordinals import ordinals
from captally.operators.pairing import unique_images
from captally.operators.skew import skew_join

SPLITS = ("train", "val", "test")
# The documented positional cut of the caption table.
DEFAULT_SIZES = (6000, 1000)


def by_split(df: DataFrame, name: str, column: str = "split") -> DataFrame:
    """FLT-1: rows of one split.  An unknown split name is an error (Q7)."""
    if name not in SPLITS:
        raise ValueError(f"unknown split {name!r}; expected one of {SPLITS}")
    return df.where(F.col(column) == name)


def manifest_split(manifest_rows: DataFrame, name: str) -> DataFrame:
    """SPL-1: images whose manifest label is ``name``."""
    return by_split(manifest_rows, name)


def positional_split(captions: DataFrame, sizes: Sequence[int] = DEFAULT_SIZES, unique: bool = False) -> DataFrame:
    """SPL-2: (image, ordinal, split) for the distinct images in name order.

    ``unique`` says that there is one row per image already; its other
    columns are then kept.

    The first ``sizes[0]`` images are train, the next ``sizes[1]`` val and
    everything after is test (open-ended).  Positions come from
    ``ordinals`` (range partitioning), so no single task sees all images.
    """
    n_train, n_val = int(sizes[0]), int(sizes[1])
    images = captions if unique else unique_images(captions)
    ranked = ordinals(images, ["image"], "ordinal")
    label = (
        F.when(F.col("ordinal") < n_train, "train")
        .when(F.col("ordinal") < n_train + n_val, "val")
        .otherwise("test")
    )
    return ranked.withColumn("split", label)


def in_split(captions: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """JN-1: captions of the images labelled ``name``."""
    keys = by_split(labels, name).select("image")
    return skew_join(captions, keys, ["image"], "left_semi")


def split_counts(labels: DataFrame, column: str = "split") -> DataFrame:
    """SPL-3: rows per split."""
    return labels.groupBy(column).agg(F.count(F.lit(1)).alias("n_images"))
