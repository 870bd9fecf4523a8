"""Hot-key aware equi-join.

A join key that holds a large share of one side (one image with millions of
references, one token such as ``a`` present in every caption) would land in
a single shuffle partition.  ``skew_join`` deals such keys out:

* a key is hot if it has more than ``captally.skew.hotKeyRows`` rows *and*
  more than one part in ``FAIR_SHARES`` of all rows; so there are at most
  ``FAIR_SHARES`` hot keys, by arithmetic and without a cut-off, and any other
  key is no larger than a fair share of the work;
* rows of hot keys get a salt from a hash of the row, and the matching rows of
  the other side are repeated once per salt;
* every other key takes the ordinary shuffle join.

With no hot key this is a plain join.  AQE's skew-join handling stays enabled
as a second line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captally.session import HOT_KEY_ROWS_CONF, conf_int

DEFAULT_HOT_KEY_ROWS = 1_000_000
FAIR_SHARES = 10_000
SALTS = 64


def hot_keys(big: DataFrame, on: Sequence[str], threshold: int) -> list:
    """Rows of the keys that hold more than ``threshold`` rows and more than a fair share; at most FAIR_SHARES."""
    counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").alias("total")
    rows = counts.agg(total, F.max("n_rows").alias("most")).first()
    least = max(threshold, (rows["total"] or 0) // FAIR_SHARES)
    if not rows["most"] or rows["most"] <= least:
        return []
    return counts.where(F.col("n_rows") > least).select(*on).collect()


def skew_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    threshold: int | None = None,
) -> DataFrame:
    """``big.join(small, on, how)`` with the hot keys of ``big`` dealt over ``SALTS`` tasks each.

    ``how`` is one of inner, left, left_semi, left_anti.
    """
    on = list(on)
    spark = big.sparkSession
    threshold = threshold if threshold is not None else conf_int(spark, HOT_KEY_ROWS_CONF, DEFAULT_HOT_KEY_ROWS)
    found = hot_keys(big, on, threshold)
    if not found:
        return big.join(small, on, how)
    hot = F.broadcast(spark.createDataFrame(found, big.select(*on).schema))
    salt = F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)).cast("int")
    hot_big = big.join(hot, on, "left_semi").withColumn("_salt", salt)
    hot_small = small.join(hot, on, "left_semi").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hot_part = hot_big.join(hot_small, [*on, "_salt"], how).drop("_salt")
    cold_part = big.join(hot, on, "left_anti").join(small, on, how)
    return hot_part.unionByName(cold_part)
