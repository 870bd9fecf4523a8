"""Rows at given positions of a sort order, without sorting the table (JN-4, LIM-1, PIP-4).

Every round looks at one range of keys per wanted position.  A sketch of the
range (approximate percentiles of the eight bytes behind the prefix that all its keys share)
gives pivots; one exact count per pivot says between which two the position lies; that is the
next range.  A range shrinks by about ``PIVOTS`` a round, so some 10^12 keys take five
rounds; when ``SMALL`` keys are left, these alone are sorted.  What comes to
the driver is bounded by the request: ``PIVOTS`` counts for each wanted position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIVOTS = 64
SMALL = 2000
CODE_BYTES = 7


def common_prefix(a: bytes, b: bytes) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def key_code(key: str, skip: int) -> Column:
    """The bytes of a key behind the first ``skip`` ones, and how many there are, as a number that keeps their order.

    Keys of one range with equal numbers are one key, or share CODE_BYTES more bytes.
    """
    raw = F.substring(F.encode(F.col(key), "UTF-8"), skip + 1, CODE_BYTES)
    return F.conv(F.rpad(F.hex(raw), 2 * CODE_BYTES, "0"), 16, 10).cast("long") * 8 + F.octet_length(raw)


def _pivots(rows: DataFrame, key: str, ranges: list) -> list[list[int]]:
    """Pivot codes of each range (lo, hi, skip): distinct and increasing."""
    shares = [i / PIVOTS for i in range(1, PIVOTS)]
    sketches = [F.percentile_approx(F.when(F.col(key).between(lo, hi), key_code(key, skip)), shares, 1000).alias(f"r{i}") for i, (lo, hi, skip) in enumerate(ranges)]
    got = rows.agg(*sketches).first()
    return [sorted(set(x or [])) for x in got]


def _counts(rows: DataFrame, key: str, ranges: list, pivots: list[list[int]]) -> list[list]:
    """(bucket, rows, smallest key, largest key) of the buckets that the pivots cut each range into."""
    out = []
    for (lo, hi, skip), cut in zip(ranges, pivots):
        # Keys at a pivot are a bucket of their own, so a range shrinks even if its pivots are all the same.
        below = lambda p: (p < F.col("_code")).cast("int") + (p <= F.col("_code")).cast("int")
        bucket = F.aggregate(F.array(*map(F.lit, cut)), F.lit(0), lambda n, p: n + below(p)) if cut else F.lit(0)
        part = rows.where(F.col(key).between(lo, hi)).withColumn("_code", key_code(key, skip)).groupBy(bucket.alias("bucket"))
        got = part.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        out.append(sorted(tuple(r) for r in got))
    return out


def nth_keys(df: DataFrame, key: str, positions: Sequence[int], ordinal: str = "ordinal") -> DataFrame:
    """(ordinal, key): the keys at 0-based ``positions`` of the ascending order of distinct strings ``key``.

    ``key`` must be unique and not null.  Positions past the end are left out; a position may be asked for twice.
    """
    spark = df.sparkSession
    rows = df.select(key)
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    wanted = sorted({int(p) for p in positions if 0 <= p < whole["n"]})
    # (first key, last key, position of the first key, rows) -> positions wanted there
    open_: dict = {(whole["lo"], whole["hi"], 0, whole["n"]): wanted} if wanted else {}
    small: list = []
    while open_:
        small += [r for r in open_ if r[3] <= SMALL]
        ranges = [r for r in open_ if r[3] > SMALL]
        if not ranges:
            break
        bounds = [(lo, hi, common_prefix(lo.encode(), hi.encode())) for lo, hi, _, _ in ranges]
        cut = _pivots(rows, key, bounds)
        narrower: dict = {}
        for r, buckets in zip(ranges, _counts(rows, key, bounds, cut)):
            at = r[2]
            for _, n, lo, hi in buckets:
                inside = [p for p in open_[r] if at <= p < at + n]
                if inside:
                    narrower[(lo, hi, at, n)] = inside
                at += n
        open_ = narrower
    found: list[tuple] = []
    at_most = {p: r for r in small for p in wanted if r[2] <= p < r[2] + r[3]}
    for r in dict.fromkeys(at_most.values()):
        names = [x[0] for x in rows.where(F.col(key).between(r[0], r[1])).orderBy(key).limit(SMALL).collect()]
        found += [(p, names[p - r[2]]) for p, q in at_most.items() if q == r]
    return spark.createDataFrame(found, f"{ordinal} long, {key} string")


def slice_keys(df: DataFrame, key: str, lo: int, hi: int | None) -> DataFrame:
    """The rows of ``df`` (unique ``key``) at positions [lo, hi) of the ascending key order; nothing else is numbered."""
    ends = {r["ordinal"]: r[key] for r in nth_keys(df, key, [p for p in (lo, hi) if p is not None]).collect()}
    if lo not in ends:  # past the end
        return df.limit(0)
    got = df.where(F.col(key) >= ends[lo])
    return got.where(F.col(key) < ends[hi]) if hi in ends else got
