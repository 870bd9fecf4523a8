"""Quality rules: base counts per document and a robust multivariate outlier test.

Every text gives six transformed statistics (symbols, repeated windows,
repeated lines, words said twice running, upper case, word length).  For each (language, source) the
minimum-covariance-determinant estimate of centre and spread is found by
concentration steps over *all* rows: keep the ``support`` share of rows with
the smallest Mahalanobis distance, re-estimate, repeat.  Three deterministic
starts (median and MAD; correlations of tanh scores; of spatial signs) take
``FIRST_STEPS`` steps each, the one with the smallest determinant goes on
until its determinant stays.  A document whose distance from its group's
estimate is beyond the chi-square quantile is rejected.

Scale: statistics are fixed-point integers, so every sum is exact and does
not depend on row order.  A concentration step is one map-side combined
aggregation by (group, distance bucket); a hot group is salted at the join
and reduced to at most ``N_BUCKETS`` rows before anything sees it whole.

Defined results: a null text is an empty one (no words, ``base_failed``); null
languages and sources are groups of their own; a group with fewer than
``min_rows`` rows (five per statistic) is judged by all rows of its language,
or, if these are too few, of the table; in a table with fewer rows there is
no estimate, the distance is null and the base decides.  An empty table gives
an empty result.  Repeated rows are judged alike, ties in distance count in
proportion.  Other columns of the input, whatever their names, are not read;
``keep_good`` returns them as they were.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.llm.text_batches import (
    SPACED_WORD,
    TextHasher,
    count_per_row,
    map_texts,
    odd_weights,
    row_of,
    window_hashes,
    word_spans,
)
from captally.operators.materialize import cut

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

#: The statistics; each is stored in units of 1/SCALE.
STATS = ("symbols", "repeats", "dup_lines", "echoes", "upper", "word_length")
SCALE = 1024
#: Least standard deviations: a statistic that is constant in the core of a
#: group must not turn one odd character into an outlier.  Wider cores are
#: left as they are.
FLOORS = (0.04, 0.10, 0.12, 0.06, 0.03, 0.12)
#: Distance buckets are 1/16 of an octave wide, between 2**-16 and 2**32.
N_BUCKETS = 48 * 16
SALTS = 16
#: Rows that an estimate needs: five per statistic.
MIN_ROWS = 5 * len(STATS)
FIRST_STEPS = 2
MAX_STEPS = 20
#: A step that moves no log-determinant by more than this ends the search.
SETTLED = 1e-3

BASE_FIELDS = [
    T.StructField(c, T.LongType(), False)
    for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
]
STAT_FIELDS = [T.StructField(f"z_{s}", T.LongType(), False) for s in STATS]


def _counter():
    """Makes the per-task function: text bytes to base counts and statistics."""
    hasher, weights = TextHasher(), odd_weights(WINDOW)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    not_newline = np.ones(256, bool)
    not_newline[10] = False
    upper = np.zeros(256, bool)
    upper[65:91] = True
    letter = upper.copy()
    letter[97:123] = True
    letter[0xC3:0xF5] = True
    salt = np.uint64(0x9E3779B97F4A7C15)

    def counts(data, offsets):
        n = len(offsets) - 1
        starts, ends, firsts = word_spans(data, offsets, SPACED_WORD)
        hasher.load(data)
        n_words = np.diff(firsts)
        word_chars = count_per_row(SPACED_WORD[data] & ((data & 0xC0) != 0x80), offsets)
        n_symbols = count_per_row(symbol[data], offsets)

        # Lines with a word, and those equal to an earlier one of the same text.
        l_start, l_end, l_first = word_spans(data, offsets, not_newline)
        with_word = np.searchsorted(starts, l_end) > np.searchsorted(starts, l_start)
        line_row = row_of(l_first, len(l_start))[with_word]
        key = hasher.spans(l_start[with_word], l_end[with_word]) ^ (line_row.astype(np.uint64) * salt)
        lines = np.bincount(line_row, minlength=n)
        distinct = np.unique(key, return_index=True)[1]
        n_dup = lines - np.bincount(line_row[distinct], minlength=n)

        # Words inside windows that occur twice or more in the text.
        words = hasher.spans(starts, ends)
        word_row = row_of(firsts, len(starts))
        wins = window_hashes(words, weights)
        covered = np.zeros(len(starts) + 1, np.int64)
        if len(wins):
            whole = np.flatnonzero(word_row[: len(wins)] == word_row[WINDOW - 1 :])
            key = wins[whole] ^ (word_row[whole].astype(np.uint64) * salt)
            _, back, times = np.unique(key, return_inverse=True, return_counts=True)
            again = whole[times[back] > 1]
            np.add.at(covered, again, 1)
            np.add.at(covered, again + WINDOW, -1)
        n_repeat = count_per_row(np.cumsum(covered[:-1]) > 0, firsts)

        echo = np.zeros(len(words), bool)
        echo[1:] = (words[1:] == words[:-1]) & (word_row[1:] == word_row[:-1])
        n_echo = count_per_row(echo, firsts)
        caps = count_per_row(upper[data], offsets)
        letters = count_per_row(letter[data], offsets)
        # Ratios are smoothed by a few neutral units, so that short texts are not noisy.
        z = (
            n_symbols / (n_words + 10.0),
            n_repeat / (n_words + 20.0),
            n_dup / (lines + 10.0),
            n_echo / (n_words + 20.0),
            caps / (letters + 150.0),
            np.log((word_chars + 5.0 * 40) / (n_words + 40.0)),
        )
        fixed = [np.rint(np.minimum(x, 64.0) * SCALE).astype(np.int64) for x in z]
        return [x.astype(np.int64) for x in (n_words, word_chars, n_symbols, n_dup, n_repeat)] + fixed

    return counts


def text_stats(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus the base counts and the fixed-point statistics."""
    return map_texts(docs, text, keep, BASE_FIELDS + STAT_FIELDS, _counter)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function by the series of the incomplete gamma function."""
    a, y = k / 2.0, x / 2.0
    if y <= 0:
        return 0.0
    term = total = 1.0 / a
    for i in range(1, 2000):
        term *= y / (a + i)
        total += term
        if term < total * 1e-15:
            break
    return min(1.0, total * math.exp(-y + a * math.log(y) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def _group_key() -> Column:
    return F.to_json(F.struct(F.col("lang"), F.col("source")))


def _pools(stats: DataFrame, min_rows: int) -> tuple[DataFrame, DataFrame]:
    """((group, pool) that judges each group, (group, pool) of the pools each group's rows belong to)."""
    sizes = cut(stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.first("group").alias("group")), "quality-sizes")
    by_lang = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    own = F.concat(F.lit("g"), F.col("a.group"))
    of_lang = F.concat(F.lit("l"), F.coalesce(F.concat(F.lit("="), F.col("a.lang")), F.lit("-")))
    judged = F.when(F.col("n") >= min_rows, own).when(F.col("n_lang") >= min_rows, of_lang).otherwise(F.lit("all"))
    both = sizes.alias("a").join(by_lang.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")))
    both = cut(both.select("a.group", judged.alias("pool"), F.array(own, of_lang, F.lit("all")).alias("around")), "quality-pools")
    judges = both.select("group", "pool")
    members = both.select("group", F.explode("around").alias("pool")).join(judges.select("pool").distinct(), "pool", "left_semi")
    return judges, members.select("group", "pool")


P = len(STATS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
START_SCHEMA = "pool string, start int, centre array<double>, precision array<double>"
PARAM_SCHEMA = START_SCHEMA + ", log_det double"


def _at_least_floors(cov: np.ndarray) -> np.ndarray:
    return cov + np.diag(np.maximum(np.square(FLOORS) - np.diag(cov), 0.0))


def _median_start(pdf: pd.DataFrame) -> pd.DataFrame:
    """Coordinate-wise median and MAD of one pool, from counts by value."""
    centre, spread = [], []
    for d in range(P):
        part = pdf[pdf["dim"] == d]
        v, n = part["v"].to_numpy(float), part["n"].to_numpy(float)

        def median(v, n):
            o = np.argsort(v, kind="stable")
            return v[o][np.searchsorted(np.cumsum(n[o]), n.sum() / 2.0)]

        m = median(v, n)
        centre.append(m * 16 / SCALE)
        spread.append(max(1.4826 * median(np.abs(v - m), n) * 16 / SCALE, FLOORS[d]))
    return pd.DataFrame({"pool": [pdf["pool"].iloc[0]], "start": [0], "centre": [centre], "precision": [list(np.diag(1 / np.square(spread)).ravel())]})


def _score_sums(scored: DataFrame) -> DataFrame:
    """Per pool the sums and products of tanh scores and spatial signs, exact in units of 1/SCALE."""
    off = [(F.col(f"z_{s}") / F.lit(float(SCALE)) - F.col("centre")[i]) * F.sqrt(F.col("precision")[i * P + i]) for i, s in enumerate(STATS)]
    norm = F.sqrt(sum((x * x for x in off), F.lit(1e-12)))
    fixed = [F.round(F.tanh(x) * SCALE).cast("long").alias(f"t{i}") for i, x in enumerate(off)]
    fixed += [F.round(x / norm * SCALE).cast("long").alias(f"u{i}") for i, x in enumerate(off)]
    rows = scored.select("pool", "centre", "precision", *fixed)
    sums = [F.sum(f"t{i}").alias(f"t{i}") for i in range(P)]
    sums += [F.sum(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}_{j}") for k in "tu" for i, j in PAIRS]
    return rows.groupBy("pool").agg(F.count(F.lit(1)).alias("n"), F.first("centre").alias("centre"), F.first("precision").alias("precision"), *sums)


def _score_starts(batches):
    """Two more starts of each pool: the spreads of the first with the correlations of its scores."""
    for pdf in batches:
        made = []
        for _, r in pdf.iterrows():
            spread = 1 / np.sqrt(np.diag(np.reshape(r["precision"], (P, P))))
            for start, kind in ((1, "t"), (2, "u")):
                mean = np.array([r[f"t{i}"] / r["n"] if kind == "t" else 0.0 for i in range(P)])
                cov = np.zeros((P, P))
                for i, j in PAIRS:
                    cov[i, j] = cov[j, i] = r[f"{kind}{i}_{j}"] / r["n"] - mean[i] * mean[j]
                size = np.sqrt(np.maximum(np.diag(cov), 1.0))
                # A tenth of the unit matrix keeps scores that always go together apart.
                corr = 0.9 * cov / np.outer(size, size)
                np.fill_diagonal(corr, 1.0)
                made.append((r["pool"], start, list(r["centre"]), list(np.linalg.inv(corr * np.outer(spread, spread)).ravel())))
        yield pd.DataFrame(made, columns=["pool", "start", "centre", "precision"])


def _concentrate(support: float):
    """One concentration step of one pool and start, from sums by distance bucket (at most N_BUCKETS rows).

    The core has exactly the ``support`` share of the rows: those of the
    bucket on its edge count in proportion.
    """
    consistency = support / _chi2_cdf(chi2_quantile(support, P), P + 2)

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bucket")
        n = pdf["n"].to_numpy(float)
        size = math.ceil(support * n.sum())
        share = np.clip((size - (np.cumsum(n) - n)) / n, 0.0, 1.0)
        mean = np.array([pdf[f"s{i}"].to_numpy(float) @ share for i in range(P)]) / size
        cov = np.empty((P, P))
        for i, j in PAIRS:
            cov[i, j] = cov[j, i] = pdf[f"s{i}_{j}"].to_numpy(float) @ share / size - mean[i] * mean[j]
        cov = _at_least_floors(consistency * cov / SCALE**2)
        made = {"centre": [list(mean / SCALE)], "precision": [list(np.linalg.inv(cov).ravel())], "log_det": [np.linalg.slogdet(cov)[1]]}
        return pd.DataFrame({"pool": [pdf["pool"].iloc[0]], "start": [pdf["start"].iloc[0]], **made})

    return step


def _distance() -> Column:
    """Squared Mahalanobis distance of a row from its joined ``centre``."""
    p = len(STATS)
    off = [F.col(f"z_{s}") / F.lit(float(SCALE)) - F.col("centre")[i] for i, s in enumerate(STATS)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i, p):
            total = total + F.lit(1.0 if i == j else 2.0) * off[i] * off[j] * F.col("precision")[i * p + j]
    # greatest() skips nulls: without an estimate there is no distance.
    return F.when(total.isNotNull(), F.greatest(total, F.lit(0.0)))


def _with_params(stats: DataFrame, params: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``; the estimates are repeated per salt so that a hot group is split."""
    salted = params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cols = [f"z_{s}" for s in STATS]
    return stats.withColumn("salt", F.pmod(F.xxhash64("doc_id", *cols), F.lit(SALTS)).cast("int")).join(salted, [key, "salt"], "left").drop("salt")


def _step(rows: DataFrame, params: DataFrame, support: float) -> DataFrame:
    d2 = _with_params(rows, params, "pool").withColumn("d2", _distance())
    bucket = F.least(F.greatest(F.floor((F.log2(F.col("d2") + F.lit(2.0**-16)) + 16) * 16), F.lit(0)), F.lit(N_BUCKETS - 1))
    sums = [F.sum(f"z_{s}").alias(f"s{i}") for i, s in enumerate(STATS)]
    sums += [F.sum(F.col(f"z_{STATS[i]}") * F.col(f"z_{STATS[j]}")).alias(f"s{i}_{j}") for i, j in PAIRS]
    by_bucket = d2.groupBy("pool", "start", bucket.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *sums)
    return cut(by_bucket.groupBy("pool", "start").applyInPandas(_concentrate(support), PARAM_SCHEMA), "quality-step")


def estimates(rows: DataFrame, support: float = 0.75) -> DataFrame:
    """(pool, start, centre, precision, log_det): the estimate of every pool of ``rows``, a written table."""
    dims = F.explode(F.array(*(F.struct(F.lit(d).alias("dim"), F.round(F.col(f"z_{s}") / 16).cast("long").alias("v")) for d, s in enumerate(STATS))))
    values = rows.select("pool", dims.alias("x")).groupBy("pool", "x.dim", "x.v").agg(F.count(F.lit(1)).alias("n"))
    first = cut(values.groupBy("pool").applyInPandas(_median_start, START_SCHEMA), "quality-start")
    more = _score_sums(_with_params(rows, first, "pool")).mapInPandas(_score_starts, START_SCHEMA)
    params = cut(first.unionByName(more), "quality-starts")
    for _ in range(FIRST_STEPS):
        params = _step(rows, params, support)
    best = F.min(F.struct("log_det", "start", "centre", "precision")).alias("b")
    params = cut(params.groupBy("pool").agg(best).select("pool", "b.start", "b.centre", "b.precision", "b.log_det"), "quality-best")
    for _ in range(MAX_STEPS):
        before, params = params, _step(rows, params, support)
        moved = params.alias("a").join(before.alias("b"), "pool").where(F.abs(F.col("a.log_det") - F.col("b.log_det")) > SETTLED)
        if moved.isEmpty():
            break
    return params


def fit(stats: DataFrame, support: float = 0.75, min_rows: int = MIN_ROWS) -> DataFrame:
    """(group, centre, precision) for every (lang, source); ``stats`` should be a written table."""
    judges, members = _pools(stats, min_rows)
    rows = cut(_with_params(stats, members, "group").select("doc_id", "pool", *(f"z_{s}" for s in STATS)), "quality-rows")
    counts = rows.groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
    usable = estimates(rows, support).join(counts.where(F.col("n") >= min_rows), "pool", "left_semi")
    return cut(judges.join(usable, "pool").select("group", "centre", "precision"), "quality-fit")


#: Share of a normal group that the cut-off leaves alone.
CONFIDENCE = 1 - 1e-6


def judge(stats: DataFrame, params: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """Adds ``base_failed``, ``distance`` (null without an estimate) and ``kept``."""
    cutoff = chi2_quantile(confidence, len(STATS))
    return (
        _with_params(stats, params, "group")
        .withColumn("base_failed", base_failed())
        .withColumn("distance", F.sqrt(_distance()))
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= math.sqrt(cutoff), F.lit(True)))
        .drop("centre", "precision", "group")
    )


def quality_verdicts(docs: DataFrame, **fit_args) -> DataFrame:
    """doc_id, the base counts, base_failed, distance and kept of every document."""
    rows = docs.select("doc_id", "lang", "source", "text")
    stats = cut(text_stats(rows, ["doc_id", "lang", "source"]).withColumn("group", _group_key()), "quality-stats")
    cols = ["doc_id", *(f.name for f in BASE_FIELDS), "base_failed", "distance", "kept"]
    return judge(stats, fit(stats, **fit_args)).select(*cols)


def keep_good(docs: DataFrame, **fit_args) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they were."""
    packed = docs.select(F.struct("*").alias("whole"), "doc_id", "lang", "source", "text")
    keep = ["doc_id", "lang", "source"]
    stats = cut(text_stats(packed.select(*keep, "text"), keep).withColumn("group", _group_key()), "quality-stats")
    params = fit(stats, **fit_args)
    again = text_stats(packed, ["whole", *keep]).withColumn("group", _group_key())
    return judge(again, params).where("kept").select("whole.*")
