"""The covariance estimate of the quality rules against a plain search, and small groups."""

import math

import numpy as np
import pytest

from captally.llm import quality_rules as q

SCHEMA = "doc_id long, lang string, source string, text string"


def plain(i: int, n: int = 120) -> str:
    return " ".join(f"word{(i * 37 + j * j) % 211}{'s' * ((i + j) % 3)}" for j in range(n))


JUNK = " ".join(f"w{i} ###" if i % 2 else f"v{i} $%" for i in range(240))


def verdicts(spark, rows, **args):
    return {r.doc_id: r for r in q.quality_verdicts(spark.createDataFrame(rows, SCHEMA), **args).collect()}


def least_determinant(z: np.ndarray, support: float, starts: int = 400):
    """Fast search from many random subsets with exact cores."""
    n, p = z.shape
    h = math.ceil(support * n)
    factor = support / q._chi2_cdf(q.chi2_quantile(support, p), p + 2)
    r = np.random.default_rng(5)
    best = np.inf
    for _ in range(starts):
        core = z[r.choice(n, p + 2, replace=False)]
        for _ in range(30):
            cov = q._at_least_floors(factor * np.cov(core.T, bias=True))
            off = z - core.mean(0)
            core = z[np.argsort(np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off), kind="stable")[:h]]
        best = min(best, np.linalg.slogdet(q._at_least_floors(factor * np.cov(core.T, bias=True)))[1])
    return best


@pytest.mark.parametrize("seed, n, bad", [(1, 40, 6), (2, 60, 12), (3, 200, 45)])
def test_least_determinant(spark, seed, n, bad):
    """Cores far wider than the floors, correlated statistics and a far cloud: as small a determinant as a plain search."""
    r = np.random.default_rng(seed)
    mix = np.eye(6) + 0.4 * r.normal(size=(6, 6))
    z = r.normal(size=(n, 6)) @ mix
    z[:bad] = 0.3 * z[:bad] + 12 * np.array([1, 1, 0, 1, 0, 1])
    fixed = np.rint(z * q.SCALE).astype(int)
    names = ", ".join(f"z_{s} long" for s in q.STATS)
    rows = spark.createDataFrame([(i, "gx", *map(int, x)) for i, x in enumerate(fixed)], f"doc_id long, pool string, {names}")
    (got,) = q.estimates(rows).collect()
    assert got.log_det <= least_determinant(fixed / q.SCALE, 0.75) + 0.35
    # The far cloud stays outside, the rest inside.
    off = fixed / q.SCALE - np.array(got.centre)
    d = np.sqrt(np.einsum("ij,jk,ik->i", off, np.reshape(got.precision, (6, 6)), off))
    assert d[:bad].min() > math.sqrt(q.chi2_quantile(q.CONFIDENCE, 6)) > np.median(d[bad:])


def test_junk_in_a_small_group(spark):
    rows = [(i, "en", "a", plain(i)) for i in range(29)] + [(99, "en", "a", JUNK)]
    got = verdicts(spark, rows)
    assert not got[99].kept and not got[99].base_failed and all(got[i].kept for i in range(29))


def test_rare_groups_are_judged_by_the_language_or_the_table(spark):
    rows = [(i, "en", "a", plain(i)) for i in range(60)]
    rows += [(60, "en", "rare", plain(60)), (61, "en", "rare", JUNK), (62, "xx", "rare", plain(62)), (63, None, None, JUNK)]
    got = verdicts(spark, rows)
    assert [got[i].kept for i in (60, 61, 62, 63)] == [True, False, True, False]
    assert all(r.distance is not None for r in got.values())


def test_one_row_does_not_switch_the_test_off(spark):
    """98 clean rows and one of junk in a group of its own."""
    rows = [(i, "en", "a", plain(i)) for i in range(98)] + [(98, "en", "b", JUNK)]
    got = verdicts(spark, rows)
    assert [i for i, r in got.items() if not r.kept] == [98]


def test_stage_on_odd_rows(odd, none):
    kept = q.keep_good(odd)
    assert kept.columns == odd.columns
    good = {(r.doc_id, r.kept) for r in q.quality_verdicts(odd).collect()}
    out = [r.doc_id for r in kept.collect()]
    assert out and {(i, True) for i in out} <= good
    assert q.keep_good(none).count() == 0
