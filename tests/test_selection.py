"""JN-4 / LIM-1: rows at positions found by selection, against a sorted list."""

import random

import pytest

from captally.operators import selection
from captally.operators.ordinals import at_positions, slice_images


def names(kind):
    r = random.Random(kind)
    if kind == 0:
        return [f"img{i:08d}.jpg" for i in range(3000)]
    if kind == 1:  # one long shared prefix, keys of all lengths, code points of one to four bytes
        return list({"common/prefix/of/all/" + "".join(r.choice("aé日🙂/ ") for _ in range(r.randrange(0, 14))) for _ in range(3000)})
    return list({"x" * r.randrange(1, 200) for _ in range(3000)} | {f"{i * i}" for i in range(800)} | {"", "a\u0000", "a"})


@pytest.mark.parametrize("kind, small, pivots", [(0, 5, 16), (1, 20, 16), (2, 5, 64), (2, 2000, 64)])
def test_positions(spark, monkeypatch, kind, small, pivots):
    monkeypatch.setattr(selection, "SMALL", small)
    monkeypatch.setattr(selection, "PIVOTS", pivots)
    keys = names(kind)
    order = sorted(keys, key=str.encode)
    n = len(order)
    df = spark.createDataFrame([(k, len(k)) for k in keys], "image string, size int").repartition(4)
    ask = [n - 1, 0, n // 2, n // 2, n]
    got = at_positions(df, ask).collect()
    assert [(r.ordinal, r.image, r.found) for r in got] == [(p, order[p] if p < n else None, p < n) for p in ask]
    assert all(r["size"] == len(r.image) for r in got if r.found)


@pytest.mark.parametrize("lo, hi", [(1000, 1300), (2990, None), (5000, 6000), (7, 7)])
def test_slices(spark, monkeypatch, lo, hi):
    monkeypatch.setattr(selection, "SMALL", 100)
    order = sorted(names(0))
    df = spark.createDataFrame([(k,) for k in names(0)], "image string").repartition(4)
    got = sorted((r.ordinal, r.image) for r in slice_images(df.unionByName(df), lo, hi).collect())
    assert got == list(enumerate(order))[lo:hi]


def test_no_rows(spark):
    df = spark.createDataFrame([], "image string")
    assert [r.found for r in at_positions(df, [0, 3]).collect()] == [False, False]
    assert slice_images(df, 0, 5).count() == 0


def test_few_rows_reach_the_driver(spark, monkeypatch):
    """Rounds and what they bring grow with the logarithm of the table."""
    rounds = []
    real = selection._counts
    monkeypatch.setattr(selection, "SMALL", 50)
    monkeypatch.setattr(selection, "_counts", lambda *a: rounds.append(real(*a)) or rounds[-1])
    df = spark.range(40_000).selectExpr("concat('img', lpad(id, 9, '0')) as image")
    assert selection.nth_keys(df, "image", [31_234]).first().image == "img000031234"
    assert len(rounds) <= 4 and all(len(b) < 2 * selection.PIVOTS for r in rounds for b in r)
