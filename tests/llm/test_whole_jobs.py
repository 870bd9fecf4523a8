"""Operators do the whole of what their docstrings state, on planted rows."""

from itertools import combinations

import brute_llm as brute
import pytest
from pyspark.sql import functions as F

from captally.llm import decontamination, mixing, queries


def test_decontamination_finds_every_placement_of_two_substitutions(spark):
    bench, docs, want = [], [], set()
    for n in (12, 15):
        item = [f"n{n}w{i}" for i in range(n)]
        bench.append((n, " ".join(item)))
        for where in [(), *combinations(range(n), 1), *combinations(range(n), 2), *combinations(range(n), 3)]:
            words = [f"other{i}" if i in where else w for i, w in enumerate(item)]
            equal = [i not in where for i in range(n)]
            if any(sum(equal[k : k + 12]) >= 10 for k in range(n - 11)):
                want.add((len(docs), n))
            docs.append((len(docs), "x y z " + " ".join(words) + " end of it"))
    item = [f"w{i}" for i in range(59)]
    bench.append((59, " ".join(item)))
    want.add((len(docs), 59))
    # The last window with two substitutions ends before the 58th word.
    docs.append((len(docs), " ".join("other" if i % 5 == 2 else w for i, w in enumerate(item))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(df, items).collect()}
    assert set(got) == want
    assert all(r.n_overlap >= r.n_matches >= 10 for r in got.values())
    last = got[(docs[-1][0], 59)]
    assert (last.n_matches, last.n_overlap, last.first_word) == (46, 57, 0)
    kept = {r.doc_id for r in decontamination.drop_contaminated(df, items).collect()}
    assert kept == {i for i, _ in docs} - {d for d, _ in want}


def test_mix_is_made_of_the_documents(odd):
    """Every slot holds the words its pieces name, and taken counts them."""
    texts = {}
    for r in odd.collect():
        texts.setdefault((r.doc_id, r.source), []).append(brute.spaced((r.text or "").encode()))
    taken = {}
    for r in mixing.mixed_blocks(odd, shard_blocks=64).collect():
        words = brute.spaced(r.text.encode())
        assert 0 < len(words) == sum(p.end - p.start for p in r.pieces) <= mixing.BLOCK_WORDS
        at = 0
        for p in r.pieces:
            part = words[at : at + p.end - p.start]
            assert any(len(t) == p["size"] and t[p.start : p.end] == part for t in texts[(p.doc_id, r.source)])
            at += len(part)
            taken[(p.doc_id, p["size"])] = taken.get((p.doc_id, p["size"]), 0) + len(part)
    report = {}
    for r in mixing.mix_report(odd, shard_blocks=64).collect():
        report[(r.doc_id, r["size"])] = report.get((r.doc_id, r["size"]), 0) + r.taken
    assert {k: n for k, n in report.items() if n} == taken


@pytest.mark.parametrize("name", ["op1_mixing", "pipeline"])
def test_registered_mix_writes_its_texts(spark, monkeypatch, name):
    """The registered queries write every slot's text."""
    import corpus_pipeline

    written = {}

    def keep(df, label="table", real=mixing.cut):
        written[label] = real(df, label)
        return written[label]

    monkeypatch.setattr(mixing, "cut", keep)
    report = {"op1_mixing": queries.op1_mixing, "pipeline": corpus_pipeline.run}[name](spark, "/root/testdata/sf0.01")
    taken = report.agg(F.sum("taken")).first()[0]
    assert written["mix-blocks"].agg(F.sum(F.size(F.split("text", " ")))).first()[0] == taken > 0
