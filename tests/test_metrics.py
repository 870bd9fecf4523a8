"""MET-1..7 against a plain-Python reading of the definitions."""

import math
import re

import pytest
from pyspark.sql import functions as F

import brute
from captally.operators import metrics as M

CANDS = {
    "a.jpg": "a dog runs on the grass",
    "b.jpg": "two children play in the park today",
    "c.jpg": "",  # empty prediction
    "d.jpg": "a man",
    "e.jpg": "the cat sat on the mat",
}
REFS = {
    "a.jpg": ["a dog runs on grass", "the dog is running", "a brown dog  runs fast on the green grass"],
    "b.jpg": ["children play in a park"],
    "c.jpg": ["a scene", "something happens"],
    "d.jpg": ["a man walks", "a man", "man"],
    "e.jpg": ["the cat sat on the mat", "a cat is on a mat", "the cat sat", "cat", "on the mat the cat sat"],
    "z.jpg": ["references without a prediction are not scored"],
}


def frames(spark, cands=CANDS, refs=REFS):
    p = spark.createDataFrame(list(cands.items()), "image string, caption string")
    r = spark.createDataFrame(
        [(img, i, c) for img, cs in refs.items() for i, c in enumerate(cs)], "image string, pos int, caption string"
    )
    return p, r


def scored_refs(cands=CANDS, refs=REFS):
    return {k: refs[k] for k in cands if k in refs}


def check(spark, cands=CANDS, refs=REFS, tol=1e-9):
    p, r = frames(spark, cands, refs)
    per = {row.image: row for row in M.per_image_scores(p, r).collect()}
    corpus = {row.metric: row.score for row in M.caption_scores(p, r).collect()}
    rr = scored_refs(cands, refs)
    b, bper = brute.bleu(cands, rr)
    rl, rper = brute.rouge_l(cands, rr)
    cd, cper = brute.cider(cands, rr)
    assert set(per) == set(cands)
    for img in cands:
        for k in range(4):
            assert per[img][f"bleu_{k + 1}"] == pytest.approx(bper[img][k], abs=tol)
        assert per[img].rouge_l == pytest.approx(rper[img], abs=tol)
        assert per[img].cider == pytest.approx(cper[img], abs=tol)
    for k in range(4):
        assert corpus[f"Bleu_{k + 1}"] == pytest.approx(b[k], abs=tol)
    assert corpus["ROUGE_L"] == pytest.approx(rl, abs=tol)
    assert corpus["CIDEr"] == pytest.approx(cd, abs=tol)
    return corpus


def test_metrics_match_brute_force(spark):
    check(spark)


def test_hot_key_path_gives_same_result(spark):
    base = check(spark)
    spark.conf.set("captally.skew.hotKeyRows", "1")
    try:
        hot = check(spark)
    finally:
        spark.conf.unset("captally.skew.hotKeyRows")
    assert hot == pytest.approx(base)


def test_invariant_under_partitioning(spark):
    base = check(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert check(spark) == pytest.approx(base)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_bleu_is_one_for_exact_match(spark):
    cands = {"x.jpg": "a b c d e", "y.jpg": "one two three four"}
    refs = {"x.jpg": ["a b c d e"], "y.jpg": ["one two three four"]}
    p, r = frames(spark, cands, refs)
    corpus = {row.metric: row.score for row in M.caption_scores(p, r).collect()}
    for k in range(1, 5):
        assert corpus[f"Bleu_{k}"] == pytest.approx(1.0, abs=1e-6)
    assert corpus["ROUGE_L"] == pytest.approx(1.0)


def test_single_image_cider_is_zero(spark):
    p, r = frames(spark, {"a.jpg": "a dog"}, {"a.jpg": ["a dog"]})
    corpus = {row.metric: row.score for row in M.caption_scores(p, r).collect()}
    assert corpus["CIDEr"] == 0.0


def test_empty_input_gives_no_scores(spark):
    p, r = frames(spark, {"a.jpg": "a dog"}, {"b.jpg": ["a cat"]})
    assert M.caption_scores(p, r).count() == 0


def test_unknown_tokenizer(spark):
    p, r = frames(spark)
    with pytest.raises(ValueError):
        M.pair(p, r, "bogus")


def test_caption_mode_runs_and_is_bounded(spark):
    p, r = frames(spark)
    rows = M.caption_scores(p, r, "caption").collect()
    assert {x.metric for x in rows} == set(M.METRIC_NAMES)
    assert all(x.score >= 0 and math.isfinite(x.score) for x in rows)


def test_coverage(spark):
    p, r = frames(spark, dict(CANDS, **{"q.jpg": "no refs"}))
    row = M.coverage(p, r).first()
    assert (row.scored_images, row.unreferenced_predictions, row.unpredicted_images) == (5, 1, 1)


def test_golden_values_from_fixtures(spark):
    """FIXTURES.md section 4: first five sentences, at most 30 tokens per side."""
    from captally import fixtures as fx

    arr = fx.sentence_arrays(spark, "/root/testdata/sf0.01").where(F.size("sents") >= 2)
    cut30 = lambda toks: F.array_join(F.slice(toks, 1, 30), " ")
    kept = F.filter(F.split(F.get(F.col("sents"), 0), " "), lambda t, i: i % 5 != 4)
    preds = arr.select("image", cut30(kept).alias("caption"))
    refs = arr.select("image", F.posexplode(F.slice("sents", 1, 5)).alias("pos", "s")).select(
        "image", "pos", cut30(F.split("s", " ")).alias("caption")
    )
    got = {row.metric: row.score for row in M.caption_scores(preds, refs).collect()}
    golden = {"Bleu_1": 0.906014, "Bleu_2": 0.814998, "Bleu_3": 0.707249, "Bleu_4": 0.572307,
              "ROUGE_L": 0.922525, "CIDEr": 1.217965}
    for k, v in golden.items():
        assert got[k] == pytest.approx(v, abs=2e-6), k


def scoring_plan(spark, p, r):
    paired = M.pair(p, r)
    df = M.image_scores_plan(paired, M.measured(paired))
    df.collect()
    return paired, df._jdf.queryExecution().executedPlan().toString()


def test_plan_that_runs(spark):
    """One scan of predictions, grams written once, nothing in a single partition, no cross or nested-loop join."""
    p, r = frames(spark)
    paired, plan = scoring_plan(spark, p, r)
    assert "isFinalPlan=true" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan
    assert "LocalTableScan" not in plan and "Scan ExistingRDD" not in plan  # the inputs were read once, before


def test_hot_image_and_hot_gram_are_shared_out(spark):
    """One image with most references, all holding one gram: several tasks do its work and scores are right."""
    cands = {f"i{k}.jpg": "a dog runs here" for k in range(6)}
    refs = {k: ["a dog"] for k in cands}
    refs["i0.jpg"] = [f"a dog runs {n} times" for n in range(400)]
    check(spark, cands, refs)
    p, r = frames(spark, cands, refs)
    paired = M.pair(p, r)
    hot = paired.pairs.where("image = 'i0.jpg'")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny partitions would be merged
    try:
        dealt = M.measures.spread(hot).select(F.spark_partition_id().alias("part")).distinct()
        assert dealt.count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_skew_join_deals_hot_keys(spark):
    from captally.operators.skew import skew_join

    big = spark.createDataFrame([("hot", i) for i in range(500)] + [(f"k{i}", i) for i in range(50)], "k string, v int")
    small = spark.createDataFrame([("hot", "H"), ("k1", "one"), ("k2", "two"), ("nope", "x")], "k string, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(str, big.join(small, ["k"], how).collect()))
        assert sorted(map(str, skew_join(big, small, ["k"], how, threshold=100).collect())) == want, how


def test_second_prediction_is_an_error_unless_ordered(spark):
    p = spark.createDataFrame([("a", 0, "old one"), ("a", 1, "a dog"), ("b", 0, "cat")], "image string, pos int, caption string")
    r = spark.createDataFrame([("a", 0, "a dog"), ("b", 0, "cat")], "image string, pos int, caption string")
    with pytest.raises(ValueError, match="1 image"):
        M.pair(p.drop("pos"), r)
    assert sorted(x.c_caption for x in M.pair(p, r).pairs.collect()) == ["a dog", "cat"]


def test_presets_are_scored_apart_in_one_job(spark):
    p, r = frames(spark)
    other = {k: "the " + v for k, v in CANDS.items() if k != "b.jpg"}
    q, _ = frames(spark, other)
    both = p.withColumn("preset", F.lit("x")).unionByName(q.withColumn("preset", F.lit("y")))
    got = {(x.preset, x.metric): x.score for x in M.caption_scores(both, r).collect()}
    for name, preds in (("x", p), ("y", q)):
        for row in M.caption_scores(preds, r).collect():
            assert got[name, row.metric] == pytest.approx(row.score, abs=1e-9)


def many_references():
    cands = {f"i{k}.jpg": f"a dog runs here with dog {k % 3}" for k in range(7)}
    refs = {k: [f"a dog {j}", "the dog  runs here", "a a a dog"] for j, k in enumerate(cands)}
    refs["i0.jpg"] = [f"a dog runs {n % 5} times in field {n}" for n in range(150)]
    refs["i1.jpg"] = [f"with dog {n % 7} a dog runs {n} times" for n in range(90)]
    return cands, refs


def test_small_blocks_and_wide_images_give_the_same_scores(spark, monkeypatch):
    """Images in many blocks, two of them dealt by their references: scores equal the brute-force ones."""
    monkeypatch.setattr(M.measures, "BLOCK_BYTES", 500)
    monkeypatch.setattr(M.measures, "WIDE_BYTES", 2000)
    cands, refs = many_references()
    check(spark, cands, refs)
    p, r = frames(spark, cands, refs)
    rows = M.measured(M.pair(p, r))
    wide = rows.where("h1 is null").groupBy("unit").count().where("count > 1")
    assert wide.count() == 2 and rows.where("h1 is not null").count() > 0


def test_no_gram_row_is_written(spark):
    """what is kept of the pairs is one row an image, not one a gram."""
    cands, refs = many_references()
    p, r = frames(spark, cands, refs)
    assert M.measured(M.pair(p, r)).count() == len(cands)


def test_gram_counts_without_a_shuffle_of_grams(spark):
    """grams are counted where their text is; rows with equal keys are added up, null tokens make no gram."""
    from collections import Counter

    from captally.operators import ngrams

    rows = [("a", 1, ["x", "y", "x", "y"]), ("a", 1, ["x", "y"]), (None, 1, ["x"]), (None, 1, ["x", None, "z"]), ("b", 2, []), ("c", 3, None)]
    df = spark.createDataFrame(rows, "k string, p int, t array<string>")
    got = ngrams.ngram_counts(df, "t", ["k", "p"], 3)
    assert dict(got.dtypes) == {"k": "string", "p": "int", "n": "int", "g": "string", "cnt": "bigint"}
    want = Counter()
    for k, p, t in rows:
        for n in (1, 2, 3):
            for i in range(len(t or []) - n + 1):
                if None not in t[i : i + n]:
                    want[k, p, n, " ".join(t[i : i + n])] += 1
    assert {(x.k, x.p, x.n, x.g): x.cnt for x in got.collect()} == want
    assert got.count() == len(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") and "Aggregate" not in plan


def test_document_frequency_over_blocks(spark, monkeypatch):
    """each gram is one row with its number of images, wherever its images lie."""
    monkeypatch.setattr(M.measures, "BLOCK_BYTES", 500)
    monkeypatch.setattr(M.measures, "WIDE_BYTES", 2000)
    cands, refs = many_references()
    p, r = frames(spark, cands, refs)
    got = M.reference_frequencies(M.pair(p, r)).collect()
    want = {}
    for image, texts in refs.items():
        for t in (x.split() for x in texts):
            for n in range(1, 5):
                for i in range(len(t) - n + 1):
                    want.setdefault((n, " ".join(t[i : i + n])), set()).add(image)
    assert {(x.n, x.g): x.df for x in got} == {k: len(v) for k, v in want.items()}
    assert len(got) == len(want)


def test_packed_numbers_come_back():
    import numpy as np

    m = M.measures
    rng = np.random.default_rng(7)
    for x in ([], [0], [0, 0, 5, 5], [2**64 - 1], [3, 2**64 - 1], rng.integers(0, 2**64, 5000, np.uint64), rng.integers(0, 1 << 12, 5000, np.uint64)):
        x = np.sort(np.array(x, np.uint64))
        assert (m.unpack_sorted(m.pack_sorted(x)) == x).all()
        for k in (1, 37, 64):
            got = m.unpack_bits(np.frombuffer(m.pack_bits(x, k), np.uint8), len(x), k)
            assert (got == x & np.uint64((1 << k) - 1)).all()
    counts = np.array([0, 1, 255, 256, 70000, 2**31 - 1])
    assert (m.unpack_counts(m.pack_counts(counts)) == counts).all()


def test_no_reference_text_is_written(spark, monkeypatch):
    """the texts are dealt to their blocks; no table of references or of pairs lies on the disk."""
    written = []

    def kept(df, name="table"):
        written.append((name, df.columns))
        return cut(df, name)

    cut = M.cut
    monkeypatch.setattr(M, "cut", kept)
    monkeypatch.setattr(M.measures, "cut", kept)
    p, r = frames(spark)
    assert M.image_scores(M.pair(p, r)).count() == len(CANDS)
    assert [name for name, columns in written if "caption" in columns] == ["predictions", "candidates"]
    assert not [name for name, columns in written if "c_caption" in columns]


def test_only_shared_grams_are_sent_whole():
    """a gram that no other block has costs some bits, and its number of images is right."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    m, bits = M.measures, 24

    def block(unit, texts):
        k = len(texts)
        return m.Block(pa.table({"unit": pa.array([unit] * k, pa.int64()), "wide": pa.array([False] * k), "n_images": pa.array([2] * k, pa.int64()),
                                 "preset": pa.array([""] * k), "caption": pa.array(texts), "c_caption": pa.array(["common one"] * k)}), "whitespace", 4, 1)

    blocks = [block(u, [f"common one w{u}x{k} v{u}x{k}" for k in range(200)]) for u in (1, 2)]
    asked = pa.concat_tables(b.places(k, bits) for k, b in enumerate(blocks))
    assert sum(map(len, asked["places"].to_pylist())) < 3 * sum(len(b.keys) for b in blocks)
    marks = m.mark(asked)
    mine = [marks.filter(pc.equal(marks["block"], k)) for k in (0, 1)]
    shared = [b.shared(x) for b, x in zip(blocks, mine)]
    sent = pa.concat_tables(b.requests(k, s, bits) for k, (b, s) in enumerate(zip(blocks, shared)))
    assert all(3 <= s.sum() < 10 for s in shared)  # common, one, common one
    totals = m.add_up(asked, sent, bits, once=False)
    for k, (b, s) in enumerate(zip(blocks, shared)):
        df = b.totals(s, totals.filter(pc.equal(totals["block"], k)))
        assert (df == 2).sum() == 3 and (df == 1).sum() == len(b.keys) - 3 and np.isin(np.flatnonzero(df == 2), np.flatnonzero(s)).all()


def test_presets_of_the_same_images_share_their_references(spark, monkeypatch):
    """F1: references are read and counted once for presets that have the same images, and each preset's scores are its own."""
    monkeypatch.setattr(M.measures, "BLOCK_BYTES", 500)
    monkeypatch.setattr(M.measures, "WIDE_BYTES", 2000)
    cands, refs = many_references()
    p, r = frames(spark, cands, refs)
    q, _ = frames(spark, {k: f"the dog {v} in field 3" for k, v in cands.items()}, refs)
    some, _ = frames(spark, {k: v for k, v in cands.items() if k > "i2"}, refs)
    tables = {"x": p, "y": q, "z": some}
    both = [df.withColumn("preset", F.lit(name)) for name, df in tables.items()]
    paired = M.pair(both[0].unionByName(both[1]).unionByName(both[2]), r)
    assert {(x.preset, x.alike) for x in paired.cand.select("preset", "alike").distinct().collect()} == {
        (name, paired.cand.where(F.col("preset") == of).first().alike) for name, of in (("x", "x"), ("y", "x"), ("z", "z"))
    }
    assert paired.cand.select("alike").distinct().count() == 2
    got = {(x.preset, x.metric): x.score for x in M.corpus_scores(M.image_scores(paired)).collect()}
    for name, preds in tables.items():
        for row in M.caption_scores(preds, r).collect():
            assert got[name, row.metric] == pytest.approx(row.score, abs=1e-9)
    # A block that has two candidates of an image has its references once.
    m = M.measures
    dealt, _, _ = m.in_blocks(paired.cand.withColumn("preset", F.col("alike")).where("preset = alike and image = 'i5.jpg'"), r, paired.sizes, "whitespace")
    blocks = [m.block_texts([x.rows for x in rows]) for rows in _by_block(dealt)]
    assert sum(len(t.refs) for t in blocks) == 2 * len(refs["i5.jpg"]) and sum(len(t.cands) for t in blocks) == 3


def _by_block(dealt):
    blocks = {}
    for x in dealt.collect():
        blocks.setdefault(x.block, []).append(x)
    return blocks.values()


def test_a_round_computes_what_it_needs():
    """the first round sorts the grams' hashes only; no gram is counted and no second hash made for it."""
    import pyarrow as pa

    k = 50
    block = M.measures.Block(pa.table({"unit": pa.array([1] * k, pa.int64()), "wide": pa.array([False] * k), "n_images": pa.array([2] * k, pa.int64()),
                                       "preset": pa.array([""] * k), "caption": pa.array([f"one two w{i}" for i in range(k)]), "c_caption": pa.array(["one two"] * k)}), "whitespace", 4, 4)
    assert block.places(0, 20).num_rows == 4
    assert not {"sorted_grams", "h2", "seen", "keys"} & set(vars(block))
    assert len(block.slots[0]) == 3 + 3 * k  # one, two, "one two"; and w, "two w" and "one two w" of each
    assert block.seen.tolist() == [1] * (3 + 3 * k)


def test_hashes_and_orders_of_a_block():
    """what the array steps of a block rest on."""
    import numpy as np
    import pyarrow as pa

    from captally.functions.arrow_text import flat

    m = M.measures
    words = ["", "a", "b", "a\0", "\0", "abcdefgh", "abcdefghi", "abcdefgh\0", "é", "x" * 64, "x" * 65, "x" * 66, "x" * 200, *map(str, range(5000))]
    data, offsets = flat(pa.array(words))
    got = m.span_hashes(data, offsets[:-1], offsets[1:])
    assert len(set(got[0].tolist())) == len(set(got[1].tolist())) == len(words)
    data, offsets = flat(pa.array(words[::-1]))  # other neighbours
    assert (m.span_hashes(data, offsets[:-1], offsets[1:])[:, ::-1] == got).all()
    rng = np.random.default_rng(3)
    for x in (np.zeros(0, np.uint64), rng.integers(0, 2**64, 3000, np.uint64), rng.integers(0, 5, 3000).astype(np.uint64), rng.integers(0, 3, 3000, np.uint64) << np.uint64(60) | rng.integers(0, 9, 3000, np.uint64)):
        assert (m.sorted_order(x) == np.argsort(x, kind="stable")).all()
    known = np.unique(rng.integers(0, 10**6, 2000))
    x = np.append(rng.integers(0, 10**6, 5000), -1)
    at = m.among(x, known)
    assert ((at >= 0) == np.isin(x, known)).all() and (known[at[at >= 0]] == x[at >= 0]).all()
    assert (m.among(x, known[:0]) == -1).all()


def test_odd_texts_have_the_brute_force_scores(spark):
    """long tokens, odd white space, empty texts and repeated tokens."""
    long = "q" * 70
    cands = {"a.jpg": f"{long} dog  dog\tsat on the {long}", "b.jpg": "", "c.jpg": "   ", "d.jpg": "no word in common", "e.jpg": f"{'z' * 300} a b a b a b"}
    refs = {"a.jpg": [f"dog {long} sat", "", f"dog\tsat on the  {long}", "the the dog dog"], "b.jpg": ["", "x"], "c.jpg": ["  ", "a  b"], "d.jpg": ["other text", " "], "e.jpg": [f"a b {'z' * 300} a b a", f"{'z' * 299} b a"]}
    check(spark, cands, refs)


def test_reference_grams_write_no_pairs_and_shuffle_no_lists(spark, monkeypatch):
    """references are dealt once, as compressed texts; rows of one image and place are counted together."""
    from collections import Counter

    written = []

    def kept(df, name="table"):
        written.append(name)
        return cut(df, name)

    cut = M.cut
    monkeypatch.setattr(M, "cut", kept)
    monkeypatch.setattr(M.measures, "cut", kept)
    monkeypatch.setattr(M.measures, "BLOCK_BYTES", 500)
    monkeypatch.setattr(M.measures, "WIDE_BYTES", 2000)
    cands, refs = many_references()
    rows = [(k, j, t) for k, ts in refs.items() for j, t in enumerate(ts)]
    rows += [("i3.jpg", 1, "the dog again"), ("i3.jpg", None, "no place"), ("i3.jpg", None, "no place"), ("i9.jpg", 0, "no candidate"), (None, 0, "no image"), ("i4.jpg", 7, None)]
    r = spark.createDataFrame(rows, "image string, pos int, caption string")
    p, _ = frames(spark, cands, refs)
    both = p.withColumn("preset", F.lit("x")).unionByName(p.where("image < 'i2'").withColumn("preset", F.lit("y")))
    grams = M.reference_grams(M.pair(both, r))
    want = Counter()
    for name, images in (("x", set(cands)), ("y", {k for k in cands if k < "i2"})):
        for image, pos, text in rows:
            t = text.split() if text and image in images else []
            for n in range(1, 5):
                for i in range(len(t) - n + 1):
                    want[name, image, pos, n, " ".join(t[i : i + n])] += 1
    assert [(c, t) for c, t in grams.dtypes][:3] == [("preset", "string"), ("image", "string"), ("pos", "int")]
    got = grams.collect()
    assert {(x.preset, x.image, x.pos, x.n, x.g): x.cnt for x in got} == want and len(got) == len(want)
    assert "pairs" not in written
    plan = grams._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(block" in plan and not re.search(r"hashpartitioning\(preset#\d+, image#\d+, pos", plan)
