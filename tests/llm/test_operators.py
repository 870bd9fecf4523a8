"""Each operator against a plain reading of its contract, on odd rows and on given tables."""

import hashlib
import math
import zlib

import brute_llm as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from captally.llm import decontamination, language_id, license_scan, lm_scoring, mixing, pii, quality_rules, simhash_dedup, suffix_dedup

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def tables(odd, given):
    return [[(r.doc_id, r.text, r.source) for r in t.collect()] for t in (odd, given)]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def same(left, right, digits=9):
    left, right = key(left), key(right)
    assert len(left) == len(right)
    for a, b in zip(left, right, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=10**-digits, abs_tol=10**-digits)), (a, b)


@pytest.mark.parametrize("which", [0, 1])
def test_mixing(spark, odd, given, which):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    got = [tuple(r) for r in mixing.mix_report(df, shard_blocks=64).collect()]
    size = [len(brute.spaced((t or "").encode())) for _, t, _ in rows]
    per = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        per[s] = per.get(s, 0) + n
    goal = brute.targets(per)
    same([(i, n, per[s], goal[s]) for (i, _, s), n in zip(rows, size, strict=True)], [g[:4] for g in got], 6)
    assert all(0 <= g[4] <= 3 * g[1] for g in got)
    taken = {}
    for g in got:
        taken[(g[2], round(g[3], 3))] = taken.get((g[2], round(g[3], 3)), 0) + g[4]
    for (source_size, target), t in taken.items():
        assert abs(t - target) <= max(mixing.BLOCK_WORDS, 0.02 * target), (source_size, target, t)
    again = [tuple(r) for r in mixing.mix_report(df.repartition(5), shard_blocks=64).collect()]
    assert key(again) == key(got)


def test_mix_blocks_are_the_report(given):
    blocks = mixing.mixed_blocks(given, shard_blocks=64)
    words = blocks.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    report = mixing.mix_report(given, shard_blocks=64).join(given.select("doc_id", "source"), "doc_id")
    assert {r.source: r.n for r in words} == {r.source: r.n for r in report.groupBy("source").agg(F.sum("taken").alias("n")).collect()}


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 64, 1001):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5), F.lit(0)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


@pytest.mark.parametrize("group_rows", [suffix_dedup.GROUP_ROWS, 2])
@pytest.mark.parametrize("which", [0, 1])
def test_suffix_dedup(odd, given, which, group_rows):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    got = suffix_dedup.repeat_report(df, group_rows=group_rows).collect()
    want = [(i, *r) for (i, _, _), r in zip(rows, brute.repeats([t for _, t, _ in rows]), strict=True)]
    same(want, [tuple(r) for r in got])


def test_suffix_dedup_oracle(given):
    import duckdb

    from captally.llm.queries import ORACLES

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF001}/documents.parquet'")
    same(con.sql(ORACLES["op2_suffix_dedup"]).fetchall(), [tuple(r) for r in suffix_dedup.repeat_report(given).collect()])


def test_deep_shallow_order():
    rng = np.random.default_rng(4)
    for _ in range(60):
        m, size = int(rng.integers(1, 70)), int(rng.integers(9, 90))
        group = np.sort(rng.integers(0, 5, m))
        texts = rng.integers(97, 99, (m, size)).astype(np.uint8)
        for i in range(1, m):
            n = rng.integers(0, size + 1)
            texts[i, :n] = texts[rng.integers(0, i), :n]
        order, shared = suffix_dedup.deep_shallow(texts, group, shallow=int(rng.choice([0, 8, 16, 64])))
        rows = [(group[i], texts[i].tobytes()) for i in order]
        assert rows == sorted(rows)
        for j in range(m):
            if j == 0 or rows[j][0] != rows[j - 1][0]:
                assert shared[j] == -1
            else:
                a, b = rows[j - 1][1], rows[j][1]
                assert shared[j] == next((k for k in range(size) if a[k] != b[k]), size)


def test_language_id(spark, odd, given):
    mixed = given.unionByName(odd.select(given.columns))
    got = {(r.doc_id, r.text): r for r in language_id.identify_languages(mixed).join(mixed.select("doc_id", "text", "lang"), "doc_id").collect()}
    for (i, text), r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    real = given.join(language_id.identify_languages(given), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in real) >= 0.97 * len(real)
    found = {r.doc_id: r.lang_pred for r in language_id.identify_languages(odd).collect() if r.doc_id in (4, 5, 6, 7, 13)}
    assert [found[i] == "und" for i in (4, 5, 6, 7, 13)] == [True, True, True, False, False]


def test_language_id_needs_no_language(odd):
    got = language_id.identify_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)} and len(got) == odd.count()


@pytest.mark.parametrize("which", [0, 1])
def test_quality_base(odd, given, which):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    got = quality_rules.quality_verdicts(df).collect()
    want = []
    for i, t, _ in rows:
        n_words, *rest = brute.quality(t)
        want.append((i, n_words, *rest, n_words < 20 or 100 * rest[-1] > 30 * n_words))
    same(want, [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got])
    assert not any(r.kept for r in got if r.base_failed)


def test_quality_outliers(spark):
    """Junk is rejected, clean text of any length stays."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_rules.quality_verdicts(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r.kept for r in got if r.quality == 1)
    bad = [r.kept for r in got if r.quality == 0]
    assert bad and sum(bad) <= 0.1 * len(bad)


def test_quality_without_an_estimate_has_no_distance(spark):
    docs = spark.createDataFrame([(i, "en", "a", " ".join(f"word{i}x{j}" for j in range(30))) for i in range(5)], "doc_id long, lang string, source string, text string")
    assert [(r.distance, r.kept) for r in quality_rules.quality_verdicts(docs).collect()] == [(None, True)] * 5


def test_chi_square_quantiles():
    assert abs(quality_rules.chi2_quantile(0.95, 1) - 3.841) < 1e-3
    assert abs(quality_rules.chi2_quantile(0.99, 5) - 15.086) < 1e-3


@pytest.mark.parametrize("which", [0, 1])
def test_lm_scoring(odd, given, which):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    pieces = 1 << 10  # most words take the join
    got = [tuple(r) for r in lm_scoring.score_texts(df, frequent=pieces).collect()]
    want = [(i, *r) for (i, _, _), r in zip(rows, brute.word_scores([(i, t) for i, t, _ in rows]), strict=True)]
    same(want, [g[:6] for g in got], 7)
    assert all(g[6] < 0 for g in got)
    few = [tuple(r) for r in lm_scoring.score_texts(df, frequent=0).collect()]
    same(got, few, 7)


def test_lattice_sums_all_segmentations():
    import pyarrow as pa

    texts = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab"]
    pieces = lm_scoring.Pieces([t.encode() for t in texts], [-float(i) for i in range(len(texts))])
    p = dict(zip(texts, np.exp(pieces.log_p), strict=False))

    def total(s):
        if not s:
            return 1.0
        out = sum(p[t] * total(s[len(t) :]) for t in texts if s.startswith(t))
        if s[0] not in p:
            out += float(np.exp(sum(pieces.log_p[pieces.n + b] for b in s[0].encode()))) * total(s[1:])
        return out

    words = ["a", "ab", "aba", "baab", "é", "aéb", "abababab"]
    lattice = lm_scoring.Lattice(pieces)
    assert np.allclose(np.exp(lattice.log_probabilities(pa.array(words))), [total("▁" + w) for w in words])
    counts = lattice.expected_counts(pa.array(["ab"]), np.array([2.0]))
    # ▁ a b | ▁ ab | ▁a b | ▁ab
    ways = {("▁", "a", "b"): 0, ("▁", "ab"): 0, ("▁a", "b"): 0, ("▁ab",): 0}
    ways = {w: math.prod(p[x] for x in w) for w in ways}
    want = {t: 2 * sum(v * w.count(t) for w, v in ways.items()) / sum(ways.values()) for t in texts}
    assert np.allclose(counts[: len(texts)], [want[t] for t in texts])


def test_long_word_has_a_probability():
    import pyarrow as pa

    pieces = lm_scoring.Pieces.load(lm_scoring.VOCABULARY)
    got = lm_scoring.Lattice(pieces).log_probabilities(pa.array(["ab" * 3000, "x"]))
    assert np.isfinite(got).all() and got[0] < got[1]


@pytest.mark.parametrize("which", [0, 1])
def test_simhash(odd, given, which):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    got = [tuple(r) for r in simhash_dedup.near_duplicates(df).collect()]
    prints = [brute.fingerprint(t) for _, t, _ in rows]
    label = brute.near_components(prints)
    least = {}
    for (i, _, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = [(i, f"{f:016x}", least.get(c)) for (i, _, _), f, c in zip(rows, prints, label, strict=True)]
    same(want, got)
    kept = simhash_dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == len(set(label))


@pytest.mark.parametrize("block_rows", [simhash_dedup.BLOCK_ROWS, 5])
def test_simhash_links(spark, block_rows):
    """Dense clusters, and keys cut into salted blocks, lose no link."""
    rng = np.random.default_rng(8)
    codes = set()
    for _ in range(25):
        base = int(rng.integers(0, 2**63))
        for _ in range(int(rng.integers(1, 40))):
            flips = rng.choice(24, rng.integers(0, 7), replace=False)
            codes.add((base ^ sum(1 << int(b) for b in flips)) & (2**63 - 1))
    codes = sorted(codes)
    fps = spark.createDataFrame([(c,) for c in codes], "fp long")
    roots = {r.node: r.root for r in simhash_dedup.components(simhash_dedup.links(fps, block_rows=block_rows)).collect()}
    label = brute.near_components(codes)
    assert [roots.get(c, c) for c in codes] == [codes[i] for i in label]


@pytest.mark.parametrize("which", [0, 1])
def test_decontamination(spark, odd, given, which):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    whole = next(t for _, t, _ in rows if t and 100 < len(t.split()) < 500)
    extra = [(901, whole), (902, "of the and"), (903, ""), (904, None), (905, whole)]
    bench = bench.unionByName(spark.createDataFrame(extra, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()}
    want = brute.overlaps([(i, t) for i, t, _ in rows], [(r.item_id, r.text) for r in bench.collect()])
    assert got == want and want
    kept = decontamination.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert key((r.doc_id, r.text) for r in kept.collect()) == key((i, t) for i, t, _ in rows if not brute.overlaps([(i, t)], [(r.item_id, r.text) for r in bench.collect()]))


def test_decontamination_stands_substitutions(spark):
    words = [f"w{i}" for i in range(30)]
    planted = list(words)
    planted[7] = planted[19] = "other"
    docs = spark.createDataFrame([(1, "x y z " + " ".join(planted) + " end"), (2, "w1 w2 w3 other w5"), (3, " ".join(reversed(words)))], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    got = decontamination.contaminated(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.n_matches, r.n_overlap, r.first_word) for r in got] == [(1, 5, 28, 30, 3)]


def test_decontamination_finds_short_items_whole(spark):
    texts = ["x Paris is, the capital CITY y", "paris is the capital", "paris is the big city", "the capital city paris is", "a b c d", "e f", "paris is the capital city", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(1, "paris is the capital city", "?"), (2, "Paris is the capital", "?"), (3, "b c d", "?"), (4, "e f", "?"), (5, "a b c d", "?"), (6, None, "?"), (7, "paris is the capital city", "?")]
    bench = spark.createDataFrame(items, "item_id long, text string, tid string")
    split = [brute.alnum(brute.low(t)) for t in texts]

    def whole(least):
        want = set()
        for i, toks in enumerate(split):
            for j, t, _ in items:
                w = brute.alnum(brute.low(t))
                if len(w) >= least and any(toks[k : k + len(w)] == w for k in range(len(toks) - len(w) + 1)):
                    want.add((i, j))
        return want

    for least in (4, 1):
        got = decontamination.contaminated(docs, bench, least_tokens=least).collect()
        assert {(r.doc_id, r.item_id) for r in got} == whole(least) and len(got) == len(whole(least))
    kept = decontamination.drop_contaminated(docs, bench).collect()
    assert {r.doc_id for r in kept} == set(range(len(texts))) - {i for i, _ in whole(4)}


@pytest.mark.parametrize("which", [0, 1])
def test_license_base(odd, given, which):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    got = license_scan.scan_licenses(df).collect()
    want = [(i, *brute.license_base(t)) for i, t, _ in rows]
    same(want, [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got])
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got)


def test_license_templates(spark):
    texts = [
        "Foo. This great work is licensed under the Apache License, Version 2.0.",
        "licensed under the apache licence version 2.0",  # mandatory word spelled otherwise
        "Released under the terms of the MIT License",
        "released under a MIT License",
        "all rights reserved. Apache cc by gnu GENERAL public license",
        "Licensed under CC BY-NC 4.0.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(docs).collect()}
    assert got == {0: "apache-2.0", 1: "", 2: "mit", 3: "", 4: "cc-by,gpl,reserved", 5: "cc-by,cc-by-nc"}


def test_token_automaton():
    a = license_scan.TokenAutomaton("one [[two [[three]]]] {{0-2}} four {{x|y}} five")
    accepts = lambda s: a.longest(s.split()) is not None and a.longest(s.split())[0] == len(s.split())
    assert all(map(accepts, ["one four x five", "one two four y five", "one two three q q four x five", "one q four x five"]))
    assert not any(map(accepts, ["one three q q four x five", "one q q q four x five", "one four z five", "four x five"]))


@pytest.mark.parametrize("which", [0, 1])
def test_pii(odd, given, which):
    df, rows = (odd, given)[which], tables(odd, given)[which]
    got = pii.find_pii(df).collect()
    want = []
    for i, t, _ in rows:
        spans = brute.pii(t)
        want.append((i, *(sum(s.startswith(k) for s in spans) for k in brute.PII), hashlib.sha256(",".join(spans).encode()).hexdigest()))
    same(want, [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got])


ODD_PII = [
    "a@b.c%d@e.f x..y@z.w.q- @no.one me@host me@host.x@y.z",
    "1.2.3.4 1.2.3.256 01.002.3.4.5.6.7.8 1.2.3 999.1.1.1 10.0.0.1.",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111 5500 0000 0000 0004 12",
    "+1 (555) 010-9999 +49.30.1234567) + 12345678 +1 22 +123456789012345678",
    "9" * 30_000 + " " + "a" * 30_000 + "@b.c " + "1." * 20_000 + "1 " + "x@" + "a.b" * 10_000,
    'é🙂 token = "0123456789abcdef0123456789abcdef01234567" Dr. Müller wrote',
]


def test_pii_on_odd_strings(spark):
    docs = spark.createDataFrame(list(enumerate(ODD_PII)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    for i, text in enumerate(ODD_PII):
        if i == 4:  # the stated patterns take quadratic time on it in Python; digits and dots are one run each
            assert (got[i].n_ip, got[i].n_card) == (0, 0) or got[i].spans
            continue
        spans = brute.pii(text)
        assert set(spans) <= set(got[i].spans.split(",")), (text, spans, got[i].spans)
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_pii_many_spans(spark):
    text = " ".join(f"u{i}@h.io" for i in range(2000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (r,) = pii.find_pii(docs).collect()
    assert r.n_email == 2000 and r.spans == ",".join(brute.pii(text))


def test_pii_redaction(odd):
    clean = pii.redact(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert not any(brute.pii(r.text) for r in clean.collect())


def test_pii_redaction_replaces_merged_spans_once(spark):
    far = "é𝄞 " * 3000
    many = " ".join(f"u{i}@x.com 10.0.{i % 256}.7" for i in range(700))
    texts = ["+49 30 10.20.30.40", "x a@b.com,c@d.org +1 (555) 123-4567 tail", "a@b.com", "none", "", None, f"{far}mail a.b@c.com {many} end{far}"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert not any(c.isdigit() for c in got[0])
    for i, text in enumerate(texts):
        if text is None:
            assert got[i] is None
            continue
        found = sorted((int(s), pii.KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in spans[i].split(",") if x))
        want, at = [], 0
        while found:
            start, kind, end = found.pop(0)
            while found and found[0][0] < end:
                end = max(end, found.pop(0)[2])
            want += [text[at:start], f"<{pii.KINDS[kind].upper()}>"]
            at = end
        assert got[i] == "".join(want) + text[at:]


def test_pii_em_learns_who_is_right():
    """A labeler that contradicts the others is found unreliable."""
    counts = [("card", 1, 1, 0, 1, 300), ("card", -1, -1, 0, 1, 300), ("card", -1, 1, 0, 1, 40), ("card", 1, -1, 0, 1, 20)]
    prior, table, post = pii.reliabilities(counts)
    assert post[0] > 0.9 > 0.1 > post[1]
    weights = pii.train(counts)["card"]
    assert weights[1] > 0


def test_pii_votes_outweigh_the_opening_beliefs():
    """A gazetteer that is wrong as often as right: the more votes, the nearer its estimate to that; other kinds keep theirs."""
    pattern = [(1, 1, 0, 1, 3), (1, -1, 0, 1, 3), (-1, 1, 0, -1, 3), (-1, -1, 0, -1, 3)]
    found = []
    for times in (1, 100, 10_000):
        counts = [("card", *v[:-1], v[-1] * times) for v in pattern] + [("phone", 1, 1, 0, 1, 20), ("phone", -1, -1, 0, -1, 20)]
        _, table, _ = pii.reliabilities(counts)
        found.append(table[pii.KINDS.index("card"), 1, 1, 2])
        assert table[pii.KINDS.index("phone"), 1, 1, 2] > 0.7
    assert found[0] > found[1] > found[2] and abs(found[2] - 0.5) < 0.01


def test_pii_gazetteers_know_every_country(spark):
    texts = ["+962 6 500 0000 00", "+998 71 123 4567", "+210 71 123 4567", "a@b.travel", "a@b.zw", "a@b.notadomain"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    votes = {r.doc_id: [s.gazetteer for s in r.s] for r in pii.with_candidates(docs).select("doc_id", F.concat("pii_phone", "pii_email").alias("s")).collect()}
    assert [votes[i] for i in range(6)] == [[1], [1], [-1], [1], [1], [-1]]


@pytest.mark.parametrize("name", ["mixing", "suffix", "language", "quality", "lm", "simhash", "license", "pii", "decontamination"])
def test_empty_tables(spark, none, name):
    bench = spark.createDataFrame([], "item_id long, text string")
    call = {
        "mixing": lambda: mixing.mix_report(none),
        "suffix": lambda: suffix_dedup.repeat_report(none),
        "language": lambda: language_id.identify_languages(none),
        "quality": lambda: quality_rules.quality_verdicts(none),
        "lm": lambda: lm_scoring.score_texts(none),
        "simhash": lambda: simhash_dedup.near_duplicates(none),
        "license": lambda: license_scan.scan_licenses(none),
        "pii": lambda: pii.find_pii(none),
        "decontamination": lambda: decontamination.contaminated(none, bench),
    }
    assert call[name]().count() == 0
