"""The prefix trie against a plain reading of its contract."""

import hashlib
import random
import zlib

import pytest

from captally.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def own_turns(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, digest(r or "", x or ""), (r or "", x or "")))
    return {c: [v[-1] for v in sorted(turns)] for c, turns in convs.items()}


def plain(rows, rebuild=True):
    convs = own_turns(rows)
    if rebuild:
        lent = {}
        for c in convs:
            h = zlib.crc32(str(c).encode()) % 9
            base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
            lent[c] = convs.get(base, [])[:h] + convs[c][h:]
        convs = lent
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    value = {p: ((0 if p in kids else 1), (len(m) - 1) * len(p[-1][1].encode()) if p else 0) for p, m in members.items()}
    sums = {p: [0, 0] for p in members}
    for p, (leaf, saved) in value.items():
        for d in range(len(p) + 1):
            sums[p[:d]][0] += leaf
            sums[p[:d]][1] += saved
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.add((min(m), len(p), parent, len(m), len(kids.get(p, [])), *sums[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def report(turns, rebuild=True):
    source = prefix_trie.ordered_turns(turns)
    rows = prefix_trie.trie_report(prefix_trie.rebuilt(source) if rebuild else source).collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


def branching(seed, convs, length, words=2):
    """Conversations that share prefixes of every length."""
    r = random.Random(seed)
    rows, paths = [], [[]]
    for c in range(convs):
        path = list(r.choice(paths))
        path = path[: r.randrange(len(path) + 1)]
        while len(path) < r.randrange(1, length + 1):
            path.append(("user" if len(path) % 2 == 0 else "assistant", f"t{r.randrange(words)} é"))
        paths.append(path)
        rows += [(c * 3 - 20, 7 * t, role, text) for t, (role, text) in enumerate(path)]
    r.shuffle(rows)
    return rows


ODD = [
    (0, 1, "user", "a"), (0, None, None, None), (0, None, "", ""), (0, 1, "user", "a"), (0, 1, "user", "b"),  # nulls, ties, repeats
    (1, 0, "user", "a"), (2, 0, "usera", ""), (3, 0, "user", "a\u0000"), (-7, 0, "user", "a"), (-5, 0, "x", "é" * 40_000),
    (None, 0, "user", "a"), (41, 0, "user", "alone, base absent"), (40, 0, "", "\n"), (44, 5, "", "\n"),
]


@pytest.mark.parametrize("rebuild", [True, False])
def test_odd_rows(spark, rebuild):
    df = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 as pos", "2 as shard", "3 as k1", "'x' as digest", "4 as depth").repartition(3)
    assert report(df, rebuild) == plain(ODD, rebuild)


@pytest.mark.parametrize("shard, block, chunk", [(1024, 128, 4096), (4, 3, 2), (1, 1, 1)])
def test_shards_blocks_and_chunks_change_nothing(spark, monkeypatch, shard, block, chunk):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("CHUNK", chunk)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = branching(1, 60, 14)
    assert report(spark.createDataFrame(rows, SCHEMA).repartition(4), False) == plain(rows, False)


def test_long_conversations_over_many_blocks(spark):
    rows = [(1, t, "user", f"long {t}") for t in range(700)] + [(2, t, "user", f"long {t}") for t in range(430)]
    rows += [(3, t, "user", f"long {t}" if t != 300 else "off") for t in range(500)] + [(4, 0, "user", "long 0")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert report(df, False) == plain(rows, False)
    assert report(df) == plain(rows)


def test_copies_over_shards_are_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD", 16)
    rows = [(c, t, "user", "same") for c in range(200) for t in range(2)]
    got = report(spark.createDataFrame(rows, SCHEMA), False)
    assert got == plain(rows, False)
    assert {r[3] for r in got} == {200}


def test_unit_work_is_bounded_by_shard_and_block(spark):
    rows = [(c, t, "user", "same") for c in range(1500) for t in range(3)] + [(9999, t, "user", f"x{t}") for t in range(1000)]
    source = prefix_trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    most = prefix_trie._units(source).groupBy("shard", "block").count().agg({"count": "max"}).first()[0]
    assert most <= prefix_trie.SHARD * (prefix_trie.BLOCK + 1) and most == 1024 * 4


def test_no_rows(spark):
    assert report(spark.createDataFrame([], SCHEMA)) == set()
    assert report(spark.createDataFrame([(None, 0, "user", "a")], SCHEMA)) == set()
