"""Chat formatting against a plain reading: prefixes go, equal ones keep the smallest id."""

import pytest

from captally.llm import chat_format
from captally.llm.queries import ORACLES


def plain(rows):
    convs = {}
    for c, t, r, x in set((c, t, r or "", x or "") for c, t, r, x in rows):
        convs.setdefault(c, []).append((t, r, x))
    for turns in convs.values():
        turns.sort(key=lambda v: (v[0] is not None, v[0] if v[0] is not None else 0, v[1], v[2]))
    seqs = {c: [v[1:] for v in turns] for c, turns in convs.items()}
    order = lambda c: (c is None, c if c is not None else 0)
    out = set()
    for c, s in seqs.items():
        if any(d != c and o[: len(s)] == s and (len(o) > len(s) or order(d) < order(c)) for d, o in seqs.items()):
            continue
        for pos, (turn, role, text) in enumerate(convs[c], 1):
            out.add((c, pos, len(s), turn, f"<|im_start|>{role}\n{text}<|im_end|>\n"))
    return out


ROWS = (
    [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(3)]
    + [(2, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(5)]  # 1 is its prefix
    + [(3, 10 * t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(5)]  # equal to 2
    + [(4, 0, "user", "t0"), (4, 1, "assistant", "other")]
    + [(5, 0, None, None), (5, 0, "a", "x"), (5, 0, "a", "w"), (5, 0, "a", "w")]  # ties, nulls, repeated rows
    + [(None, 0, "user", "t0"), (6, None, "user", "n"), (6, -5, "user", "m")]
    + [(7, t, "user", f"long {t}") for t in range(0, 3000, 3)]
    + [(8, t, "user", f"long {3 * t}") for t in range(700)]  # a prefix of 7 across chunks
    + [(9, 0, "user", "y" * 200_000)]
)


def test_prefixes_collapse(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as pos", "2 as chunk", "3 as lane0")
    got = {(r.conv_id, r.pos, r.n_turns, r.turn, r.rendered) for r in chat_format.chat_format(turns).collect()}
    assert got == plain(ROWS)
    assert {c for c, *_ in got} == {2, 4, 5, 6, 7, 9}


def test_empty(spark):
    assert chat_format.chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("snapshots", [False, True])
def test_oracle(spark, snapshots):
    import duckdb

    path = "/root/testdata/sf0.001/conversations.parquet"
    turns = spark.read.parquet(path)
    con = duckdb.connect()
    con.sql(f"create table conversations as select * from '{path}'")
    if snapshots:  # every conversation is logged again, cut after its second turn
        turns = turns.unionByName(turns.where("turn < 2").selectExpr("conv_id + 1000 as conv_id", "turn", "role", "text"))
        con.sql("insert into conversations select conv_id + 1000, turn, role, text from conversations where turn < 2")
    cols = ["conv_id", "pos", "n_turns", "turn", "rendered"]
    want = {tuple(r) for r in con.sql(ORACLES["op5_chat_format"]).df()[cols].itertuples(index=False)}
    assert {tuple(r) for r in chat_format.chat_format(turns).select(cols).collect()} == want
