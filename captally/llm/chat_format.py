"""Chat formatting: collapse cumulative snapshots, then render.

Logged conversations often come as snapshots that each repeat the turns so
far.  Every turn gets the rolling hash of its conversation's turns up to and
including it; a conversation whose last hash and length occur inside a longer
conversation is a prefix of it and is removed by an anti-join.  Of equal
conversations the one with the smallest conv_id stays.  What is left is
rendered turn by turn with a chat template.

The rolling hash of a prefix is the sum of the hashes of its (position, role,
text) triples, as four 32-bit lanes, so it is a running sum: within chunks of
``CHUNK_TURNS`` turn numbers, then over the chunks of a conversation.  Only
hashes and lengths move through the joins that look for prefixes, and a
conversation is never gathered into one row or one task.

Defined results: null roles and texts count as empty ones; null
conv_ids form one conversation, null turns come first; turns with one number
are ordered by role and text; repeated rows count once; empty tables give an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captally.operators.materialize import cut

CHUNK_TURNS = 256
LANES = 4

# The chat template.
TURN_HEAD = "<|im_start|>"
TURN_END = "<|im_end|>\n"


def _chunk() -> Column:
    return F.floor(F.coalesce(F.col("turn"), F.lit(-(1 << 62))) / CHUNK_TURNS).cast("long")


def _turn_hash() -> list[Column]:
    """Four 32-bit lanes of two hashes of (position, role, text)."""
    parts = [F.col("pos"), F.col("content_a"), F.col("content_b")]
    out = []
    for seed in range(LANES // 2):
        h = F.xxhash64(F.lit(seed), *parts)
        out += [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]
    return out


def _running(rows: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """Adds running sums (row included) of ``values`` over each conversation, in two steps."""
    rows = rows.select("*", *(v.alias(f"own_{k}") for k, v in values.items()))
    chunks = rows.groupBy("conv_id", "chunk").agg(*(F.sum(f"own_{k}").alias(f"sum_{k}") for k in values))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "chunk", *(F.coalesce(F.sum(f"sum_{k}").over(before), F.lit(0)).alias(f"before_{k}") for k in values))
    inside = Window.partitionBy("conv_id", "chunk").orderBy(*order)
    rows = rows.select("*", *(F.sum(f"own_{k}").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"upto_{k}") for k in values))
    on = F.col("r.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("r.chunk") == F.col("c.chunk"))
    keep = [c for c in rows.columns if not c.startswith(("own_", "upto_"))]
    joined = rows.alias("r").join(chunks.alias("c"), on)
    return joined.select(*(f"r.{c}" for c in keep), *((F.col(f"upto_{k}") + F.col(f"before_{k}")).alias(k) for k in values))


def _plain(turns: DataFrame) -> DataFrame:
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumns({"content_a": F.xxhash64(F.lit(11), "role", "text"), "content_b": F.xxhash64(F.lit(12), "role", "text")})


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, turn, pos, content hashes, lanes): position and rolling hash of every distinct turn."""
    rows = _plain(turns).withColumn("chunk", _chunk())
    rows = rows.groupBy("conv_id", "chunk", "turn", "role", "content_a", "content_b").agg(F.min("text").alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = _running(rows, order, {"pos": F.lit(1).cast("long")}).drop("text", "role")
    lanes = {f"lane{i}": h for i, h in enumerate(_turn_hash())}
    return _running(rows, [F.col("pos")], lanes)


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of conversations that no other contains as a prefix; ``hashed`` should be a written table."""
    key = ["pos", *(f"lane{i}" for i in range(LANES))]
    sizes = hashed.groupBy("conv_id").agg(F.max(F.struct(*key)).alias("last"))
    whole = sizes.select("conv_id", "last.*")
    one_each = whole.groupBy(*key).agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id"))["conv_id"].alias("conv_id"))
    lengths = whole.select("conv_id", F.col("pos").alias("n_turns"))
    inner = hashed.alias("h").join(lengths.alias("s"), F.col("h.conv_id").eqNullSafe(F.col("s.conv_id")))
    inner = inner.where(F.col("h.pos") < F.col("s.n_turns")).select(*(f"h.{k}" for k in key)).distinct()
    return one_each.join(inner, key, "left_anti").select("conv_id", F.col("pos").alias("n_turns"))


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN_HEAD), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(TURN_END))


def chat_format(turns: DataFrame) -> DataFrame:
    """conv_id, pos, n_turns, turn, rendered: the turns of the conversations that stay, in template form.

    A conversation's training text is its ``rendered`` values in order of
    ``pos``; they stay rows because a conversation may be of any length.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    hashed = cut(prefix_hashes(turns), "chat-hashes")
    kept = cut(maximal_conversations(hashed), "chat-kept")
    texts = _plain(turns).distinct()
    same = F.col("k.conv_id").eqNullSafe(F.col("t.conv_id"))
    texts = texts.alias("t").join(kept.alias("k"), same).select("t.*", "k.n_turns")
    at = hashed.select("conv_id", "turn", "content_a", "content_b", "pos")
    on = F.col("t.conv_id").eqNullSafe(F.col("a.conv_id")) & F.col("t.turn").eqNullSafe(F.col("a.turn"))
    on = on & (F.col("t.content_a") == F.col("a.content_a")) & (F.col("t.content_b") == F.col("a.content_b"))
    return (
        texts.alias("t")
        .join(at.alias("a"), on)
        .select("t.conv_id", "a.pos", "t.n_turns", "t.turn", render_turn(F.col("t.role"), F.col("t.text")).alias("rendered"))
    )
