"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt by id into shards of ``SHARD`` and their turns into
blocks of ``BLOCK`` positions; one (shard, block) is one unit of work of at most
SHARD * BLOCK turns, so neither a long conversation nor a prefix that all
share makes a large one.  In a unit every (position, turn) has a bitset of the
conversations that hold it.  A depth-first walk intersects the bitset of a
parent with the postings of the next position: each result is a child, its
popcount the number of conversations, and those that end there are its end
list.  A conversation that is alone in its shard from some depth on needs no
postings: its further nodes are a chain.

A node is named by 128 bits, the xor of the hashes of its (position, turn)
pairs (the odds that two of 10^13 nodes share a name are below 10^-12), so blocks start from
the xor of the turns before them and the shards' parts of a node meet by an
ordinary aggregation.  Every node belongs to its smallest member and the nodes
of one owner are a chain of one conversation.  Sums over a subtree are the
rest of the owner's chain plus the totals of the chains that branch off below,
and those reach their ancestors through the members' postings: no recursion
over depth and no path is ever gathered.

Defined results: turns are ordered by ``turn`` (null first), ties by the
SHA-256 of length-prefixed role and text, and repeated rows are turns of their
own; null role or text is empty; rows with a null conv_id name no
conversation and are left out; a table without conversations has no nodes, not
even the root.  Other columns are ignored, whatever their names.  Texts of any
length pass as hash and length only.  One node's end list may hold any number
of ids: it is a row per shard, and its digest is taken over them as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.operators.materialize import cut
from captally.operators.ordinals import ordinals
from captally.operators.skew import skew_join

SHARD = 1024
BLOCK = 128
#: Rows of one conversation that a window takes at a time; their totals are summed in a second one.
CHUNK = 4096
NODE = ["k1", "k2", "depth"]


class Turns(NamedTuple):
    """Ordered conversations."""

    turns: DataFrame  # conv_id, pos (dense from 0), digest, n_bytes
    convs: DataFrame  # conv_id, n_turns (may be 0)


class Trie(NamedTuple):
    """Nodes (k1, k2, depth) and their end lists."""

    nodes: DataFrame  # k1, k2, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    ends: DataFrame  # k1, k2, depth, shard, conv_ids: conversations that end at the node, ascending by (shard, place)


def ordered_turns(conversations: DataFrame) -> Turns:
    """Dense positions of (conv_id, turn, role, text) rows; a long conversation is dealt over many tasks."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    numbered = ordinals(rows, ["conv_id", "turn", "digest"]).drop("turn")
    convs = cut(numbered.groupBy("conv_id").agg(F.min("ordinal").alias("start"), F.count(F.lit(1)).alias("n_turns")), "trie-convs")
    placed = skew_join(numbered, convs.select("conv_id", "start"), ["conv_id"])
    return Turns(placed.select("conv_id", (F.col("ordinal") - F.col("start")).alias("pos"), "digest", "n_bytes"), convs.select("conv_id", "n_turns"))


def rebuilt(source: Turns, group: int = 5, modulus: int = 9) -> Turns:
    """Every conversation c as the first h turns of c - c % ``group``, then its own after its first h.

    h is the unsigned CRC-32 of c's decimal digits modulo ``modulus``.
    """
    c = source.convs.withColumns(
        {"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus, "base": F.col("conv_id") - F.col("conv_id") % group}
    )
    base = source.convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    c = c.join(base, "base", "left").withColumn("lent", F.least("h", F.coalesce("n_base", F.lit(0))))
    c = cut(c.withColumn("total", F.col("lent") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))), "trie-rebuilt")
    own = skew_join(source.turns, c.select("conv_id", "h", "lent"), ["conv_id"]).where(F.col("pos") >= F.col("h"))
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "digest", "n_bytes")
    lent = source.turns.where(F.col("pos") < modulus - 1).withColumnRenamed("conv_id", "base")
    lent = lent.join(c.select("conv_id", "base", "lent"), "base").where(F.col("pos") < F.col("lent"))
    turns = own.unionByName(lent.select("conv_id", "pos", "digest", "n_bytes"))
    return Turns(turns, c.select("conv_id", F.col("total").alias("n_turns")))


def before(df: DataFrame, key: str, place: str, columns: list[str], combine: Callable, zero, merge: Callable, reverse: bool = False) -> DataFrame:
    """``df`` with ``columns`` combined over the rows of ``key`` before each row in the order of ``place`` (after it: ``reverse``).

    Rows are combined by chunks of CHUNK places and the chunks' totals in a
    second window, so a key of any size is many small groups.
    """
    order = F.desc if reverse else F.asc
    past = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    chunked = df.withColumn("_chunk", F.floor(F.col(place) / CHUNK))
    inner = past(Window.partitionBy(key, "_chunk").orderBy(order(place)))
    outer = past(Window.partitionBy(key).orderBy(order("_chunk")))
    totals = chunked.groupBy(key, "_chunk").agg(*(combine(c).alias(c) for c in columns))
    totals = totals.select(key, "_chunk", *(combine(c).over(outer).alias(f"_far_{c}") for c in columns))
    near = chunked.withColumns({f"_near_{c}": combine(c).over(inner) for c in columns}).join(totals, [key, "_chunk"])
    both = {f"{c}_before": merge(F.coalesce(f"_near_{c}", zero), F.coalesce(f"_far_{c}", zero)) for c in columns}
    return near.withColumns(both).drop("_chunk", *(f"_{w}_{c}" for w in ("near", "far") for c in columns))


# ---------------------------------------------------------------- one unit

UNIT = ["shard", "block", "local", "conv_id", "n_turns", "pos", "t1", "t2", "z1", "z2", "n_bytes"]
PARTS = T.StructType(
    [
        *(T.StructField(c, T.LongType()) for c in ("k1", "k2", "depth", "p1", "p2", "conv_id", "n_convs", "n_bytes", "shard")),
        T.StructField("members", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
    ]
)


def bit_places(bits: int) -> np.ndarray:
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def postings(local: np.ndarray, pos: np.ndarray, t1: np.ndarray, t2: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(posting of each row, -1 if its turn is nowhere else at its position; bitsets): the (position, turn) index."""
    order = np.lexsort((local, t2, t1, pos))
    same = np.zeros(len(order), bool)
    for x in (pos, t1, t2):
        s = x[order]
        same[1:] |= s[1:] != s[:-1]
    group = np.cumsum(same)
    size = np.bincount(group)
    shared = np.flatnonzero((size > 1))
    number = np.full(len(size), -1)
    number[shared] = np.arange(len(shared))
    of_row = np.empty(len(order), np.int64)
    of_row[order] = number[group]
    first = np.cumsum(size) - size
    bitsets = []
    for g in shared.tolist():
        bits = 0
        for x in local[order[first[g] : first[g] + size[g]]].tolist():
            bits |= 1 << x
        bitsets.append(bits)
    return of_row, bitsets


def walk(block: int, local: np.ndarray, pos: np.ndarray, key1: np.ndarray, key2: np.ndarray, of_row: np.ndarray, bitsets: list[int]):
    """Depth-first walk of a unit: (row of a node's last turn, its bitset), parents before children.

    Rows are sorted by (conversation, position); the first row of each
    conversation (position -1) stands for the prefix before the block.
    """
    heads = np.flatnonzero(pos < 0)
    ends = np.append(heads[1:], len(pos))
    head = dict(zip(local[heads].tolist(), heads.tolist()))
    end = dict(zip(local[heads].tolist(), ends.tolist()))
    groups: dict = {}
    for x, a, b in zip(local[heads].tolist(), key1[heads].tolist(), key2[heads].tolist()):
        groups[(a, b)] = groups.get((a, b), 0) | 1 << x
    if block == 0:
        for bits in groups.values():
            yield head[(bits & -bits).bit_length() - 1], bits
    numbers = of_row.tolist()
    stack = [(bits, 1) for bits in groups.values()]
    while stack:
        rest, step = stack.pop()
        while rest:
            low = (rest & -rest).bit_length() - 1
            row = head[low] + step
            if row >= end[low]:
                rest ^= 1 << low
                continue
            posting = numbers[row]
            child = rest & bitsets[posting] if posting >= 0 else 1 << low
            if child & (child - 1):
                yield row, child
                stack.append((child, step + 1))
            else:
                for r in range(row, end[low]):
                    yield r, child
            rest &= ~child


def unit_nodes(rows: pa.Table) -> pa.Table:
    """The nodes of one (shard, block), with members and end lists."""
    at = {c: rows[c].to_numpy() for c in UNIT}
    order = np.lexsort((at["pos"], at["local"]))
    at = {c: v[order] for c, v in at.items()}
    shard, block = int(at["shard"][0]), int(at["block"][0])
    local, pos = at["local"], at["pos"]
    heads = np.flatnonzero(pos < 0)
    spread = np.diff(np.append(heads, len(pos)))
    keys = []
    for z in (at["z1"], at["z2"]):
        run = np.bitwise_xor.accumulate(z)
        start = np.where(heads > 0, run[heads - 1], 0)
        keys.append(run ^ np.repeat(start, spread))
    of_row, bitsets = postings(local, pos, at["t1"], at["t2"])
    conv_of = np.zeros(int(local.max()) + 1, np.int64)
    conv_of[local] = at["conv_id"]
    depth = block * BLOCK + pos + 1
    ending: dict = {}
    for x, n in zip(local[heads].tolist(), at["n_turns"][heads].tolist()):
        ending[n] = ending.get(n, 0) | 1 << x
    found, members, ends = [], [], []
    for row, bits in walk(block, local, pos, *keys, of_row, bitsets):
        found.append(row)
        members.append(conv_of[bit_places(bits)])
        ends.append(conv_of[bit_places(bits & ending.get(int(depth[row]), 0))])
    found = np.array(found, np.int64)
    parent = np.maximum(found - 1, 0)
    columns = [keys[0][found], keys[1][found], depth[found], keys[0][parent], keys[1][parent], at["conv_id"][found]]
    columns += [np.array([len(m) for m in members], np.int64), at["n_bytes"][found], np.full(len(found), shard)]
    lists = [pa.ListArray.from_arrays(np.append(0, np.cumsum([len(x) for x in xs])).astype(np.int32), np.concatenate(xs) if xs else np.zeros(0, np.int64)) for xs in (members, ends)]
    return pa.Table.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), *lists], names=PARTS.names)


# ---------------------------------------------------------------- the trie


def _units(source: Turns) -> DataFrame:
    """Turns with shard, block and hashes, and one row before each conversation's block."""
    ranked = ordinals(source.convs, ["conv_id"], "rank").select(
        "conv_id", "n_turns", F.floor(F.col("rank") / SHARD).alias("shard"), (F.col("rank") % SHARD).alias("local")
    )
    turns = skew_join(source.turns, ranked, ["conv_id"])
    hashed = {"t1": F.xxhash64("digest"), "t2": F.xxhash64(F.lit(1), "digest"), "z1": F.xxhash64("pos", "digest"), "z2": F.xxhash64("digest", "pos")}
    turns = turns.withColumns(hashed).withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumn("pos", F.col("pos") % BLOCK)
    turns = cut(turns.select(*UNIT), "trie-turns")
    one = ["conv_id", "shard", "local", "n_turns"]
    blocks = turns.groupBy(*one, "block").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    starts = before(blocks, "conv_id", "block", ["z1", "z2"], F.bit_xor, F.lit(0), lambda a, b: a.bitwiseXOR(b))
    starts = starts.select(*one, "block", F.col("z1_before").alias("z1"), F.col("z2_before").alias("z2"))
    zero = F.lit(0).cast("long")
    turnless = ranked.where("n_turns = 0").select(*one, zero.alias("block"), zero.alias("z1"), zero.alias("z2"))
    none = {"pos": F.lit(-1).cast("long"), "t1": zero, "t2": zero, "n_bytes": zero}
    return turns.unionByName(starts.unionByName(turnless).withColumns(none).select(*UNIT))


def prefix_trie(source: Turns) -> Trie:
    """The trie of ordered conversations, see the module docstring."""
    parts = cut(_units(source).groupBy("shard", "block").applyInArrow(unit_nodes, PARTS), "trie-parts")
    nodes = parts.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2")
    )
    nodes = cut(nodes, "trie-merged")
    below = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(below.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left").fillna(0, ["n_children"])
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("n_bytes")})
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("first_depth"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    # A chain's total reaches the nodes that its conversation shares above it.
    shared = parts.select(*NODE, F.explode("members").alias("conv_id"))
    shared = skew_join(shared, chains, ["conv_id"]).where(F.col("depth") < F.col("first_depth"))
    shared = shared.groupBy(*NODE).agg(F.sum("leaf").alias("leaf_off"), F.sum("saved").alias("saved_off"))
    whole = before(nodes, "conv_id", "depth", ["leaf", "saved"], F.sum, F.lit(0), lambda a, b: a + b, reverse=True)
    whole = whole.join(shared, NODE, "left")
    total = lambda c: F.col(c) + F.col(f"{c}_before") + F.coalesce(f"{c}_off", F.lit(0))
    whole = whole.select(*NODE, "p1", "p2", "conv_id", "n_convs", "n_children", total("leaf").alias("n_leaves"), total("saved").alias("saved_tokens"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    whole = cut(whole, "trie-nodes")
    placed = skew_join(whole, parents, ["p1", "p2", "depth"], "left").drop("p1", "p2")
    return Trie(placed, parts.where(F.size("ends") > 0).select(*NODE, "shard", F.col("ends").alias("conv_ids")))


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of every node with an end list: ids in order, comma-joined.

    Lists of a node come to one task in shard order and pass as a stream, a
    list at a time; SHA-256 allows no other way.
    """
    schema = T.StructType([*(ends.schema[c] for c in NODE), T.StructField("ends_sha256", T.StringType())])
    texts = ends.select(*NODE, "shard", F.array_join("conv_ids", ",").alias("ids"))

    def run(batches):
        now, digest = None, None
        for b in batches:
            out = []
            for key, ids in zip(zip(*(b.column(i).to_pylist() for i in range(3))), b.column(4).to_pylist()):
                if key == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*now, digest.hexdigest())))], schema=arrow)

    arrow = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "shard").mapInArrow(run, schema)


def trie_report(source: Turns) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node."""
    trie = prefix_trie(source)
    none: Column = F.lit(hashlib.sha256(b"").hexdigest())
    got = trie.nodes.join(end_digests(trie.ends), NODE, "left")
    return got.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
