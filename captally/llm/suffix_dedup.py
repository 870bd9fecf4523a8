"""Suffix-array dedup: removes every byte covered by a repeated 200-byte string.

Sorting all suffixes of a corpus is hopeless, and needless: strings that
repeat share *anchors*.  An anchor is a position whose ``GRAM``-byte string has
the least hash in some run of ``LENGTH - GRAM + 1`` neighbours, all inside one
text; every 200-byte string contains the anchor of its own run, at the same
place in each of its occurrences.  So it is enough to sort the suffixes, and
the reversed prefixes, that start at anchors with the same gram:

1. One pass over the texts takes about 1.2 % of the positions as anchors, with
   the hash of the text around each (the bytes any 200-byte string through
   the anchor can reach).  Grams that occur once are dropped.
2. Equal surroundings are one entry of the suffix array, with a weight.  An
   entry of weight two or more repeats whole.
3. Grams with several different surroundings are sorted deep-shallow:
   multikey quicksort, eight bytes at a time, to ``SHALLOW`` bytes, then a
   blind trie for each group that still agrees.  From the common-prefix
   lengths of suffixes and reversed prefixes follows, for every offset of a
   200-byte string around the anchor, which entries share it.
4. Covered ranges are united per text and cut out.

Scale: nothing is sorted as a whole; a task holds complete gram groups of at
most ``GROUP_ROWS`` entries.  A larger group is salted; strings that no
sub-group could settle are counted across sub-groups by hash.  Copies are
counted map-side.  Texts move twice: to fetch surroundings and to be cut.

Defined results: null and empty texts have no bytes, nothing removed and the
digest of no bytes; texts under 200 bytes lose nothing; repeated rows repeat
each other's strings; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.llm.text_batches import SpanHasher, map_texts, mix64
from captally.operators.materialize import cut

LENGTH = 200
GRAM = 40
SHALLOW = 64
GROUP_ROWS = 100_000
#: Entries sorted together (whole groups).
BATCH_ROWS = 1 << 14
#: Text handled at a time in the anchor pass, which keeps some 100 bytes for each of its bytes.
ANCHOR_CHUNK = 1 << 20


def sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every run of ``width`` values (doubling, so log2(width) passes)."""
    size = 1
    while size * 2 <= width:
        a = op(a[:-size], a[size:])
        size *= 2
    return op(a[: len(a) - (width - size)], a[width - size :]) if size < width else a


def anchor_positions(hasher: SpanHasher, data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of the anchors of all texts in the batch; ``hasher`` has the batch loaded."""
    n, run = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - gram + 1)
    h = np.maximum(hasher.spans(at, at + gram), np.uint64(1))
    least = sliding(h, run, np.minimum)
    inside = np.zeros(n + 1, np.int64)
    sizes = np.diff(offsets)
    whole = np.flatnonzero(sizes >= length)
    np.add.at(inside, offsets[whole], 1)
    np.add.at(inside, offsets[whole] + sizes[whole] - length + 1, -1)
    least[np.cumsum(inside)[: len(least)] == 0] = 0
    padded = np.zeros(len(h) + run - 1, np.uint64)
    padded[run - 1 : run - 1 + len(least)] = least
    pos = np.flatnonzero(sliding(padded, run, np.maximum) == h)
    return pos, h[pos]


ANCHOR_FIELDS = [T.StructField(c, T.ArrayType(T.LongType()), False) for c in ("grams", "around", "places")]


def _anchors(length: int, gram: int):
    def make():
        hasher = SpanHasher()
        reach = length - gram

        def anchors(data, offsets):
            hasher.load(data)
            pos, h = anchor_positions(hasher, data, offsets, length, gram)
            row = np.searchsorted(offsets, pos, side="right") - 1
            begin, end = offsets[row], offsets[row + 1]
            lo, hi = np.maximum(pos - reach, begin), np.minimum(pos + length, end)
            around = hasher.spans(lo, hi) ^ mix64((pos - lo).astype(np.uint64) + np.uint64(1))
            ends = pa.array(np.searchsorted(pos, offsets).astype(np.int32))
            return [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (h.view(np.int64), around.view(np.int64), pos - begin)]

        return anchors

    return make


class _Leaf:
    __slots__ = ("text", "rows")

    def __init__(self, text: bytes, row: int) -> None:
        self.text, self.rows = text, [row]


class _Branch:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int) -> None:
        self.depth, self.kids = depth, {}


def blind_trie_order(texts: list[bytes], rows: list[int]) -> tuple[list[int], list[int]]:
    """Rows in order of their equally long texts, and the common prefix of each with the one before it (first: -1).

    The trie stores branching depths and bytes only; a text goes down blindly
    to some leaf, and one comparison with that leaf tells where it belongs.
    """
    size = len(texts[0])
    root = _Leaf(texts[0], rows[0])
    for text, row in zip(texts[1:], rows[1:], strict=True):
        node = root
        while node.__class__ is _Branch:
            kid = node.kids.get(text[node.depth])
            node = kid if kid is not None else next(iter(node.kids.values()))
        if node.text == text:
            node.rows.append(row)
            continue
        differ = int.from_bytes(node.text) ^ int.from_bytes(text)
        common = size - (differ.bit_length() + 7) // 8
        other, parent, node = node.text, None, root
        while node.__class__ is _Branch and node.depth < common:
            parent, node = node, node.kids[text[node.depth]]
        leaf = _Leaf(text, row)
        if node.__class__ is _Branch and node.depth == common:
            node.kids[text[common]] = leaf
            continue
        branch = _Branch(common)
        branch.kids[other[common]], branch.kids[text[common]] = node, leaf
        if parent is None:
            root = branch
        else:
            parent.kids[text[parent.depth]] = branch
    order, shared = [], []
    stack = [(root, -1)]
    while stack:
        node, before = stack.pop()
        if node.__class__ is _Leaf:
            order += node.rows
            shared += [before] + [size] * (len(node.rows) - 1)
        else:
            keys = sorted(node.kids, reverse=True)
            stack += [(node.kids[k], node.depth) for k in keys[:-1]]
            stack.append((node.kids[keys[-1]], before))
    return order, shared


def deep_shallow(texts: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the rows of a byte matrix inside their (adjacent) groups.

    Returns the order and, per place in it, the common prefix with the row
    before; -1 at the first row of a group.
    """
    m, size = texts.shape
    wide = -(-size // 8) * 8
    padded = np.zeros((m, wide), np.uint8)
    padded[:, :size] = texts
    units = np.ascontiguousarray(padded).view(">u8").astype(np.uint64)
    order, segment = np.arange(m), group.copy()
    shared = np.full(m, size, np.int64)
    shared[np.flatnonzero(np.diff(group, prepend=group[0] - 1))] = -1

    def tied(seg):
        same = np.zeros(len(seg) + 1, bool)
        same[1:-1] = seg[1:] == seg[:-1]
        return same[1:] | same[:-1]

    # Multikey quicksort on eight bytes at a time; only ties go on.
    places = np.flatnonzero(tied(segment))
    for d in range(min(shallow, wide) // 8):
        if not len(places):
            break
        rows, seg = order[places], segment[places]
        key = units[rows, d]
        by = np.lexsort((key, seg))
        rows, key = rows[by], key[by]
        order[places] = rows
        split = np.flatnonzero((key[1:] != key[:-1]) & (seg[1:] == seg[:-1])) + 1
        differ = key[split] ^ key[split - 1]
        zeros = np.zeros(len(split), np.int64)
        for byte in range(7, 0, -1):  # leading equal bytes
            zeros += differ >> np.uint64(8 * byte) == 0
        shared[places[split]] = np.minimum(8 * d + zeros, size)
        new = np.zeros(len(seg), bool)
        new[0] = True
        new[1:] = seg[1:] != seg[:-1]
        new[split] = True
        segment[places] = np.cumsum(new) + m * (d + 1)
        places = places[tied(np.cumsum(new))]

    # Blind tries for the groups that agree so far.
    if len(places) and shallow < size:
        seg = segment[places]
        cuts = np.append(np.flatnonzero(np.diff(seg, prepend=-1)), len(seg))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            where = places[lo:hi]
            rows = order[where]
            sorted_rows, common = blind_trie_order([texts[r].tobytes() for r in rows], rows.tolist())
            order[where] = sorted_rows
            shared[where[1:]] = common[1:]
    return order, shared


def shared_windows(left, left_size, right, right_size, group, weight, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per (bytes before the anchor, entry): whether that 200-byte string repeats, and its class.

    ``left`` holds the bytes before each anchor, nearest first, ``right`` those
    from it on.  Entries of weight two or more repeat by themselves.
    """
    m, reach = len(group), length - gram
    by_right, right_shared = deep_shallow(right, group)
    by_left, left_shared = deep_shallow(left, group)
    repeated = np.zeros((reach + 1, m), bool)
    classes = np.full((reach + 1, m), -1, np.int32)
    right_id, left_id = np.empty(m, np.int64), np.empty(m, np.int64)
    for before in range(reach + 1):
        fits = np.flatnonzero((left_size >= before) & (right_size >= length - before))
        if not len(fits):
            continue
        right_id[by_right] = np.cumsum(right_shared < length - before)
        left_id[by_left] = np.cumsum(left_shared < before)
        _, cls, n = np.unique(right_id[fits] * (m + 1) + left_id[fits], return_inverse=True, return_counts=True)
        total = np.bincount(cls, weights=np.minimum(weight[fits], 2))
        repeated[before, fits] = total[cls] > 1
        classes[before, fits] = cls
    return repeated, classes


SORTED_SCHEMA = "rid long, start long, end long, gram long, before int, window long"


def _sort_entries(length: int, gram: int):
    """Arrow batches of entries (sorted by unit) to covered ranges, and for salted units to open windows."""
    reach = length - gram

    def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in column], np.int64)
        out = np.zeros((len(column), width), np.uint8)
        out[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(column), np.uint8)
        return out, size

    def work(rows: dict[str, list]) -> pa.RecordBatch:
        unit, weight = np.array(rows["unit"]), np.array(rows["weight"])
        rid, pos, parts, grams = (np.array(rows[c]) for c in ("rid", "pos", "parts", "gram"))
        group = np.cumsum(np.diff(unit, prepend=unit[0] - 1) != 0)
        right, right_size = matrix(rows["right"], length)
        left, left_size = matrix([x[::-1] for x in rows["left"]], reach)
        repeated, classes = shared_windows(left, left_size, right, right_size, group, weight, length, gram)
        # Runs of consecutive offsets are one covered range; whole entries are reported by their weight.
        runs = np.zeros((reach + 3, len(unit)), np.int8)
        runs[1:-1] = repeated & (weight < 2)
        edge = np.diff(runs, axis=0)
        first, entry = np.nonzero(edge.T == 1)[::-1]
        last = np.nonzero(edge.T == -1)[1] - 1
        start, end = pos[entry] - last, pos[entry] - first + length
        out = [rid[entry], start, end, grams[entry], np.full(len(entry), -1), np.zeros(len(entry), np.int64)]
        columns = [pa.array(x) for x in out]
        # Units of salted groups: windows not settled here, and one of each class that is.
        open_rows = np.flatnonzero(parts > 1)
        if len(open_rows):
            hasher = SpanHasher()
            texts = [rows["left"][i] + rows["right"][i] for i in open_rows]
            ends = np.cumsum([len(t) for t in texts])
            begins = ends - [len(t) for t in texts]
            hasher.load(np.frombuffer(b"".join(texts), np.uint8))
            more = [[], [], [], [], [], []]
            for before in range(reach + 1):
                fits = classes[before, open_rows] >= 0
                who = open_rows[fits]
                lone = ~repeated[before, who]
                head = np.zeros(len(who), bool)
                head[np.unique(classes[before, who], return_index=True)[1]] = True
                send = lone | head
                at = begins[fits][send] + left_size[who[send]] - before
                more[0].append(np.where(lone[send], rid[who[send]], -1))
                more[1].append(pos[who[send]] - before)
                more[2].append(pos[who[send]] - before + length)
                more[3].append(grams[who[send]])
                more[4].append(np.full(send.sum(), before))
                more[5].append(hasher.spans(at, at + length).view(np.int64))
            columns = [pa.concat_arrays([c, pa.array(np.concatenate(x))]) for c, x in zip(columns, more, strict=True)]
        columns[4] = columns[4].cast(pa.int32())
        return pa.RecordBatch.from_arrays(columns, names=["rid", "start", "end", "gram", "before", "window"])

    def run(batches):
        held: dict[str, list] = {}
        for b in batches:
            unit, rid, pos = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("unit", "rid", "pos"))
            # Repeated rows of the documents fetch an entry more than once.
            new = np.ones(len(unit), bool)
            new[1:] = (unit[1:] != unit[:-1]) | (rid[1:] != rid[:-1]) | (pos[1:] != pos[:-1])
            if held and len(unit) and (held["unit"][-1], held["rid"][-1], held["pos"][-1]) == (unit[0], rid[0], pos[0]):
                new[0] = False
            for name, column in zip(b.schema.names, b.filter(pa.array(new)).columns, strict=True):
                held.setdefault(name, []).extend(column.to_pylist())
            units = held["unit"]
            if len(units) >= BATCH_ROWS and units[0] != units[-1]:
                last = len(units) - 1
                while units[last - 1] == units[-1]:
                    last -= 1
                yield work({k: v[:last] for k, v in held.items()})
                held = {k: v[last:] for k, v in held.items()}
        if held.get("unit"):
            yield work(held)

    return run


def _small(batches, rows: int = 1024):
    """Batches of at most ``rows`` texts: what a step holds besides follows them."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def _surroundings(length: int, gram: int):
    """Joined texts and their entries to one row per entry with the bytes before and from the anchor."""
    reach = length - gram

    def run(batches):
        for b in _small(batches):
            texts, entries = b.column(0), b.column(1)
            out: dict[str, list] = {c: [] for c in ("gram", "unit", "parts", "weight", "rid", "pos", "left", "right")}
            for text, mine in zip(texts, entries, strict=True):
                data = text.as_buffer()
                for e in mine.as_py():
                    p = e["pos"]
                    for c in ("gram", "unit", "parts", "weight", "rid", "pos"):
                        out[c].append(e[c])
                    out["left"].append(data[max(0, p - reach) : p].to_pybytes())
                    out["right"].append(data[p : p + length].to_pybytes())
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    return run


ENTRY_SCHEMA = "gram long, unit long, parts int, weight long, rid long, pos long, left binary, right binary"


def covered_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(k1, k2, ranges): byte ranges [start, end) covered by repeated strings, per text that has any.

    ``docs`` has the text's key in k1 and k2.
    """
    reach = length - gram
    rows = docs.where(F.octet_length("text") >= length).withColumn("n_bytes", F.octet_length("text").cast("long"))
    anchored = map_texts(rows, "text", ["k1", "k2", "n_bytes"], ANCHOR_FIELDS, _anchors(length, gram), ANCHOR_CHUNK)
    anchored = cut(anchored.withColumn("rid", F.monotonically_increasing_id()), "suffix-anchors")
    zipped = F.explode(F.arrays_zip(F.col("grams").alias("gram"), F.col("around").alias("around"), F.col("places").alias("pos")))
    anchors = anchored.select("rid", "n_bytes", zipped.alias("x")).select("x.gram", "x.around", "rid", "x.pos", "n_bytes")
    often = anchored.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # Written first, so that the join has shuffles of its own, whose hot grams Spark may split.
    often = cut(often.select("gram"), "suffix-often")
    anchors = cut(anchors.join(often, "gram"), "suffix-shared")

    entries = anchors.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct("rid", "pos")).alias("one"))
    entries = cut(entries.select("gram", "around", "weight", "one.rid", "one.pos"), "suffix-entries")
    # Entries that repeat whole: every place they stand for is covered as far as a string can reach.
    whole = anchors.join(entries.where(F.col("weight") > 1).select("gram", "around"), ["gram", "around"], "left_semi")
    whole = whole.select("rid", F.greatest(F.col("pos") - reach, F.lit(0)).alias("start"), F.least(F.col("pos") + length, "n_bytes").alias("end"))

    # Grams with several entries are sorted; the texts around their places are fetched first.
    several = cut(entries.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1), "suffix-several")
    parts = F.ceil(F.col("size") / group_rows).cast("int")
    units = entries.join(several, "gram").withColumn("parts", parts)
    units = units.withColumn("unit", F.xxhash64("gram", F.pmod(F.xxhash64("around"), F.col("parts"))))
    wanted = units.groupBy("rid").agg(F.collect_list(F.struct("gram", "unit", "parts", "weight", "rid", "pos")).alias("entries"))
    keyed = wanted.join(anchored.select("rid", "k1", "k2"), "rid").select("k1", "k2", "entries")
    texts = docs.select("k1", "k2", "text")
    fetched = keyed.join(texts, ["k1", "k2"]).select(F.col("text").cast("binary").alias("text"), "entries").mapInArrow(_surroundings(length, gram), ENTRY_SCHEMA)
    placed = fetched.repartition("unit").sortWithinPartitions("unit", "rid", "pos")
    found = cut(placed.mapInArrow(_sort_entries(length, gram), SORTED_SCHEMA), "suffix-found")
    settled = found.where(F.col("before") < 0).select("rid", "start", "end")
    windows = found.where(F.col("before") >= 0)
    again = windows.groupBy("gram", "before", "window").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    across = windows.where(F.col("rid") >= 0).join(again, ["gram", "before", "window"], "left_semi").select("rid", "start", "end")

    ranges = whole.unionByName(settled).unionByName(across).groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    ranges = anchored.select("rid", "k1", "k2").join(ranges, "rid")
    # Repeated rows have the same ranges, since all their entries repeat: one of them speaks for all.
    return ranges.groupBy("k1", "k2").agg(F.min_by("ranges", "rid").alias("ranges"))


def _cut_out():
    """Joined texts and ranges to (bytes, removed runs, what is left)."""

    def run(batches):
        for b in _small(batches):
            n_bytes, removed, kept = [], [], []
            for text, ranges in zip(b.column(1), b.column(2), strict=True):
                data = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
                runs: list[list[int]] = []
                values = ranges.values if ranges.is_valid else None
                if values is not None:
                    pairs = np.stack([values.field("start").to_numpy(), values.field("end").to_numpy()], axis=1)
                    for lo, hi in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
                        if runs and lo <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], hi)
                        else:
                            runs.append([lo, hi])
                edges = [0, *(x for r in runs for x in r), data.size]
                n_bytes.append(data.size)
                removed.append([{"start": lo, "end": hi} for lo, hi in runs])
                kept.append(b"".join(data[lo:hi].to_pybytes() for lo, hi in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, n_bytes, removed (runs of bytes taken out) and kept (the bytes that are left) of every document."""
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    ranges = covered_ranges(keyed.select("k1", "k2", "text"), length, gram, group_rows)
    joined = keyed.join(ranges, ["k1", "k2"], "left").select("doc_id", F.col("text").cast("binary").alias("text"), "ranges")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    return joined.mapInArrow(_cut_out(), schema)


def repeat_report(docs: DataFrame, **args) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    return remove_repeats(docs, **args).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
