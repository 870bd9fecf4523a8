"""Mixing sources to target weights, in DataFrame functions only.

Documents of a source are laid end to end in a pseudorandom order and cut
into blocks of ``block_words`` words.  Every output shard draws how many of
its slots go to each source from the multinomial of the targets; a source's
slots over all shards, numbered through, are mapped to its blocks by one
pseudorandom permutation of the block numbers per pass (swap-or-not rounds,
so no sorting and no table of the permutation), and blocks are joined by
number.  A block is thus drawn again only after all others of its source.

The shards' draws add up to the targets only on average.  Slots that a source
drew beyond its quota go to the sources that drew too few, so each source is
taken to within a block of its target and no block more than three times.

The mix is written once, every slot with its text and the pieces it is made
of; what is taken of a document is counted from the written pieces.

Scale: a source is dealt to hash buckets of about ``BUCKET_ROWS`` documents
and no block crosses a bucket, so a hot source is no single task and texts are
shuffled once: documents are placed, cut and packed inside their bucket, and
the drawn slots (a few numbers each) are sent there and joined by block.
Places of buckets, and numbers of slots over the shards, are running sums in
two levels.  Only tables of one row per source are seen whole.

Defined results: a null or word-less text has size 0 and taken 0; null is a
source of its own, ordered last; repeated rows each take their own place; an
empty table gives an empty result.  Everything is a function of the rows and
``seed``, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captally.operators.materialize import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARD_BLOCKS = 1 << 16
BUCKET_ROWS = 8192
PERMUTATION_ROUNDS = 16
CELLS = 4096
STRETCH = 1024
BUCKET_BLOCKS = 1 << 14


def _sizes(docs: DataFrame, *more: str) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.xxhash64("doc_id", "text").alias("place"), *more)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: sid, weight, source_size, target, buckets.

    With the sources in the order of ``cap / weight``, those before the first
    one whose fair share of what is left fits its cap are at their caps; the
    rest share by weight.  That is the fixed point of resharing the excess.
    """
    one = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "sid")
    below = by_room.rowsBetween(Window.unboundedPreceding, -1)
    above = by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    per = per.withColumn("sid", F.row_number().over(one) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1))
    per = per.withColumn("cap", F.lit(max_repeats) * F.col("source_size")).withColumn("room", F.col("cap") / F.col("weight"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))
    per = per.withColumn("share", left / F.sum("weight").over(above))
    fits = F.when(F.col("share") <= F.col("room"), F.struct("room", "sid", "share"))
    per = per.withColumn("level", F.min(fits).over(everything)["share"])
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
    return per.select("source", "sid", "weight", "source_size", "target", F.ceil(F.col("n_docs") / BUCKET_ROWS).alias("buckets"))


def running_before(rows: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``keys`` with a smaller ``order`` (a whole number, unique there).

    Rows are summed in stretches of ``STRETCH`` numbers, and then the stretches.
    """
    rows = rows.withColumn("_stretch", F.floor(F.col(order) / STRETCH))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_stretch").agg(F.sum(value).alias("_sum"))
    sums = sums.select(*keys, "_stretch", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, [*keys, "_stretch"])
    return rows.withColumn(out, F.col("_base") + F.col("_inside")).drop("_stretch", "_inside", "_base")


def bucket_starts(sizes: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(sid, bucket, blocks, bucket_at, block_at): the blocks of each hash bucket of a source, the words and blocks before it."""
    totals = _bucketed(sizes, sources).groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    totals = totals.withColumn("blocks", F.ceil(F.col("words") / block_words))
    totals = running_before(cut(totals, "mix-buckets"), ["sid"], "bucket", "words", "bucket_at")
    return running_before(totals, ["sid"], "bucket", "blocks", "block_at").drop("words")


def with_quotas(sources: DataFrame, starts: DataFrame) -> DataFrame:
    """``sources`` with blocks, quota (the slots that make up the target) and first_ticket."""
    per = sources.join(starts.groupBy("sid").agg(F.sum("blocks").alias("blocks")), "sid")
    quota = F.when(F.col("blocks") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(F.lit(0))
    before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("quota", quota.cast("long"))
    return per.withColumn("first_ticket", F.coalesce(F.sum("quota").over(before), F.lit(0)))


def _bucketed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    rows = rows.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    return rows.select("d.*", "s.sid", F.pmod("d.place", "s.buckets").alias("bucket"))


def _in_bucket() -> Column:
    """The words before the document in its bucket."""
    inside = Window.partitionBy("sid", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("size").over(inside), F.lit(0))


def placed(rows: DataFrame, sources: DataFrame, starts: DataFrame) -> DataFrame:
    """``rows`` with sid and ``at``, the words before the document in its source."""
    rows = _bucketed(rows, sources).withColumn("in_bucket", _in_bucket())
    return rows.join(starts, ["sid", "bucket"]).withColumn("at", F.col("bucket_at") + F.col("in_bucket")).drop("in_bucket", *starts.columns[1:])


def pieces(block_words: int = BLOCK_WORDS) -> Column:
    """An array with, per block that the document reaches into, the block, the word range [start, end) of the document, and its words."""
    at = F.col("in_bucket")
    first, last = F.floor(at / block_words), F.floor((at + F.col("size") - 1) / block_words)
    blocks = F.sequence(first.cast("long"), last.cast("long"))

    def piece(words, block):
        start = F.greatest(F.lit(0).cast("long"), block * block_words - at)
        end = F.least(F.col("size"), (block + 1) * block_words - at)
        part = F.array_join(F.slice(words, (start + 1).cast("int"), (end - start).cast("int")), " ")
        return F.struct(block.alias("block"), start.alias("start"), end.alias("end"), part.alias("part"))

    # The one-row array binds the words, so they are found once a document and not once a block.
    found = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return F.transform(found, lambda words: F.transform(blocks, lambda block: piece(words, block)))[0]


def permuted(i: Column, n: Column, *key: Column) -> Column:
    """Image of ``i`` under a pseudorandom permutation of 0..n-1 (swap-or-not network)."""

    def swap(x, r):
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        heads = F.pmod(F.xxhash64(*key, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(heads, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(PERMUTATION_ROUNDS)), i.cast("long"), swap)


def slots(sources: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """(shard, sid, block): the drawn block of every output slot."""
    spark = sources.sparkSession
    n = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    # Multinomial counts: each slot's ticket falls into the ticket range of one source.
    width = max(1, n // CELLS)
    tickets = spark.range(n).select(
        F.floor(F.col("id") / shard_blocks).alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, n))).alias("ticket")
    )
    last = F.col("first_ticket") + F.col("quota") - 1
    cells = sources.where(F.col("quota") > 0).select(
        "sid", "first_ticket", last.alias("last_ticket"),
        F.explode(F.sequence(F.floor(F.col("first_ticket") / width).cast("long"), F.floor(last / width).cast("long"))).alias("cell"),
    )
    drawn = tickets.withColumn("cell", F.floor(F.col("ticket") / width)).join(cells, "cell")
    drawn = drawn.where(F.col("ticket").between(F.col("first_ticket"), F.col("last_ticket")))
    counts = cut(drawn.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n")), "mix-counts")

    counts = running_before(counts, ["sid"], "shard", "n", "first").join(sources.select("sid", "quota"), "sid")
    counts = counts.withColumn("kept", F.greatest(F.lit(0), F.least(F.col("n"), F.col("quota") - F.col("first"))))
    # Few rows make many slots: spread them by their number, not by their bytes.
    spread = counts.where(F.col("kept") > 0).repartition(n // shard_blocks + 1, "shard", "sid")
    fair = spread.select("shard", "sid", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("kept") - 1)).alias("nth"))

    # Slots beyond a source's quota, numbered through, meet the missing slots of other sources.
    by_sid = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    over = running_before(counts.withColumn("over", F.col("n") - F.col("kept")).where(F.col("over") > 0), ["sid"], "shard", "over", "at")
    sums = over.groupBy("sid").agg(F.sum("over").alias("sum"))
    over = over.join(sums.select("sid", F.coalesce(F.sum("sum").over(by_sid), F.lit(0)).alias("base")), "sid")
    over = over.withColumn("from", F.col("base") + F.col("at"))
    over = over.select("shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("over") - 1)).alias("number"))
    took = counts.groupBy("sid").agg(F.sum("n").alias("took"))
    short = sources.join(took, "sid", "left").withColumn("took", F.coalesce("took", F.lit(0)))
    short = short.withColumn("missing", F.col("quota") - F.col("took")).where(F.col("missing") > 0)
    short = short.withColumn("from", F.coalesce(F.sum("missing").over(by_sid), F.lit(0)))
    short = short.select("sid", "took", "from", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("missing") - 1)).alias("number"))
    moved = over.join(short, "number").select("shard", "sid", (F.col("took") + F.col("number") - F.col("from")).alias("nth"))

    every = fair.unionByName(moved).join(sources.select("sid", "blocks"), "sid")
    turn = F.floor(F.col("nth") / F.col("blocks"))
    block = permuted(F.pmod("nth", "blocks"), F.col("blocks"), F.lit(seed), F.col("sid"), turn)
    return every.select("shard", "sid", block.alias("block"))


def _mix(docs: DataFrame, sources: DataFrame, starts: DataFrame, block_words: int, shard_blocks: int, seed: int) -> DataFrame:
    """(shard, sid, block, pieces, text), one row per output slot.

    Documents and slots go to the documents' buckets in one shuffle.  Words
    before a document, its pieces and the grouping by block, where a block's
    pieces meet the slots that drew it, need no other.
    """
    rows = _bucketed(_sizes(docs, "text").where(F.col("size") > 0), sources)
    rows = rows.select("sid", "bucket", "place", "doc_id", "size", "text")
    # A slot's bucket is the one whose range of blocks holds its block, looked up by stretches of blocks.
    held = starts.where(F.col("blocks") > 0)
    ends = [F.floor(b / BUCKET_BLOCKS).cast("long") for b in (F.col("block_at"), F.col("block_at") + F.col("blocks") - 1)]
    held = held.select("sid", "bucket", "block_at", "blocks", F.explode(F.sequence(*ends)).alias("cell"))
    drawn = slots(sources, shard_blocks, seed).withColumn("cell", F.floor(F.col("block") / BUCKET_BLOCKS)).join(held, ["sid", "cell"])
    drawn = drawn.where(F.col("block").between(F.col("block_at"), F.col("block_at") + F.col("blocks") - 1))
    drawn = drawn.select("sid", "bucket", F.lit(0).cast("long").alias("size"), "shard", (F.col("block") - F.col("block_at")).alias("drawn"))
    rows = rows.unionByName(drawn, allowMissingColumns=True).withColumn("in_bucket", _in_bucket())
    none = F.lit(None)
    asked = F.array(F.struct(F.col("drawn").alias("block"), none.cast("long").alias("start"), none.cast("long").alias("end"), none.cast("string").alias("part")))
    rows = rows.withColumn("x", F.explode(F.when(F.col("shard").isNull(), pieces(block_words)).otherwise(asked)))
    part = F.when(F.col("shard").isNull(), F.struct("in_bucket", "doc_id", "size", "x.start", "x.end", "x.part"))
    packed = rows.groupBy("sid", "bucket", F.col("x.block").alias("local"))
    packed = packed.agg(F.sort_array(F.collect_list(part)).alias("parts"), F.collect_list("shard").alias("shards")).where(F.size("shards") > 0)
    packed = packed.join(starts, ["sid", "bucket"])

    def span(p):
        at = (F.col("bucket_at") + p["in_bucket"]).alias("at")
        return F.struct(at, p["doc_id"].alias("doc_id"), p["size"].alias("size"), p["start"].alias("start"), p["end"].alias("end"))

    packed = packed.select(
        "sid", (F.col("block_at") + F.col("local")).alias("block"), F.transform("parts", span).alias("pieces"),
        F.array_join(F.col("parts.part"), " ").alias("text"), "shards",
    )
    return packed.select(F.explode("shards").alias("shard"), "sid", "block", "pieces", "text")


def _plan(docs: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written tables of document sizes, sources and buckets."""
    sizes = cut(_sizes(docs), "mix-sizes")
    sources = cut(source_targets(sizes), "mix-sources")
    starts = cut(bucket_starts(sizes, sources, block_words), "mix-starts")
    return sizes, cut(with_quotas(sources, starts), "mix-quotas"), starts


def mix_report(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = 0, out: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) of every document.

    The mix is written with its texts, and taken is counted from its pieces.
    ``out`` names a folder where the mix of ``mixed_blocks`` stays as Parquet;
    without it the written mix goes when the driver's Python ends.
    """
    sizes, sources, starts = _plan(docs, block_words)
    mix = _mix(docs, sources, starts, block_words, shard_blocks, seed)
    if out is None:
        mix = cut(mix, "mix-blocks")
    else:
        mix.join(sources.select("sid", "source"), "sid").write.parquet(out)
        mix = docs.sparkSession.read.parquet(out)
    used = mix.select("sid", F.explode("pieces").alias("p")).select("sid", "p.at", (F.col("p.end") - F.col("p.start")).alias("words"))
    used = used.groupBy("sid", "at").agg(F.sum("words").alias("taken"))
    rows = placed(sizes, sources, starts).select("doc_id", "sid", "size", "at")
    # A word-less document shares its place with the next one.
    taken = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).alias("taken")
    report = rows.join(used, ["sid", "at"], "left").select("doc_id", "size", "sid", taken)
    return report.join(sources, "sid").select("doc_id", "size", "source_size", "target", "taken")


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """The mix itself: (shard, source, block, pieces, text), one row per output slot.

    A block's text is its words, single-spaced; documents meet inside blocks.
    ``pieces`` says whose they are, in order: doc_id, the word range
    [start, end), the document's size and ``at``, its place in the source.
    """
    _, sources, starts = _plan(docs, block_words)
    mix = cut(_mix(docs, sources, starts, block_words, shard_blocks, seed), "mix-blocks")
    return mix.join(sources.select("sid", "source"), "sid").select("shard", "source", "block", "pieces", "text")
