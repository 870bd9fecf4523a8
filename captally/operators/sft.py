"""Training-example preparation (SFT-1..7): the data side of fine-tuning.

The tokenizer is a vocabulary table of whole words, or a ``SubwordTokenizer``.
With a table encoding is a relational job (explode, join, ordered collect per
text); sub-words are found once for each distinct word of an Arrow batch, where
the text is.
Reserved ids of a vocabulary table: 0 unknown, 1 begin, 2 end (also padding); a
sub-word tokenizer has no begin id and its ``eos`` ends and pads.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captally.functions.subword import SubwordTokenizer
from captally.functions.tokens import whitespace_tokens
from captally.operators.materialize import cut
from captally.operators.ordinals import ordinals
from captally.operators.pairing import drop_bad_samples
from captally.operators.skew import skew_join

# Reserved ids, label mask value and the schedule defaults.
UNK_ID, BOS_ID, EOS_ID = 0, 1, 2
PAD_ID = EOS_ID
IGNORE_INDEX = -100
VOCAB_OFFSET = 3
MAX_LEN = 32
BATCH_SIZE = 4
GRAD_ACCUMULATION = 4
EPOCHS = 3
STACKED = ("input_ids", "attention_mask", "labels")


def build_vocab(texts: DataFrame, text: str = "caption", offset: int = VOCAB_OFFSET) -> DataFrame:
    """(token, id): distinct whitespace tokens in code-point order, id from ``offset``."""
    toks = texts.select(F.explode(whitespace_tokens(F.col(text))).alias("token")).distinct()
    return ordinals(toks, ["token"], "ordinal").select("token", (F.col("ordinal") + offset).cast("int").alias("id"))


def encode(
    df: DataFrame,
    text: str,
    vocab: DataFrame | None,
    keys: Sequence[str],
    bos: bool = True,
    max_tokens: int | None = None,
    tokenizer: SubwordTokenizer | None = None,
) -> DataFrame:
    """SFT-1: (keys..., ids array<int>) -- token ids in text order, unknown -> 0.

    ``keys`` must identify a row.  Words are joined to the vocabulary with
    ``skew_join`` (a frequent one is dealt over many tasks) and gathered back
    per text.  With ``max_tokens`` only that many words of a text are looked
    up: what a fixed-length example has room for.  With a ``tokenizer`` nothing
    is joined: a batch's distinct words are encoded where their texts are.
    """
    keys = list(keys)
    tokens = whitespace_tokens(F.col(text)) if tokenizer is None else tokenizer.words(F.col(text))
    if max_tokens is not None:
        tokens = F.slice(tokens, 1, max_tokens)
    if tokenizer is None:
        return _joined_ids(df, tokens, vocab.select("token", F.array("id").alias("ids")), keys, bos)
    again = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "repeated-keys")
    whole = lambda rows: rows.select(*keys, tokenizer.encode(tokens).alias("ids"))
    if again.isEmpty():
        return whole(df)
    # Rows that share their keys are one text, word by word.
    other = again.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    rest = df.join(other, same, "left_semi")
    words = rest.select(F.explode(tokens).alias("word")).distinct()
    table = cut(tokenizer.word_table(words), "subwords").withColumnRenamed("word", "token")
    return whole(df.join(other, same, "left_anti")).unionByName(_joined_ids(rest, tokens, table, keys, False))


def _joined_ids(df: DataFrame, tokens: Column, table: DataFrame, keys: Sequence[str], bos: bool) -> DataFrame:
    """(keys..., ids) by a join of every token with ``table`` (token, ids)."""
    # An empty text stays as one row without a token.
    toks = df.select(*keys, F.posexplode_outer(tokens).alias("p", "token"))
    ided = skew_join(toks, table, ["token"], "left")
    at = F.when(F.col("p").isNotNull(), F.struct("p", F.coalesce("ids", F.array(F.lit(UNK_ID))).alias("ids")))
    gathered = ided.groupBy(*keys).agg(F.sort_array(F.collect_list(at)).alias("_t"))
    ids = F.flatten(F.transform("_t", lambda s: s["ids"]))
    if bos:
        ids = F.concat(F.array(F.lit(BOS_ID)), ids)
    return gathered.select(*keys, ids.alias("ids"))


def truncate_pad(ids: Column, max_len: int = MAX_LEN, pad: int = PAD_ID) -> Column:
    """SFT-2: cut to ``max_len`` ids and right-pad to exactly ``max_len``."""
    cut = F.slice(ids, 1, max_len)
    return F.concat(cut, F.array_repeat(F.lit(pad), F.lit(max_len) - F.size(cut)))


def caption_mask(ids: Column, max_len: int = MAX_LEN) -> Column:
    """Attention mask of a truncated-and-padded caption: 1 for real ids, 0 for padding."""
    real = F.least(F.size(ids), F.lit(max_len))
    return F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(max_len) - real))


def concat_prompt(prompt_ids: Column, caption_ids: Column) -> Column:
    """SFT-3: prompt part followed by caption part."""
    return F.concat(prompt_ids, caption_ids)


def mask_labels(
    ids: Column, n_prompt: Column, mask: Column | None = None, mask_eos: bool = True, pad: int = PAD_ID, ignore: int = IGNORE_INDEX
) -> Column:
    """SFT-4: prompt positions and padding positions -> ``ignore``.

    Padding equals the end id.  With ``mask_eos`` (as in the reference, Q16)
    every such id is masked, the true end token too; without it only the
    positions that ``mask`` marks 0 are, and the end token is learned.
    """
    if mask_eos or mask is None:
        return F.transform(ids, lambda x, i: F.when((i < n_prompt) | (x == pad), F.lit(ignore)).otherwise(x))
    marked = F.arrays_zip(ids.alias("x"), mask.alias("m"))
    return F.transform(marked, lambda z, i: F.when((i < n_prompt) | (z["m"] == 0), F.lit(ignore)).otherwise(z["x"]))


def training_examples(
    captions: DataFrame,
    prompt: str,
    vocab: DataFrame | None,
    max_len: int = MAX_LEN,
    key: str = "image",
    mask_eos: bool = True,
    tokenizer: SubwordTokenizer | None = None,
) -> DataFrame:
    """SFT-5: (image, input_ids, attention_mask, labels) from (image, caption).

    Caption ids are the encoded caption plus the end id, truncated and
    padded to ``max_len``; the prompt ids come first and are masked in the
    labels.
    """
    eos = EOS_ID if tokenizer is None else tokenizer.eos
    spark = captions.sparkSession
    prompt_df = spark.createDataFrame([(0, prompt)], "k int, caption string")
    # The prompt is one short text given by the caller: its ids are a literal.
    prompt_ids = encode(prompt_df, "caption", vocab, ["k"], tokenizer=tokenizer).first()["ids"]
    n_prompt = F.lit(len(prompt_ids))
    cap = encode(captions, "caption", vocab, [key], max_tokens=max_len, tokenizer=tokenizer).select(
        key, F.concat("ids", F.array(F.lit(eos))).alias("cap")
    )
    both = cap.select(
        key,
        concat_prompt(F.array(*map(F.lit, prompt_ids)), truncate_pad(F.col("cap"), max_len, eos)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n_prompt), caption_mask(F.col("cap"), max_len)).alias("attention_mask"),
    )
    labels = mask_labels(F.col("input_ids"), n_prompt, F.col("attention_mask"), mask_eos, eos)
    return both.select(key, "input_ids", "attention_mask", labels.alias("labels"))


def assemble_batches(examples: DataFrame, size: int = BATCH_SIZE, key: str = "image") -> DataFrame:
    """SFT-6: drop failed samples, then fixed-size batches in key order.

    (batch_id, n_examples, keys array, and each of ``input_ids``,
    ``attention_mask`` and ``labels`` that the examples have, stacked: one row
    of the matrix per example).  Batch ids come from dense ordinals, so each
    group holds at most ``size`` rows.  Failed samples go first and batches are
    filled without them; the reference drops them from a batch already formed,
    which only makes that batch smaller.
    """
    if "status" in examples.columns:
        examples = drop_bad_samples(examples)
    stacked = [c for c in STACKED if c in examples.columns]
    ranked = ordinals(examples.select(key, *stacked), [key], "ordinal")
    rows = F.sort_array(F.collect_list(F.struct("ordinal", key, *stacked)))
    batches = ranked.groupBy(F.floor(F.col("ordinal") / size).alias("batch_id")).agg(F.count(F.lit(1)).alias("n_examples"), rows.alias("_rows"))
    return batches.select("batch_id", "n_examples", F.col(f"_rows.{key}").alias(f"{key}s"), *(F.col(f"_rows.{c}").alias(c) for c in stacked))


def step_plan(
    examples: DataFrame, batch: int = BATCH_SIZE, accum: int = GRAD_ACCUMULATION, epochs: int = EPOCHS
) -> DataFrame:
    """SFT-7: optimiser steps implied by the schedule, as one aggregate row.

    batches = ceil(n / batch); steps per epoch = max(floor(batches / accum), 1):
    the pinned public trainer counts whole accumulation rounds per epoch.
    """
    n = F.count(F.lit(1))
    batches = F.ceil(n / F.lit(batch))
    per_epoch = F.greatest(F.floor(batches / F.lit(accum)), F.lit(1))
    return examples.agg(
        n.alias("n_examples"),
        batches.cast("long").alias("batches_per_epoch"),
        per_epoch.cast("long").alias("steps_per_epoch"),
        (per_epoch * epochs).cast("long").alias("total_steps"),
    )
