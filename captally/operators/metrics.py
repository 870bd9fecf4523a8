"""Caption metrics as DataFrame plans: BLEU-1..4, ROUGE-L, CIDEr-D (MET-1..7).

Inputs are two tables:

* ``preds``: (image, caption) -- one candidate per image;
* ``refs``:  (image, pos, caption) -- any number of references per image.

With a ``preset`` column in the predictions, every preset is scored on its own
in the same job.  Only images with a prediction *and* at least one reference
are scored (Q10); a second prediction for an image is an error, unless ``pos``
says which came last.

Nothing is collected per image: references stay one row each, and pairs are
dealt into blocks by image, those of a large image by 32 references, so a hot
image is many tasks (``operators.measures``).  A block measures its pairs with
array operations; gram keys travel packed, once per block, to learn how many
images hold them, so no gram row is written or joined and a frequent gram is no
single task either.

Formulas (public definitions: Papineni et al. 2002, Lin 2004, Vedantam et al.
2015, as implemented by the common caption-evaluation package):

* BLEU: ``guess_n = max(0, |c| - n + 1)``; ``correct_n = sum_g min(cnt_c(g),
  max_j cnt_rj(g))``; ``BLEU_n = (prod_{k<=n} (correct_k + 1e-15) /
  (guess_k + 1e-9)) ** (1/n)``, times ``exp(1 - 1/ratio)`` when
  ``ratio = (|c| + 1e-15) / (closest + 1e-9) < 1``.  The corpus score sums the
  counts first.
* ROUGE-L: ``P = max_j lcs/|c|``, ``R = max_j lcs/|r_j|`` (independent maxima),
  ``F = (1 + b^2) P R / (R + b^2 P)``, b = 1.2; mean over images.
* CIDEr-D: ``idf(g) = ln N - ln max(1, df(g))`` over the evaluated images,
  ``w = count * idf``; per reference and n ``sum_g min(w_c, w_r) w_r /
  (|w_c| |w_r|)`` times ``exp(-(b_c - b_r)^2 / (2 sigma^2))`` with b the
  bigram count, mean over n, mean over references, times 10; mean over images.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captally.functions.tokens import caption_tokens, space_tokens, whitespace_tokens
from captally.operators import measures
from captally.operators.materialize import cut
from captally.operators.ngrams import document_frequency, ngram_counts
from captally.operators.pairing import duplicate_predictions, latest_prediction
from captally.operators.skew import skew_join

MAX_N = 4
ROUGE_BETA = 1.2
CIDER_SIGMA = measures.CIDER_SIGMA
BLEU_TINY = 1e-15
BLEU_SMALL = 1e-9
METRIC_NAMES = ["Bleu_1", "Bleu_2", "Bleu_3", "Bleu_4", "ROUGE_L", "CIDEr"]
TOKENIZERS = ("whitespace", "caption")


def tokenizers(mode: str):
    """(n-gram tokenizer, LCS tokenizer) for a tokenizer mode (Q13)."""
    if mode == "whitespace":
        return whitespace_tokens, space_tokens
    if mode == "caption":
        # ROUGE-L splits the space-joined tokens again, so an empty caption
        # is one empty token, as in whitespace mode.
        return caption_tokens, lambda c: space_tokens(F.array_join(caption_tokens(c), " "))
    raise ValueError(f"unknown tokenizer {mode!r}; expected one of {TOKENIZERS}")


@dataclass
class Paired:
    """Candidates and references of the scored images, ready for every metric."""

    cand: DataFrame  # unit, preset, image, caption, n_images, alike (equal for presets of the same images); a written table
    refs: DataFrame  # image, pos, caption (a plan: texts are not written again)
    sizes: DataFrame  # image, size: bytes of its references (a written table)
    mode: str

    @cached_property
    def pairs(self) -> DataFrame:
        """(pair, unit, preset, image, pos, caption (reference), c_caption (candidate), n_images), a written table."""
        pairs = skew_join(self.refs, self.cand.withColumnRenamed("caption", "c_caption").drop("alike"), ["image"], "inner")
        return cut(pairs.withColumn("pair", F.monotonically_increasing_id()), "pairs")


def one_prediction_each(preds: DataFrame) -> DataFrame:
    """(preset, image, caption), one row per preset and image.

    With a ``pos`` column the last attempt counts (AGG-3); without one a
    second prediction for an image is an error.
    """
    if "preset" not in preds.columns:
        preds = preds.withColumn("preset", F.lit(""))
    keys = ["preset", "image"]
    if "pos" in preds.columns:
        return latest_prediction(preds, keys=keys).select(*keys, "caption")
    preds = cut(preds.select(*keys, "caption"), "predictions")
    n = duplicate_predictions(preds, keys).count()
    if n:
        raise ValueError(f"{n} image(s) have more than one prediction")
    return preds


def pair(preds: DataFrame, refs: DataFrame, tokenizer: str = "whitespace") -> Paired:
    """JN-2/JN-3: restrict to predicted images and pair every reference with its candidate.

    ``refs`` is a plan that runs twice, for the sizes and for the texts; it must
    give the same rows each time.
    """
    tokenizers(tokenizer)
    refs = refs.select("image", "pos", "caption").where(F.col("caption").isNotNull())
    # One short row an image: no text is written before it is dealt.
    sizes = cut(refs.where(F.col("image").isNotNull()).groupBy("image").agg(F.sum(F.octet_length("caption")).alias("size")), "reference-sizes")
    preds = one_prediction_each(preds).where(F.col("caption").isNotNull())
    cand = cut(preds.join(sizes.select("image"), "image", "left_semi").withColumn("unit", F.monotonically_increasing_id()), "candidates")
    summed = [F.sum(F.xxhash64("image", F.lit(k)).cast("decimal(20,0)")).cast("string") for k in (1, 2)]
    per_preset = cand.groupBy("preset").agg(F.count(F.lit(1)).alias("n_images"), F.concat_ws(":", F.count(F.lit(1)).cast("string"), *summed).alias("alike"))
    return Paired(cand=cand.join(per_preset, "preset"), refs=refs, sizes=sizes, mode=tokenizer)


def measured(p: Paired) -> DataFrame:
    """Lengths, LCS, clipped counts and similarities of every image (MET-2, MET-4, MET-5, NGR-1), written once to the checkpoint folder.

    The references of presets that have the same images are read and counted once for all of them.
    """
    return cut(measures.pair_measures(p.cand.withColumn("preset", F.col("alike")), p.refs, p.sizes, p.mode, MAX_N), "measures")


def pair_stats(pairs: DataFrame) -> DataFrame:
    """Per unit: reference count, ROUGE-L maxima, BLEU lengths, sum of similarities (MET-2, MET-4, MET-5), from ``measured`` rows."""
    return pairs.where("h1 is null").groupBy("unit").agg(
        F.sum("n_refs").alias("n_refs"),
        F.max("c_len").alias("c_len"),
        # MET-2: nearest reference length, ties to the shorter one.
        F.min(F.struct("closest_d", "closest_len")).getField("closest_len").alias("closest_len"),
        F.max("prec_max").alias("prec_max"),
        F.max("rec_max").alias("rec_max"),
        *(F.sum(c).alias(c) for c in measures.CORRECT),
        F.sum("cider_sum").alias("cider_sum"),
    )


def candidate_grams(p: Paired) -> DataFrame:
    """NGR-1, candidate side: (preset, image, n, g, cnt)."""
    ng_tok, _ = tokenizers(p.mode)
    toks = p.cand.select("preset", "image", ng_tok(F.col("caption")).alias("t"))
    return ngram_counts(toks, "t", ["preset", "image"], MAX_N)


def reference_grams(p: Paired) -> DataFrame:
    """NGR-1, reference side: (preset, image, pos, n, g, cnt); texts are dealt, no table of pairs is written."""
    ng_tok, _ = tokenizers(p.mode)
    rows = measures.reference_rows(p.cand, p.refs, p.sizes)
    toks = rows.select("preset", "image", "pos", ng_tok(F.col("caption")).alias("t"))
    return ngram_counts(toks, "t", ["preset", "image", "pos"], MAX_N, dealt=True)


def reference_frequencies(p: Paired) -> DataFrame:
    """MET-6: (preset, n, g, df): in how many images' references each gram occurs."""
    return document_frequency(p.cand, p.refs, p.sizes, p.mode, MAX_N)


def _guess(k: int) -> Column:
    return F.greatest(F.col("c_len") - k + 1, F.lit(0))


def bleu_columns(correct, guess, test_len: Column, ref_len: Column) -> list[Column]:
    """BLEU_1..4 from per-n correct/guess columns and the two lengths."""
    ratio = (test_len + BLEU_TINY) / (ref_len + BLEU_SMALL)
    brevity = F.when(ratio < 1, F.exp(1 - 1 / ratio)).otherwise(F.lit(1.0))
    out = []
    prod = F.lit(1.0)
    for k in range(1, MAX_N + 1):
        prod = prod * (correct(k) + BLEU_TINY) / (guess(k) + BLEU_SMALL)
        out.append((F.pow(prod, 1.0 / k) * brevity).alias(f"bleu_{k}"))
    return out


def bleu_counts(pairs: DataFrame) -> DataFrame:
    """MET-1 step: clipped matches of the wide images (unit, wide_1..4), best over their blocks, from ``measured`` rows."""
    best = pairs.where("h1 is not null").groupBy("unit", "n", "h1", "h2").agg(F.max("clip").alias("clip"))
    by_n = lambda k: F.coalesce(F.sum(F.when(F.col("n") == k, F.col("clip"))), F.lit(0))
    return best.groupBy("unit").agg(*(by_n(k).alias(f"wide_{k}") for k in range(1, MAX_N + 1)))


def image_scores(p: Paired) -> DataFrame:
    """Per preset and image: raw counts plus bleu_1..4, rouge_l, cider; written once to the checkpoint folder."""
    return cut(image_scores_plan(p, measured(p)), "image_scores")


def image_scores_plan(p: Paired, pairs: DataFrame) -> DataFrame:
    """The lazy plan of ``image_scores`` over the ``measured`` pairs."""
    units = p.cand.select("unit", "preset", "image")
    joined = (
        units.join(pair_stats(pairs), "unit")
        .join(bleu_counts(pairs), "unit", "left")
    )
    joined = joined.select(
        "preset",
        "image",
        "n_refs",
        "c_len",
        "closest_len",
        "prec_max",
        "rec_max",
        *[(F.col(f"correct_{k}") + F.coalesce(f"wide_{k}", F.lit(0))).cast("bigint").alias(f"correct_{k}") for k in range(1, MAX_N + 1)],
        *[_guess(k).cast("bigint").alias(f"guess_{k}") for k in range(1, MAX_N + 1)],
        "cider_sum",
    )
    b2 = ROUGE_BETA * ROUGE_BETA
    pm, rm = F.col("prec_max"), F.col("rec_max")
    rouge = F.when((pm != 0) & (rm != 0), (1 + b2) * pm * rm / (rm + b2 * pm)).otherwise(F.lit(0.0))
    return joined.select(
        "*",
        *bleu_columns(lambda k: F.col(f"correct_{k}"), lambda k: F.col(f"guess_{k}"), F.col("c_len"), F.col("closest_len")),
        rouge.alias("rouge_l"),
        (F.col("cider_sum") / F.col("n_refs") * 10.0).alias("cider"),
    )


def per_image_scores(preds: DataFrame, refs: DataFrame, tokenizer: str = "whitespace") -> DataFrame:
    """Per-image BLEU-1..4, ROUGE-L and CIDEr (the table the reference throws away)."""
    return image_scores(pair(preds, refs, tokenizer)).select(
        "image", *[f"bleu_{k}" for k in range(1, MAX_N + 1)], "rouge_l", "cider"
    )


def corpus_scores(per_image: DataFrame) -> DataFrame:
    """MET-7: corpus scores as (preset, metric, score) rows from ``image_scores`` output.

    BLEU sums counts over the corpus first; ROUGE-L and CIDEr are means of
    the per-image scores.  No rows in -> no rows out (Q12).
    """
    totals = per_image.groupBy("preset").agg(
        F.sum("c_len").alias("c_len"),
        F.sum("closest_len").alias("closest_len"),
        *[F.sum(f"correct_{k}").alias(f"correct_{k}") for k in range(1, MAX_N + 1)],
        *[F.sum(f"guess_{k}").alias(f"guess_{k}") for k in range(1, MAX_N + 1)],
        F.avg("rouge_l").alias("rouge_l"),
        F.avg("cider").alias("cider"),
    )
    scored = totals.select(
        "preset",
        *bleu_columns(
            lambda k: F.col(f"correct_{k}").cast("double"),
            lambda k: F.col(f"guess_{k}").cast("double"),
            F.col("c_len").cast("double"),
            F.col("closest_len").cast("double"),
        ),
        "rouge_l",
        "cider",
    )
    stacked = ", ".join(
        f"'{name}', {col}" for name, col in zip(METRIC_NAMES, ["bleu_1", "bleu_2", "bleu_3", "bleu_4", "rouge_l", "cider"])
    )
    return scored.selectExpr("preset", f"stack({len(METRIC_NAMES)}, {stacked}) as (metric, score)")


def caption_scores(preds: DataFrame, refs: DataFrame, tokenizer: str = "whitespace") -> DataFrame:
    """MET-7: all corpus metrics as (metric, score), with a preset column if the predictions have one."""
    scores = corpus_scores(image_scores(pair(preds, refs, tokenizer)))
    return scores if "preset" in preds.columns else scores.drop("preset")


def coverage(preds: DataFrame, refs: DataFrame) -> DataFrame:
    """MET-7: scored images, predictions without reference, images with references but no prediction (one join)."""
    ref_images = refs.select("image", F.lit(1).alias("r")).distinct()
    pred_images = preds.select("image", F.lit(1).alias("p")).distinct()
    has_r, has_p = F.col("r").isNotNull(), F.col("p").isNotNull()
    return pred_images.join(ref_images, "image", "full_outer").agg(
        F.count_if(has_r & has_p).alias("scored_images"),
        F.count_if(has_p & ~has_r).alias("unreferenced_predictions"),
        F.count_if(has_r & ~has_p).alias("unpredicted_images"),
    )
