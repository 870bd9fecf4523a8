"""The registered queries: one callable (spark, sf_dir) -> DataFrame per operator group.

Every query reads the driver's tables (through ``fixtures``) in full.  Doubles
are rounded to 6 places and arrays are flattened to text so the results can
be compared with the DuckDB statements in ``captally.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captally import fixtures as fx
from captally.functions.text import append_eos, image_id, image_path, to_json_text, wrap_single
from captally.functions.tokens import caption_tokens as caption_tokens_fn
from captally.operators import metrics
from captally.operators.captioner import (
    PRESETS,
    caption_images,
    caption_with_ledger,
    decoding_presets,
    postprocess,
    text_batch_captioner,
    text_captioner,
)
from captally.operators.materialize import cut, scratch_path
from captally.operators.ordinals import annotation_ids, image_ordinal, slice_images, sort_images
from captally.operators.pairing import (
    duplicate_predictions as duplicate_predictions_op,
    existing_images,
    failures,
    first_caption,
    group_captions,
    id_collisions,
    latest_prediction,
    missing_images,
    pick_metrics,
    references_for,
    scored_only,
    unique_images as unique_images_op,
    unknown_prediction_ids,
)
from captally.functions.subword import read_tokenizer
from captally.operators.sft import assemble_batches, encode, step_plan as step_plan_op
from captally.operators.splits import by_split, in_split, manifest_split, positional_split, split_counts
from captally.plans.evaluation import compare_presets, evaluate_captions, evaluate_manifest
from captally.plans.report import qualitative_report, score_report
from captally.plans.training import prepare_training, training_captions
from captally.sinks import write_captions, write_coco_predictions, write_coco_references
from captally.sources.images import check_pictures
from captally.sources import (
    lower_header,
    parse_token_lines,
    raw_references,
    read_caption_tokens,
    read_captions,
    read_coco_images,
    read_coco_predictions,
    read_coco_references,
    read_split_manifest,
    scan_images,
    validate_images,
)

IMAGE_DIR = "/data/images"
#: A public byte-level vocabulary; any file of that form will do.
SUBWORD_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
DIGITS = 6


def _r(c: str) -> F.Column:
    return F.round(F.col(c), DIGITS).alias(c)


def _ints_text(c: str) -> F.Column:
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",").alias(c)


def _image_scores(spark: SparkSession, sf: str, mode: str = "whitespace") -> DataFrame:
    return metrics.image_scores(metrics.pair(fx.scoring_predictions(spark, sf), fx.references(spark, sf, False), mode))


def _positional_labels(spark: SparkSession, sf: str) -> DataFrame:
    """(image, n_captions, ordinal, split): 60 / 20 / 20 % of the images in name order."""
    per_image = fx.references(spark, sf).groupBy("image").agg(F.count(F.lit(1)).alias("n_captions"))
    images = cut(per_image, "images")
    n = images.count()
    return positional_split(images, (n * 6 // 10, n * 2 // 10), unique=True)


# ---------------------------------------------------------------- captions


def captions_grouped(spark, sf):
    """AGG-1, PRJ-2: one row per (image, chunk)."""
    g = group_captions(fx.references(spark, sf), dense=True)
    return g.select(
        "image",
        F.col("chunk").cast("long").alias("chunk"),
        F.col("n_captions").cast("long").alias("n_captions"),
        F.array_join("captions", "\n").alias("captions"),
        image_path("image", IMAGE_DIR).alias("path"),
    )


def first_captions(spark, sf):
    """PRJ-3, PRJ-4 on the manifest shape (images with no sentence keep a null)."""
    m = fx.manifest(spark, sf).select("filename", raw_references("sentences").alias("refs"))
    return m.select(
        F.col("filename").alias("image"),
        first_caption("refs").alias("first_caption"),
        F.size("refs").cast("long").alias("n_refs"),
    )


def positional_split_counts(spark, sf):
    """SPL-2, SPL-3: images and captions per positional split."""
    labels = _positional_labels(spark, sf)
    captions = labels.groupBy("split").agg(F.sum("n_captions").alias("n_captions"))
    return split_counts(labels).join(captions, "split").select(
        "split", F.col("n_images").cast("long").alias("n_images"), F.col("n_captions").cast("long").alias("n_captions")
    )


def test_split_captions(spark, sf):
    """JN-1: the captions of the positional test split."""
    return in_split(fx.references(spark, sf), cut(_positional_labels(spark, sf), "labels"), "test").select(
        "image", F.col("pos").cast("long").alias("pos"), "caption"
    )


def unique_images(spark, sf):
    """AGG-2."""
    return unique_images_op(fx.references(spark, sf))


def image_slice(spark, sf):
    """LIM-1, SRT-1: the second tenth of the images in name order."""
    images = cut(unique_images_op(fx.references(spark, sf)), "images")
    n = images.count()
    got = sort_images(slice_images(images, n // 10, n // 5, unique=True))
    return got.select("image", F.col("ordinal").cast("long").alias("ordinal"))


def manifest_split_rows(spark, sf):
    """SPL-1, FLT-1: the manifest's test images."""
    m = fx.manifest(spark, sf)
    return manifest_split(m, "test").select(
        F.col("filename").alias("image"), "split", F.size("sentences").cast("long").alias("n_refs")
    )


def image_ordinals(spark, sf):
    """WIN-1: position of each image inside its positional split."""
    labels = _positional_labels(spark, sf).select("image", "split")
    return image_ordinal(labels, "split").select("image", "split", F.col("ordinal").cast("long").alias("ordinal"))


def annotation_rows(spark, sf):
    """AGG-4, WIN-2, ID-1: COCO annotation rows with dense ids."""
    ann = annotation_ids(fx.references(spark, sf))
    return ann.select(image_id("image").alias("image_id"), F.col("id").cast("long").alias("id"), "caption")


def clean_captions(spark, sf):
    """STR-1, STR-2, CAP-2."""
    raw = fx.raw_predictions(spark, sf)
    return postprocess(raw.select("image", F.col("raw").alias("caption")), PRESETS["greedy"])


def token_key_split(spark, sf):
    """SRC-2 parser, STR-3: ``image#k<TAB>caption`` lines parsed back."""
    return parse_token_lines(_token_lines(spark, sf)).select("image", F.col("pos").cast("long").alias("pos"), "caption")


def _token_lines(spark, sf):
    key = F.concat("image", F.lit("#"), F.col("pos").cast("string"))
    return fx.references(spark, sf).select(F.concat(key, F.lit("\t"), "caption").alias("value"))


def caption_token_file(spark, sf):
    """SRC-2: a token file written from the references and read again."""
    path = scratch_path(spark, "tokens")
    _token_lines(spark, sf).write.text(path)
    return read_caption_tokens(spark, path).select("image", F.col("pos").cast("long").alias("pos"), "caption")


def split_manifest_file(spark, sf):
    """SRC-3, PRJ-3: a sharded manifest (JSON lines) written from the documents and read again."""
    path = scratch_path(spark, "manifest")
    fx.manifest(spark, sf).select("filename", "split", "sentences").write.json(path)
    got = read_split_manifest(spark, path, document=False)
    return got.select("filename", "split", F.array_join("refs", "\n").alias("refs"), F.size("refs").cast("long").alias("n_refs"))


def caption_csv(spark, sf):
    """SRC-1, SNK-3, PRJ-1: a CSV with an upper-case header written from the references and read again."""
    path = scratch_path(spark, "csv")
    write_captions(fx.references(spark, sf), path)
    shouted = read_captions(spark, path).select(F.col("image").alias("IMAGE"), F.col("caption").alias("Caption"))
    return lower_header(shouted).groupBy("image").agg(
        F.count(F.lit(1)).alias("n_captions"), F.sum(F.length("caption")).cast("long").alias("n_chars")
    )


def json_captions(spark, sf):
    """JSN-1, STR-4, ARR-1: predictions with an end mark as JSON text."""
    preds = fx.predictions(spark, sf).select("image", append_eos("caption", "</s>").alias("caption"))
    row = preds.select("image", "caption", wrap_single("caption").alias("captions"))
    return row.select("image", to_json_text("image", "captions").alias("json"))


def image_listing(spark, sf):
    """SRC-4: files of an image folder written from the documents."""
    got = scan_images(spark, fx.image_folder(spark, sf))
    return got.select("image", F.col("length").cast("long").alias("length"))


def image_validity(spark, sf):
    """SRC-5: which of the files are pictures."""
    got = validate_images(spark, fx.image_folder(spark, sf))
    return got.select("image", "ok", F.col("width").cast("long").alias("width"), F.col("height").cast("long").alias("height"))


def picture_check(spark, sf):
    """SRC-5: RGB, 16-bit, palette and CMYK pictures, some of them cut off."""
    got = check_pictures(fx.picture_files(spark, sf))
    size = [F.col(c).cast("long").alias(c) for c in ("width", "height", "n_channels", "bits")]
    return got.select("image", "kind", "format", *size, "problem", "ok")


def csv_documents(spark, sf):
    """SRC-1 by byte ranges: whole texts, with their line ends, quotes and commas, written as CSV and read again."""
    path = scratch_path(spark, "csv-texts")
    docs = fx.spread(fx.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    write_captions(docs.select(fx.image_name(F.col("doc_id")).alias("image"), F.col("text").alias("caption")), path)
    return read_captions(spark, path).select("image", F.length("caption").cast("long").alias("n_chars"), F.sha2("caption", 256).alias("text_sha256"))


def image_presence(spark, sf):
    """FLT-2: images of the documents with and without a file."""
    rows = fx.manifest(spark, sf).select(F.col("filename").alias("image"))
    listing = cut(scan_images(spark, fx.image_folder(spark, sf)).select("image"), "listing")
    there = existing_images(rows, listing).withColumn("present", F.lit(True))
    return there.unionByName(missing_images(rows, listing).withColumn("present", F.lit(False)))


def latest_predictions(spark, sf):
    """AGG-3: last write wins per image."""
    got = latest_prediction(fx.attempts(spark, sf))
    return got.select("image", "caption", F.col("attempts").cast("long").alias("attempts"))


def paired_captions(spark, sf):
    """JN-3: every reference with its image's prediction."""
    p = metrics.pair(fx.scoring_predictions(spark, sf), fx.references(spark, sf, False))
    return p.pairs.select("image", F.col("pos").cast("long").alias("pos"), "caption", F.col("c_caption").alias("prediction"))


def _ok_predictions(spark, sf):
    labels = fx.table(spark, sf, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0))
    ok = labels.select(fx.image_name(F.col("doc_id")).alias("image"))
    return fx.predictions(spark, sf).join(ok, "image", "left_semi")


def references_for_predicted(spark, sf):
    """JN-2: references of the images that have a prediction."""
    got = references_for(fx.references(spark, sf), _ok_predictions(spark, sf))
    return got.select("image", F.col("pos").cast("long").alias("pos"), "caption")


def _labelled_references(spark, sf):
    """References of the images that have a file (see ``fixtures.image_status``)."""
    gone = fx.image_status(spark, sf).where(F.col("status") == "missing").select("image")
    return fx.references(spark, sf).join(gone, "image", "left_anti")


def unknown_prediction_ids_q(spark, sf):
    """JN-5, ID-1: predictions whose image has no reference: those without a file."""
    preds = fx.predictions(spark, sf).select(image_id("image").alias("image_id"), "image")
    refs = _labelled_references(spark, sf).select(image_id("image").alias("image_id"))
    return unknown_prediction_ids(preds, refs)


def prediction_id_check(spark, sf):
    """JN-5, ID-1 (Q8): the figures that the checks of PIP-2 look at."""
    preds = fx.predictions(spark, sf).select(image_id("image").alias("image_id"), "image")
    refs = _labelled_references(spark, sf).select(image_id("image").alias("image_id"))
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("figure"), "n")
    out = one(preds, "predictions").unionByName(one(unknown_prediction_ids(preds, refs), "unknown_ids"))
    return out.unionByName(one(id_collisions(preds), "id_collisions"))


def duplicate_predictions(spark, sf):
    """JN-3: images that ``pair`` would refuse without an order: more than one prediction."""
    return duplicate_predictions_op(fx.attempts(spark, sf))


def score_coverage(spark, sf):
    """MET-7: coverage of predictions and references that each miss some images."""
    return metrics.coverage(_ok_predictions(spark, sf), _labelled_references(spark, sf))


def caption_tokens(spark, sf):
    """STR-7: caption tokens of every reference."""
    refs = fx.references(spark, sf)
    toks = caption_tokens_fn(F.col("caption"))
    return refs.select(
        "image", F.col("pos").cast("long").alias("pos"), F.array_join(toks, " ").alias("tokens"),
        F.size(toks).cast("long").alias("n_tokens"),
    )


def document_tokens(spark, sf):
    """STR-7 on whole texts: documents, benchmark items and conversation turns."""
    texts = fx.spread(fx.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    items = fx.table(spark, sf, "benchmark").select((F.lit(-1) - F.col("item_id")).alias("doc_id"), "text")
    turn_id = F.lit(-1_000_000_000) - F.col("conv_id") * 1000 - F.col("turn")
    turns = fx.table(spark, sf, "conversations").select(turn_id.alias("doc_id"), "text")
    lexed = texts.unionByName(items).unionByName(turns).select("doc_id", caption_tokens_fn(F.col("text")).alias("t"))
    return lexed.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("long").alias("n_tokens"))


def _generations(spark, sf):
    gen = caption_images(fx.image_content(spark, sf), text_captioner, PRESETS["greedy"])
    return postprocess(gen, PRESETS["greedy"])


def failures_by_status(spark, sf):
    """CAP-1: generation outcomes per status, from one pass."""
    return _generations(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def failed_images(spark, sf):
    """FLT-5: failed generations."""
    return failures(_generations(spark, sf)).select("image", "status")


def caption_images_stub(spark, sf):
    """CAP-1, CAP-2 with the deterministic stand-in captioner."""
    return _generations(spark, sf).select("image", "caption", "status")


def ngram_counts(spark, sf):
    """NGR-1, STR-5: n-gram counts of candidates and references (pos null for a candidate)."""
    p = metrics.pair(fx.scoring_predictions(spark, sf), fx.references(spark, sf, False))
    sides = metrics.candidate_grams(p).withColumns({"side": F.lit("candidate"), "pos": F.lit(None).cast("long")})
    sides = sides.unionByName(metrics.reference_grams(p).withColumns({"side": F.lit("reference"), "pos": F.col("pos").cast("long")}))
    return sides.select("image", "side", "pos", F.col("n").cast("long").alias("n"), "g", F.col("cnt").cast("long").alias("cnt"))


def document_frequency(spark, sf):
    """MET-6: images whose references hold each n-gram."""
    p = metrics.pair(fx.scoring_predictions(spark, sf), fx.references(spark, sf, False))
    d = metrics.reference_frequencies(p)
    return d.select(F.col("n").cast("long").alias("n"), "g", F.col("df").cast("long").alias("df"))


# ---------------------------------------------------------------- metrics


def _corpus(spark, sf, names, mode="whitespace"):
    scores = metrics.corpus_scores(_image_scores(spark, sf, mode))
    if names is not None:
        scores = pick_metrics(scores, names)
    return scores.select("metric", _r("score"))


def bleu_corpus(spark, sf):
    """MET-1, MET-2."""
    return _corpus(spark, sf, ["Bleu_1", "Bleu_2", "Bleu_3", "Bleu_4"])


def bleu_per_image(spark, sf):
    per = _image_scores(spark, sf)
    return per.select("image", *[_r(f"bleu_{k}") for k in range(1, 5)])


def rouge_l_per_image(spark, sf):
    """MET-3, MET-4, STR-6."""
    return _image_scores(spark, sf).select("image", _r("rouge_l"))


def rouge_l_corpus(spark, sf):
    return _corpus(spark, sf, ["ROUGE_L"])


def cider_per_image(spark, sf):
    """MET-5."""
    return _image_scores(spark, sf).select("image", _r("cider"))


def cider_corpus(spark, sf):
    return _corpus(spark, sf, ["CIDEr"])


def caption_scores(spark, sf):
    """MET-7: every metric, whitespace mode."""
    return _corpus(spark, sf, None)


def caption_scores_ptb(spark, sf):
    """MET-7 in caption-tokenizer mode (STR-7 for all three metrics)."""
    return _corpus(spark, sf, None, mode="caption")


def score_lines(spark, sf):
    """SNK-4, NUM-1, FLT-4: BLEU and CIDEr as report lines, times 100 with two digits."""
    scores = metrics.caption_scores(fx.scoring_predictions(spark, sf), fx.references(spark, sf, False))
    lines = score_report(scores, metrics=["Bleu_1", "Bleu_2", "Bleu_3", "Bleu_4", "CIDEr"])
    return lines.select("metric", "value", "line")


def batched_captions(spark, sf):
    """CAP-1 in batches: a captioner that takes 64 images a call, where one unreadable image fails the call."""
    gen = caption_images(fx.image_content(spark, sf), text_batch_captioner, PRESETS["greedy"])
    return postprocess(gen, PRESETS["greedy"]).select("image", "caption", "status")


def resumed_captions(spark, sf):
    """CAP-1, AGG-3 with a ledger: half of the images first, then all; the second run asks only for the rest."""
    images, ledger = fx.image_content(spark, sf), scratch_path(spark, "ledger")
    first = images.where(F.pmod(F.xxhash64("image"), F.lit(2)) == 0)
    caption_with_ledger(first, text_batch_captioner, PRESETS["greedy"], ledger, buckets=4)
    gen = postprocess(caption_with_ledger(images, text_batch_captioner, PRESETS["greedy"], ledger, buckets=4), PRESETS["greedy"])
    twice = cut(spark.read.parquet(ledger).groupBy("image").agg(F.count(F.lit(1)).alias("n")), "asked")
    return gen.join(twice, "image", "left").select("image", "caption", "status", F.coalesce("n", F.lit(0)).cast("long").alias("n_asked"))


def _presets_compared(spark, sf):
    preds = {"greedy": fx.scoring_predictions(spark, sf), "beam": fx.beam_predictions(spark, sf)}
    out = pick_metrics(compare_presets(preds, fx.references(spark, sf, False)), ["Bleu_4", "ROUGE_L", "CIDEr"])
    settings = decoding_presets(spark).withColumnRenamed("name", "preset")
    return out.join(settings, "preset")


def preset_comparison(spark, sf):
    """PIP-5, FLT-4, CAP-3: greedy vs beam predictions, same references, one job; with the presets' settings."""
    return _presets_compared(spark, sf).select(
        "preset", "metric", _r("score"), "prompt", F.col("num_beams").cast("long").alias("num_beams"),
        F.col("max_length").cast("long").alias("max_length"), F.col("min_length").cast("long").alias("min_length"),
        "repetition_penalty", "length_penalty", "first_sentence",
    )


def preset_captions(spark, sf):
    """CAP-1..3: every preset's captions of every readable image, beside its settings."""
    images = fx.image_content(spark, sf)
    each = [postprocess(caption_images(images, text_captioner, p), p).withColumn("name", F.lit(p.name)) for p in PRESETS.values()]
    done = scored_only(reduce(DataFrame.unionByName, each))
    return done.join(decoding_presets(spark), "name").select(
        "name", "image", "caption", "prompt", F.col("num_beams").cast("long").alias("num_beams"), F.col("max_new_tokens").cast("long").alias("max_new_tokens"),
        F.col("max_length").cast("long").alias("max_length"), F.col("min_length").cast("long").alias("min_length"), "repetition_penalty", "length_penalty",
        "first_sentence",
    )


def qualitative_rows(spark, sf):
    """JN-4, PIP-4, STR-8: rows of the positional test split at 3/4, 1/10 and 1/2 of it, and one past its end."""
    labels = cut(_positional_labels(spark, sf), "labels")
    test = by_split(labels, "test").select("image")
    n = test.count()
    rep = qualitative_report(fx.predictions(spark, sf), fx.references(spark, sf), test, (n * 3 // 4, n // 10, n // 2, n), unique=True)
    return rep.select(
        F.col("slot").cast("long").alias("slot"), F.col("idx").cast("long").alias("idx"), "found", "image", "reference", "prediction", "title"
    )


# ---------------------------------------------------------------- training


def _manifest_rows(spark, sf):
    return fx.manifest(spark, sf).select("filename", "split", raw_references("sentences").alias("refs"))


def _training(spark, sf):
    return prepare_training(_manifest_rows(spark, sf), fx.image_status(spark, sf))


def usable_samples(spark, sf):
    """FLT-3, PRJ-4: first captions of the train images that can be read."""
    return training_captions(_manifest_rows(spark, sf), fx.image_status(spark, sf))


def training_examples(spark, sf):
    """SFT-1..5, PIP-3: examples of the train images that can be read."""
    return _training(spark, sf).select("image", _ints_text("input_ids"), _ints_text("attention_mask"), _ints_text("labels"))


def training_labels_with_end(spark, sf):
    """SFT-4 (Q16), PIP-3 ``out``: labels that keep the true end token, written and read again."""
    out = scratch_path(spark, "training")
    got = prepare_training(_manifest_rows(spark, sf), fx.image_status(spark, sf), mask_eos=False, out=out)
    return got.select("image", _ints_text("labels"))


def training_batches(spark, sf):
    """SFT-6: batches of the samples that are left when bad ones are dropped."""
    train = manifest_split(_manifest_rows(spark, sf), "train").where(F.size("refs") > 0)
    samples = train.select(F.col("filename").alias("image")).join(fx.image_status(spark, sf), "image")
    batches = assemble_batches(samples)
    return batches.select(
        F.col("batch_id").cast("long").alias("batch_id"),
        F.col("n_examples").cast("long").alias("n_examples"),
        F.array_join("images", ",").alias("images"),
    )


def _stacked_text(c: str) -> F.Column:
    return F.array_join(F.transform(F.col(c), lambda row: F.array_join(F.transform(row, lambda x: x.cast("string")), ",")), ";").alias(c)


def stacked_batches(spark, sf):
    """SFT-6: batches as matrices of ids, masks and labels, one row per example."""
    batches = assemble_batches(_training(spark, sf))
    return batches.select(
        F.col("batch_id").cast("long").alias("batch_id"), F.array_join("images", ",").alias("images"), *(_stacked_text(c) for c in ("input_ids", "attention_mask", "labels"))
    )


def subword_round_trip(spark, sf):
    """SFT-1 with a sub-word tokenizer: every document encoded and decoded again."""
    tokenizer = read_tokenizer(spark, SUBWORD_VOCABULARY)
    docs = fx.spread(fx.table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    ids = encode(docs, "text", None, ["doc_id"], tokenizer=tokenizer)
    decoded = ids.select("doc_id", F.size("ids").alias("n"), tokenizer.decode(F.col("ids")).alias("text"))
    return decoded.select("doc_id", F.sha2("text", 256).alias("text_sha256"), (F.col("n") <= F.octet_length("text")).alias("no_longer_than_bytes"))


def subword_training_texts(spark, sf):
    """SFT-1..5 with a sub-word tokenizer: the captions that the labels of the examples spell, where they fit."""
    tokenizer = read_tokenizer(spark, SUBWORD_VOCABULARY)
    room = 512
    examples = prepare_training(_manifest_rows(spark, sf), fx.image_status(spark, sf), tokenizer=tokenizer, max_len=room)
    learned = F.filter("labels", lambda x: x >= 0)
    rows = examples.select("image", tokenizer.decode(learned).alias("caption"))
    return rows.where(F.octet_length("caption") < room)  # a token has at least one byte, so these are whole


def step_plan(spark, sf):
    """SFT-7: from a count of the usable samples alone."""
    return step_plan_op(training_captions(_manifest_rows(spark, sf), fx.image_status(spark, sf)))


# ---------------------------------------------------------------- files round trips


def coco_round_trip(spark, sf):
    """SNK-1, SNK-2, SRC-6, SRC-7: write COCO files, read all of them back."""
    folder = scratch_path(spark, "coco")
    preds = fx.predictions(spark, sf).select(image_id("image").alias("image_id"), "caption")
    refs = annotation_ids(fx.references(spark, sf)).select(image_id("image").alias("image_id"), "id", "caption")
    write_coco_predictions(preds, f"{folder}/predictions")
    write_coco_references(refs, f"{folder}/references")
    back_p = read_coco_predictions(spark, f"{folder}/predictions")
    back_r = read_coco_references(spark, f"{folder}/references")
    images = read_coco_images(spark, f"{folder}/references").select(F.col("id").alias("image_id"))
    counts = back_r.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_refs"))
    got = back_p.join(images, "image_id").join(counts, "image_id")
    return got.select("image_id", "caption", F.col("n_refs").cast("long").alias("n_refs"))


def _evaluated_manifest(spark, sf):
    return evaluate_manifest(_manifest_rows(spark, sf), fx.image_content(spark, sf), text_captioner, PRESETS["zero_shot"])


def evaluate_manifest_q(spark, sf):
    """PIP-1: manifest test split, stand-in captioner, whitespace-mode scores."""
    return _evaluated_manifest(spark, sf).scores.select("metric", _r("score"))


def evaluate_manifest_coverage(spark, sf):
    """PIP-1: images scored, and status rows of every image of the split."""
    job = _evaluated_manifest(spark, sf)
    status = job.generations.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("status_"), "status").alias("figure"), "n")
    names = ["scored_images", "unreferenced_predictions", "unpredicted_images"]
    figures = job.coverage.unpivot([], names, "figure", "n")
    return status.unionByName(figures)


def evaluate_captions_q(spark, sf):
    """PIP-2, SRC-1, SNK-3: caption CSV round trip, positional test split, COCO files, caption-mode scores."""
    folder = scratch_path(spark, "captions")
    write_captions(fx.references(spark, sf), f"{folder}/captions")
    caps = cut(read_captions(spark, f"{folder}/captions"), "captions")  # parsed once
    n = unique_images_op(caps).count()
    job = evaluate_captions(
        caps, fx.image_content(spark, sf), text_captioner, PRESETS["greedy"], out=f"{folder}/coco",
        sizes=(n * 6 // 10, n * 2 // 10),
    )
    return job.scores.select("metric", _r("score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "captions_grouped": captions_grouped,
    "unique_images": unique_images,
    "image_slice": image_slice,
    "first_captions": first_captions,
    "positional_split_counts": positional_split_counts,
    "test_split_captions": test_split_captions,
    "manifest_split_rows": manifest_split_rows,
    "image_ordinals": image_ordinals,
    "annotation_rows": annotation_rows,
    "clean_captions": clean_captions,
    "token_key_split": token_key_split,
    "caption_token_file": caption_token_file,
    "split_manifest_file": split_manifest_file,
    "caption_csv": caption_csv,
    "json_captions": json_captions,
    "image_listing": image_listing,
    "image_validity": image_validity,
    "picture_check": picture_check,
    "csv_documents": csv_documents,
    "image_presence": image_presence,
    "latest_predictions": latest_predictions,
    "duplicate_predictions": duplicate_predictions,
    "paired_captions": paired_captions,
    "references_for_predicted": references_for_predicted,
    "unknown_prediction_ids": unknown_prediction_ids_q,
    "prediction_id_check": prediction_id_check,
    "score_coverage": score_coverage,
    "caption_tokens": caption_tokens,
    "document_tokens": document_tokens,
    "failures_by_status": failures_by_status,
    "failed_images": failed_images,
    "caption_images_stub": caption_images_stub,
    "batched_captions": batched_captions,
    "resumed_captions": resumed_captions,
    "ngram_counts": ngram_counts,
    "document_frequency": document_frequency,
    "bleu_corpus": bleu_corpus,
    "bleu_per_image": bleu_per_image,
    "rouge_l_per_image": rouge_l_per_image,
    "rouge_l_corpus": rouge_l_corpus,
    "cider_per_image": cider_per_image,
    "cider_corpus": cider_corpus,
    "caption_scores": caption_scores,
    "caption_scores_ptb": caption_scores_ptb,
    "score_lines": score_lines,
    "preset_comparison": preset_comparison,
    "preset_captions": preset_captions,
    "qualitative_rows": qualitative_rows,
    "usable_samples": usable_samples,
    "training_examples": training_examples,
    "training_labels_with_end": training_labels_with_end,
    "training_batches": training_batches,
    "stacked_batches": stacked_batches,
    "subword_round_trip": subword_round_trip,
    "subword_training_texts": subword_training_texts,
    "step_plan": step_plan,
    "coco_round_trip": coco_round_trip,
    "evaluate_manifest": evaluate_manifest_q,
    "evaluate_manifest_coverage": evaluate_manifest_coverage,
    "evaluate_captions": evaluate_captions_q,
}
