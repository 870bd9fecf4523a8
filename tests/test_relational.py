"""Splits, ordinals, pairing, SFT and the captioner on small tables."""

import pytest
from pyspark.sql import functions as F

from captally.operators.captioner import PRESETS, caption_images, decoding_presets, postprocess, text_captioner
from captally.operators.ordinals import annotation_ids, at_positions, image_ordinal, ordinals, slice_images
from captally.operators.pairing import (
    caption_positions,
    check_id_collisions,
    check_prediction_ids,
    drop_bad_samples,
    failures,
    group_captions,
    latest_prediction,
    pick_metrics,
    references_for,
    scored_only,
    unknown_prediction_ids,
)
from captally.operators.sft import (
    IGNORE_INDEX,
    assemble_batches,
    build_vocab,
    encode,
    mask_labels,
    step_plan,
    training_examples,
    truncate_pad,
)
from captally.operators.splits import by_split, positional_split, split_counts
from captally.plans.evaluation import evaluate_manifest
from captally.plans.report import score_report
from captally.plans.training import training_captions


def images(spark, n):
    return spark.createDataFrame([(f"img{i:05d}.jpg", i % 3, f"cap {i}") for i in range(n)], "image string, pos int, caption string")


def test_ordinals_dense_and_no_single_partition(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("image"))
    got = ordinals(df, ["image"], "o")
    rows = sorted((r.image, r.o) for r in got.collect())
    assert [o for _, o in rows] == list(range(5000))
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_positional_split_disjoint_and_complete(spark):
    labels = positional_split(images(spark, 100), (60, 20))
    counts = {r.split: r.n_images for r in split_counts(labels).collect()}
    assert counts == {"train": 60, "val": 20, "test": 20}
    # fewer images than the cut: everything is train, test is empty
    small = positional_split(images(spark, 10), (60, 20))
    assert {r.split for r in small.collect()} == {"train"}


def test_unknown_split_raises(spark):
    with pytest.raises(ValueError):
        by_split(images(spark, 3).withColumn("split", F.lit("train")), "holdout")


def test_image_ordinal_per_split_and_slices(spark):
    labels = positional_split(images(spark, 30), (10, 10)).select("image", "split")
    per = image_ordinal(labels, "split")
    for split in ("train", "val", "test"):
        got = sorted(r.ordinal for r in per.where(F.col("split") == split).collect())
        assert got == list(range(10))
    sl = slice_images(images(spark, 30), 5, 8)
    assert sorted(r.image for r in sl.collect()) == ["img00005.jpg", "img00006.jpg", "img00007.jpg"]
    ranked = ordinals(images(spark, 30).select("image"), ["image"], "ordinal")
    picked = at_positions(ranked, [12, 3, 99]).collect()
    assert [(r.slot, r.image, r.found) for r in picked] == [(0, "img00012.jpg", True), (1, "img00003.jpg", True), (2, None, False)]


def test_annotation_ids_dense_over_image_then_pos(spark):
    refs = spark.createDataFrame([("b", 1, "x"), ("a", 0, "y"), ("b", 0, "z"), ("a", 2, "w")], "image string, pos int, caption string")
    got = [(r.image, r.pos, r.id) for r in annotation_ids(refs).orderBy("id").collect()]
    assert got == [("a", 0, 0), ("a", 2, 1), ("b", 0, 2), ("b", 1, 3)]


def test_group_captions_ordered_and_chunked(spark):
    refs = spark.createDataFrame([("a", p, f"c{p}") for p in (5, 1, 9, 3)], "image string, pos long, caption string")
    g = group_captions(refs, chunk=3).orderBy("chunk").collect()
    assert [(r.chunk, r.captions) for r in g] == [(0, ["c1", "c3", "c5"]), (1, ["c9"])]
    ranks = sorted((r.pos, r.rank) for r in caption_positions(refs).collect())
    assert ranks == [(1, 0), (3, 1), (5, 2), (9, 3)]


def test_latest_prediction_last_write_wins(spark):
    att = spark.createDataFrame([("a", 0, "old"), ("a", 2, "new"), ("a", 1, "mid"), ("b", 0, "only")], "image string, pos int, caption string")
    got = {r.image: (r.caption, r.attempts) for r in latest_prediction(att).collect()}
    assert got == {"a": ("new", 3), "b": ("only", 1)}


def test_references_for_predicted(spark):
    refs = images(spark, 6)
    preds = spark.createDataFrame([("img00001.jpg", "x"), ("nope.jpg", "y")], "image string, caption string")
    assert [r.image for r in references_for(refs, preds).collect()] == ["img00001.jpg"]


def test_captioner_statuses_and_postprocess(spark):
    imgs = spark.createDataFrame(
        [("ok.jpg", bytearray(b"  A dog runs. Then more.")), ("miss.jpg", None), ("bad.jpg", bytearray(b"\xff\xfe"))],
        "image string, content binary",
    )
    gen = postprocess(caption_images(imgs, text_captioner, PRESETS["greedy"]), PRESETS["greedy"])
    got = {r.image: (r.caption, r.status) for r in gen.collect()}
    assert got == {"ok.jpg": ("A dog runs.", "ok"), "miss.jpg": (None, "missing"), "bad.jpg": (None, "error")}
    assert [r.image for r in scored_only(gen).collect()] == ["ok.jpg"]
    assert sorted(r.image for r in failures(gen).collect()) == ["bad.jpg", "miss.jpg"]
    assert [r.image for r in drop_bad_samples(gen).collect()] == ["ok.jpg"]
    assert decoding_presets(spark).count() == 5


def test_sft_masks_and_padding(spark):
    df = spark.createDataFrame([([5, 6, 2, 2],)], "ids array<int>")
    assert df.select(mask_labels(F.col("ids"), F.lit(1))).first()[0] == [IGNORE_INDEX, 6, IGNORE_INDEX, IGNORE_INDEX]
    assert df.select(truncate_pad(F.col("ids"), 3)).first()[0] == [5, 6, 2]
    assert df.select(truncate_pad(F.col("ids"), 6)).first()[0] == [5, 6, 2, 2, 2, 2]


def test_training_examples_batches_and_plan(spark):
    caps = spark.createDataFrame([(f"i{k}", "a dog runs" if k % 2 else "") for k in range(9)], "image string, caption string")
    vocab = build_vocab(caps)
    assert {r.token: r.id for r in vocab.collect()} == {"a": 3, "dog": 4, "runs": 5}
    ex = {r.image: r for r in training_examples(caps, "Describe a dog.", vocab, max_len=6).collect()}
    row = ex["i1"]
    # prompt = [1, 0, 3, 0] (begin, unknown, 'a', unknown); caption = [1, 3, 4, 5, 2, 2]
    assert row.input_ids == [1, 0, 3, 0, 1, 3, 4, 5, 2, 2]
    assert row.attention_mask == [1, 1, 1, 1, 1, 1, 1, 1, 1, 0]
    assert row.labels == [-100, -100, -100, -100, 1, 3, 4, 5, -100, -100]
    assert ex["i0"].input_ids[4:] == [1, 2, 2, 2, 2, 2]
    batches = assemble_batches(training_examples(caps, "p", vocab)).orderBy("batch_id").collect()
    assert [r.n_examples for r in batches] == [4, 4, 1]
    plan = step_plan(training_examples(caps, "p", vocab), batch=4, accum=4, epochs=3).first()
    assert (plan.n_examples, plan.batches_per_epoch, plan.steps_per_epoch, plan.total_steps) == (9, 3, 1, 3)


def test_score_report_and_pick(spark):
    scores = spark.createDataFrame([("Bleu_4", 0.25), ("CIDEr", 0.9412)], "metric string, score double")
    rep = {r.metric: r.line for r in score_report(scores).collect()}
    assert rep == {"Bleu_4": "Bleu_4: 25.00", "CIDEr": "CIDEr: 94.12"}
    assert [r.metric for r in pick_metrics(scores, ["CIDEr"]).collect()] == ["CIDEr"]
    rep3 = {r.metric: r.line for r in score_report(scores, 1.0, 3).collect()}
    assert rep3["CIDEr"] == "CIDEr: 0.941"


def test_step_plan_that_does_not_divide(spark):
    """117 images in batches of 4 and rounds of 4: 30 batches, 7 whole rounds an epoch."""
    plan = step_plan(spark.range(117)).first()
    assert (plan.batches_per_epoch, plan.steps_per_epoch, plan.total_steps) == (30, 7, 21)


def test_end_token_can_be_learned(spark):
    caps = spark.createDataFrame([("i", "a dog")], "image string, caption string")
    vocab = build_vocab(caps)
    masked, kept = (training_examples(caps, "p", vocab, 6, mask_eos=m).first().labels for m in (True, False))
    assert masked == [-100, -100, 1, 3, 4, -100, -100, -100]
    assert kept == [-100, -100, 1, 3, 4, 2, -100, -100]


def test_long_text_is_cut_before_lookup(spark):
    caps = spark.createDataFrame([("i", "a b " * 500)], "image string, caption string")
    vocab = build_vocab(caps)
    row = training_examples(caps, "p", vocab, 5).first()
    assert row.input_ids == [1, 0, 1, 3, 4, 3, 4]


def test_encode_hot_tokens(spark):
    caps = spark.createDataFrame([(i, "the cat " * 20 if i % 2 else "") for i in range(30)], "image int, caption string")
    vocab = build_vocab(caps)
    want = {r.image: r.ids for r in encode(caps, "caption", vocab, ["image"]).collect()}
    spark.conf.set("captally.skew.hotKeyRows", "10")
    try:
        got = {r.image: r.ids for r in encode(caps, "caption", vocab, ["image"]).collect()}
        assert [r.image for r in references_for(images(spark, 6), images(spark, 2)).orderBy("image").collect()] == ["img00000.jpg", "img00001.jpg"]
    finally:
        spark.conf.unset("captally.skew.hotKeyRows")
    assert got == want and want[0] == [1] and want[1] == [1] + [4, 3] * 20


def test_bad_samples_leave_training(spark):
    manifest = spark.createDataFrame([(f"i{k}", "train", [f"cap {k}"]) for k in range(4)] + [("none", "train", [])], "filename string, split string, refs array<string>")
    status = spark.createDataFrame([("i0", "ok"), ("i1", "missing"), ("i2", "error"), ("i3", "ok"), ("none", "ok")], "image string, status string")
    assert sorted(r.image for r in training_captions(manifest, status).collect()) == ["i0", "i3"]


def test_unknown_ids_and_collisions_stop_the_job(spark):
    preds = spark.createDataFrame([(1, "a"), (2, "b")], "image_id long, image string")
    refs = spark.createDataFrame([(1, "a")], "image_id long, image string")
    assert [r.image_id for r in unknown_prediction_ids(preds, refs).collect()] == [2]
    with pytest.raises(ValueError, match="1 prediction"):
        check_prediction_ids(preds, refs)
    check_prediction_ids(refs, preds)
    clash = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "image_id long, image string")
    with pytest.raises(ValueError, match="1 image_id"):
        check_id_collisions(clash)
    check_id_collisions(preds)


def test_captioner_is_made_once_per_worker(spark, tmp):
    """16 partitions on 4 cores: no more factory calls than Python workers."""
    import os

    def factory(preset):
        import tempfile

        tempfile.mkstemp(prefix="made-", dir=tmp)
        return lambda blob: "caption."

    imgs = spark.range(64).selectExpr("concat('i', id) as image", "cast('x' as binary) as content").repartition(16)
    assert caption_images(imgs, factory, PRESETS["greedy"]).where("status = 'ok'").count() == 64
    assert 1 <= len(os.listdir(tmp)) <= 8


def test_evaluation_reports_every_image_of_the_split(spark):
    rows = [("a", "test", ["a dog runs"]), ("b", "test", ["cat"]), ("c", "test", ["gone"]), ("d", "train", ["x"]), ("e", "test", [])]
    manifest = spark.createDataFrame(rows, "filename string, split string, refs array<string>")
    files = [("a", bytearray(b"a dog")), ("b", bytearray(b"\xff")), ("d", bytearray(b"x")), ("e", bytearray(b"e"))]
    imgs = spark.createDataFrame(files, "image string, content binary")
    job = evaluate_manifest(manifest, imgs, text_captioner)
    assert {r.image: r.status for r in job.generations.collect()} == {"a": "ok", "b": "error", "c": "missing", "e": "ok"}
    assert tuple(job.coverage.first()) == (1, 1, 2)
    assert job.scores.count() == 6


def test_generations_run_once(spark):
    from captally import queries

    plan = queries.failures_by_status(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_scratch_is_removed(spark):
    import os

    from captally.operators import materialize

    path = materialize.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.exists(local)
    keep, materialize._WRITTEN[:] = [p for p in materialize._WRITTEN if p != path], [path]
    assert materialize.remove_scratch() == 1 and not os.path.exists(local)
    materialize._WRITTEN[:] = keep
