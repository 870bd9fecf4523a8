"""Grouping, pairing and filtering of captions, predictions and failures.

AGG-1..4, JN-2/JN-5, PRJ-4, FLT-2..5.  The pairing join itself (JN-3) and
the scored-image restriction live in ``metrics.pair``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captally.operators.ordinals import ordinals
from captally.operators.skew import skew_join

# Captions per grouped row.  The output key is (image, chunk): an image with
# millions of captions becomes many bounded rows, not one.
GROUP_CHUNK = 64


def caption_positions(captions: DataFrame, order: str = "pos") -> DataFrame:
    """Dense 0-based place of each caption inside its image (file order)."""
    ranked = ordinals(captions, ["image", order], "_g")
    starts = ranked.groupBy("image").agg(F.min("_g").alias("_s"))
    return ranked.join(starts, "image").withColumn("rank", (F.col("_g") - F.col("_s")).cast("int")).drop("_g", "_s")


def group_captions(captions: DataFrame, chunk: int = GROUP_CHUNK, dense: bool = False) -> DataFrame:
    """AGG-1: image -> captions in order, as (image, chunk, n_captions, captions).

    ``dense=True`` means ``pos`` is already 0..k-1 inside each image;
    otherwise the dense rank is computed first.  Each output row holds at
    most ``chunk`` captions, so no task ever gathers an unbounded group.
    """
    ranked = captions.withColumn("rank", F.col("pos").cast("int")) if dense else caption_positions(captions)
    grouped = ranked.groupBy("image", F.floor(F.col("rank") / chunk).cast("int").alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "caption"))).alias("_c")
    )
    return grouped.select(
        "image", "chunk", F.size("_c").alias("n_captions"), F.transform("_c", lambda s: s["caption"]).alias("captions")
    )


def unique_images(df: DataFrame) -> DataFrame:
    """AGG-2: distinct image names."""
    return df.select("image").distinct()


def latest_prediction(attempts: DataFrame, order: str = "pos", keys: Sequence[str] = ("image",)) -> DataFrame:
    """AGG-3: keyed upsert, last write wins: (image, caption, attempts).

    ``max_by`` is a partial aggregate, so an image with many attempts is
    combined map-side.
    """
    return attempts.groupBy(*keys).agg(
        F.max_by("caption", order).alias("caption"), F.count(F.lit(1)).alias("attempts")
    )


def duplicate_predictions(preds: DataFrame, keys: Sequence[str] = ("image",)) -> DataFrame:
    """(keys..., n_predictions) of the images with more than one prediction."""
    counted = preds.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_predictions"))
    return counted.where(F.col("n_predictions") > 1)


def explode_annotations(grouped: DataFrame, refs: str = "refs") -> DataFrame:
    """AGG-4: (image, refs array) -> one row per (image, pos, caption)."""
    return grouped.select("image", F.posexplode(refs).alias("pos", "caption"))


def first_caption(refs) -> Column:
    """PRJ-4: first caption of a list; null for an empty list (no error)."""
    return F.get(F.col(refs) if isinstance(refs, str) else refs, 0)


def references_for(refs: DataFrame, preds: DataFrame) -> DataFrame:
    """JN-2: references of the predicted images (hot images joined map-side)."""
    keys = preds.select("image").distinct()
    return skew_join(refs, keys, ["image"], "left_semi")


def unknown_prediction_ids(preds: DataFrame, refs: DataFrame, key: str = "image_id") -> DataFrame:
    """JN-5: predictions whose id has no reference."""
    return preds.join(refs.select(key).distinct(), key, "left_anti")


def check_prediction_ids(preds: DataFrame, refs: DataFrame, key: str = "image_id") -> None:
    """JN-5: raise if any prediction id is unknown; ``unknown_prediction_ids`` is the full list."""
    n = unknown_prediction_ids(preds, refs, key).count()
    if n:
        raise ValueError(f"{n} prediction(s) have a {key} that the references lack")


def id_collisions(images: DataFrame, key: str = "image_id") -> DataFrame:
    """ID-1 (Q8): ids that stand for more than one image, as (key, n_images)."""
    once = images.select(key, "image").distinct()
    return once.groupBy(key).agg(F.count(F.lit(1)).alias("n_images")).where(F.col("n_images") > 1)


def check_id_collisions(images: DataFrame, key: str = "image_id") -> None:
    """Raise if two images share an id: scoring by id would merge them."""
    n = id_collisions(images, key).count()
    if n:
        raise ValueError(f"{n} {key} value(s) stand for more than one image")


def existing_images(df: DataFrame, listing: DataFrame) -> DataFrame:
    """FLT-2: rows whose image file exists (one listing, not a stat per row)."""
    return df.join(listing.select("image").distinct(), "image", "left_semi")


def missing_images(df: DataFrame, listing: DataFrame) -> DataFrame:
    """FLT-2 companion: rows whose image file is missing."""
    return df.join(listing.select("image").distinct(), "image", "left_anti")


def drop_bad_samples(df: DataFrame) -> DataFrame:
    """FLT-3: keep samples whose status is ``ok``."""
    return df.where(F.col("status") == "ok")


def pick_metrics(scores: DataFrame, names: Sequence[str]) -> DataFrame:
    """FLT-4: whitelist of metric names."""
    return scores.where(F.col("metric").isin(list(names)))


def scored_only(df: DataFrame) -> DataFrame:
    """FLT-5: generations without an error."""
    return df.where(F.col("error").isNull() & (F.col("status") == "ok"))


def failures(df: DataFrame) -> DataFrame:
    """FLT-5 companion: failed generations."""
    return df.where(F.col("error").isNotNull() | (F.col("status") != "ok"))
