"""SNK-4 score report and PIP-4 qualitative rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captally.functions.text import plot_title, scale_round
from captally.operators.materialize import cut
from captally.operators.ordinals import at_positions
from captally.operators.pairing import pick_metrics

# Rows the qualitative viewer shows by default.
DEFAULT_INDICES = (1090, 50, 200)


def score_report(scores: DataFrame, scale: float = 100.0, digits: int = 2, metrics: Sequence[str] | None = None) -> DataFrame:
    """SNK-4: (metric, value, line) with ``value = round(score * scale, digits)``."""
    if metrics is not None:
        scores = pick_metrics(scores, metrics)
    value = scale_round("score", scale, digits)
    return scores.select(
        "metric",
        value.alias("value"),
        F.format_string(f"%s: %.{digits}f", F.col("metric"), value).alias("line"),
    )


def qualitative_report(
    preds: DataFrame, refs: DataFrame, images: DataFrame, indices: Sequence[int] = DEFAULT_INDICES, unique: bool = False
) -> DataFrame:
    """PIP-4: chosen rows of ``images`` by position in name order.

    (slot, idx, found, image, reference, prediction, title): ``reference`` is
    the first reference in ``pos`` order; rows come in the requested order,
    with ``found`` false for a position past the end.  The rows are found by
    selection; no other image is sorted, numbered or written (``unique`` says
    that there is one row per image already, else the names are made distinct).
    """
    names = images.select("image")
    names = names if unique else cut(names.distinct(), "images")
    # One row per requested index: small by what was asked for, so only its images' rows are read on.
    chosen = cut(at_positions(names, indices, "idx"), "chosen")
    names = F.broadcast(chosen.select("image").distinct())
    first_ref = refs.join(names, "image", "left_semi").groupBy("image").agg(F.min_by("caption", "pos").alias("reference"))
    preds = preds.join(names, "image", "left_semi")
    return (
        chosen.join(first_ref, "image", "left")
        .join(preds.select("image", F.col("caption").alias("prediction")), "image", "left")
        .select("slot", "idx", "found", "image", "reference", "prediction", plot_title("idx", "prediction").alias("title"))
        .orderBy("slot")
    )
