"""Writers: COCO-style predictions/references and caption CSV (SNK-1..3).

Files are sharded JSON lines (or CSV parts) written by every task in
parallel; ``read_coco_predictions``/``read_coco_references`` read them back.  A
tool that wants one JSON array can join the lines outside of Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_coco_predictions(preds: DataFrame, path: str) -> None:
    """SNK-1: predictions (image_id, caption) as COCO results."""
    preds.select(F.col("image_id").cast("long").alias("image_id"), "caption").write.mode("overwrite").json(path)


def write_coco_references(refs: DataFrame, path: str) -> None:
    """SNK-2: references (image_id, id, caption) as a COCO ground-truth set.

    ``<path>/images`` holds the distinct ids, ``<path>/annotations`` the rows
    (image_id, id, caption).
    """
    ann = refs.select(F.col("image_id").cast("long").alias("image_id"), F.col("id").cast("long").alias("id"), "caption")
    ann.write.mode("overwrite").json(f"{path.rstrip('/')}/annotations")
    ann.select(F.col("image_id").alias("id")).distinct().write.mode("overwrite").json(f"{path.rstrip('/')}/images")


def write_captions(df: DataFrame, path: str) -> None:
    """SNK-3: (image, caption) CSV with a header, quotes doubled."""
    df.select("image", "caption").write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"'
    ).csv(path)
