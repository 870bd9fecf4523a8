"""SRC-6/SRC-7: read COCO-style prediction and reference files back.

The default is sharded JSON lines.  ``document=True`` reads files that hold one
JSON value each (an array, or one ``{images, annotations}`` object); such a file
is read by one task.  A malformed file is an error in both forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREDICTION = T.StructType([T.StructField("image_id", T.LongType()), T.StructField("caption", T.StringType())])
ANNOTATION = T.StructType(
    [
        T.StructField("image_id", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("caption", T.StringType()),
    ]
)
REFERENCES = T.StructType(
    [
        T.StructField("images", T.ArrayType(T.StructType([T.StructField("id", T.LongType())]))),
        T.StructField("annotations", T.ArrayType(ANNOTATION)),
    ]
)


def read_coco_predictions(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """SRC-6: (image_id, caption)."""
    return spark.read.schema(PREDICTION).option("multiLine", document).option("mode", "FAILFAST").json(path)


def read_coco_references(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """SRC-7: (image_id, id, caption) of the annotations."""
    reader = spark.read.option("mode", "FAILFAST")
    if not document:
        return reader.schema(ANNOTATION).json(f"{path.rstrip('/')}/annotations")
    return reader.schema(REFERENCES).option("multiLine", True).json(path).select(F.inline("annotations"))


def read_coco_images(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: the ids of the ``images`` table written beside the annotations."""
    return spark.read.schema("id long").option("mode", "FAILFAST").json(f"{path.rstrip('/')}/images")
