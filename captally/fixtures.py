"""Caption-shaped views derived from the driver's tables (see FIXTURES.md).

The driver ships TPC-H-like tables plus ``documents`` and ``conversations``;
nothing is image-caption shaped, so the evaluation inputs are derived from
the prose, by rules that Spark and DuckDB can both state:

* ``sentences``: each document split on '.' or newline, spaces trimmed,
  empties dropped; documents with at least one sentence.  Whole texts: every
  sentence of every document is kept.
* ``references``: image ``img<doc_id:08d>.jpg``, one reference per sentence.
* ``raw_predictions``: tokens of sentence 0 without every fifth one, then
  ``. `` + sentence 1 (empty if there is none) + ``.``, padded with spaces.
* ``predictions``: raw predictions after strip + first-sentence rule (CAP-2).
* ``scoring_predictions``: predictions without their final '.'.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captally.functions.text import first_sentence, strip_text
from captally.operators.materialize import scratch_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def image_name(doc_id) -> F.Column:
    return F.concat(F.lit("img"), F.lpad(doc_id.cast("string"), 8, "0"), F.lit(".jpg"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread rows over the shuffle partitions (AQE may coalesce them).

    The driver's files hold each table in very few row groups, so a scan
    yields one or two input splits; without this every per-document step
    after the scan would run in one task.
    """
    return df.repartition(*keys)


def sentence_arrays(spark: SparkSession, sf_dir: str, spread_first: bool = True) -> DataFrame:
    """(doc_id, image, sents array<string>) for documents with a sentence; texts stay where they were read without ``spread_first``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    if spread_first:
        docs = spread(docs, "doc_id")
    sents = F.filter(F.transform(F.split(F.col("text"), "[.\n]"), lambda s: F.trim(s)), lambda s: s != "")
    return (
        docs.select("doc_id", sents.alias("sents"))
        .where(F.size("sents") >= 1)
        .select("doc_id", image_name(F.col("doc_id")).alias("image"), "sents")
    )


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, sentence)."""
    return sentence_arrays(spark, sf_dir).select("doc_id", F.posexplode("sents").alias("pos", "sentence"))


def references(spark: SparkSession, sf_dir: str, spread_first: bool = True) -> DataFrame:
    """(image, pos, caption): every sentence of a document is a reference."""
    return sentence_arrays(spark, sf_dir, spread_first).select(
        "image", F.posexplode("sents").alias("pos", "caption")
    ).withColumn("pos", F.col("pos").cast("int"))


def raw_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, doc_id, raw): a noisy two-sentence model output per image."""
    arr = sentence_arrays(spark, sf_dir, spread_first=False)
    kept = F.filter(F.split(F.get(F.col("sents"), 0), " "), lambda t, i: i % 5 != 4)
    raw = F.concat(F.lit(" "), F.array_join(kept, " "), F.lit(". "), F.coalesce(F.get(F.col("sents"), 1), F.lit("")), F.lit(". "))
    return spread(arr.select("image", "doc_id", raw.alias("raw")), "doc_id")  # not the whole texts


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, caption): CAP-2 applied to the raw output."""
    return raw_predictions(spark, sf_dir).select("image", first_sentence(strip_text("raw")).alias("caption"))


def scoring_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, caption) with the final '.' removed, as scored."""
    return predictions(spark, sf_dir).select("image", F.regexp_replace("caption", "[.]$", "").alias("caption"))


def beam_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second decoding preset: strip only, no first-sentence rule."""
    return raw_predictions(spark, sf_dir).select("image", strip_text("raw").alias("caption"))


# Manifest split label by document language.
SPLIT_BY_LANG = {"en": "train", "es": "val", "fr": "test", "de": "test"}


def split_label(lang) -> F.Column:
    out = F.lit(None).cast("string")
    expr = None
    for k, v in SPLIT_BY_LANG.items():
        expr = (F.when(lang == k, v) if expr is None else expr.when(lang == k, v))
    return expr.otherwise(out)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split manifest flattened to (ordinal, filename, split, sentences).

    Every document is an image (also those with fewer than two sentences,
    so images with one or no reference occur); ``sentences`` has the nested
    ``array<struct<raw>>`` shape of the manifest format.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")
    sents = F.filter(F.transform(F.split(F.col("text"), "[.\n]"), lambda s: F.trim(s)), lambda s: s != "")
    return docs.select(
        F.col("doc_id").alias("ordinal"),
        image_name(F.col("doc_id")).alias("filename"),
        split_label(F.col("lang")).alias("split"),
        F.transform(sents, lambda s: F.struct(s.alias("raw"))).alias("sentences"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, pos, caption): an older beam attempt for every image and a
    newer greedy one where the document has an even number of sentences."""
    arr = sentence_arrays(spark, sf_dir)
    raw = raw_predictions(spark, sf_dir)
    both = raw.join(arr.select("image", F.size("sents").alias("k")), "image")
    older = both.select("image", F.lit(0).alias("pos"), strip_text("raw").alias("caption"))
    newer = both.where(F.col("k") % 2 == 0).select(
        "image", F.lit(1).alias("pos"), first_sentence(strip_text("raw")).alias("caption")
    )
    return older.unionByName(newer)


def image_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, content): document bytes standing in for image files.

    A document labelled quality 0 has no file (null content); one labelled
    toxic has unreadable bytes (a 0xFF lead byte is never valid UTF-8).
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    body = F.encode(F.col("text"), "UTF-8")
    content = (
        F.when(F.col("quality") == 0, F.lit(None).cast("binary"))
        .when(F.col("toxic") == 1, F.concat(F.unhex(F.lit("FF")), body))
        .otherwise(body)
    )
    return docs.join(labels, "doc_id", "left").select(image_name(F.col("doc_id")).alias("image"), content.alias("content"))


# Fixed value: a WBMP picture of 8 x 1 pixels, all but its last byte.
WBMP_HEAD, WBMP_PIXELS = "\x00\x00\x08\x01", "U"


#: Sub-folders of the image folder; a folder a picture would make the listing as slow as a job for each.
IMAGE_FOLDERS = 256


def image_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of image files ``<part>/<name>``, one per document that has a file.

    A document labelled quality 0 has no file, one labelled toxic has a file
    that is no picture; every other file is a tiny valid one.  Rows of one
    image are one file, one after the other.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("size"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    rows = docs.join(labels, "doc_id", "left").where(F.coalesce("quality", F.lit(1)) == 1)
    image = F.coalesce(image_name(F.col("doc_id")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    part = F.pmod(F.xxhash64("image"), F.lit(IMAGE_FOLDERS)).cast("int")
    junk = F.when(F.col("toxic") == 1, F.coalesce("size", F.lit(0))).otherwise(F.lit(-1))
    rows = rows.select(image.alias("image"), junk.alias("junk")).withColumn("part", part)
    folder = scratch_path(spark, "images")
    spark.range(0).select(F.col("id").cast("string")).write.text(folder)
    # A write of many tiny files is latency: a fixed number of tasks that Spark does not merge.
    rows = rows.repartition(IMAGE_FOLDERS, "part").sortWithinPartitions("part", "image")
    made = rows.mapInArrow(lambda batches: _write_images(folder, batches), "n long")
    made.agg(F.sum("n")).collect()
    return folder


def _write_images(folder: str, batches):
    from pyarrow import fs

    local = "/" + folder.removeprefix("file:").lstrip("/")
    store, top = fs.FileSystem.from_uri(folder) if "://" in folder and not folder.startswith("file:") else (fs.LocalFileSystem(), local)
    n, seen, last, body = 0, set(), None, []

    def write():
        if last is None:
            return
        if last[0] not in seen:
            seen.add(last[0])
            store.create_dir(f"{top}/part-{last[0]}", recursive=True)
        name = last[1]
        if name.startswith("_"):  # Spark reads no file of such a name, but a folder image=<name> (null ids)
            store.create_dir(f"{top}/part-{last[0]}/image={name}", recursive=True)
            name = f"image={name}/file"
        with store.open_output_stream(f"{top}/part-{last[0]}/{name}") as f:
            for size in body:
                f.write((WBMP_HEAD if size < 0 else "?" * size).encode() + WBMP_PIXELS.encode())

    for b in batches:
        for part, image, junk in zip(*(b[c].to_pylist() for c in ("part", "image", "junk"))):
            if (part, image) != last:
                write()
                n, last, body = n + 1, (part, image), []
            body.append(junk)
    write()
    yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})


# Small whole pictures, as hex: an RGB, a 16-bit grey and a palette PNG of 2 x 2, a CMYK JPEG of 8 x 8.
PICTURES = {
    "rgb": (
        "89504E470D0A1A0A0000000D4948445200000002000000020802000000FDD49A730000001174455874436F6D6D656E74006D6164652068657265977E"
        "EE260000000549444154789C6360402B08F39500000006494441540600000E00019B36E7410000000049454E44AE426082"
    ),
    "grey16": (
        "89504E470D0A1A0A0000000D4948445200000002000000021000000000074D8EBB0000001174455874436F6D6D656E74006D6164652068657265977E"
        "EE260000000549444154789C636080B06C312500000006494441540100000A0001813A7F250000000049454E44AE426082"
    ),
    "palette": (
        "89504E470D0A1A0A0000000D49484452000000020000000208030000004568FD1600000030504C5445000102030405060708090A0B0C0D0E0F101112"
        "131415161718191A1B1C1D1E1F202122232425262728292A2B2C2D2E2FAD978EEF0000001174455874436F6D6D656E74006D6164652068657265977E"
        "EE260000000549444154789C6360005DD4B2050000000649444154010000060001882086410000000049454E44AE426082"
    ),
    "cmyk": (
        "FFD8FFDB0043000101010101010101010101010101010101010101010101010101010101010101010101010101010101010101010101010101010101"
        "0101010101010101010101FFC00014080008000804011100021100031100041100FFC40014000100000000000000000000000000000000FFC4001410"
        "0100000000000000000000000000000000FFDA000E040100020003000400003F000000FFD9"
    ),
}


def picture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, kind, content): picture files of several kinds, one per document, every fifth cut in its last third."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    kinds = F.array(*(F.lit(k) for k in PICTURES))
    kind = F.element_at(kinds, (F.pmod(F.col("doc_id"), F.lit(len(PICTURES))) + 1).cast("int"))
    whole = F.unhex(F.element_at(F.create_map(*(F.lit(x) for kv in PICTURES.items() for x in kv)), kind))
    cut = F.pmod(F.floor(F.col("doc_id") / len(PICTURES)), F.lit(5)) == 0
    content = F.when(cut, F.substring(whole, 1, F.floor(F.octet_length(whole) * 2 / 3).cast("int"))).otherwise(whole)
    return docs.select(image_name(F.col("doc_id")).alias("image"), kind.alias("kind"), content.alias("content"))


def image_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image, status) of every document's image: ok, missing or error, by its labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    status = F.when(F.col("quality") == 0, "missing").when(F.col("toxic") == 1, "error").otherwise("ok")
    return docs.join(labels, "doc_id", "left").select(image_name(F.col("doc_id")).alias("image"), status.alias("status"))
