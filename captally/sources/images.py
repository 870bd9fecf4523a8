"""SRC-4 image folder listing and SRC-5 image validity scan.

Spark's file readers keep the status of every file in the driver.  Here a level
of folders is listed by tasks and written as a table of rows, so the driver
sees the number of folders of each level only; files are opened by the tasks
that check them.  Folders are read with ``pyarrow.fs``; a store that it cannot
open is left to Spark's reader.  What counts as a file is Spark's rule: hidden
names and empty files do not.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captally.operators.materialize import cut
from captally.sources.pictures import Picture, inspect

#: Rows that go to Spark at a time, and files that one task checks.
ROWS_OUT = 1 << 13
FILES_PER_TASK = 1 << 12
LISTED = "root string, path string, length long"


def scan_images(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """SRC-4: (path, image, length) of the files in ``folder``.

    ``image`` is the file name, or the value of an ``image=<name>`` folder.
    The listing is written once; the file bytes are not read.
    """
    roots = _roots(spark, folder)
    if roots is None:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    else:
        files = _listed(spark, roots)
        if glob != "*":
            pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
            files = files.where(F.element_at(F.split("path", "/"), -1).rlike(f"(?s)\\A(?:{pattern})\\z"))
    return files.select("path", _image_of("path").alias("image"), "length")


def _roots(spark: SparkSession, folder: str) -> list[str] | None:
    """The folders (or files) that ``folder`` stands for; None where tasks cannot list them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = store.makeQualified(path)
    found = store.globStatus(whole) if any(x in folder for x in "{}[]*?\\") else [store.getFileStatus(whole)] if store.exists(whole) else None
    roots = [x.getPath().toString() for x in found or []]
    return roots if roots and all(map(_opens, roots)) else None


def _opens(root: str) -> bool:
    try:
        return _store(root) is not None
    except (OSError, ValueError, NotImplementedError):  # pyarrow's own errors are of these kinds
        return False


def _store(root: str):
    """(file system, path in it); a local path has no escapes."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")) if root.startswith("file:") else fs.FileSystem.from_uri(root)


def _hidden(name: str, folder: bool) -> bool:
    """Spark's rule for names that its readers skip."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(root: str, path: str):
    """(name, length) of what lies in a folder, or of the file itself with an empty name; the length of a folder is None."""
    from pyarrow import fs

    store, top = _store(root)
    at = top + path[len(root) :]
    info = store.get_file_info(at)
    if info.type == fs.FileType.File:
        yield "", info.size
    elif isinstance(store, fs.LocalFileSystem):
        with os.scandir(at) as found:
            for x in found:
                try:
                    yield os.fsencode(x.name).decode("utf-8", "replace"), None if x.is_dir() else x.stat().st_size
                except FileNotFoundError:  # a link to nothing, or a file that has gone
                    continue
    else:
        for x in store.get_file_info(fs.FileSelector(at)):
            yield x.base_name, None if x.type == fs.FileType.Directory else x.size


def _list(batches):
    rows: list[tuple] = []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))], names=["root", "path", "length"])

    for b in batches:
        for root, path in zip(b["root"].to_pylist(), b["path"].to_pylist()):
            for name, length in _entries(root, path):
                if not _hidden(name or path.rpartition("/")[2], length is None) and length != 0:
                    rows.append((root, f"{path.rstrip('/')}/{name}" if name else path, length))
                    if len(rows) == ROWS_OUT:
                        yield out()
                        rows.clear()
    if rows:
        yield out()


def _listed(spark: SparkSession, roots: list[str]) -> DataFrame:
    """LISTED of every file below ``roots``, level by level."""
    folders, found, n = spark.createDataFrame([(r, r) for r in roots], "root string, path string"), [], len(roots)
    while n:
        dealt = folders.repartition(min(n, 4 * spark.sparkContext.defaultParallelism), "path")
        level = cut(dealt.mapInArrow(_list, LISTED), "listing")
        found.append(level.where("length is not null"))
        folders = level.where("length is null").select("root", "path")
        n = folders.count()
    files = found[0]
    for more in found[1:]:
        files = files.unionByName(more)
    return files


def _image_of(path: str) -> Column:
    folder = F.regexp_extract(F.col(path), "/image=([^/]+)/[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.element_at(F.split(path, "/"), -1))


PICTURE = "format string, width int, height int, n_channels int, bits int, problem string"


def _pictures(found: list[Picture]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(x, pa.int32() if i in (1, 2, 3, 4) else pa.string()) for i, x in enumerate(zip(*found))] or [pa.array([], t) for t in (pa.string(), *(pa.int32(),) * 4, pa.string())], names=list(Picture._fields))


def _inspect(contents: pa.Array) -> pa.Array:
    return _pictures([Picture(None, problem="missing") if c is None else inspect(c) for c in contents.to_pylist()])


def check_pictures(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` without their bytes, and (format, width, height, n_channels, bits, problem, ok) of each picture.

    The check is structural (``sources.pictures``): no pixels are made.  ``ok``
    says that a conversion to RGB would succeed; sizes are -1 where not.
    """
    return _checked(files.withColumn("_p", F.arrow_udf(_inspect, T.StructType.fromDDL(PICTURE))(content)), [c for c in files.columns if c != content])


def _checked(files: DataFrame, kept: list[str]) -> DataFrame:
    return files.select(*kept, "_p.*").withColumn("ok", F.col("problem").isNull())


def _open_and_inspect(batches):
    """(path, _p) of files, of which one at a time is in memory."""
    for b in batches:
        found, last, store = [], None, None
        for root, path in zip(b["root"].to_pylist(), b["path"].to_pylist()):
            if root != last:
                last, store = root, _store(root)
            with store[0].open_input_stream(store[1] + path[len(root) :]) as f:
                found.append(inspect(f.read()))
        yield pa.RecordBatch.from_arrays([b["path"], _pictures(found)], names=["path", "_p"])


def validate_images(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-5: check every file of a folder: (path, image, format, width, height, n_channels, bits, problem, ok)."""
    roots = _roots(spark, folder)
    if roots is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        return check_pictures(files.select("path", _image_of("path").alias("image"), "content"))
    files = _listed(spark, roots)
    dealt = files.select("root", "path").repartition(-(-files.count() // FILES_PER_TASK) or 1, "path")
    read = dealt.mapInArrow(_open_and_inspect, f"path string, _p struct<{PICTURE.replace(' ', ':').replace(',:', ',')}>")
    return _checked(read.withColumn("image", _image_of("path")), ["path", "image"])
