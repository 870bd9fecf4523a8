"""SRC-1 by byte ranges: rows and order of a plain reading, however the file is cut."""

import csv
import io
import random

import pytest

from captally.sources import read_captions
from captally.sources.csv_records import _lines, csv_records


def content(seed, n):
    r = random.Random(seed)
    words = ["a", "dog", "é", 'say "hi"', "x,y", "line\nbreak", "\n\n", '"', "\r\nwin", "日本", " ", "end\r"]
    return [(f"i{k}.jpg", " ".join(r.choice(words) for _ in range(r.randrange(1, 9)))) for k in range(n)]


def write(path, rows, ending="\n", header=("Image", "Caption")):
    buf = io.StringIO(newline="")
    w = csv.writer(buf, lineterminator=ending)
    w.writerow(header)
    w.writerows(rows)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(buf.getvalue())


@pytest.fixture()
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_a_file_of_many_ranges(spark, tmp, small_ranges, ending):
    rows = content(1, 400)
    write(f"{tmp}/c.csv", rows, ending)
    assert _lines(spark, f"{tmp}/c.csv").rdd.getNumPartitions() > 8
    got = read_captions(spark, f"{tmp}/c.csv").orderBy("pos").collect()
    assert [(r.image, r.caption) for r in got] == [(i, c) for i, c in rows]
    assert len({r.pos for r in got}) == len(rows)


def test_a_record_longer_than_ranges(spark, tmp, small_ranges):
    rows = [("a", "one"), ("b", "line, \"q\"\n" * 400), ("c", "three"), ("d", "\n" * 900 + "x"), ("e", "five")]
    write(f"{tmp}/c.csv", rows)
    got = read_captions(spark, f"{tmp}/c.csv").orderBy("pos").collect()
    assert [(r.image, r.caption) for r in got] == rows


def test_several_files_have_several_headers(spark, tmp, small_ranges):
    for k in range(3):
        write(f"{tmp}/{k}.csv", content(k, 40))
    got = read_captions(spark, f"{tmp}/*.csv").orderBy("pos").collect()
    assert [(r.image, r.caption) for r in got] == [row for k in range(3) for row in content(k, 40)]


def test_same_rows_as_the_multi_line_reader(spark, tmp):
    write(f"{tmp}/c.csv", content(5, 200) + [("", "no image"), ("x", ""), ("NA", "NA")])
    key = lambda df: [(r.image, r.caption) for r in df.orderBy("pos").collect()]
    assert key(read_captions(spark, f"{tmp}/c.csv")) == key(read_captions(spark, f"{tmp}/c.csv", split=False))


def test_no_rows_and_stray_quotes(spark, tmp):
    write(f"{tmp}/c.csv", [])
    assert read_captions(spark, f"{tmp}/c.csv").count() == csv_records(spark, f"{tmp}/c.csv").count() == 0
    with open(f"{tmp}/d.csv", "w") as f:
        f.write('image,caption\na,5" pipe\nb,two\nc,"3"\n')
    with pytest.raises(Exception, match="Malformed records"):
        read_captions(spark, f"{tmp}/d.csv").collect()
    assert read_captions(spark, f"{tmp}/d.csv", split=False).count() == 3
