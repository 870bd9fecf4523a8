"""Sources and sinks on hand-written files (SRC-1..7, SNK-1..3, FLT-2)."""

import json
import os
import struct
import zlib

import pytest

from captally.operators.pairing import existing_images, missing_images
from captally.sinks import write_captions, write_coco_predictions, write_coco_references
from captally.sources import (
    read_caption_tokens,
    read_captions,
    read_coco_images,
    read_coco_predictions,
    read_coco_references,
    read_split_manifest,
    scan_images,
    validate_images,
)
from captally.sources.manifest import raw_references

CSV = (
    'Image,Caption\n'
    'a.jpg,"A dog, running"\n'
    'a.jpg,"He said ""hi"""\n'
    'b.jpg,"two\nlines"\n'
    ',orphan caption\n'
    'c.jpg,\n'
    'c.jpg,NA\n'
    'd.jpg,  spaced out  \n'
)


def test_read_captions_edge_cases(spark, tmp):
    path = os.path.join(tmp, "captions.csv")
    with open(path, "w") as f:
        f.write(CSV)
    rows = read_captions(spark, path).orderBy("pos").collect()
    got = [(r.image, r.caption) for r in rows]
    assert got == [
        ("a.jpg", "A dog, running"),
        ("a.jpg", 'He said "hi"'),
        ("b.jpg", "two\nlines"),
        ("c.jpg", "NA"),
        ("d.jpg", "  spaced out  "),
    ]


def test_caption_csv_round_trip(spark, tmp):
    df = spark.createDataFrame([("a.jpg", 'x, "y"\nz')], "image string, caption string")
    write_captions(df, os.path.join(tmp, "out"))
    back = read_captions(spark, os.path.join(tmp, "out")).collect()
    assert [(r.image, r.caption) for r in back] == [("a.jpg", 'x, "y"\nz')]


def test_read_caption_tokens(spark, tmp):
    path = os.path.join(tmp, "tokens.txt")
    with open(path, "w") as f:
        f.write("a.jpg#0\tA \"quoted\" dog's toy\na.jpg#1\tsecond\nnokey\tcaption without index\n")
    rows = read_caption_tokens(spark, path).collect()
    assert [(r.image, r.pos, r.caption) for r in rows] == [
        ("a.jpg", 0, "A \"quoted\" dog's toy"),
        ("a.jpg", 1, "second"),
        ("nokey", None, "caption without index"),
    ]


def test_read_split_manifest(spark, tmp):
    doc = {"images": [
        {"filename": "one.jpg", "split": "test", "sentences": [{"raw": "only one", "tokens": ["x"]}]},
        {"filename": "five.jpg", "split": "train", "sentences": [{"raw": f"s{i}"} for i in range(5)]},
        {"filename": "none.jpg", "split": "test", "sentences": []},
        {"filename": "v.jpg", "split": "val", "sentences": [{"raw": "v"}]},
    ]}
    path = os.path.join(tmp, "manifest.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    rows = {r.filename: r for r in read_split_manifest(spark, path).collect()}
    assert rows["one.jpg"].refs == ["only one"]
    assert rows["five.jpg"].refs == [f"s{i}" for i in range(5)]
    assert rows["none.jpg"].refs == []
    assert rows["v.jpg"].split == "val" and rows["five.jpg"].ordinal == 1


def png_bytes(w=2, h=2):
    raw = b"".join(b"\x00" + b"\xff\x00\x00" * w for _ in range(h))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images_scan_validate_and_existence(spark, tmp):
    folder = os.path.join(tmp, "images")
    os.makedirs(folder)
    with open(os.path.join(folder, "good.png"), "wb") as f:
        f.write(png_bytes())
    with open(os.path.join(folder, "junk.png"), "wb") as f:
        f.write(b"not an image at all")
    listing = scan_images(spark, folder)
    assert sorted(r.image for r in listing.collect()) == ["good.png", "junk.png"]
    valid = {r.image: r.ok for r in validate_images(spark, folder).collect()}
    assert valid == {"good.png": True, "junk.png": False}
    wanted = spark.createDataFrame([("good.png",), ("junk.png",), ("gone.png",)], "image string")
    assert sorted(r.image for r in existing_images(wanted, listing).collect()) == ["good.png", "junk.png"]
    assert [r.image for r in missing_images(wanted, listing).collect()] == ["gone.png"]


def test_coco_round_trip(spark, tmp):
    preds = spark.createDataFrame([(1, "a dog"), (2, "two cats")], "image_id long, caption string")
    refs = spark.createDataFrame([(1, 0, "a dog runs"), (1, 1, "dog"), (2, 2, "cats")], "image_id long, id long, caption string")
    write_coco_predictions(preds, os.path.join(tmp, "p"))
    write_coco_references(refs, os.path.join(tmp, "r"))
    back_p = read_coco_predictions(spark, os.path.join(tmp, "p"))
    back_r = read_coco_references(spark, os.path.join(tmp, "r"))
    assert sorted(tuple(r) for r in back_p.collect()) == [(1, "a dog"), (2, "two cats")]
    assert sorted(tuple(r) for r in back_r.collect()) == [(1, 0, "a dog runs"), (1, 1, "dog"), (2, 2, "cats")]
    assert sorted(r.id for r in read_coco_images(spark, os.path.join(tmp, "r")).collect()) == [1, 2]


def write(tmp, name, text):
    path = os.path.join(tmp, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_coco_documents(spark, tmp):
    p = write(tmp, "p.json", json.dumps([{"image_id": 1, "caption": "a dog"}]))
    r = write(tmp, "r.json", json.dumps({"images": [{"id": 1}], "annotations": [{"image_id": 1, "id": 0, "caption": "dog"}]}))
    assert [tuple(x) for x in read_coco_predictions(spark, p, document=True).collect()] == [(1, "a dog")]
    assert [tuple(x) for x in read_coco_references(spark, r, document=True).collect()] == [(1, 0, "dog")]


def test_sharded_manifest(spark, tmp):
    path = write(tmp, "m.jsonl", '{"filename": "a", "split": "test", "sentences": [{"raw": "x"}]}\n{"filename": "b", "split": "val"}\n')
    rows = read_split_manifest(spark, path, document=False).collect()
    assert sorted((r.filename, r.split, r.refs) for r in rows) == [("a", "test", ["x"]), ("b", "val", [])]


@pytest.mark.parametrize("name", ["manifest", "manifest lines", "predictions", "prediction lines", "references", "csv"])
def test_broken_files_are_errors(spark, tmp, name):
    cut_off = '{"images": [{"filename": "a.jpg", "split": "te'
    read = {
        "manifest": lambda: read_split_manifest(spark, write(tmp, "x", cut_off)),
        "manifest lines": lambda: read_split_manifest(spark, write(tmp, "x", '{"filename": "a"}\n{"filen'), document=False),
        "predictions": lambda: read_coco_predictions(spark, write(tmp, "x", '[{"image_id": 1, "cap'), document=True),
        "prediction lines": lambda: read_coco_predictions(spark, write(tmp, "x", '{"image_id": "one", "caption": 2')),
        "references": lambda: read_coco_references(spark, write(tmp, "x", cut_off), document=True),
        "csv": lambda: read_captions(spark, write(tmp, "x", "image,caption\na.jpg\n")),
    }[name]
    with pytest.raises(Exception, match="(?i)malformed|MALFORMED"):
        read().collect()


def test_raw_references_handles_null(spark):
    df = spark.createDataFrame([(None,)], "s array<struct<raw string>>")
    assert df.select(raw_references("s")).first()[0] == []


def test_image_folder_has_few_folders(spark, tmp):
    """files lie in a fixed number of folders; rows of one image are one file; a null id has its own."""
    from captally import fixtures as fx

    sf = os.path.join(tmp, "sf")
    docs = [(k, "x" * (k % 7)) for k in range(600)] + [(5, "again"), (None, "t"), (601, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    labels = [(k, 0 if k % 10 == 0 else 1, 1 if k % 10 == 5 else 0) for k in range(600)] + [(601, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    folder = fx.image_folder(spark, sf)
    got = {r.image: r.length for r in scan_images(spark, folder).collect()}
    want = {f"img{k:08d}.jpg": (k % 7 if k % 10 == 5 else 4) + 1 for k in range(600) if k % 10}
    want["img00000005.jpg"] = 5 + 1 + 5 + 1
    assert got == {**want, "img00000601.jpg": 1, "__HIVE_DEFAULT_PARTITION__": 5}
    folders = os.listdir(folder.removeprefix("file:"))
    assert len([x for x in folders if not x.startswith((".", "_"))]) <= fx.IMAGE_FOLDERS
    ok = {r.image for r in validate_images(spark, folder).collect() if r.ok}
    assert "img00000001.jpg" in ok and "img00000015.jpg" not in ok
    empty = os.path.join(tmp, "empty")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert scan_images(spark, fx.image_folder(spark, empty)).count() == 0


def test_the_driver_holds_no_file_of_an_image_folder(spark, tmp):
    """A level of folders is a written table: the files themselves are in no file index (F4, F5, F6)."""
    import os

    for k in range(60):
        os.makedirs(f"{tmp}/top/part-{k % 3}/image=_{k}")
        for at in (f"part-{k % 3}/a{k}.jpg", f"part-{k % 3}/image=_{k}/file", f"b {k}%41.jpg"):
            with open(f"{tmp}/top/{at}", "wb") as f:
                f.write(b"\x00\x00\x08\x01U" if k % 2 else b"???")
    for hidden in ("_h.jpg", ".h.jpg", "x._COPYING_", "part-0/_h", "empty.jpg"):
        with open(f"{tmp}/top/{hidden}", "wb") as f:
            f.write(b"" if hidden == "empty.jpg" else b"x")
    os.symlink("nowhere", f"{tmp}/top/broken.jpg")
    names = {x for k in range(60) for x in (f"a{k}.jpg", f"_{k}", f"b {k}%41.jpg")}
    listing, checked = scan_images(spark, f"{tmp}/top"), validate_images(spark, f"{tmp}/top")
    assert len(listing.inputFiles()) < 60 and len(checked.inputFiles()) < 60
    assert {r.image: r.length for r in listing.collect()} == {n: 5 if int("".join(c for c in n.split("%")[0] if c.isdigit())) % 2 else 3 for n in names}
    assert {r.image for r in checked.collect() if r.ok} == {r.image for r in listing.where("length = 5").collect()}
    assert {r.path for r in listing.collect()} == {r.path for r in checked.collect()}
    assert {r.image for r in scan_images(spark, f"{tmp}/top", "a[1-3]*.{jpg,png}").collect()} == {f"a{k}.jpg" for k in range(60) if str(k)[0] in "123"}
    assert scan_images(spark, f"{tmp}/top/b 1%41.jpg").count() == 1 and scan_images(spark, f"{tmp}/top/part-[01]").count() == 80
    os.makedirs(f"{tmp}/none")
    assert scan_images(spark, f"{tmp}/none").count() == 0
