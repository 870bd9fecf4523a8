"""SRC-5: structural checks against pictures made here, whole, cut and damaged."""

import os
import struct
import zlib

import pytest

from captally.sources import scan_images, validate_images
from captally.sources.images import check_pictures
from captally.sources.pictures import PNG, inspect, png_bytes


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(width=5, height=3, bits=8, colour=2, interlace=0, palette=False, end=True):
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw = b"\0" * png_bytes(width, height, bits * channels, interlace == 1)
    data = zlib.compress(raw)
    half = len(data) // 2
    out = PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, bits, colour, 0, 0, interlace))
    out += chunk(b"PLTE", bytes(range(48))) if palette else b""
    out += chunk(b"tEXt", b"Comment\0made here") + chunk(b"IDAT", data[:half]) + chunk(b"IDAT", data[half:])
    return out + (chunk(b"IEND", b"") if end else b"")


def jpeg(channels=3, width=8, height=8, bits=8, sof=0xC0):
    """Grey blocks: one Huffman code each for "no difference" and "end of block"."""
    seg = lambda m, b: bytes([0xFF, m]) + struct.pack(">H", len(b) + 2) + b
    out = b"\xff\xd8" + seg(0xDB, b"\0" + b"\1" * 64)
    out += seg(sof, struct.pack(">BHHB", bits, height, width, channels) + b"".join(bytes([i + 1, 0x11, 0]) for i in range(channels)))
    for table in (0x00, 0x10):
        out += seg(0xC4, bytes([table, 1] + [0] * 15 + [0]))
    out += seg(0xDA, bytes([channels]) + b"".join(bytes([i + 1, 0]) for i in range(channels)) + b"\0\x3f\0")
    n_bits = 2 * channels * ((width + 7) // 8) * ((height + 7) // 8)
    return out + b"\0" * (n_bits // 8) + bytes([0xFF >> n_bits % 8 if n_bits % 8 else 0x00]) + b"\xff\xd9"


GIF = b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x80, 0, 0) + b"\0" * 6 + b"\x21\xf9\x04\0\0\0\0\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 2, 2, 0) + b"\x02\x02\x4c\x01\x00\x3b"
BMP = b"BM" + struct.pack("<IHHI", 54 + 16, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 2, 2, 1, 24, 0, 16, 0, 0, 0, 0) + b"\0" * 16

GOOD = {
    "rgb": (png(), ("png", 5, 3, 3, 8)),
    "grey16": (png(colour=0, bits=16), ("png", 5, 3, 1, 16)),
    "rgb16": (png(bits=16), ("png", 5, 3, 3, 16)),
    "palette4": (png(colour=3, bits=4, palette=True), ("png", 5, 3, 1, 4)),
    "alpha": (png(colour=6), ("png", 5, 3, 4, 8)),
    "interlaced": (png(width=17, height=11, interlace=1), ("png", 17, 11, 3, 8)),
    "tiny interlaced": (png(width=1, height=1, colour=0, bits=1, interlace=1), ("png", 1, 1, 1, 1)),
    "no end chunk": (png(end=False), ("png", 5, 3, 3, 8)),
    "jpeg": (jpeg(), ("jpeg", 8, 8, 3, 8)),
    "grey jpeg": (jpeg(1, 30, 20), ("jpeg", 30, 20, 1, 8)),
    "cmyk jpeg": (jpeg(4), ("jpeg", 8, 8, 4, 8)),
    "gif": (GIF, ("gif", 2, 2, 1, 8)),
    "bmp": (BMP, ("bmp", 2, 2, 3, 8)),
    "wbmp": (b"\0\0\x08\x01U", ("wbmp", 8, 1, 1, 1)),
}
flipped = lambda data, at: data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
BAD = {
    "empty": (b"", "format"),
    "text": (b"not an image", "format"),
    "png cut in data": (png(40, 40)[:75], "truncated"),
    "png cut in header": (png()[:20], "truncated"),
    "png header damaged": (flipped(png(), 18), "checksum"),
    "png data damaged": (flipped(png(), png().index(b"IDAT") + 5), "checksum"),
    "png short data": (PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", 9, 9, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" * 50)) + chunk(b"IEND", b""), "truncated"),
    "png without palette": (png(colour=3, bits=8), "no palette"),
    "png bad depth": (png(colour=2, bits=4), "header"),
    "png not deflate": (PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", 9, 9, 8, 2, 0, 0, 0)) + chunk(b"IDAT", b"\xff" * 50), "damaged"),
    "jpeg cut": (jpeg()[:-2], "truncated"),
    "jpeg cut in tables": (jpeg()[:40], "truncated"),
    "jpeg of 12 bits": (jpeg(bits=12), "header"),
    "jpeg lossless": (jpeg(sof=0xC3), "coding"),
    "jpeg without scan": (jpeg()[: jpeg().index(b"\xff\xda")] + b"\xff\xd9", "no scan"),
    "gif cut": (GIF[:-4], "truncated"),
    "bmp cut": (BMP[:-1], "truncated"),
    "wbmp cut": (b"\0\0\x08\x02U", "truncated"),
}


@pytest.mark.parametrize("name", GOOD)
def test_good(name):
    data, want = GOOD[name]
    got = inspect(data)
    assert (got.problem, tuple(got)[:5]) == (None, want)


@pytest.mark.parametrize("name", BAD)
def test_bad(name):
    data, problem = BAD[name]
    got = inspect(data)
    assert got.problem == problem and got.width == -1


def test_folder(spark, tmp):
    for kind, files in (("good", GOOD), ("bad", BAD)):
        for name, (data, _) in files.items():
            if data:  # Spark's file sources list no empty files
                with open(os.path.join(tmp, f"{kind} {name}"), "wb") as f:
                    f.write(data)
    got = {r.image: r for r in validate_images(spark, tmp).collect()}
    assert {n: r.ok for n, r in got.items()} == {**{f"good {n}": True for n in GOOD}, **{f"bad {n}": False for n in BAD if n != "empty"}}
    assert scan_images(spark, tmp).count() == len(got)


@pytest.mark.parametrize("name", ["rgb", "grey16", "palette4", "alpha", "interlaced", "jpeg", "grey jpeg", "gif", "bmp", "wbmp"])
def test_a_decoder_agrees_on_good_files(spark, tmp, name):
    """Java's decoders read what is called good (CMYK JPEG they cannot)."""
    with open(os.path.join(tmp, "x"), "wb") as f:
        f.write(GOOD[name][0])
    image = spark.read.format("image").load(tmp).first()
    assert (image.image.width, image.image.height) == GOOD[name][1][1:3]


def test_null_content_and_no_files(spark):
    rows = spark.createDataFrame([("a", None), ("b", bytearray(png()))], "image string, content binary")
    assert {r.image: (r.ok, r.problem) for r in check_pictures(rows).collect()} == {"a": (False, "missing"), "b": (True, None)}
    assert check_pictures(rows.limit(0)).count() == 0
