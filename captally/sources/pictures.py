"""Structural checks of picture files (SRC-5): would a conversion to RGB find all it needs?

A file is walked by its own structure, without making pixels: PNG chunks with
their checksums and the inflated length of the image data, JPEG markers with
components and precision up to the end of the last scan, the headers and sizes of GIF,
BMP and WBMP.  Palette, grey, CMYK, alpha and 16-bit pictures can all be
converted; truncated or damaged ones cannot.
"""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

PNG = b"\x89PNG\r\n\x1a\n"
# Fixed values of the formats: channels and allowed depths by PNG colour type,
# and the passes of an interlaced PNG (x start, y start, x step, y step).
PNG_KINDS = {0: (1, (1, 2, 4, 8, 16)), 2: (3, (8, 16)), 3: (1, (1, 2, 4, 8)), 4: (2, (8, 16)), 6: (4, (8, 16))}
PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
READ_JPEG = {0xC0, 0xC1, 0xC2}
OTHER_JPEG = {0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
INFLATE_STEP = 1 << 20


class Picture(NamedTuple):
    """What a file says of itself; ``problem`` is null for a picture that can be converted."""

    format: str | None
    width: int = -1
    height: int = -1
    n_channels: int = -1
    bits: int = -1
    problem: str | None = None


class Broken(Exception):
    """A file is not the picture it begins as."""


def png_bytes(width: int, height: int, bits: int, interlaced: bool) -> int:
    """Bytes of the filtered rows of a PNG."""
    rows = lambda w, h: h * (1 + (w * bits + 7) // 8) if w and h else 0
    if not interlaced:
        return rows(width, height)
    return sum(rows(-(-(width - x) // dx) if width > x else 0, -(-(height - y) // dy) if height > y else 0) for x, y, dx, dy in PASSES)


def check_png(data: bytes) -> Picture:
    at, head, palette, inflate, have, need = len(PNG), None, False, zlib.decompressobj(), 0, 0
    while at < len(data):
        if at + 12 > len(data):
            raise Broken("truncated")
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if at + 12 + size > len(data):
            if kind != b"IDAT":
                raise Broken("truncated")
        elif not kind[0] & 0x20 and zlib.crc32(kind + body) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise Broken("checksum")
        if head is None:
            if kind != b"IHDR" or size != 13:
                raise Broken("no header")
            width, height, bits, colour, method, filters, interlace = struct.unpack(">IIBBBBB", body)
            channels, depths = PNG_KINDS.get(colour, (0, ()))
            if not width or not height or bits not in depths or method or filters or interlace > 1:
                raise Broken("header")
            head = Picture("png", width, height, channels, bits)
            need = png_bytes(width, height, bits * channels, interlace == 1)
        elif kind == b"PLTE":
            palette = True
        elif kind == b"IDAT":
            if colour == 3 and not palette:
                raise Broken("no palette")
            rest = body
            while rest and not inflate.eof:
                have += len(inflate.decompress(rest, INFLATE_STEP))
                rest = inflate.unconsumed_tail
        elif kind == b"IEND":
            break
        at += 12 + size
    if head is None:
        raise Broken("truncated")
    if have < need:
        raise Broken("truncated")
    return head


def check_jpeg(data: bytes) -> Picture:
    at, head, scanned = 2, None, False
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            raise Broken("truncated")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        at += 2
        if marker == 0xD9:
            if not scanned:
                raise Broken("no scan")
            return head
        if marker in (0x00, 0x01) or 0xD0 <= marker <= 0xD8:
            continue  # a stuffed byte or a restart inside a scan
        if at + 2 > len(data):
            raise Broken("truncated")
        size = struct.unpack(">H", data[at : at + 2])[0]
        body = data[at + 2 : at + size]
        if size < 2 or len(body) < size - 2:
            raise Broken("truncated")
        if marker in OTHER_JPEG:
            raise Broken("coding")
        if marker in READ_JPEG:
            if len(body) < 6:
                raise Broken("header")
            bits, height, width, channels = struct.unpack(">BHHB", body[:6])
            if bits != 8 or not height or not width or channels not in (1, 3, 4) or len(body) < 6 + 3 * channels:
                raise Broken("header")
            head = Picture("jpeg", width, height, channels, bits)
        if marker == 0xDA:
            if head is None:
                raise Broken("no header")
            scanned = True
        at += size


def check_gif(data: bytes) -> Picture:
    if len(data) < 13:
        raise Broken("truncated")
    width, height, flags = struct.unpack("<HHB", data[6:11])
    if not width or not height:
        raise Broken("header")
    at = 13 + (3 << (flags & 7) + 1 if flags & 0x80 else 0)

    def blocks(at: int) -> int:
        while at < len(data) and data[at]:
            at += 1 + data[at]
        if at >= len(data):
            raise Broken("truncated")
        return at + 1

    while True:
        if at >= len(data):
            raise Broken("truncated")
        if data[at] == 0x2C and at + 10 < len(data):  # the first image is what is converted
            local = data[at + 9]
            blocks(at + 11 + (3 << (local & 7) + 1 if local & 0x80 else 0))
            return Picture("gif", width, height, 1, 8)
        if data[at] != 0x21:
            raise Broken("truncated" if data[at] == 0x2C else "no image")
        at = blocks(at + 2)


def check_bmp(data: bytes) -> Picture:
    if len(data) < 30:
        raise Broken("truncated")
    start, _, width, height, _, bits = struct.unpack("<IIiiHH", data[10:30])
    if width <= 0 or not height or bits not in (1, 4, 8, 16, 24, 32):
        raise Broken("header")
    packed = struct.unpack("<I", data[30:34])[0] if len(data) >= 34 else 0
    if packed not in (1, 2) and len(data) < start + (width * bits + 31) // 32 * 4 * abs(height):
        raise Broken("truncated")
    return Picture("bmp", width, abs(height), {24: 3, 32: 4}.get(bits, 1), min(bits, 8))


def check_wbmp(data: bytes) -> Picture:
    sizes, at = [], 2
    for _ in range(2):
        value = 0
        while True:
            if at >= len(data):
                raise Broken("truncated")
            value = value << 7 | data[at] & 0x7F
            at += 1
            if not data[at - 1] & 0x80:
                break
        sizes.append(value)
    width, height = sizes
    if not width or not height or width > 1 << 16 or height > 1 << 16:
        raise Broken("header")
    if len(data) < at + (width + 7) // 8 * height:
        raise Broken("truncated")
    return Picture("wbmp", width, height, 1, 1)


FORMATS = ((PNG, "png", check_png), (b"\xff\xd8\xff", "jpeg", check_jpeg), (b"GIF87a", "gif", check_gif), (b"GIF89a", "gif", check_gif), (b"BM", "bmp", check_bmp),
           (b"\0\0", "wbmp", check_wbmp))


def inspect(data: bytes) -> Picture:
    """The picture a file holds, or its problem: ``format`` (none that is known), ``truncated``, ``checksum``, ..."""
    for magic, name, check in FORMATS:
        if data.startswith(magic):
            try:
                return check(data)
            except Broken as exc:
                return Picture(name, problem=str(exc))
            except zlib.error:
                return Picture(name, problem="damaged")
    return Picture(None, problem="format")
