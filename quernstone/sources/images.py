"""What an image's header says: size, format, mode, date taken, whether a place is noted."""

from __future__ import annotations

import shutil
import struct
from collections.abc import Iterator

#: Tags of the date taken and of the place, colour types of PNG, components of JPEG.
DATE_TAG, SUB_TAG, PLACE_TAG = 36867, 34665, 34853
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}
AVIF_BRANDS = (b"avif", b"avis")


def recogniser() -> str | None:
    """Path of the text recogniser, or None where it is not installed."""
    return shutil.which("tesseract")


def _directory(data: bytes, at: int, order: str) -> dict[int, tuple[int, int, bytes]]:
    """Tag -> (type, count, the four bytes of value or offset) of one directory."""
    n = struct.unpack_from(order + "H", data, at)[0]
    rows = (struct.unpack_from(order + "HHI4s", data, at + 2 + 12 * k) for k in range(n))
    return {tag: (kind, count, raw) for tag, kind, count, raw in rows}


def noted(data: bytes) -> dict[str, str]:
    """Date taken and place flag of a block of tags (TIFF structure); nothing where it is damaged."""
    try:
        order = {b"II": "<", b"MM": ">"}[data[:2]]
        main = _directory(data, struct.unpack_from(order + "I", data, 4)[0], order)
        offset = lambda entry: struct.unpack(order + "I", entry[2])[0]
        out = {}
        inner = _directory(data, offset(main[SUB_TAG]), order) if SUB_TAG in main else {}
        if date := inner.get(DATE_TAG) or main.get(DATE_TAG):
            text = data[offset(date) : offset(date) + date[1]].split(b"\0")[0].decode("ascii", "replace").strip()
            if text:
                out["captured"] = text
        if PLACE_TAG in main:
            out["has_place"] = "true"
        return out
    except (KeyError, struct.error):
        return {}


def boxes(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Kind, start and end of the content of each box; a size of 0 runs to the end, of 1 has eight more bytes."""
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        size = size or end - at
        if size < head or at + size > end:
            raise ValueError("a box beyond its file")
        yield kind, at + head, at + size
        at += size


def _avif(data: bytes) -> dict[str, str]:
    """Facts of the primary item: its properties are boxes that associations number; the tags are an item of their own."""
    top = {k: (a, z) for k, a, z in boxes(data, 0, len(data))}
    if b"meta" not in top:
        raise ValueError("an AVIF without its items")
    meta = {k: (a, z) for k, a, z in boxes(data, top[b"meta"][0] + 4, top[b"meta"][1])}
    number = lambda at, wide: struct.unpack_from(">I" if wide else ">H", data, at)[0]
    primary = number(meta[b"pitm"][0] + 4, data[meta[b"pitm"][0]] > 0)
    inside = {k: (a, z) for k, a, z in boxes(data, *meta[b"iprp"])}
    properties = list(boxes(data, *inside[b"ipco"]))
    at, _ = inside[b"ipma"]
    version, large = data[at], data[at + 3] & 1
    own: list[int] = []
    count, at = number(at + 4, True), at + 8
    for _ in range(count):
        item, at = number(at, version > 0), at + (4 if version else 2)
        n, at = data[at], at + 1
        for _ in range(n):
            index, at = (number(at, False) & 0x7FFF, at + 2) if large else (data[at] & 0x7F, at + 1)
            if item == primary:
                own.append(index)
    said = {properties[k - 1][0]: properties[k - 1][1] for k in own if 0 < k <= len(properties)}
    if b"ispe" not in said:
        raise ValueError("an AVIF without a size")
    w, h = struct.unpack_from(">II", data, said[b"ispe"] + 4)
    channels = data[said[b"pixi"] + 4] if b"pixi" in said else 3
    out = {"width": str(w), "height": str(h), "image_format": "AVIF", "mode": {1: "L", 4: "RGBA"}.get(channels, "RGB")}
    return out | (_item_tags(data, meta) if b"iinf" in meta and b"iloc" in meta else {})


def _item_tags(data: bytes, meta: dict[bytes, tuple[int, int]]) -> dict[str, str]:
    """What :func:`noted` gives of the item that holds tags."""
    at, end = meta[b"iinf"]
    wide = data[at] > 0
    tagged = set()
    for kind, a, _ in boxes(data, at + (8 if wide else 6), end):
        if kind == b"infe" and data[a] >= 2:
            size = 4 if data[a] > 2 else 2
            if data[a + 6 + size : a + 10 + size] == b"Exif":
                tagged.add(int.from_bytes(data[a + 4 : a + 4 + size], "big"))
    at, _ = meta[b"iloc"]
    version, sizes = data[at], struct.unpack_from(">H", data, at + 4)[0]
    widths = [sizes >> 12 & 15, sizes >> 8 & 15, sizes >> 4 & 15, sizes & 15 if version else 0]  # offset, length, base, index
    at += 6
    take = lambda n: (int.from_bytes(data[at : at + n], "big"), at + n)
    count, at = take(4 if version > 1 else 2)
    for _ in range(count):
        item, at = take(4 if version > 1 else 2)
        at += 4 if version else 2  # how it is built, and in which file
        base, at = take(widths[2])
        extents, at = take(2)
        for k in range(extents):
            at += widths[3]
            offset, at = take(widths[0])
            length, at = take(widths[1])
            if item in tagged and k == 0:
                start = base + offset
                body = data[start : start + length]
                return noted(body[4 + int.from_bytes(body[:4], "big") :])
    return {}


def header(data: bytes) -> dict[str, str]:
    """width, height, image_format, mode and what :func:`noted` gives; raises on an unknown or broken file."""
    said = lambda w, h, name, mode: {"width": str(w), "height": str(h), "image_format": name, "mode": mode}
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        w, h, _, colour = struct.unpack_from(">IIBB", data, 16)
        at, more = 8, {}
        while at + 8 <= len(data):
            size, kind = struct.unpack_from(">I4s", data, at)
            if kind == b"eXIf":
                more = noted(data[at + 8 : at + 8 + size])
            at += 12 + size
        return said(w, h, "PNG", PNG_MODES.get(colour, "?")) | more
    if data[:2] == b"\xff\xd8":
        at, more = 2, {}
        while at + 4 <= len(data) and data[at] == 0xFF:
            marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            if marker == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                more = noted(data[at + 10 : at + 2 + size])
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                _, h, w, n = struct.unpack_from(">BHHB", data, at + 4)
                return said(w, h, "JPEG", JPEG_MODES.get(n, "?")) | more
            at += 2 + size
        raise ValueError("a JPEG without a frame")
    if data[:2] == b"BM":
        w, h, _, bits = struct.unpack_from("<iiHH", data, 18)
        return said(w, abs(h), "BMP", "RGBA" if bits == 32 else "RGB" if bits == 24 else "P")
    if data[:4] in (b"II*\0", b"MM\0*"):
        order = "<" if data[:2] == b"II" else ">"
        main = _directory(data, struct.unpack_from(order + "I", data, 4)[0], order)
        number = lambda tag, none: none if tag not in main else struct.unpack(order + ("H2x" if main[tag][0] == 3 else "I"), main[tag][2])[0]
        return said(number(256, 0), number(257, 0), "TIFF", {1: "L", 3: "RGB", 4: "RGBA"}.get(number(277, 1), "?")) | noted(data)
    if data[4:8] == b"ftyp" and any(data[k : k + 4] in AVIF_BRANDS for k in (8, *range(16, min(len(data), struct.unpack_from(">I", data)[0]), 4))):
        return _avif(data)
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        kind = data[12:16]
        if kind == b"VP8X":
            return said(1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little"), "WEBP", "RGBA" if data[20] & 16 else "RGB")
        if kind == b"VP8L":
            bits = int.from_bytes(data[21:25], "little")
            return said(1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF), "WEBP", "RGBA" if bits >> 28 & 1 else "RGB")
        w, h = struct.unpack_from("<HH", data, 26)
        return said(w & 0x3FFF, h & 0x3FFF, "WEBP", "RGB")
    raise ValueError("no image format that is known here")
