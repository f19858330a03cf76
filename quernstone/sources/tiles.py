"""Vector tiles, decoded from their protobuf fields, and the texts of their features."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

#: How an absent thing is written, features read of a layer, the mark of another kind of file.
NEGATIVE = ("falso", "false", "no", "0", "none", "null", "nao", "não")
FEATURE_CAP, OSM_MARK = 5000, b"OSMHeader"
Property = str | float | int | bool


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if b < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message: integers, or bytes of a fixed or given length."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind in (1, 2, 5):
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            if at + size > len(data):
                raise ValueError("a field is cut off")
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} is unknown")
        yield tag >> 3, value


def _value(data: bytes) -> Property | None:
    for number, v in fields(data):
        if number == 1:
            return v.decode()
        if number in (2, 3):
            return struct.unpack("<f" if number == 2 else "<d", v)[0]
        if number == 4:
            return v - (1 << 64) if v >> 63 else v
        if number == 5:
            return v
        if number == 6:
            return (v >> 1) ^ -(v & 1)
        if number == 7:
            return bool(v)
    return None


def layers(data: bytes) -> dict[str, list[dict[str, Property]]]:
    """The properties of each layer's features, in file order; geometry is left aside."""
    found: dict[str, list[dict[str, Property]]] = {}
    for number, body in fields(data):
        if number != 3:
            continue
        parts = list(fields(body))
        keys = [v.decode() for n, v in parts if n == 3]
        values = [_value(v) for n, v in parts if n == 4]
        own = found.setdefault(next(v.decode() for n, v in parts if n == 1), [])
        for n, feature in parts:
            if n != 2:
                continue
            tags: list[int] = []
            for m, packed in fields(feature):
                at = 0
                while m == 2 and at < len(packed):
                    tag, at = _varint(packed, at)
                    tags.append(tag)
            own.append({keys[k]: values[v] for k, v in zip(tags[::2], tags[1::2], strict=True)})
    return found


def in_order(features: list[dict[str, Property]]) -> list[dict[str, Property]]:
    """By whole-number ``fid``; then those of another one by its text; file order breaks ties."""

    def key(p: dict[str, Property]) -> tuple[bool, int, str]:
        fid = p.get("fid")
        whole = isinstance(fid, int)
        return not whole, int(fid) if whole else 0, "" if whole or fid is None else str(fid)

    return sorted(features, key=key)


def place_of(path: str) -> tuple[int, int, int | None] | None:
    """(zoom, x, y) of a path that ends in .../zoom/x/name; y is the last number in the name."""
    found = re.search(r"(?:^|/)(\d+)/(\d+)/([^/]*)$", path)
    if not found:
        return None
    numbers = re.findall(r"\d+", found[3].rsplit(".", 1)[0])
    return int(found[1]), int(found[2]), int(numbers[-1]) if numbers else None
