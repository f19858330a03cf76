"""What stands between the bytes of a PDF stream and its content: filters, predictors, standard encryption."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

#: Fixed value: the padding of passwords.
PADDING = bytes.fromhex("28BF4E5E4E758A4164004E56FFFA01082E2E00B6D0683E802F0CA9FE6453697A")


def lzw(data: bytes, early: int = 1) -> bytes:
    """Codes of 9 to 12 bits, the high bit first; 256 clears the table, 257 ends. ``early``: codes widen one sooner."""
    out, table, before, width = bytearray(), [bytes([k]) for k in range(256)] + [b"", b""], b"", 9
    held = bits = 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            del table[258:]
            before, width = b"", 9
            continue
        if code < len(table):
            entry = table[code]
        elif code == len(table) and before:
            entry = before + before[:1]
        else:
            raise ValueError("a broken LZW stream")
        out += entry
        if before and len(table) < 4096:
            table.append(before + entry[:1])
        before = entry
        width = min(12, max(9, (len(table) + early).bit_length()))
    return bytes(out)


def ascii85(data: bytes) -> bytes:
    """Five characters for four bytes, z for four zeros, up to ~>."""
    out, group = bytearray(), []
    for c in data.split(b"~")[0]:
        if c == 122 and not group:
            out += bytes(4)
        elif 33 <= c <= 117:
            group.append(c - 33)
            if len(group) == 5:
                out += (sum(v * 85 ** (4 - k) for k, v in enumerate(group)) & 0xFFFFFFFF).to_bytes(4, "big")
                group = []
    if len(group) > 1:
        n, full = len(group), group + [84] * (5 - len(group))
        out += (sum(v * 85 ** (4 - k) for k, v in enumerate(full)) & 0xFFFFFFFF).to_bytes(4, "big")[: n - 1]
    return bytes(out)


def ascii_hex(data: bytes) -> bytes:
    digits = bytes(c for c in data.split(b">")[0] if chr(c) in "0123456789abcdefABCDEF")
    return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())


def run_length(data: bytes) -> bytes:
    """A length up to 127 and that many bytes more than one, or 129 to 255 and a byte to repeat; 128 ends."""
    out, at = bytearray(), 0
    while at < len(data) and data[at] != 128:
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            out += data[at + 1 : at + 2] * (257 - n)
            at += 2
    return bytes(out)


def flate(data: bytes) -> bytes:
    """Deflated bytes, as far as they can be read."""
    return zlib.decompressobj().decompress(data)


def unpredicted(data: bytes, predictor: int, colors: int = 1, bits: int = 8, columns: int = 1) -> bytes:
    """Rows as they were before a predictor took differences: 2 that of TIFF (8 bits), from 10 on those of PNG."""
    if predictor < 2:
        return data
    step, size = max(1, colors * bits // 8), (colors * bits * columns + 7) // 8
    if predictor == 2:
        if bits != 8:
            raise ValueError(f"a TIFF predictor of {bits} bits")
        out = bytearray(data)
        for row in range(0, len(out), size):
            for k in range(row + step, min(row + size, len(out))):
                out[k] = (out[k] + out[k - step]) & 255
        return bytes(out)
    out, above = bytearray(), bytes(size)
    for at in range(0, len(data), size + 1):
        kind, row = data[at], bytearray(data[at + 1 : at + 1 + size])
        for k in range(len(row)):
            left, up, corner = row[k - step] if k >= step else 0, above[k], above[k - step] if k >= step else 0
            if kind == 1:
                add = left
            elif kind == 2:
                add = up
            elif kind == 3:
                add = (left + up) // 2
            elif kind == 4:
                guess = left + up - corner
                add = min((abs(guess - left), 0, left), (abs(guess - up), 1, up), (abs(guess - corner), 2, corner))[2]
            else:
                add = 0
            row[k] = (row[k] + add) & 255
        out += row
        above = bytes(row) + bytes(size - len(row))
    return bytes(out)


#: Filters by name and short name.
FILTERS: dict[str, Callable[[bytes], bytes]] = {"FlateDecode": flate, "Fl": flate, "LZWDecode": lzw, "LZW": lzw, "ASCII85Decode": ascii85, "A85": ascii85, "ASCIIHexDecode": ascii_hex, "AHx": ascii_hex, "RunLengthDecode": run_length, "RL": run_length}


def unfiltered(body: bytes, filters: list[str], parms: list[dict]) -> bytes:
    """A stream's content; a filter of images raises."""
    for name, own in zip(filters, parms, strict=True):
        if name == "Crypt":
            continue
        if name not in FILTERS:
            raise ValueError(f"a stream with filter {name}")
        body = lzw(body, own.get("EarlyChange", 1)) if name in ("LZWDecode", "LZW") else FILTERS[name](body)
        if name in ("FlateDecode", "Fl", "LZWDecode", "LZW"):
            body = unpredicted(body, own.get("Predictor", 1), own.get("Colors", 1), own.get("BitsPerComponent", 8), own.get("Columns", 1))
    return body


def rc4(key: bytes, data: bytes) -> bytes:
    state, j = list(range(256)), 0
    for i in range(256):
        j = (j + state[i] + key[i % len(key)]) & 255
        state[i], state[j] = state[j], state[i]
    out, i, j = bytearray(), 0, 0
    for byte in data:
        i = (i + 1) & 255
        j = (j + state[i]) & 255
        state[i], state[j] = state[j], state[i]
        out.append(byte ^ state[(state[i] + state[j]) & 255])
    return bytes(out)


class Security:
    """The standard handler with RC4, opened by the empty password; others raise."""

    def __init__(self, given: dict, ident: bytes):
        version, revision = given.get("V", 0), given.get("R", 0)
        method = (given.get("CF") or {}).get(given.get("StmF", "Identity"), {}).get("CFM", "None") if version == 4 else "V2"
        if given.get("Filter") != "Standard" or version not in (1, 2, 4) or method != "V2":
            raise ValueError("an encrypted file, by a method that is not read here")
        size = 5 if revision < 3 else (given.get("Length") or (128 if version == 4 else 40)) // 8
        plain = PADDING + given["O"][:32] + (given["P"] & 0xFFFFFFFF).to_bytes(4, "little") + ident
        if revision >= 4 and str(given.get("EncryptMetadata", "true")) == "false":
            plain += b"\xff" * 4
        key = hashlib.md5(plain).digest()
        for _ in range(50 if revision >= 3 else 0):
            key = hashlib.md5(key[:size]).digest()
        self.key = key[:size]
        if revision < 3:
            known, mark = rc4(self.key, PADDING), given["U"]
        else:
            known = hashlib.md5(PADDING + ident).digest()
            for k in range(20):
                known = rc4(bytes(b ^ k for b in self.key), known)
            mark = given["U"][:16]
        if known != mark:
            raise ValueError("an encrypted file that needs a password")

    def opened(self, body: bytes, number: int, generation: int) -> bytes:
        own = hashlib.md5(self.key + number.to_bytes(3, "little") + generation.to_bytes(2, "little")).digest()
        return rc4(own[: min(16, len(self.key) + 5)], body)
