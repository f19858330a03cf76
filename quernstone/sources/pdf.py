"""Words with places and sizes out of PDF files, by the standard's own structures.

Follows the cross-reference chain to the live objects, or reads objects wherever they
stand where it is damaged; object streams, filters and predictors, files encrypted
with RC4 under the empty password, the page tree, text operators, simple and
composite fonts with their widths and Unicode maps. A code without a known
character comes out as ``(cid:n)``. Other encryption and filters of images are
refused with a reason; drawings, forms and annotations are left aside.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from quernstone.sources.pdf_streams import Security, unfiltered

#: Gap in points that parts words, share of the size that stands above the base line, nested objects followed.
GAP, ASCENT, DEPTH = 3.0, 1.0, 40
_SPACE, _STOP = b"\0\t\n\f\r ", b"()<>[]{}/%"
_ESCAPES = {ord("n"): 10, ord("r"): 13, ord("t"): 9, ord("b"): 8, ord("f"): 12}


class Name(str):
    """A name, without its slash; a plain str is an operator."""


class Ref(int):
    """The number of an object that stands elsewhere."""


class Reader:
    """A tokenizer of objects from one place on."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def blank(self) -> None:
        data, n = self.data, len(self.data)
        while self.at < n:
            c = data[self.at]
            if c in _SPACE:
                self.at += 1
            elif c == 37:  # a comment
                ends = [e for e in (data.find(b"\n", self.at), data.find(b"\r", self.at)) if e >= 0]
                self.at = min(ends) if ends else n
            else:
                return

    def value(self, depth: int = 0) -> object:
        """The next object or operator; None at the end."""
        self.blank()
        data, at = self.data, self.at
        if at >= len(data):
            return None
        c = data[at : at + 1]
        if data[at : at + 2] == b"<<" or c == b"[":
            close, self.at = (b">>", at + 2) if c == b"<" else (b"]", at + 1)
            items: list = []
            while True:
                self.blank()
                if self.at >= len(data) or data.startswith(close, self.at):
                    self.at += len(close)
                    break
                if depth > DEPTH:
                    raise ValueError("objects nested too deep")
                items.append(self.value(depth + 1))
                if items[-1] == "R" and not isinstance(items[-1], (Name, bytes)) and len(items) > 2:
                    items[-3:] = [Ref(items[-3])]
            return items if close == b"]" else {str(k): v for k, v in zip(items[::2], items[1::2], strict=False)}
        if c == b"(":
            return self.string()
        if c == b"<":
            end = data.find(b">", at)
            self.at = end + 1 if end >= 0 else len(data)
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", data[at + 1 : end if end >= 0 else len(data)])
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        end = at + 1
        while end < len(data) and data[end] not in _SPACE and data[end] not in _STOP:
            end += 1
        word, self.at = data[at:end], end
        if c == b"/":
            return Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda m: bytes.fromhex(m[1].decode()), word[1:]).decode("latin-1"))
        try:
            return float(word) if b"." in word else int(word)
        except ValueError:
            return word.decode("latin-1")

    def string(self) -> bytes:
        """A string in brackets, which may nest; the place is on the first."""
        data, out, level = self.data, bytearray(), 1
        self.at += 1
        while self.at < len(data):
            c = data[self.at]
            self.at += 1
            if c == 92 and self.at < len(data):
                c = data[self.at]
                self.at += 1
                if 48 <= c <= 55:
                    octal = re.compile(rb"[0-7]{1,3}").match(data, self.at - 1)[0]
                    self.at += len(octal) - 1
                    out.append(int(octal, 8) & 255)
                elif c not in b"\r\n":
                    out.append(_ESCAPES.get(c, c))
                continue
            level += (c == 40) - (c == 41)
            if level == 0:
                break
            out.append(c)
        return bytes(out)


class File:
    """The objects of a file by number.

    The cross-reference chain says where each live object stands. Where it is missing
    or wrong, objects are read wherever they stand and the last of a number counts.
    """

    def __init__(self, data: bytes):
        if b"%PDF-" not in data[:1024]:
            raise ValueError("not a PDF file")
        self.data = data
        self.objects: dict[int, object] = {}
        self.streams: dict[int, tuple[dict, bytes]] = {}
        self.generation: dict[int, int] = {}
        self.security: Security | None = None
        try:
            self.trailer, places, inside = self.references()
        except (ValueError, KeyError, IndexError, TypeError, AttributeError, zlib.error):
            self.trailer, places, inside = {}, None, None
        for m in re.finditer(rb"(?<![0-9])(\d+)\s+(\d+)\s+obj\b", data):
            number = int(m[1])
            if places is not None and places.get(number) != m.start():
                continue
            reader = Reader(data, m.end())
            value = reader.value()
            self.objects[number], self.generation[number] = value, int(m[2])
            self.streams.pop(number, None)
            reader.blank()
            if isinstance(value, dict) and data.startswith(b"stream", reader.at):
                start = reader.at + 6
                start += 2 if data.startswith(b"\r\n", start) else 1
                self.streams[number] = (value, (start, data))
        for number in list(self.streams):
            head, (start, whole) = self.streams[number]
            self.streams[number] = (head, self.body(head, start, whole))
        if not self.trailer and (m := re.search(rb"/Encrypt\s+(\d+)\s+\d+\s+R", data)):
            ident = re.search(rb"/ID\s*\[", data)
            self.trailer = {"Encrypt": Ref(int(m[1])), "ID": Reader(data, ident.end() - 1).value() if ident else []}
        if "Encrypt" in self.trailer:
            given, ident = self.get(self.trailer["Encrypt"]), self.get(self.trailer.get("ID")) or [b""]
            if not isinstance(given, dict):
                raise ValueError("an encrypted file")
            self.security = Security({k: self.get(v) for k, v in given.items()}, ident[0])
        for number in [k for k, (h, _) in self.streams.items() if h.get("Type") == "ObjStm"]:
            head, body = self.streams[number][0], self.decoded(number)
            reader = Reader(body)
            pairs = [(reader.value(), reader.value()) for _ in range(self.get(head["N"]))]
            for own, at in pairs:
                if inside is None or inside.get(own) == number:
                    self.objects.setdefault(own, Reader(body, self.get(head["First"]) + at).value())

    def body(self, head: dict, start: int, whole: bytes) -> bytes:
        size = self.get(head.get("Length"))
        sound = isinstance(size, int) and whole[start + size : start + size + 20].lstrip().startswith(b"endstream")
        end = start + size if sound else whole.find(b"endstream", start)
        return whole[start : end if end >= 0 else len(whole)]

    def references(self) -> tuple[dict, dict[int, int], dict[int, int]]:
        """The trailer, the place of every live object, and the stream of those that stand in one; raises where the chain is damaged.

        The newest part of the chain comes first, and what it says of a number holds.
        """
        data = self.data
        at = int(re.search(rb"startxref\s+(\d+)(?!.*startxref)", data[-2048:], re.S)[1])
        trailer: dict = {}
        said: dict[int, tuple[int, int]] = {}  # number -> kind, place or stream
        seen: set[int] = set()
        todo = [at]
        while todo:
            at = todo.pop(0)
            if at in seen:
                continue
            seen.add(at)
            reader = Reader(data, at)
            first = reader.value()
            if first == "xref":
                while isinstance(start := reader.value(), int):
                    count = reader.value()
                    for k in range(count):
                        place, _, kind = reader.value(), reader.value(), reader.value()
                        said.setdefault(start + k, (1 if kind == "n" else 0, place))
                own = reader.value()
            else:
                if reader.value() is None or reader.value() != "obj":
                    raise ValueError("no cross-reference at its place")
                own = reader.value()
                reader.blank()
                start = data.index(b"stream", reader.at) + 6
                start += 2 if data.startswith(b"\r\n", start) else 1
                body = self.content(own, self.body(own, start, data))
                widths, index = own["W"], own.get("Index") or [0, own["Size"]]
                numbers = [n for a, c in zip(index[::2], index[1::2], strict=True) for n in range(a, a + c)]
                step = sum(widths)
                for k, number in enumerate(numbers):
                    row, values = body[k * step : (k + 1) * step], []
                    for w in widths:
                        values.append(int.from_bytes(row[:w], "big"))
                        row = row[w:]
                    said.setdefault(number, (values[0] if widths[0] else 1, values[1]))
            trailer = {**own, **trailer}
            todo += [own[k] for k in ("XRefStm", "Prev") if isinstance(own.get(k), int)]
        places = {n: p for n, (kind, p) in said.items() if kind == 1}
        for number, place in places.items():
            if not re.compile(rb"%d\s+\d+\s+obj\b" % number).match(data, place):
                raise ValueError("a cross-reference to another place")
        if not isinstance(trailer.get("Root"), Ref):
            raise ValueError("a trailer without a root")
        return trailer, places, {n: p for n, (kind, p) in said.items() if kind == 2}

    def get(self, value: object) -> object:
        for _ in range(DEPTH):
            if not isinstance(value, Ref):
                return value
            value = self.objects.get(int(value))
        return None

    def content(self, head: dict, body: bytes) -> bytes:
        """A stream's body through its filters."""
        listed = lambda v: v if isinstance(v, list) else [] if v is None else [v]
        filters = [self.get(f) for f in listed(self.get(head.get("Filter")))]
        parms = [self.get(p) or {} for p in listed(self.get(head.get("DecodeParms")))]
        plain = [{k: self.get(v) for k, v in p.items()} for p in parms] + [{}] * (len(filters) - len(parms))
        return unfiltered(body, filters, plain[: len(filters)])

    def decoded(self, number: int) -> bytes:
        head, body = self.streams[number]
        if self.security is not None and head.get("Type") != "XRef":
            body = self.security.opened(body, number, self.generation.get(number, 0))
        return self.content(head, body)

    def stream(self, value: object) -> bytes:
        """The bytes of a stream or of several in a row; what cannot be read is empty."""
        if isinstance(value, Ref) and int(value) in self.streams:
            return self.decoded(int(value))
        value = self.get(value)
        return b"\n".join(self.stream(v) for v in value) if isinstance(value, list) else b""

    def pages(self) -> Iterator[dict]:
        """Page dictionaries in order, with what they inherit."""
        root = self.get(self.trailer.get("Root"))
        if not isinstance(root, dict) or "Pages" not in root:
            root = next((o for o in reversed(self.objects.values()) if isinstance(o, dict) and o.get("Type") == "Catalog"), None)
        if root is None:
            raise ValueError("a file without a catalogue")
        todo, seen = [(root.get("Pages"), {})], set()
        while todo:
            ref, given = todo.pop()
            node = self.get(ref)
            if not isinstance(node, dict) or (isinstance(ref, Ref) and int(ref) in seen):
                continue
            seen.add(int(ref) if isinstance(ref, Ref) else id(node))
            own = given | {k: node[k] for k in ("Resources", "MediaBox") if k in node}
            if "Kids" in node:
                todo += [(k, own) for k in reversed(self.get(node["Kids"]) or [])]
            else:
                yield node | own


def unicode_map(body: bytes) -> dict[int, str]:
    """Code -> text of a character map."""
    out: dict[int, str] = {}
    text = lambda b: b.decode("utf-16-be", "replace")
    number = lambda b: int.from_bytes(b, "big")
    reader, held = Reader(body), []
    while (v := reader.value()) is not None:
        if v == "endbfchar":
            out |= {number(a): text(b) for a, b in zip(held[::2], held[1::2], strict=False) if isinstance(a, bytes) and isinstance(b, bytes)}
        elif v == "endbfrange":
            for a, z, to in zip(held[::3], held[1::3], held[2::3], strict=False):
                if not isinstance(a, bytes) or not isinstance(z, bytes):
                    continue
                for k in range(min(number(z) - number(a) + 1, 1 << 16)):
                    out[number(a) + k] = text(to[k]) if isinstance(to, list) and k < len(to) else text(to[:-1] + bytes([(to[-1] + k) & 255])) if isinstance(to, bytes) and to else ""
        held = [] if isinstance(v, str) and not isinstance(v, Name) else [*held, v]
    return out


class Font:
    """Texts and widths (in thousandths) of codes."""

    def __init__(self, file: File, spec: dict):
        self.known = unicode_map(file.stream(spec["ToUnicode"])) if "ToUnicode" in spec else {}
        self.wide = file.get(spec.get("Subtype")) == "Type0"
        self.widths: dict[int, float] = {}
        self.default, self.named = 500.0, {}
        if self.wide:
            inner = file.get((file.get(spec.get("DescendantFonts")) or [{}])[0]) or {}
            self.default = file.get(inner.get("DW", 1000))
            items = [file.get(x) for x in file.get(inner.get("W")) or []]
            while items:
                first, second, *rest = items
                if isinstance(second, list):
                    self.widths |= {first + k: file.get(w) for k, w in enumerate(second)}
                    items = rest
                else:
                    self.widths |= dict.fromkeys(range(first, second + 1), rest[0])
                    items = rest[1:]
        else:
            start = file.get(spec.get("FirstChar", 0)) or 0
            self.widths = {start + k: file.get(w) for k, w in enumerate(file.get(spec.get("Widths")) or [])}
            encoding = file.get(spec.get("Encoding"))
            at = 0
            for x in file.get(encoding.get("Differences")) or [] if isinstance(encoding, dict) else []:
                if isinstance(x, int):
                    at = x
                elif isinstance(x, Name):
                    hexed = re.fullmatch(r"uni([0-9A-F]{4})", x)
                    self.named |= {at: chr(int(hexed[1], 16)) if hexed else x} if hexed or len(x) == 1 else {"space": {at: " "}}.get(x, {})
                    at += 1

    def glyphs(self, data: bytes) -> Iterator[tuple[str, float, bool]]:
        """(text, width, whether it is the one-byte space) of each code."""
        codes = [int.from_bytes(data[k : k + 2], "big") for k in range(0, len(data), 2)] if self.wide else list(data)
        for c in codes:
            plain = None if self.wide else self.named.get(c) or bytes([c]).decode("cp1252", "ignore")
            yield self.known.get(c) or plain or f"(cid:{c})", float(self.widths.get(c, self.default) or 0), c == 32 and not self.wide


def _times(a: tuple, b: tuple) -> tuple:
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


ONE = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


def glyphs(file: File, page: dict) -> Iterator[tuple[str, float, float, float, float]]:
    """(text, x0, x1, base line from below, size) in drawing order."""
    fonts: dict[str, Font] = {}
    specs = file.get((file.get(page.get("Resources")) or {}).get("Font")) or {}
    reader, args = Reader(file.stream(page.get("Contents"))), []
    whole, saved, line, text = ONE, [], ONE, ONE
    font, size, spacing, word, scale, leading, rise = None, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0

    def show(data: bytes) -> Iterator[tuple[str, float, float, float, float]]:
        nonlocal text
        for said, width, space in font.glyphs(data) if font else ():
            step = (width / 1000 * size + spacing + (word if space else 0.0)) * scale
            place = _times((size * scale, 0.0, 0.0, size, 0.0, rise), _times(text, whole))
            end = _times((1.0, 0.0, 0.0, 1.0, width / 1000 * size * scale, 0.0), _times(text, whole))
            yield said, place[4], end[4], place[5], (place[2] ** 2 + place[3] ** 2) ** 0.5
            text = _times((1.0, 0.0, 0.0, 1.0, step, 0.0), text)

    def down(x: float, y: float) -> None:
        nonlocal line, text
        line = text = _times((1.0, 0.0, 0.0, 1.0, x, y), line)

    while (v := reader.value()) is not None:
        if not isinstance(v, str) or isinstance(v, Name):
            args.append(v)
            continue
        numbers = [float(a) for a in args if isinstance(a, (int, float))]
        if v == "q":
            saved.append((whole, font, size, spacing, word, scale, leading, rise))
        elif v == "Q" and saved:
            whole, font, size, spacing, word, scale, leading, rise = saved.pop()
        elif v == "cm" and len(numbers) == 6:
            whole = _times(tuple(numbers), whole)
        elif v == "BT":
            line = text = ONE
        elif v == "Tf" and len(args) == 2:
            if args[0] not in fonts:
                fonts[args[0]] = Font(file, file.get(specs.get(args[0])) or {})
            font, size = fonts[args[0]], numbers[0]
        elif v == "Tm" and len(numbers) == 6:
            line = text = tuple(numbers)
        elif v in ("Td", "TD") and len(numbers) == 2:
            leading = -numbers[1] if v == "TD" else leading
            down(*numbers)
        elif v == "T*":
            down(0.0, -leading)
        elif v in ("Tc", "Tw", "Tz", "TL", "Ts") and numbers:
            spacing, word, scale, leading, rise = (
                numbers[0] if v == "Tc" else spacing, numbers[0] if v == "Tw" else word, numbers[0] / 100 if v == "Tz" else scale, numbers[0] if v == "TL" else leading, numbers[0] if v == "Ts" else rise,
            )
        elif v in ("Tj", "'", '"') and args and isinstance(args[-1], bytes):
            if v == '"' and len(numbers) == 2:
                word, spacing = numbers
            if v != "Tj":
                down(0.0, -leading)
            yield from show(args[-1])
        elif v == "TJ" and args and isinstance(args[-1], list):
            for part in args[-1]:
                if isinstance(part, bytes):
                    yield from show(part)
                elif isinstance(part, (int, float)):
                    text = _times((1.0, 0.0, 0.0, 1.0, -part / 1000 * size * scale, 0.0), text)
        elif v == "BI":  # an inline image: on to its end
            end = re.compile(rb"\sEI\b").search(reader.data, reader.at)
            reader.at = end.end() if end else len(reader.data)
        args = []


def page_words(file: File, page: dict) -> tuple[float, list[dict]]:
    """Width of a page, and its words: glyphs of one line without a gap or a blank between."""
    box = [float(file.get(v)) for v in file.get(page.get("MediaBox")) or (0, 0, 612, 792)]
    words: list[dict] = []
    open_word = False
    for said, x0, x1, base, size in glyphs(file, page):
        if not said.strip():
            open_word = False
            continue
        top = box[3] - base - ASCENT * size
        last = words[-1] if words else None
        if open_word and last and abs(last["top"] - top) <= GAP and -GAP <= x0 - box[0] - last["x1"] <= GAP:
            last |= {"text": last["text"] + said, "x1": x1 - box[0], "bottom": max(last["bottom"], box[3] - base)}
        else:
            words.append({"text": said, "x0": x0 - box[0], "x1": x1 - box[0], "top": top, "bottom": box[3] - base, "size": size})
        open_word = True
    return box[2] - box[0], words


def pages(data: bytes) -> Iterator[tuple[int, float, list[dict]]]:
    """(number from 1, width, words) of each page; a page is let go before the next."""
    file = File(data)
    for number, page in enumerate(file.pages(), 1):
        yield number, *page_words(file, page)
