"""Dictionary forms in texts by an Aho-Corasick automaton.

One walk over a text with failure links meets every occurrence of every form, so
the cost follows the text and what is found, not the size of the dictionary. Of the
occurrences that are whole words the leftmost are taken, of those the longest, and
none that overlaps one taken before.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame


def folded(text: str) -> tuple[str, list[int] | None]:
    """``text`` case-folded and, where that changes lengths, the place in ``text`` of each character and of the end."""
    out = text.casefold()
    if len(out) == len(text):
        return out, None
    places, parts = [], []
    for k, c in enumerate(text):
        part = c.casefold()
        parts.append(part)
        places += [k] * len(part)
    return "".join(parts), [*places, len(text)]


def _word(c: str) -> bool:
    return c == "_" or c.isalnum()


class Forms:
    """The forms of a dictionary, by case or (``fold``) without; empty ones are left out."""

    def __init__(self, forms: Mapping[str, tuple[str, str]], fold: bool = False):
        self.fold, self.found = fold, ahocorasick.Automaton()
        for form, entry in forms.items():
            if key := form.casefold() if fold else form:
                self.found.add_word(key, (len(key), entry))
        if len(self.found):
            self.found.make_automaton()

    def spans(self, text: str) -> list[tuple[int, int, tuple[str, str]]]:
        """(start, end, entry) of whole words in order, leftmost and longest."""
        if not len(self.found) or not text:
            return []
        shown, places = folded(text) if self.fold else (text, None)
        met = []
        for last, (size, entry) in self.found.iter(shown):
            start, end = last + 1 - size, last + 1
            if places is not None:  # a form may not begin or end inside what one character became
                if (start and places[start - 1] == places[start]) or places[end - 1] == places[end]:
                    continue
                start, end = places[start], places[end]
            if not (start and _word(text[start - 1])) and not (end < len(text) and _word(text[end])):
                met.append((start, end, entry))
        met.sort(key=lambda m: (m[0], -m[1]))
        out, upto = [], 0
        for m in met:
            if m[0] >= upto:
                out.append(m)
                upto = m[1]
        return out


def match_forms(texts: DataFrame, forms: Mapping[str, tuple[str, str]], key: str, text: str = "text", fold: bool = False) -> DataFrame:
    """(key, pos, start, end, name, kind): the dictionary's forms in each text, in order.

    The automaton is built once and broadcast; it is as large as the dictionary,
    whatever the texts. One pass, no shuffle; a null text holds nothing.
    """
    held = texts.sparkSession.sparkContext.broadcast(Forms(forms, fold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            at, rows = [], []
            for k, t in enumerate(batch.column(text).to_pylist()):
                for pos, (start, end, entry) in enumerate(own.spans(t or "")):
                    at.append(k)
                    rows.append((pos, start, end, *entry))
            if rows:
                pos, start, end, name, kind = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at)), *(pa.array(c, pa.int32()) for c in (pos, start, end)), pa.array(name), pa.array(kind)], names=[key, "pos", "start", "end", "name", "kind"])

    return texts.select(key, text).mapInArrow(run, f"{key} {dict(texts.dtypes)[key]}, pos int, start int, end int, name string, kind string")
