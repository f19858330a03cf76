"""A statistical guess of a text's language from runs of three characters.

Training counts the runs of labelled texts by language in one aggregation that is
combined within tasks; a run's weight in a language is the logarithm of its smoothed
share there, in thousandths as an integer, so sums are exact in any order. A text
goes to the language with the largest sum. Texts that are too short get the default,
texts without a known run the guess by function words. Workers fold case, number
characters and look runs up by tables, a block of texts at a time.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.session import materialise

#: Bits of a character in the number of a run; runs of a model at most.
BITS, MOST = 21, 200_000
#: Bits of a common character; a model's runs of those are found by one table of 2**21 places.
FEW = 7
_SPACE = ord(" ")


@cache
def folded() -> np.ndarray:
    """What each character counts as: letters and marks in lower case, one by one as SQL does, all others a space."""
    out = np.full(sys.maxunicode + 1, _SPACE, np.int32)
    for code in range(sys.maxunicode + 1):
        low = chr(code).lower()[0]
        if unicodedata.category(low)[0] in "LM":
            out[code] = ord(low)
    return out


def _characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def letters(texts: list[str], kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, and the place of the space before each text and after the last.

    Whatever is between letters becomes one space, and there is one at each end,
    which neighbours share; a text without letters has no place of its own. ``kept``
    may give other numbers for the characters of ``folded``; 0 is the space there.
    """
    raw = _characters(f" {' '.join(texts)} ")
    out, space = (folded().take(raw), _SPACE) if kept is None else (kept.take(raw), 0)
    first = out != space
    first[1:] |= out[:-1] != space  # the first of several spaces stays
    first[0] = True
    before = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return out[first], np.cumsum(first)[before] - 1


def _numbers(data: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The number of every run of three characters."""
    made = data[:-2] << bits
    made |= data[1:-1]
    made <<= bits
    made |= data[2:]
    return made


def runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The number of every run of three characters of some texts as they are, and the text each is from."""
    data = _characters("".join(t or "" for t in texts)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t or "") for t in texts])
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = owner[:-2] == owner[2:]
    return _numbers(data)[whole], owner[:-2][whole]


def letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every run of three of the ``letters`` of some texts in order of its number, and how often it occurs."""
    data, ends = letters(texts)
    made = _numbers(data.astype(np.int64))
    across = ends - 1  # these have the space between two texts in the middle
    return np.unique(np.delete(made, np.unique(across[(across >= 0) & (across < len(made))])), return_counts=True)


def blocks(column: pa.Array, size: int = 1 << 20) -> Iterator[list[str]]:
    """The texts of a column in order, in runs of about ``size`` characters; null is empty, bytes that are no UTF-8 no letters."""
    held, n = [], 0
    for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        held.append((t.as_py() or b"").decode("utf-8", "replace"))
        n += len(held[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


@dataclass(frozen=True)
class LanguageModel:
    """Numbers of the runs in order, a weight for each language, the weight of other runs, the languages."""

    grams: np.ndarray
    weights: np.ndarray
    unknown: np.ndarray
    languages: tuple[str, ...]


class Places:
    """Where a model has each run of some texts, and what texts sum up to.

    The characters in most of the model's runs have small numbers, so their runs are
    looked up in a table; runs with any other one are searched for.
    """

    def __init__(self, model: LanguageModel):
        self.model = model
        parts = [model.grams >> 2 * BITS, model.grams >> BITS & (1 << BITS) - 1, model.grams & (1 << BITS) - 1]
        chars, n = np.unique(np.concatenate(parts), return_counts=True)
        chars, n = chars[chars != _SPACE], n[chars != _SPACE]
        common = chars[np.argsort(-n, kind="stable")][: (1 << FEW) - 2]
        self.other = (1 << FEW) - 1  # any other letter
        few = np.full(sys.maxunicode + 1, self.other, np.int32)
        few[_SPACE] = 0
        few[common] = np.arange(1, len(common) + 1)
        self.few = few.take(folded())
        # Runs that are not in the model have the place after its last.
        self.weights = np.vstack([model.weights, model.unknown]).T.astype(np.int64, order="C")
        self.table = np.full(1 << 3 * FEW, len(model.grams), np.int32)
        small = [few[p] for p in parts]
        inside = np.logical_and.reduce([p != self.other for p in small])
        self.table[(small[0] << 2 * FEW | small[1] << FEW | small[2])[inside]] = np.flatnonzero(inside)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The place of every run, and the place of the space before each text and after the last."""
        data, ends = letters(texts, self.few)
        place = self.table.take(_numbers(data, FEW)).astype(np.intp)
        rare = data == self.other
        if rare.any():
            at = np.flatnonzero(rare[:-2] | rare[1:-1] | rare[2:])
            whole = letters(texts)[0].astype(np.int64)
            made = whole[at] << 2 * BITS | whole[at + 1] << BITS | whole[at + 2]
            grams = self.model.grams
            found = np.searchsorted(grams, made)
            place[at] = np.where(grams.take(found, mode="clip") == made, found, len(grams)) if len(grams) else 0
        return place, ends

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row a text of its sums by language; how many of its runs the model knows."""
        place, ends = self.of(texts)
        start = np.minimum(ends[:-1], len(place))
        end = np.maximum(start, ends[1:] - 1)

        def added(values: np.ndarray) -> np.ndarray:
            upto = np.zeros(len(values) + 1, np.int64)
            np.cumsum(values, out=upto[1:])
            return upto[end] - upto[start]

        own = [added(w.take(place)) for w in self.weights]
        return np.array(own, np.int64).reshape(len(own), len(texts)).T, added(place < len(self.model.grams))


def train(docs: DataFrame, text: str = "text", language: str = "lang", most: int = MOST) -> LanguageModel:
    """A model of the labelled texts: the ``most`` commonest runs over all languages, which bounds it.

    Texts or languages that are null are left out. Counts are exact over all texts.
    """
    slim = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(language).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang")
            for name in names.unique().to_pylist():
                for texts in blocks(batch.column("text").filter(pc.equal(names, name))):
                    own, n = letter_runs(texts)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(own), pa.string()), pa.array(own), pa.array(n)], names=["lang", "gram", "n"])

    counted = materialise(slim.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-runs")
    common = counted.groupBy("gram").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "gram").limit(most).select("gram")
    totals = {r["lang"]: int(r["n"]) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()}  # a row a language
    distinct = counted.select("gram").distinct().count()
    rows = counted.join(F.broadcast(common), "gram").toPandas()  # bounded by ``most`` and the languages
    grams = np.unique(rows["gram"].to_numpy(np.int64))
    languages = tuple(sorted(totals))
    n = np.zeros((len(grams), len(languages)), np.int64)
    if len(rows):
        n[np.searchsorted(grams, rows["gram"].to_numpy(np.int64)), np.searchsorted(languages, rows["lang"].to_numpy(str))] = rows["n"].to_numpy(np.int64)
    size = np.array([totals[k] for k in languages], np.float64) + distinct + 1
    weigh = lambda c: np.floor(1000 * np.log((c + 1) / size)).astype(np.int64)
    return LanguageModel(grams, weigh(n.astype(np.float64)), weigh(np.zeros(len(languages))), languages)


def guess(docs: DataFrame, model: LanguageModel, text: str = "text", default: str = T.DEFAULT_LANGUAGE) -> DataFrame:
    """``docs`` with ``language``, ``score`` (the sum of weights) and ``margin`` over the next language.

    Ties go to the first language by name. A text of under LEAST_FOR_LANGUAGE
    characters once normalised gets ``default``; one without a run that the model
    knows gets the guess by function words; both have no score and no margin. The
    model is broadcast; its size is bounded when it is trained.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        places = Places(held.value)
        languages = pa.array(held.value.languages, pa.string())
        for column in columns:
            names, best, margin = [pa.array([], pa.string())], [pa.array([], pa.int64())], [pa.array([], pa.int64())]
            for texts in blocks(column):
                sums, hits = places.sums(texts)
                none = (hits == 0) | (len(languages) == 0)
                top = -np.sort(-sums, axis=1) if len(languages) else np.zeros((len(texts), 1), np.int64)
                pick = sums.argmax(axis=1) if len(languages) else np.zeros(len(texts), np.int64)
                names.append(languages.take(pa.array(pick, mask=none)))
                best.append(pa.array(top[:, 0], mask=none))
                margin.append(pa.array(top[:, 0] - top[:, 1], mask=none) if len(languages) > 1 else pa.nulls(len(texts), pa.int64()))
            yield pa.StructArray.from_arrays([pa.concat_arrays(x) for x in (names, best, margin)], names=["language", "score", "margin"])

    scored = F.arrow_udf(score, "language string, score long, margin long")
    short = T.is_short(F.col(text), T.LEAST_FOR_LANGUAGE)
    said = docs.withColumn("_said", F.when(short, F.lit(None)).otherwise(scored(F.col(text))))
    language = F.when(short, F.lit(default)).otherwise(F.coalesce(F.col("_said.language"), T.function_word_language(F.col(text), default)))
    return said.withColumns({"language": language, "score": F.col("_said.score"), "margin": F.col("_said.margin")}).drop("_said")
