"""Splitting documents into sentence-preserving fragments.

A document is one row with an ordered array of blocks, so the folds below run
inside a row: no shuffle, and a document's size bounds a task's memory. The
greedy packing is also given as a native fold for texts that are already cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import sentences as rules
from quernstone.functions import text as T


@dataclass(frozen=True)
class ChunkConfig:
    """Fixed values of the chunker: words aimed at, word and token caps, and the rest."""

    target_words: int = 190
    max_words: int = 240
    max_tokens: int = 450
    min_words: int = 40
    overlap: int = 1
    boundary_level: int = 6
    keep_atomic: bool = True
    count_tokens: Callable[[str], int] | None = None

    def tokens(self, text: str) -> int:
        return self.count_tokens(text) if self.count_tokens else math.ceil(len(text.split()) * T.TOKENS_PER_WORD)


BLOCKS = "array<struct<text: string, kind: string, level: int, path: array<string>, page: int, atomic: boolean, sentences: array<string>>>"
FRAGMENT = (
    "chunk_id string, position int, n_tokens int, text string, enriched string, section array<string>, page int, "
    "n_words int, unit string, overlaps boolean, n_sentences int, data array<map<string,string>>"
)


#: Documents that a worker turns into Python's at once, fragments it sends at once.
DOCUMENTS, SENT = 16, 512
FRAGMENT_NAMES = "chunk_id position n_tokens text enriched section page n_words unit overlaps n_sentences data".split()


def pack_words(sizes: Column, target: int = 190, most: int = 240) -> Column:
    """Group number of each item of an array of word counts, packed greedily in order.

    A group closes once it has ``target`` words, or where the next item would
    take it over ``most``; an item over the cap stands alone.
    """
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("group"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, n: Column) -> Column:
        close = (F.size(acc["out"]) > 0) & ((acc["words"] + n > most) | (acc["words"] >= target))
        group = acc["group"] + close.cast("int")
        return F.struct(F.when(close, n).otherwise(acc["words"] + n).alias("words"), group.alias("group"), F.concat(acc["out"], F.array(group)).alias("out"))

    return F.aggregate(F.transform(sizes, lambda n: n.cast("long")), start, step, lambda acc: acc["out"])


def accumulate_records(sizes: Column, least: int = 40, target: int = 190) -> Column:
    """Group number of each record: short ones gather until ``target`` words, others stand alone.

    Records of a group are joined by a separator that counts as one word.
    """
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("group"), F.lit(True).alias("fresh"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, n: Column) -> Column:
        alone = n >= least
        group = acc["group"] + (alone & ~acc["fresh"]).cast("int")
        words = F.when(acc["fresh"], n).otherwise(acc["words"] + 1 + n)
        done = alone | (words >= target)
        return F.struct(
            F.when(done, F.lit(0).cast("long")).otherwise(words).alias("words"), (group + done.cast("int")).alias("group"), done.alias("fresh"), F.concat(acc["out"], F.array(group)).alias("out")
        )

    return F.aggregate(F.transform(sizes, lambda n: n.cast("long")), start, step, lambda acc: acc["out"])


class _Sentence:
    """A sentence and its words, counted once."""

    __slots__ = ("text", "page", "title", "words")

    def __init__(self, text: str, page: int | None, title: bool):
        self.text, self.page, self.title, self.words = text, page, title, len(text.split())


class Chunker:
    """The folds over one document."""

    def __init__(self, config: ChunkConfig):
        self.config = config
        self.merged = 0  # orphans that joined a neighbour

    def sections(self, blocks: list[dict]) -> list[dict]:
        """Runs of blocks that packing does not cross, each with its breadcrumb."""
        out: list[dict] = []
        anchor: list[str] = []
        for b in blocks:
            title = b["kind"] == "title"
            path = [*(b["path"] or ()), *([b["text"]] if title else ())]
            atomic = bool(b["atomic"]) and self.config.keep_atomic
            boundary = title and b["level"] is not None and b["level"] <= self.config.boundary_level
            current = out[-1] if out else None
            opens = current is None or atomic != current["atomic"] or boundary or path[: len(anchor)] != anchor
            if opens:
                anchor = path
                waiting = current is not None and title and atomic == current["atomic"] and all(x["kind"] == "title" for x in current["blocks"])
                if waiting:  # titles in a row share a section, under the deepest
                    current["crumb"] = path
                else:
                    out.append({"crumb": path, "atomic": atomic, "blocks": []})
            out[-1]["blocks"].append(b)
        return out

    def fits(self, group: list[_Sentence], budget: int) -> bool:
        words = sum(s.words for s in group)
        if words > self.config.max_words:
            return False
        # The estimate needs the words alone; a tokenizer needs the text.
        return (self.config.tokens(" ".join(s.text for s in group)) if self.config.count_tokens else math.ceil(words * T.TOKENS_PER_WORD)) <= budget

    def pack(self, items: list[_Sentence], budget: int) -> list[list[_Sentence]]:
        groups: list[list[_Sentence]] = [[]]
        size = 0
        for s in items:
            now = groups[-1]
            if now and (size >= self.config.target_words or size + s.words > self.config.max_words or not self.fits([*now, s], budget)):
                groups.append([])
                size = 0
            groups[-1].append(s)
            size += s.words
        return [g for g in groups if g]

    def mend(self, groups: list[list[_Sentence]], budget: int) -> list[list[_Sentence]]:
        """Groups of too few words join the next one, else the one before, where that fits."""
        groups, k = list(groups), 0
        while k < len(groups) > 1:
            small = sum(s.words for s in groups[k]) < self.config.min_words
            ahead = small and k + 1 < len(groups) and self.fits(groups[k] + groups[k + 1], budget)
            back = small and not ahead and k > 0 and self.fits(groups[k - 1] + groups[k], budget)
            if ahead or back:
                at = k if ahead else k - 1
                groups[at : at + 2] = [groups[at] + groups[at + 1]]
                self.merged += 1
            else:
                k += 1
        return groups

    def overlapped(self, groups: list[list[_Sentence]], budget: int) -> Iterator[tuple[list[_Sentence], bool]]:
        """Each group with the last sentences of the one before, where that fits."""
        for before, own in zip([[], *groups], groups, strict=False):
            longer = before[-self.config.overlap :] + own if before and self.config.overlap > 0 else own
            taken = len(longer) > len(own) and self.fits(longer, budget)
            yield (longer if taken else own), taken

    def records(self, section: dict) -> Iterator[list[dict]]:
        held: list[dict] = []
        for b in section["blocks"]:
            if len(b["text"].split()) >= self.config.min_words:
                if held:
                    yield held
                held = []
                yield [b]
            else:
                held.append(b)
                if len(" · ".join(x["text"] for x in held).split()) >= self.config.target_words:
                    yield held
                    held = []
        if held:
            yield held

    def cut(self, parts: list[str], page: int | None, title: bool) -> list[_Sentence]:
        """Sentences; one over the word cap is cut at inner punctuation where that loses nothing."""
        out = []
        for p in parts:
            whole = _Sentence(p, page, title)
            if whole.words <= self.config.max_words:
                out.append(whole)
                continue
            words, inner = p.split(" "), [[]]
            for w in words:
                inner[-1].append(w)
                if w[-1:] in tuple(".!?。"):
                    inner.append([])
            out += [_Sentence(" ".join(x), page, title) for x in inner if x]
        return out

    def prepared(self, blocks: list[dict], observatory: str | None, title: str | None) -> list[tuple[dict, str, int, list[_Sentence]]]:
        """Sections with their prefix, budget and (of those that are packed) sentences; target and overlap play no part."""
        c, out = self.config, []
        for section in self.sections(blocks):
            crumb = section["crumb"]
            prefix = " · ".join(p for p in ((observatory or "").strip(), (title or "").strip(), " > ".join(crumb)) if p)
            budget = max(1, c.max_tokens - c.tokens(prefix)) if prefix else c.max_tokens
            out.append((section, prefix, budget, [] if section["atomic"] else [s for b in section["blocks"] for s in self.cut(b["sentences"], b["page"], b["kind"] == "title")]))
        return out

    def prose(self, items: list[_Sentence], budget: int) -> list[list[_Sentence]]:
        return self.mend(self.pack(items, budget), budget)

    def fragments(self, doc: str, blocks: list[dict], observatory: str | None, title: str | None) -> list[dict]:
        c, out = self.config, []
        for section, prefix, budget, items in self.prepared(blocks, observatory, title):
            crumb = section["crumb"]
            found: list[tuple[list[_Sentence], bool, str, list]] = []
            if section["atomic"]:
                for rows in self.records(section):
                    text = " · ".join(b["text"] for b in rows)
                    whole = self.cut([text], rows[0]["page"], False) if len(text.split()) <= c.max_words else self.cut([s for b in rows for s in b["sentences"]], rows[0]["page"], False)
                    aside = [b["data"] for b in rows if b.get("data")]
                    found += [(g, False, "atomic", aside) for g in ([whole] if len(text.split()) <= c.max_words else self.pack(whole, budget))]
            else:
                groups = self.prose(items, budget)
                lone = len(groups) == 1 and all(s.title for s in groups[0])
                found += [(g, o, "orphan_title" if lone else "prose", []) for g, o in self.overlapped(groups, budget)]
            for group, overlaps, unit, aside in found:
                text, n_words = " ".join(s.text for s in group), sum(s.words for s in group)
                out.append(
                    {
                        "chunk_id": f"{doc}-c{len(out):04d}", "position": len(out), "n_tokens": c.tokens(text) if c.count_tokens else math.ceil(n_words * T.TOKENS_PER_WORD), "text": text,
                        "enriched": f"{prefix}\n{text}" if prefix else text, "section": crumb, "page": next((s.page for s in group if s.page is not None), None),
                        "n_words": n_words, "unit": unit, "overlaps": overlaps, "n_sentences": len(group), "data": aside,
                    }
                )
        return out


def few(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, of which only DOCUMENTS are Python's at a time."""
    for at in range(0, batch.num_rows, DOCUMENTS):
        yield from batch.slice(at, DOCUMENTS).to_pylist()


def _cut(docs: DataFrame, language: str) -> DataFrame:
    """(doc_id, blocks, observatory, title) with normalised blocks, the empty ones dropped, and their sentences."""
    kept = "data" in docs.schema["blocks"].dataType.elementType.names
    data = lambda b: b["data"] if kept else F.lit(None).cast("map<string,string>")
    slim = lambda b, t: F.struct(t.alias("text"), *(b[c].alias(c) for c in ("kind", "level", "path", "page", "atomic")), data(b).alias("data"))
    clean = F.filter(F.transform("blocks", lambda b: slim(b, T.normalised(b["text"]))), lambda b: F.length(b["text"]) > 0)
    cut = F.transform(clean, lambda b: b.withField("sentences", rules.sentences(b["text"], language)))
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), cut.alias("blocks"), "observatory", "title")


def fragment_documents(docs: DataFrame, config: ChunkConfig = ChunkConfig(), language: str = "es") -> DataFrame:  # noqa: B008
    """Fragments of (doc_id, blocks, observatory, title): one row each, FRAGMENT columns.

    ``blocks`` is an array of (text, kind, level, path, page, atomic), and data where
    rows keep some: it goes along with the fragments of atomic rows. Texts are
    normalised and empty blocks dropped; sentences are cut in the plan, folds run
    in one Arrow pass over whole documents. A document without blocks gives none.
    """
    ready = _cut(docs, language)
    schema = "doc_id string, " + FRAGMENT
    names = ["doc_id", *FRAGMENT_NAMES]
    kinds = {"position": pa.int32(), "n_tokens": pa.int32(), "section": pa.list_(pa.string()), "page": pa.int32(), "n_words": pa.int32(), "overlaps": pa.bool_(), "n_sentences": pa.int32(), "data": pa.list_(pa.map_(pa.string(), pa.string()))}
    arrow = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker = Chunker(config)
        for batch in batches:
            rows: list[dict] = []
            for r in few(batch):
                for f in chunker.fragments(r["doc_id"], r["blocks"] or [], r["observatory"], r["title"]):
                    rows.append({"doc_id": r["doc_id"], **f})
                    if len(rows) >= SENT:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return ready.mapInArrow(run, schema)


def sweep(docs: DataFrame, targets: tuple[int, ...] = (120, 190, 240), overlaps: tuple[int, ...] = (0, 1), language: str = "es") -> DataFrame:
    """The corpus fragmented anew with each target and overlap, measured: one row a configuration.

    n_fragments, median_words and p95_words (nearest rank, 0 without fragments),
    one_sentence and merged_orphans (percentages of the fragments, one decimal).
    Sentences are cut and counted once for all, packed once a target; tasks send a
    histogram of fragment sizes a batch, so a configuration gathers no more rows than
    fragments have sizes.
    """
    configs = [(t, o) for t in targets for o in overlaps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunkers = [Chunker(ChunkConfig(target_words=t, overlap=o)) for t, o in configs]
        for batch in batches:
            counts: dict[tuple[int, int, int], list[int]] = {}
            for r in few(batch):
                ready = chunkers[0].prepared(r["blocks"] or [], r["observatory"], r["title"])
                if any(section["atomic"] for section, *_ in ready):
                    sizes = [((t, o), f["n_words"], f["n_sentences"]) for (t, o), chunker in zip(configs, chunkers, strict=True) for f in chunker.fragments(r["doc_id"], r["blocks"] or [], r["observatory"], r["title"])]
                else:
                    sizes = []
                    for k in range(0, len(configs), len(overlaps)):
                        own = chunkers[k : k + len(overlaps)]
                        for _, _, budget, items in ready:
                            before = own[0].merged
                            groups = own[0].prose(items, budget)
                            for chunker in own[1:]:
                                chunker.merged += own[0].merged - before
                            for config, chunker in zip(configs[k : k + len(overlaps)], own, strict=True):
                                sizes += [(config, sum(s.words for s in g), len(g)) for g, _ in chunker.overlapped(groups, budget)]
                for config, n_words, n_sentences in sizes:
                    held = counts.setdefault((*config, n_words), [0, 0, 0])
                    held[0] += 1
                    held[1] += n_sentences == 1
            for (t, o), chunker in zip(configs, chunkers, strict=True):
                counts.setdefault((t, o, 0), [0, 0, 0])[2] += chunker.merged
                chunker.merged = 0
            yield pa.RecordBatch.from_pylist([{"target": t, "overlap": o, "n_words": w, "n": n, "single": s, "merged": m} for (t, o, w), (n, s, m) in counts.items()])

    def measure(rows: pa.Table) -> pa.Table:
        sizes = sorted((r["n_words"], r["n"]) for r in rows.to_pylist())
        total, single, merged = (sum(rows.column(c).to_pylist()) for c in ("n", "single", "merged"))

        def rank(p: int) -> int:
            left = max(1, math.ceil(p / 100 * total))
            for words, n in sizes:
                left -= n
                if left <= 0:
                    return words
            return 0

        share = lambda part: round(100 * part / total, 1) if total else 0.0
        first = {c: rows.column(c)[0].as_py() for c in ("target", "overlap")}
        return pa.Table.from_pylist([{**first, "n_fragments": total, "median_words": rank(50), "p95_words": rank(95), "one_sentence": share(single), "merged_orphans": share(merged)}])

    sizes = _cut(docs, language).mapInArrow(run, "target long, overlap long, n_words long, n long, single long, merged long")
    # Every configuration has a row, without documents too.
    none = docs.sparkSession.createDataFrame([(t, o, 0, 0, 0, 0) for t, o in configs], sizes.schema)
    summed = sizes.union(none).groupBy("target", "overlap", "n_words").agg(*(F.sum(c).alias(c) for c in ("n", "single", "merged")))
    return summed.groupBy("target", "overlap").applyInArrow(measure, "target long, overlap long, n_fragments long, median_words long, p95_words long, one_sentence double, merged_orphans double")


def fragment_violations(fragments: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:  # noqa: B008
    """Fragments that break an invariant, with messages."""
    checks = {
        "empty text": F.length("text") == 0,
        "text is not normalised": F.col("text") != T.normalised(F.col("text")),
        "word count differs": F.col("n_words") != T.word_count(F.col("text")),
        "too many words": (F.col("n_words") > config.max_words) & (F.col("n_sentences") > 1),
        "bad unit": ~F.col("unit").isin("prose", "atomic", "orphan_title"),
        "id differs": F.col("chunk_id") != T.fragment_id(F.col("doc_id"), F.col("position")),
        "enriched text lacks the text": ~F.col("enriched").endswith(F.col("text")),
    }
    found = F.filter(F.array(*(F.when(c, F.lit(m)) for m, c in checks.items())), lambda m: m.isNotNull())
    return fragments.select("chunk_id", found.alias("violations")).where(F.size("violations") > 0)
