"""Benchmark decontamination by latent semantic retrieval.

Documents are reduced to their words that occur in the benchmark, with places.
Passages are windows of words under TF-IDF weights, with document frequencies
over the whole corpus. A randomised singular value decomposition of the passages
that are heavy enough to matter, and of the benchmark's own, is run over the
cluster: one pass sketches the row space, a second gives the small matrix whose
eigenvectors turn the sketch into singular vectors. Passages whose cosine with a
benchmark passage, in the latent space, reaches a threshold are candidates. Each
is judged on words alone: the longest common subsequence of the item and the
words around, and whether the item's answer, its last words, is there too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.columns import spare
from quernstone.llm.tokens import word_blocks
from quernstone.session import materialise


@dataclass(frozen=True)
class Config:
    """``window`` words a passage, ``rank`` latent dimensions, thresholds of both tests.

    An item is found where ``share`` of its words stand in order in the words
    around a candidate, or ``weak_share`` and ``answer_share`` of its answer. Around
    are the item's number of benchmark words to each side, so that the reach grows
    where other words stand between them, up to ``spread`` times the item's length.
    A passage is a candidate if its energy (the sum of its squared weights) is
    ``gate`` of the lightest item's at least and its cosine ``cosine``: an item so
    thinned out that 24 words hold less of it is not found. The latent space is fitted
    on the corpus's passages of ``fit_gate``. ``benchmark_bytes``
    bounds the benchmark, which every task holds, ``space_bytes`` the matrix of its
    words and the latent dimensions, which the driver holds too, and ``scores`` the
    similarities computed at once. A pass over the corpus sums one
    sparse matrix a task; ``gather`` partitions make a task, at least ``fit_tasks``.
    """

    window: int = 24
    rank: int = 256
    benchmark_weight: float = 30.0
    oversample: int = 32
    max_df: float = 0.1
    least_features: int = 6
    gate: float = 0.3
    fit_gate: float = 0.45
    cosine: float = 0.45
    share: float = 0.8
    weak_share: float = 0.6
    answer_share: float = 0.9
    spread: int = 5
    fit_tasks: int = 256
    gather: int = 16
    benchmark_bytes: int = 64 << 20
    space_bytes: int = 256 << 20
    scores: int = 1 << 20
    seed: int = 2


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    places: dict[int, int] = {}
    for k, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if hit := places.get(w):
            met = row & hit
            row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


@dataclass
class Items:
    """The benchmark: sorted vocabulary of hashes; of each item its id and words."""

    ids: list[int]
    words: list[np.ndarray]
    vocabulary: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        ids, words = [], []
        rows = [(i, t) for i, t in rows if t]
        for first, w in word_blocks(pa.array([t for _, t in rows], pa.string())):
            for k, own in enumerate(np.split(w.hashes, np.searchsorted(w.text, np.arange(1, w.n_texts)))):
                if len(own):
                    ids.append(rows[first + k][0])
                    words.append(own)
        vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        return cls(ids, [np.searchsorted(vocabulary, w) for w in words], vocabulary)


def benchmark_words(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, text_hash, at, word): places and vocabulary numbers of benchmark words."""
    held = docs.sparkSession.sparkContext.broadcast(items.vocabulary)
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = dict(slim.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash long, at array<int>, word array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = held.value
        for batch in batches:
            for row, w in word_blocks(batch.column("text")):
                first = np.searchsorted(w.text, np.arange(w.n_texts + 1))
                number = np.searchsorted(vocabulary, w.hashes)
                number[number == len(vocabulary)] = 0
                own = np.flatnonzero(vocabulary[number] == w.hashes) if len(vocabulary) else np.zeros(0, np.int64)
                cut = pa.array(np.searchsorted(own, first).astype(np.int32))
                at = (own - first[w.text[own]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, w.n_texts),
                        batch.column("text_hash").slice(row, w.n_texts),
                        pa.ListArray.from_arrays(cut, pa.array(at)),
                        pa.ListArray.from_arrays(cut, pa.array(number[own].astype(np.int32))),
                    ],
                    names=["doc_id", "text_hash", "at", "word"],
                )

    return slim.mapInArrow(run, schema)


@dataclass
class Batch:
    """Words of some documents: row, place and number of each; where each row starts."""

    row: np.ndarray
    at: np.ndarray
    word: np.ndarray
    first: np.ndarray

    @classmethod
    def each(cls, batch: pa.RecordBatch, words: int = 1 << 15) -> Iterator[tuple[int, int, Batch]]:
        """(first row, end, batch): runs of rows of about ``words`` words, long rows alone."""
        ends, a = np.asarray(batch.column("at").offsets)[1:].astype(np.int64), 0
        while a < batch.num_rows:
            base = ends[a - 1] if a else np.int64(batch.column("at").offsets[0].as_py())
            z = max(a + 1, int(np.searchsorted(ends, base + words, side="right")))
            yield a, z, cls.of(batch.slice(a, z - a))
            a = z

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Batch:
        at, word = batch.column("at"), batch.column("word")
        first = np.asarray(at.offsets) - at.offsets[0].as_py()
        row = np.repeat(np.arange(len(at)), np.diff(first))
        return cls(row, at.flatten().to_numpy().astype(np.int64), word.flatten().to_numpy(), first)


@dataclass
class Space:
    """Features (-1: none) and weights of vocabulary words, the gate, and item passages."""

    config: Config
    feature: np.ndarray
    weight: np.ndarray
    gate: float
    n_features: int
    basis: np.ndarray | None = None
    item_of: np.ndarray | None = None
    item_latent: np.ndarray | None = None

    def passages(self, b: Batch) -> Passages:
        """The passages heavy enough; one starts every half window and covers two cells of that length."""
        half = self.config.window // 2
        f = self.feature[b.word]
        own = np.flatnonzero(f >= 0)
        key = b.row[own] * (np.int64(1) << 32) + b.at[own] // half
        order = np.argsort(key, kind="stable")
        key, f, w = key[order], f[own][order], self.weight[b.word[own]][order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        cells = key[start]
        energy = np.append(np.add.reduceat(w.astype(np.float64) ** 2, start) if len(key) else np.zeros(0), 0.0)
        starts = np.union1d(cells, cells[(cells & 0xFFFFFFFF) > 0] - 1)
        covered = []
        for k in (starts, starts + 1):
            at = np.minimum(np.searchsorted(cells, k), max(len(cells) - 1, 0))
            covered.append(np.where(cells[at] == k, at, -1) if len(cells) else np.zeros(0, np.int64))
        sums = energy[covered[0]] + energy[covered[1]]
        heavy = sums >= self.gate
        low, high = covered[0][heavy], covered[1][heavy]
        # Cells that no such passage covers go, the others are numbered anew.
        used = np.zeros(len(cells) + 1, bool)
        used[low] = used[high] = True
        used[-1] = False
        number = np.where(used, np.cumsum(used) - 1, -1)
        size = np.diff(np.r_[start, len(key)])
        entry = np.repeat(used[:-1], size)
        chosen = starts[heavy]
        return Passages(chosen >> 32, (chosen & 0xFFFFFFFF) * half, number[low], number[high], np.repeat(number[:-1], size)[entry], f[entry], sums[heavy])


@dataclass
class Passages:
    """Row and first place of each passage, its two cells (-1: none) and energy; (cell, feature) entries in order of cell.

    A passage is the sum of its cells, so each word is met once. A feature has one
    weight: who multiplies scales the other matrix by the weights beforehand.
    """

    row: np.ndarray
    place: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cell: np.ndarray
    feature: np.ndarray
    energy: np.ndarray

    def times(self, onto: np.ndarray) -> np.ndarray:
        """Rows of the passage matrix times a matrix, given scaled by the features' weights."""
        z = _project(self.cell, self.feature, onto)
        z = np.concatenate((z, np.zeros((1, onto.shape[1]), z.dtype)))
        return z[self.low] + z[self.high]

    def back(self, y: np.ndarray, out: np.ndarray) -> np.ndarray:
        """``out``, to which the transposed passage matrix times ``y`` is added, still to be scaled by the weights."""
        total = np.zeros((int(self.cell[-1]) + 2 if len(self.cell) else 1, y.shape[1]), y.dtype)
        for of in (self.low, self.high):
            total[of[of >= 0]] += y[of >= 0]
        return _back(self.cell, self.feature, total, out)


def _project(passage: np.ndarray, f: np.ndarray, onto: np.ndarray) -> np.ndarray:
    """Rows of a sparse matrix, given by entries in order, times ``onto``; every row has an entry."""
    if not len(passage):
        return np.zeros((0, onto.shape[1]), onto.dtype)
    start = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    out = np.empty((len(start), onto.shape[1]), onto.dtype)
    ends = np.r_[start[1:], len(passage)]
    for a in range(0, len(start), 512):
        z = min(a + 512, len(start))
        lo, hi = start[a], ends[z - 1]
        out[a:z] = np.add.reduceat(onto[f[lo:hi]], start[a:z] - lo, axis=0)
    return out


def _back(passage: np.ndarray, f: np.ndarray, y: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``out`` with the transposed sparse matrix times ``y`` added."""
    order = np.argsort(f, kind="stable")
    for a in range(0, len(order), 1 << 13):
        o = order[a : a + (1 << 13)]
        start = np.flatnonzero(np.r_[True, f[o][1:] != f[o][:-1]])
        out[f[o][start]] += np.add.reduceat(y[passage[o]], start, axis=0)
    return out


#: Rows of a matrix that are summed as one.
_ROWS = 1024


def _summed(table: DataFrame, shape: tuple[int, int], part: Callable[[Batch, np.ndarray], None], config: Config) -> np.ndarray:
    """The sum of what ``part`` adds to a matrix for each batch.

    A task sends its matrix in runs of rows, without those that are zero; equal
    runs are added up in tasks of their own, so none holds all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for _, _, b in Batch.each(batch):
                part(b, total)
        for at in range(0, shape[0], _ROWS):
            rows = total[at : at + _ROWS]
            if rows.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([rows.tobytes()], pa.binary())], names=["at", "m"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(min(_ROWS, shape[0] - rows.column("at")[0].as_py()) * shape[1])
        for m in rows.column("m"):
            total += np.frombuffer(m.as_buffer(), dtype=np.float64)
        return pa.table({"at": rows.column("at").slice(0, 1), "m": pa.array([total.tobytes()], pa.binary())})

    tasks = max(config.fit_tasks, table.rdd.getNumPartitions() // config.gather)
    each = table.select("at", "word").coalesce(tasks).mapInArrow(run, "at long, m binary")
    out = np.zeros(shape)
    for r in each.groupBy("at").applyInArrow(add, "at long, m binary").toLocalIterator():
        out[r["at"] : r["at"] + _ROWS] = np.frombuffer(r["m"], dtype=np.float64).reshape(-1, shape[1])
    return out


def _item_batch(items: Items) -> Batch:
    sizes = [len(w) for w in items.words]
    return Batch(np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes]), np.concatenate(items.words), np.r_[0, np.cumsum(sizes)])


def fit_space(table: DataFrame, items: Items, config: Config) -> Space:
    """Weights, gate and latent basis from the whole corpus and the benchmark."""
    n_words = len(items.vocabulary)

    def counted(b: Batch, total: np.ndarray) -> None:
        once = np.unique(b.row * np.int64(n_words) + b.word)
        df = np.bincount(once % n_words, minlength=n_words)
        total[:, 0] += np.r_[df, len(b.first) - 1]

    counts = _summed(table, (n_words + 1, 1), counted, config)[:, 0]
    df, n_docs = counts[:-1], counts[-1]
    idf = np.log((n_docs + 1) / (df + 1)) + 1e-6
    usable = df <= config.max_df * n_docs
    for w in items.words:  # an item of common words keeps its rarest
        own = np.unique(w)
        usable[own[np.argsort(df[own], kind="stable")[: config.least_features]]] = True
    feature = np.where(usable, np.cumsum(usable) - 1, -1).astype(np.int64)
    n = int(usable.sum())
    space = Space(config, feature, idf.astype(np.float32), 0.0, n)
    own = _item_batch(items)
    whole = space.passages(own)
    row, energy = whole.row, whole.energy
    best = np.zeros(len(items.words))
    np.maximum.at(best, row, energy)
    space.gate = float(config.fit_gate * best.min())

    width = min(n, config.rank + config.oversample)
    if 8 * n * width > config.space_bytes:
        raise ValueError(f"{n} benchmark words in {width} dimensions are more than {config.space_bytes} bytes; give the benchmark in parts")
    scale = space.weight[usable][:, None]
    omega = np.random.default_rng(config.seed).normal(size=(n, width)).astype(np.float32) * scale
    bench = whole.times(omega)
    held = table.sparkSession.sparkContext.broadcast((space, omega))

    def sketched(b: Batch, total: np.ndarray) -> None:
        s, o = held.value
        p = s.passages(b)
        p.back(p.times(o), total[:-1])
        total[-1] += len(p.row)

    sketch = _summed(table, (n + 1, width), sketched, config)
    # The benchmark's passages weigh so many times all the corpus's together.
    level = config.benchmark_weight * max(1.0, sketch[-1, 0]) / len(bench)
    q, _ = np.linalg.qr((sketch[:-1] + level * whole.back(bench, np.zeros((n, width)))) * scale)
    q = q.astype(np.float32) * scale
    turned = table.sparkSession.sparkContext.broadcast((space, q))

    def squared(b: Batch, total: np.ndarray) -> None:
        s, o = turned.value
        y = s.passages(b).times(o)
        total += y.T @ y

    y = whole.times(q).astype(np.float64)
    small = _summed(table, (width, width), squared, config) + level * y.T @ y
    _, vectors = np.linalg.eigh(small)
    space.basis = (q @ vectors[:, ::-1][:, : config.rank]).astype(np.float32)
    z = whole.times(space.basis)
    space.gate = float(config.gate * best.min())
    space.item_of = row
    # Scaled so that a benchmark passage has similarity 1 with itself, however
    # much of it the latent space keeps.
    space.item_latent = z * (np.sqrt(energy) / np.maximum((z * z).sum(axis=1), 1e-9))[:, None].astype(np.float32)
    return space


def judge(item: list[int], around: list[int], config: Config) -> tuple[float, bool]:
    """Share of the item found in order in the words around, and whether that is a leak."""
    share = common_subsequence(item, around) / len(item)
    if share >= config.share:
        return share, True
    answer = item[-max(3, len(item) // 5) :]
    return share, share >= config.weak_share and common_subsequence(answer, around) >= config.answer_share * len(answer)


def find_leaks(docs: DataFrame, benchmark: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Per row of ``docs``: doc_id, text_hash, contaminated, item_id, share, n_candidates, item_ids.

    item_ids lists every item found, in order. item_id and share are of the item
    best found, one that is a leak before others (ties: the smaller id), null and 0
    where no passage was a candidate. Null and empty texts hold no words; null and
    empty items are no items. A repeated item counts once for each id. Repeated rows
    are judged each, long texts whole; an empty table gives no rows. Other columns
    are not read. The benchmark is gathered, so its size is checked against
    ``benchmark_bytes`` and that of its latent space against ``space_bytes``.
    """
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > config.benchmark_bytes:
        raise ValueError(f"the benchmark has {size} bytes; give it in parts of at most {config.benchmark_bytes}")
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").collect()
    items = Items.of(sorted((r[0], r[1]) for r in rows))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_hash long, contaminated boolean, item_id long, share double, n_candidates int, item_ids array<long>"
    if not items.ids:
        return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.lit(False).alias("contaminated"), F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("share"), F.lit(0).alias("n_candidates"), F.array().cast("array<long>").alias("item_ids"))
    table = materialise(benchmark_words(docs, items), "benchmark-words")
    space = fit_space(table, items, config)
    held = docs.sparkSession.sparkContext.broadcast((space, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, items = held.value
        words = [w.tolist() for w in items.words]
        for batch in batches:
            for first, end, b in Batch.each(batch):
                yield judged(space, items, words, batch.slice(first, end - first), b)

    def judged(space: Space, items: Items, words: list[list[int]], batch: pa.RecordBatch, b: Batch) -> pa.RecordBatch:
        whole = space.passages(b)
        row, place = whole.row, whole.place
        met: dict[tuple[int, int], list[int]] = {}
        if len(row):
            z = whole.times(space.basis)
            z /= np.sqrt(whole.energy)[:, None].astype(np.float32)
            step = max(1, space.config.scores // len(space.item_latent))
            for a in range(0, len(z), step):
                p, i = np.nonzero(z[a : a + step] @ space.item_latent.T >= space.config.cosine)
                for r, s, item in zip(row[a + p].tolist(), place[a + p].tolist(), space.item_of[i].tolist(), strict=True):
                    met.setdefault((r, item), []).append(s)
        n = batch.num_rows
        bad, best, share, count = np.zeros(n, bool), np.full(n, -1), np.zeros(n), np.zeros(n, np.int32)
        found: list[list[int]] = [[] for _ in range(n)]
        for (r, item), places in sorted(met.items()):
            count[r] += 1
            own = slice(b.first[r], b.first[r + 1])
            at, word = b.at[own], b.word[own]
            reach, far = len(words[item]), space.config.spread * len(words[item])
            leaks, top, seen = False, 0.0, (0, 0)
            for s in sorted(set(places)):
                near = np.searchsorted(at, (s, s + space.config.window))
                bounds = np.searchsorted(at, (s - far, s + space.config.window + far))
                lo, hi = max(near[0] - reach, bounds[0]), min(near[1] + reach, bounds[1])
                if lo >= seen[0] and hi <= seen[1]:  # part of what was judged before
                    continue
                seen = (lo, hi)
                got, leak = judge(words[item], word[lo:hi].tolist(), space.config)
                leaks, top = leaks or leak, max(top, got)
            if leaks:
                found[r].append(items.ids[item])
            if (leaks, top) > (bool(bad[r]), share[r]):
                share[r], best[r] = top, item
            bad[r] |= leaks
        names = np.array(items.ids)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(bad), pa.array(names[np.maximum(best, 0)].astype(np.int64), mask=best < 0), pa.array(share), pa.array(count), pa.array([sorted(x) for x in found], pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "contaminated", "item_id", "share", "n_candidates", "item_ids"],
        )

    return table.mapInArrow(run, schema)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """``docs`` without the rows that hold a benchmark item.

    Columns stay, whatever their names. Rows with null or empty texts hold no item
    and stay; of repeated rows all go or all stay, null ids included. Texts are
    read whole. An empty table gives no rows, an empty benchmark drops none.
    """
    ident, digest = spare("_id", docs), spare("_hash", docs)
    bad = find_leaks(docs, benchmark, config).where("contaminated").select(F.col("doc_id").alias(ident), F.col("text_hash").alias(digest))
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(ident)) & (F.xxhash64(docs["text"]) == F.col(digest)), "left_anti")
