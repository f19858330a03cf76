"""A convolutional text classifier for toxicity, trained in numpy.

Each word is the sum of hashed embeddings of the word and of its first bytes
(so that inflected forms share a part). Filters of several widths slide over the
words; each filter keeps its largest value over the whole text, and a logistic
layer on these maxima gives the raw score. Scores are calibrated on rows that
training left out, and each language gets a threshold there; language never
enters a score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quernstone.llm.columns import spare
from quernstone.llm.tokens import Words, word_blocks

#: Threshold of the calibrated score that all languages have until they get their own.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Config:
    """Model and training parameters.

    ``sample`` bounds the labelled rows fitted on, ``sample_bytes`` their texts.
    """

    buckets: int = 1 << 16
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    prefixes: tuple[int, ...] = (4, 6)
    sample: int = 8000
    sample_bytes: int = 64 << 20
    epochs: int = 6
    batch: int = 32
    rate: float = 0.01
    seed: int = 9
    threshold: float = THRESHOLD


@dataclass
class Model:
    """Weights; ``thresholds`` by language apply to calibrated scores."""

    config: Config
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    scale: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0]))
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fresh(cls, config: Config) -> Model:
        rng = np.random.default_rng(config.seed)
        n = len(config.widths) * config.filters
        return cls(
            config,
            rng.normal(0, 0.1, (config.buckets, config.dim)).astype(np.float32),
            [rng.normal(0, 0.3, (w * config.dim, config.filters)).astype(np.float32) for w in config.widths],
            np.zeros(n, np.float32),
            np.concatenate((rng.normal(0, 0.3, n), [0.0])).astype(np.float32),
        )

    def buckets_of(self, words: Words) -> np.ndarray:
        """Embedding rows of each word: the word itself, then its prefixes."""
        kinds = [words.hashes, *(words.prefixes(p) + np.uint64(p) for p in self.config.prefixes)]
        return np.stack([(h % np.uint64(self.config.buckets)).astype(np.int32) for h in kinds], axis=1)

    def features(self, buckets: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Largest filter values of each text and the words where they start (-1: none).

        A text with fewer words than a filter is wide gets 0 there.
        """
        c, n = self.config, len(buckets)
        top = np.zeros((n_texts, len(self.bias)), np.float32)
        at = np.full((n_texts, len(self.bias)), -1, np.int64)
        if not n:
            return top, at
        word = self.embed[buckets[:, 0]]
        for k in range(1, buckets.shape[1]):
            word = word + self.embed[buckets[:, k]]
        for k, (w, weights) in enumerate(zip(c.widths, self.filters, strict=True)):
            own = slice(k * c.filters, (k + 1) * c.filters)
            if n < w:
                continue
            value = sum(word[i : n - w + 1 + i] @ weights[i * c.dim : (i + 1) * c.dim] for i in range(w))
            whole = np.flatnonzero(text[: n - w + 1] == text[w - 1 :])
            if not len(whole):
                continue
            value, owner = value[whole], text[whole]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.maximum.reduceat(value, first, axis=0)
            rows = owner[first]
            top[rows, own] = np.maximum(best + self.bias[own], 0)
            hit_row, hit_col = np.nonzero(value == np.repeat(best, np.diff(np.r_[first, len(owner)]), axis=0))
            at[owner[hit_row], k * c.filters + hit_col] = whole[hit_row]
        return top, at

    def raw(self, top: np.ndarray) -> np.ndarray:
        return top @ self.out[:-1] + self.out[-1]

    def score(self, words: Words) -> np.ndarray:
        """Calibrated scores, 0 to 1, of the texts of ``words``."""
        top, _ = self.features(self.buckets_of(words), words.text, words.n_texts)
        z = self.scale[0] * self.raw(top).astype(np.float64) + self.scale[1]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _train(model: Model, texts: list[np.ndarray], labels: np.ndarray) -> None:
    """Adagrad on the logistic loss, with gradients through the maxima only."""
    c = model.config
    rng = np.random.default_rng(c.seed)
    params = [model.embed, *model.filters, model.bias, model.out]
    seen = [np.full(p.shape, 1e-4, np.float32) for p in params]
    weight = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-3), 0.5 / max(1 - labels.mean(), 1e-3)).astype(np.float32)
    step = c.rate * 5
    for _ in range(c.epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), c.batch):
            rows = order[k : k + c.batch]
            buckets = np.concatenate([texts[i] for i in rows])
            text = np.repeat(np.arange(len(rows)), [len(texts[i]) for i in rows])
            top, at = model.features(buckets, text, len(rows))
            error = ((1 / (1 + np.exp(-np.clip(model.raw(top), -40, 40)))) - labels[rows]) * weight[rows] / len(rows)
            grad_out = np.r_[error @ top, error.sum()].astype(np.float32)
            back = (error[:, None] * model.out[:-1]) * (top > 0) * (at >= 0)
            grad_bias = back.sum(axis=0)
            touched, pieces, grad_filters = [], [], []
            for j, w in enumerate(c.widths):
                own = slice(j * c.filters, (j + 1) * c.filters)
                grad = np.zeros_like(model.filters[j])
                r, f = np.nonzero(back[:, own])
                if len(r):
                    place, g = at[:, own][r, f], back[:, own][r, f]
                    for i in range(w):
                        b = buckets[place + i]
                        part = slice(i * c.dim, (i + 1) * c.dim)
                        np.add.at(grad[part].T, f, g[:, None] * model.embed[b].sum(axis=1))
                        piece = g[:, None] * model.filters[j][part].T[f]
                        for kind in range(b.shape[1]):
                            touched.append(b[:, kind])
                            pieces.append(piece)
                grad_filters.append(grad)
            for p, s, g in zip(params[1:], seen[1:], [*grad_filters, grad_bias, grad_out], strict=True):
                s += g * g
                p -= step * g / np.sqrt(s)
            if touched:
                unique, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                g = np.zeros((len(unique), c.dim), np.float32)
                np.add.at(g, inverse, np.concatenate(pieces))
                seen[0][unique] += g * g
                model.embed[unique] -= step * g / np.sqrt(seen[0][unique])


def _calibrate(z: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slope and offset of the logistic curve from raw scores to probabilities."""
    a, b = 1.0, 0.0
    target = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        d, w = p - target, np.maximum(p * (1 - p), 1e-6)
        g = np.array([(d * z).sum(), d.sum()]) + np.array([1e-3 * a, 0])
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-9]])
        delta = np.linalg.solve(h, g)
        a, b = a - np.clip(delta[0], -1, 1), b - np.clip(delta[1], -2, 2)
        if np.abs(delta).max() < 1e-6:
            break
    return np.array([max(a, 1e-3), b])


def fit(texts: list[str], labels: list[int], langs: list[str | None], config: Config = Config()) -> Model:  # noqa: B008
    """A model from labelled texts: four fifths train, one fifth calibrates.

    ``langs`` only serve to choose each language's threshold: the one of best
    F1 on the fifth left out, kept where the language has ten rows of each label
    there. Without rows of both labels the model scores all alike.
    """
    model = Model.fresh(config)
    y = np.array(labels, dtype=np.float32)
    if not len(y) or y.min() == y.max():
        model.out[:] = 0
        model.scale = np.array([1.0, 0.0 if not len(y) else (3.0 if y[0] else -3.0)])
        return model
    found: list[np.ndarray] = []
    for _, words in word_blocks(pa.array(texts, pa.string())):
        found += np.split(model.buckets_of(words), np.searchsorted(words.text, np.arange(1, words.n_texts)))
    fold = np.random.default_rng(config.seed + 1).permutation(len(y)) % 5 == 0
    if y[fold].min() == y[fold].max() or y[~fold].min() == y[~fold].max():
        fold = np.zeros(len(y), bool)
    train = np.flatnonzero(~fold)
    _train(model, [found[i] for i in train], y[train])
    rest = np.flatnonzero(fold) if fold.any() else train
    z = np.concatenate([model.raw(model.features(found[i], np.zeros(len(found[i]), np.int64), 1)[0]) for i in rest]).astype(np.float64)
    model.scale = _calibrate(z, y[rest])
    p = 1 / (1 + np.exp(-np.clip(model.scale[0] * z + model.scale[1], -40, 40)))
    for lang in sorted({x for x in langs if x}):
        own = np.array([langs[i] == lang for i in rest])
        good = y[rest][own] > 0
        if min(good.sum(), (~good).sum()) < 10:
            continue
        cuts = np.r_[np.linspace(0.05, 0.95, 19), config.threshold]
        f1 = [2 * (good & (p[own] >= t)).sum() / (good.sum() + (p[own] >= t).sum()) for t in cuts]
        best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
        model.thresholds[lang] = float(cuts[min(best, key=lambda i: abs(cuts[i] - config.threshold))])
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, config: Config) -> DataFrame:
    """(doc_id, text, lang, toxic), at most ``config.sample`` rows: the smallest hashes of an id.

    Rows that would pass ``config.sample_bytes`` together, in that order, are left
    out, and so is any text longer than that. Only ids for which crc32(id as text)
    mod 4 is not 2 take part. A null label or id does not count; an id that has
    both labels counts as toxic, one with several texts has the largest.
    """
    ident = F.col("doc_id").cast("string").cast("binary")
    known = labels.where("toxic is not null and doc_id is not null").where(F.crc32(ident) % 4 != 2)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    sizes = texts.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("size")).where(F.col("size") <= config.sample_bytes)
    order = F.xxhash64("doc_id")
    first = known.join(sizes, "doc_id").orderBy(order, "doc_id").limit(config.sample)
    total = F.sum("size").over(Window.orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, 0))  # over the sample's rows
    chosen = first.select("doc_id", "toxic", total.alias("total")).where(F.col("total") <= config.sample_bytes).select("doc_id", "toxic")
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max(F.struct("text", "lang")).alias("t"), F.max("toxic").alias("toxic"))
    return rows.select("doc_id", "t.text", "t.lang", "toxic")


def fit_on(docs: DataFrame, labels: DataFrame, config: Config = Config()) -> Model:  # noqa: B008
    """The model of :func:`fit` on :func:`labelled_sample`, fitted in one task.

    Only the weights come to the driver, buckets x dim floats.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")
        texts, labels, langs = (rows.column(c).to_pylist() for c in ("text", "toxic", "lang"))
        return pa.table({"model": pa.array([pickle.dumps(fit(texts, labels, langs, config))], pa.binary())})

    sample = labelled_sample(docs, labels, config)
    made = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(run, "model binary").first()
    return pickle.loads(made[0]) if made else fit([], [], [], config)


def score_documents(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Every row of ``docs`` with its score in column ``name``: the whole text is read, in one pass.

    A null text scores as an empty one does. A column of that name is replaced;
    others stay. Repeated rows stay, an empty table gives none. A text may be of
    any length: it is scored whole, alone where it is long. No shuffle.
    """
    kept = docs.drop(*(c for c in docs.columns if c.lower() == name.lower()))
    names = kept.columns
    schema = StructType([*kept.schema, StructField(name, DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: buckets x dim floats
    place = [c.lower() for c in names].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [held.value.score(words) for _, words in word_blocks(batch.column(place), 1 << 20)]
            made = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(names))), made], names=schema.names)

    return kept.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that reach their language's threshold; columns stay, one named score too."""
    name = spare("score", docs)
    return score_documents(docs, model, name).where(~is_toxic(model, name)).select(*docs.columns)


def is_toxic(model: Model, name: str = "score") -> F.Column:
    """Whether a scored row reaches its language's threshold (the common one where lang is null or unknown)."""
    cut = F.lit(model.config.threshold)
    for lang, t in sorted(model.thresholds.items()):
        cut = F.when(F.col("lang") == lang, t).otherwise(cut)
    return F.col(name) >= cut


def classify_documents(docs: DataFrame, labels: DataFrame, config: Config = Config()) -> DataFrame:  # noqa: B008
    """doc_id, held_out, score, predicted and flagged for every document.

    predicted compares the score with ``config.threshold``, flagged with the
    threshold of the row's language. A null doc_id counts as not held out, a null
    text as empty; long texts are read whole. Repeated rows stay. Empty tables give
    no rows; without labels of both kinds all scores are alike.
    """
    model = fit_on(docs, labels, config)
    scored = score_documents(docs.select("doc_id", "lang", "text"), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= config.threshold).cast("int").alias("predicted"),
        is_toxic(model).alias("flagged"),
    )
