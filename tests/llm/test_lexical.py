import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quernstone.llm.lexical import Config, Items, Range, postings, search_documents, terms, weights


def terms_of(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]


def brute(docs, items, top=10):
    held = [(i, terms_of(t)) for i, t in docs]
    n, total = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = Counter(w for _, ws in held for w in set(ws))
    out = []
    for ident, text in items:
        scored = []
        for doc, ws in held:
            tf, m = Counter(ws), 25 + (75 * len(ws) * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m)) for w in terms_of(text) if w in tf)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(ident, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scored)[:top])]
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, v or 0) for v in r])


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    made = lambda size: " ".join(rng.choice(words[: rng.choice((5, 20, 60))]) for _ in range(size))
    docs = [(k, made(rng.choice((1, 3, 3, 3, 10, 40)))) for k in range(n)]
    return docs, [(k, made(rng.randint(1, 6))) for k in range(25)]


@pytest.mark.parametrize("text", ["", "a.B c", "É x_y\x00Z", "ab c", "1:2@3[4`5{6\x7f7"])
def test_terms(text):
    assert [w.decode() for w in terms(text.encode())] == terms_of(text)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_many_ties(spark, seed):
    docs, items = corpus(seed)
    small = Config(documents=50, leaf=2, fan=3, terms=20)
    got = search_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), small)
    assert in_order(got.collect()) == in_order(brute(docs, items))


def test_bounds_hold_and_most_leaves_stay_shut(spark):
    docs, items = corpus(3, 2000)
    docs += [(9000, items[0][1] + " " + items[0][1])]
    known = Items.of(items)
    small = Config(documents=4096, leaf=4, fan=4)
    index = postings(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), known.vocabulary, small)
    weight, n, total = weights(index, len(known.vocabulary))
    part = Range(index.toArrow().combine_chunks().to_batches()[0], 0, n, total, small, np.arange(len(weight)))
    opened = []
    plain = part.scores
    part.scores = lambda leaf, *a: opened.append(leaf) or plain(leaf, *a)
    for t, c in zip(known.terms, known.counts, strict=True):
        columns, factors = part.of(t, weight[t] * c)
        leaves = part.bounds(0, slice(None), columns, factors)
        assert all(plain(k, columns, factors).max() <= b for k, b in enumerate(leaves))
        for low, high in zip(part.levels, part.levels[1:], strict=False):
            assert (high.max(axis=0) == low.max(axis=0)).all()
        best = sorted((s for k in range(len(leaves)) for s in plain(k, columns, factors)), reverse=True)[9]
        opened.clear()
        part.search(columns, factors, int(best))
        assert len(opened) <= (leaves >= best).sum() < len(leaves)


def test_equal_bounds_are_opened(spark):
    # Every document scores alike, so the smallest ids must win although all bounds tie.
    docs = [(k, "same words") for k in range(300, 0, -1)] + [(1000, "other")] * 5
    items = spark.createDataFrame([(1, "words"), (2, "other other")], "item_id long, text string")
    got = search_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), items, Config(documents=32, leaf=2, fan=2))
    rows = in_order(got.collect())
    assert [r[2] for r in rows if r[0] == 1] == [] or [r[2] for r in rows if r[0] == 1] == list(range(1, 11))
    assert rows == in_order(brute(docs, [(1, "words"), (2, "other other")]))


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(None, "rare word here"), (1, None), (2, ""), (3, "rare word"), (3, "rare word"), (4, "word " * 5000 + "rare"), (5, ".,!"), (6, "nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("item", F.lit(1))
    given = [(1, "rare word"), (1, "nothing"), (None, "rare"), (2, None), (3, " ")]
    items = spark.createDataFrame(given, "item_id long, text string").withColumn("rank", F.lit(1))
    got = search_documents(docs, items)
    assert got.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    assert in_order(got.collect()) == in_order(brute(rows, given))
    assert search_documents(docs.limit(0), items).count() == 0
    assert search_documents(docs, items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        search_documents(docs, items, Config(item_bytes=3))


def test_empty_range_has_a_tree():
    made = [pa.array([x]) for x in ([1], [0], [], [], [])]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    batch = pa.RecordBatch.from_arrays([m.cast(k) for m, k in zip(made, kinds, strict=True)], names=["ids", "lengths", "term", "doc", "tf"])
    part = Range(batch, 0, 0, 0, Config(), np.arange(1))
    assert part.search(*part.of(Items.of([(1, "x")]).terms[0], Items.of([(1, "x")]).counts[0]), 0) == []
