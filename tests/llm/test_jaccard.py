import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm import jaccard
from quernstone.llm.hot import join_back
from quernstone.llm.jaccard import alike, band_starts, differing, jaccard_join, parities, possible, shingle_set, signatures
from quernstone.llm.tokens import mix


def set_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)} or ({" ".join(words)} if words else set())


def brute(rows):
    sets, name = [set_of(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 90 * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                name[y] = x
    ids = [[d for k, (d, _) in enumerate(rows) if root(k) == root(i) and d is not None] for i in range(len(rows))]
    return [(d, len(sets[i]), min(ids[i], default=None)) for i, (d, _) in enumerate(rows)]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, v or 0) for v in r])


def of_numbers(numbers):
    return np.sort(mix(np.array(sorted(numbers), np.uint64)))


@pytest.mark.parametrize("text", ["", " \t", "one", "One two", "a b c", "a b c a b c", "É x\x0by É x\x1c y", "w " * 50 + "long" * 40])
def test_shingle_set(text, monkeypatch):
    assert len(shingle_set(text.encode())) == len(set_of(text))
    whole = jaccard.word_codes(text.encode())
    assert (jaccard.word_codes(text.encode(), 3) == whole).all()


def test_bands_reach_every_linked_size():
    starts = band_starts(5000)
    for size in range(1, 4000):
        own = int(np.searchsorted(starts, size, side="right")) - 1
        assert 100 * size // 90 < starts[own + 2]
    assert differing(8) == 0 and differing(10) == 1


@pytest.mark.parametrize("size", [9, 10, 11, 19, 40, 95, 300, 1500])
def test_linked_sets_share_a_signature(size):
    rng = random.Random(size)
    for _ in range(40):
        base = set(rng.sample(range(10**9), size))
        other = set(base)
        # As different as a link allows: elements go, elements come.
        while True:
            grown = set(other)
            if rng.random() < 0.5:
                grown.remove(rng.choice(sorted(grown)))
            if rng.random() < 0.5:
                grown.add(rng.randrange(10**9))
            if 100 * len(base & grown) < 90 * len(base | grown):
                break
            other = grown
        a, b = of_numbers(base), of_numbers(other)
        assert alike(a, b)
        if base != other:
            assert len(np.intersect1d(signatures(a), signatures(b)))
        rows = list(possible([parities(a), parities(b)], np.array([len(a), len(b)]), np.zeros(2, int), np.array([1, 2])))
        assert sum(len(x) for x, _ in rows) == 1


def test_far_sets_are_told_apart_by_parities():
    rng = random.Random(1)
    sets = [of_numbers(rng.sample(range(10**9), 300)) for _ in range(40)]
    left = sum(len(a) for a, _ in possible([parities(s) for s in sets], np.full(40, 300), np.zeros(40, int), np.arange(40)))
    assert left == 0


def corpus(seed, n_groups=12):
    """Groups of chains: neighbours are linked, ends are not; copies, short texts and a shared passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    rows, passage = [], " ".join(word() for _ in range(60))
    for g in range(n_groups):
        words = [word() for _ in range(rng.choice((11, 14, 40, 150)))]
        for _ in range(rng.randint(2, 9)):
            rows.append(" ".join(words))
            words = list(words)
            words[rng.randrange(len(words))] = word()
            if rng.random() < 0.5:
                words = words[1:]
        rows += [rows[-1]] * rng.randint(0, 4)
    rows += [passage + " " + " ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(30)]
    rows += ["", " ", "one", "One", "one two", "a b c", "A b C", "a b c d"]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("block", [2, 512])
def test_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HEADED", block)
    rows = corpus(block)
    got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert in_order(got.collect()) == in_order(brute(rows))


def test_close_sets_that_no_representative_links(spark):
    # One base text, copies with two changed words each: most pairs of copies lie about the threshold.
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.sample(range(120), 2):
            words[k] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert in_order(got.collect()) == in_order(brute(rows))


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (3, None), (2, ""), (2, ""), (None, None), (None, "quite alone here"), (7, "x " * 3000), (8, "x x x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("x")).withColumn("node", F.lit(1))
    assert in_order(jaccard_join(docs).collect()) == in_order(brute(rows))
    assert jaccard_join(docs.limit(0)).count() == 0


def test_join_back_splits_hot_keys(spark):
    rows = spark.range(4000).selectExpr("id", "CASE WHEN id < 3000 THEN -1 ELSE id END AS k")
    groups = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    got = join_back(rows, groups, ["k"], "n")
    assert got.columns == ["k", "id", "v"] or set(got.columns) == {"k", "id", "v"}
    assert got.where("v = 2 * k").count() == 4000
