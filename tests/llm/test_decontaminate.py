import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quernstone.llm.decontaminate import Config, common_subsequence, drop_leaks, find_leaks
from quernstone.llm.queries import op2_decontamination


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=20), st.lists(st.integers(0, 4), max_size=20))
def test_common_subsequence(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    assert common_subsequence(a, b) == rows[-1][-1]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: text(rng.randint(15, 60)) for i in range(30)}
    docs, truth = [], {}
    for d in range(600):
        words = text(rng.randint(5, 400))
        if d % 6 == 0:
            item = items[d // 6 % 30]
            leak = list(item)
            if d % 12 == 0:  # a paraphrase: some words replaced, answer kept
                for k in rng.sample(range(len(leak) - len(leak) // 4), len(leak) // 6):
                    leak[k] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = leak
            truth[d] = d // 6 % 30
        docs.append((d, ", ".join(words).capitalize(), 1.0))
    return docs, [(i, " ".join(w)) for i, w in items.items()], truth


def test_planted_leaks(spark, planted):
    docs, items, truth = planted
    rows = find_leaks(spark.createDataFrame(docs, "doc_id long, text string, share double").repartition(5), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(rows) == len(docs)
    found = {r.doc_id: r.item_id for r in rows if r.contaminated}
    assert set(found) <= set(truth)
    assert len(found) >= 0.97 * len(truth) and all(truth[d] == i for d, i in found.items())


def test_odd_rows(spark, planted):
    _, items, _ = planted
    bench = spark.createDataFrame([*items, (None, "w1 w2"), (77, None), (78, ""), (79, items[3][1])], "item_id long, text string")
    docs = spark.createDataFrame([(None, None), (1, ""), (2, items[3][1]), (2, items[3][1]), (None, "x " * 50_000 + items[4][1])], "doc_id long, text string")
    rows = find_leaks(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.contaminated, r.item_id or 0) for r in rows if r.doc_id != 1) == [(0, False, 0), (0, True, 4), (2, True, 3), (2, True, 3)]
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert [r.contaminated for r in find_leaks(docs, bench.limit(0)).collect()] == [False] * 5
    with pytest.raises(ValueError):
        find_leaks(docs, bench, Config(benchmark_bytes=10))
    with pytest.raises(ValueError, match="in parts"):
        find_leaks(docs, bench, Config(space_bytes=1000))


def exhaustive(docs, items, spread=5):
    """Every item in every document by plain dynamic programming over all stretches that could hold it."""
    cut = lambda t: "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in t.lower()).split()
    wanted = {i: cut(t) for i, t in items if t and cut(t)}
    found = {}
    for d, t in docs:
        words = cut(t or "")
        for i, item in wanted.items():
            best = 0
            for s in range(0, max(1, len(words) - len(item) // 2), max(1, len(item) // 2)):
                best = max(best, common_subsequence(item, words[s : s + (spread + 1) * len(item)]))
            if best >= 0.8 * len(item):
                found.setdefault(d, set()).add(i)
    return found


@pytest.mark.parametrize("fillers", [0, 1, 2, 3])
def test_recall_of_diluted_and_paraphrased_leaks(spark, fillers):
    """Against the search of all stretches: nine of ten leaks at least, with up to three words between any two."""
    rng = random.Random(fillers)
    vocabulary = [f"w{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(15, 50)))) for i in range(25)]
    docs = []
    for d in range(200):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        if d % 2 == 0:
            leak = items[d // 2 % 25][1].split()
            for k in rng.sample(range(len(leak)), len(leak) // 10):
                leak[k] = rng.choice(vocabulary)
            thin = [w for x in leak for w in (x, *(f"filler{rng.randint(0, 900)}" for _ in range(fillers)))]
            at = rng.randint(0, len(words))
            words[at:at] = thin
        docs.append((d, " ".join(words)))
    truth = exhaustive(docs, items)
    rows = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r.doc_id: set(r.item_ids) for r in rows if r.contaminated}
    assert all(r.contaminated == bool(r.item_ids) for r in rows)
    pairs = {(d, i) for d, own in truth.items() for i in own}
    assert len(pairs) >= 95 and len(pairs & {(d, i) for d, own in got.items() for i in own}) >= 0.9 * len(pairs)
    assert set(got) <= set(truth)


def test_two_items_in_a_document(spark, planted):
    _, items, _ = planted
    docs = [(1, f"{items[2][1]} and then {items[5][1]}"), (2, None)]
    rows = {r.doc_id: r for r in find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert rows[1].item_ids == [2, 5] and rows[1].item_id in (2, 5) and rows[2].item_ids == []


def test_stage_keeps_clashing_columns(spark, planted):
    docs, items, truth = planted
    odd = spark.createDataFrame([(d, t, 1, 2, 3) for d, t, _ in docs[:40]], "doc_id long, text string, _id int, _hash int, share int")
    kept = drop_leaks(odd, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == odd.columns and not {r.doc_id for r in kept.collect()} & set(truth)


def test_query(spark, sf_dir):
    words = lambda t: f" {' '.join(''.join(c if c.isalnum() else ' ' for c in t.lower()).split())} "
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    verbatim = {d for d, t in docs.items() if any(i in t for i in items)}
    rows = op2_decontamination(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    assert verbatim <= {r.doc_id for r in rows if r.contaminated}


def test_query_against_the_search_of_all_stretches(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    pairs = {(d, i) for d, own in exhaustive(docs, items).items() for i in own}
    got = {(r.doc_id, i) for r in op2_decontamination(spark, sf_dir).collect() for i in r.item_ids}
    assert pairs and len(pairs & got) >= 0.9 * len(pairs)
