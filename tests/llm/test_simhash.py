import random

import pytest
import xxhash
from pyspark.sql import functions as F

from quernstone.llm.components import connected_components
from quernstone.llm.queries import op6_simhash
from quernstone.llm.simhash import fingerprint, groups_for, keep_one, linked_fingerprints, near_duplicates, refinements


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids_fps):
    ids_fps = list(ids_fps)
    name = {i: i for i, _ in ids_fps}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for a, (i, f) in enumerate(ids_fps):
        for j, g in ids_fps[:a]:
            if (f ^ g).bit_count() <= 3:
                x, y = sorted((root(i), root(j)))
                name[y] = x
    return {i: root(i) for i, _ in ids_fps}


@pytest.mark.parametrize("text", ["", " \t ", "one", "one two", "A b C", "a b c d a b c d", "É É x y z", "x\x1cy z w v\x0bu"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_all_links_found(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(12):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, 1, 3, 7, 15, 2**64 - 1, 2**63, 2**63 + 1}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    links = {frozenset((a, b)) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3}
    for groups in (3, 4, 5, 7):
        got = {frozenset(x % 2**64 for x in r) for r in linked_fingerprints(spark.createDataFrame(signed, "fp long"), groups).collect()}
        assert got == links, groups


def test_cells_refine_as_the_corpus_grows():
    """Strangers in a cell of even fingerprints do not grow with them: two counts agree with a chance of 0.375."""
    for n in (10**5, 10**7, 10**8, 10**9, 10**10, 10**11):
        kept = min(m.bit_count() // 2 for m in refinements(groups_for(n)))
        assert n * 0.375 ** (16 + kept) <= 8, n
    assert [len(refinements(g)) for g in (3, 4, 5, 8)] == [1, 4, 10, 56]


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 7), (200, 201), (201, 200), (300, 300)] + [(500, k) for k in range(501, 560)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(51)} | {100: 0, 200: 200, 201: 200} | {k: 500 for k in range(500, 560)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs}
    comps = brute_components(fps.items())
    rows = op6_simhash(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{fps[i]:016x}", comps[i]) for i in fps}


def test_nulls_ties_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(3, None, 1), (2, "", 1), (2, "", 1), (None, " ", 1), (None, "some other words here", 1), (9, "quite a different text", 1)],
        "doc_id long, text string, fp int",
    )
    rows = near_duplicates(df).collect()
    assert len(rows) == 6
    assert [r.component_id for r in rows if r.fingerprint == '0' * 16] == [2] * 4
    assert [r.component_id for r in rows if r.doc_id is None and r.fingerprint != '0' * 16] == [None]
    assert near_duplicates(df.limit(0)).count() == 0
    assert near_duplicates(df.withColumn("component_id", F.lit(1))).count() == 6
    kept = keep_one(df.withColumn("root", F.lit("x"))).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [("2", ""), ("9", "quite a different text"), ("None", "some other words here")]
    assert kept[0].root == "x"


def test_no_table_of_fingerprints_passes_through_the_driver(spark):
    few = spark.createDataFrame([(0,), (1,), (1 << 40,)], "fp long")
    plan = linked_fingerprints(few)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
