import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.operators import blocks as B
from quernstone.operators import chunk as C
from quernstone.operators import graph as G
from quernstone.operators import relational as R
from quernstone.operators import retrieval as V


def test_heading_paths_equal_a_stack(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for d in range(20):
        stack = []
        for p in range(60):
            level = rng.choice([None, None, 1, 2, 3, 4, 6, 9])
            if level is not None:
                stack = [h for h in stack if h[0] < min(level, 6)]
            want[d, p] = [t for _, t in stack]
            if level is not None:
                stack.append((min(level, 6), f"t{p}"))
            rows.append((d, p, level, f"t{p}"))
    df = spark.createDataFrame(rows, "doc_id int, pos int, level int, text string")
    got = B.heading_paths(df)
    assert {(r.doc_id, r.pos): r.path for r in got.collect()} == want
    assert B.path_violations(got).count() == 0
    assert B.path_violations(got.withColumn("path", F.when(F.col("pos") == 3, F.array(F.lit("x"))).otherwise(F.col("path")))).count() == 20


def test_layout(spark):
    lines = spark.createDataFrame([(1, 0, 10.0, 10.0), (1, 1, 22.0, 10.0), (1, 2, 34.0, 10.0), (1, 3, 60.0, 10.0), (1, 4, 72.0, 14.0), (1, 5, 5.0, 14.0)], "page int, n int, top double, size double")
    got = B.paragraph_numbers(lines, "page", "top", "size", F.lit(12.0), ["n"]).orderBy("n").collect()
    assert [r.paragraph for r in got] == [0, 0, 0, 1, 2, 3]
    assert B.modal(spark.createDataFrame([(1, 12), (1, 12), (1, 9), (1, 9), (1, 3)], "g int, v int"), ["g"], "v", "m").collect()[0].m == 9
    sizes = spark.createDataFrame([(10.0,), (12.0,), (20.0,), (15.0,)], "size double")
    assert {r.size: r.level for r in B.title_levels(sizes, 10.0).collect()} == {20.0: 1, 15.0: 2, 12.0: 3}
    bands = spark.createDataFrame([(1, b) for b in (3, 4, 9, 10, 15)], "g int, b int")
    assert tuple(B.widest_gap(bands, ["g"], "b").collect()[0]) == (1, 5, 4)
    words = spark.createDataFrame([(1, 0, "hola", 90.0), (1, 1, "mundo", 50.0), (1, 2, "x", -1.0), (2, 0, "mal", 20.0)], "line int, pos int, text string, conf double")
    assert [(r.line, r.text) for r in B.recognised_lines(words, ["line"]).collect()] == [(1, "hola mundo")]


def prose(rng, n, size=12):
    return " ".join(f"{'Palabra' if not i else 'palabra'}{rng.randint(0, 99)}" for i in range(size)) and " ".join(" ".join([f"Frase{k}", *(f"palabra{rng.randint(0, 99)}" for _ in range(size - 2)), "fin."]) for k in range(n))


def chunked(spark, blocks, **config):
    row = [("D1", [(t, kind, level, path, page, atomic) for t, kind, level, path, page, atomic in blocks], "Obs", None)]
    df = spark.createDataFrame(row, "doc_id string, blocks array<struct<text:string,kind:string,level:int,path:array<string>,page:int,atomic:boolean>>, observatory string, title string")
    out = C.fragment_documents(df, C.ChunkConfig(**config))
    assert C.fragment_violations(out, C.ChunkConfig(**config)).count() == 0
    return sorted(out.collect(), key=lambda r: r.position)


def test_fragments_keep_sentences(spark):
    rng = random.Random(2)
    text = prose(rng, 60)
    got = chunked(spark, [("Inicio", "title", 1, [], 1, False), (text, "paragraph", None, ["Inicio"], 2, False)], overlap=0)
    assert " ".join(r.text for r in got) == "Inicio " + text
    assert [r.position for r in got] == list(range(len(got))) and len(got) > 2
    assert all(r.n_words <= 240 and r.text.endswith("fin.") and r.section == ["Inicio"] and r.page in (1, 2) for r in got)
    assert got[0].enriched == "Obs · Inicio\n" + got[0].text and got[0].chunk_id == "D1-c0000"
    lapped = chunked(spark, [(text, "paragraph", None, [], None, False)])
    assert [r.overlaps for r in lapped] == [False] + [True] * (len(lapped) - 1)


def test_sections_records_and_orphans(spark):
    rng = random.Random(3)
    body = prose(rng, 6)
    got = chunked(spark, [("A", "title", 1, [], None, False), ("B", "title", 2, ["A"], None, False), (body, "paragraph", None, ["A", "B"], None, False), ("C", "title", 1, [], None, False)])
    assert [(r.section, r.unit) for r in got] == [(["A", "B"], "prose"), (["C"], "orphan_title")]
    rows = [(f"col: {'x ' * n}fin", "row", None, [], None, True) for n in (10, 10, 60, 10, 100, 300)]
    units = chunked(spark, rows)
    assert {r.unit for r in units} == {"atomic"} and [r.n_words for r in units][:4] == [25, 62, 12, 102]


@pytest.mark.parametrize("seed", range(5))
def test_native_folds_equal_the_plain_ones(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.randint(0, 260) for _ in range(40)]
    df = spark.createDataFrame([(sizes,)], "s array<int>").select(C.pack_words(F.col("s")).alias("p"), C.accumulate_records(F.col("s")).alias("r")).first()
    chunker = C.Chunker(C.ChunkConfig(max_tokens=10**9))
    packed = chunker.pack([C._Sentence("w " * n, None, False) for n in sizes], 10**9)
    assert df.p == [k for k, g in enumerate(packed) for _ in g]
    records = chunker.records({"blocks": [{"text": "w " * n} for n in sizes]})
    # An empty record joins as its separator alone.
    assert len(df.r) == len(sizes) and (0 in sizes or df.r == [k for k, g in enumerate(records) for _ in g])


def test_relational(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    index = spark.createDataFrame([("b", 1), ("z", 2)], "k string, v int")
    assert [[r.k for r in x.collect()] for x in R.split_by_index(files, index, "k")] == [["b"], ["a", "c"], ["z"]]
    assert [x.count() for x in R.split_by_index(files, None, "k")] == [3, 0, 0]
    assert sorted(map(tuple, R.upsert(index, spark.createDataFrame([("z", 9), ("y", 8)], "k string, v int"), "k").collect())) == [("b", 1), ("y", 8), ("z", 9)]
    with pytest.raises(ValueError, match="not unique"):
        R.require_unique(files.union(files), "k")
    lines = spark.createDataFrame([("d", u, t) for u in range(4) for t in ("pie", "pie", f"l{u}")], "g string, u int, t string")
    assert [tuple(r) for r in R.repeated_lines(lines, "g", "u", "t").collect()] == [("d", "pie", 4)]
    assert R.repeated_lines(lines.where("u < 2"), "g", "u", "t").count() == 0
    n = spark.createDataFrame([(1, i) for i in range(1, 21)], "g int, v int")
    assert R.half_even_rank(n, ["g"], "v", 95, "p").first().p == 20 and n.agg(R.nearest_rank("v", 95)).first()[0] == 19
    assert n.where("v < 0").agg(R.nearest_rank("v", 95)).first()[0] == 0


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row_id long, vec array<double>").repartition(5)
    ask = spark.createDataFrame([(i, x[i].tolist()) for i in range(7)], "query_id long, qvec array<double>")
    want = {i: np.lexsort((np.arange(300), -(x[i] @ x.T)))[:4].tolist() for i in range(7)}
    for size, rows, block in ((V.QUERY_BYTES, V.ROW_BYTES, V.BLOCK), (3 * 64, 50 * 64, 7), (64, V.ROW_BYTES, 16)):
        for name, value in (("QUERY_BYTES", size), ("ROW_BYTES", rows), ("BLOCK", block), ("PAIRS", 5)):
            monkeypatch.setattr(V, name, value)
        got = V.top_k(df, ask, 4).orderBy("query_id", "rank").collect()
        assert {i: [r.row_id for r in got if r.query_id == i] for i in range(7)} == want
    assert V.top_k(df, ask.limit(0), 4).count() == 0
    with pytest.raises(Exception, match="length 0"):
        spark.createDataFrame([([0.0, 0.0],)], "v array<double>").select(V.unit(F.col("v"))).collect()


def test_top_k_of_few_rows_ties_and_odd_vectors(spark):
    rows = [(k, [1.0, 0.5, float(k % 2)]) for k in range(40)] + [(100, [9.0, 9.0, 9.0])]
    index = spark.createDataFrame(rows, "row_id long, vec array<float>").repartition(7)
    ask = spark.createDataFrame([("a", [1.0, 0.0, 0.0]), ("b", [0.0, 0.0, -1.0])], "query_id string, qvec array<double>")
    got = {q: [(r.row_id, r.score) for r in V.top_k(index, ask, 5).where(F.col("query_id") == q).orderBy("rank").collect()] for q in "ab"}
    assert got == {"a": [(100, 9.0), (0, 1.0), (1, 1.0), (2, 1.0), (3, 1.0)], "b": [(0, 0.0), (2, 0.0), (4, 0.0), (6, 0.0), (8, 0.0)]}
    assert V.top_k(index.where("row_id < 3"), ask, 5).count() == 6 and V.top_k(index.limit(0), ask, 5).count() == 0
    with pytest.raises(Exception, match="not of length"):
        V.top_k(index.withColumn("vec", F.array(F.lit(1.0))), ask, 5).collect()


def test_blocks_and_halves_that_cannot_reach_are_skipped():
    rng = np.random.default_rng(1)
    q = rng.normal(size=(6, 16))
    blocks = [rng.normal(size=(200, 16)) * scale for scale in (3.0, 1.0, 0.2, 0.1)]
    near = V.Nearest(q, 3)
    for b, x in enumerate(blocks):
        near.add(x, np.arange(200) + 200 * b, float(np.linalg.norm(x, axis=1).max()))
    every = np.concatenate(blocks)
    assert near.row.tolist() == [np.lexsort((np.arange(800), -(every @ v)))[:3].tolist() for v in q]
    assert near.skipped == 2 and near.halved > 50


def test_work_grows_with_the_grid_not_with_the_driver():
    mb = 1 << 20
    assert V.grid(1000, 10, 64, 8) == (1, 1)
    assert V.grid(10 * mb, 100, 128, 200) == (200, 1)
    rows, columns = V.grid(1000 * mb, 10 * mb, 128, 200)
    more_rows, more_columns = V.grid(100_000 * mb, 10 * mb, 128, 200)
    assert (rows, columns) == (8000, 320) and (more_rows, more_columns) == (100 * rows, columns)


def test_metrics_by_hand(spark):
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "x"), (1, 3, "b"), (2, 1, "q")], "query_id int, rank int, item string")
    rel = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (1, "c", 1.0), (2, "r", 1.0), (3, "s", 1.0)], "query_id int, item string, gain double")
    assert {r.query_id: r.f1 for r in V.f1_at_k(hits, rel, 3).collect()} == {1: pytest.approx(2 / 3), 2: 0.0, 3: 0.0}
    dcg, ideal = 1 + 1 / 2, 1 + 1 / np.log2(3) + 1 / 2
    assert {r.query_id: r.ndcg for r in V.ndcg_at_k(hits, rel, 10).collect()} == {1: pytest.approx(dcg / ideal), 2: 0.0, 3: 0.0}
    assert [r[0] for r in spark.range(6).orderBy("id").select(V.f1_ceiling(F.col("id"), 3)).collect()] == pytest.approx([0, 1, 1, 1, 6 / 7, 0.75])


def test_graph(spark):
    d = G.Dictionary(sensitive={"NASA": ("NASA", "AGENCIA")}, insensitive={"españa": ("España", "PAIS"), "corea del sur": ("Corea del Sur", "PAIS")}, noise_acronyms=frozenset({"PDF"}), stopwords=frozenset({"the"}))
    texts = ["Ayer la NASA firmó con ESPAÑA un pacto. Luego Corea del Sur financia el Centro Espacial Europeo.", "Nota: PDF ABC xx NASA: Nombre Propio.", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = G.recognise(df, d).orderBy("doc_id", "pos").collect()
    assert [(r.name, r.kind) for r in found if r.doc_id == 0] == [("NASA", "AGENCIA"), ("España", "PAIS"), ("Corea del Sur", "PAIS"), ("Centro Espacial Europeo", "NOMBRE")]
    assert [r.sentence for r in found if r.doc_id == 0] == [0, 0, 1, 1]
    assert [r.name for r in found if r.doc_id == 1] == ["ABC", "NASA", "Nombre Propio"]
    three = [tuple(r) for r in G.triples(G.recognise(df, d)).where("doc_id = 0").collect()]
    assert sorted(three) == [(0, "Corea del Sur", "financia", "Centro Espacial Europeo"), (0, "NASA", "firma", "España")]
    nodes = G.nodes(G.recognise(df, d))
    edges = G.edges(G.triples(G.recognise(df, d)))
    kept, lines = G.pruned(nodes, edges, least_mentions=2)
    assert {r.node for r in kept.collect()} == {"nasa", "espana", "corea del sur"} and lines.count() == 1
    assert {r.node for r in G.isolated(kept, lines).collect()} == {"corea del sur"}
    assert sorted(map(tuple, G.merged(edges, edges).collect())) == sorted((a, r, b, 2 * w) for a, r, b, w in map(tuple, edges.collect()))


def test_triples_are_all_of_a_text(spark):
    names = [f"Org{i:02}" for i in range(40)]
    d = G.Dictionary(sensitive={n: (n, "ORG") for n in names}, use_names=False)
    pairs = list(zip(names[::2], names[1::2], strict=True))
    by_sentence = " ".join(f"{a} financia {b}." for a, b in [*pairs, *pairs]) + " Org00 regula Org01. Org01 regula Org00."
    one_sentence = ", ".join(names)
    df = spark.createDataFrame(list(enumerate([by_sentence, one_sentence, "Org00 opera Org01."])), "doc_id int, text string")
    expected = [(0, a, "financia", b) for a, b in pairs] + [(0, "Org01", "regula", "Org00"), (2, "Org00", "opera", "Org01")]
    expected += [(1, a, G.NO_RELATION, b) for i, a in enumerate(names) for b in names[i + 1 : i + 4]]
    found = G.triples(G.recognise(df, d))
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert sorted(map(tuple, found.groupBy("doc_id").count().collect())) == [(0, 21), (1, 114), (2, 1)]


def test_sweep_fragments_every_document_anew(spark):
    import math

    rng = random.Random(4)
    block = lambda k, t: (t, "title" if k else "paragraph", k, [], None, False)
    rows = []
    for d in range(12):
        blocks = [block(None, prose(rng, rng.randint(5, 50), rng.randint(5, 20)))]
        for h in range(rng.randint(0, 3)):  # sections end inside a pack, the last fragments are orphans
            blocks += [block(1, f"Parte {h}"), block(None, prose(rng, rng.randint(1, 17)))]
        rows.append((f"D{d}", blocks, "Obs", None))
    schema = "doc_id string, blocks array<struct<text:string,kind:string,level:int,path:array<string>,page:int,atomic:boolean>>, observatory string, title string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = {(r.target, r.overlap): tuple(r)[2:] for r in C.sweep(df).collect()}
    assert set(got) == {(t, o) for t in (120, 190, 240) for o in (0, 1)}
    for (t, o), measured in got.items():
        out = C.fragment_documents(df, C.ChunkConfig(target_words=t, overlap=o)).collect()
        sizes, n = sorted(r.n_words for r in out), len(out)
        rank = lambda p: sizes[math.ceil(p / 100 * n) - 1]  # noqa: B023, E731
        assert measured[:4] == (n, rank(50), rank(95), round(100 * sum(r.n_sentences == 1 for r in out) / n, 1))
    assert got[120, 0] != got[240, 0] and got[190, 0] != got[190, 1]
    assert max(m[4] for m in got.values()) > 0
    # Ten sentences of 12 words and three more: the last 36 words join the 120 before them.
    one = spark.createDataFrame([("D", [block(None, prose(rng, 13))], None, None)], schema)
    assert {tuple(r)[2:] for r in C.sweep(one, (120,), (0,)).collect()} == {(1, 156, 156, 0.0, 100.0)}
    assert sorted(tuple(r) for r in C.sweep(df.limit(0), (120,), (0, 1)).collect()) == [(120, 0, 0, 0, 0, 0.0, 0.0), (120, 1, 0, 0, 0, 0.0, 0.0)]


def test_workers_send_fragments_and_entities_a_few_at_a_time(spark, monkeypatch):
    text = "Acme Corporation met Globex Union. " * 20
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    block = F.struct(F.col("text").alias("text"), F.lit("paragraph").alias("kind"), F.lit(None).cast("int").alias("level"), F.array().cast("array<string>").alias("path"), F.lit(None).cast("int").alias("page"), F.lit(False).alias("atomic"))
    nested = docs.select("doc_id", F.array(block).alias("blocks"), F.lit("o").alias("observatory"), F.lit(None).cast("string").alias("title"))
    rows = lambda: (sorted(map(str, C.fragment_documents(nested).collect())), sorted(map(str, G.recognise(docs, G.Dictionary()).collect())))
    whole = rows()
    for module, few in ((C, {"DOCUMENTS": 1, "SENT": 1}), (G, {"TEXTS": 2, "SENT": 3})):
        for name, n in few.items():
            monkeypatch.setattr(module, name, n)
    assert rows() == whole and all(whole)


def test_words_of_a_sentence_are_counted_once():
    class Text(str):
        counted = 0

        def split(self, *a):
            Text.counted += 1
            return super().split(*a)

    chunker = C.Chunker(C.ChunkConfig())
    groups = chunker.mend(chunker.pack(chunker.cut([Text("one two three.") for _ in range(500)], None, False), 450), 450)
    assert sum(map(len, groups)) == 500 and Text.counted == 500


def test_classes_give_the_metrics_of_their_pairs(spark):
    hits = spark.createDataFrame([(q, r, (q * r) % 12) for q in range(4) for r in range(1, 6)], "query_id long, rank int, item long").distinct()
    items = spark.createDataFrame([(i, i % 3 if i else None, float(i % 5)) for i in range(12)], "item long, class int, gain double")
    asked = spark.createDataFrame([(0, None), (1, 1), (2, 2), (3, 9)], "query_id long, class int")
    pairs = asked.join(items, "class").select("query_id", "item", "gain")
    assert sorted(V.f1_by_class(hits, asked, items.drop("gain"), 3).collect()) == sorted(V.f1_at_k(hits, pairs, 3).collect())
    assert sorted(V.ndcg_by_class(hits, asked, items, 4).collect()) == sorted(V.ndcg_at_k(hits, pairs, 4).collect())
