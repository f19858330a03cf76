from quernstone.operators import assembly as S
from quernstone.operators import graph as G

DICTIONARY = G.Dictionary(sensitive={"NASA": ("NASA", "ORG"), "ESA": ("ESA", "ORG"), "Agencia Espacial Europea": ("ESA", "ORG")}, stopwords=frozenset("el la".split()))
TEXTS = [
    ("d1", 1, "NASA firma con ESA."),
    ("d1", 1, "La NASA financia a Orbital Dynamics en la misión."),
    ("d2", 2, "ESA colabora con NASA. nada más"),
    ("d3", 0, "sin entidades aquí"),
    ("d3", 2, "NASA firma con ESA. Luego NASA firma con ESA."),
]


def frame(spark, rows=None):
    return spark.createDataFrame([(k, d, f"{d}-c{k:04d}", p, t) for k, (d, p, t) in enumerate(TEXTS) if rows is None or k in rows], "line long, doc_id string, chunk_id string, phenomenon int, text string")


def test_graph_of_fragments(spark):
    nodes, edges, stats = S.assemble(*S.accumulate(frame(spark), DICTIONARY))
    by = {r.node: r for r in nodes.collect()}
    assert set(by) == {"nasa", "esa"}  # the name met once is pruned
    assert (by["nasa"].name, by["nasa"].kind, by["nasa"].mentions, by["nasa"].n_chunks, by["nasa"].n_docs) == ("NASA", "ORG", 5, 4, 3)
    assert by["nasa"].phenomena == [2, 1] and by["nasa"].chunk_ids == ["d1-c0000", "d1-c0001", "d2-c0002", "d3-c0004"]
    lines = {(r.a, r.relation, r.b): r for r in edges.collect()}
    assert lines["nasa", "firma", "esa"].weight == 2 and lines["nasa", "firma", "esa"].chunk_ids == ["d1-c0000", "d3-c0004"]
    assert lines["esa", "colabora_con", "nasa"].phenomena == [2]
    said = {(r.what, r.kind): r.n for r in stats.collect()}
    assert said["fragments", ""] == 5 and said["without entities", ""] == 1 and said["nodes", ""] == 2 and said["nodes by kind", "ORG"] == 2
    assert said["edges", ""] == len(lines) and said["edges pruned", ""] == 1 and said["isolated nodes", ""] == 0
    assert said["mentions by origin", "dictionary"] == 7 and said["mentions by origin", "name"] == 1


def test_batches_merge_to_the_same(spark):
    whole = S.accumulate(frame(spark), DICTIONARY)
    parts = S.merge(*(S.accumulate(frame(spark, rows), DICTIONARY) for rows in ({0, 4}, {1, 2}, {3})))
    for a, b in zip(S.assemble(*whole, least_mentions=1), S.assemble(*parts, least_mentions=1), strict=True):
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect()))
    assert "orbital dynamics" in {r.node for r in S.assemble(*whole, least_mentions=1)[0].collect()}
    lonely = S.assemble(*whole, least_weight=3, isolated=False)
    assert lonely[0].count() == 0 and lonely[1].count() == 0


def test_no_fragments(spark):
    nodes, edges, stats = S.assemble(*S.accumulate(frame(spark, set()), DICTIONARY))
    assert nodes.count() == 0 and edges.count() == 0
    assert {r.what: r.n for r in stats.collect()}["fragments"] == 0


def test_dictionary_summary(spark):
    assert S.dictionary_summary(S.dictionary_forms(spark, DICTIONARY)) == {"ORG": 2, "_total_entidades": 2, "_total_variantes": 3}
