import json

import numpy as np
import pytest

from quernstone import cli
from quernstone.operators import encode as E
from quernstone.operators import graph as G
from quernstone.sources import artefacts as A


def stub(dimension=128):
    def encoder(texts):
        out = np.zeros((len(texts), dimension))
        for row, t in zip(out, texts, strict=True):
            for k in range(len(t) - 2):
                row[sum(map(ord, t[k : k + 3].lower())) % dimension] += 1
        return out

    return encoder


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    (root / "F1_a").mkdir()
    sentences = lambda word, n: " ".join(f"The {word} number {k} orbits far above the quiet observatory today." for k in range(n))
    (root / "F1_a/sat.md").write_text(f"# Satellites\n\n{sentences('satellite', 60)}\n\n## NASA\n\nNASA firma con ESA. {sentences('probe', 30)}", encoding="utf-8")
    (root / "F1_a/sea.txt").write_text(sentences("ocean", 50), encoding="utf-8")
    (root / "bad.json").write_text("{broken", encoding="utf-8")
    out = tmp_path_factory.mktemp("out")
    cli.main(["extract", "--input", str(root), "--output", f"{out}/docs"], spark)
    return root, out


def test_extract_and_retry(spark, corpus):
    root, out = corpus
    rows = {r.source: r for r in A.read_manifest(spark, f"{out}/docs/manifest").collect()}
    assert rows["bad.json"].n_errors == 1 and rows["sat.md"].phenomenon == 1 and rows["sat.md"].n_blocks == 4
    (root / "bad.json").write_text('{"title": "Mended now", "body_text": "It reads well."}', encoding="utf-8")
    cli.main(["extract", "--input", str(root), "--output", f"{out}/docs", "--retry"], spark)
    again = {r.source: r for r in A.read_manifest(spark, f"{out}/docs/manifest").collect()}
    assert again["bad.json"].n_errors == 0 and again["sat.md"] == rows["sat.md"] and len(again) == 3
    with pytest.raises(ValueError):
        cli.extract_corpus(spark, str(root), f"{out}/docs", retry=True, clean=True)
    with pytest.raises(ValueError):
        cli.extract_corpus(spark, str(root), f"{out}/none", retry=True)


def test_index_answer_evaluate(spark, corpus, tmp_path, monkeypatch):
    root, out = corpus
    report = cli.fragment(spark, f"{out}/docs", f"{out}/chunks", cli.chunk.ChunkConfig())
    assert report["n_documents"] == 3 and report["n_fragments"] > 5
    config, count = E.EncoderConfig(dimension=128), lambda t: len(t.split())
    made = cli.index(spark, f"{out}/chunks/{A.CHUNKS}", f"{out}/index", config, stub(), count)
    assert made["n_vectors"] == report["n_fragments"]
    (tmp_path / "q.txt").write_text("q001 ocean number orbits\nq002 satellite number orbits", encoding="utf-8")
    said = cli.answer(spark, f"{out}/index", f"{tmp_path}/q.txt", f"{tmp_path}/results", config, stub(), count, fragments=3)
    assert said["queries"] == 2
    answers = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/results").collect()]
    assert [a["query_id"] for a in answers] == ["q001", "q002"] and all(len(a["fragmentos"]) == 3 and a["documentos"][0]["puesto"] == 1 for a in answers)
    assert answers[0]["documentos"][0]["fuente"] == "sea.txt"
    truth = [{"question_id": a["query_id"], "relevant_chunks": [{"rank": 1, "chunk_id": a["fragmentos"][0]["chunk_id"]}]} for a in answers]
    (tmp_path / "truth.json").write_text(json.dumps(truth), encoding="utf-8")
    got = cli.evaluate(spark, f"{tmp_path}/results", f"{tmp_path}/truth.json", 1)
    assert got["queries"] == 2 and got["ndcg_binary"] == got["ndcg_graded"] == 1.0 and got["f1"] == 1.0 and got["ignored"] == 0
    (tmp_path / "more.json").write_text(json.dumps([{"question_id": "q9", "relevant_chunks": [{"rank": 1, "chunk_id": "a-c0000"}]}]), encoding="utf-8")
    with pytest.raises(ValueError, match="without an answer"):
        cli.evaluate(spark, f"{tmp_path}/results", f"{tmp_path}/more.json")


def test_graph_in_batches(spark, corpus, tmp_path):
    _, out = corpus
    if not A.exists(spark, f"{out}/index"):
        cli.fragment(spark, f"{out}/docs", f"{out}/chunks", cli.chunk.ChunkConfig())
        cli.index(spark, f"{out}/chunks/{A.CHUNKS}", f"{out}/index", E.EncoderConfig(dimension=128), stub(), lambda t: len(t.split()))
    dictionary = G.Dictionary(sensitive={"NASA": ("NASA", "ORG"), "ESA": ("ESA", "ORG")})
    lines = f"{out}/index/{A.METADATA}"
    whole = cli.build_graph(spark, lines, f"{tmp_path}/whole", dictionary)
    for name, first, end in (("a", 0, 2), ("b", 2, None)):
        cli.build_graph(spark, lines, f"{tmp_path}/{name}", dictionary, first, end, partial=True)
    assert cli.build_graph(spark, "", f"{tmp_path}/merged", dictionary, merge=[f"{tmp_path}/a", f"{tmp_path}/b"]) == whole
    assert whole["nodes by kind"]["ORG"] == 2 and whole["edges"] >= 1


def test_sweep_and_options(spark, corpus):
    _, out = corpus
    table = cli.sweep(spark, f"{out}/docs").splitlines()
    assert len(table) == 8 and table[0].startswith("| target | overlap |")
    args = cli.parser().parse_args(["fragment", "--input", "a", "--output", "b", "--target-words", "100", "--no-atomic"])
    assert args.target_words == 100 and args.no_atomic
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["index", "--input", "a"])
