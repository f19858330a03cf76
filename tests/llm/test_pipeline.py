import pytest

import corpus_pipeline
from quernstone.llm.bpe import codec
from quernstone.llm.decontaminate import common_subsequence
from quernstone.llm.queries import vocabulary_file
from quernstone.llm.secrets import scan_documents
from quernstone.session import shared_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _id int, _hash int, _cut string, _key int, root long, `Share` double"


def odd_rows(spark):
    """Nulls in every column, empty and long texts, ties, repeats, names that stages might use."""
    rows = [
        (None, None, None, None, None), (None, "a text without an id here", None, None, 25), (1, "", "en", "s", 0), (2, None, "en", "s", None), (3, " \t\n", "xx", None, 3), (4, "one two three four five six", "en", "s", 27), (4, "one two three four five six", "en", "s", 27),
        (5, "One  two three four five SIX", "en", "s", 28), (4, "another text under the same id", "de", "s", 30), (6, "lorem ipsum " * 60_000, "es", "s", 720_000), (7, "password: hunter22 and more", "en", "s", 27), (7, "password: hunter22 and more", "en", "s", 27),
    ]
    return spark.createDataFrame([(*r, 0.5, 1, 2, "c", 3, 4, 0.25) for r in rows], SCHEMA)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_tables(spark, sf_dir, k):
    docs = odd_rows(spark)
    name, stage = corpus_pipeline.STAGES[k]
    got = stage(spark, docs, sf_dir)
    rows = got.collect()
    ids = sorted(r.doc_id or -1 for r in rows)
    if k == 4:
        assert len(rows) == 12 and sorted(r.n_tokens for r in rows)[:2] == [0, 0]
    else:
        assert got.columns == docs.columns
        assert all((r.score, r._id, r._hash, r._cut, r._key, r.root, r.Share) == (0.5, 1, 2, "c", 3, 4, 0.25) for r in rows)
    if k in (0, 2, 3):
        assert ids == [-1, -1, 1, 2, 3, 4, 4, 4, 5, 6, 7, 7], name  # clean documents stay, repeats too
    if k == 1:
        assert ids == [-1, 1, 4, 4, 6, 7]
    if k == 3:
        texts = {r.text for r in rows if r.doc_id == 7}
        assert len(texts) == 1 and "hunter22" not in texts.pop() and {r.n_chars for r in rows if r.doc_id == 6} == {720_000}
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        old = {r.doc_id: r for r in before.collect()}
        new = {r.doc_id: r for r in docs.collect()}
        assert set(new) <= ids and docs.count() == len(new)
        ids = set(new)
        if k < 4:
            assert docs.columns == before.columns
        if k in (0, 1, 2):
            assert all(new[d] == old[d] for d in new)
        if k == 0:
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            clean = [d for d in old if labels.get(d) == 0]
            assert sum(d in new for d in clean) >= 0.95 * len(clean)
        if k == 1:  # no two that stay are alike; each that went is like one of a smaller id
            sets = {d: shingles(r.text) for d, r in old.items()}
            alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
            assert not [(a, b) for a in new for b in new if a < b and alike(a, b)]
            assert all(any(alike(a, b) for a in old if a < b) for b in set(old) - set(new))
        if k == 2:  # a document that went holds most of an item in order, one that stayed none verbatim
            items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert all(any(common_subsequence(i, words(old[d].text)) >= 0.6 * len(i) for i in items) for d in set(old) - set(new))
            assert not [d for d, r in new.items() if any(f" {' '.join(i)} " in f" {' '.join(words(r.text))} " for i in items)]
        if k == 3:
            assert set(old) == set(new)
            assert scan_documents(docs).where("n_assign + n_access + n_hex > 0").count() == 0
        if k == 4:
            own = codec(vocabulary_file())
            assert {d: r.n_tokens for d, r in new.items()} == {d: len(own.encode(r.text or "")) for d, r in old.items()}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/quernstone")
    listed = lambda: {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}
    held = listed()
    assert corpus_pipeline.run(spark, sf_dir).count() == len(ids)
    left = listed() - held
    assert len(left) == 1 and left.pop().startswith("stage-secret_scans")
