import math
import random
import zlib

import pytest

from quernstone.llm import tokens
from quernstone.llm.queries import op9_toxicity
from quernstone.llm.toxicity import Config, classify_documents, fit, labelled_sample, score_documents

SMALL = Config(buckets=1 << 12, sample=1200, epochs=6)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1500):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(1, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randint(0, len(words)), rng.choice(["vile", "scum", f"grub{rng.randint(0, 99)}"]))
        rows.append((i, " ".join(words), "en" if i % 2 else "de", 1.0))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(planted):
    rows = classify_documents(*planted, SMALL).collect()
    assert len(rows) == 1500
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum((r.doc_id % 5 == 0) == r.predicted for r in held) > 0.97 * len(held)
    assert sum((r.doc_id % 5 == 0) == r.flagged for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_same_twice_and_labels_of_the_fold_unused(planted):
    docs, labels = planted
    first = {r.doc_id: r.score for r in classify_documents(docs, labels, SMALL).collect()}
    spoiled = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic")
    again = {r.doc_id: r.score for r in classify_documents(docs.repartition(5), spoiled, SMALL).collect()}
    assert again == pytest.approx(first, abs=1e-5)


def test_nulls_empty_and_clashing(spark, planted):
    odd = spark.createDataFrame([(None, None, None, 5.0), (1, "", "xx", 5.0), (1, "", "xx", 5.0), (2, "vile " * 50_000, "en", 5.0)], planted[0].schema)
    rows = classify_documents(odd, planted[1].limit(0), SMALL).collect()
    assert len(rows) == 4 and len({r.score for r in rows}) == 1 and rows[0].held_out is False
    model = fit(["vile"] * 30 + ["fine"] * 60, [1] * 30 + [0] * 60, ["en"] * 90, SMALL)
    scored = score_documents(odd.selectExpr("*", "1 as SCORE2"), model).collect()
    assert scored[3].score > 0.3 and scored[0].score == scored[1].score and scored[0].SCORE2 == 1
    assert classify_documents(odd.limit(0), planted[1], SMALL).count() == 0


def test_query_covers_all(spark, sf_dir):
    assert op9_toxicity(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_scores_against_a_plain_forward_pass(spark):
    """Every word's vector, every filter at every place and the largest values, in loops over Python numbers."""
    texts = ["vile scum went home", "a fine day", "", "one", "Vile? vile! grub7 and grub9 in the long, long evening"]
    model = fit([f"vile w{i} w{i + 1}" for i in range(40)] + [f"w{i} w{i + 2} fine" for i in range(80)], [1] * 40 + [0] * 80, ["en"] * 120, SMALL)
    c = model.config
    base, inverse, mask = tokens._BASE, tokens._UNBASE, (1 << 64) - 1

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    def hashed(word):
        return mixed(sum(b * pow(int(base), k, 1 << 64) for k, b in enumerate(word)) & mask)

    def score(text):
        words = ["".join(ch for ch in w) for w in "".join(ch.lower() if ch.isalnum() else " " for ch in text).split()]
        vectors = []
        for w in words:
            data = w.encode()
            places = [hashed(data)] + [(hashed(data[:p]) + p) & mask for p in c.prefixes]
            vectors.append([sum(float(model.embed[h % c.buckets][d]) for h in places) for d in range(c.dim)])
        top = []
        for k, width in enumerate(c.widths):
            for f in range(c.filters):
                values = [sum(vectors[a + i][d] * float(model.filters[k][i * c.dim + d][f]) for i in range(width) for d in range(c.dim)) for a in range(len(vectors) - width + 1)]
                top.append(max(0.0, max(values) + float(model.bias[k * c.filters + f])) if values else 0.0)
        z = model.scale[0] * (sum(t * float(o) for t, o in zip(top, model.out[:-1], strict=True)) + float(model.out[-1])) + model.scale[1]
        return 1 / (1 + math.exp(-z))

    assert pow(int(base), -1, 1 << 64) == int(inverse)
    rows = score_documents(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.score for r in rows] == pytest.approx([score(t) for t in texts], abs=1e-4)


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * 100 if i else "y" * 5000, "en") for i in range(50)] + [(3, "z" * 40, "de")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, Config(sample=20, sample_bytes=1000)).collect()
    assert 0 < len(rows) <= 10 and sum(len(r.text) for r in rows) <= 1000 and len({r.doc_id for r in rows}) == len(rows)
