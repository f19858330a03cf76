import random

import corpus_pipeline


def similarity(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_near_copies_go(spark):
    """Copies with replaced words: those of similarity 0.8 or more go, others stay."""
    rng = random.Random(5)
    docs, copies = [], {}
    for d in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(100, 400))]
        docs.append((d, " ".join(words)))
        for k in range(3):
            new = list(words)
            for at in rng.sample(range(len(new)), rng.randint(1, max(1, len(new) // 25))):
                new[at] = "x"
            docs.append((1000 + 10 * d + k, " ".join(new)))
            copies[docs[-1][0]] = similarity(" ".join(words), " ".join(new))
    docs += [(5000, None), (5001, " "), (5002, "a b"), (5003, "A  b"), (None, "a b"), (None, "c d e f g h")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, root int")
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    rows = {(r.doc_id, r.text) for r in kept.collect()}
    ids = {i for i, _ in rows}
    assert set(range(60)) | {5000, 5002, None} <= ids and not {5001, 5003} & ids and (None, "a b") not in rows
    high = [i for i, s in copies.items() if s >= 0.8]
    assert len(high) > 60 and not ids & set(high)
    texts = [(i, t) for i, t in rows if i is not None and i < 5000]
    assert all(similarity(s, t) < 0.8 for i, s in texts for j, t in texts if i < j and (i - 1000) // 10 == (j - 1000) // 10)
    # A copy below the limit goes only if it resembles another copy of its document.
    by_id = dict(docs)
    for i, s in copies.items():
        if s < 0.8 and i not in ids:
            assert any(similarity(by_id[i], by_id[j]) >= 0.8 for j in copies if j < i and j // 10 == i // 10)
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), "").count() == 0
