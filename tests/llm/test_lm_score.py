import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quernstone.llm.lm_score import Config, pair_places, score_documents
from quernstone.llm.queries import op8_lm_score
from quernstone.llm.tokens import word_blocks

SMALL = Config(words=1 << 12, pairs=1 << 14, block=1000)


def brute(texts, target, c):
    import pyarrow as pa

    docs = []
    for t in texts:
        ((_, w),) = word_blocks(pa.array([t], pa.string()), 1 << 30)
        words = (w.hashes % np.uint64(c.words)).astype(np.int64)
        context, pair = pair_places(words, np.array([0]), c)
        docs.append((words.tolist(), context.tolist(), pair.tolist()))
    out = []
    for d, (words, context, pair) in enumerate(docs):
        losses = []
        for m in (0, 1):
            rest = [x for e, x in enumerate(docs) if e != d and (m == 0 or target[e])]
            uni, big = Counter(w for x in rest for w in x[0]), Counter(p for x in rest for p in x[2])
            starts = sum(1 for x in rest if x[0])
            total, loss = sum(uni.values()), 0.0
            for w, v, p in zip(words, context, pair, strict=True):
                before = starts if v == c.words else uni[v]
                weight = c.weight if before else 0
                share = min(big[p] / before, 1) if before else 0
                loss -= math.log(weight * share + (1 - weight) * (uni[w] + c.alpha) / (total + c.alpha * c.words))
            losses.append(loss / len(words) if words else None)
        out.append((len(words), losses[1], losses[0], losses[1] - losses[0] if words else 0.0))
    return out


def test_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, "", " . "]
    quality = [i % 3 == 0 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(texts)], "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([(i, int(q)) for i, q in enumerate(quality)] + [(None, 1), (1, None)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in score_documents(docs, labels, SMALL).collect()}
    for i, want in enumerate(brute(texts, quality, SMALL)):
        assert tuple(rows[i])[1:] == pytest.approx(want)
    assert score_documents(docs.limit(0), labels, SMALL).count() == 0
    assert score_documents(docs, labels.limit(0), SMALL).count() == len(texts)


def test_target_scores_lower(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("abcde" if i % 2 else "defgh") for _ in range(80))) for i in range(200)]
    labels = [(i, i % 2) for i in range(100)]
    rows = score_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), SMALL).collect()
    unseen = {r.doc_id: r.score for r in rows if r.doc_id >= 100}
    assert max(s for i, s in unseen.items() if i % 2) < min(s for i, s in unseen.items() if not i % 2)


def test_query(spark, sf_dir):
    rows = op8_lm_score(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(np.isfinite(r.score) for r in rows)


def test_query_against_plain_counts(spark, sf_dir):
    """Every document of the table, from counts of its words and pairs as bytes; the document's own are taken out."""
    docs = {r.doc_id: re.findall(rb"[0-9a-z\x80-\xff]+", (r.text or "").encode().lower()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.quality == 1}
    c, models = Config(), []
    size = len({w for x in docs.values() for w in x})
    for m in (0, 1):
        own = [x for d, x in docs.items() if m == 0 or d in good]
        uni, big = Counter(w for x in own for w in x), Counter(p for x in own for p in zip([None, *x], x, strict=False))
        uni[None] = sum(1 for x in own if x)
        models.append((uni, big, sum(map(len, own))))
    for r in op8_lm_score(spark, sf_dir).collect():
        words, losses = docs[r.doc_id], []
        for m, (uni, big, total) in enumerate(models):
            own, pairs = (Counter(words), Counter(zip([None, *words], words, strict=False))) if m == 0 or r.doc_id in good else (Counter(), Counter())
            n, loss = sum(own.values()), 0.0
            own[None] = int(bool(own))
            for v, w in zip([None, *words], words, strict=False):
                before = uni[v] - own[v]
                weight = c.weight if before else 0
                loss -= math.log(weight * (big[v, w] - pairs[v, w]) / max(before, 1) + (1 - weight) * (uni[w] - own[w] + c.alpha) / (total - n + c.alpha * size))
            losses.append(loss / len(words) if words else None)
        assert (r.n_tokens, r.background_loss, r.target_loss) == pytest.approx((len(words), *losses))


def exact(texts, target, c):
    """Scores from counts of the words and word pairs themselves, nothing hashed."""
    docs = [t.split() for t in texts]
    size, out = len({w for x in docs for w in x}), []
    for d, words in enumerate(docs):
        losses = []
        for m in (0, 1):
            rest = [x for e, x in enumerate(docs) if e != d and (m == 0 or target[e])]
            uni, big = Counter(w for x in rest for w in x), Counter(p for x in rest for p in zip([None, *x], x, strict=False))
            uni[None], total, loss = len(rest), sum(map(len, rest)), 0.0
            for v, w in zip([None, *words], words, strict=False):
                weight = c.weight if uni[v] else 0
                loss -= math.log(weight * big[v, w] / max(uni[v], 1) + (1 - weight) * (uni[w] + c.alpha) / (total + c.alpha * size))
            losses.append(loss / len(words))
        out.append((len(words), losses[1], losses[0], losses[1] - losses[0]))
    return out


def test_every_word_has_its_own_count(spark):
    """Words that share a place of a table of 1 << 17 are counted apart, over several blocks and buckets."""
    import pyarrow as pa

    ((_, w),) = word_blocks(pa.array([" ".join(f"w{i}" for i in range(3000))]))
    place, twins = {}, []
    for i, h in enumerate((w.hashes % np.uint64(1 << 17)).tolist()):
        twins += [f"w{place[h]}", f"w{i}"] if h in place else []
        place[h] = i
    assert len(twins) >= 10
    rng = random.Random(10)
    texts = [" ".join(rng.choice(twins) for _ in range(rng.randint(1, 60))) for _ in range(50)]
    target = [i % 3 == 0 for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(q)) for i, q in enumerate(target)], "doc_id long, quality int")
    for config in (Config(), Config(block=100, bucket=64, least_bits=2)):
        rows = {r.doc_id: r for r in score_documents(docs, labels, config).collect()}
        for i, want in enumerate(exact(texts, target, Config())):
            assert tuple(rows[i])[1:] == pytest.approx(want)
