import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm import repeats
from quernstone.llm.queries import op7_repeats
from quernstone.llm.repeats import anchors, deduplicate, maximal_repeats, repeat_groups, suffix_array


def brute(rows, length=50):
    """{(id, text): (n_bytes, n_removed, n_spans, digest)}; None sorts last."""
    least = {}
    order = lambda i: (i is None, i or 0)
    for i, t in rows:
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            least[w] = min(least.get(w, order(i)), order(i))
    out = {}
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            if least[data[p : p + length]] < order(i):
                gone[p : p + length] = True
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out[i, t] = (len(data), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(data) else 0, hashlib.sha256(kept).hexdigest())
    return out


def test_equal_windows_pick_equal_anchors():
    rng = np.random.default_rng(0)
    for size in (1, 2, 26, 256):
        data = rng.integers(0, size, 3000).astype(np.uint8)
        offsets = np.array([0, 10, 900, 900, 2000, 3000])
        h, text, a, z = anchors(data, offsets)
        seen = {}
        windows = 0
        for hash_, t, s, e in zip(h.tolist(), text.tolist(), a.tolist(), z.tolist(), strict=True):
            assert offsets[t] <= s and e <= offsets[t + 1]
            for p in range(s, e - 49):
                windows += 1
                assert seen.setdefault(data[p : p + 50].tobytes(), hash_) == hash_
        assert windows == sum(max(0, n - 49) for n in np.diff(offsets))


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh", "\x00a"])
def test_maximal_repeats(letters):
    rng = random.Random(letters)
    contexts = list({"".join(rng.choice(letters) for _ in range(rng.randint(6, 14))).encode() for _ in range(25)})
    owner, place, left, lcp = suffix_array(contexts, 6)
    suffix = [contexts[o][p:] for o, p in zip(owner, place, strict=True)]
    assert suffix == sorted(suffix)
    before = np.where(place > 0, [contexts[o][p - 1] for o, p in zip(owner, place, strict=True)], -1 - np.arange(len(place)))
    got = {(suffix[a][:n], z - a) for n, a, z in maximal_repeats(lcp, before, 6)}
    want = set()
    for s in {x[:n] for x in suffix for n in range(6, len(x) + 1)}:
        at = [k for k, x in enumerate(suffix) if x.startswith(s)]
        after = {suffix[k][len(s) : len(s) + 1] or k for k in at}
        if len(at) > 1 and len({before[k] for k in at}) > 1 and len(after) > 1:
            want.add((s, len(at)))
    assert got == want


def test_against_brute_force(spark):
    rng = random.Random(7)
    words = [f"{chr(97 + i % 26)}{i}é" for i in range(200)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 40))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))))
        text = " ".join(parts)
        rows.append((i, text[rng.randint(0, 5) :] if rng.random() < 0.5 else text))
    rows += [(200, "a" * 400), (201, "a" * 70), (202, "b" + "a" * 49), (203, "ab" * 100), (204, "\x00" * 60 + "x"), (205, "\x00" * 55)]
    rows += [(300, None), (301, ""), (302, rows[0][1]), (None, rows[1][1]), (None, passages[0]), (40, passages[1] + "!"), (40, passages[1] + "?"), (302, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int").repartition(4)
    want = brute(rows)
    got = deduplicate(df).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, str(r.doc_id)) for r in got) == sorted((*want[r], str(r[0])) for r in rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert deduplicate(df.limit(0)).count() == 0
    # The same where every anchor with several contexts is too wide for one task, and where common ones are spread.
    for every in (1 << 20, 1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(repeats, "SAMPLE_EVERY", every)
            patch.setattr(repeats, "REPEATED_IDS", every - 1)  # the second time all rows carry a hash
            again = deduplicate(df.union(df.where("doc_id < 0")), wide=1).collect()
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, str(r.doc_id)) for r in again) == sorted((*want[r], str(r[0])) for r in rows)


def test_common_anchors_are_spread(spark):
    """A stretch with other words around it in each document is common in the sample."""
    rng = random.Random(3)
    stretch = "".join(rng.choice("abcdefgh ") for _ in range(30))
    rows = [(i, "".join(rng.choice("mnopqrst ") for _ in range(40)) + stretch + "".join(rng.choice("uvwxyz ") for _ in range(rng.choice((40, 2))))) for i in range(300)]
    rows += [(1000 + i, rows[i][1][rng.randint(0, 30) :]) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(repeats.common_anchors(repeats._known(df), 1, wide=2)) > 0
    want = brute(rows)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(repeats, "SAMPLE_EVERY", 1)
        got = deduplicate(df, wide=2).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want[r] for r in rows)


def test_stretches_lie_in_every_string():
    for length in (16, 17, 20, 31, 50, 51):
        rest = length - repeats.KMER
        for before in range(rest + 1):
            assert any(a <= before and b <= rest - before for a, b in repeats.stretches(length))
    assert all(a + b >= 22 for a, b in repeats.stretches(50))


def test_only_contexts_that_may_share_are_asked(spark):
    """Phrases that recur in other company give common anchors, but no bytes are cut for them."""
    rng = random.Random(5)
    phrase = "".join(rng.choice("abcdefgh ") for _ in range(24))
    other = lambda n: "".join(rng.choice("ijklmnopqrstuvwxyz") for _ in range(n))
    rows = [(i, other(40) + phrase + other(40)) for i in range(200)]
    rows += [(200 + i, "<" + rows[i][1][10 + i : 60 + i] + ">") for i in range(30)]  # exactly one string of 50 bytes each
    known = repeats._known(spark.createDataFrame(rows, "doc_id long, text string"))
    found = repeats.met_contexts(repeats.context_rows(known, 4, np.zeros(0, np.uint64))).where("kind <> 0").select("doc").distinct()
    assert {r.doc for r in found.collect()} == {*range(30), *range(200, 230)}
    want = brute(rows)
    for wide in (repeats.WIDE, 1):
        got = deduplicate(known.selectExpr("doc as doc_id", "cast(data as string) as text"), wide=wide).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {k[0]: v for k, v in want.items()}


def test_tasks_grow_with_the_corpus(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(60)]
    rows += [(100 + i, rows[i][1][20:200] + "!") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = repeats._known(df)
    dealt = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(repeats, "BUCKET", 20)
        inner = repeats.met_contexts
        patch.setattr(repeats, "met_contexts", lambda *a: dealt.append(inner(*a)) or dealt[-1])
        got = deduplicate(df).collect()
    assert dealt[0].rdd.getNumPartitions() > 2 * repeats._partitions(known)
    want = brute(rows)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted((k[0], *v) for k, v in want.items())


def test_long_text(spark):
    """A text of several pieces, whole in another document; periods inside."""
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 9_000_000).astype(np.uint8).tobytes().decode() + "=" * 200_000
    rows = {r.doc_id: r for r in deduplicate(spark.createDataFrame([(1, "head " + text), (2, "tail" + text), (3, "=" * 70)], "doc_id long, text string"), keep_text=False).collect()}
    assert (rows[1].n_removed, rows[1].n_spans) == (0, 0)
    assert (rows[2].n_removed, rows[2].n_spans) == (len(text), 1)
    assert (rows[3].n_removed, rows[3].n_spans) == (70, 1)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {k[0]: v for k, v in brute(rows).items()}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op7_repeats(spark, sf_dir).collect()} == want


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_texts_of_one_id_whose_hashes_are_equal(spark, monkeypatch, most):
    passage = "".join(chr(97 + (k * k) % 23) for k in range(73))
    rows = [(1, passage), (None, "q" * 12 + passage), (None, passage + "z" * 30), (None, None), (7, "other"), (7, "v" * 40)]
    plain = repeats._tie
    monkeypatch.setattr(repeats, "REPEATED_IDS", most)
    # The first two hashes are of no use, as if all texts collided.
    monkeypatch.setattr(repeats, "_tie", lambda seed: F.lit(5).cast("long") if seed < 2 else plain(seed))
    got = repeats.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = sorted((r.doc_id or 0, bytes(r.kept).decode(), r.n_removed) for r in got.collect())
    assert kept == sorted([(1, passage, 0), (0, "q" * 12, 73), (0, "z" * 30, 73), (0, "", 0), (7, "other", 0), (7, "v" * 40, 0)])
    monkeypatch.setattr(repeats, "_tie", lambda seed: F.lit(5).cast("long"))
    with pytest.raises(RuntimeError):
        repeats.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))


def brute_groups(rows, length=50):
    """[(string, {(id, place): times})] of the maximal repeats within contexts."""
    held = []
    for i, t in rows:
        data = np.frombuffer((t or "").encode(), np.uint8)
        _, _, a, z = anchors(data, np.array([0, len(data)]))
        held += [(i, s, data[s:e].tobytes()) for s, e in zip(a.tolist(), z.tolist(), strict=True)]
    met = {}
    for k, (i, s, c) in enumerate(held):
        for p in range(len(c) - length + 1):
            for q in range(p + length, len(c) + 1):
                met.setdefault(c[p:q], []).append((c[p - 1] if p else -1 - k, c[q] if q < len(c) else -1 - k, i, s + p))
    return {
        (w, tuple(sorted((str(i), at) for _, _, i, at in x)))
        for w, x in met.items()
        if len({b for b, _, _, _ in x}) > 1 and len({e for _, e, _, _ in x}) > 1
    }


@pytest.mark.parametrize("wide", [repeats.WIDE, 1])
def test_groups_with_all_occurrences(spark, wide):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = [word(n) for n in (49, 50, 51, 75, 130, 300)]
    rows = [(k, word(rng.randint(0, 60)) + rng.choice(shared) + word(9) + rng.choice(shared)[: rng.randint(45, 300)]) for k in range(25)]
    rows += [(30, None), (31, ""), (32, "x" * 260), (33, "ab" * 90), (None, rows[0][1]), (None, rows[1][1]), (2, rows[2][1]), (34, shared[4] + "é" * 40)]
    got = {}
    for r in repeat_groups(spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit(0)), wide=wide).collect():
        got.setdefault((r.repeat, r["size"]), []).append((str(r.doc_id), r.at))
    want = brute_groups(rows)
    assert len({k for k, _ in got}) == len(got) == len(want) > 50
    assert sorted((n, tuple(sorted(x))) for (_, n), x in got.items()) == sorted((len(w), x) for w, x in want)
    assert repeat_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
