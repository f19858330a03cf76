import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quernstone.llm.tokens import word_blocks


def words(text):
    return [w.lower() for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", text.encode())]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbZ9 é\n.🙂"), max_size=30)), max_size=12), st.integers(1, 60))
def test_same_words_same_hash(texts, limit):
    got, seen = [[] for _ in texts], {}
    for row, w in word_blocks(pa.array(texts, pa.string()), limit):
        for h, p, t in zip(w.hashes.tolist(), w.prefixes(2).tolist(), w.text.tolist(), strict=True):
            got[row + t].append((h, p))
    for text, pairs in zip(texts, got, strict=True):
        expected = words(text or "")
        assert len(pairs) == len(expected)
        for (h, p), w in zip(pairs, expected, strict=True):
            assert seen.setdefault(w, h) == h and seen.setdefault(w[:2], p) == p
    assert len(set(seen.values())) == len(seen)


def test_sliced_column():
    column = pa.array(["x", "one two", None, "two one"]).slice(1)
    ((row, w),) = word_blocks(column)
    assert row == 0 and w.text.tolist() == [0, 0, 2, 2]
    assert (w.hashes[:2] == w.hashes[:1:-1]).all() and np.unique(w.hashes).size == 2
