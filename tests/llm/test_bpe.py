import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quernstone.llm.bpe import Codec, encode_documents
from quernstone.llm.queries import op4_bpe, vocabulary_file

PATH = vocabulary_file()
OWN, THEIRS = Codec.from_file(PATH), Tokenizer.from_file(PATH)


def same(text):
    theirs = THEIRS.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == theirs
    assert OWN.decode(theirs) == THEIRS.decode(theirs, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    same(text)


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "\n\n  \t a", "it's We'LL 've", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>c", "<|endoftext",
        "é ñ ß 中文字 🙂🙂 á", "\x00\x1c\x1d\x85 \xa0x", "aaaa" * 3000, "1234567890" * 500, "=" * 5000, "​﻿", "٣٤٥ ⅷ ²",
    ],
)
def test_edge_texts(text):
    same(text)


def test_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(1, "Hello  world", 9, "x"), (1, None, 8, "x"), (None, "", 7, None)], "doc_id long, text string, n_tokens int, decoded string"
    )
    rows = encode_documents(df, PATH).collect()
    assert [r.n_tokens for r in rows] == [len(THEIRS.encode("Hello  world").ids), 0, 0]
    assert [r.decoded for r in rows] == ["Hello  world", "", ""]
    assert rows[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert encode_documents(df.limit(0), PATH).count() == 0


def test_query(spark, sf_dir):
    rows = op4_bpe(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = THEIRS.encode(texts[r.doc_id], add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
