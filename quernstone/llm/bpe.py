"""Byte-level BPE: encoding by a heap of merge ranks, decoding by concatenation.

A pre-token starts as a doubly linked list of byte symbols. Every adjacent pair
that has a merge goes on a heap under (rank, place). The lowest entry is merged
unless it is stale, that is, unless the pair that stands at its place still
gives the same symbol; the merge links its neighbours to the new symbol and
pushes the two new pairs. Vocabulary files are a parameter and never copied.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: The byte-level pre-token pattern that the vocabulary files state.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Pre-tokens whose ids each of two generations remembers, and the longest (characters).
CACHE_WORDS, CACHE_LONGEST = 1 << 17, 64


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte: itself where printable, else from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    rest = (b for b in range(256) if b not in letters)
    return letters | {b: chr(256 + k) for k, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary."""

    def __init__(self, spec: dict):
        byte_of = {c: b for b, c in byte_letters().items()}
        vocab = spec["model"]["vocab"]
        to_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.vocabulary: dict[int, bytes] = {i: to_bytes(t) for t, i in vocab.items()}
        self.byte_ids = [vocab[c] for _, c in sorted(byte_letters().items())]
        self.merges = {
            (vocab[a], vocab[b]): (rank, vocab[a + b])
            for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        }
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.vocabulary |= {i: t.encode() for t, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.pre_tokens = regex.compile(PATTERN).findall
        self.cache: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    @classmethod
    def from_file(cls, path: str) -> Codec:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        merges = self.merges
        symbol = [self.byte_ids[b] for b in data]
        n = len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            if found := merges.get((symbol[i], symbol[i + 1])):
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, made = heapq.heappop(heap)
            if symbol[i] < 0 or (j := after[i]) < 0:
                continue
            found = merges.get((symbol[i], symbol[j]))
            if not found or found[1] != made:
                continue
            symbol[i], symbol[j] = made, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((made, symbol[k])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            if (h := before[i]) >= 0 and (found := merges.get((symbol[h], made))):
                heapq.heappush(heap, (found[0], h, found[1]))
        return [s for s in symbol if s >= 0]

    def _encode_plain(self, text: str, out: list[int]) -> None:
        cache = self.cache
        for word in self.pre_tokens(text):
            ids = cache.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    ids = self.merge(word.encode("utf-8", "surrogatepass"))
                if len(word) <= CACHE_LONGEST:
                    if len(cache) >= CACHE_WORDS:  # words met since then are kept, others forgotten
                        self.older, self.cache = cache, {}
                        cache = self.cache
                    cache[word] = ids
            out += ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the strings of added tokens stand for themselves."""
        out: list[int] = []
        for k, part in enumerate(self.added_cut.split(text) if self.added_cut else [text]):
            if k % 2:
                out.append(self.added[part])
            else:
                self._encode_plain(part, out)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.vocabulary.__getitem__, ids)).decode("utf-8", "replace")


def little_endian(ids: list[int]) -> bytes:
    """The ids as unsigned 32-bit words."""
    words = array("I", ids)
    if sys.byteorder != "little":
        words.byteswap()
    return words.tobytes()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, loaded once in each Python process."""
    if path not in _codecs:
        _codecs[path] = Codec.from_file(path)
    return _codecs[path]


def encode_documents(docs: DataFrame, vocabulary: str, digests_only: bool = False) -> DataFrame:
    """Every row of ``docs`` with its whole text encoded and decoded again.

    Adds token_ids (array<int>), n_tokens, ids_sha256 (ids as little-endian
    32-bit words), decoded (string) and decoded_sha256; with ``digests_only``
    the two large columns are left out and only doc_id is kept of the input.
    A null text counts as empty: no tokens, digests of no bytes. Columns of the
    input that have the names of added ones are replaced. No shuffle; rows keep
    their order. Texts of any length are encoded whole; an empty table gives no
    rows. ``vocabulary`` names a file that every executor has.
    """
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if not digests_only:
        added = "token_ids array<int>, decoded string, " + added
    new = StructType.fromDDL(added)
    names = {f.name.lower() for f in new}
    kept = docs.select("doc_id", "text") if digests_only else docs.drop(*(c for c in docs.columns if c.lower() in names))
    base = [f for f in kept.schema if not (digests_only and f.name == "text")]
    schema = StructType([*base, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            made: dict[str, list] = {f.name: [] for f in new}
            for text in batch.column("text"):
                ids = own.encode(text.as_py() or "")
                decoded = own.decode(ids)
                made["n_tokens"].append(len(ids))
                made["ids_sha256"].append(hashlib.sha256(little_endian(ids)).hexdigest())
                made["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if not digests_only:
                    made["token_ids"].append(ids)
                    made["decoded"].append(decoded)
            arrow = {"token_ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in base] + [pa.array(made[f.name], arrow.get(f.name, pa.string())) for f in new],
                names=schema.names,
            )

    return kept.mapInArrow(run, schema)
