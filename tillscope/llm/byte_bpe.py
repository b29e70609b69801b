"""Byte-level BPE: encoding and decoding by a rank file.

Each match of the split pattern is a pre-token and is encoded on its own.
First tier: a minimal perfect hash over the vocabulary (hash and displace:
keys fall into buckets, each bucket keeps the displacement that sends its keys
to free slots of a table with exactly one slot per vocabulary entry; a lookup
is one hash, one displacement, one comparison) resolves a pre-token that is
itself a vocabulary entry.  Second tier, for misses: the bytes form a doubly
linked list, a heap holds the rank of every adjacent pair, and the lowest rank
(leftmost on ties) is merged until no pair has a rank.

A worker remembers the ids of pre-tokens it has resolved (``CACHE_TOKENS`` at
most, then it starts afresh).  Tables are built once in the driver from the
rank file and broadcast; their size is the vocabulary's.

Defined cases: a null text counts as empty and has no ids; a null list of ids
decodes to no bytes; a lone byte missing from the ranks raises ``KeyError``, as
it would in the library; an id outside the vocabulary raises ``KeyError`` when
decoded; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import slices

CACHE_TOKENS = 800_000
_BUCKET_KEYS = 3
#: Letters, numbers and white space below U+0250, for texts that hold no other characters: the standard ``re``
#: module, which has no Unicode classes, then splits them alike and in half the time.
_LATIN = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ɏ", r"\p{N}": "0-9²³¹¼½¾", r"\s": "\t-\r \x85\xa0"}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash of the keys, with the key and its value in each slot."""

    def __init__(self, entries: dict[bytes, int]):
        self.size = max(1, len(entries))
        self.buckets = self.size // _BUCKET_KEYS + 1
        by_bucket: dict[int, list[tuple[int, bytes]]] = {}
        for key in entries:
            h = xxhash.xxh3_64_intdigest(key)
            by_bucket.setdefault((h >> 32) % self.buckets, []).append((h, key))
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [-1] * self.size
        free = set(range(self.size))
        for bucket, members in sorted(by_bucket.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:  # a single key can go straight to any free slot, marked by a negative shift
                slots = [free.pop()]
                self.shift[bucket] = -slots[0] - 1
            else:
                shift = 0
                while True:
                    slots = [self._slot(h, shift) for h, _ in members]
                    if len(set(slots)) == len(slots) and free.issuperset(slots):
                        break
                    shift += 1
                self.shift[bucket] = shift
                free.difference_update(slots)
            for slot, (_, key) in zip(slots, members, strict=True):
                self.keys[slot], self.values[slot] = key, entries[key]

    def _slot(self, h: int, shift: int) -> int:
        mixed = (h ^ (shift * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (mixed >> 24) % self.size

    def get(self, key: bytes) -> int:
        """The key's value, or -1 if it isn't one of the keys."""
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[(h >> 32) % self.buckets]
        slot = -shift - 1 if shift < 0 else self._slot(h, shift)
        return self.values[slot] if self.keys[slot] == key else -1


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token that is no vocabulary entry, merging lowest rank first over linked bytes."""
    n = len(piece)
    right = list(range(1, n + 1))  # start of the next part; n: the end
    left = list(range(-1, n - 1))
    heap = []
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = right[i]
        if middle < 0 or middle >= n or right[middle] != end:  # one of the two parts has changed since
            continue
        right[i], right[middle] = end, -1
        if end < n:
            left[end] = i
            after = right[end]
            rank = get(piece[i:after])
            if rank is not None:
                heapq.heappush(heap, (rank, i, after))
        before = left[i]
        if before >= 0:
            rank = get(piece[before:end])
            if rank is not None:
                heapq.heappush(heap, (rank, before, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : right[i]]])
        i = right[i]
    return out


def _latin(pattern: str) -> str:
    """The pattern with its Unicode classes written out for characters below U+0250."""
    letters, numbers, space = (_LATIN[k] for k in (r"\p{L}", r"\p{N}", r"\s"))
    out, depth, i = [], 0, 0
    while i < len(pattern):
        two, five = pattern[i : i + 2], pattern[i : i + 5]
        if five in (r"\p{L}", r"\p{N}"):
            part, i = (letters if five == r"\p{L}" else numbers), i + 5
        elif two == r"\s":
            part, i = space, i + 2
        elif two == r"\S" and not depth:
            out.append(f"[^{space}]")
            i += 2
            continue
        else:
            depth += (pattern[i] == "[") - (pattern[i] == "]")
            out.append(pattern[i])
            i += 1
            continue
        out.append(part if depth else f"[{part}]")
    return "".join(out)


class Codec(dict):
    """Encoder and decoder; as a dict, the memo from pre-token to its ids (little-endian uint32 bytes)."""

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash, pattern: str):
        import regex

        self.ranks, self.table = ranks, table
        self.find_any, self.find_latin = regex.compile(pattern).findall, re.compile(_latin(pattern)).findall
        self.beyond_latin = re.compile("[^\x00-\u024f]").search
        self.token = {rank: token for token, rank in ranks.items()}

    def __missing__(self, pre_token: str) -> bytes:
        raw = pre_token.encode("utf-8")
        whole = self.table.get(raw)
        ids = np.array([whole] if whole >= 0 else merge_bytes(raw, self.ranks), "<u4").tobytes()
        self[pre_token] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self) > CACHE_TOKENS:
            self.clear()
        find = self.find_any if self.beyond_latin(text) else self.find_latin
        return b"".join(map(self.__getitem__, find(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_WORKER: dict[int, Codec] = {}


def _codec(docs: DataFrame, ranks_path: str, pattern: str):
    """A function that gives a task its worker's codec."""
    ranks = read_ranks(ranks_path)
    digest = zlib.crc32(repr((sorted(ranks.items()), pattern)).encode())
    sent = docs.sparkSession.sparkContext.broadcast((ranks, PerfectHash(ranks)))  # one vocabulary

    def get() -> Codec:
        if digest not in _WORKER:
            _WORKER[digest] = Codec(*sent.value, pattern)
        return _WORKER[digest]

    return get


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian uint32 bytes) of each whole text."""
    codec = _codec(docs, ranks_path, pattern)

    def run(batches):
        encode = codec().encode
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(map(encode, part["text"].to_pylist()), pa.binary())], ["doc_id", "ids"])

    return _pruned(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str = "") -> DataFrame:
    """``doc_id`` and ``decoded`` (the bytes that the ids stand for)."""
    codec = _codec(encoded, ranks_path, pattern)

    def run(batches):
        decode = codec().decode
        for batch in batches:
            texts = [decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the ids again and digest both, without sending either between processes."""
    codec = _codec(docs, ranks_path, pattern)

    def run(batches):
        own = codec()
        decimal = {rank: str(rank) for rank in own.token}
        for batch in batches:
            for part in slices(batch, "text"):
                n, of_ids, of_text = [], [], []
                for text in part["text"].to_pylist():
                    ids = np.frombuffer(own.encode(text), "<u4").tolist()
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(own.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _pruned(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _pruned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
