"""BPE encoding and decoding by a tokenizer file, with a segment tree over adjacent pair ranks.

The file is that of a byte-level tokenizer: added tokens are cut out of a text
first, the rest is split into pre-tokens by the byte-level pattern, and each
pre-token's bytes are merged by the file's ranked pairs.  Merging keeps a
segment tree with one leaf per part of the pre-token that holds the rank of its
pair with the next part (none: infinity) together with its place.  Inner nodes
hold the least of their leaves, so the root is the leftmost pair of lowest rank.
A merge changes three leaves, each a walk from leaf to root, and merging ends
when the root is infinite: m parts take O(m log m).

A worker keeps the ids of pre-tokens it has met, twice ``CACHE_TOKENS`` at most:
when a memo is full it becomes the old one, those still met move to the new, and
the rest goes with the next change.  Decoding turns ids into tokens, tokens into bytes and those
into text, special tokens included; ids that the file doesn't know are skipped,
and bytes that are no UTF-8 become U+FFFD.

Defined cases: a null text counts as empty and has no ids; a null list of ids
decodes to an empty text; rows that repeat are handled each; a null id is kept.
A file with a normalizer, prefix space, dropout, unknown tokens or word-end
marks raises ``ValueError``: it describes another kind of tokenizer.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import slices

CACHE_TOKENS = 500_000
_NONE = 1 << 62


def _pattern(letter: str, number: str, space: str) -> str:
    """The byte-level split pattern over the given contents of character classes."""
    return (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
            f"|[{space}]+(?![^{space}])|[{space}]+")


ANY_PATTERN = _pattern(r"\p{L}", r"\p{N}", r"\s")
#: For texts of characters below U+0250 only, whose classes can be written out: the standard ``re`` module is faster.
LATIN_PATTERN = _pattern("A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others U+0100 and up in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def merge_parts(parts: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Ids of a pre-token from its first parts, merging the leftmost pair of lowest rank until none has a rank.

    ``merges``: pair of ids to rank and merged id.  The tree is one list: node i
    has the children 2 i and 2 i + 1, the leaves follow the inner nodes, and a
    leaf holds its pair's rank and, in the lower bits, its place.
    """
    n = len(parts)
    if n < 2:
        return parts
    bits = max(0, n - 2).bit_length()
    size = 1 << bits
    get = merges.get
    parts = list(parts)
    least = [_NONE] * (2 * size)
    for i in range(n - 1):
        if (ranked := get((parts[i], parts[i + 1]))) is not None:
            least[size + i] = ranked[0] << bits | i
    for i in range(size - 1, 0, -1):
        a, b = least[2 * i], least[2 * i + 1]
        least[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (root := least[1]) != _NONE:  # the leftmost pair of lowest rank
        i = root & size - 1
        j = after[i]
        merged = parts[i] = merges[parts[i], parts[j]][1]
        parts[j] = -1
        k = after[i] = after[j]
        h = before[i]
        changed = [(i, _NONE)]
        if k < n:
            before[k] = i
            changed[0] = (i, ranked[0] << bits | i if (ranked := get((merged, parts[k]))) is not None else _NONE)
            changed.append((j, _NONE))
        if h >= 0:
            changed.append((h, ranked[0] << bits | h if (ranked := get((parts[h], merged))) is not None else _NONE))
        for place, leaf in changed:  # point updates: from the leaf up, as long as a node changes
            at = place + size
            if least[at] == leaf:
                continue
            least[at] = leaf
            while at > 1:
                other = least[at ^ 1]
                at >>= 1
                if other < leaf:
                    leaf = other
                if least[at] == leaf:
                    break
                least[at] = leaf
    return [p for p in parts if p >= 0]


class Coder(dict):
    """Encoder and decoder of one tokenizer file; as a dict, the memo from pre-token to its ids."""

    def __init__(self, tokenizer_json: str):
        import regex

        spec = json.loads(tokenizer_json)
        model, split, added = spec["model"], spec["pre_tokenizer"], spec["added_tokens"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if (odd or spec["normalizer"] or model["type"] != "BPE" or (split or {}).get("type") != "ByteLevel"
                or split["add_prefix_space"] or not split.get("use_regex", True)
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)):
            raise ValueError("not a plain byte-level BPE tokenizer file")
        vocab = model["vocab"]
        letters = byte_letters()
        self.old: dict[str, list[int]] = {}
        self.byte_ids = [vocab[letter] for letter in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.token = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocab.items()}
        self.token |= {t["id"]: t["content"].encode() for t in added}
        self.added = {t["content"]: t["id"] for t in added}
        marks = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(marks)})").split if marks else lambda text: [text]
        self.find_any, self.find_latin = regex.compile(ANY_PATTERN).findall, re.compile(LATIN_PATTERN).findall
        self.beyond_latin = re.compile("[^\x00-ɏ]").search

    def __missing__(self, pre_token: str) -> list[int]:
        ids = self.old.pop(pre_token, None)
        if ids is None:
            ids = merge_parts([self.byte_ids[b] for b in pre_token.encode()], self.merges)
        self[pre_token] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(self) > CACHE_TOKENS:
            self.old = dict(self)
            self.clear()
        find = self.find_any if self.beyond_latin(text) else self.find_latin
        out: list[int] = []
        for i, piece in enumerate(self.cut(text)):
            if i % 2:
                out.append(self.added[piece])
            else:
                out.extend(chain.from_iterable(map(self.__getitem__, find(piece))))
        return out

    def decode(self, ids: list[int]) -> str:
        token = self.token
        return b"".join([token[i] for i in ids if i in token]).decode("utf-8", "replace")


_WORKER: dict[int, Coder] = {}


def _coder(frame: DataFrame, tokenizer_path: str):
    """A function that gives a task its worker's coder."""
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    digest = zlib.crc32(text.encode())
    sent = frame.sparkSession.sparkContext.broadcast(text)  # one vocabulary file, a few MB

    def get() -> Coder:
        if digest not in _WORKER:
            _WORKER[digest] = Coder(sent.value)
        return _WORKER[digest]

    return get


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian uint32 bytes) of each whole text."""
    coder = _coder(docs, tokenizer_path)

    def run(batches):
        encode = coder().encode
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [np.array(encode(t), "<u4").tobytes() for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id`` and ``decoded`` (the text that the ids stand for)."""
    coder = _coder(encoded, tokenizer_path)

    def run(batches):
        decode = coder().decode
        for batch in batches:
            texts = [decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def round_trip_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the ids again and digest both, without sending either between processes."""
    coder = _coder(docs, tokenizer_path)

    def run(batches):
        own = coder()
        decimal = {i: str(i) for i in own.token}
        for batch in batches:
            for part in slices(batch, "text"):
                n, of_ids, of_text = [], [], []
                for text in part["text"].to_pylist():
                    ids = own.encode(text)
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                    of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
