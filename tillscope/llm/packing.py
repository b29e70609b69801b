"""Packing documents into token sequences.

Each document becomes its token ids and an end id, is cut into pieces of at
most ``seq_len`` ids, and the pieces are packed by first-fit decreasing: the
longest piece first, each into the first sequence with room, found in
O(log n) in a tournament tree whose inner nodes hold the largest free room
below them.  Packing runs in randomised groups of about ``group_docs``
documents: each piece is dealt to a group by a hash of its document, position
and ids, so that no document, source, group of copies or repeated id fills one
group, and groups are packed independently.

Words repeat far more often than they change, so a worker keeps the ids of
words it has met, twice ``CACHE_WORDS`` at most: when a memo is full it becomes
the old one, words still met move to the new, and the rest goes with the next
change.  Texts are read in blocks of about ``BLOCK_BYTES``; equal words of a
block are found by their hashes, compared byte by byte, and looked up once.
The tests check this against encoding whole texts.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed each; a null id stays null; an empty table gives no pieces; ties in
length are ordered by document id and start.
"""

from __future__ import annotations

import itertools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import slices
from tillscope.llm.word_columns import first_alike, spans

CACHE_WORDS = 350_000
TURN_WORDS = 50_000  #: words looked up before the memo may turn
BLOCK_BYTES = 4_000_000
#: Kinds of bytes: gaps, a-z, ASCII punctuation but the apostrophe, and all others.  Where letters and punctuation
#: meet the tokenizer always splits, so "word," and "(word" are looked up as the word and the mark.
_KINDS = np.full(256, 3, np.uint8)
_KINDS[list(b" \n")], _KINDS[list(b"abcdefghijklmnopqrstuvwxyz")], _KINDS[list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = 0, 1, 2
_CUTS = np.zeros((4, 4), bool)
_CUTS[0, 1:] = _CUTS[1:, 0] = _CUTS[1, 2] = _CUTS[2, 1] = True
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_CUT = "doc_id long, start long, length long, doc_tokens long, ids binary"


class RoomTree:
    """Free room of sequences 0..capacity-1 with a tournament for the first that has enough."""

    def __init__(self, sequences: int, room: int):
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def take(self, need: int) -> tuple[int, int]:
        """Put ``need`` ids into the first sequence with room; returns it and its room before."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < need:
                at += 1
        room = best[at]
        best[at] = room - need
        found = at - self.leaves
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return found, room


def first_fit_decreasing(lengths: list[int], seq_len: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each length; ``lengths`` must be sorted from longest to shortest."""
    tree = RoomTree(len(lengths), seq_len)
    return [(s, seq_len - room) for s, room in map(tree.take, lengths)]


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 and up, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(0x100) if x not in printable]
    return {x: chr(x) for x in printable} | {x: chr(0x100 + i) for i, x in enumerate(others)}


class WordIds(dict):
    """Word (A-Z lower-cased, UTF-8) to its ids as little-endian uint32 bytes, filled by the tokenizer when a word is new.

    For a tokenizer that lower-cases, drops white space and splits letters from
    everything else.  A word ending in a comma or full stop after a letter is
    the word and the mark; a word of small Latin letters is one pre-token, so
    the tokenizer's model alone gives its ids; the rest goes through the whole
    tokenizer.  Texts that may hold a special token's string go through it whole.
    """

    def __init__(self, tokenizer_json: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.old: dict[bytes, bytes] = {}
        self.marks = sorted({x.content[:2] for x in self.tokenizer.get_added_tokens_decoder().values()})

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.pop(word, None)
        if ids is not None:
            self[word] = ids
            return ids
        text = word.decode()
        if len(text) > 1 and text[-1] in ",." and text[-2].lower().isalpha():
            ids = self[word[:-1]] + self[word[-1:]]
        elif text.isalpha() and text == text.lower() and max(text) < "\u0250":
            letters = text if text.isascii() else "".join([self.letters[x] for x in word])
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])
        else:
            ids = self.encode(text)
        self[word] = ids
        return ids

    def text_ids(self, text: str | None) -> bytes:
        return self.texts_ids([text])[0]

    def turn(self) -> None:
        if len(self) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()

    def texts_ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text without the end; a word is looked up once for all its places."""
        whole = {i: self.encode(t) for i, t in enumerate(texts) if t and any(mark in t for mark in self.marks)}
        data, starts, lengths, firsts = spans([None if i in whole else t for i, t in enumerate(texts)], _KINDS, _CUTS)
        alike = first_alike(data, starts, lengths)
        own = np.flatnonzero(alike == np.arange(len(alike)))
        found: list[bytes] = []
        for a in range(0, len(own), TURN_WORDS):
            self.turn()
            now = own[a : a + TURN_WORDS]
            found += [self[data[x : x + n]] for x, n in zip(starts[now].tolist(), lengths[now].tolist(), strict=True)]
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        number = np.empty(len(alike), np.int64)
        number[own] = np.arange(len(own))
        number = number[alike]
        size = sizes[number]
        stops = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat((np.cumsum(sizes) - sizes)[number] - stops[:-1], size) + np.arange(stops[-1])
        ids = np.frombuffer(b"".join(found), "<u4").take(at).tobytes()
        bounds = (4 * stops[firsts]).tolist()
        return [whole[i] if i in whole else ids[a:b] for i, (a, b) in enumerate(itertools.pairwise(bounds))]


_WORKER: dict[int, WordIds] = {}


def cut_documents(docs: DataFrame, tokenizer_path: str, seq_len: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece with its ids; every id of a document lies in exactly one piece."""
    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    digest = zlib.crc32(text.encode())
    model = docs.sparkSession.sparkContext.broadcast(text)  # one vocabulary file, a few MB

    def cut(batches):
        words = _WORKER.get(digest)
        if words is None:
            words = _WORKER[digest] = WordIds(model.value)
        end = np.asarray([end_id], "<u4").tobytes()
        step = 4 * seq_len
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                out = {"doc_id": [], "start": [], "length": [], "doc_tokens": [], "ids": []}
                for doc_id, ids in zip(part["doc_id"].to_pylist(), words.texts_ids(part["text"].to_pylist()), strict=True):
                    ids += end
                    for at in range(0, len(ids), step):
                        piece = ids[at : at + step]
                        out["doc_id"].append(doc_id)
                        out["start"].append(at // 4)
                        out["length"].append(len(piece) // 4)
                        out["doc_tokens"].append(len(ids) // 4)
                        out["ids"].append(piece)
                yield pa.RecordBatch.from_pydict(out, schema=_schema(_CUT))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, _CUT)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def pack_documents(
    docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 1, group_docs: int = 1024,
    seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces with their ids (little-endian uint32) and place: ``sequence_id``, ``offset``.

    ``group_docs`` documents on average share a group; a group's index times
    2^31 plus the sequence's index in it is the ``sequence_id``.
    """
    groups = max(1, -(-docs.count() // group_docs))
    schema = _schema(PIECES)

    def pack(key, table):
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        lengths = table["length"].to_pylist()
        places = first_fit_decreasing(lengths, seq_len)
        first = key[0].as_py() << 31
        return pa.table(
            [table["doc_id"], table["start"], table["length"], table["doc_tokens"],
             pa.array([first + s for s, _ in places], pa.int64()), pa.array([o for _, o in places], pa.int64()),
             table["ids"]],
            schema=schema,
        )

    pieces = cut_documents(docs, tokenizer_path, seq_len, end_id, id_col, text_col)
    # the ids too: rows without an id, or of one repeated id, are dealt by what they hold
    group = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(0)), "start", "ids"), F.lit(groups))
    return pieces.withColumn("pack_group", group).groupBy("pack_group").applyInArrow(pack, PIECES)
