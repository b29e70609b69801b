"""Words of many texts as columns: spans in one byte string, hashed and compared a byte of all words at a time."""

from __future__ import annotations

import zlib

import numpy as np

def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
LONG_WORD = 64  #: bytes; longer words are handled one by one


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words from longest to shortest, and how many have more than 0, 1, ... bytes; ``LONG_WORD`` and one more count as one length."""
    short = (LONG_WORD + 1 - np.minimum(lengths, LONG_WORD + 1)).astype(np.uint16)
    return np.argsort(short, kind="stable"), np.cumsum(np.bincount(short, minlength=LONG_WORD + 2))[LONG_WORD::-1]


def crc32s(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``zlib.crc32`` of each word, all words a byte at a time."""
    letters = np.frombuffer(data, np.uint8)
    order, longer = _by_length(lengths)
    at, crc = starts[order], np.full(len(starts), 0xFFFFFFFF, np.uint32)
    for k in range(LONG_WORD):
        n = longer[k]
        if not n:
            break
        now = crc[:n]
        crc[:n] = _CRC.take((now & np.uint32(255)) ^ letters.take(at[:n] + k)) ^ (now >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = ~crc
    for i in order[: longer[LONG_WORD]].tolist():
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]])
    return out


def spans(texts: list[str | None], kinds: np.ndarray, cuts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with A-Z lower-cased and a space after each, the starts and lengths of the words, and each text's
    first word with the number of words at the end.  ``kinds`` gives every byte's kind, 0 between words and for the
    space; a new word begins between bytes of kinds a and b where ``cuts[a, b]``."""
    raw = [t.encode() if t else b"" for t in texts]
    data = b" ".join([*raw, b""]).lower()
    kind = kinds.take(np.frombuffer(data, np.uint8))
    edges = np.concatenate([[0], np.flatnonzero(cuts[kind[:-1], kind[1:]]) + 1, [len(data)]])
    own = np.flatnonzero(kind[edges[:-1]]) if len(data) else np.arange(0)
    starts, lengths = edges[own], edges[own + 1] - edges[own]
    stops = np.cumsum([len(x) + 1 for x in raw], dtype=np.int64)
    return data, starts, lengths, np.concatenate([[0], np.searchsorted(starts, stops)])


def same_words(a: bytes, a_starts: np.ndarray, b: bytes, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether words of the same lengths are equal, pair by pair."""
    a_letters, b_letters = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    order, longer = _by_length(lengths)
    a_at, b_at, same = a_starts[order], b_starts[order], np.ones(len(order), bool)
    for k in range(LONG_WORD):
        n = longer[k]
        if not n:
            break
        same[:n] &= a_letters.take(a_at[:n] + k) == b_letters.take(b_at[:n] + k)
    for i in range(longer[LONG_WORD]):
        n = lengths[order[i]]
        same[i] = a[a_at[i] : a_at[i] + n] == b[b_at[i] : b_at[i] + n]
    out = np.empty(len(order), bool)
    out[order] = same
    return out


def first_alike(data: bytes, starts: np.ndarray, lengths: np.ndarray, rounds: int = 8) -> np.ndarray:
    """For each word the number of one equal word, mostly the same for all of them; a word not settled after ``rounds`` has itself."""
    hashes, out = crc32s(data, starts, lengths), np.arange(len(starts))
    bits = max(1, min(31, len(starts).bit_length() + 1))
    table, open_ = np.zeros(1 << bits, np.int32), out.astype(np.int32)
    for _ in range(rounds):
        if not len(open_):
            break
        slot = (hashes[open_] >> np.uint32(32 - bits)).astype(np.intp)
        table[slot] = open_
        found = table.take(slot)
        same = (hashes[found] == hashes[open_]) & (lengths[found] == lengths[open_])
        maybe = np.flatnonzero(same)
        same[maybe] = same_words(data, starts[found[maybe]], data, starts[open_[maybe]], lengths[open_[maybe]])
        out[open_[same]] = found[same]
        open_ = open_[~same]
        hashes[open_] = hashes[open_] * np.uint32(0x9E3779B1) ^ np.uint32(0x85EBCA77)
    return out
