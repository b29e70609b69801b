import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from tillscope.llm import byte_bpe, packing

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
ALPHABET = ["a", "B", "é", "É", "ß", "Σ", "ς", "İ", "̇", "́", " ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "'", "s", "t",
            ",", ".", "!", "1", "²", "日", "🙂", "<|", "<|endoftext|>", "<|ENDOFTEXT|>", "the", "ing", " of "]


def texts(n, seed=1):
    rnd = random.Random(seed)
    return [None, ""] + ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 25))) for _ in range(n)] + ["word " * 5000]


def test_byte_bpe_equals_library_and_round_trips(docs_of):
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    all_texts = texts(3000)
    docs = docs_of(list(enumerate(all_texts)) + [(None, "again"), (3, all_texts[3])])
    encoded = byte_bpe.encode_documents(docs, RANKS, P.PATTERN)
    ids = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in encoded.collect()}
    decoded = {r.doc_id: bytes(r.decoded).decode() for r in byte_bpe.decode_documents(encoded, RANKS).collect()}
    digests = {r.doc_id: r for r in byte_bpe.round_trip_digests(docs, RANKS, P.PATTERN).collect()}
    for i, t in enumerate(all_texts):
        assert ids[i] == lib.encode_ordinary(t or "") and decoded[i] == (t or "")
        assert digests[i].n_tokens == len(ids[i])
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids[i])).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    ranks = byte_bpe.read_ranks(RANKS)
    table = byte_bpe.PerfectHash(ranks)
    assert len(table.keys) == len(ranks) and all(table.get(k) == v for k, v in ranks.items())
    assert all(table.get(b"\xff\xfe" + bytes([k])) == -1 for k in range(200))


def test_word_ids_equal_library():
    own = packing.WordIds(open(WORDS, encoding="utf-8").read())
    lib = Tokenizer.from_file(WORDS)
    for t in texts(6000, 2):
        assert np.frombuffer(own.text_ids(t), "<u4").tolist() == lib.encode(t or "", add_special_tokens=False).ids, t


def test_packed_ids_of_a_block_equal_the_library_and_look_each_word_up_once(monkeypatch):
    rnd, text = random.Random(2), open(WORDS, encoding="utf-8").read()
    lib, own = Tokenizer.from_str(text), packing.WordIds(text)
    parts = [*"abcABC'’srtvemldΣσςÀé0129.,!<>|(){}\\\"-_~`=/ \n\t\r\x0b\x0c\x1c\x85\xa0\u3000", "\u0301", "\u0338", "İ", "😀", "<|endoftext|>", "'ll,"]
    texts = [None, "", "q" * 70 + " " + "q" * 71] + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    for t, ids in zip(texts, own.texts_ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t or "", add_special_tokens=False).ids, t
    asked, missing = [], packing.WordIds.__missing__
    monkeypatch.setattr(packing.WordIds, "__missing__", lambda self, word: (asked.append(word), missing(self, word))[1])
    packing.WordIds(text).texts_ids(["Word, (word) word.", "WORD! word"] * 50)
    assert sorted(asked) == [b"!", b"(", b")", b",", b".", b"word"]



def test_a_full_word_memo_keeps_what_is_still_met(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = packing.WordIds(f.read())
    first = None
    for i in range(60):
        words.text_ids(f"often w{chr(97 + i % 26)}x{chr(97 + i // 26)}")
        first = first or words[b"often"]
        assert words[b"often"] is first  # the same object: not encoded anew
        assert len(words) + len(words.old) <= 2 * (5 + 2)


def test_packing_places_every_id_once(docs_of):
    all_texts = texts(400, 3)
    rows = list(enumerate(all_texts)) + [(None, "no id"), (5, all_texts[5])]
    out = packing.pack_documents(docs_of(rows), WORDS, seq_len=64, group_docs=100).collect()
    lib = Tokenizer.from_file(WORDS)
    own = sorted((r for r in out if r.doc_id == 402), key=lambda r: r.start)
    ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in own]).tolist()
    assert ids == lib.encode(all_texts[402], add_special_tokens=False).ids + [1] and own[0].doc_tokens == len(ids)
    assert sum(r.length for r in out) == sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    by_sequence = {}
    for r in out:
        assert r.length == len(r.ids) // 4 and zlib.crc32(bytes(r.ids)) >= 0
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces[:-1]]).tolist() and sum(n for _, n in pieces) <= 64
    assert sum(n for p in by_sequence.values() for _, n in p) > 0.9 * 64 * len(by_sequence)
    assert packing.pack_documents(docs_of(rows).limit(0), WORDS).count() == 0


def test_first_fit_decreasing_equals_plain_search():
    rnd = random.Random(4)
    for _ in range(50):
        lengths = sorted((rnd.randint(1, 30) for _ in range(rnd.randint(1, 60))), reverse=True)
        rooms, expected = [], []
        for n in lengths:
            k = next((i for i, room in enumerate(rooms) if room >= n), len(rooms))
            if k == len(rooms):
                rooms.append(30)
            expected.append((k, 30 - rooms[k]))
            rooms[k] -= n
        assert packing.first_fit_decreasing(lengths, 30) == expected
