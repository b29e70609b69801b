import hashlib
import json
import random
import re

import public_tokenizers as P
import pytest
import regex
from tokenizers import Tokenizer

from tillscope.llm import tree_bpe

FILE = P.path("byte_bpe_50k.json")
ALPHABET = ["a", "B", "é", "ß", "Σ", "̇", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "'", "s", "'re",
            "'ll", ",", ".", "1", "²", "٣", "日", "🙂", "​", "<|", "<|endoftext|>", "<|endoftext|><|endoftext|>", "the", "ing", " of "]


def texts(n, seed):
    rnd = random.Random(seed)
    return [None, ""] + ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 25))) for _ in range(n)] + [
        "word " * 20_000, "".join(rnd.choice("abcdeinrst") for _ in range(20_000))]


def test_encode_and_decode_equal_library(docs_of):
    lib = Tokenizer.from_file(FILE)
    all_texts = texts(2000, 1)
    docs = docs_of([*enumerate(all_texts), (None, "again"), (3, all_texts[3])])
    encoded = tree_bpe.encode_documents(docs, FILE)
    import numpy as np

    ids = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in encoded.collect()}
    decoded = {r.doc_id: r.decoded for r in tree_bpe.decode_documents(encoded, FILE).collect()}
    digests = tree_bpe.round_trip_digests(docs, FILE).collect()
    assert len(digests) == len(all_texts) + 2 and tree_bpe.round_trip_digests(docs.limit(0), FILE).count() == 0
    digests = {r.doc_id: r for r in digests}
    for i, t in [*enumerate(all_texts), (None, "again")]:
        expected = lib.encode(t or "", add_special_tokens=False).ids
        assert ids[i] == expected and decoded[i] == lib.decode(expected, skip_special_tokens=False) == (t or "")
        assert digests[i].n_tokens == len(expected)
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_decode_of_any_ids_equals_library(spark):
    lib, own = Tokenizer.from_file(FILE), tree_bpe.Coder(open(FILE, encoding="utf-8").read())
    rnd = random.Random(2)
    for _ in range(3000):
        ids = [rnd.randrange(50_300) for _ in range(rnd.randint(0, 6))]
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)
    row = spark.createDataFrame([(1, None), (2, bytearray(b"\x00\x00\x00\x00"))], "doc_id long, ids binary")
    assert {r.doc_id: r.decoded for r in tree_bpe.decode_documents(row, FILE).collect()} == {1: "", 2: "!"}


def test_merging_equals_search_for_the_lowest_pair():
    rnd = random.Random(3)
    for _ in range(400):
        letters = rnd.randint(1, 4)
        merges, known = {}, letters
        while len(merges) < 12:
            pair = rnd.randrange(known), rnd.randrange(known)
            if pair not in merges:
                merges[pair] = len(merges), known
                known += 1
        parts = [rnd.randrange(letters) for _ in range(rnd.randint(0, 40))]
        expected = list(parts)
        while ranked := [(merges[p][0], i) for i, p in enumerate(zip(expected, expected[1:], strict=False)) if p in merges]:
            i = min(ranked)[1]
            expected[i : i + 2] = [merges[expected[i], expected[i + 1]][1]]
        assert tree_bpe.merge_parts(parts, merges) == expected


def test_written_out_classes_are_those_of_the_pattern():
    for code in range(0x250):
        for name, written in ((r"\p{L}", "A-Za-zªµºÀ-ÖØ-öø-ɏ"), (r"\p{N}", "0-9²³¹¼½¾"), (r"\s", "\t-\r \x85\xa0")):
            assert f"[{written}]" in tree_bpe.LATIN_PATTERN or written in tree_bpe.LATIN_PATTERN
            assert bool(regex.match(name, chr(code))) == bool(re.match(f"[{written}]", chr(code)))


def test_other_kinds_of_tokenizer_are_refused():
    spec = json.load(open(FILE, encoding="utf-8"))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"model": spec["model"] | {"ignore_merges": True}}):
        with pytest.raises(ValueError):
            tree_bpe.Coder(json.dumps(spec | change))


def test_registered_query_equals_library(spark, tmp_path):
    from tillscope.llm.queries import queries

    lib = Tokenizer.from_file(FILE)
    rows = list(enumerate(texts(100, 4)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries()["op13_tree_bpe"](spark, str(tmp_path)).collect():
        ids = lib.encode(rows[r.doc_id][1] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_a_full_memo_keeps_what_is_still_met(monkeypatch):
    monkeypatch.setattr(tree_bpe, "CACHE_TOKENS", 5)
    merged = []
    true = tree_bpe.merge_parts
    monkeypatch.setattr(tree_bpe, "merge_parts", lambda *a: merged.append(a[0]) or true(*a))
    coder, lib = tree_bpe.Coder(open(FILE, encoding="utf-8").read()), Tokenizer.from_file(FILE)
    for i in range(60):
        text = f"often w{chr(97 + i % 26)}x{chr(97 + i // 26)}"
        assert coder.encode(text) == lib.encode(text, add_special_tokens=False).ids
        assert len(coder) + len(coder.old) <= 2 * (5 + 3)
    assert sum(p == [coder.byte_ids[b] for b in b"often"] for p in merged) == 1
