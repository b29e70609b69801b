import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillscope.llm import periodic_runs as pr


def plain_runs(words):
    """All runs, by comparing the words with themselves at every lag."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                best.setdefault((start, i + q), q)
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def made(rnd):
    """Words with runs of short and long periods, periods that hold runs themselves, cut off anywhere."""
    letters = rnd.choice([1, 2, 2, 3, 5, 50])
    some = lambda n: [b"%d" % rnd.randrange(letters) for _ in range(n)]
    out = some(rnd.randint(0, 60))
    for _ in range(rnd.randint(0, 3)):
        period = some(rnd.randint(1, 120))
        if rnd.random() < 0.5:
            period = some(rnd.randint(1, 6)) * rnd.randint(1, 15) + some(rnd.randint(0, 10))
        if rnd.random() < 0.3:
            period = period * rnd.randint(1, 5) + some(2)
        off = rnd.randrange(len(period))
        out += (period * 8)[off : off + rnd.randint(3 * len(period), 6 * len(period))] + some(rnd.randint(0, 10))
    return out


def found(texts):
    return [[tuple(r) for r in runs.tolist()] for runs in pr.runs_of_texts(texts)]


def test_runs_equal_plain_search():
    rnd = random.Random(11)
    long = 0
    for _ in range(60):
        texts = [made(rnd) for _ in range(10)] + [[]]
        expected = [plain_runs(t) for t in texts]
        long += sum(q >= pr.SHORT for runs in expected for *_, q in runs)
        assert found(texts) == expected
    assert long > 100


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b"]), max_size=90), max_size=4), st.integers(1, 40))
def test_runs_of_few_letters(texts, times):
    texts = [t * times if len(t) * times < 400 else t for t in texts]
    assert found(texts) == [plain_runs(t) for t in texts]


def test_hashes_that_meet_by_chance_change_nothing(monkeypatch):
    true = pr._Prefixes.hashes
    monkeypatch.setattr(pr._Prefixes, "hashes", lambda self, a, b: true(self, a, b) >> np.uint64(62))
    rnd = random.Random(12)
    for _ in range(20):
        texts = [made(rnd) for _ in range(5)]
        assert found(texts) == [plain_runs(t) for t in texts]


def test_work_stays_linear_on_one_word_and_nested_periods():
    """Evenly spaced equal minimizers seed pairs at their ends only."""
    for words in ([b"a"] * 200_000, ([b"a"] * 40 + [b"b"]) * 5000):
        pairs = 0
        numbers = np.array([w == b"a" for w in words], np.int64)
        scale, grams, hashed = pr.SHORT, pr._mixed(numbers.astype(np.uint64)), 1
        while 4 * scale <= len(words):
            while hashed < scale // 4:
                grams = pr._mixed(grams[:-hashed] * pr._MIX + (grams[hashed:] ^ (grams[hashed:] >> np.uint64(32))))
                hashed *= 2
            at = pr.minimizers(grams, scale // 4)
            pairs += len(pr.seed_pairs(at, grams[at], scale)[0])
            scale *= 2
        assert pairs < 4 * len(words)
    assert found([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]


def collapse(words, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_detect_and_digests_of_documents(spark, docs_of):
    rnd = random.Random(13)
    texts = [None, "", " \n\t ", "a " * 6, "a a a a a", "x y " * 9, "日 本 " * 4, "q\x1cr " * 5, "w " * 30_000]
    texts += [b" ".join(made(rnd)).decode() for _ in range(60)]
    rows = [*enumerate(texts), (None, texts[-1]), (3, texts[3])]
    docs = docs_of(rows).repartition(3)
    runs = {r.doc_id: r for r in pr.detect(docs).collect()}
    digests = {r.doc_id: r for r in pr.digests(docs).collect()}
    assert pr.digests(docs).count() == len(rows) and pr.detect(docs.limit(0)).count() == 0
    for i, text in [*enumerate(texts), (None, texts[-1])]:
        words = (text or "").encode().split()
        expected = plain_runs(words) if len(words) < 10_000 else [(0, 30_000, 1)]
        kept = b" ".join(collapse(words, expected))
        assert [(r.start, r.start + r.length, r.period) for r in runs[i].runs] == expected
        assert runs[i].collapsed == kept.decode()
        d = digests[i]
        top = min(((s - e, s, q) for s, e, q in expected), default=None)
        assert d.n_runs == len(expected)
        assert (d.start, d.length, d.period, d.exponent_milli) == (
            (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2]))
        assert d.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in expected).encode()).hexdigest()
        assert d.collapsed_sha256 == hashlib.sha256(kept).hexdigest()


def test_planted_words():
    from tillscope.llm.queries import planted_words

    planted = 0
    for doc_id in range(-5, 300):
        words = [b"%d" % i for i in range(40)]
        h = zlib.crc32(str(doc_id).encode())
        got = planted_words(doc_id, " ".join(map(str, range(40))))
        if h % 10:
            assert got == words
            continue
        planted += 1
        g = h // 10
        a = g % 40
        p = 1 + (40 - a) // (3 + g % 8)
        assert got[:a] == words[:a] and all(got[i] == (words[i] if i < a + p else got[i - p]) for i in range(a, 40))
    assert planted > 10 and planted_words(None, "a b") == [b"a", b"b"] and planted_words(7, None) == []
