import re
from collections import Counter

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillscope.llm import quality_rules as Q

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "é", "a b c d e", " ", "\n", "\t\n", "#|", "A"]), max_size=40).map(" ".join)), min_size=1, max_size=40))
def test_counts_equal_brute_force(docs_of, texts):
    out = {r.doc_id: tuple(r[n] for n in NAMES) for r in Q.text_statistics(docs_of(list(enumerate(texts))), ["doc_id"]).collect()}
    assert out == {i: brute(t) for i, t in enumerate(texts)}


def mcd(x, share=0.75, steps=4):
    """The same concentration steps with numpy, cuts on the same histogram."""
    ridge = np.diag([v * v for v in Q.FEATURES.values()])
    keep = np.ones(len(x), bool)
    for _ in range(steps + 1):
        mean, cov = x[keep].mean(0), np.cov(x[keep].T, bias=True) + ridge
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        bucket = np.floor(32 * np.log1p(d)).astype(int)
        cut = next(b for b in range(bucket.max() + 1) if (bucket <= b).sum() >= share * len(x))
        keep = bucket <= cut
    return d / max(1.0, np.expm1((cut + 1) / 32) / Q._chi2(share, x.shape[1]))


def test_outliers_equal_numpy(docs_of, spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(160):
        words = ["w" * int(k) for k in rng.integers(2, 8, 30)]
        text = " ".join(words) + str(i)
        rows.append((i, text + " %%% ### $$$" * 9 if i % 40 == 0 else text, "en" if i < 90 else None, "s"))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "one two", "xx", "tiny"), (1, rows[1][1], "en", "s")]
    out = Q.judge(docs_of(rows), ["doc_id"]).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    for members in (range(90), range(90, 160)):
        ids = [i for i in members if not by_id[i].base_failed] + ([1] if 1 in members else [])
        x = np.array([[np.log(r.word_chars / r.n_words), np.log1p(100 * r.n_symbols / r.word_chars), np.log1p(100 * r.n_upper / r.word_chars)]
                      for r in (by_id[i] for i in ids)])
        assert np.allclose([by_id[i].distance for i in ids], mcd(x), rtol=1e-6)
    assert not any(by_id[i].kept for i in (0, 40, 80, 120, 900, 901, 902))
    assert [r for r in out if not r.kept and not r.base_failed and r.doc_id % 40 and r.doc_id < 900] == []
    assert Q.judge(docs_of(rows).limit(0), ["doc_id"]).count() == 0


def test_small_groups_are_judged(docs_of):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(104):
        lang, source = ("en", "s") if i < 84 else ("en", "small") if i < 94 else ("xx", "few")
        text = " ".join("w" * int(k) for k in rng.integers(2, 8, 30)) + str(i)
        rows.append((i, text + "".join(f" %#{k}$$$" for k in range(20)) if i in (90, 100) else text, lang, source))
    by_id = {r.doc_id: r for r in Q.judge(docs_of(rows), ["doc_id"]).collect()}
    assert sorted(i for i, r in by_id.items() if not r.kept and not r.base_failed) == [90, 100]
    features = lambda r: [np.log(r.word_chars / r.n_words), np.log1p(100 * r.n_symbols / r.word_chars), np.log1p(100 * r.n_upper / r.word_chars)]
    for ids, judged in (range(84), range(84)), (range(94), range(84, 94)), (range(104), range(94, 104)):
        ids = [i for i in ids if not by_id[i].base_failed]
        expected = dict(zip(ids, mcd(np.array([features(by_id[i]) for i in ids])), strict=True))
        assert all(np.isclose(by_id[i].distance, expected[i], rtol=1e-6) for i in judged if i in expected)
