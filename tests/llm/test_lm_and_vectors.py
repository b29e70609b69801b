import math
import random
import zlib
from collections import Counter

import numpy as np

from tillscope.llm import hnsw, maxent_lm, queries

DATA = "/root/testdata/sf0.01"


def test_base_score_equals_brute_force_and_model_beats_it(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: r for r in queries.op3_lm_scoring(spark, DATA).collect()}
    counts = Counter()
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 7 != 2:
            counts.update([*maxent_lm.words_of(d.text), None])
    n, v = sum(counts.values()), len(counts)
    for d in docs:
        words, r = [*maxent_lm.words_of(d.text), None], out[d.doc_id]
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
    held = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_is_a_distribution_and_edges(docs_of):
    rows = [(i, t) for i, t in enumerate(["a b c a", "b a\tb", "c c c a b", "É e"] * 5)]
    model, counts = maxent_lm.fit(docs_of(rows), head=3)
    seen = {bytes(r.word): r.n for r in counts.collect()}
    texts = [None, "", "a b", "zz a", "c " * 3000, "A B"]
    out = maxent_lm.score_texts(docs_of(list(enumerate(texts)) + [(2, "a b")]), model, counts, ["doc_id", "token"]).toPandas().sort_values("doc_id")
    assert len(out) == 7 and out.n_tokens.tolist() == [1, 1, 3, 3, 3, 3001, 3]
    assert out.n_known.tolist() == [1, 1, 3, 3, 2, 3001, 3]
    assert math.isclose(out.base_score.iloc[2], out.base_score.iloc[6])  # "a b" and "A B"
    vocabulary = maxent_lm.Vocabulary({maxent_lm.END: 0})
    codes, sizes = vocabulary.codes(["a b"])
    _, features = maxent_lm._history(vocabulary, codes, sizes)
    p = maxent_lm._softmax(model.weights, model.bias, features)
    inside = np.ones(maxent_lm.CLASSES)  # the share of unseen words
    for word, n in seen.items():
        inside[maxent_lm.class_of(word)] += n + 1
    assert np.allclose(p.sum(1), 1, atol=1e-5) and np.allclose(inside, model.class_total)
    nothing, none = maxent_lm.fit(docs_of(rows).limit(0))
    assert maxent_lm.score_texts(docs_of([(1, "a")]), nothing, none, ["doc_id"]).first().n_known == 0
    assert maxent_lm.score_texts(docs_of(rows).limit(0), model, counts, ["doc_id"]).count() == 0


def test_history_chooses_among_the_words_of_a_class(docs_of):
    # "tab" and "grab" share their last two bytes, so a class, and their count: only the history tells them apart
    rows = [(i, "red tab" if i % 2 else "blue grab") for i in range(600)]
    model, counts = maxent_lm.fit(docs_of(rows))
    assert maxent_lm.class_of(b"tab") == maxent_lm.class_of(b"grab")
    texts = ["red tab", "red grab", "blue tab", "blue grab"]
    score = {r.doc_id: r.score for r in maxent_lm.score_texts(docs_of(list(enumerate(texts))), model, counts, ["doc_id"]).collect()}
    assert score[0] > score[1] + 0.2 and score[3] > score[2] + 0.2


def test_score_equals_brute_force_and_adds_up_to_one(docs_of):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["aa", "ba", "ca", "xx", "yx", "é"]) for _ in range(rnd.randrange(9)))) for i in range(200)]
    model, counts = maxent_lm.fit(docs_of(rows), head=2, cell_ridge=1.0)
    trees, seen = model.trees, {bytes(r.word): r.n for r in counts.collect()}
    assert np.abs(trees.cells).max() > 0
    u32 = lambda x: x & 0xFFFFFFFF

    def features(one, two):
        a, b, c = maxent_lm._MIX
        return [u32(one * a), u32((u32(two * b) ^ u32(u32(one * c) * 5)) * a), u32(two * c)]

    def log_class(h):
        logits = model.bias + sum(model.weights[x >> 18] for x in h)
        return logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max()

    def log_leaf(class_, path, h):
        out = 0.0
        for level in range(trees.bits):
            node = (class_ << trees.bits) + (1 << level) + (path >> (trees.bits - level))
            key = u32(node * maxent_lm._MIX[1])
            x = trees.bias[node] + sum(trees.cells[(3 * level + f) * maxent_lm.CELLS + (u32((v ^ key) * maxent_lm._MIX[0]) >> 18)] for f, v in enumerate(h))
            out -= math.log1p(math.exp(-x if path >> (trees.bits - level - 1) & 1 else x))
        return out

    start = zlib.crc32(b" ")
    for text, r in zip(["aa ba", "zz xx yx", ""], maxent_lm.score_texts(
            docs_of([(0, "aa ba"), (1, "zz xx yx"), (2, "")]), model, counts, ["doc_id"]).orderBy("doc_id").collect(), strict=True):
        one = two = start
        want = 0.0
        for word in [*maxent_lm.words_of(text), maxent_lm.END]:
            h, c, path = features(one, two), maxent_lm.class_of(word), zlib.crc32(word) >> (32 - trees.bits)
            leaf = 0.5**trees.bits + sum(n + 1 for w, n in seen.items() if maxent_lm.class_of(w) == c and zlib.crc32(w) >> (32 - trees.bits) == path)
            want += log_class(h)[c] + log_leaf(c, path, h) + math.log((seen.get(word, 0) + 1) / leaf)
            one, two = zlib.crc32(word), one
        assert math.isclose(r.score, want / math.log(10), rel_tol=1e-4)
    h = features(zlib.crc32(b"aa"), zlib.crc32(b"xx"))
    leaves = [log_class(h)[c] + log_leaf(c, p, h) for c in range(maxent_lm.CLASSES) for p in range(1 << trees.bits)]
    assert math.isclose(sum(map(math.exp, leaves)), 1, rel_tol=1e-4)


def test_tokens_of_a_block_equal_plain_python():
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "A b", "É" * 70 + " x" * 3, "q" * 64 + " " + "q" * 65 + " " + "Q" * 1000 + " " + "q" * 999 + "r"]
    texts += ["".join(rnd.choice("abcABC é\t\n\x0b\x0c\r\x85 \x1c😀") for _ in range(rnd.randrange(60))) for _ in range(200)]
    head = {w: i + 1 for i, w in enumerate(sorted({w for t in texts[1::2] for w in maxent_lm.words_of(t)}))} | {maxent_lm.END: 77}
    vocabulary = maxent_lm.Vocabulary(head)
    for block in (texts, [None], ["a"], [" a"]):
        tokens, sizes = vocabulary.codes(block)
        at, _ = maxent_lm._features(tokens, sizes)
        want = [w for t in block for w in [*maxent_lm.words_of(t), maxent_lm.END]]
        assert tokens.hashes[at].tolist() == [zlib.crc32(w) for w in want]
        assert tokens.classes[at].tolist() == [maxent_lm.class_of(w) for w in want]
        assert vocabulary.counts(tokens)[at].tolist() == [head.get(w, -1) for w in want]


def test_head_tells_words_of_one_hash_apart():
    a, b = b"plumless", b"buckeroo"
    assert zlib.crc32(a) == zlib.crc32(b)
    for known, other in ((a, b), (b, a)):
        vocabulary = maxent_lm.Vocabulary({known: 5, maxent_lm.END: 1})
        tokens, _ = vocabulary.codes([(known + b" " + other).decode()])
        assert vocabulary.counts(tokens)[tokens.places].tolist() == [5, -1]


def test_gradient_equals_brute_force(docs_of):
    texts = ["a b c a", "b a\tb", None, "c é é b"] * 3
    rng = np.random.default_rng(5)
    trees = maxent_lm.grow_trees([(maxent_lm.class_of(w), zlib.crc32(w) >> 29, 4) for w in (b"a", b"b", b"c")], 3)
    trees.cells = rng.normal(0, 0.3, len(trees.cells)).astype(np.float32)
    weights, bias = rng.normal(0, 0.3, (maxent_lm.ROWS, maxent_lm.CLASSES)).astype(np.float32), np.zeros(maxent_lm.CLASSES, np.float32)
    step, (wrong, curve) = maxent_lm._gradient(docs_of(list(enumerate(texts))), weights, bias, trees)
    want, want_wrong, want_curve = np.zeros_like(step, float), np.zeros_like(wrong, float), np.zeros_like(curve, float)
    for text in texts:
        tokens, sizes = maxent_lm.Vocabulary({}).codes([text])
        at, features = maxent_lm._features(tokens, sizes)
        for i, (h, c) in enumerate(zip(tokens.hashes[at], tokens.classes[at], strict=True)):
            own = [f[i : i + 1] for f in features]
            rows = [int(r[0]) for r in maxent_lm._rows(own)]
            p = np.exp(bias + weights[rows].sum(0))
            miss = np.eye(maxent_lm.CLASSES)[c] - p / p.sum()
            for r in [*rows, maxent_lm.ROWS]:
                want[r] += [*miss, 1]
            for side, logit, cells in maxent_lm._choices(trees, np.array([c]), np.array([h]), own):
                right = 1 / (1 + math.exp(-logit[0]))
                for x in cells:
                    want_wrong[x[0]] += side[0] - right
                    want_curve[x[0]] += right * (1 - right)
    assert np.allclose(step, want, atol=1e-4) and np.allclose(wrong, want_wrong, atol=1e-4) and np.allclose(curve, want_curve, atol=1e-4)


def test_gradients_handed_on_follow_the_tokens_not_the_files(docs_of, monkeypatch):
    tasks, gradient = [], maxent_lm._gradient
    monkeypatch.setattr(maxent_lm, "_gradient", lambda docs, *rest: (tasks.append(docs.rdd.getNumPartitions()), gradient(docs, *rest))[1])
    docs = docs_of([(i, "a b c") for i in range(60)]).repartition(30)
    model, _ = maxent_lm.fit(docs, rounds=2)
    assert model.tokens == 240 and tasks == [1, 1]


def brute(vectors, query, k):
    own = np.array(vectors[query], float)
    found = [(-float(np.array(v, float) @ own), i) for i, v in vectors.items() if i != query]
    return [(i, -s) for s, i in sorted(found)[:k]]


def test_graph_recall(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(3000, 24)).astype(np.float32) * rng.uniform(0.5, 1.5, (3000, 1)).astype(np.float32)
    vectors = {i: p.tolist() for i, p in enumerate(points)}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    valid = hnsw.valid_vectors(table)
    out = hnsw.nearest(valid.where("id % 100 = 0"), hnsw.build_index(valid, 11, shard_nodes=1500), k=10, beam=96, block_queries=16).collect()
    hits = 0
    for q in range(0, 3000, 100):
        own = sorted((r.rank, r.vec_id, r.score) for r in out if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 11))
        hits += len({r[1] for r in own} & {i for i, _ in brute(vectors, q, 10)})
    assert hits / 300 >= 0.9


def test_vector_edges(spark):
    rnd = random.Random(2)
    rows = [(i, [float(rnd.randint(-2, 2)) for _ in range(3)], "x") for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 2.0], "x") for i in range(40)]
    rows += [(200, None, "x"), (201, [0.0, 0.0, 0.0], "x"), (202, [1.0, float("nan"), 1.0], "x"), (203, [1.0, None, 1.0], "x"),
             (204, [float("inf"), 1.0, 1.0], "x"), (205, [1.0, 1.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (100, [1.0, 2.0, 2.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    valid = hnsw.valid_vectors(table)
    index = hnsw.build_index(valid, copies=6, shard_nodes=16)
    out = hnsw.nearest(valid.where("id % 20 = 0"), index, k=5, block_queries=3).collect()
    good = {i: v for i, v, _ in rows if i is not None and i < 200 and any(v)}
    for q in (i for i in good if i % 20 == 0):
        assert [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q] == brute(good, q, 5)
    assert {r.query_id for r in out} == {i for i in good if i % 20 == 0}
    assert hnsw.nearest(valid.limit(0), index, k=5).count() == 0
    assert hnsw.valid_vectors(table).where("id = 205").count() == 1
