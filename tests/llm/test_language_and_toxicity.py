import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from tillscope.llm import language_id, queries, toxicity

DATA = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    out = queries.op6_language_id(spark, DATA)
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "text")
    rows = out.join(truth, "doc_id").where("held_out and length(text) > 60").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(docs_of):
    learned = language_id.learn_dictionaries(docs_of(
        [(i, "the cat and the dog in the house " * 3, "en") for i in range(3)]
        + [(9, "der hund und die katze im haus " * 3, "de"), (10, "x", None), (11, None, "fr")]))
    assert set(learned) == {"en", "de"}
    rows = [(1, None), (2, ""), (3, "12 !!"), (4, "the dog and the cat"), (5, "die katze und der hund " * 2000), (5, "die katze"), (None, "the house")]
    out = language_id.predict_language(docs_of(rows), learned).collect()
    assert [r.lang_pred for r in out] == ["und", "und", "und", "en", "de", "de", "en"]
    assert {r.lang_pred for r in language_id.predict_language(docs_of(rows), {}).collect()} == {"und"}
    assert language_id.learn_dictionaries(docs_of(rows).limit(0)) == {}


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(0)
    model = toxicity.Restorer(rng.integers(0, 50, (toxicity.SIZE,) * 3))

    def cost(letters, extra):
        codes = [0, 0, *[int(toxicity._LETTERS[ord(c)]) for c in letters], 0]
        return extra + sum(model.cost[a * toxicity.SIZE + b][c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))

    for token in ("1d10t", "p@$$", "id!ot", "aaab", "i d i o t", "s*t", "l.o.s.e.r", "éé1"):
        paths = [("".join(x for x, _ in p), sum(y for _, y in p)) for p in itertools.product(*model.lattice(token))]
        best = min(cost(*p) for p in paths)
        assert any(math.isclose(cost(*p), best) and p[0] == model.decode(token) for p in paths), token


def test_disguised_words_are_found_and_scored(docs_of):
    clean = ["the weather is fine and we like the garden " + w for w in "abcdefghijklmnopqrstuvwxyz"] * 3
    toxic = [f"the weather is {x} and we like the garden " + w for w in "abcdefghijklmnopqrstuvwxyz" for x in ("idiot", "loser")]
    rows = [(i, t) for i, t in enumerate([x + f" {i}" for i, x in enumerate(clean + toxic)])]
    docs = docs_of(rows + [(500, None), (501, "")])
    labels = docs.select("doc_id", (F.col("doc_id") >= len(clean)).cast("int").alias("toxic")).where("doc_id < 500")
    labels = labels.union(labels.limit(1).selectExpr("doc_id", "cast(null as int)"))
    model = toxicity.fit(docs, labels)
    probes = ["what an 1d10t", "i d i o t !", "a L0SER", "idddiioot", "the garden is fine", None, "", "a a a a a " * 3000, "the idiot's"]
    out = toxicity.score(docs_of(list(enumerate(probes)) + [(0, probes[0])]), model, ["doc_id", "score"], prefix="t_").collect()
    assert [r.t_rejected for r in out] == [True, True, True, True, False, False, False, False, True, True]
    assert {r.score for r in out} == {0.5} and all(0 <= r.t_score <= 1 for r in out)
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.rejected for r in toxicity.score(docs, none, ["doc_id"]).collect()} == {False}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0)), ["doc_id"]).count() == 0


def test_toxicity_held_out(spark):
    out = queries.op2_toxicity(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = [r.predicted for r in out if r.toxic == 1]
    assert sum(hits) / len(hits) > 0.6 and np.mean([r.predicted for r in out if r.toxic == 0]) < 0.03
