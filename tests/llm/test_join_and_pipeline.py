import random

import corpus_pipeline
from pyspark.sql import functions as F

from tillscope.llm import ngram_join
from tillscope.llm.components import components


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute(rows, n, share):
    """Component of every id: all pairs compared."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= share * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in sets}


def corpus():
    rnd = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(25)]
    texts = [None, "", "  ", "one", "one two", "One TWO", "one two three", "a b c d e", "a b c d e f", "a b c d e f"]
    for _ in range(20):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 90))] + (passage if rnd.random() < 0.5 else [])
        for _ in range(rnd.randint(1, 6)):
            own = list(base)
            for _ in range(rnd.randint(0, 3)):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            texts.append(" ".join(own))
    hot = [rnd.choice(vocabulary) for _ in range(60)]  # one large group of near copies
    for k in range(40):
        texts.append(" ".join([*hot[: k % 5 + 50], *([f"x{k}"] if k % 2 else [])]))
    texts.append(" ".join(rnd.choice(vocabulary) for _ in range(6000)))
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows += [(1, "one two three four five six"), (rows[40][0], rows[90][1]), (rows[50][0], rows[50][1]), (None, rows[20][1])]
    rnd.shuffle(rows)
    return rows


def test_join_equals_all_pairs(docs_of):
    rows = corpus()
    out = ngram_join.near_duplicates(docs_of(rows), n=4, share=85).collect()
    assert len(out) == len(rows)
    expected = brute(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in out} == expected | {None: None}
    sizes = sorted((r.doc_id or 0, r.n_shingles) for r in out)
    assert sizes == sorted((i or 0, len(shingles(t, 4))) for i, t in rows)


def longer_versions(rnd):
    """Pairs of a text and the same with 5 to 15 % new words, appended or put in; no two pairs share a word."""
    rows = []
    for k in range(80):
        base = [f"p{k}w{i}" for i in range(rnd.randint(40, 130))]
        new = [f"p{k}n{i}" for i in range(max(2, round(len(base) * rnd.uniform(0.05, 0.15))))]
        at = len(base) if k % 2 else rnd.randrange(len(base))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:at] + new + base[at:]))]
    return rows


def test_join_finds_longer_versions(docs_of):
    rows = longer_versions(random.Random(11))
    for share in (80, 85):
        expected = brute(rows, 5, share)
        assert sum(i != c for i, c in expected.items()) > 40
        out = ngram_join.near_duplicates(docs_of(rows), n=5, share=share).collect()
        assert {r.doc_id: r.component_id for r in out} == expected


def edited(rnd, base, edits, tag):
    """``base`` with as many words, spread out, replaced by new ones."""
    own, step = list(base), len(base) // max(1, edits)
    for k in range(edits):
        own[k * step + rnd.randrange(max(1, step - 8))] = f"{tag}e{k}"
    return " ".join(own)


def test_join_of_sizes_around_the_threshold(docs_of):
    """Pairs of every size, cut, lengthened and edited so that similarities lie closely on both sides of the threshold."""
    rnd = random.Random(17)
    rows = []
    for k in range(260):
        base = [f"k{k}w{i}" for i in range(rnd.choice([4, 5, 6, 8, 11, 16, 17, 31, 33, 60, 64, 65, 120, 257]) + rnd.randrange(3))]
        other = list(base)
        for _ in range(rnd.randint(0, max(1, len(base) // 40))):
            other[rnd.randrange(len(other))] = f"k{k}x{rnd.randrange(99)}"
        cut = rnd.randint(0, max(1, len(base) // 8))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other[cut:] + [f"k{k}y{i}" for i in range(rnd.randint(0, cut))]))]
    for share in (60, 85):
        expected = brute(rows, 4, share)
        linked = sum(i != c for i, c in expected.items())
        assert 40 < linked < 240
        out = ngram_join.near_duplicates(docs_of(rows), n=4, share=share).collect()
        assert {r.doc_id: r.component_id for r in out} == expected


def test_group_just_below_the_threshold_stays_linear(docs_of, monkeypatch):
    """300 near copies of one text, of one length, whose similarities lie just below the threshold, met row by row."""
    rnd = random.Random(19)
    base = [f"w{i}" for i in range(150)]
    rows = [(k, edited(rnd, base, 2, f"d{k}")) for k in range(300)] + [(k, " ".join(base)) for k in range(300, 310)]
    met = []
    true = ngram_join._worth
    monkeypatch.setattr(ngram_join, "_worth", lambda rows_met, share, **kw: met.append(rows_met.count()) or true(rows_met, share, **kw))
    out = ngram_join.near_duplicates(docs_of(rows), n=4, share=93).collect()
    assert {r.doc_id: r.component_id for r in out} == brute(rows, 4, 93)
    assert len(met) == 2 and max(met) < 20 * len(rows)  # all pairs would be 45,000 for every shared token


def test_rows_of_one_id_and_text_are_one_set(docs_of, monkeypatch):
    """A row repeated whole 300 times, the pivot of its near copies, doesn't multiply what is verified."""
    rnd = random.Random(23)
    base = [f"w{i}" for i in range(120)]
    rows = [(1, " ".join(base))] * 300 + [(k, edited(rnd, base, 1, f"d{k}")) for k in range(2, 42)]
    seen = []
    true = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, sets, share: seen.append((sets.count(), sets.select("doc_id").distinct().count())) or true(pairs, sets, share))
    out = ngram_join.near_duplicates(docs_of(rows).repartition(5), n=4, share=85).collect()
    assert {r.doc_id: r.component_id for r in out} == dict.fromkeys([1, *range(2, 42)], 1)
    assert all(n == ids for n, ids in seen) and seen[0][0] == 41


def test_bands_cover_every_size(spark):
    rows = spark.range(1, 5000).select(
        F.col("id"), ngram_join._band(F.col("id")).alias("band")).select("*", ngram_join._band_start(F.col("band")).alias("start")).collect()
    for a, b in zip(rows, rows[1:], strict=False):
        assert a.band <= b.band and a.start <= a.id and (a.band == b.band or b.start == b.id)


def test_registered_join_equals_its_sql(docs_of, spark, tmp_path):
    import duckdb

    from tillscope.llm.queries import oracle_sql, queries

    docs_of(corpus()).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.sql(oracle_sql()["op4_ngram_join"])
    got = queries()["op4_ngram_join"](spark, str(tmp_path)).select(*rel.columns).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(rel.fetchall(), key=key)


def test_join_leaves_no_tables_behind(docs_of, spark):
    import os

    folder = spark.sparkContext.getCheckpointDir() or ngram_join.written(spark.range(1), "probe") and spark.sparkContext.getCheckpointDir()
    folder = folder.removeprefix("file:")
    parent = os.path.dirname(folder.rstrip("/"))
    count = lambda: sum(name.startswith("llm-") for _, names, _ in os.walk(parent) for name in names)
    before = count()
    ngram_join.near_duplicates(docs_of(corpus()), n=4, share=85).collect()
    assert count() - before <= 8  # what the lazy result still reads


def test_join_of_empty_table(docs_of):
    assert ngram_join.near_duplicates(docs_of([(1, "a b")]).limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(129, 200), (200, 300), (7, 7), (500, 499)]
    out = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 1 for i in range(1, 41)} | {k: 100 for k in [*range(100, 130), 200, 300]} | {499: 499, 500: 499}


def test_prefix_lengths_agree():
    for size in (1, 3, 7, 100, 999):
        for matches in (1, 2, 4):
            assert ngram_join.prefix_length(size, matches, 85) == size - (85 * size + 99) // 100 + matches


def test_pipeline_stages(docs_of, spark, tmp_path):
    good = "This is a quiet line about gardens number {} with some more plain words in it and then a few others at the end"
    rows = [(i, good.format(f"k{i} " + " ".join(f"q{i}z{j}" for j in range(12))), "en", "s") for i in range(60)]
    rows += [(100, rows[5][1], "en", "s"), (101, rows[6][1] + " more", "en", "s"), (102, None, "en", "s"), (103, "too short", None, None),
             (104, rows[7][1] + ' password = "abcdefgh12345678"', "de", None), (7, rows[7][1], "en", "s"), (None, good.format("nothing"), "en", "s")]
    rows += [(200 + i, good.format(f"you idiot moron z{i} " + " ".join(f"t{i}z{j}" for j in range(12))), "en", "s") for i in range(40)]
    docs = docs_of(rows).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    spark.createDataFrame([(i, 1, int(i >= 200)) for i in [*range(60), *range(200, 240)]], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, kept, str(tmp_path)), name)
        assert kept.columns == docs.columns
        ids[name] = sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect())
    clean = sorted((i is None, i) for i, *_ in rows if i is None or i < 200)
    assert ids["toxicity"] == clean
    assert ids["quality"] == [x for x in clean if x[1] not in (102, 103)]
    components_ = brute([(r[0], r[1]) for r in rows if r[0] is not None and r[0] < 102 or r[0] == 104], 5, 80)
    assert ids["near_duplicates"] == sorted({(False, c) for c in components_.values()}) + [(True, None)]
    assert not any("abcdefgh12345678" in r.text for r in kept.collect())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {i for _, i in ids["secrets"]}
    assert sum(r.length for r in packed) == sum(d for _, d in {(r.doc_id, r.doc_tokens) for r in packed})
    spark.createDataFrame([], docs.schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Columns named like the stages' own, repeated ids with different texts, rows without id, a long text: values stay."""
    words = lambda tag, n: " ".join(f"{tag}plain{j}" for j in range(n))
    texts = [(i, f"A quiet line about gardens {words(f'k{i}', 14)} and then a few others at the end") for i in range(40)]
    texts += [(3, f"Something else altogether {words('other', 20)} under a known number"), (None, texts[4][1]), (None, None),
              (50, words("long", 20_000)), (51, texts[5][1]), (5, texts[5][1]), (52, texts[6][1] + ' token = "abcdefgh12345678"')]
    names = ["findings", "_key", "_blob", "row", "score", "r_id", "r_key", "key", "tie", "blob", "clean", "kept", "rejected",
             "_toxic_rejected", "f_blob", "group", "a.b"]
    rows = [(i, t, "en", "s", len(t or ""), *[f"{c}{k}" for c in names]) for k, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names)
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").collect()} == {i for i, _ in texts}
            continue
        assert out.columns == docs.columns
        got = out.collect()
        kept[name] = sorted(r["_key"] for r in got)
        original = {r[-len(names) + 1]: r for r in rows}
        for r in got:
            own = original[r["_key"]]
            assert tuple(r)[5:] == own[5:] and r.doc_id == own[0]
            assert name == "secrets" or r.text == own[1]
        if name == "secrets":
            assert "abcdefgh12345678" not in next(r.text for r in got if r.doc_id == 52)
            assert all(r.n_chars == len(r.text or "") for r in got)
    every = [f"_key{k}" for k in range(len(rows))]
    assert kept["toxicity"] == kept["secrets"] == sorted(every)
    assert set(every[:40]) <= set(kept["quality"]) and "_key42" not in kept["quality"]
    # the copy without an id, the copy under a larger id, the near copy, and one of two rows of one id and text
    gone = set(every) - set(kept["near_duplicates"])
    assert len(gone) == 4 and gone - {"_key5", "_key45"} == {"_key41", "_key44", "_key46"}
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, none, str(tmp_path)).count() == 0 and stage(spark, none, str(tmp_path)).columns == docs.columns
