"""Quality rules and robust multivariate outliers.

``text_statistics`` counts, per text: words, characters in words, symbols,
upper-case letters, lines, repeated lines, and words inside five-word windows
that occur twice or more.

``judge`` fits a minimum-covariance-determinant estimate for every (language,
source) group and rejects rows whose transformed statistics lie too far from it
by Mahalanobis distance.  The estimate is found by concentration steps: mean
and covariance of the rows kept so far, distances of all rows to it, then the
``share`` of rows with the smallest distances is kept, and so on.  The first
step starts from all rows of the group, gross outliers among them, so a group
whose bad rows lie together and exceed about a quarter (1 - ``share``) keeps
them.  A step is one aggregation over the narrow statistics table (partial
sums map-side, so a source with a third of all rows is no hot task) and one
histogram of distances, from which the cut of each group is read.  Estimates go
to the rows by a join on (group, salt).  The inverse is a Cholesky factor
written out in columns.  Everything is DataFrame code.

Defined cases: a null or empty text has no words and fails the base rules;
null languages and sources form groups of their own; a group with fewer than
``least_rows`` rows that passed the base rules is judged by the estimate of all
rows of its language, and where the language has fewer too, by that of the whole
table, however small (a row alone is its own estimate and stays);
``ridge`` is added to every variance, so a group without spread in a statistic
(or of copies of one text) stays well defined; repeated rows count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import SPACE_CLASS, WORD_CLASS, written

WINDOW = 5
SALTS = 16


def text_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the counts of each text (longs)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        *[F.col(c) for c in keep], text.alias("_text"),
        F.array_remove(F.split(text, SPACE_CLASS + "+", -1), "").alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(WORD_CLASS))).alias("_lines"),
    )
    without = lambda chars: F.length(F.regexp_replace("_text", chars, ""))
    rows = rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - without(r"[#*$%&|<>]+")).cast("long").alias("n_symbols"),
        (F.length("_text") - without(r"[A-Z]+")).cast("long").alias("n_upper"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hash"),
    )
    at = lambda i, k: F.get(F.col("_hash"), i + k)
    windows = F.when(
        F.size("_hash") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_hash") - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])),
    )
    rows = rows.withColumn("_windows", windows).withColumn("_kinds", F.size(F.array_distinct("_windows")))
    # only texts with a repeated window go on: (window, place) sorted, those equal to a neighbour, back in text order
    rows = rows.withColumn("_sorted", F.when(
        F.col("_kinds") < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    beside = lambda k: F.get(F.col("_sorted"), k)["w"]
    rows = rows.withColumn("_places", F.sort_array(F.transform(
        F.filter("_sorted", lambda s, k: F.coalesce(s["w"] == beside(k - 1), F.lit(False)) | F.coalesce(s["w"] == beside(k + 1), F.lit(False))),
        lambda s: s["i"])))
    covered = F.aggregate(
        F.transform("_places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_hash", "_windows", "_kinds", "_sorted", "_places")


#: Judged statistics with the standard deviation that ``ridge`` assumes at least.  Repetition is the base rules'
#: affair: repeated lines and passages are common in good documents and carry no verdict here.
FEATURES = {"word_length": 0.1, "symbol_rate": 0.3, "upper_rate": 0.4}
GROUP = ["g_lang", "g_source"]
ALL = "*"  #: in place of a key: all languages or sources (keys of rows are "null" or start with "=")


def _features(stats: DataFrame) -> DataFrame:
    """Base verdict, group key and transformed statistics of each row."""
    rate = lambda n: F.log1p(100.0 * F.col(n) / F.col("word_chars"))
    usable = F.col("word_chars") > 0
    return stats.select(
        "*",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("null")).alias("g_lang"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null")).alias("g_source"),
        F.when(usable, F.log(F.col("word_chars") / F.col("n_words"))).alias("word_length"),
        F.when(usable, rate("n_symbols")).alias("symbol_rate"),
        F.when(usable, rate("n_upper")).alias("upper_rate"),
    )


def _levels(fit: DataFrame, least_rows: int) -> DataFrame:
    """The group that judges each group (``by_lang``, ``by_source``): itself, its language or the whole table.

    Also ``by_own`` and, per language, ``lang_judges``: which estimates the group's rows shape.
    """
    groups = fit.groupBy(*GROUP).count()
    langs = groups.groupBy("g_lang").agg(F.sum("count").alias("n_lang"), F.min("count").alias("n_least"))
    own, lang = F.col("count") >= least_rows, F.col("n_lang") >= least_rows
    return groups.join(langs, "g_lang").select(
        *GROUP, own.alias("by_own"), (lang & (F.col("n_least") < least_rows)).alias("lang_judges"),
        F.when(own | lang, F.col("g_lang")).otherwise(F.lit(ALL)).alias("by_lang"),
        F.when(own, F.col("g_source")).otherwise(F.lit(ALL)).alias("by_source"))


def _salted(per_group: DataFrame) -> DataFrame:
    return per_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _shaping(fit: DataFrame, levels: DataFrame) -> DataFrame:
    """Each row once for every estimate that it shapes, the group columns naming the estimate."""
    table_judges = levels.where(F.col("by_lang") == ALL).limit(1).count() > 0
    key = lambda lang, source: F.struct(lang.alias("g_lang"), source.alias("g_source"))
    keys = F.filter(
        F.array(
            F.when(F.col("by_own"), key(F.col("g_lang"), F.col("g_source"))),
            F.when(F.col("lang_judges"), key(F.col("g_lang"), F.lit(ALL))),
            F.when(F.lit(table_judges), key(F.lit(ALL), F.lit(ALL)))),
        lambda k: k.isNotNull())
    return fit.join(_salted(levels), [*GROUP, "salt"]).select(F.explode(keys).alias("key"), "salt", *FEATURES).select(
        "key.*", "salt", *FEATURES)


def _estimate(rows: DataFrame) -> DataFrame:
    """Mean and Cholesky factor of the covariance, per group: columns m_i and l_i_j."""
    names = list(FEATURES)
    aggs = [F.avg(n).alias(f"m_{i}") for i, n in enumerate(names)]
    aggs += [
        (F.covar_pop(a, names[j]) + F.lit(FEATURES[a] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}")
        for i, a in enumerate(names) for j in range(i + 1)
    ]
    est = rows.groupBy(*GROUP).agg(*aggs)
    for i in range(len(names)):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            est = est.withColumn(f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}"))
    return est.drop(*[f"c_{i}_{j}" for i in range(len(names)) for j in range(i + 1)])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution; null without an estimate."""
    ys: list[Column] = []
    for i, name in enumerate(FEATURES):
        y = F.col(name) - F.col(f"m_{i}")
        for k, earlier in enumerate(ys):
            y = y - F.col(f"l_{i}_{k}") * earlier
        ys.append(y / F.col(f"l_{i}_{i}"))
    return sum((y * y for y in ys[1:]), ys[0] * ys[0])


def _bucket() -> Column:
    return F.floor(32 * F.log1p("d2")).cast("long")


def _with_estimate(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Left join on (group, salt): a group with a third of all rows is spread over the salts."""
    return rows.join(_salted(est), [*GROUP, "salt"], "left").withColumn("d2", _distance())


def _with_cut(rows: DataFrame, est: DataFrame, share: float) -> DataFrame:
    """The estimate with ``cut``: the histogram bucket below which ``share`` of the group's distances lie."""
    counts = _with_estimate(rows, est).where("d2 is not null").groupBy(*GROUP, _bucket().alias("bucket")).count()
    group = Window.partitionBy(*GROUP)  # a few hundred buckets a group
    below = F.sum("count").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    cuts = (
        counts.withColumn("below", below).withColumn("all", F.sum("count").over(group))
        .where(F.col("below") >= share * F.col("all"))
        .groupBy(*GROUP).agg(F.min("bucket").alias("cut"))
    )
    return est.drop("cut").join(cuts, GROUP)


def _chi2(share: float, d: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty)."""
    from statistics import NormalDist

    return d * (1 - 2 / (9 * d) + NormalDist().inv_cdf(share) * (2 / (9 * d)) ** 0.5) ** 3


def judge(
    docs: DataFrame, keep: list[str], share: float = 0.75, steps: int = 4, cutoff: float = 36.0, least_rows: int = 50,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """``keep`` columns of each row, its statistics, ``base_failed``, ``distance`` (null: no words, or no row of the group passed the base rules) and ``kept``.

    ``least_rows`` rows make an estimate of a group's or language's own,
    ``share`` of its rows shape it, ``cutoff`` is the squared
    distance beyond which a row goes (scaled by the spread of the kept rows,
    never below the ridge's).  Columns of ``docs`` other than those named here
    are ignored.
    """
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    stats = _features(text_statistics(named, ["row", "lang", "source"])).withColumn(
        "salt", F.pmod(F.xxhash64("row", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    stats = written(stats, "statistics")
    fit = stats.where("not base_failed").select(*GROUP, "salt", *FEATURES)
    levels = written(_levels(fit, least_rows), "levels")
    fit = written(_shaping(fit, levels), "shaping")
    est = written(_estimate(fit), "estimate")
    for _ in range(steps):
        cut = written(_with_cut(fit, est, share), "cut")
        near = _with_estimate(fit, cut).where(_bucket() <= F.col("cut"))
        est = written(_estimate(near), "estimate")
    final = _with_cut(fit, est, share).withColumn(
        "scale", F.greatest(F.lit(1.0), F.expm1((F.col("cut") + 1) / 32.0) / F.lit(_chi2(share, len(FEATURES)))))
    named = final.withColumnsRenamed({"g_lang": "by_lang", "g_source": "by_source"})
    judged = _with_estimate(stats, levels.join(named, ["by_lang", "by_source"]).drop("by_lang", "by_source", "by_own", "lang_judges"))
    distance = F.col("d2") / F.col("scale")
    return judged.select(
        "row.*", "n_words", "word_chars", "n_symbols", "n_upper", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"))
