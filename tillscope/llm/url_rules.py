"""URL allow and block rules as a sort-merge range join.

A rule ``host/path`` covers its host and all subdomains where the url's path
starts with the rule's path; the longest rule wins.  Reversing the host labels
gives each rule a canonical key (``example.org`` + ``/es/`` becomes
``org.example/es/``), and the rules below one host turn into nested intervals
[key, key + 0xFF).  A url meets the rules of each of its ancestor hosts (only
those depths that occur among the rules), so it gets one probe key per depth.

The sweep sorts rule starts, rule ends and probes by key.  After a start the
innermost active rule is that rule, after an end it is the enclosing one (its
parent, found beforehand by joining every proper prefix of a rule's path), so
the top of the stack at a probe is the last event before it: a running
``last`` over the sorted rows.  Sweeps run per (ancestor host, salt): a host
with a third of all rows is dealt over ``salts`` sweeps, each of which gets
the few events of that host.  Everything is DataFrame code.

Defined cases: a null url, or one without ``://``, has an empty host and path
and meets no rule; two rules with one key count once, ``block`` winning; null
rule parts never match; repeated rows are judged one by one; an empty rule
table or an empty url table gives default verdicts or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import lower_ascii, shuffle_partitions

STATE = "struct<rule:string,verdict:string,size:int>"


def host_of(url: Column) -> Column:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _rule_events(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Start and end events of each rule, and the label depths of the rule hosts."""
    base = (
        rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.array_join(_reversed_labels(F.col("host")), ".").alias("rev"),
            F.size(_reversed_labels(F.col("host"))).alias("depth"),
            "path",
            F.struct(
                F.concat("host", "path").alias("rule"), "verdict", F.length(F.concat("host", "path")).alias("size")
            ).cast(STATE).alias("state"),
        )
    )
    prefixes = base.select(
        "rev", "path", F.explode(F.expr("transform(sequence(0, length(path)), k -> left(path, k))")).alias("prefix")
    ).where("length(prefix) < length(path)")
    outer = base.select("rev", F.col("path").alias("prefix"), F.col("state").alias("outer_state"))
    parents = (
        prefixes.join(outer, ["rev", "prefix"])
        .groupBy("rev", "path")
        .agg(F.max_by("outer_state", F.length("prefix")).alias("parent"))
    )
    none = F.struct(F.lit(None).alias("rule"), F.lit(None).alias("verdict"), F.lit(0).alias("size")).cast(STATE)
    key = F.concat("rev", "path").cast("binary")
    starts = base.select("rev", key.alias("key"), "state")
    ends = base.join(parents, ["rev", "path"], "left").select(
        "rev", F.concat(key, F.unhex(F.lit("FF"))).alias("key"), F.coalesce("parent", none).alias("state")
    )
    return starts.unionByName(ends), base.select("depth").distinct()


def judge_urls(
    urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", salts: int | None = None
) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has ``host``, ``path``, ``verdict``.  ``salts`` is the number of
    sweeps a host's rows are dealt over (default: 4 per shuffle partition, 256
    at least); every rule event is repeated that often.  Columns of ``urls``
    named like the four results are replaced.
    """
    spark = urls.sparkSession
    salts = salts or max(256, 4 * shuffle_partitions(spark))
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    events, depths = _rule_events(rules)
    depth_list = depths.agg(F.array_sort(F.collect_set("depth"))).scalar()  # a few ints: the label depths of rule hosts

    rows = urls.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        host_of(F.col(f"`{url_col}`")).alias("host"),
        path_of(F.col(f"`{url_col}`")).alias("path"),
    ).withColumn("row_id", F.monotonically_increasing_id())
    probes = (
        rows.withColumn("depths", depth_list)
        .withColumn("labels", _reversed_labels(F.col("host")))
        .withColumn("at", F.explode_outer(F.expr("filter(depths, d -> d <= size(labels))")))
        .withColumn("rev", F.expr("array_join(slice(labels, 1, at), '.')"))
        .select(
            "row", "host", "path", "row_id", "rev",
            F.concat("rev", "path").cast("binary").alias("key"),
            F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int").alias("salt"),
            F.lit(1).alias("kind"),
            F.lit(None).cast(STATE).alias("state"),
        )
    )
    dealt = events.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("kind", F.lit(0))
    sweep = Window.partitionBy("rev", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        probes.unionByName(dealt, allowMissingColumns=True)
        .withColumn("top", F.last("state", ignorenulls=True).over(sweep))
        .where("kind = 1")
    )
    judged = swept.groupBy("row_id").agg(
        F.first("row").alias("row"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max_by("top", F.coalesce(F.col("top.size"), F.lit(0))).alias("best"),
    )
    return judged.select(
        "row.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
