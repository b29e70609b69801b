"""Secret scans with an incremental blob ledger.

Every version of every text is addressed by the SHA-256 of its content.  The
ledger has one row per blob and scan: which rule versions (``kind@version``)
were applied and what they found.  A scan subtracts the ledger from (distinct
blobs x current rules), fetches one text for each blob that has something left
to do, scans it with those rules only, and joins findings back to all paths
that hold the blob.  Adding or changing one rule rescans with that rule alone;
a new copy of a known text costs one digest.

Only (path, digest) rows and one text per unseen blob move.  Digests are
counted map-side before the shuffle, so a blob with a third of all rows is a
row per task; findings are repeated over ``salts`` salts when they are joined
to the paths, so its paths spread over as many tasks.

Span positions come from splitting a text at a pattern: piece and match
lengths, summed along the text, give the starts (code points, end exclusive).
Everything is DataFrame code.

Defined cases: a null text is the empty text and has no finding; a null path
stays null; repeated rows are answered each; empty tables give no rows; spans
of different kinds may overlap, those of one kind never do.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import written


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int = 0  #: whose length counts
    least: int = 1  #: shorter matches are dropped
    needs: str = ""  #: a literal that each match holds, to skip most texts cheaply

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


#: Base kinds, in the order in which spans with one start are listed; then the others.
BASE_RULES = [
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),  # maximal runs, so the same as longer matches of [0-9a-f]+
]
MORE_RULES = [
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, "eyJ"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, "gh"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, "xox"),
]
RULES = BASE_RULES + MORE_RULES

FINDING = "struct<start:int,order:int,end:int,kind:string,version:int>"
LEDGER = f"blob binary, scanned array<string>, findings array<{FINDING}>"


def address(text: Column) -> Column:
    """The blob of a text: its SHA-256, null counting as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _hits(rule: Rule) -> Column:
    """Piece, match and group lengths of the rule's matches in ``text``; null without any."""
    pattern = F.lit(rule.pattern)
    due = F.array_contains("todo", F.lit(rule.tag))
    if rule.needs:
        due = due & F.contains("text", F.lit(rule.needs))
    lengths = F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.group).alias("group_no"),
        F.transform(F.split("text", rule.pattern, -1), F.length).alias("pieces"),
        F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.length).alias("matches"),
        F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.length).alias("groups"),
    )
    return F.when(due & F.rlike("text", pattern), lengths)


def find_spans(blobs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(blob, findings) for blobs with any; ``blobs`` has ``blob``, ``text`` and ``todo`` (rule tags to apply)."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(RULES + [r for r in rules if r not in RULES]) for x in (r.kind, i)])
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.least)])
    # explode_outer: no filter on the array is inferred, which would run every pattern twice
    hits = (
        blobs.select("blob", F.explode_outer(F.array(*[_hits(r) for r in rules])).alias("hit"))
        .where("hit is not null")
        .select("blob", "hit.kind", "hit.version", F.posexplode(F.arrays_zip("hit.pieces", "hit.matches", "hit.groups")))
        .select("blob", "kind", "version", "pos", "col.pieces", "col.matches", "col.groups")
        .repartition("blob", "kind").dropDuplicates(["blob", "kind", "pos"])  # a row repeated whole comes twice
    )
    along = Window.partitionBy("blob", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("pieces") + F.coalesce("matches", F.lit(0))).over(along).cast("int")
    return (
        hits.withColumn("end", end)
        .where(F.col("matches").isNotNull() & (F.col("groups") >= least[F.col("kind")]))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_list(F.struct(
            (F.col("end") - F.col("matches")).alias("start"), order[F.col("kind")].alias("order"), "end", "kind", "version",
        ).cast(FINDING))).alias("findings"))
    )


def scan(
    versions: DataFrame, ledger: DataFrame | None = None, rules: list[Rule] | None = None,
    path_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(paths with their blob, new ledger rows for whatever ``ledger`` lacks).

    Both are written to the shared folder.  Append the second to the ledger
    and pass it to ``findings_of`` with the first.
    """
    rules = rules if rules is not None else RULES
    tags = F.array(*[F.lit(r.tag) for r in rules])
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", address(F.col("text"))).withColumn("pick", F.xxhash64("path"))
    paths = written(rows.select("path", "blob", "pick"), "paths")
    todo = paths.groupBy("blob").agg(F.min("pick").alias("pick"))
    if ledger is None:
        todo = todo.withColumn("todo", tags)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
        todo = todo.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(tags, F.coalesce("seen", F.array().cast("array<string>"))))
    pending = todo.where(F.size("todo") > 0).select("blob", "pick", "todo")
    texts = rows.join(pending.hint("shuffle_hash"), ["blob", "pick"])  # hash side: digests only
    found = find_spans(texts.where("text <> ''").select("blob", "text", "todo"), rules)
    fresh = pending.join(found, "blob", "left").select(
        "blob", F.col("todo").alias("scanned"), F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings"))
    return paths.select("path", "blob"), written(fresh, "ledger")


def findings_of(paths: DataFrame, ledger: DataFrame, rules: list[Rule] | None = None, salts: int = 16) -> DataFrame:
    """``path``, ``blob`` and ``findings`` (sorted by start, then rule order) of the current rules for every path."""
    rules = rules if rules is not None else RULES
    current = F.array(*[F.lit(r.tag) for r in rules])
    by_blob = (
        ledger.select("blob", F.explode("findings").alias("f"))
        .where(F.array_contains(current, F.concat_ws("@", "f.kind", "f.version")))
        .groupBy("blob").agg(F.array_sort(F.collect_set("f")).alias("findings"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = paths.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(salts)).cast("int"))
    none = F.array().cast(f"array<{FINDING}>")
    return salted.join(by_blob, ["blob", "salt"], "left").select(
        "path", "blob", F.coalesce("findings", none).alias("findings"))


def spans_text(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def of_kinds(findings: Column, kinds: list[str]) -> Column:
    return F.filter(findings, lambda f: f["kind"].isin(*kinds))


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every finding replaced by ``mark``; overlapping findings become one mark."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    folded = F.aggregate(
        findings, start,
        lambda acc, f: F.when(f["end"] <= acc["at"], acc).otherwise(F.struct(
            f["end"].alias("at"),
            F.concat(acc["parts"], F.when(
                f["start"] >= acc["at"],
                F.array(F.substring(text, acc["at"] + 1, f["start"] - acc["at"]), F.lit(mark)),
            ).otherwise(F.array().cast("array<string>"))).alias("parts"),
        )),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(findings) == 0, text).otherwise(folded)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``path``, ``blob`` and ``findings`` of every row, starting from an empty ledger."""
    paths, ledger = scan(docs, None, RULES, id_col, text_col)
    return findings_of(paths, ledger)

