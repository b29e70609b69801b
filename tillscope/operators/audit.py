"""Constraint audits (C1–C6): what the warehouse DDL would have enforced.

``audit_star`` counts the violations of all declared rules in one pass over
each table and one shuffle, as a lazy ``(table, rule, columns, violations)``;
``check_predicate`` counts one predicate over any frame.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.sources.schema import RULES, SCHEMAS
from tillscope.sources.star import Star

AUDIT_SCHEMA = "table string, rule string, columns string, violations bigint"


def _rows(df: DataFrame, table: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate pass over ``df`` evaluating many counting expressions, unpivoted to rows."""
    if not checks:
        return df.sparkSession.createDataFrame([], AUDIT_SCHEMA)
    agg = df.agg(*[expr.cast("long").alias(f"_c{i}") for i, (_, _, expr) in enumerate(checks)])
    rows = [F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.lit(cols).alias("columns"),
                     F.col(f"_c{i}").alias("violations")) for i, (rule, cols, _) in enumerate(checks)]
    return agg.select(F.inline(F.array(*rows)))


def check_predicate(df: DataFrame, table: str, name: str, predicate: str) -> DataFrame:
    """C4: rows where a CHECK predicate is FALSE (NULL passes, as in SQL)."""
    return _rows(df, table, [(f"check:{name}", predicate, F.count_if(~F.expr(predicate)))])


def _domain_conditions(df: DataFrame, table: str, max_length: dict[str, int]) -> list[tuple[str, str, Column]]:
    """Varchar lengths, and values that their declared decimal type cannot hold.

    The second kind is for tables as delivered (text or wider numbers); a
    column that already has its declared type cannot fail it.
    """
    checks = [(f"max_length:{n}", c, F.length(F.col(c)) > n) for c, n in max_length.items() if c in df.columns]
    for f in SCHEMAS[table].fields:
        if isinstance(f.dataType, T.DecimalType) and f.name in df.columns:
            fits = F.col(f.name).try_cast(f.dataType)
            checks.append((f"decimal:{f.dataType.simpleString()}", f.name, F.col(f.name).isNotNull() & fits.isNull()))
    return checks


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill NULLs of defaulted columns (TRUE, 0, NOW()) with their declared default."""
    rules = RULES[table]
    schema = {f.name: f.dataType for f in SCHEMAS[table].fields}
    out = df
    for c, value in rules.defaults:
        if c not in out.columns:
            continue
        default = F.current_timestamp().cast("timestamp_ntz") if value == "now" else F.lit(value)
        out = out.withColumn(c, F.coalesce(F.col(c), default.cast(schema[c])))
    return out


@dataclass(frozen=True)
class _Space:
    """The values of one key: ``table`` holds it, ``rule`` says it is unique (None: not), ``children`` refer to it."""

    table: str
    columns: tuple[str, ...]
    rule: int | None
    children: list[tuple[int, str, str]]  # rule, table, column


def _single_checks(star: Star, table: str) -> list[tuple[str, str, Column]]:
    """(rule, columns, violated) for the rules that one row breaks on its own."""
    rules, df = RULES[table], star.table(table)
    counted = [("not_null", c, F.col(c).isNull()) for c in rules.not_null if c in df.columns]
    counted += _domain_conditions(df, table, dict(rules.max_length))
    return counted + [(f"check:{name}", pred, ~F.expr(pred)) for name, pred in rules.checks]


def _key(columns: tuple[str, ...], types: list | None = None) -> Column:
    """The key as text, NULL if one of its columns is (SQL keys ignore those)."""
    cols = [F.col(c) if types is None else F.col(c).cast(t) for c, t in zip(columns, types or columns, strict=True)]
    if len(cols) == 1:
        return cols[0].cast("string")
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.to_json(F.struct(*cols)))


def audit_star(star: Star, tables: Iterable[str] = tuple(RULES)) -> DataFrame:
    """C1–C5 over the given tables: one row per (table, rule, columns) with its violation count.

    One pass over each table and one shuffle for all rules.  A row hands on its
    primary and unique keys, the keys it refers to, and the numbers of the rules
    it breaks on its own.  Counted by (key space, value), combined before they
    move, a value shows how often its table holds it and how often each child
    table refers to it: more than one holder breaks uniqueness, references
    without a holder break the foreign key (NULLs pass, as in SQL).
    """
    tables = list(tables)
    named: list[tuple[str, str, str]] = []  # the output's rows, in order
    singles: dict[str, list[tuple[int, Column]]] = {t: [] for t in tables}
    spaces: dict[tuple[str, tuple[str, ...]], _Space] = {}

    def rule(table: str, kind: str, columns: str) -> int:
        named.append((table, kind, columns))
        return len(named) - 1

    for t in tables:
        for kind, columns, violated in _single_checks(star, t):
            singles[t].append((rule(t, kind, columns), violated))
        for kind, columns in [("primary_key", RULES[t].primary_key), *(("unique", u) for u in RULES[t].unique)]:
            spaces[t, tuple(columns)] = _Space(t, tuple(columns), rule(t, kind, ",".join(columns)), [])
    for t in tables:
        for column, parent, key in RULES[t].foreign_keys:
            space = spaces.setdefault((parent, (key,)), _Space(parent, (key,), None, []))
            space.children.append((rule(t, "foreign_key", column), t, column))

    numbered = list(enumerate(spaces.values()))
    most = max((len(s.children) for _, s in numbered), default=0)
    emitted = []
    for t in dict.fromkeys([*tables, *(s.table for _, s in numbered)]):
        df = star.table(t)
        out = [(F.lit(no), _key(s.columns), 0) for no, s in numbered if s.table == t]
        for no, s in numbered:
            types = [star.table(s.table).schema[c].dataType for c in s.columns]
            out += [(F.lit(no), _key((column,), types), i) for i, (_, child, column) in enumerate(s.children, 1) if child == t]
        rows = [F.when(key.isNotNull(), F.struct(no.alias("space"), key.alias("key"), F.lit(role).alias("role"))) for no, key, role in out]
        rows += [F.when(violated, F.struct(F.lit(-1 - no).alias("space"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("role")))
                 for no, violated in singles.get(t, [])]
        emitted.append(df.select(F.inline(F.array_compact(F.array(*rows)))))
    held, refers = F.col("n0"), [F.col(f"n{i}") for i in range(1, most + 1)]
    counts = reduce(DataFrame.unionByName, emitted).groupBy("space", "key").agg(
        *[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(most + 1)])
    found = [F.when(F.col("space") < 0, _finding(-1 - F.col("space"), held))]
    for no, s in numbered:
        here = F.col("space") == no
        if s.rule is not None:
            found.append(F.when(here & (held > 1), _finding(F.lit(s.rule), held)))
        found += [F.when(here & (held == 0) & (refers[i] > 0), _finding(F.lit(c[0]), refers[i])) for i, c in enumerate(s.children)]
    spark = counts.sparkSession
    zero = spark.range(len(named)).select(F.col("id").cast("int").alias("no"), F.lit(0).cast("long").alias("n"))
    total = counts.select(F.inline(F.array_compact(F.array(*found)))).unionByName(zero).groupBy("no").agg(F.sum("n").alias("violations"))
    names = F.array(*[F.struct(F.lit(a).alias("table"), F.lit(b).alias("rule"), F.lit(c).alias("columns")) for a, b, c in named])
    return total.select(F.get(names, F.col("no")).alias("r"), "violations").select("r.table", "r.rule", "r.columns", "violations")


def _finding(rule: Column, n: Column) -> Column:
    return F.struct(rule.cast("int").alias("no"), n.alias("n"))
