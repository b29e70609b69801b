"""Global NTILE without a single-partition window.

Two forms: ``tiles_by_selection`` (lazy, no sort, several sorts at once) and
``ntile``, which also gives global positions:

``F.ntile(n).over(Window.orderBy(...))`` has no partition key, so Spark
plans ``Exchange SinglePartition``: one task sorts every row.  This
operator computes the same tiles in parallel:

1. range-partition the rows on the (total) sort order and sort each range;
   checkpoint the result, so the sampled range bounds and the row order are
   fixed once and survive executor loss (lineage is cut in the shared
   ``spark.checkpoint.dir``);
2. count rows per range (one small aggregate, one row per partition) and
   turn the counts into running offsets (a window over those few rows);
3. a row's global zero-based position is its range offset plus its place
   inside the range;
4. NTILE(k) of position i among n rows: with q = n div k, r = n mod k and
   cut = r·(q+1), tile = i div (q+1) + 1 when i < cut, else
   r + (i − cut) div q + 1.

The sort order must be total (append a unique key as ``tie``); tied rows
otherwise get an arbitrary tile, as in any SQL engine.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.session import ensure_checkpoint_dir

#: Ranks at which the sketch of a sort key is read, its accuracy, and the grid steps added to both sides of a position:
#: the sketch errs by one rank in ``SKETCH_ACCURACY``, the margin is twenty times that.
GRID, SKETCH_ACCURACY, MARGIN = 1000, 10_000, 2
_PID, _LOCAL, _OFF, _N = "_nt_pid", "_nt_local", "_nt_off", "_nt_n"


def global_position(df: DataFrame, order: list[Column], out: str = "_pos", partitions: int | None = None,
                    total_col: str | None = None) -> DataFrame:
    """Add ``out`` = zero-based position of each row under ``order`` (and optionally the row total)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # the range sample and the partitioning pass both read the input: keep it
    # for the duration of the checkpoint so an expensive upstream runs once
    # (an evicted block is recomputed; correctness rests on the checkpoint)
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # without an explicit count the range exchange starts from
        # spark.sql.shuffle.partitions and AQE may merge adjacent ranges, which
        # keeps them in order; an explicit count is used as given
        ranged = (src.repartitionByRange(partitions, *order) if partitions else src.repartitionByRange(*order))
        ranged = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    finally:
        src.unpersist()
    pid = F.spark_partition_id()
    # monotonically_increasing_id = partition id << 33 | row number inside the partition
    indexed = (ranged.withColumn(_PID, pid)
               .withColumn(_LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33)))
    counts = ranged.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias("_nt_cnt"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("_nt_cnt").over(before), F.lit(0)).cast("long").alias(_OFF),
        F.sum("_nt_cnt").over(every).cast("long").alias(_N),
    )
    # one row per partition: the broadcast is bounded by the partition count
    joined = indexed.join(F.broadcast(offsets), _PID)
    res = joined.withColumn(out, F.col(_OFF) + F.col(_LOCAL))
    if total_col:
        res = res.withColumnRenamed(_N, total_col)
    return res.drop(_PID, _LOCAL, _OFF, _N)


def tile_of(pos: str, total: str, k: int) -> Column:
    """NTILE(k) from a zero-based position and the row total (both column names)."""
    q = F.expr(f"{total} div {k}")
    r = F.col(total) % k
    cut = r * (q + 1)
    first = F.expr(f"{pos} div ({total} div {k} + 1)") + 1
    rest = r + F.expr(f"({pos} - ({total} % {k}) * ({total} div {k} + 1)) div greatest({total} div {k}, 1)") + 1
    return F.when(F.col(pos) < cut, first).otherwise(rest).cast("int")


def ntile(df: DataFrame, k: int, order: list[Column], out: str, tie: list[Column] | None = None,
          small: bool = False, partitions: int | None = None) -> DataFrame:
    """Add ``out`` = NTILE(k) OVER (ORDER BY order, tie) to every row of ``df``.

    ``small=True`` uses the single-partition window directly (for inputs
    known to be small); the default is the distributed form above.
    """
    keys = list(order) + list(tie or [])
    if small:
        return df.withColumn(out, F.ntile(k).over(Window.orderBy(*keys)))
    pos, total = "_nt_pos", "_nt_total"
    ranked = global_position(df, keys, pos, partitions, total_col=total)
    return ranked.withColumn(out, tile_of(pos, total, k)).drop(pos, total)


def ascending_key(col: Column) -> Column:
    """A whole-number sort key as 64 bits, NULLs first (as ``ORDER BY x`` has them)."""
    return F.coalesce(col.cast("long"), F.lit(-(2**63)))


def descending_key(col: Column) -> Column:
    """The key that sorts ascending as ``ORDER BY x DESC`` would, NULLs last."""
    return F.coalesce(-col.cast("long"), F.lit(2**63 - 1))


def _sketched(rows: DataFrame, group: list[str], *more: Column) -> DataFrame:
    """Per group: ``n`` rows and ``grid``, approximate values of ``x`` at every ``1 / GRID`` of its ranks (a mergeable sketch)."""
    steps = [i / GRID for i in range(1, GRID)]
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("x", steps, SKETCH_ACCURACY).alias("grid"), *more)


def _at_positions(rows: DataFrame, targets: DataFrame, group: list[str], keep: list[str]) -> DataFrame:
    """The exact ``x`` at each target's ``position`` within its group, the target's place among equal ones, and their number.

    ``targets`` has the group, ``n`` and ``grid`` of ``_sketched``, ``position``
    and the columns of ``keep``.  The sketch brackets a position within a few
    hundredths of a percent of the ranks; one aggregation counts what lies below
    the bracket and each value inside it, and a running sum over those few
    values finds the one that holds the position.
    """
    step = F.col("position") * GRID / F.col("n")
    low, high = F.floor(step).cast("int") - 1 - MARGIN, F.ceil(step).cast("int") - 1 + MARGIN
    bracket = targets.select(
        *group, *keep, "position",
        F.when(low >= 0, F.get("grid", low)).otherwise(F.lit(-(2**63))).alias("_low"),
        F.when(high < GRID - 1, F.get("grid", high)).otherwise(F.lit(2**63 - 1)).alias("_high"))
    own = [*dict.fromkeys([*group, *keep])]
    counted = (
        rows.join(F.broadcast(bracket), group)  # one row a cut: sorts x (k - 1)
        .where(F.col("x") <= F.col("_high"))
        .groupBy(*own, "position", F.when(F.col("x") >= F.col("_low"), F.col("x")).alias("v")).agg(F.count(F.lit(1)).alias("ties")))
    upto = F.sum("ties").over(Window.partitionBy(*own).orderBy(F.col("v").asc_nulls_first()))
    below = F.col("_upto") - F.col("ties")
    return (
        counted.withColumn("_upto", upto)
        .where(F.col("v").isNotNull() & (below <= F.col("position")) & (F.col("position") < F.col("_upto")))
        .select(*own, "v", (F.col("position") - below).alias("within"), "ties"))


def _evaluated_once(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` dealt by a hash of the id, for plans that read it several times.

    The condition always holds; as it reads every column and isn't
    deterministic, neither column pruning nor filters change what lies below
    it, so that all readers have one and the same exchange and Spark runs it once.
    """
    return df.repartition(F.xxhash64(id_col)).where(F.xxhash64(*df.columns) % 2 < F.rand(0) + 2)


def tiles_by_selection(df: DataFrame, k: int, sorts: dict[str, Column], id_col: str) -> DataFrame:
    """Add, for each name in ``sorts``, NTILE(k) OVER (ORDER BY its key, ``id_col``) to every row of ``df``.

    ``sorts`` maps output names to 64-bit keys in ascending order (see
    ``ascending_key`` and ``descending_key``); ``id_col`` is a unique whole
    number.  No sort and no window over the rows: a tile follows from comparing
    a row's own (key, id) with the k - 1 keys at which tiles begin.  These are
    found by order-statistic selection, for all sorts at once: a sketch of the
    keys and an exact count around each cut give the key that holds it, and the
    same two steps over the ids of the rows with that key, however many there
    are, give the row.  The plan is lazy, evaluates ``df`` once and broadcasts
    one row a cut.

    Cuts are exact: should a sketch ever miss its own error bound by far, the
    query fails instead of returning other tiles.
    """
    names = list(sorts)
    df = _evaluated_once(df, id_col)
    each = F.array(*[F.struct(F.lit(i).alias("s"), sorts[name].alias("x"), F.col(id_col).cast("long").alias("id")) for i, name in enumerate(names)])
    rows = df.select(F.inline(each))
    sketch = _sketched(rows, ["s"])
    t = F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("t") if k > 1 else F.explode(F.array().cast("array<int>")).alias("t")
    position = (F.expr(f"t * (n div {k})") + F.least("t", F.col("n") % k)).alias("position")
    targets = sketch.select("s", "n", "grid", t).select("*", position).where(F.col("position") < F.col("n"))
    values = _at_positions(rows, targets, ["s"], ["s", "t"])
    tied = (
        rows.join(F.broadcast(values.withColumnRenamed("v", "x")), ["s", "x"])  # one row a cut
        .select("s", "t", F.col("x").alias("v"), F.col("id").alias("x"), "within"))
    inner = _sketched(tied, ["s", "t"], F.max("v").alias("key"), F.max("within").alias("position"))
    rows_at = _at_positions(tied.select("s", "t", "x"), inner, ["s", "t"], ["key"])
    cuts = rows_at.agg(F.collect_list(F.struct("s", "key", F.col("v").alias("id"))).alias("cuts")).scalar()  # sorts x (k - 1) rows
    due = sketch.where(F.col("grid").isNotNull()).agg(F.coalesce(F.sum(F.least(F.lit(k - 1), F.col("n") - 1)), F.lit(0)).alias("due")).scalar()
    with_cuts = df.withColumn("_cuts", cuts).withColumn("_due", due)
    missed = F.raise_error(F.lit("tile cuts not found within the sketch's bounds")).cast("int")
    out = []
    for i, name in enumerate(names):
        key, own = sorts[name], F.col(id_col).cast("long")
        reached = lambda c: (c["s"] == i) & ((c["key"] < key) | ((c["key"] == key) & (c["id"] <= own)))  # noqa: E731, B023
        tile = (F.size(F.filter("_cuts", reached)) + 1).cast("int")
        out.append(F.when(F.size("_cuts") == F.col("_due"), tile).otherwise(missed).alias(name))
    return with_cuts.select(*df.columns, *out)
