"""Distributed global positions (WN8) and exact quantiles (MO1 edges, AG2/AG6/AG11 medians).

Neither operator sorts the whole input in one task or buffers a whole group.

``with_global_position``:

1. the input is range-partitioned on the ordering key (Spark samples the key
   to pick balanced bounds), so partition ``p`` holds a contiguous key range;
   that partitioned frame is checkpointed lazily so every consumer sees the
   same bounds;
2. a running count is computed *inside* each partition (window on the
   partition id, bounded by the partition size);
3. per-partition totals (one row per partition, a table whose size is the
   partition count, a parameter) give each partition its starting offset.

``exact_quantiles`` needs no sort of the input, no range exchange and no
checkpoint. A mergeable sketch brackets each wanted rank between two values; a
second hash aggregate counts the values inside the brackets one by one and all
others per gap between brackets (map-side combined, so a value repeated a
billion times is one row with a count). Only that table, about ``4 n / accuracy``
distinct values per probability, is ordered. Results equal DuckDB
``quantile_cont`` / pandas ``quantile`` (linear interpolation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.numeric import clean_double
from aerolith.session import ensure_checkpoint_dir


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))


def with_global_position(df: DataFrame, order: list[Column | str], weight: str | None = None,
                         partitions: int | None = None, pos_col: str = "_pos") -> DataFrame:
    """Add ``pos_col``: 0-based start position of each row in the total order ``order``.

    With ``weight`` each row stands for ``weight`` consecutive positions
    (``[pos, pos + weight)``). Ties are broken arbitrarily but consistently.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    ranged = (df.repartitionByRange(_partitions(df, partitions), *order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_w", w))
    # Both branches below (running counts and per-partition sizes) must see
    # the *same* range partitioning. Column pruning gives them different
    # subtrees, so Spark would plan two range exchanges with independently
    # sampled bounds. A reliable lazy checkpoint (in spark.checkpoint.dir)
    # freezes one RDD: one shuffle, and recomputation after executor loss
    # reuses the same partitioner.
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=False)
    local = ranged.withColumn(
        "_local_end",
        F.sum("_w").over(Window.partitionBy("_pid").orderBy(*order_cols)
                         .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sizes = ranged.groupBy("_pid").agg(F.sum("_w").alias("_size"))
    # one row per range partition: a table bounded by the partition count
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_size").over(Window.orderBy("_pid")
                                       .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    out = local.join(F.broadcast(offsets), "_pid")
    return out.withColumn(pos_col, F.col("_offset") + F.col("_local_end") - F.col("_w")) \
        .drop("_pid", "_offset", "_local_end", "_w")


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probs: list[float],
                    accuracy: int = 10000, bounded_groups: bool = False) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group.

    Returns one row per group: ``groups``..., ``n`` (non-null values) and
    ``quantiles`` (array of doubles aligned with ``probs``). NULL/NaN values
    and NULL groups are ignored; a group without values yields no row.

    ``accuracy`` sets the width of the brackets, never the result.
    ``bounded_groups`` says that the number of groups is bounded by the
    schema or a small dimension, so the brackets may be broadcast.
    """
    groups = list(groups)
    vals = df.select(*groups, clean_double(value).alias("_v")).filter(F.col("_v").isNotNull())
    doubles = lambda xs: "array(" + ", ".join(f"{float(x)!r}D" for x in xs) + ")"
    # pass 1: one sketch per group gives for each probability two values around the wanted rank;
    # its rank error is n / accuracy, so twice that on either side is safe once n is well above accuracy
    points = [min(max(p + d, 0.0), 1.0) for p in map(float, probs) for d in (-2.0 / accuracy, 2.0 / accuracy)]
    sketch = vals.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", points, accuracy).alias("_q"))
    whole = f"n <= {4 * accuracy}"   # rounded ranks weigh too much in small groups: keep all their values
    brackets = sketch.select(*groups, "n", F.expr(f"""transform(sequence(0, {len(probs) - 1}), i -> struct(
        IF({whole} OR {doubles(points)}[2 * i] <= 0D, _min, _q[2 * i]) AS lo,
        IF({whole} OR {doubles(points)}[2 * i + 1] >= 1D, _max, _q[2 * i + 1]) AS hi))""").alias("_b"))
    # pass 2: a value inside a bracket stands for itself; all values between two brackets stand for
    # one row of the gap, placed right after the end of the bracket below
    if groups:
        placed = vals.join(F.broadcast(brackets) if bounded_groups else brackets, groups)
    else:
        placed = vals.withColumn("_s", brackets.select(F.struct("n", "_b")).scalar()).select("_v", "_s.n", "_s._b")
    below = "aggregate(_b, double('-Infinity'), (a, b) -> IF(b.hi < _v, greatest(a, b.hi), a))"
    counted = placed.withColumn("_gap", F.expr("NOT exists(_b, b -> _v BETWEEN b.lo AND b.hi)")) \
        .withColumn("_v", F.expr(f"IF(_gap, {below}, _v)")) \
        .groupBy(*groups, "n", "_v", "_gap").agg(F.count(F.lit(1)).alias("_c"))
    end = F.sum("_c").over(Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_v", "_gap")
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("_r1", end - 1).withColumn("_r0", F.expr("_r1 - _c + 1"))
    # the rows that hold the floor or ceil rank of a point: at most two per probability and group
    held = ranked.filter(F.expr(f"""exists({doubles(probs)}, p -> floor(p * (n - 1)) BETWEEN _r0 AND _r1
        OR ceil(p * (n - 1)) BETWEEN _r0 AND _r1)"""))
    points_of = held.groupBy(*groups, "n").agg(F.collect_list(F.expr(
        "struct(_r0, _r1, IF(_gap, raise_error('quantile outside its bracket'), _v) AS v)")).alias("_h"))
    at = lambda f: f"element_at(filter(_h, x -> {f}(p * (n - 1)) BETWEEN x._r0 AND x._r1), 1).v"
    return points_of.select(*groups, "n", F.expr(f"""transform({doubles(probs)}, p ->
        {at('floor')} + ({at('ceil')} - {at('floor')}) * (p * (n - 1) - floor(p * (n - 1))))""").alias("quantiles"))


def approx_quantiles(df: DataFrame, groups: list[str], value: str, probs: list[float],
                     accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles per group, same output shape as ``exact_quantiles``.

    One hash aggregate with Spark's mergeable ``percentile_approx`` sketch:
    each task builds a partial sketch per group and the sketches are merged
    after the shuffle, so a hot group costs one sketch per task and no range
    partitioning is needed. The rank error is at most ``n / accuracy`` (the
    returned values are data values, not interpolated). Use it when exact
    order statistics are not required.
    """
    groups = list(groups)
    v = clean_double(value)
    vals = df.select(*groups, v.alias("_v")).filter(F.col("_v").isNotNull())
    g = vals.groupBy(*groups) if groups else vals.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n"),
                 F.percentile_approx("_v", [float(p) for p in probs], accuracy).alias("quantiles"))


def quantiles(df: DataFrame, groups: list[str], value: str, probs: list[float],
              accuracy: int | None = None, bounded_groups: bool = False) -> DataFrame:
    """Exact quantiles by default; ``accuracy`` switches to the approximate sketch."""
    if accuracy:
        return approx_quantiles(df, groups, value, probs, accuracy)
    return exact_quantiles(df, groups, value, probs, bounded_groups=bounded_groups)


def median(df: DataFrame, groups: list[str], value: str, accuracy: int | None = None) -> DataFrame:
    """Median per group as a column ``median`` (exact unless ``accuracy`` is given)."""
    return quantiles(df, groups, value, [0.5], accuracy).select(*groups, F.col("quantiles")[0].alias("median"))
