"""Joins in time: as-of (newest value at or before a time) and points in intervals, both safe for hot keys.

``asof_join`` sorts both sides together by (keys, time) over range partitions, so a hot key spans many tasks. Inside a
partition a row takes the last value above it; a key that goes on from an earlier partition takes the value carried over
the edge. At most one key goes over each edge, so what is carried is a table of one row per partition.

``interval_join`` cuts time into cells and every interval into dyadic nodes (cells, pairs of cells, fours, ...), at most
two of each size, and gives every point its node of each size in use. A point lies in exactly one node of an interval's
cover, so an equi-join on (keys, size, node) meets every pair once, whether intervals last a second or ten years; the
exact bounds are tested afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from critica.session import materialized

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | position in partition


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], within: Column | None = None) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the newest row of ``right`` of equal keys at or before its time.

    Both sides hold the columns ``on``; ``values`` must not be columns of ``left``. Times are of one orderable type. Rows
    without such a value, with a null key or a null time get nulls; of right rows with equal keys and time the one with
    the greatest values counts. ``within`` may reject a value that is too old: a condition on the columns of ``left`` and
    on ``values`` and ``right_time`` (available as ``asof_time``). The rows are written once to the checkpoint folder:
    pass the columns that are needed.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    on = list(on)
    value = F.struct(F.col(right_time).alias("asof_time"), *values)
    usable = F.lit(True)
    for k in (*on, right_time):
        usable = usable & F.col(k).isNotNull()
    rows = left.select(*[F.col(k).alias(f"k{i}__") for i, k in enumerate(on)], F.col(left_time).alias("t__"),
                       F.lit(1).alias("side__"), F.struct(*left.columns).alias("row__"))
    known = right.where(usable).select(*[F.col(k).alias(f"k{i}__") for i, k in enumerate(on)], F.col(right_time).alias("t__"),
                                       F.lit(0).alias("side__"), value.alias("value__"))
    keys = [f"k{i}__" for i in range(len(on))]
    both = rows.unionByName(known, allowMissingColumns=True)
    sort = [*keys, "t__", "side__", "value__"]  # at equal times values come first
    ranged = materialized(both.repartitionByRange(*sort).sortWithinPartitions(*sort)
                          .withColumn("at__", F.monotonically_increasing_id()), "asof") \
        .withColumn("part__", F.shiftright("at__", _LOCAL_BITS))
    above = Window.partitionBy("part__", *keys).orderBy("at__").rowsBetween(Window.unboundedPreceding, 0)
    filled = ranged.withColumn("found__", F.last("value__", ignorenulls=True).over(above)).where("side__ = 1")
    # what each partition leaves behind per key, and what the partitions before it left for its keys
    left_behind = ranged.groupBy("part__", *keys).agg(
        F.max_by("value__", F.when(F.col("side__") == 0, F.col("at__"))).alias("last__"))
    before = Window.partitionBy(*keys).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    carried = (left_behind.withColumn("carried__", F.last("last__", ignorenulls=True).over(before))
               .where(F.col("carried__").isNotNull())
               .select(F.col("part__").alias("c_part__"), *[F.col(k).alias(f"c_{k}") for k in keys], "carried__"))
    same = F.col("part__") == F.col("c_part__")
    for k in keys:
        same = same & (F.col(k) == F.col(f"c_{k}"))
    joined = filled.join(F.broadcast(carried), same, "left")  # one row per range partition at most
    out = joined.select("row__.*", F.coalesce("found__", "carried__").alias("v__"), F.col("t__").isNull().alias("no_time__"))
    asof_time = F.when(~F.col("no_time__"), F.col("v__.asof_time")).alias("asof_time")
    out = out.select(*left.columns, asof_time, *[F.when(~F.col("no_time__"), F.col(f"v__.{c}")).alias(c) for c in values])
    if within is not None:
        out = out.select(*left.columns, *[F.when(within, F.col(c)).alias(c) for c in ("asof_time", *values)])
    return out.select(*left.columns, *values)


def dyadic_cover(first: Column, beyond: Column) -> Column:
    """Disjoint dyadic nodes (level, node) that cover the cells [first, beyond): at most two per level."""
    def nodes(k):
        low = -F.call_function("shiftright", -first, k)  # rounded up
        high = F.call_function("shiftright", beyond, k)
        some = low < high
        level = k.cast("int").alias("level")
        return F.array(F.when(some & (F.pmod(low, F.lit(2)) == 1), F.struct(level, low.alias("node"))),
                       F.when(some & (F.pmod(high, F.lit(2)) == 1), F.struct(level, (high - 1).alias("node"))))

    top = F.greatest(F.length(F.bin(F.greatest(beyond - first, F.lit(1)))), F.lit(1))
    found = F.flatten(F.transform(F.sequence(F.lit(0), top.cast("int")), nodes))
    return F.filter(found, lambda x: x.isNotNull())


def interval_join(points: DataFrame, spans: DataFrame, on: Sequence[str], time: str, start: str, end: str,
                  cell: int) -> DataFrame:
    """Pairs of rows of ``points`` and ``spans`` with equal keys and start <= time < end.

    Times are integers (for timestamps: ``unix_micros``); ``cell`` is the width of a cell in the same unit, about the
    least span that is common. The spans are written once to the shared folder: pass the columns that are needed. The keys come once; no other column name may be on both sides. Null keys and times and
    empty spans match nothing.
    """
    on = list(on)
    clash = (set(points.columns) & set(spans.columns)) - set(on)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")

    def cell_of(c):
        t, width = c.cast("bigint"), F.lit(cell).cast("bigint")
        return F.call_function("div", t - F.pmod(t, width), width)  # rounded down, in whole numbers

    real = materialized(spans.where(F.col(start) < F.col(end)), "spans")  # read for its levels and for the join
    covered = real.withColumn("n__", F.explode(dyadic_cover(cell_of(F.col(start)), cell_of(F.col(end) - 1) + 1))) \
        .select("*", F.col("n__.level").alias("level__"), F.col("n__.node").alias("node__")).drop("n__")
    levels = sorted(r[0] for r in covered.select("level__").distinct().collect())  # at most 64 numbers
    at = cell_of(F.col(time))
    dealt = points.where(F.col(time).isNotNull()).withColumn("level__", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))) \
        .withColumn("node__", F.call_function("shiftright", at, F.col("level__")))
    met = dealt.join(covered, [*on, "level__", "node__"])
    return met.where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("level__", "node__")
