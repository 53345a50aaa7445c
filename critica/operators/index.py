"""Distributed positions in a global order (W2 and friends), without a single-partition window.

``row_index`` numbers rows in a total order, optionally restarting per group:

1. range-partition on (group, order) and sort inside each partition: a hot group spans several partitions,
   so no task ever holds a whole large group;
2. ``monotonically_increasing_id`` gives (partition, position) for free; the frame is written to the shared
   checkpoint folder as a table (sorted columns are small), so both uses below see the same partition ids, also after a lost executor;
3. per (partition, group) counts and first positions, then running sums over the partitions of each group;
4. position = offset of its (partition, group) + position inside it.

Without groups the offsets table has one row per partition (a proven bound), so it is broadcast. With
groups it has about one row per group plus one per partition, and is joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from critica.session import materialized

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | position in partition


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_index(df: DataFrame, order: Sequence, groups: Sequence[str] = (), name: str = "idx", start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = start-based position of each row in ``order`` (restarting per ``groups``).

    ``order`` must be total within a group (add tie-breakers), otherwise positions among ties are arbitrary.
    Rows with a NULL group key form a group of their own. The frame is written once to the checkpoint folder: pass
    narrow rows (keys and order columns) and join wide columns back by key.
    """
    groups = list(groups)
    sort = [F.col(g).asc() for g in groups] + [_col(c) for c in order]
    ranges = [num_partitions] if num_partitions else []  # else adaptive execution sizes them
    ranged = materialized(df.repartitionByRange(*ranges, *sort).sortWithinPartitions(*sort)
                          .withColumn("_mid", F.monotonically_increasing_id()), "row-index")
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = ranged.groupBy(pid.alias("_pid"), *groups).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min(local).alias("_first"))
    before = (Window.partitionBy(*groups) if groups else Window).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *groups, "_first",
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    if not groups:
        offsets = F.broadcast(offsets)  # one row per range partition
    offsets = offsets.select(F.col("_pid").alias("_opid"), *[F.col(g).alias(f"_o_{g}") for g in groups], "_first", "_off")
    same = F.col("_pid") == F.col("_opid")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    out = ranged.withColumn("_pid", pid).join(offsets, same).drop("_opid", *[f"_o_{g}" for g in groups])
    return out.withColumn(name, F.col("_off") + local - F.col("_first") + F.lit(start)) \
              .drop("_mid", "_pid", "_first", "_off")


def dense_index(df: DataFrame, key: str, name: str = "idx", cast_int: bool = True) -> DataFrame:
    """(key, name): 0-based dense rank of each distinct non-NULL key; equals ``dense_rank() - 1`` over key."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    out = row_index(keys, [F.col(key).asc()], name=name)
    if cast_int:
        out = out.withColumn(name, F.col(name).cast("int"))
    return out.select(key, name)
