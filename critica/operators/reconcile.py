"""Multiset difference of two loads (K4, Q1): which rows were added, removed, changed or repeated.

Rows are compared as multisets, nulls equal to nulls. Both loads are first reduced to (128-bit row hash, count), so whole
rows are shuffled only where counts differ; those are then grouped by their values. The work of an unchanged load is one
narrow aggregate, whatever the width of its rows, and a row that repeats very often is one count per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critica.session import materialized

KINDS = ("added", "removed", "changed", "repeated")


def row_hash(columns: Sequence[str]):
    """Two 64-bit hashes of a row that tell nulls from values and column from column."""
    marked = [F.struct(F.col(c).isNull().alias("null"), F.col(c).alias("value")) for c in columns]
    return F.struct(F.xxhash64(F.lit(1), *marked).alias("h1"), F.xxhash64(F.lit(2), *reversed(marked)).alias("h2"))


def load_difference(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(columns, n_before, n_after, kind) of every row whose number differs between the loads.

    ``kind``: *repeated* if the row is in both; with ``keys``, *changed* if its key is in both loads, else *added* or
    *removed*. Without keys a row that is in one load only is added or removed. ``after`` may order its columns
    differently but must have the same ones.
    """
    columns = before.columns
    if sorted(columns) != sorted(after.columns):
        raise ValueError("the loads have different columns")
    after = after.select([F.col(c).cast(before.schema[c].dataType).alias(c) for c in columns])
    both = before.withColumn("side__", F.lit(0)).unionByName(after.withColumn("side__", F.lit(1)))
    number = [F.count_if(F.col("side__") == i).alias(n) for i, n in enumerate(("n_before", "n_after"))]
    hashed = both.withColumn("h__", row_hash(columns))
    differ = materialized(hashed.groupBy("h__").agg(*number).where("n_before <> n_after").select("h__"), "differing")
    rows = hashed.join(differ, "h__", "left_semi").groupBy(*columns).agg(*number)
    kind = F.when((F.col("n_before") > 0) & (F.col("n_after") > 0), "repeated")
    if not keys:
        return rows.withColumn("kind", kind.when(F.col("n_before") > 0, "removed").otherwise("added"))
    # loads that hold the keys of differing rows, in any row
    rows = materialized(rows, "differing-rows")
    names = [f"k{i}__" for i in range(len(keys))]
    touched = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    held = (both.select(*keys, "side__").join(touched, same, "left_semi").groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
            .agg(F.count_distinct("side__").alias("loads__")))
    return (rows.join(held, same).withColumn("kind", kind.when(F.col("loads__") == 2, "changed")
                                             .when(F.col("n_before") > 0, "removed").otherwise("added"))
            .select(*columns, "n_before", "n_after", "kind"))
