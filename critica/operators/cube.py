"""Several levels of aggregation in one pass (grouping sets) and sketches that merge over any range of days.

The cube is computed from the finest groups, not from rows: counts, sums and maxima of the finest level merge into every
coarser one, so rows are shuffled once and each set only costs its share of finest groups.

Sketches per day - HyperLogLog for distinct users, KLL for quantiles of play time - are columns of a small table. Merging
them gives any range of days without reading reviews again, with the sketches' own error bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def review_cube(reviews: DataFrame, sets: Sequence[Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """(keys, level, n_reviews, n_up, max_votes) per grouping set; ``level`` is the grouping id over ``keys``: a bit is 1
    where the key is rolled up, the first key's bit being the highest. Rolled-up keys are null."""
    finest = reviews.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("voted_up")).alias("up"),
                                        F.max("votes_up").alias("votes"))
    return (finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(k) for k in keys])
            .agg(F.grouping_id().cast("bigint").alias("level"), F.sum("n").alias("n_reviews"), F.sum("up").alias("n_up"),
                 F.max("votes").alias("max_votes")))


LG_K = 14  # HyperLogLog: about 0.8 % standard error
KLL_K = 400  # KLL: about 0.7 % rank error


def day_sketches(reviews: DataFrame) -> DataFrame:
    """(dt, n, users, minutes): one sketch of distinct users and one of play minutes per day."""
    return reviews.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.col("steamid"), F.lit(LG_K)).alias("users"),
        F.kll_sketch_agg_bigint(F.col("playtime_at_review"), F.lit(KLL_K)).alias("minutes"))


def merged_sketches(sketches: DataFrame, group) -> DataFrame:
    """(period, n, n_users, minutes) with the sketches of a period's days merged; ``n_users`` is an estimate."""
    return sketches.groupBy(group.alias("period")).agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n_users"),
        F.kll_merge_agg_bigint("minutes").alias("minutes"))


def quantiles(merged: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.9)) -> DataFrame:
    """The merged sketches with one column q<percent> per share."""
    return merged.select("period", "n", "n_users", *[
        F.kll_sketch_get_quantile_bigint(F.col("minutes"), F.lit(float(s))).alias(f"q{round(100 * s)}") for s in shares])
