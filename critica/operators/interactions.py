"""Implicit ratings and the user-item interaction matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critica.functions import features as fx


def with_rating(reviews: DataFrame, name: str = "implicit_rating") -> DataFrame:
    return reviews.withColumn(name, fx.implicit_rating("voted_up", "playtime_at_review"))


def interaction_matrix(reviews: DataFrame, keys: Sequence[str] = ("steamid", "appid", "dt"),
                       drop_null_users: bool = False) -> DataFrame:
    """Max implicit rating per key (default per user, item and day: the daily matrix).

    Aggregation is a max, so the partial aggregate before the shuffle already collapses repeated reviews of a
    pair within each task. NULL users form a group unless ``drop_null_users``.
    """
    r = reviews
    if drop_null_users:
        r = r.where(F.col("steamid").isNotNull())
    r = with_rating(r.select(*keys, "voted_up", "playtime_at_review"))
    m = r.groupBy(*keys).agg(F.max("implicit_rating").alias("implicit_rating"))
    cols = [F.col("steamid").alias("user_sk") if k == "steamid" else F.col(k) for k in keys]
    return m.select(*cols, "implicit_rating")


def interactions(reviews: DataFrame) -> DataFrame:
    """(steamid, appid, rating): max rating per user and item over all days; NULL users dropped."""
    r = with_rating(reviews.where(F.col("steamid").isNotNull())
                    .select("steamid", "appid", "voted_up", "playtime_at_review"))
    return r.groupBy("steamid", "appid").agg(F.max("implicit_rating").alias("rating"))
