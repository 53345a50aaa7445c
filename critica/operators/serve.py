"""Recommendation lookup (R4): the published table is partitioned by day, so a day is required (partition
filter), then the user filter and ``rank <= top_n``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recommendations_for(recs: DataFrame, user_sk: int, top_n: int, day: str) -> DataFrame:
    """Point lookup for one user: (rank, ranked_appid, score), ordered by rank."""
    if day is None:
        raise ValueError("a day is required (partition filter)")
    return (recs.where(F.to_date("generated_at") == F.to_date(F.lit(day)))
            .where(F.col("user_sk") == F.lit(user_sk)).where(F.col("rank") <= top_n)
            .select("rank", "ranked_appid", "score").orderBy("rank"))


def recommendations_for_users(recs: DataFrame, users: DataFrame, top_n: int, day: str) -> DataFrame:
    """Batch form: the same lookup for a set of users (semi join on user_sk)."""
    if day is None:
        raise ValueError("a day is required (partition filter)")
    return (recs.where(F.to_date("generated_at") == F.to_date(F.lit(day))).where(F.col("rank") <= top_n)
            .join(users.select("user_sk").distinct(), "user_sk", "left_semi")
            .select("user_sk", "rank", "ranked_appid", "score"))
