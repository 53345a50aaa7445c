"""Staging view and star schema: stg_reviews, dim_games (G3), dim_users (G4), fact_reviews, the daily
sentiment mart (G5), and the incremental fact rebuild (P9, K5).

Semantics kept from the SQL models: ``count_if`` ignores NULL; negative = count(*) - count_if(voted_up), so a
NULL vote counts as negative; ``avg`` ignores NULL; a ratio over zero rows is NULL (try_divide).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from critica.functions.keys import hashed_id, surrogate_key

STG_COLUMNS = [
    "review_id", "appid", "steamid", "playtime_forever", "playtime_at_review", "num_reviews", "language",
    "review", "timestamp_created", "timestamp_updated", "voted_up", "votes_up", "votes_funny",
    "weighted_vote_score", "comment_count", "steam_purchase", "received_for_free",
    "written_during_early_access", "sentiment_score", "sentiment_label", "review_length", "playtime_hours",
    "playtime_bucket", "helpfulness_ratio", "dt",
]


def stg_reviews(silver: DataFrame, dedup_across_dt: bool = False) -> DataFrame:
    """Rename, default missing counts to 0, drop rows without id or appid.

    ``dedup_across_dt`` keeps only the latest version of a review seen on several days (by
    timestamp_updated, then dt); by default every day keeps its own copy, as loaded.
    """
    z = F.lit(0).cast("bigint")
    s = silver.where(F.col("recommendationid").isNotNull() & F.col("appid").isNotNull()).select(
        F.col("recommendationid").alias("review_id"),
        F.col("appid").cast("bigint").alias("appid"),
        "steamid",
        F.coalesce("playtime_forever", z).alias("playtime_forever"),
        F.coalesce("playtime_at_review", z).alias("playtime_at_review"),
        F.coalesce("num_reviews", z).alias("num_reviews"),
        "language", "review", "timestamp_created", "timestamp_updated", "voted_up",
        F.coalesce("votes_up", z).alias("votes_up"),
        F.coalesce("votes_funny", z).alias("votes_funny"),
        "weighted_vote_score",
        F.coalesce("comment_count", z).alias("comment_count"),
        "steam_purchase", "received_for_free", "written_during_early_access", "sentiment_score",
        "sentiment_label",
        F.coalesce("review_length", z).alias("review_length"),
        "playtime_hours", "playtime_bucket", "helpfulness_ratio", "dt",
    )
    if dedup_across_dt:
        w = Window.partitionBy("review_id").orderBy(F.col("timestamp_updated").desc_nulls_last(),
                                                    F.col("dt").desc_nulls_last())
        s = s.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return s


def dim_games(stg: DataFrame, key_algo: str = "md5", summary: DataFrame | None = None) -> DataFrame:
    """One row per appid. ``summary`` (appid, name, review_score_desc) fills the descriptive columns
    (see :func:`critica.operators.pages.app_summary`); without it they stay NULL."""
    g = stg.groupBy("appid").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col("voted_up")).alias("total_positive"),
        F.min("dt").alias("first_seen_dt"),
        F.max("dt").alias("last_seen_dt"),
    )
    if summary is not None:
        g = g.join(summary.select("appid", "name", "review_score_desc"), "appid", "left")
    else:
        g = g.withColumn("name", F.lit(None).cast("string")) \
             .withColumn("review_score_desc", F.lit(None).cast("string"))
    return g.select(
        surrogate_key(F.col("appid").cast("string"), key_algo).alias("game_sk"),
        "appid",
        F.col("name").cast("string").alias("name"),
        "total_reviews",
        "total_positive",
        F.try_divide(F.col("total_positive").cast("double"), F.col("total_reviews").cast("double"))
        .alias("positive_rate"),
        F.col("review_score_desc").cast("string").alias("review_score_desc"),
        "first_seen_dt",
        "last_seen_dt",
    )


def dim_users(stg: DataFrame, key_algo: str = "md5", hash_user: bool = False, salt: str = "") -> DataFrame:
    """One row per reviewer. ``hash_user`` replaces the natural id by its salted sha-256 (anonymised
    dimension); the surrogate key is still derived from the natural id so facts keep joining."""
    u = stg.where(F.col("steamid").isNotNull()).groupBy("steamid").agg(
        F.max("num_reviews").alias("num_reviews"),
        F.min(F.timestamp_seconds("timestamp_created")).alias("first_review_ts"),
    )
    sid = hashed_id("steamid", salt) if hash_user else F.col("steamid")
    return u.select(surrogate_key("steamid", key_algo).alias("user_sk"), sid.alias("steamid"), "num_reviews",
                    "first_review_ts")


FACT_COLUMNS = ["review_id", "game_sk", "user_sk", "dt", "voted_up", "playtime_at_review_min", "votes_up",
                "weighted_vote_score", "sentiment_score", "sentiment_label", "review_length", "created_ts"]


def fact_reviews(stg: DataFrame, dts: Sequence | None = None, key_algo: str = "md5") -> DataFrame:
    """One row per review; ``dts`` restricts the build to those days (a partition filter on dt)."""
    src = stg if dts is None else stg.where(F.col("dt").isin([F.lit(d).cast("date") for d in dts]))
    return src.select(
        "review_id",
        surrogate_key(F.col("appid").cast("string"), key_algo).alias("game_sk"),
        F.when(F.col("steamid").isNotNull(), surrogate_key("steamid", key_algo)).alias("user_sk"),
        "dt",
        "voted_up",
        F.col("playtime_at_review").alias("playtime_at_review_min"),
        "votes_up",
        "weighted_vote_score",
        "sentiment_score",
        "sentiment_label",
        "review_length",
        F.timestamp_seconds("timestamp_created").alias("created_ts"),
    )


def sentiment_trends(fact: DataFrame, games: DataFrame) -> DataFrame:
    """Daily sentiment per game.

    The fact rows are aggregated by (game_sk, dt) *before* the join with the game dimension (which is unique
    on game_sk), so the join sees one row per game and day instead of one per review.
    """
    daily = fact.groupBy("game_sk", "dt").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col("voted_up")).alias("positive_reviews"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.count_if(F.col("sentiment_label") == "pos").alias("sentiment_pos_count"),
        F.count_if(F.col("sentiment_label") == "neu").alias("sentiment_neu_count"),
        F.count_if(F.col("sentiment_label") == "neg").alias("sentiment_neg_count"),
    )
    return daily.join(games.select("game_sk", "appid", "name"), "game_sk").select(
        "game_sk", "appid", "name", "dt", "total_reviews", "positive_reviews",
        (F.col("total_reviews") - F.col("positive_reviews")).alias("negative_reviews"),
        F.try_divide(F.col("positive_reviews").cast("double"), F.col("total_reviews").cast("double"))
        .alias("positive_rate"),
        "avg_sentiment_score", "sentiment_pos_count", "sentiment_neu_count", "sentiment_neg_count",
    )


def newest_day(fact: DataFrame | None):
    """The newest day of an existing fact, as a date; None if there is no fact or it has no rows. Over a table that is
    partitioned by dt this reads partition values only."""
    return None if fact is None else fact.agg(F.max("dt")).first()[0]


def fact_incremental(stg: DataFrame, existing_fact: DataFrame | None, key_algo: str = "md5") -> DataFrame:
    """Fact rows of every staged day >= the newest day of the existing fact; all days when there is none (NULL max means
    a full build). The day is a literal, so a staging table partitioned by dt opens only these folders, once."""
    newest = newest_day(existing_fact)
    return fact_reviews(stg if newest is None else stg.where(F.col("dt") >= F.lit(newest)), None, key_algo)


def build_gold(stg: DataFrame, key_algo: str = "md5") -> dict[str, DataFrame]:
    games = dim_games(stg, key_algo)
    users = dim_users(stg, key_algo)
    fact = fact_reviews(stg, None, key_algo)
    mart = sentiment_trends(fact, games)
    return {"dim_games": games, "dim_users": users, "fact_reviews": fact, "mart_game_sentiment_trends": mart}
