"""Schema contracts: bronze page, silver/staging, gold tables, recommendations (K9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

AUTHOR = T.StructType([
    T.StructField("steamid", T.StringType()),
    T.StructField("num_games_owned", T.LongType()),
    T.StructField("num_reviews", T.LongType()),
    T.StructField("playtime_forever", T.LongType()),
    T.StructField("playtime_last_two_weeks", T.LongType()),
    T.StructField("playtime_at_review", T.LongType()),
    T.StructField("last_played", T.LongType()),
])

# weighted_vote_score arrives as a string in the source pages (sometimes a number); it is read as a
# string and converted with try_cast so a malformed value becomes NULL instead of failing the job.
REVIEW = T.StructType([
    T.StructField("recommendationid", T.StringType()),
    T.StructField("author", AUTHOR),
    T.StructField("language", T.StringType()),
    T.StructField("review", T.StringType()),
    T.StructField("timestamp_created", T.LongType()),
    T.StructField("timestamp_updated", T.LongType()),
    T.StructField("voted_up", T.BooleanType()),
    T.StructField("votes_up", T.LongType()),
    T.StructField("votes_funny", T.LongType()),
    T.StructField("weighted_vote_score", T.StringType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("steam_purchase", T.BooleanType()),
    T.StructField("received_for_free", T.BooleanType()),
    T.StructField("written_during_early_access", T.BooleanType()),
])

QUERY_SUMMARY = T.StructType([
    T.StructField("num_reviews", T.LongType()),
    T.StructField("review_score", T.LongType()),
    T.StructField("review_score_desc", T.StringType()),
    T.StructField("total_positive", T.LongType()),
    T.StructField("total_negative", T.LongType()),
    T.StructField("total_reviews", T.LongType()),
])

PAGE_SCHEMA = T.StructType([
    T.StructField("success", T.LongType()),
    T.StructField("query_summary", QUERY_SUMMARY),
    T.StructField("reviews", T.ArrayType(REVIEW)),
    T.StructField("cursor", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

# Flat review row after flatten (19 columns, dt last)
FLAT_COLUMNS = [
    "recommendationid", "steamid", "playtime_forever", "playtime_at_review", "num_reviews", "language",
    "review", "timestamp_created", "timestamp_updated", "voted_up", "votes_up", "votes_funny",
    "weighted_vote_score", "comment_count", "steam_purchase", "received_for_free",
    "written_during_early_access", "appid", "dt",
]

FLAT_SCHEMA = T.StructType([
    T.StructField("recommendationid", T.StringType()),
    T.StructField("steamid", T.StringType()),
    T.StructField("playtime_forever", T.LongType()),
    T.StructField("playtime_at_review", T.LongType()),
    T.StructField("num_reviews", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("review", T.StringType()),
    T.StructField("timestamp_created", T.LongType()),
    T.StructField("timestamp_updated", T.LongType()),
    T.StructField("voted_up", T.BooleanType()),
    T.StructField("votes_up", T.LongType()),
    T.StructField("votes_funny", T.LongType()),
    T.StructField("weighted_vote_score", T.DoubleType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("steam_purchase", T.BooleanType()),
    T.StructField("received_for_free", T.BooleanType()),
    T.StructField("written_during_early_access", T.BooleanType()),
    T.StructField("appid", T.IntegerType()),
    T.StructField("dt", T.DateType()),
])

# Silver = flat + features + sentiment (25 columns), the staging contract
SILVER_SCHEMA = T.StructType(
    [f for f in FLAT_SCHEMA.fields if f.name != "dt"]
    + [
        T.StructField("review_length", T.LongType()),
        T.StructField("playtime_hours", T.DoubleType()),
        T.StructField("playtime_bucket", T.StringType()),
        T.StructField("helpfulness_ratio", T.DoubleType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("dt", T.DateType()),
    ]
)

RECS_SCHEMA = T.StructType([
    T.StructField("user_sk", T.LongType(), False),
    T.StructField("ranked_appid", T.LongType(), False),
    T.StructField("rank", T.LongType(), False),
    T.StructField("score", T.DoubleType(), True),
    T.StructField("generated_at", T.TimestampType(), False),
])


FACT_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("game_sk", T.LongType()),
    T.StructField("user_sk", T.LongType()),
    T.StructField("dt", T.DateType()),
    T.StructField("voted_up", T.BooleanType()),
    T.StructField("playtime_at_review_min", T.LongType()),
    T.StructField("votes_up", T.LongType()),
    T.StructField("weighted_vote_score", T.DoubleType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("sentiment_label", T.StringType()),
    T.StructField("review_length", T.LongType()),
    T.StructField("created_ts", T.TimestampType()),
])

MATRIX_SCHEMA = T.StructType([
    T.StructField("user_sk", T.StringType()),
    T.StructField("appid", T.IntegerType()),
    T.StructField("implicit_rating", T.DoubleType()),
    T.StructField("dt", T.DateType()),
])


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, expected: T.StructType, allow_nullable_relax: bool = True,
                  check_order: bool = False) -> DataFrame:
    """Fail unless ``df`` has exactly the expected columns and types.

    The only tolerated difference is a REQUIRED column arriving as nullable when
    ``allow_nullable_relax`` — mirroring a load that permits required -> nullable relaxation.
    """
    got = {f.name: f for f in df.schema.fields}
    want = {f.name: f for f in expected.fields}
    missing = [n for n in want if n not in got]
    extra = [n for n in got if n not in want]
    problems = []
    if missing:
        problems.append(f"missing columns {missing}")
    if extra:
        problems.append(f"unexpected columns {extra}")
    for name, wf in want.items():
        gf = got.get(name)
        if gf is None:
            continue
        if gf.dataType != wf.dataType:
            problems.append(f"{name}: type {gf.dataType.simpleString()} != {wf.dataType.simpleString()}")
        if gf.nullable and not wf.nullable and not allow_nullable_relax:
            problems.append(f"{name}: nullable but required")
    if check_order and [f.name for f in df.schema.fields] != [f.name for f in expected.fields]:
        problems.append("column order differs")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
