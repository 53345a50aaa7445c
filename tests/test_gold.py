import datetime as dt

from pyspark.sql import functions as F

from conftest import flat_df, review_row
from critica.operators import gold, silver as sv


def test_stg_dedup_across_days_keeps_latest(spark):
    rows = [review_row(recommendationid="r1", dt=dt.date(2024, 1, 1), timestamp_updated=5, votes_up=1),
            review_row(recommendationid="r1", dt=dt.date(2024, 1, 2), timestamp_updated=9, votes_up=2),
            review_row(recommendationid="r2", dt=dt.date(2024, 1, 2))]
    s = sv.silver(flat_df(spark, rows))
    assert gold.stg_reviews(s).count() == 3                       # each day keeps its own copy by default
    one = {r["review_id"]: r["votes_up"] for r in gold.stg_reviews(s, dedup_across_dt=True).collect()}
    assert one == {"r1": 2, "r2": 10}


def test_dim_games_enriched_from_latest_summary(spark):
    s = sv.silver(flat_df(spark, [review_row(recommendationid="a", appid=730, voted_up=True),
                                  review_row(recommendationid="b", appid=730, voted_up=None),
                                  review_row(recommendationid="c", appid=440, voted_up=False)]))
    stg = gold.stg_reviews(s)
    summary = spark.createDataFrame([(730, "Game A", "Very Positive")], "appid bigint, name string, "
                                                                        "review_score_desc string")
    g = {r["appid"]: r for r in gold.dim_games(stg, summary=summary).collect()}
    assert g[730]["name"] == "Game A" and g[730]["review_score_desc"] == "Very Positive"
    assert g[440]["name"] is None
    assert g[730]["total_reviews"] == 2 and g[730]["total_positive"] == 1 and g[730]["positive_rate"] == 0.5
    mart = gold.build_gold(stg)["mart_game_sentiment_trends"].where(F.col("appid") == 730).first()
    assert mart["negative_reviews"] == 1                          # a NULL vote counts as negative


def test_incremental_fact_opens_new_days_only_and_scans_staging_once(spark, tmp):
    import datetime as dt

    from pyspark.sql import functions as F

    from critica.operators.gold import fact_incremental, newest_day
    from critica.schemas import SILVER_SCHEMA
    from critica.operators.gold import fact_reviews, stg_reviews
    from conftest import flat_df, review_row
    from critica.operators.silver import silver

    rows = [review_row(recommendationid=f"r{d}", dt=dt.date(2024, 1, d)) for d in range(1, 6)]
    silver(flat_df(spark, rows)).select(*SILVER_SCHEMA.names).write.partitionBy("dt").parquet(f"{tmp}/stg")
    stg = stg_reviews(spark.read.schema(SILVER_SCHEMA).parquet(f"{tmp}/stg"))
    old = fact_reviews(stg).where(F.col("dt") < "2024-01-04")
    old.write.partitionBy("dt").parquet(f"{tmp}/fact")
    fact = spark.read.schema(old.schema).parquet(f"{tmp}/fact")
    assert newest_day(fact) == dt.date(2024, 1, 3) and newest_day(fact.limit(0)) is None and newest_day(None) is None
    new = fact_incremental(stg, fact)
    assert sorted(r.dt.day for r in new.collect()) == [3, 4, 5]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(dt" in plan and "Join" not in plan
    assert fact_incremental(stg, None).count() == fact_incremental(stg, fact.limit(0)).count() == 5
