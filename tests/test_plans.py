"""Physical-plan properties that matter at scale (checked on the executed, adaptive plan)."""
import os
import re

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, plan):
    return len(re.findall(pattern, plan))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_silver_has_one_shuffle_and_a_map_side_limit(spark):
    from critica.operators import silver as sv
    from critica.sources.tables import reviews_view
    df = sv.silver(reviews_view(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # one shuffle of reviews (the view below it distributes narrow order lines)
    shuffles = re.findall(r"Exchange hashpartitioning\([^)]*\), ENSURE_REQUIREMENTS", plan)
    assert len(shuffles) == 1, plan
    # the partial group limit sits below the exchange: one row per key per map task is shuffled
    below = plan.split(shuffles[0], 1)[1]
    assert "WindowGroupLimit" in below
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan   # no Python UDF in the hot path


def test_texts_stay_where_they_are_read(spark, tmp):
    """Readers of silver without the text column: it is gone before the dedup window, scored and measured already."""
    from conftest import flat_df, review_row
    from critica.operators import silver as sv
    flat_df(spark, [review_row(recommendationid=f"r{i}") for i in range(5)]).write.parquet(f"{tmp}/flat")
    flat = spark.read.parquet(f"{tmp}/flat")
    for out in (sv.silver(flat).drop("review"), sv.silver(flat, stats=sv.SilverStats()).drop("review")):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        above, md5, _ = plan.partition("md5(cast(review#")
        assert md5 and not re.search(r"\breview#", above.rpartition("\n")[0]), plan


def test_row_index_avoids_single_partition_windows_on_data(spark):
    from critica.operators.index import row_index
    df = spark.range(0, 20000).withColumn("g", (F.col("id") % 3).cast("string"))
    out = row_index(df, [F.col("id").desc()], groups=["g"], name="j")
    plan = executed_plan(out)
    assert "SinglePartition" not in plan
    out0 = row_index(df, [F.col("id").asc()], name="j")
    plan0 = executed_plan(out0)
    # only the tiny per-partition offsets table is windowed in one partition, and it is broadcast
    assert "BroadcastExchange" in plan0 or "BroadcastHashJoin" in plan0


def test_mart_aggregates_before_join_and_prunes_columns(spark, tmp):
    from conftest import flat_df, review_row
    from critica.operators import gold, silver as sv
    silver = sv.silver(flat_df(spark, [review_row(recommendationid=f"r{i}", appid=i % 5) for i in range(50)]))
    silver.write.mode("overwrite").parquet(f"{tmp}/silver")
    stg = gold.stg_reviews(spark.read.parquet(f"{tmp}/silver"))
    mart = gold.build_gold(stg)["mart_game_sentiment_trends"]
    plan = executed_plan(mart)
    assert "partial_count" in plan                       # map-side partial aggregation
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("review:" not in s for s in scans)   # the text column is never read


def test_options(spark, tmp):
    from conftest import flat_df, review_row
    from critica.functions.sentiment import add_sentiment, pandas_scorer
    from critica.operators.gold import dim_users
    from critica.operators.retention import drop_partitions, expired_partitions
    df = flat_df(spark, [review_row(recommendationid="a", steamid="u1")])
    hashed = dim_users(df, hash_user=True, salt="s").first()
    plain = dim_users(df).first()
    assert hashed["user_sk"] == plain["user_sk"] and hashed["steamid"] != "u1" and len(hashed["steamid"]) == 64
    scored = add_sentiment(df, "review", scorer=pandas_scorer(lambda: (lambda t: 0.5 if "Good" in t else 0.0)))
    assert scored.first()["sentiment_label"] == "pos"
    days = spark.createDataFrame([("2024-01-01",), ("2024-06-01",), ("2024-07-10",)], "d string") \
        .select(F.to_date("d").alias("dt"))
    exp = [str(r["dt"]) for r in expired_partitions(days, F.to_date(F.lit("2024-07-15"))).collect()]
    assert exp == ["2024-01-01"]
    os.makedirs(f"{tmp}/t/dt=2024-01-01")
    drop_partitions(spark, f"{tmp}/t", exp, enabled=False)
    assert os.path.isdir(f"{tmp}/t/dt=2024-01-01")
    drop_partitions(spark, f"{tmp}/t", exp, enabled=True)
    assert not os.path.isdir(f"{tmp}/t/dt=2024-01-01")


NARROW = ["load_verify_by_dt", "partition_tiers", "expired_partitions", "interaction_matrix", "interactions_user_item",
          "hash_split", "dense_user_index", "dense_item_index"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NARROW)
def test_text_is_dropped_before_the_joins(spark, name):
    """Queries that put out no text carry none: it is read only to derive a flag and a key per document."""
    from critica.plans.queries import QUERIES, kept_reviews
    for df in (QUERIES[name](spark, SF), kept_reviews(spark, SF)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        carried = [x for x in plan.splitlines() if re.search(r"\b(review|text)#", x)]
        assert all(re.search(r"Relation|md5\(text#|RLIKE", x) for x in carried), carried


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_loads_and_spans_are_derived_once(spark):
    """What is read several times comes from a table written once, not from the order lines again."""
    from critica.plans.queries import QUERIES
    for name in ("load_difference", "interval_matches"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan, (name, plan)


def test_ordered_frames_are_kept_as_tables(spark):
    """Positions and as-of rows are written as sorted columns, not as serialised rows of a checkpoint."""
    from critica.operators.index import row_index
    from critica.operators.timejoin import asof_join
    left = spark.createDataFrame([(1, 5), (1, 7), (None, 3), (2, 1)], "k int, t int")
    right = spark.createDataFrame([(1, 4, "a"), (1, 6, "b")], "k int, u int, v string")
    joined = asof_join(left, right, ["k"], "t", "u", ["v"])
    placed = row_index(left, [F.col("t")], groups=["k"], name="j")
    assert sorted(map(tuple, joined.select("t", "v").collect())) == [(1, None), (3, None), (5, "a"), (7, "b")]
    assert sorted(map(tuple, placed.select("t", "j").collect())) == [(1, 0), (3, 0), (5, 0), (7, 1)]
    for df in (joined, placed):
        assert "LogicalRDD" not in df._jdf.queryExecution().optimizedPlan().toString()
