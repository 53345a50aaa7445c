import math

import pytest
from pyspark.sql import functions as F

from conftest import flat_df, review_row
from critica.operators import silver as sv
from critica.schemas import SILVER_SCHEMA, assert_schema


def ids(df, col="recommendationid"):
    return sorted(r[col] for r in df.select(col).collect())


def test_dedup_keeps_latest_version(spark):
    df = flat_df(spark, [review_row(recommendationid="r1", timestamp_updated=100),
                         review_row(recommendationid="r1", timestamp_updated=200),
                         review_row(recommendationid="r2", timestamp_updated=150)])
    out = sv.deduplicate(df).collect()
    assert len(out) == 2
    assert {r["recommendationid"]: r["timestamp_updated"] for r in out}["r1"] == 200


def test_dedup_no_duplicates(spark):
    df = flat_df(spark, [review_row(recommendationid=i) for i in ("r1", "r2", "r3")])
    assert sv.deduplicate(df).count() == 3


def test_dedup_three_versions(spark):
    df = flat_df(spark, [review_row(recommendationid="dup", timestamp_updated=t) for t in (50, 300, 100)])
    out = sv.deduplicate(df).collect()
    assert len(out) == 1 and out[0]["timestamp_updated"] == 300


def test_dedup_null_timestamp_loses_and_ties_are_deterministic(spark):
    rows = [review_row(recommendationid="x", timestamp_updated=None, votes_up=1),
            review_row(recommendationid="x", timestamp_updated=5, votes_up=2),
            review_row(recommendationid="y", timestamp_updated=7, votes_up=9),
            review_row(recommendationid="y", timestamp_updated=7, votes_up=3)]
    for limit in (False, True):
        out = {r["recommendationid"]: r["votes_up"]
               for r in sv.deduplicate(flat_df(spark, rows), map_side_limit=limit).collect()}
        assert out == {"x": 2, "y": 3}


def test_dedup_is_per_day(spark):
    import datetime as dt
    rows = [review_row(recommendationid="r1", dt=dt.date(2024, 1, 1)),
            review_row(recommendationid="r1", dt=dt.date(2024, 1, 2))]
    assert sv.deduplicate(flat_df(spark, rows)).count() == 2


@pytest.mark.parametrize("texts,kept", [
    (["Good game", ""], ["Good game"]),
    (["text", "   ", "\t\n"], ["text"]),
    (["ok", " 　", None], ["ok"]),
])
def test_junk_blank_text(spark, texts, kept):
    df = flat_df(spark, [review_row(recommendationid=f"r{i}", review=t) for i, t in enumerate(texts)])
    assert sorted(r["review"] for r in sv.filter_junk(df).collect()) == kept


def test_junk_language_and_combined(spark):
    df = flat_df(spark, [review_row(recommendationid="a", language="english"),
                         review_row(recommendationid="b", language="russian"),
                         review_row(recommendationid="c", language="schinese"),
                         review_row(recommendationid="d", language="english", review=""),
                         review_row(recommendationid="e", language=None)])
    assert ids(sv.filter_junk(df)) == ["a"]


def test_latest_version_decides(spark):
    df = flat_df(spark, [review_row(recommendationid="r", timestamp_updated=1, review="fine"),
                         review_row(recommendationid="r", timestamp_updated=2, review=" ")])
    assert sv.filter_junk(sv.deduplicate(df)).count() == 0


def test_features(spark):
    df = flat_df(spark, [review_row(recommendationid="a", review="Hello", playtime_at_review=30, votes_up=100,
                                    votes_funny=0),
                         review_row(recommendationid="b", playtime_at_review=300, votes_up=0, votes_funny=0),
                         review_row(recommendationid="c", playtime_at_review=3600),
                         review_row(recommendationid="d", playtime_at_review=36000),
                         review_row(recommendationid="e", playtime_at_review=120, review="好游戏")])
    out = {r["recommendationid"]: r for r in sv.add_derived_features(df).collect()}
    assert out["a"]["review_length"] == 5
    assert [out[k]["playtime_bucket"] for k in "abcd"] == ["< 1hr", "1-10hr", "10-100hr", "100+hr"]
    assert out["a"]["helpfulness_ratio"] == pytest.approx(100 / 101)
    assert out["b"]["helpfulness_ratio"] == 0.0
    assert out["e"]["playtime_hours"] == 2.0
    assert out["e"]["review_length"] == 3


def test_silver_schema_and_stats(spark):
    df = flat_df(spark, [review_row(recommendationid="r1", timestamp_updated=1),
                         review_row(recommendationid="r1", timestamp_updated=2),
                         review_row(recommendationid="r2", language="german"),
                         review_row(recommendationid="r3", review="I love it, it is great!")])
    stats = sv.SilverStats()
    out = sv.silver(df, stats=stats)
    rows = out.collect()
    assert_schema(out, SILVER_SCHEMA)
    assert [f.name for f in out.schema.fields] == [f.name for f in SILVER_SCHEMA.fields]
    got = stats.get()
    assert {k: got[k] for k in ("n_raw", "n_dedup", "n_filtered")} == {"n_raw": 4, "n_dedup": 3, "n_filtered": 2}
    assert got["raw_text_chars"] == 3 * len("Good game") + len("I love it, it is great!")
    by = {r["recommendationid"]: r for r in rows}
    assert by["r3"]["sentiment_label"] == "pos" and -1 <= by["r3"]["sentiment_score"] <= 1


def test_flatten_casts_and_defaults(spark):
    from pyspark.sql import Row
    from critica.schemas import PAGE_SCHEMA
    page = {"success": 1, "query_summary": None, "cursor": "c",
            "reviews": [{"recommendationid": "1", "author": {"steamid": "s", "playtime_at_review": None},
                         "language": "english", "review": "x", "timestamp_created": 1, "timestamp_updated": 2,
                         "voted_up": True, "votes_up": None, "votes_funny": 3, "weighted_vote_score": "0.25",
                         "comment_count": None},
                        {"recommendationid": "2", "author": None, "weighted_vote_score": "not-a-number"}]}
    import json
    raw = spark.createDataFrame([Row(json=json.dumps(page), appid=730)])
    pages = raw.select(F.from_json("json", PAGE_SCHEMA).alias("p"), "appid").select("p.*", "appid")
    out = {r["recommendationid"]: r for r in sv.flatten_reviews(pages, dt="2024-01-01").collect()}
    assert out["1"]["votes_up"] == 0 and out["1"]["playtime_at_review"] == 0 and out["1"]["votes_funny"] == 3
    assert out["1"]["weighted_vote_score"] == 0.25 and out["2"]["weighted_vote_score"] is None
    assert out["2"]["steamid"] is None and str(out["2"]["dt"]) == "2024-01-01" and out["2"]["appid"] == 730


def test_empty_reviews_page_yields_no_rows(spark):
    from critica.schemas import PAGE_SCHEMA
    pages = spark.createDataFrame([(1, None, [], "")], PAGE_SCHEMA.simpleString().replace(
        ",_corrupt_record:string", "")).withColumn("appid", F.lit(1))
    assert sv.flatten_reviews(pages, dt="2024-01-01").count() == 0
    assert math.isfinite(1.0)


def test_versions_that_tie_on_everything_but_the_vote(spark):
    a = review_row(recommendationid="t", voted_up=True)
    b = review_row(recommendationid="t", voted_up=False)
    kept = {tuple(sv.deduplicate(flat_df(spark, rows)).select("voted_up").first()) for rows in ([a, b], [b, a])}
    assert len(kept) == 1


def test_tasks_that_hold_texts_grow_with_the_lines(spark, tmp, monkeypatch):
    """Lines that meet their texts are dealt by number, not by their own narrow size; without texts adaptive execution decides."""
    import datetime as dt

    from critica.sources import tables
    day = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i // 3, i % 5, 1, i % 3, 1.0, 100.0, 0.1, 0.0, "N", "O", day) for i in range(30)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp}/lineitem.parquet")
    spark.createDataFrame([(i, i, "O", day) for i in range(10)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz") \
        .write.parquet(f"{tmp}/orders.parquet")
    spark.createDataFrame([(i, f"good text {i}", "en") for i in range(4)], "doc_id long, text string, lang string").write.parquet(f"{tmp}/documents.parquet")
    monkeypatch.setattr(tables, "LINES_PER_TASK", 8)
    plan = tables.reviews_view(spark, tmp)._jdf.queryExecution().executedPlan().toString()
    assert "4), REPARTITION_BY_NUM" in plan, plan
    assert tables.reviews_view(spark, tmp).count() == 30
    monkeypatch.setattr(tables, "LINES_PER_TASK", 50)
    assert "REPARTITION_BY_COL" in tables.reviews_view(spark, tmp)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in tables.reviews_view(spark, tmp, text=False)._jdf.queryExecution().executedPlan().toString()
