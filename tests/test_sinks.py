import datetime as dt

import pytest
from pyspark.sql import functions as F

from critica.schemas import SchemaMismatch, assert_schema
from critica.sources import sinks


def test_dynamic_overwrite_replaces_one_day_only(spark, tmp):
    a = spark.createDataFrame([("u", 1, 0.5, dt.date(2024, 1, 1)), ("u", 2, 0.7, dt.date(2024, 1, 2))],
                              "user_sk string, appid int, implicit_rating double, dt date")
    sinks.write_matrix(a, tmp)
    b = spark.createDataFrame([("v", 3, 0.9, dt.date(2024, 1, 2))],
                              "user_sk string, appid int, implicit_rating double, dt date")
    sinks.write_matrix(b, tmp)
    back = {(r["user_sk"], str(r["dt"])) for r in sinks.read_matrix(spark, tmp).collect()}
    assert back == {("u", "2024-01-01"), ("v", "2024-01-02")}
    assert sinks.read_matrix(spark, tmp, "2024-01-01").count() == 1
    assert sinks.read_matrix(spark, tmp).schema["dt"].dataType.simpleString() == "date"


def test_schema_check_allows_only_nullable_relaxation(spark):
    from pyspark.sql import types as T
    want = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())])
    ok = spark.createDataFrame([(1, "x")], "a bigint, b string")
    assert_schema(ok, want)
    with pytest.raises(SchemaMismatch):
        assert_schema(ok, want, allow_nullable_relax=False)
    with pytest.raises(SchemaMismatch):
        assert_schema(spark.createDataFrame([(1,)], "a int"), want)


def test_publish_and_lookup_requires_day(spark, tmp):
    recs = spark.createDataFrame([(1, 10, 1, 0.9), (1, 11, 2, 0.8), (2, 10, 1, 0.5)],
                                 "user_sk bigint, ranked_appid bigint, rank bigint, score double") \
        .withColumn("generated_at", F.to_timestamp(F.lit("2024-01-05 03:00:00")))
    path = f"{tmp}/recs"
    sinks.publish_recommendations(recs, path)
    from critica.operators.serve import recommendations_for
    got = recommendations_for(sinks.read_recommendations(spark, path, "2024-01-05"), 1, 1, "2024-01-05").collect()
    assert [(r["rank"], r["ranked_appid"]) for r in got] == [(1, 10)]
    with pytest.raises(ValueError):
        sinks.read_recommendations(spark, path, "")


def matrix(spark, *rows):
    return spark.createDataFrame([(u, a, r, dt.date(2024, 1, d)) for u, a, r, d in rows],
                                 "user_sk string, appid int, implicit_rating double, dt date")


def days_of(spark, path):
    return sorted((r["user_sk"], r["dt"].day) for r in sinks.read_matrix(spark, path).collect())


@pytest.mark.parametrize("owned", [["2024-01-02"], ["2024-01-02", "2024-01-03"]])
def test_owned_days_without_rows_are_emptied(spark, tmp, owned):
    sinks.write_matrix(matrix(spark, ("a", 1, 0.5, 1), ("b", 1, 0.5, 2), ("c", 1, 0.5, 3)), tmp)
    sinks.write_matrix(matrix(spark, ("x", 1, 0.5, 1), ("d", 1, 0.5, 3)), tmp, owned)
    rest = [("c", 3)] if len(owned) == 1 else [("d", 3)]
    assert days_of(spark, tmp) == [("a", 1), *rest]  # rows of days that are not owned are not written


def test_every_day_emptied_can_still_be_read(spark, tmp):
    sinks.write_matrix(matrix(spark, ("a", 1, 0.5, 1)), tmp)
    sinks.write_matrix(matrix(spark), tmp, ["2024-01-01"])
    assert days_of(spark, tmp) == [] and sinks.read_matrix(spark, tmp, "2024-01-01").count() == 0


def test_published_day_is_replaced_by_an_empty_one_and_the_contract_holds(spark, tmp):
    from critica.schemas import FACT_SCHEMA, RECS_SCHEMA
    recs = spark.createDataFrame([(1, 10, 1, 0.9)], "user_sk bigint, ranked_appid bigint, rank bigint, score double") \
        .withColumn("generated_at", F.to_timestamp(F.lit("2024-01-05 03:00:00")))
    sinks.publish_recommendations(recs, tmp, "2024-01-05")
    sinks.publish_recommendations(spark.createDataFrame([], RECS_SCHEMA), tmp, "2024-01-05")
    assert sinks.read_recommendations(spark, tmp, "2024-01-05").count() == 0
    with pytest.raises(SchemaMismatch):
        sinks.publish_recommendations(recs.withColumn("rank", F.col("rank").cast("int")), tmp)
    with pytest.raises(SchemaMismatch):
        sinks.write_fact(spark.createDataFrame([], FACT_SCHEMA).withColumn("extra", F.lit(1)), tmp)


def test_materialisations_and_export(spark, tmp):
    df = spark.range(5).withColumnRenamed("id", "n")
    sinks.materialize(df, "v_numbers")
    assert spark.table("v_numbers").count() == 5
    sinks.export_parquet(df, f"{tmp}/out")
    assert spark.read.parquet(f"{tmp}/out").count() == 5
    with pytest.raises(ValueError):
        sinks.materialize(df, "x", "cube")


def test_tables_by_name(spark):
    import os

    from critica.sources.tables import register_views
    if os.path.isdir("/root/testdata/sf0.001"):
        register_views(spark, "/root/testdata/sf0.001", ("region", "nation"))
        assert spark.sql("select count(*) as n from nation join region on n_regionkey = r_regionkey").first()["n"] == 25


def test_copies_of_texts_are_packed_tighter_than_published_tables(spark, tmp):
    """Intermediate tables and the staging copy of silver are zstd; silver itself stays snappy."""
    import glob

    from conftest import flat_df, review_row
    from critica.operators.silver import silver
    from critica.schemas import SILVER_SCHEMA
    from critica.session import materialized
    from critica.sources.sinks import load_staging, write_silver
    rows = materialized(silver(flat_df(spark, [review_row(recommendationid=f"r{i}") for i in range(5)])).select(*SILVER_SCHEMA.names), "silver")
    assert all(f.endswith(".zstd.parquet") for f in rows.inputFiles())
    load_staging(rows, f"{tmp}/staging", SILVER_SCHEMA)
    write_silver(rows, f"{tmp}/silver")
    files = {k: glob.glob(f"{tmp}/{k}/**/*.parquet", recursive=True) for k in ("staging", "silver")}
    assert files["staging"] and all(f.endswith(".zstd.parquet") for f in files["staging"])
    assert files["silver"] and all(f.endswith(".snappy.parquet") for f in files["silver"])
    assert spark.read.parquet(f"{tmp}/staging").count() == rows.count() == 5
