"""Readers for Parquet tables: the driver's tables, silver / gold tables, and the reviews view over them.

``reviews_view`` maps the TPC-H-like order lines onto the flat review schema (one order line = one review
version), so every review operator runs on data whose size grows with the scale factor:

==========================  ===================================================================
recommendationid            ``l_orderkey || '-' || l_linenumber`` (repeats -> real duplicates)
steamid / appid             ``o_custkey`` as string / ``l_partkey`` as int
timestamp_created, dt       epoch seconds / date of ``o_orderdate``
timestamp_updated           epoch seconds of ``l_shipdate``
voted_up                    ``l_returnflag <> 'R'``
playtime_at_review          ``floor(l_extendedprice * l_discount)`` minutes
playtime_forever            ``floor(l_extendedprice)`` minutes
num_reviews                 ``l_suppkey``
votes_up / votes_funny      ``l_quantity`` / ``l_linenumber``
weighted_vote_score         ``l_discount``
comment_count               ``round(l_tax * 100)``
steam_purchase              ``l_linestatus = 'O'``
received_for_free           ``l_discount = 0``
written_during_early_access ``o_orderstatus = 'P'``
review, language            text / language of document ``l_orderkey mod count(documents)``
==========================  ===================================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.functions.features import non_blank

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# Order lines that a task joins with their texts; document language code -> review language name
LINES_PER_TASK = 50_000
LANGUAGE_NAMES = {"en": "english", "fr": "french", "de": "german", "es": "spanish"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables by name as temporary views (``spark.table(name)`` / SQL)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def language_name(code) -> F.Column:
    c = F.col(code) if isinstance(code, str) else code
    expr = None
    for k, v in LANGUAGE_NAMES.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(c)


def reviews_view(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """Flat reviews (FLAT_SCHEMA columns) over lineitem ⋈ orders ⋈ documents.

    ``text=False`` leaves the review text out and carries what decides about it instead, computed once per document:
    ``has_text`` (the junk filter) and ``review_key`` (the md5 tie-breaker of dedup). Lines are distributed by the
    order key, so a table that arrives in few files is spread for the work after it. Adaptive execution would size those
    tasks by the narrow lines; with texts they are sized by ``LINES_PER_TASK``, so that what a task sorts fits its memory
    however many lines there are.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    tasks = 1 + li.count() // LINES_PER_TASK if text else 1  # counted from the files' footers
    li = li.repartition(*[tasks][:tasks - 1], "l_orderkey")  # few lines are not held in one task
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    docs = read_table(spark, sf_dir, "documents")
    n_docs = docs.select(F.count(F.lit(1))).scalar()  # uncorrelated scalar subquery, evaluated once
    about_text = [F.col("text").alias("review")] if text else [non_blank("text").alias("has_text"),
                                                               F.md5("text").alias("review_key")]
    d = docs.select(F.col("doc_id"), language_name("lang").alias("language"), *about_text)
    text_columns = ["review"] if text else ["has_text", "review_key"]

    lines = li.join(o, li.l_orderkey == o.o_orderkey).withColumn("doc_slot", F.pmod(F.col("l_orderkey"), n_docs))
    j = lines.join(d, lines.doc_slot == d.doc_id)
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("recommendationid"),
        F.col("o_custkey").cast("string").alias("steamid"),
        F.floor(F.col("l_extendedprice")).cast("bigint").alias("playtime_forever"),
        F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint").alias("playtime_at_review"),
        F.col("l_suppkey").cast("bigint").alias("num_reviews"),
        F.col("language"),
        *text_columns,
        F.unix_timestamp(F.col("o_orderdate")).alias("timestamp_created"),
        F.unix_timestamp(F.col("l_shipdate")).alias("timestamp_updated"),
        (F.col("l_returnflag") != F.lit("R")).alias("voted_up"),
        F.col("l_quantity").cast("bigint").alias("votes_up"),
        F.col("l_linenumber").cast("bigint").alias("votes_funny"),
        F.col("l_discount").cast("double").alias("weighted_vote_score"),
        F.round(F.col("l_tax") * F.lit(100.0)).cast("bigint").alias("comment_count"),
        (F.col("l_linestatus") == F.lit("O")).alias("steam_purchase"),
        (F.col("l_discount") == F.lit(0.0)).alias("received_for_free"),
        (F.col("o_orderstatus") == F.lit("P")).alias("written_during_early_access"),
        F.col("l_partkey").cast("int").alias("appid"),
        F.to_date(F.col("o_orderdate")).alias("dt"),
    )


# SQL twin of reviews_view for the DuckDB oracle (independent engine, same mapping)
REVIEWS_SQL = """
reviews_v as (
  select
    cast(l.l_orderkey as varchar) || '-' || cast(l.l_linenumber as varchar) as recommendationid,
    cast(o.o_custkey as varchar) as steamid,
    cast(floor(l.l_extendedprice) as bigint) as playtime_forever,
    cast(floor(l.l_extendedprice * l.l_discount) as bigint) as playtime_at_review,
    cast(l.l_suppkey as bigint) as num_reviews,
    case d.lang when 'en' then 'english' when 'fr' then 'french' when 'de' then 'german'
                when 'es' then 'spanish' else d.lang end as language,
    d.text as review,
    cast(epoch(o.o_orderdate) as bigint) as timestamp_created,
    cast(epoch(l.l_shipdate) as bigint) as timestamp_updated,
    l.l_returnflag <> 'R' as voted_up,
    cast(l.l_quantity as bigint) as votes_up,
    cast(l.l_linenumber as bigint) as votes_funny,
    cast(l.l_discount as double) as weighted_vote_score,
    cast(round(l.l_tax * 100.0) as bigint) as comment_count,
    l.l_linestatus = 'O' as steam_purchase,
    l.l_discount = 0.0 as received_for_free,
    o.o_orderstatus = 'P' as written_during_early_access,
    cast(l.l_partkey as integer) as appid,
    d.doc_id as doc_id,
    cast(o.o_orderdate as date) as dt
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join documents d on d.doc_id = l.l_orderkey % (select count(*) from documents)
)"""
