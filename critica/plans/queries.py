"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver's tables.

Every query reads whole tables (no id subsets, no row caps); the only limits are the features themselves
(top-N per user, k in ranking metrics). Doubles coming from sums, averages, logs or divisions are rounded
to 6 decimals so an independent engine can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.operators import gold, silver as sv
from critica.session import materialized
from critica.sources.tables import read_table, reviews_view

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------------------------------------
def silver_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.silver(reviews_view(spark, sf_dir))


def stg_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_reviews(silver_frame(spark, sf_dir))


def stg_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging without the text, written once for queries that read it several times."""
    return materialized(stg_frame(spark, sf_dir).drop("review"), "stg")


# ---------------------------------------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------------------------------------
@query("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    d = sv.deduplicate(reviews_view(spark, sf_dir, text=False))
    return d.select("recommendationid", "dt", "appid", "steamid", "timestamp_updated", "votes_up",
                    "playtime_at_review", "language")


@query("junk_filter")
def q_junk_filter(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").withColumnRenamed("text", "review") \
        .withColumn("language", F.col("lang"))
    return sv.filter_junk(docs, "en").select("doc_id", "lang", "source")


@query("derived_features")
def q_derived_features(spark, sf_dir):
    s = silver_frame(spark, sf_dir)
    return s.select("recommendationid", "dt", "review_length", r6("playtime_hours").alias("playtime_hours"),
                    "playtime_bucket", r6("helpfulness_ratio").alias("helpfulness_ratio"))


@query("lexicon_sentiment")
def q_lexicon_sentiment(spark, sf_dir):
    from critica.functions.sentiment import add_sentiment
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    s = add_sentiment(docs, "text", keys=["doc_id"])
    return s.select("doc_id", r6("sentiment_score").alias("sentiment_score"), "sentiment_label")


@query("silver_reviews")
def q_silver_reviews(spark, sf_dir):
    s = silver_frame(spark, sf_dir)
    return s.select("recommendationid", "steamid", "appid", "dt", "voted_up", "votes_up", "votes_funny",
                    "playtime_at_review", "timestamp_updated", "review_length",
                    r6("sentiment_score").alias("sentiment_score"), "sentiment_label")


# ---------------------------------------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------------------------------------
@query("stg_reviews")
def q_stg_reviews(spark, sf_dir):
    s = stg_frame(spark, sf_dir)
    return s.select("review_id", "appid", "steamid", "dt", "playtime_forever", "num_reviews", "comment_count",
                    "weighted_vote_score", "playtime_bucket")


@query("dim_games")
def q_dim_games(spark, sf_dir):
    g = gold.dim_games(stg_frame(spark, sf_dir))
    return g.withColumn("positive_rate", r6("positive_rate"))


@query("dim_users")
def q_dim_users(spark, sf_dir):
    return gold.dim_users(stg_frame(spark, sf_dir))


@query("fact_reviews")
def q_fact_reviews(spark, sf_dir):
    f = gold.fact_reviews(stg_frame(spark, sf_dir))
    return f.withColumn("sentiment_score", r6("sentiment_score"))


@query("sentiment_trends")
def q_sentiment_trends(spark, sf_dir):
    g = gold.build_gold(stg_once(spark, sf_dir))
    m = g["mart_game_sentiment_trends"]
    return m.withColumn("positive_rate", r6("positive_rate")) \
            .withColumn("avg_sentiment_score", r6("avg_sentiment_score"))


# ---------------------------------------------------------------------------------------------------------
# interactions, ids, split, recommendations, metrics
# ---------------------------------------------------------------------------------------------------------
def kept_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept (deduped, filtered) rows without their text: the rating queries need only the flag that a text is
    there and its md5 as the last tie-breaker."""
    return sv.filter_junk(sv.deduplicate(reviews_view(spark, sf_dir, text=False)))


def users_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_users over the kept rows (same rows as staging; only the columns the dimension needs)."""
    return users_of(kept_reviews(spark, sf_dir))


def users_of(kept: DataFrame) -> DataFrame:
    return gold.dim_users(kept.where(F.col("recommendationid").isNotNull() & F.col("appid").isNotNull()))


def kept_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the kept rows that ratings and users need, written once."""
    return materialized(kept_reviews(spark, sf_dir).select(
        "recommendationid", "steamid", "appid", "dt", "voted_up", "playtime_at_review", "num_reviews",
        "timestamp_created"), "kept")


def interactions_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from critica.operators.interactions import interactions
    return interactions(kept_reviews(spark, sf_dir))


def interactions_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(interactions_frame(spark, sf_dir), "interactions")


@query("interaction_matrix")
def q_interaction_matrix(spark, sf_dir):
    from critica.operators.interactions import interaction_matrix
    m = interaction_matrix(kept_reviews(spark, sf_dir))
    return m.withColumn("implicit_rating", r6("implicit_rating"))


@query("interactions_user_item")
def q_interactions(spark, sf_dir):
    return interactions_frame(spark, sf_dir).withColumn("rating", r6("rating"))


@query("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    from critica.functions.keys import surrogate_key
    c = read_table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"),
                                                       F.col("c_custkey").cast("string").alias("natural_key"))
    p = read_table(spark, sf_dir, "part").select(F.lit("part").alias("kind"),
                                                   F.col("p_partkey").cast("string").alias("natural_key"))
    return c.unionByName(p).withColumn("sk", surrogate_key("natural_key"))


@query("dense_user_index")
def q_dense_user_index(spark, sf_dir):
    from critica.operators.index import dense_index
    return dense_index(interactions_frame(spark, sf_dir), "steamid", "user_idx")


@query("dense_item_index")
def q_dense_item_index(spark, sf_dir):
    from critica.operators.index import dense_index
    return dense_index(interactions_frame(spark, sf_dir), "appid", "item_idx")


@query("hash_split")
def q_hash_split(spark, sf_dir):
    from critica.operators.split import with_split
    return with_split(interactions_frame(spark, sf_dir), ["steamid", "appid"]).select("steamid", "appid", "split")


@query("topn_unseen")
def q_topn_unseen(spark, sf_dir):
    from critica.operators.recommend import popular_unseen_top_n
    return popular_unseen_top_n(interactions_once(spark, sf_dir), 10, unique_pairs=True)


def popularity_eval_inputs(spark, sf_dir, k: int = 10):
    """Train/test by hash split; predictions = the train top-k for every test user also present in train."""
    from critica.operators.recommend import popular_top_k
    from critica.operators.split import hash_split
    train, test = hash_split(interactions_once(spark, sf_dir), ["steamid", "appid"])
    topk = popular_top_k(train, k).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("r", "appid"))), lambda x: x["appid"]).alias("a"))
    users = test.select("steamid").distinct().join(train.select("steamid").distinct(), "steamid")
    pred = users.select("steamid", F.posexplode(topk.scalar()).alias("p0", "appid")) \
        .select("steamid", "appid", (F.col("p0") + 1).alias("pos"))
    return pred, test.select("steamid", "appid")


@query("ranking_metrics")
def q_ranking_metrics(spark, sf_dir):
    from critica.operators.metrics import ranking_metrics
    pred, labels = popularity_eval_inputs(spark, sf_dir, 10)
    m = ranking_metrics(pred, labels, 10, user="steamid", item="appid")
    return m.select("k", "n_users", r6("precision_at_k").alias("precision_at_k"), r6("ndcg_at_k").alias("ndcg_at_k"))


GENERATED_AT = "2024-01-01 00:00:00"


def popularity_recs(kept: DataFrame, top_n: int = 10) -> tuple[DataFrame, DataFrame]:
    """(recommendations, users) of a stored ``kept`` frame: published-shape rows of the popularity baseline, mapped to
    user_sk through dim_users."""
    from critica.operators.interactions import interactions
    from critica.operators.recommend import popular_unseen_top_n
    users = users_of(kept).select("steamid", "user_sk")
    top = popular_unseen_top_n(materialized(interactions(kept), "interactions"), top_n, unique_pairs=True)
    recs = top.join(users, "steamid").select(
        F.col("user_sk").cast("bigint"), F.col("appid").cast("bigint").alias("ranked_appid"), "rank", "score",
        F.to_timestamp(F.lit(GENERATED_AT)).alias("generated_at"))
    return recs, users


@query("recommendation_lookup")
def q_recommendation_lookup(spark, sf_dir):
    from critica.operators.serve import recommendations_for_users
    recs, users = popularity_recs(kept_once(spark, sf_dir))
    return recommendations_for_users(recs, users.select("user_sk"), top_n=5, day=GENERATED_AT[:10])


@query("load_verify_by_dt")
def q_load_verify_by_dt(spark, sf_dir):
    return kept_reviews(spark, sf_dir).groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"))


@query("load_verify_recs")
def q_load_verify_recs(spark, sf_dir):
    recs, _ = popularity_recs(kept_once(spark, sf_dir))
    return recs.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("user_sk").alias("n_users"))


@query("dq_summary")
def q_dq_summary(spark, sf_dir):
    from critica.operators.quality import run_suite
    # staging feeds five tables and 24 tests: written once, without the text
    stg = stg_once(spark, sf_dir)
    tables = gold.build_gold(stg)
    tables["stg_reviews"] = stg
    return run_suite(tables)


@query("als_recommend")
def q_als_recommend(spark, sf_dir):
    """ALS unseen top-10 over the whole reviews view (no oracle: factorisation is not bit-stable across
    layouts; the invariants are checked in tests)."""
    from critica.plans.recommender import run_recommender
    kept = kept_once(spark, sf_dir)
    return run_recommender(kept, users_of(kept), GENERATED_AT, top_n=10, evaluate=False).recommendations


@query("als_shape")
def q_als_shape(spark, sf_dir):
    """What factorisation cannot change, at the job's own parameters: with the model refitted on all interactions every user gets
    min(10, unseen items) rows, and no row breaks an invariant (seen item, rank out of range or repeated, score
    rising with rank)."""
    from critica.operators.interactions import interactions
    from critica.plans.recommender import recommendation_invariants, run_recommender
    kept = kept_once(spark, sf_dir)
    users = users_of(kept)
    recs = materialized(run_recommender(kept, users, GENERATED_AT, top_n=10, evaluate=False, refit_on_all=True)
                        .recommendations, "recs")
    seen = interactions(kept).join(users.select("steamid", "user_sk"), "steamid").select("user_sk", "appid")
    broken = recommendation_invariants(recs, seen, 10).groupBy("user_sk").agg(F.count(F.lit(1)).alias("b"))
    return (recs.groupBy("user_sk").agg(F.count(F.lit(1)).alias("n_rows")).join(broken, "user_sk", "left")
            .select("user_sk", "n_rows", F.coalesce("b", F.lit(0)).cast("bigint").alias("n_breaks")))


def fixed_factors(inter: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Integer factors made from the ids of users and items, so inner products are the same in every engine; the norms of
    items differ by a factor of nine."""
    user, item = F.col("steamid").cast("bigint"), F.col("appid").cast("bigint")
    users = inter.select(user.alias("user_id")).distinct().withColumn("features", F.array(
        *[(F.col("user_id") * p % 17 - 4).cast("double") for p in (3, 7, 11, 19, 23, 31, 43, 59)]))
    items = inter.select(item.alias("item_id")).distinct().withColumn("features", F.array(
        *[((F.col("item_id") * p % 13 - 3) * (1 + F.col("item_id") % 9)).cast("double") for p in (5, 15, 17, 29, 37, 41, 47, 53)]))
    return users, items


@query("pruned_topn")
def q_pruned_topn(spark, sf_dir):
    """The ten best unseen items of every user by inner products, with blocks of items left out by their norm;
    equal to scoring every item."""
    from critica.operators.pruned_topn import pruned_top_n
    inter = interactions_once(spark, sf_dir)
    users, items = fixed_factors(inter)
    seen = inter.select(F.col("steamid").cast("bigint").alias("user_id"), F.col("appid").cast("bigint").alias("item_id"))
    return pruned_top_n(users, items, seen, 10, "user_id", "item_id").drop("n_scored")


def popular_candidates(inter: DataFrame, top_n: int = 10) -> DataFrame:
    """(steamid, appid, score): per user the top_n + (own seen items) most popular items - enough to fill top_n after
    the seen ones are removed, and no more."""
    from critica.operators.recommend import popularity
    ranked = popularity(inter).select(F.col("appid"), F.col("pop").cast("double").alias("score"), "r")
    need = inter.groupBy("steamid").agg((F.count(F.lit(1)) + top_n).alias("need"))
    wanted = need.select("steamid", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("need"))).alias("r"))
    return wanted.join(ranked, "r").select("steamid", "appid", "score")


@query("publish_fixed_scores")
def q_publish_fixed_scores(spark, sf_dir):
    """The publishing path with a score that is the same everywhere (popularity): dense ids, bounded candidates,
    seen-item anti join, re-rank, map-back, contract check, day-partitioned write, read back."""
    from critica.operators.interactions import interactions
    from critica.operators.recommend import index_interactions, map_back, unseen_top_n
    from critica.session import scratch_path
    from critica.sources import sinks
    kept = kept_once(spark, sf_dir)
    data, user_map, item_map = index_interactions(interactions(kept))
    data = materialized(data, "als_data")
    scored = popular_candidates(data.select("steamid", "appid")).join(user_map, "steamid").join(item_map, "appid")
    top = unseen_top_n(scored.select("user_idx", "item_idx", "score"), data.select("user_idx", "item_idx"), 10)
    path = scratch_path(spark, "published")
    sinks.publish_recommendations(map_back(top, user_map, item_map, users_of(kept), GENERATED_AT), path, GENERATED_AT[:10])
    return sinks.read_recommendations(spark, path, GENERATED_AT[:10])


# ---------------------------------------------------------------------------------------------------------
# bronze pages
# ---------------------------------------------------------------------------------------------------------
@query("bronze_flatten")
def q_bronze_flatten(spark, sf_dir):
    """Reviews packed into source pages, serialised to JSON, parsed back with the page schema, flattened."""
    from critica.sources.bronze import pages_from_json, pages_from_reviews, pages_to_json
    pages = pages_from_json(pages_to_json(pages_from_reviews(reviews_view(spark, sf_dir))))
    flat = sv.flatten_reviews(pages)
    return flat.select("recommendationid", "steamid", "appid", "dt", "playtime_forever", "playtime_at_review",
                       "num_reviews", "votes_up", "votes_funny", "weighted_vote_score", "comment_count",
                       "voted_up", "timestamp_created", "timestamp_updated", "language",
                       F.length("review").cast("bigint").alias("review_length"))


def conv_pages(spark, sf_dir):
    from critica.operators.pages import conversation_pages
    return conversation_pages(read_table(spark, sf_dir, "conversations"))


@query("page_chain_audit")
def q_page_chain_audit(spark, sf_dir):
    from critica.operators.pages import page_chain_audit
    return page_chain_audit(conv_pages(spark, sf_dir)).select(
        "dt", "appid", "page_num", "cursor", "n_reviews", "sent_cursor", "status", "kept")


@query("resume_state")
def q_resume_state(spark, sf_dir):
    from critica.operators.pages import page_chain_audit, resume_state
    return resume_state(page_chain_audit(conv_pages(spark, sf_dir)))


@query("app_summary")
def q_app_summary(spark, sf_dir):
    from critica.operators.pages import app_summary
    from critica.sources.bronze import pages_from_reviews
    votes = reviews_view(spark, sf_dir, text=False).withColumn("review", F.col("review_key"))  # texts play no part
    return app_summary(pages_from_reviews(votes))


@query("target_item_restrict")
def q_target_item_restrict(spark, sf_dir):
    """Reviews of the target items only (left-semi join); the target list is the 50 most reviewed items."""
    from critica.operators.recommend import popularity
    from critica.sources.bronze import first_items
    rv = reviews_view(spark, sf_dir, text=False).select("steamid", "appid")
    ranked = popularity(rv.where(F.col("steamid").isNotNull()), distinct=True)
    targets = first_items(ranked, 50, "r").select("appid")
    kept = rv.join(targets, "appid", "left_semi")
    return kept.groupBy("appid").agg(F.count(F.lit(1)).alias("n_reviews"))


# ---------------------------------------------------------------------------------------------------------
# writes, incremental builds, retention
# ---------------------------------------------------------------------------------------------------------
@query("partition_overwrite")
def q_partition_overwrite(spark, sf_dir):
    """Write the monthly interaction matrix, rewrite only its first month, read everything back: the other
    months must be untouched and the rewritten month present once (dynamic partition overwrite)."""
    from critica.session import scratch_path
    from critica.sources.sinks import read_matrix, write_matrix
    m = monthly_matrix(spark, sf_dir)
    root = scratch_path(spark, "matrix")
    write_matrix(m, root)
    write_matrix(m.where(F.col("dt") == m.select(F.min("dt")).scalar()), root)
    return read_matrix(spark, root).withColumn("implicit_rating", r6("implicit_rating"))


def monthly_matrix(spark, sf_dir):
    from critica.operators.interactions import interaction_matrix
    return materialized(interaction_matrix(kept_reviews(spark, sf_dir).withColumn("dt", F.trunc("dt", "month"))), "matrix")


@query("day_replace_empty")
def q_day_replace_empty(spark, sf_dir):
    """Write the monthly matrix, then run its first and second month again with rows for the second only: the first
    month must be empty afterwards, the second replaced, the others untouched."""
    from critica.session import scratch_path
    from critica.sources.sinks import read_matrix, write_matrix
    m = monthly_matrix(spark, sf_dir)
    root = scratch_path(spark, "matrix")
    write_matrix(m, root)
    first = m.select(F.min("dt").alias("a"), F.add_months(F.min("dt"), 1).alias("b")).first()
    half = m.where(F.col("dt") == F.lit(first.b)).withColumn("implicit_rating", F.col("implicit_rating") / 2)
    write_matrix(half, root, [str(first.a), str(first.b)])
    return read_matrix(spark, root).withColumn("implicit_rating", r6("implicit_rating"))


# ---------------------------------------------------------------------------------------------------------
# bronze files -> silver files
# ---------------------------------------------------------------------------------------------------------
ITEM_GROUPS = 8


def coarse_pages(spark, sf_dir):
    """All reviews as page files in few folders: the year stands for the day, items fall into a fixed number of groups."""
    from critica.sources.bronze import pages_from_reviews
    rv = reviews_view(spark, sf_dir).withColumn("dt", F.trunc("dt", "year")) \
        .withColumn("appid", F.pmod("appid", F.lit(ITEM_GROUPS)).cast("int"))
    return pages_from_reviews(rv)


def silver_digest(silver: DataFrame) -> DataFrame:
    return silver.select("recommendationid", "dt", "appid", "votes_up", "timestamp_updated", "review_length",
                         "playtime_bucket")


@query("bronze_to_silver")
def q_bronze_to_silver(spark, sf_dir):
    """Page files written, read back with the page contract, flattened, silver built, written and read by day."""
    from critica.session import scratch_path
    from critica.sources import bronze, sinks
    root = scratch_path(spark, "lake")
    bronze.write_bronze(coarse_pages(spark, sf_dir), f"{root}/bronze", in_place=True)
    pages = bronze.require_rows(bronze.read_bronze(spark, f"{root}/bronze", multi_line=False), "bronze")
    stats = sv.SilverStats()
    sinks.write_silver(sv.silver(sv.flatten_reviews(stats.watch_pages(pages)), stats=stats), root)
    return silver_digest(sinks.read_silver(spark, root))


@query("incremental_silver")
def q_incremental_silver(spark, sf_dir):
    """Incremental refresh over page files: a first run over all years but the newest, then the newest year arrives
    and a second run picks up only its files."""
    from critica.session import scratch_path
    from critica.sources import bronze, sinks
    from critica.streaming.incremental import incremental_silver
    root = scratch_path(spark, "lake")
    pages = materialized(coarse_pages(spark, sf_dir), "pages")
    newest = pages.select(F.max("dt")).scalar()
    for part in (pages.where(F.col("dt") < newest), pages.where(F.col("dt") == newest)):
        bronze.write_bronze(part, f"{root}/bronze", in_place=True)
        incremental_silver(spark, f"{root}/bronze", root, f"{root}/progress", multi_line=False)
    return silver_digest(sinks.read_silver(spark, root))


@query("fact_incremental")
def q_fact_incremental(spark, sf_dir):
    """Incremental fact build: the existing fact holds the days before the last 90; the run rebuilds every day
    >= max(existing dt) (so the last existing day is re-processed, as an insert-overwrite would)."""
    stg = stg_once(spark, sf_dir)
    cut = stg.select(F.date_sub(F.max("dt"), 90)).scalar()
    existing = gold.fact_reviews(stg.where(F.col("dt") < cut))
    inc = gold.fact_incremental(stg, existing)
    return inc.withColumn("sentiment_score", r6("sentiment_score"))


@query("partition_tiers")
def q_partition_tiers(spark, sf_dir):
    """Age and storage tier of every silver day, relative to the newest day."""
    from critica.operators.retention import partition_ages
    return partition_ages(kept_reviews(spark, sf_dir).select("dt"))


@query("expired_partitions")
def q_expired_partitions(spark, sf_dir):
    from critica.operators.retention import expired_partitions
    return expired_partitions(kept_reviews(spark, sf_dir).select("dt"), None, "silver")


@query("seen_anti_join")
def q_seen_anti_join(spark, sf_dir):
    """Every user's candidates (its top_n + seen most popular items) without the pairs it has already seen."""
    inter = interactions_once(spark, sf_dir)
    return popular_candidates(inter).select("steamid", "appid").join(inter, ["steamid", "appid"], "left_anti")


@query("event_interactions")
def q_event_interactions(spark, sf_dir):
    """The daily interaction matrix over the events stream: the item id is parsed from the JSON ``props`` with an
    explicit schema, a purchase counts as the up-vote and the event value as the time signal."""
    from critica.operators.interactions import interaction_matrix
    ev = read_table(spark, sf_dir, "events")
    props = F.from_json("props", "struct<k:int>")
    r = ev.select(F.col("user_id").cast("string").alias("steamid"), props["k"].alias("appid"),
                  F.to_date("ts").alias("dt"), (F.col("event_type") == F.lit("purchase")).alias("voted_up"),
                  F.col("value").alias("playtime_at_review"))
    return interaction_matrix(r).withColumn("implicit_rating", r6("implicit_rating"))


@query("silver_stage_counts")
def q_silver_stage_counts(spark, sf_dir):
    """The silver job's stage counts, observed while it runs (one pass, nothing cached): rows in, after
    dedup, after the junk filter, and characters of review text read. Every silver column but the text itself goes to the
    sink, so texts are read and scored but not shuffled."""
    stats = sv.SilverStats()
    sv.silver(reviews_view(spark, sf_dir), stats=stats).drop("review").write.format("noop").mode("overwrite").save()
    st = stats.get()
    return spark.createDataFrame([(st["n_raw"], st["n_dedup"], st["n_filtered"], st["raw_text_chars"])],
                                 "n_raw bigint, n_dedup bigint, n_filtered bigint, raw_text_chars bigint")


# ---------------------------------------------------------------------------------------------------------
# sinks and readers, each written and read back
# ---------------------------------------------------------------------------------------------------------
@query("dim_users_readback")
def q_dim_users_readback(spark, sf_dir):
    """The user dimension written in full, its two columns read back."""
    from critica.session import scratch_path
    from critica.sources import sinks
    path = scratch_path(spark, "dim_users")
    sinks.write_table(users_frame(spark, sf_dir), path)
    return sinks.read_dim_users(spark, path)


@query("dim_games_view")
def q_dim_games_view(spark, sf_dir):
    """K6: the game dimension as a named view."""
    from critica.sources.sinks import materialize
    materialize(gold.dim_games(stg_frame(spark, sf_dir)), "critica_dim_games", "view")
    return spark.table("critica_dim_games").withColumn("positive_rate", r6("positive_rate"))


def yearly(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.trunc("dt", "year"))


@query("staging_load")
def q_staging_load(spark, sf_dir):
    """K4: silver loaded into the staging table by day (here: year) with its schema check, texts and all; one year is
    loaded a second time, which must change nothing."""
    from critica.schemas import SILVER_SCHEMA
    from critica.session import scratch_path
    from critica.sources.sinks import load_staging
    path = scratch_path(spark, "staging")
    rows = materialized(yearly(silver_frame(spark, sf_dir)).select(*SILVER_SCHEMA.names), "silver")
    load_staging(rows, path, SILVER_SCHEMA)
    load_staging(rows, path, SILVER_SCHEMA, [str(rows.agg(F.min("dt")).first()[0])])
    return spark.read.schema(SILVER_SCHEMA).parquet(path).select(
        "recommendationid", "steamid", "appid", "dt", F.length("review").cast("bigint").alias("n_chars"), "review_length",
        "playtime_bucket", r6("sentiment_score").alias("sentiment_score"), "sentiment_label")


@query("fact_write")
def q_fact_write(spark, sf_dir):
    """K5: the fact written by day (here: year), clustered by game; then the even years run again without rows, which
    empties them."""
    from critica.session import scratch_path
    from critica.sources import sinks
    path = scratch_path(spark, "fact")
    fact = materialized(yearly(gold.fact_reviews(stg_frame(spark, sf_dir))), "fact")
    sinks.write_fact(fact, path)
    years = [str(r.dt) for r in fact.select("dt").distinct().collect()]
    sinks.write_fact(fact.limit(0), path, [y for y in years if int(y[:4]) % 2 == 0])
    return sinks.read_fact(spark, path).withColumn("sentiment_score", r6("sentiment_score"))


@query("export_readback")
def q_export_readback(spark, sf_dir):
    """K8: interactions exported as plain snappy Parquet and read back."""
    from critica.session import scratch_path
    from critica.sources.sinks import export_parquet
    path = scratch_path(spark, "export")
    export_parquet(interactions_frame(spark, sf_dir), path)
    return spark.read.parquet(path).withColumn("rating", r6("rating"))


@query("bronze_flatten_day")
def q_bronze_flatten_day(spark, sf_dir):
    """Pages flattened as one run's day; the constant wins over the pages' own dates."""
    from critica.sources.bronze import pages_from_reviews
    votes = reviews_view(spark, sf_dir, text=False).withColumn("review", F.col("review_key"))
    return sv.flatten_reviews(pages_from_reviews(votes), "2024-01-01").select(
        "recommendationid", "steamid", "appid", "dt", "votes_up", "timestamp_updated")


@query("items_preview")
def q_items_preview(spark, sf_dir):
    """T4: the first 20 rows of the popularity ranking, as a report shows them."""
    from critica.operators.recommend import popularity
    return popularity(interactions_frame(spark, sf_dir)).orderBy("r").limit(20)


@query("python_scorer")
def q_python_scorer(spark, sf_dir):
    """A scorer that is plain Python code, made once per task, plugged in as an iterator pandas UDF."""
    from critica.functions.sentiment import add_sentiment, pandas_scorer

    def marks():
        def score(text):
            t = text or ""
            return min(t.count("!"), 10) / 10 - min(t.count("?"), 10) / 10
        return score

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    s = add_sentiment(docs, "text", scorer=pandas_scorer(marks))
    return s.select("doc_id", r6("sentiment_score").alias("sentiment_score"), "sentiment_label")


# ---------------------------------------------------------------------------------------------------------
# mergeable state, daily run
# ---------------------------------------------------------------------------------------------------------
def refreshed_state(spark, sf_dir):
    """The daily state (with half months as days) after two refreshes: first a table with every fifth day missing, every
    seventh with its votes turned round and every eleventh still there, then the days that differ in the final table."""
    from critica.operators import daily_state
    from critica.session import scratch_path
    from critica.sources.versions import Transaction, current
    late_half = (F.dayofmonth("dt") > 15).cast("int")
    number = (F.year("dt") * 12 + F.month("dt")) * 2 + late_half
    stg = materialized(stg_frame(spark, sf_dir).drop("review").withColumn("k", number)
                       .withColumn("dt", F.date_add(F.trunc("dt", "month"), 15 * late_half)), "half-months")
    root = scratch_path(spark, "gold")
    turned = F.when(F.col("k") % 7 == 1, ~F.col("voted_up")).otherwise(F.col("voted_up"))
    days = [(str(r.dt), r.k) for r in stg.select("dt", "k").distinct().collect()]  # a short list of dates
    tx = Transaction(spark, root)
    daily_state.refresh(tx, stg.where("k % 5 <> 0").withColumn("voted_up", turned), [d for d, _ in days])
    tx.commit()
    tx = Transaction(spark, root)
    daily_state.refresh(tx, stg.where("k % 11 <> 3"), [d for d, k in days if k % 5 == 0 or k % 7 == 1 or k % 11 == 3])
    tx.commit()
    return current(spark, root)


@query("state_dim_games")
def q_state_dim_games(spark, sf_dir):
    """G3 from the mergeable state after late, edited and emptied days: equal to the full build."""
    from critica.operators import daily_state
    return daily_state.dim_games(refreshed_state(spark, sf_dir)).withColumn("positive_rate", r6("positive_rate"))


@query("state_dim_users")
def q_state_dim_users(spark, sf_dir):
    """G4 from the mergeable state."""
    from critica.operators import daily_state
    return daily_state.dim_users(refreshed_state(spark, sf_dir))


@query("state_trends")
def q_state_trends(spark, sf_dir):
    """G5 from the mergeable state."""
    from critica.operators import daily_state
    state = refreshed_state(spark, sf_dir)
    return daily_state.sentiment_trends(state, daily_state.dim_games(state)).withColumn("positive_rate", r6("positive_rate")) \
        .withColumn("avg_sentiment_score", r6("avg_sentiment_score"))


@query("rolling_sentiment")
def q_rolling_sentiment(spark, sf_dir):
    """Sentiment of every game over the 7 and 28 days that end with each of its days, from day partials."""
    from critica.operators import daily_state
    r = daily_state.rolling_sentiment(daily_state.game_days(stg_frame(spark, sf_dir).drop("review")))
    return r.select("appid", "dt", *[c if c.startswith("n_") else r6(c).alias(c) for c in r.columns[2:]])


@query("daily_run")
def q_daily_run(spark, sf_dir):
    """The daily run over page files, for two days that hold all reviews (before July 1995 and after); the mart as
    published at the end."""
    from critica.plans.daily import Paths, read_gold, run_day
    from critica.session import scratch_path
    from critica.sources import bronze
    root = scratch_path(spark, "warehouse")
    half = F.when(F.col("dt") < F.lit("1995-07-01").cast("date"), F.lit("1995-01-01")).otherwise(F.lit("1995-07-01"))
    rv = reviews_view(spark, sf_dir)
    kept = materialized(sv.deduplicate(rv).withColumn("dt", half.cast("date")), "halves")
    pages = bronze.pages_from_reviews(kept.withColumn("appid", F.pmod("appid", F.lit(ITEM_GROUPS)).cast("int")))
    bronze.write_bronze(pages, f"{root}/b", in_place=True)
    paths = Paths(f"{root}/b", f"{root}/silver", f"{root}/wh")
    for day in ("1995-01-01", "1995-07-01"):
        run_day(spark, day, paths, f"{day} 06:00:00", recommend=False, multi_line=False)
    return read_gold(spark, paths, "mart_game_sentiment_trends").withColumn("positive_rate", r6("positive_rate")) \
        .withColumn("avg_sentiment_score", r6("avg_sentiment_score"))


# ---------------------------------------------------------------------------------------------------------
# joins in time, reconciliation, cubes, sketches, sessions
# ---------------------------------------------------------------------------------------------------------
@query("asof_summary")
def q_asof_summary(spark, sf_dir):
    """Every review with the newest monthly summary of its item that began at least 32 days before it."""
    from critica.operators.timejoin import asof_join
    kept = kept_once(spark, sf_dir)
    months = kept.groupBy("appid", F.trunc("dt", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("month_reviews"), F.count_if(F.col("voted_up")).alias("month_positive"))
    reviews = kept.select("recommendationid", "appid", "dt", F.date_sub("dt", 32).alias("since"))
    return asof_join(reviews, months.withColumn("at", F.col("month")), ["appid"], "since", "at",
                     ["month", "month_reviews", "month_positive"]).drop("since")


@query("interval_matches")
def q_interval_matches(spark, sf_dir):
    """Events inside the review windows of the same user: the window of a review opens on a day of January 2024 given by
    its date and lasts one to ten days."""
    from critica.operators.timejoin import interval_join
    day = 86_400_000_000
    begin = F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + F.pmod(F.unix_date("dt"), F.lit(30)) * day
    spans = kept_reviews(spark, sf_dir).select("recommendationid", F.col("steamid").cast("bigint").alias("user_id"), begin.alias("a"),
                                               (begin + (1 + F.pmod("playtime_at_review", F.lit(10))) * day).alias("b"))
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return interval_join(events, spans, ["user_id"], "t", "a", "b", day).select("event_id", "recommendationid")


@query("load_difference")
def q_load_difference(spark, sf_dir):
    """Reconciliation of the raw reviews with the kept ones, of which some items are missing and some have other votes."""
    from critica.operators.reconcile import load_difference
    columns = ["dt", "recommendationid", "appid", "votes_up", "voted_up"]
    raw = reviews_view(spark, sf_dir, text=False)
    after = sv.filter_junk(sv.deduplicate(raw)).where(F.col("appid") % 5 != 0).withColumn(
        "votes_up", F.when(F.col("appid") % 7 == 0, F.col("votes_up") + 1).otherwise(F.col("votes_up")))
    # the operator reads both loads three times: each is derived once and written with these columns alone
    return load_difference(materialized(raw.select(*columns), "raw"), materialized(after.select(*columns), "after"),
                           ["dt", "recommendationid"])


@query("review_cube")
def q_review_cube(spark, sf_dir):
    """Counts per game, month and play-time bucket with four coarser levels, in one pass."""
    from critica.operators.cube import review_cube
    f = sv.add_derived_features(kept_reviews(spark, sf_dir).withColumn("review", F.col("review_key"))).withColumn("month", F.trunc("dt", "month"))
    keys = ["appid", "month", "playtime_bucket"]
    return review_cube(f, [keys, ["appid", "month"], ["appid"], ["month", "playtime_bucket"], []], keys)


@query("sketch_bounds")
def q_sketch_bounds(spark, sf_dir):
    """Distinct users and quantiles of play time per year from merged daily sketches, against exact figures: whether the
    estimate is within 3 % and each quantile's rank within 2 % (the sketches' bounds are about a third of that)."""
    from critica.operators.cube import day_sketches, merged_sketches, quantiles
    kept = kept_once(spark, sf_dir).select("dt", "steamid", "playtime_at_review")
    shares = (0.25, 0.5, 0.9)
    got = quantiles(merged_sketches(materialized(day_sketches(kept), "sketches"), F.year("dt")), shares)
    exact = (kept.groupBy(F.year("dt").alias("period"), "playtime_at_review").agg(F.count(F.lit(1)).alias("c"))
             .join(got.select("period", *[f"q{round(100 * s)}" for s in shares]), "period").groupBy("period")
             .agg(F.sum("c").alias("total"), *[F.sum(F.when(F.col("playtime_at_review") < F.col(q), F.col("c")).otherwise(0)).alias(f"{q}_lt")
                                               for q in ("q25", "q50", "q90")],
                  *[F.sum(F.when(F.col("playtime_at_review") <= F.col(q), F.col("c")).otherwise(0)).alias(f"{q}_le")
                    for q in ("q25", "q50", "q90")]))
    users = kept.select(F.year("dt").alias("period"), "steamid").distinct().groupBy("period").agg(F.count("steamid").alias("n_exact"))
    close = [((F.col(f"q{round(100 * s)}_lt") <= (s + 0.02) * F.col("total")) & (F.col(f"q{round(100 * s)}_le") >= (s - 0.02) * F.col("total")))
             .alias(f"q{round(100 * s)}_within") for s in shares]
    return got.join(users, "period").join(exact, "period").select(
        "period", F.col("n").alias("n_reviews"), F.col("n_exact").alias("n_users"),
        (F.abs(F.col("n_users") - F.col("n_exact")) <= 0.03 * F.col("n_exact")).alias("users_within"), *close)


@query("event_sessions")
def q_event_sessions(spark, sf_dir):
    """Sessions of the events stream (30 minutes apart) that arrives in three drops; every drop is a run of its own that
    goes on from the checkpoint, and an end mark closes the last sessions."""
    from critica.session import scratch_path
    from critica.streaming import sessions as S
    root = scratch_path(spark, "sessions")
    fields = [f.split() for f in S.EVENTS.split(", ")]
    events = read_table(spark, sf_dir, "events").select(*[F.col(n).cast(k) for n, k in fields])
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    third = F.floor(3 * (F.unix_micros("ts") - F.unix_micros(F.lit(span.a))) / (1 + F.unix_micros(F.lit(span.b)) - F.unix_micros(F.lit(span.a))))
    for k in range(3):
        events.where(third == k).write.mode("append").parquet(f"{root}/in")
        if k == 2:
            S.end_mark(spark, f"{root}/in", span.b, "30 minutes", "10 minutes")
        S.run_sessions(spark, f"{root}/in", f"{root}/out", f"{root}/progress", files_per_batch=1000)
    return S.read_sessions(spark, f"{root}/out").withColumn("value", r6("value"))


@query("page_drift")
def q_page_drift(spark, sf_dir):
    """Reviews as JSON pages whose shape drifts: a field appears in odd months, and in even years votes arrive as strings.
    The report per year, read from variants, and per year the sum of the votes, which must not suffer."""
    from critica.sources.drift import drift_report, raw_reviews, typed
    rv = reviews_view(spark, sf_dir, text=False)
    shape = [F.to_json(F.struct("recommendationid", F.col("votes_up").cast(kind).alias("votes_up"), "voted_up", *extra))
             for kind in ("string", "bigint") for extra in ([F.lit("x").alias("badge")], [])]
    odd, even = F.month("dt") % 2 == 1, F.year("dt") % 2 == 0
    review = F.when(even & odd, shape[0]).when(even, shape[1]).when(odd, shape[2]).otherwise(shape[3])
    pages = rv.select(F.year("dt").alias("year"), F.concat(F.lit('{"success":1,"reviews":['), review, F.lit("]}")).alias("value"))
    raw = raw_reviews(pages, "value", "year")
    votes = typed(raw, {"votes_up": ("$.votes_up", "bigint")}, "year").groupBy("year").agg(F.sum("votes_up").alias("votes"))
    return drift_report(raw, "year").join(votes, "year")
