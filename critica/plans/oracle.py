"""Independent SQL (DuckDB dialect) for each registered query, over the same parquet tables.

The SQL restates each operator's semantics directly (windows, group by, joins); it shares only the fixed
constants (lexicon, thresholds) with the Spark code.
"""

from __future__ import annotations

from critica.functions import features as fx
from critica.functions.sentiment import sentiment_sql
from critica.operators.silver import DEDUP_TIE_BREAKERS
from critica.sources.tables import REVIEWS_SQL

ORACLE: dict[str, str] = {}


def _order_tail() -> str:
    return ", ".join(f"{c} asc nulls last" for c in (*DEDUP_TIE_BREAKERS, "md5(review)"))


def _page_order() -> str:
    cols = dict.fromkeys(["timestamp_updated", "steamid", *(c for c in DEDUP_TIE_BREAKERS if c != "appid"), "md5(review)"])
    return ", ".join(f"{c} asc nulls last" for c in cols)


DEDUP_SQL = f"""
dedup as (
  select * exclude (rn) from (
    select *, row_number() over (partition by dt, recommendationid
                                 order by timestamp_updated desc nulls last, {_order_tail()}) as rn
    from reviews_v) where rn = 1
)"""

FILTER_SQL = r"""
filt as (
  select * from dedup
  where language = 'english'
    and length(regexp_replace(coalesce(review, ''), '[\s\p{Z}]+', '', 'g')) > 0
)"""

# every review shows the text of one document: score each document once
SENT_SQL = f"""
sent as ({sentiment_sql('(select doc_id, text from documents where doc_id in (select doc_id from filt))', 'doc_id', 'text')})"""

BUCKETS_SQL = "case " + " ".join(
    f"when playtime_at_review / 60.0 < {b!r} then '{lbl}'" for b, lbl in fx.PLAYTIME_BUCKETS
) + f" else '{fx.PLAYTIME_BUCKET_TOP}' end"

FEATURES_SQL = f"""length(f.review)::bigint as review_length, f.playtime_at_review / 60.0 as playtime_hours,
         {BUCKETS_SQL} as playtime_bucket,
         f.votes_up::double / (f.votes_up::double + f.votes_funny::double + 1.0) as helpfulness_ratio"""

LABEL_SQL = (f"case when s.sentiment_score >= {fx.POS_THRESHOLD!r} then 'pos' "
             f"when s.sentiment_score <= {fx.NEG_THRESHOLD!r} then 'neg' else 'neu' end")

# kept reviews with their features; ``scored`` adds the sentiment of their document
FEAT_SQL = f"""
feat as (select f.*, {FEATURES_SQL} from filt f)"""

SCORED_SQL = f"""
scored as (select f.*, s.sentiment_score, {LABEL_SQL} as sentiment_label from feat f join sent s using (doc_id))"""


def sk(expr: str) -> str:
    """md5 surrogate key, same value as critica.functions.keys.surrogate_key(..., 'md5')."""
    h = f"('0x' || substr(md5(cast({expr} as varchar)), 1, 16))::hugeint"
    return f"(case when {h} >= 9223372036854775808 then {h} - 18446744073709551616 else {h} end)::bigint"


# The star schema, stated from the kept reviews (``feat`` / ``scored``) directly
GAMES_SQL = f"""
games as (
  select {sk('appid')} as game_sk, appid::bigint as appid, cast(null as varchar) as name, n as total_reviews,
         up as total_positive, up::double / n::double as positive_rate, cast(null as varchar) as review_score_desc,
         lo as first_seen_dt, hi as last_seen_dt
  from (select appid, count(*) as n, sum(case when voted_up then 1 else 0 end)::bigint as up, min(dt) as lo, max(dt) as hi
        from filt where recommendationid is not null and appid is not null group by appid)
)"""

USERS_SQL = f"""
users as (
  select {sk('steamid')} as user_sk, steamid, max(num_reviews) as num_reviews,
         min(make_timestamp(timestamp_created * 1000000)) as first_review_ts
  from filt where recommendationid is not null and appid is not null and steamid is not null group by steamid
)"""

FACT_SQL = f"""
fact as (
  select recommendationid as review_id, {sk('appid')} as game_sk,
         case when steamid is not null then {sk('steamid')} end as user_sk, dt, voted_up,
         coalesce(playtime_at_review, 0) as playtime_at_review_min, coalesce(votes_up, 0) as votes_up,
         weighted_vote_score, sentiment_score, sentiment_label, coalesce(review_length, 0) as review_length,
         make_timestamp(timestamp_created * 1000000) as created_ts
  from scored where recommendationid is not null and appid is not null
)"""

MART_SQL = f"""
mart as (
  select {sk('appid')} as game_sk, appid::bigint as appid, cast(null as varchar) as name, dt, n as total_reviews,
         up as positive_reviews, n - up as negative_reviews, up::double / n::double as positive_rate,
         mean as avg_sentiment_score, pos as sentiment_pos_count, neu as sentiment_neu_count, neg as sentiment_neg_count
  from (select appid, dt, count(*) as n, count(*) filter (where voted_up) as up, avg(sentiment_score) as mean,
               count(*) filter (where sentiment_label = 'pos') as pos, count(*) filter (where sentiment_label = 'neu') as neu,
               count(*) filter (where sentiment_label = 'neg') as neg
        from scored where recommendationid is not null and appid is not null group by appid, dt)
)"""

# staging as the data-quality tests see it
STG_SQL = """
stg as (
  select recommendationid as review_id, appid::bigint as appid, * exclude (recommendationid, appid) from scored
  where recommendationid is not null and appid is not null
)"""


# steps that later ones read several times: DuckDB would otherwise compute them again for every use
SHARED = ("reviews_v", "dedup", "filt", "feat", "sent", "scored")


def with_ctes(*ctes: str) -> str:
    sql = ",\n".join(c.strip() for c in ctes)
    for name in SHARED:
        sql = sql.replace(f"{name} as (", f"{name} as materialized (", 1) if sql.startswith(f"{name} as (") \
            else sql.replace(f"\n{name} as (", f"\n{name} as materialized (", 1)
    return "with " + sql


PLAIN = [REVIEWS_SQL, DEDUP_SQL, FILTER_SQL]
FEAT = [*PLAIN, FEAT_SQL]
SCORED = [*FEAT, SENT_SQL, SCORED_SQL]

ORACLE["dedup_latest"] = with_ctes(REVIEWS_SQL, DEDUP_SQL) + """
select recommendationid, dt, appid, steamid, timestamp_updated, votes_up, playtime_at_review, language from dedup"""

ORACLE["junk_filter"] = r"""
select doc_id, lang, source from documents
where lang = 'en' and length(regexp_replace(coalesce(text, ''), '[\s\p{Z}]+', '', 'g')) > 0"""

ORACLE["derived_features"] = with_ctes(*FEAT) + """
select recommendationid, dt, review_length, round(playtime_hours, 6) as playtime_hours, playtime_bucket,
       round(helpfulness_ratio, 6) as helpfulness_ratio from feat"""

ORACLE["lexicon_sentiment"] = f"""
with s as ({sentiment_sql('documents', 'doc_id', 'text')})
select doc_id, round(sentiment_score, 6) as sentiment_score,
       case when sentiment_score >= {fx.POS_THRESHOLD!r} then 'pos'
            when sentiment_score <= {fx.NEG_THRESHOLD!r} then 'neg' else 'neu' end as sentiment_label
from s"""

ORACLE["silver_reviews"] = with_ctes(*SCORED) + """
select recommendationid, steamid, appid, dt, voted_up, votes_up, votes_funny, playtime_at_review,
       timestamp_updated, review_length, round(sentiment_score, 6) as sentiment_score, sentiment_label
from scored"""

ORACLE["stg_reviews"] = with_ctes(*FEAT) + """
select recommendationid as review_id, appid::bigint as appid, steamid, dt, coalesce(playtime_forever, 0) as playtime_forever,
       coalesce(num_reviews, 0) as num_reviews, coalesce(comment_count, 0) as comment_count, weighted_vote_score,
       playtime_bucket
from feat where recommendationid is not null and appid is not null"""

ORACLE["dim_games"] = with_ctes(*PLAIN, GAMES_SQL) + """
select game_sk, appid, name, total_reviews, total_positive, round(positive_rate, 6) as positive_rate,
       review_score_desc, first_seen_dt, last_seen_dt from games"""

ORACLE["dim_users"] = with_ctes(*PLAIN, USERS_SQL) + """
select * from users"""

ORACLE["fact_reviews"] = with_ctes(*SCORED, FACT_SQL) + """
select * replace (round(sentiment_score, 6) as sentiment_score) from fact"""

ORACLE["sentiment_trends"] = with_ctes(*SCORED, MART_SQL) + """
select * replace (round(positive_rate, 6) as positive_rate, round(avg_sentiment_score, 6) as avg_sentiment_score)
from mart"""

# ---- interactions, ids, split, recommendations ----------------------------------------------------------
RATED_SQL = f"""
rated as (
  select steamid, appid, dt,
         0.6 * (case when voted_up then 1.0 else 0.0 end)
         + 0.4 * greatest(least(ln(1.0 + greatest(coalesce(playtime_at_review::double, 0.0), 0.0) / 60.0)
                                / ln(1.0 + {fx.BOOST_CAP_HOURS!r}), 1.0), 0.0) as implicit_rating
  from filt
)"""

INTER_SQL = """
inter as (
  select steamid, appid, max(implicit_rating) as rating from rated where steamid is not null group by steamid, appid
)"""

KEPT = [REVIEWS_SQL, DEDUP_SQL, FILTER_SQL, RATED_SQL, INTER_SQL]


def split_sql(cols: str = "steamid, appid", seed: int = 42) -> str:
    parts = ", ".join(f"cast({c.strip()} as varchar)" for c in cols.split(","))
    return f"(('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 8))::bigint % 1000)"


SPLIT_SQL = f"""
train as (select * from inter where {split_sql()} < 800),
test as (select * from inter where {split_sql()} >= 800)"""

POP_SQL = """
pop as (
  select appid, pop, row_number() over (order by pop desc, appid asc) as r
  from (select appid, count(distinct steamid) as pop from inter group by appid)
)"""

TOPN_SQL = """
topn as (
  select steamid, appid, rank, score from (
    select u.steamid, p.appid, p.pop::double as score,
           row_number() over (partition by u.steamid order by p.pop desc, p.appid asc) as rank
    from (select distinct steamid from inter) u cross join pop p
    where not exists (select 1 from inter i where i.steamid = u.steamid and i.appid = p.appid))
  where rank <= 10
)"""

KUSERS_SQL = f"""
kusers as (
  select {sk('steamid')} as user_sk, steamid from filt
  where steamid is not null and recommendationid is not null and appid is not null group by steamid
)"""

RECS_SQL = """
recs as (
  select k.user_sk, t.appid::bigint as ranked_appid, t.rank::bigint as rank, t.score,
         timestamp '2024-01-01 00:00:00' as generated_at
  from topn t join kusers k using (steamid)
)"""

ORACLE["interaction_matrix"] = with_ctes(REVIEWS_SQL, DEDUP_SQL, FILTER_SQL, RATED_SQL) + """
select steamid as user_sk, appid, dt, round(max(implicit_rating), 6) as implicit_rating
from rated group by steamid, appid, dt"""

ORACLE["interactions_user_item"] = with_ctes(*KEPT) + """
select steamid, appid, round(rating, 6) as rating from inter"""

ORACLE["surrogate_keys"] = f"""
select 'customer' as kind, cast(c_custkey as varchar) as natural_key, {sk('c_custkey')} as sk from customer
union all
select 'part' as kind, cast(p_partkey as varchar) as natural_key, {sk('p_partkey')} as sk from part"""

ORACLE["dense_user_index"] = with_ctes(*KEPT) + """
select steamid, (dense_rank() over (order by steamid) - 1)::integer as user_idx
from (select distinct steamid from inter)"""

ORACLE["dense_item_index"] = with_ctes(*KEPT) + """
select appid, (dense_rank() over (order by appid) - 1)::integer as item_idx
from (select distinct appid from inter)"""

ORACLE["hash_split"] = with_ctes(*KEPT) + f"""
select steamid, appid, case when {split_sql()} < 800 then 'train' else 'test' end as split from inter"""

ORACLE["topn_unseen"] = with_ctes(*KEPT, POP_SQL, TOPN_SQL) + """
select steamid, appid, rank::bigint as rank, score from topn"""

_UF = [f"(user_id * {p} % 17 - 4)" for p in (3, 7, 11, 19, 23, 31, 43, 59)]
_IF = [f"((item_id * {p} % 13 - 3) * (1 + item_id % 9))" for p in (5, 15, 17, 29, 37, 41, 47, 53)]
ORACLE["pruned_topn"] = with_ctes(*KEPT, f"""
seen as materialized (select steamid::bigint as user_id, appid::bigint as item_id from inter),
u as materialized (select user_id, {", ".join(f"{x} as u{k}" for k, x in enumerate(_UF))} from (select distinct user_id from seen)),
i as materialized (select item_id, {", ".join(f"{x} as i{k}" for k, x in enumerate(_IF))} from (select distinct item_id from seen)),
scored as (
  select user_id, item_id, ({" + ".join(f"u{k} * i{k}" for k in range(8))})::double as score
  from u cross join i where (user_id, item_id) not in (select user_id, item_id from seen)),
ranked as (select *, row_number() over (partition by user_id order by score desc, item_id) as rank from scored)""") + """
select user_id, item_id, score, rank from ranked where rank <= 10"""

ORACLE["ranking_metrics"] = with_ctes(*KEPT, SPLIT_SQL) + """,
tpop as (
  select appid, row_number() over (order by pop desc, appid asc) as pos
  from (select appid, count(distinct steamid) as pop from train group by appid)
),
topk as (select appid, pos from tpop where pos <= 10),
eu as (select distinct steamid from test where steamid in (select steamid from train)),
pred as (select eu.steamid, topk.appid, topk.pos from eu cross join topk),
lab as (select distinct steamid, appid from test),
nl as (select steamid, count(*) as n_labels from lab group by steamid),
hits as (
  select p.steamid, count(*) as n_hits, sum(1.0 / log2(p.pos + 1.0)) as dcg
  from pred p join lab l on p.steamid = l.steamid and p.appid = l.appid group by p.steamid
),
pu as (
  select eu.steamid, coalesce(h.n_hits, 0)::double / 10.0 as precision,
         coalesce(h.dcg, 0.0) / (select sum(1.0 / log2(i + 1.0)) from range(1, least(nl.n_labels, 10) + 1) t(i))
           as ndcg
  from eu join nl using (steamid) left join hits h using (steamid)
)
select 10 as k, count(*) as n_users, round(avg(precision), 6) as precision_at_k, round(avg(ndcg), 6) as ndcg_at_k
from pu"""

ORACLE["recommendation_lookup"] = with_ctes(*KEPT, POP_SQL, TOPN_SQL, KUSERS_SQL, RECS_SQL) + """
select user_sk, rank, ranked_appid, score from recs
where cast(generated_at as date) = date '2024-01-01' and rank <= 5
  and user_sk in (select user_sk from kusers)"""

ORACLE["load_verify_by_dt"] = with_ctes(REVIEWS_SQL, DEDUP_SQL, FILTER_SQL) + """
select dt, count(*) as n_rows from filt group by dt"""

ORACLE["load_verify_recs"] = with_ctes(*KEPT, POP_SQL, TOPN_SQL, KUSERS_SQL, RECS_SQL) + """
select count(*) as n_rows, count(distinct user_sk) as n_users from recs"""


def _dq_sql() -> str:
    from critica.operators.quality import DEFAULT_CHECKS
    names = {"stg_reviews": "stg", "dim_games": "games", "dim_users": "users", "fact_reviews": "fact",
             "mart_game_sentiment_trends": "mart"}
    parts = []
    for ch in DEFAULT_CHECKS:
        t, c, p = names[ch.table], ch.column, ch.params
        if ch.kind == "not_null":
            q = f"select count(*) from {t} where {c} is null"
        elif ch.kind == "unique":
            q = f"select count(*) from (select {c} from {t} where {c} is not null group by {c} having count(*) > 1)"
        elif ch.kind == "relationships":
            q = (f"select count(*) from {t} x where x.{c} is not null and not exists "
                 f"(select 1 from {names[p['to']]} y where y.{p['field']} = x.{c})")
        elif ch.kind == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in p["values"])
            q = f"select count(*) from {t} where {c} is not null and {c} not in ({vals})"
        else:
            q = f"select count(*) from {t} where {c} is not null and ({c} < {p['lo']!r} or {c} > {p['hi']!r})"
        parts.append(f"select '{ch.name}' as test, '{ch.kind}' as kind, '{ch.table}' as \"table\", "
                     f"'{c}' as \"column\", ({q})::bigint as failures")
    return with_ctes(*SCORED, STG_SQL, GAMES_SQL, USERS_SQL, FACT_SQL, MART_SQL) + "\n" + "\nunion all\n".join(parts)


ORACLE["dq_summary"] = _dq_sql()

# ---- bronze pages -----------------------------------------------------------------------------------------
ORACLE["bronze_flatten"] = with_ctes(REVIEWS_SQL) + """
select recommendationid, steamid, appid, dt, playtime_forever, playtime_at_review, num_reviews, votes_up,
       votes_funny, weighted_vote_score, comment_count, voted_up, timestamp_created, timestamp_updated, language,
       length(review)::bigint as review_length
from reviews_v where dt is not null and appid is not null"""

CONV_PAGES_SQL = r"""
cp as (
  select date '2024-01-01' as dt, conv_id as appid, turn as page_num, role as cursor,
         len(list_filter(string_split(coalesce(text, ''), chr(10)),
                         lambda x: length(regexp_replace(x, '[\s\p{Z}]+', '', 'g')) > 0))::integer as n_reviews
  from conversations
),
cps as (
  select *, coalesce(lag(cursor) over (partition by dt, appid order by page_num), '*') as sent_cursor from cp
),
fs as (select dt, appid, sent_cursor as c, min(page_num) as first_sent from cps group by all),
st as (
  select cps.*, case when coalesce(n_reviews, 0) = 0 then 'empty'
                     when cursor = sent_cursor then 'unchanged_cursor'
                     when coalesce(cursor, '') <> '' and fs.first_sent < page_num then 'revisited_cursor'
                     else 'ok' end as status
  from cps left join fs on fs.dt = cps.dt and fs.appid = cps.appid and fs.c = cps.cursor
),
audit as (
  select *, (min(case when status <> 'ok' then page_num end) over (partition by dt, appid)) as first_stop from st
)"""

ORACLE["page_chain_audit"] = with_ctes(CONV_PAGES_SQL) + """
select dt, appid, page_num, cursor, n_reviews, sent_cursor, status,
       (first_stop is null or page_num < first_stop) as kept
from audit"""

ORACLE["resume_state"] = with_ctes(CONV_PAGES_SQL) + """,
k as (select * from audit where first_stop is null or page_num < first_stop),
s as (select dt, appid, arg_max(cursor, page_num) as next_cursor, max(page_num) + 1 as next_page_num
      from k group by dt, appid)
select c.dt, c.appid, coalesce(s.next_cursor, '*') as next_cursor, coalesce(s.next_page_num, 0)::bigint as next_page_num
from (select distinct dt, appid from audit) c left join s on s.dt = c.dt and s.appid = c.appid"""

ORACLE["app_summary"] = with_ctes(REVIEWS_SQL) + f""",
j as (
  select appid, dt, voted_up,
         (row_number() over (partition by dt, appid order by recommendationid asc nulls last, {_page_order()}) - 1) // 100 as page_num
  from reviews_v where dt is not null and appid is not null
),
pg as (
  select appid, dt, page_num, count(*) as n, count(*) filter (where voted_up) as pos from j group by all
),
latest as (select appid, arg_max(struct_pack(n := n, pos := pos), struct_pack(dt := dt, page_num := page_num)) as q
           from pg group by appid)
select appid, cast(null as varchar) as name, cast(null as bigint) as review_score,
       cast(null as varchar) as review_score_desc, q.n as num_reviews, q.pos as total_positive,
       q.n - q.pos as total_negative, q.n as total_reviews
from latest"""

ORACLE["target_item_restrict"] = with_ctes(REVIEWS_SQL) + """,
pop as (select appid, count(distinct steamid) as pop from reviews_v where steamid is not null group by appid),
t as (select appid from pop order by pop desc, appid asc limit 50)
select appid, count(*) as n_reviews from reviews_v where appid in (select appid from t) group by appid"""

# ---- writes, incremental, retention --------------------------------------------------------------------
ORACLE["partition_overwrite"] = with_ctes(REVIEWS_SQL, DEDUP_SQL, FILTER_SQL, RATED_SQL) + """
select steamid as user_sk, appid, round(max(implicit_rating), 6) as implicit_rating,
       date_trunc('month', dt)::date as dt
from rated group by steamid, appid, date_trunc('month', dt)"""

ORACLE["fact_incremental"] = with_ctes(*SCORED, FACT_SQL) + """
select * replace (round(sentiment_score, 6) as sentiment_score) from fact
where dt >= (select max(dt) from fact where dt < (select max(dt) from fact) - interval 90 day)"""

ORACLE["day_replace_empty"] = with_ctes(REVIEWS_SQL, DEDUP_SQL, FILTER_SQL, RATED_SQL) + """,
m as (select steamid as user_sk, appid, max(implicit_rating) as r, date_trunc('month', dt)::date as dt
      from rated group by all),
a as (select min(dt) as first from m)
select user_sk, appid, round(case when dt = first + interval 1 month then r / 2 else r end, 6) as implicit_rating, dt
from m, a where dt > first"""

_YEARLY = """
yv as (select * replace (date_trunc('year', dt)::date as dt, (appid % 8)::integer as appid) from reviews_v
       where dt is not null and appid is not null),
ydedup as (
  select * exclude (rn) from (
    select *, row_number() over (partition by dt, recommendationid
                                 order by timestamp_updated desc nulls last, {tail}) as rn from yv) where rn = 1),
filt as (
  select * from ydedup
  where language = 'english' and length(regexp_replace(coalesce(review, ''), '[\\s\\p{{Z}}]+', '', 'g')) > 0)"""

ORACLE["bronze_to_silver"] = ORACLE["incremental_silver"] = with_ctes(
    REVIEWS_SQL, _YEARLY.format(tail=_order_tail()), FEAT_SQL) + """
select recommendationid, dt, appid, votes_up, timestamp_updated, review_length, playtime_bucket from feat"""

_TIERS = """
days as (select distinct dt from filt where dt is not null),
aged as (select dt, datediff('day', dt, (select max(dt) from days))::integer as age_days from days)"""

ORACLE["partition_tiers"] = with_ctes(REVIEWS_SQL, DEDUP_SQL, FILTER_SQL, _TIERS) + """
select dt, age_days, case when age_days > 180 then 'expired' when age_days > 30 then 'cold' else 'hot' end as tier
from aged"""

ORACLE["expired_partitions"] = with_ctes(REVIEWS_SQL, DEDUP_SQL, FILTER_SQL, _TIERS) + """
select dt, age_days, 'expired' as tier from aged where age_days > 180"""

ORACLE["seen_anti_join"] = with_ctes(*KEPT, POP_SQL) + """,
need as (select steamid, count(*) + 10 as need from inter group by steamid)
select u.steamid, p.appid from need u join pop p on p.r <= u.need
where not exists (select 1 from inter i where i.steamid = u.steamid and i.appid = p.appid)"""

ORACLE["publish_fixed_scores"] = with_ctes(*KEPT, POP_SQL, TOPN_SQL, KUSERS_SQL, RECS_SQL) + """
select user_sk, ranked_appid, rank, score, generated_at from recs"""

ORACLE["als_shape"] = with_ctes(*KEPT, KUSERS_SQL) + """
select user_sk, least(10, (select count(distinct appid) from inter) - n)::bigint as n_rows, 0::bigint as n_breaks
from (select steamid, count(*) as n from inter group by steamid) join kusers using (steamid)
where (select count(distinct appid) from inter) > n"""

ORACLE["event_interactions"] = f"""
with ev as (
  select cast(user_id as varchar) as steamid, cast(json_extract(props, '$.k') as integer) as appid,
         cast(ts as date) as dt, event_type = 'purchase' as voted_up, value as playtime_at_review
  from events
)
select steamid as user_sk, appid, dt,
       round(max(0.6 * (case when voted_up then 1.0 else 0.0 end)
         + 0.4 * greatest(least(ln(1.0 + greatest(coalesce(playtime_at_review::double, 0.0), 0.0) / 60.0)
                                / ln(1.0 + {fx.BOOST_CAP_HOURS!r}), 1.0), 0.0)), 6) as implicit_rating
from ev group by steamid, appid, dt"""

ORACLE["silver_stage_counts"] = with_ctes(REVIEWS_SQL, DEDUP_SQL, FILTER_SQL) + """
select (select count(*) from reviews_v) as n_raw, (select count(*) from dedup) as n_dedup,
       (select count(*) from filt) as n_filtered, (select sum(length(review)) from reviews_v)::bigint as raw_text_chars"""


# ---- sinks and readers: each table as it is written and read back ------------------------------------------------
ORACLE["dim_users_readback"] = with_ctes(*PLAIN, USERS_SQL) + """
select steamid, user_sk from users"""

ORACLE["dim_games_view"] = ORACLE["dim_games"]

ORACLE["staging_load"] = with_ctes(*SCORED) + """
select recommendationid, steamid, appid, date_trunc('year', dt)::date as dt, length(review)::bigint as n_chars, review_length,
       playtime_bucket, round(sentiment_score, 6) as sentiment_score, sentiment_label from scored"""

ORACLE["fact_write"] = with_ctes(*SCORED, FACT_SQL) + """
select * replace (date_trunc('year', dt)::date as dt, round(sentiment_score, 6) as sentiment_score) from fact
where year(dt) % 2 = 1"""

ORACLE["export_readback"] = with_ctes(*KEPT) + """
select steamid, appid, round(rating, 6) as rating from inter"""

ORACLE["bronze_flatten_day"] = with_ctes(REVIEWS_SQL) + """
select recommendationid, steamid, appid, date '2024-01-01' as dt, votes_up, timestamp_updated from reviews_v"""

ORACLE["items_preview"] = with_ctes(*KEPT, POP_SQL) + """
select appid, pop, r from pop where r <= 20"""

ORACLE["python_scorer"] = f"""
with s as (select doc_id, least(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '!', '')), 10) / 10.0
             - least(length(coalesce(text, '')) - length(replace(coalesce(text, ''), '?', '')), 10) / 10.0 as score from documents)
select doc_id, round(score, 6) as sentiment_score,
       case when score >= {fx.POS_THRESHOLD!r} then 'pos' when score <= {fx.NEG_THRESHOLD!r} then 'neg' else 'neu' end as sentiment_label
from s"""

# ---- mergeable state: the full build over the table as it ends ---------------------------------------------------
HALVES = """
halfmonths as materialized (
  select * replace (date_trunc('month', dt)::date + case when day(dt) > 15 then 15 else 0 end as dt) from scored
  where ((year(dt) * 12 + month(dt)) * 2 + (day(dt) > 15)::int) % 11 <> 3
)"""
_STATE_GAMES, _STATE_USERS, _STATE_MART = (x.replace("from filt", "from halfmonths").replace("from scored", "from halfmonths")
                                           for x in (GAMES_SQL, USERS_SQL, MART_SQL))
ORACLE["state_dim_games"] = with_ctes(*SCORED, HALVES, _STATE_GAMES) + """
select * replace (round(positive_rate, 6) as positive_rate) from games"""
ORACLE["state_dim_users"] = with_ctes(*SCORED, HALVES, _STATE_USERS) + """
select * from users"""
ORACLE["state_trends"] = with_ctes(*SCORED, HALVES, _STATE_MART) + """
select * replace (round(positive_rate, 6) as positive_rate, round(avg_sentiment_score, 6) as avg_sentiment_score) from mart"""

ORACLE["rolling_sentiment"] = with_ctes(*SCORED, """
days as (select appid::bigint as appid, dt, count(*) as n, count(*) filter (where voted_up) as up, sum(sentiment_score) as s,
                count(sentiment_score) as k
         from scored where recommendationid is not null and appid is not null group by appid, dt)""") + """
select appid, dt, sum(n) over w7 as n_7, round(sum(s) over w7 / sum(k) over w7, 6) as avg_sentiment_7,
       round(sum(up) over w7 / sum(n) over w7, 6) as positive_rate_7, sum(n) over w28 as n_28,
       round(sum(s) over w28 / sum(k) over w28, 6) as avg_sentiment_28, round(sum(up) over w28 / sum(n) over w28, 6) as positive_rate_28
from days window w7 as (partition by appid order by dt range between interval 6 days preceding and current row),
                 w28 as (partition by appid order by dt range between interval 27 days preceding and current row)"""

ORACLE["daily_run"] = with_ctes(*SCORED, """
halves as materialized (
  select * replace (case when dt < date '1995-07-01' then date '1995-01-01' else date '1995-07-01' end as dt, appid % 8 as appid)
  from scored)""",
    MART_SQL.replace("from scored", "from halves")) + """
select * replace (round(positive_rate, 6) as positive_rate, round(avg_sentiment_score, 6) as avg_sentiment_score) from mart"""

# ---- joins in time, reconciliation, cubes ------------------------------------------------------------------------
MONTHS_SQL = """
months as (select appid, date_trunc('month', dt)::date as month, count(*) as n, count(*) filter (where voted_up) as up
           from filt group by all)"""
ORACLE["asof_summary"] = with_ctes(*PLAIN, MONTHS_SQL) + """
select r.recommendationid, r.appid, r.dt, m.month, m.n as month_reviews, m.up as month_positive
from filt r asof left join months m on r.appid = m.appid and r.dt - interval 32 days >= m.month"""

ORACLE["interval_matches"] = with_ctes(*PLAIN, """
spans as (select recommendationid, user_id, a, a + (1 + m % 10) * 86400000000 as b from (
  select recommendationid, steamid::bigint as user_id, playtime_at_review as m,
         epoch_us(timestamp '2024-01-01') + (epoch(dt)::bigint // 86400) % 30 * 86400000000 as a from filt))""") + """
select e.event_id, s.recommendationid from events e join spans s
on e.user_id = s.user_id and epoch_us(e.ts) >= s.a and epoch_us(e.ts) < s.b"""

ORACLE["load_difference"] = with_ctes(*PLAIN, """
a as (select dt, recommendationid, appid, votes_up, voted_up from reviews_v),
b as (select dt, recommendationid, appid, case when appid % 7 = 0 then votes_up + 1 else votes_up end as votes_up, voted_up
      from filt where appid % 5 <> 0),
differ as (select dt, recommendationid, appid, votes_up, voted_up, count(*) filter (side = 1) as n_before, count(*) filter (side = 2) as n_after
  from (select *, 1 as side from a union all select *, 2 as side from b)
  group by all having count(*) filter (side = 1) <> count(*) filter (side = 2))""") + """
select *, case when n_before > 0 and n_after > 0 then 'repeated'
  when (dt, recommendationid) in (select (dt, recommendationid) from a) and (dt, recommendationid) in (select (dt, recommendationid) from b)
  then 'changed' when n_before > 0 then 'removed' else 'added' end as kind from differ"""

ORACLE["sketch_bounds"] = with_ctes(*PLAIN) + """
select year(dt)::int as period, count(*) as n_reviews, count(distinct steamid) as n_users, true as users_within,
       true as q25_within, true as q50_within, true as q90_within from filt group by 1"""

ORACLE["event_sessions"] = """
with e as (select user_id, ts, value, lag(ts) over (partition by user_id order by ts) as prev from events),
s as (select *, sum(case when prev is null or ts - prev > interval 30 minutes then 1 else 0 end)
               over (partition by user_id order by ts) as k from e)
select user_id, min(ts) as session_start, max(ts) as last_ts, count(*) as n_events, round(sum(value), 6) as value
from s group by user_id, k"""

ORACLE["review_cube"] = with_ctes(*FEAT) + """
select appid, month, playtime_bucket, grouping(appid, month, playtime_bucket)::bigint as level,
       count(*) as n_reviews, count(*) filter (where voted_up) as n_up, max(votes_up) as max_votes
from (select *, date_trunc('month', dt)::date as month from feat)
group by grouping sets ((appid, month, playtime_bucket), (appid, month), (appid), (month, playtime_bucket), ())"""

ORACLE["page_drift"] = with_ctes(REVIEWS_SQL, """
y as (select year(dt) as year, month(dt) % 2 = 1 as odd, votes_up from reviews_v),
v as (select year, sum(votes_up)::bigint as votes from y group by year),
f as (
  select year, 'recommendationid' as field, 'STRING' as type, count(*) as n, 'known' as status from y group by year
  union all select year, 'voted_up', 'BOOLEAN', count(*), 'known' from y group by year
  union all select year, 'votes_up', case when year % 2 = 0 then 'STRING' else 'BIGINT' end, count(*),
                   case when year % 2 = 0 then 'retyped' else 'known' end from y group by year
  union all select year, 'badge', 'STRING', count(*), 'unknown' from y where odd group by year)""") + """
select year::int as year, field, type, n, status, votes from f join v using (year)"""
