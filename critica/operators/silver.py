"""Bronze -> silver operators: flatten (P1-P4), deduplicate (W1), junk filter (P5, P6), features, sentiment.

Order matters and is kept: dedup first, then the junk filter, so the *latest* version of a review decides
whether it is kept (an English review whose latest edit is blank or in another language is dropped).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critica.functions import features as fx
from critica.functions.sentiment import LexiconScorer, add_sentiment, lexicon_score, sentiment_label
from critica.schemas import FLAT_COLUMNS, FLAT_SCHEMA

# Tie-breakers after the newest timestamp_updated. With the md5 of the text they cover every column of a review, so
# the version that wins never depends on row order, and the text itself is never a sort key.
DEDUP_TIE_BREAKERS = ("appid", "steamid", "num_reviews", "votes_up", "votes_funny", "playtime_at_review",
                      "timestamp_created", "language", "voted_up", "weighted_vote_score", "comment_count",
                      "playtime_forever", "steam_purchase", "received_for_free", "written_during_early_access")
TEXT_KEY = "review_key"

# Where a flat column comes from in a page's review, if not from the field of the same name, and the
# counts whose missing values are zero
AUTHOR_FIELDS = frozenset({"steamid", "playtime_forever", "playtime_at_review", "num_reviews"})
ZERO_FILLED = AUTHOR_FIELDS - {"steamid"} | {"votes_up", "votes_funny", "comment_count"}


def flatten_reviews(pages: DataFrame, dt: str | None = None, appid_col: str | None = "appid",
                    file_col: str | None = None) -> DataFrame:
    """One row per review from pages holding ``reviews: array<struct>``, in the shape of FLAT_SCHEMA.

    Every field is ``try_cast`` to its contract type, so a malformed value becomes NULL instead of failing the job,
    and missing counts become 0. ``appid`` comes from a partition column (``appid_col``) or, if absent, from
    ``appid=<n>`` in the file path column ``file_col``; ``dt`` is a literal (one run = one day) or the partition
    column when ``dt`` is None.
    """
    if appid_col and appid_col in pages.columns:
        appid = F.col(appid_col)
    elif file_col:
        appid = F.regexp_extract(F.col(file_col), r"appid=(\d+)", 1)
    else:
        appid = F.lit(None)
    given = {"appid": appid.try_cast("int"), "dt": F.col("dt").try_cast("date") if dt is None else F.to_date(F.lit(dt))}

    def field(f: T.StructField) -> Column:
        if f.name in given:
            return F.col(f.name)
        place = F.col("review_")["author"] if f.name in AUTHOR_FIELDS else F.col("review_")
        value = place[f.name].try_cast(f.dataType)
        return (F.coalesce(value, F.lit(0).cast(f.dataType)) if f.name in ZERO_FILLED else value).alias(f.name)

    one = pages.select(F.explode("reviews").alias("review_"), *[c.alias(n) for n, c in given.items()])
    return one.select(*map(field, FLAT_SCHEMA.fields))


def deduplicate(df: DataFrame, key: str = "recommendationid", newest: str = "timestamp_updated",
                within: Sequence[str] = ("dt",), tie_breakers: Sequence[str] = DEDUP_TIE_BREAKERS,
                map_side_limit: bool = True) -> DataFrame:
    """Keep the most recently updated row per key (per ``within`` group, i.e. per day).

    One shuffle: a window partitioned by (within..., key) ordered by newest first. NULL timestamps sort last,
    so any dated version wins; ties are broken by the given columns and at last by the md5 of the text
    (``review_key`` if the frame carries it, else computed from ``review``).

    ``map_side_limit=True`` (default) writes the filter as ``row_number() = 1``, which Catalyst turns into a
    partial WindowGroupLimit: every map task keeps one row per key *before* the shuffle, so a key with a huge
    number of versions sends at most one row per task (skew-safe). The price is a map-side sort of the rows;
    ``map_side_limit=False`` skips it by keeping the first row of each window with a ``lag`` test, which Catalyst
    does not rewrite.
    """
    parts = [c for c in within if c in df.columns] + [key]
    order = [F.col(newest).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_breakers
                                                 if c in df.columns and c not in parts]
    own_key = TEXT_KEY not in df.columns and "review" in df.columns
    d = df.withColumn(TEXT_KEY, F.md5("review")) if own_key else df
    if TEXT_KEY in d.columns:
        order.append(F.col(TEXT_KEY).asc_nulls_last())
    w = Window.partitionBy(*parts).orderBy(*order)
    if map_side_limit:
        out = d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    else:
        out = d.withColumn("_prev", F.lag(F.lit(1), 1).over(w)).filter(F.col("_prev").isNull()).drop("_prev")
    return out.drop(TEXT_KEY) if own_key else out


def filter_junk(df: DataFrame, language: str | None = "english",
                extra_predicates: Sequence[Column] = ()) -> DataFrame:
    """Keep reviews in the target language whose text has a non-whitespace character (``has_text`` where the frame
    carries that flag instead of the text)."""
    cond = F.col("has_text") if "has_text" in df.columns else fx.non_blank("review")
    if language is not None:
        cond = (F.col("language") == F.lit(language)) & cond
    for p in extra_predicates:
        cond = cond & p
    return df.filter(cond)


def add_derived_features(df: DataFrame) -> DataFrame:
    return add_playtime_features(df.select("*", fx.review_length("review").alias("review_length")))


def add_playtime_features(df: DataFrame) -> DataFrame:
    """The derived features that do not come from the text."""
    return df.withColumn("playtime_hours", fx.playtime_hours("playtime_at_review")) \
        .withColumn("playtime_bucket", fx.playtime_bucket("playtime_hours")) \
        .withColumn("helpfulness_ratio", fx.helpfulness_ratio("votes_up", "votes_funny"))


SILVER_ORDER = [c for c in FLAT_COLUMNS if c != "dt"] + [
    "review_length", "playtime_hours", "playtime_bucket", "helpfulness_ratio",
    "sentiment_score", "sentiment_label", "dt"]


class SilverStats:
    """Stage counts of one silver run, filled by the single action that consumes the silver output."""

    def __init__(self):
        self.raw = Observation("n_raw")
        self.dedup = Observation("n_dedup")
        self.filtered = Observation("n_filtered")
        self.pages: Observation | None = None

    def watch_pages(self, pages: DataFrame) -> DataFrame:
        """Count the page files of the run, and those that could not be parsed, while they are read."""
        self.pages = Observation("n_pages")
        return pages.observe(self.pages, F.count(F.lit(1)).alias("n"),
                             F.count_if(F.col("_corrupt_record").isNotNull()).alias("corrupt"))

    def get(self) -> dict[str, int]:
        raw = self.raw.get
        pages = self.pages.get if self.pages is not None else None
        seen = {} if pages is None else {"n_pages": int(pages["n"]), "n_corrupt_pages": int(pages["corrupt"])}
        return {**seen, "n_raw": int(raw["n"]), "n_dedup": int(self.dedup.get["n"]),
                "n_filtered": int(self.filtered.get["n"]), "raw_text_chars": int(raw["chars"] or 0)}


def silver(flat: DataFrame, language: str | None = "english", scorer: LexiconScorer | None = None,
           stats: SilverStats | None = None, extra_predicates: Sequence[Column] = ()) -> DataFrame:
    """flat reviews -> silver rows (25 columns).

    What a text decides - the junk filter, the dedup tie-breaker, its length, its sentiment - is worked out where the
    text is read, so the dedup shuffle carries texts only for readers of the ``review`` column. Only texts that can be
    kept are scored. A scorer other than the lexicon rules sees the kept rows alone, after the shuffle.

    Stage counts (rows in, after dedup, after the junk filter) are collected with ``Observation`` while the
    output is written: one pass over the input, nothing cached.
    """
    flat = flat.select(*FLAT_COLUMNS)
    if stats is not None:
        flat = flat.observe(stats.raw, F.count(F.lit(1)).alias("n"), F.sum(F.length("review")).alias("chars"))
    early = scorer is None or isinstance(scorer, LexiconScorer)
    has_text = fx.non_blank("review")
    wanted = has_text if language is None else has_text & (F.col("language") == F.lit(language))
    about_text = {"has_text": has_text, TEXT_KEY: F.md5("review"), "review_length": fx.review_length("review")}
    if early:
        about_text["sentiment_score"] = F.when(wanted, lexicon_score(F.col("review"), scorer))
    # a version that the junk filter rejects still takes part in dedup, but its text does not travel
    about_text["review"] = F.when(wanted, F.col("review"))
    d = deduplicate(flat.withColumns(about_text))
    if stats is not None:
        d = d.observe(stats.dedup, F.count(F.lit(1)).alias("n"))
    f = add_playtime_features(filter_junk(d, language, extra_predicates))
    out = f.withColumn("sentiment_label", sentiment_label("sentiment_score")) if early else add_sentiment(f, "review", scorer)
    out = out.select(*SILVER_ORDER)
    if stats is not None:
        out = out.observe(stats.filtered, F.count(F.lit(1)).alias("n"))
    return out
