"""Derived review columns as native Column expressions (no UDFs).

E1 review_length, E2 playtime_hours, E3 playtime_bucket, E4 helpfulness_ratio,
E5 voted_up_score, E6 playtime_boost, E7 implicit_rating, E9 sentiment label.
All literals are doubles so Spark and a SQL oracle agree to the last digit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the feature semantics
MINUTES_PER_HOUR = 60.0
PLAYTIME_BUCKETS = [(1.0, "< 1hr"), (10.0, "1-10hr"), (100.0, "10-100hr")]
PLAYTIME_BUCKET_TOP = "100+hr"
BOOST_CAP_HOURS = 500.0
VOTE_WEIGHT = 0.6
BOOST_WEIGHT = 0.4
POS_THRESHOLD = 0.05
NEG_THRESHOLD = -0.05

LOG_CAP = math.log(1.0 + BOOST_CAP_HOURS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def review_length(review="review") -> Column:
    """Characters (not bytes) of the review text, as bigint; NULL text -> NULL."""
    return F.length(_c(review)).cast("bigint")


def playtime_hours(minutes="playtime_at_review") -> Column:
    return (_c(minutes).cast("double") / F.lit(MINUTES_PER_HOUR)).cast("double")


def playtime_bucket(hours="playtime_hours") -> Column:
    h = _c(hours)
    expr = None
    for bound, label in PLAYTIME_BUCKETS:
        expr = F.when(h < F.lit(bound), F.lit(label)) if expr is None else expr.when(h < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(PLAYTIME_BUCKET_TOP))


def helpfulness_ratio(votes_up="votes_up", votes_funny="votes_funny") -> Column:
    up = _c(votes_up).cast("double")
    funny = _c(votes_funny).cast("double")
    return up / (up + funny + F.lit(1.0))


def voted_up_score(voted_up="voted_up") -> Column:
    """1.0 for an up-vote, 0.0 otherwise (NULL counts as 0.0)."""
    return F.when(_c(voted_up), F.lit(1.0)).otherwise(F.lit(0.0))


def playtime_boost(minutes="playtime_at_review") -> Column:
    """ln(1 + hours) / ln(1 + cap), clamped to [0, 1]; NULL or negative minutes count as 0."""
    m = F.greatest(F.coalesce(_c(minutes).cast("double"), F.lit(0.0)), F.lit(0.0))
    raw = F.log(F.lit(1.0) + m / F.lit(MINUTES_PER_HOUR)) / F.lit(LOG_CAP)
    return F.greatest(F.least(raw, F.lit(1.0)), F.lit(0.0))


def implicit_rating(voted_up="voted_up", minutes="playtime_at_review") -> Column:
    return F.lit(VOTE_WEIGHT) * voted_up_score(voted_up) + F.lit(BOOST_WEIGHT) * playtime_boost(minutes)


def sentiment_label(score="sentiment_score") -> Column:
    s = _c(score)
    return (F.when(s >= F.lit(POS_THRESHOLD), F.lit("pos"))
            .when(s <= F.lit(NEG_THRESHOLD), F.lit("neg"))
            .otherwise(F.lit("neu")))


def non_blank(text="review") -> Column:
    """True when the text has at least one character that is not whitespace (incl. NBSP / U+3000).

    Written as a search for the first non-whitespace character, which stops at once on real text; stripping
    all whitespace and measuring the rest gives the same answer but rewrites every text (6x slower measured).
    """
    return F.coalesce(_c(text), F.lit("")).rlike(r"[^\s\p{Z}]")
