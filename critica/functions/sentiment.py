"""Rule-based lexicon sentiment as native Spark expressions.

The score follows the published rule-based method for short social text (Hutto & Gilbert, ICWSM 2014) in a
reduced form, with every constant a parameter:

* tokens are maximal runs of ``[A-Za-z']``; a token's valence comes from the lexicon (lower-cased), else 0;
* an ALL-CAPS token (two or more characters, no lower-case letter) in text that also has a lower-case letter
  adds ``caps_boost`` in the direction of its valence;
* a booster / dampener among the three preceding tokens adds its value (scaled 1, 0.95, 0.9 by distance) in the
  direction of the valence;
* a negator among the three preceding tokens multiplies the valence by ``negation_scalar``;
* around the first ``but``: valences before it are multiplied by 0.5, after it by 1.5;
* the valences are summed; up to four ``!`` add ``exclaim_boost`` each in the direction of the sum;
* compound = s / sqrt(s^2 + alpha), so it lies in (-1, 1); empty or NULL text -> 0.0.

This is not the third-party analyser's output (its lexicon is not bundled); it has the same shape and labels.

Two native forms compute the same score:

* :func:`add_sentiment` (default): tokens become rows (``posexplode``) and are filtered at once to the few that
  matter (lexicon words, modifiers, ``but``) by a hash join with the lexicon table; a window over the token
  position supplies the three-token context and the per-text sum. When the input is already hash-partitioned by
  the row key (as after dedup), the windows add no shuffle.
* :func:`lexicon_score`: one ``aggregate`` fold inside a single row, over the tokens that the rules know (no key and no
  shuffle needed): a text is scored where it is read and need not travel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from critica.functions.features import sentiment_label

# ---------------------------------------------------------------------------------------------------------
# Default lexicon (word -> valence on a -4..+4 scale, after the word ratings published with Hutto &
# Gilbert, ICWSM 2014), modifiers and rule constants.
# ---------------------------------------------------------------------------------------------------------
DEFAULT_LEXICON: dict[str, float] = {
    "good": 1.9, "great": 3.1, "love": 3.2, "loved": 2.9, "loves": 2.7, "best": 3.2, "better": 1.9,
    "awesome": 3.1, "amazing": 2.8, "excellent": 2.7, "fantastic": 2.6, "wonderful": 2.7, "perfect": 2.7,
    "beautiful": 2.9, "fun": 2.3, "enjoy": 2.2, "enjoyed": 2.3, "nice": 1.8, "happy": 2.7, "like": 1.5,
    "recommend": 1.5, "recommended": 1.6, "masterpiece": 3.1, "brilliant": 2.8, "solid": 1.2, "cool": 1.3,
    "worth": 0.9, "polished": 1.4, "charming": 2.1, "addictive": 0.6, "glad": 2.0, "win": 2.8,
    "bad": -2.5, "worse": -2.1, "worst": -3.1, "terrible": -2.1, "awful": -2.0, "horrible": -2.5,
    "hate": -2.7, "hated": -3.2, "boring": -1.3, "poor": -2.1, "sad": -2.1, "ugly": -2.3, "waste": -1.8,
    "trash": -1.6, "garbage": -2.1, "broken": -1.8, "buggy": -1.6, "crash": -1.7, "crashes": -1.7,
    "annoying": -1.6, "disappointing": -2.2, "disappointed": -1.9, "refund": -0.8, "lag": -0.9,
    "unplayable": -2.3, "pointless": -1.7, "mediocre": -1.3, "fail": -2.5, "lose": -1.4, "problem": -1.7,
}
DEFAULT_BOOSTERS: dict[str, float] = {
    "absolutely": 0.293, "amazingly": 0.293, "completely": 0.293, "extremely": 0.293, "really": 0.293,
    "very": 0.293, "so": 0.293, "totally": 0.293, "incredibly": 0.293, "highly": 0.293, "super": 0.293,
    "truly": 0.293, "most": 0.293, "especially": 0.293,
    "barely": -0.293, "hardly": -0.293, "slightly": -0.293, "somewhat": -0.293, "marginally": -0.293,
    "partly": -0.293, "scarcely": -0.293, "little": -0.293,
}
DEFAULT_NEGATORS: tuple[str, ...] = (
    "not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere", "cannot", "without",
    "isn't", "aren't", "wasn't", "weren't", "don't", "doesn't", "didn't", "can't", "won't", "wouldn't",
    "shouldn't", "couldn't", "isnt", "arent", "wasnt", "dont", "doesnt", "didnt", "cant", "wont",
)
TOKEN_PATTERN = "[A-Za-z']+"
CAPS_BOOST = 0.733
NEGATION_SCALAR = -0.74
BOOSTER_DISTANCE_SCALE = (1.0, 0.95, 0.9)
BUT_WORD = "but"
BEFORE_BUT = 0.5
AFTER_BUT = 1.5
EXCLAIM_BOOST = 0.292
EXCLAIM_MAX = 4
ALPHA = 15.0


@dataclass(frozen=True)
class LexiconScorer:
    lexicon: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_LEXICON))
    boosters: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_BOOSTERS))
    negators: tuple[str, ...] = DEFAULT_NEGATORS
    caps_boost: float = CAPS_BOOST
    negation_scalar: float = NEGATION_SCALAR
    booster_scale: tuple[float, float, float] = BOOSTER_DISTANCE_SCALE
    before_but: float = BEFORE_BUT
    after_but: float = AFTER_BUT
    exclaim_boost: float = EXCLAIM_BOOST
    exclaim_max: int = EXCLAIM_MAX
    alpha: float = ALPHA

    def score(self, text: Column) -> Column:
        return lexicon_score(text, self)


def _is_caps(t: Column) -> Column:
    return (t == F.upper(t)) & (t != F.lower(t)) & (F.length(t) >= F.lit(2))


def _map_literal(d: dict[str, float]) -> Column:
    """A constant map as one JSON literal (constant-folded once by Catalyst; one call to build)."""
    import json
    return F.from_json(F.lit(json.dumps({k: float(v) for k, v in sorted(d.items())})), "map<string,double>")


def _array_literal(words) -> Column:
    import json
    return F.from_json(F.lit(json.dumps(list(words))), "array<string>")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), 0)


def lexicon_score(text: Column, sc: LexiconScorer | None = None, toks: Column | None = None) -> Column:
    """Compound sentiment score in (-1, 1) for a text column, as one native expression.

    ``toks`` may name an already computed token column, so the tokeniser runs once per row. Tokens that the rules do not
    know leave by one hash lookup; the fold sees the few others with their positions. It remembers the last three of
    them, which hold every modifier within three tokens, and sums up twice: plainly, and as if a later ``but`` came.
    """
    sc = sc or LexiconScorer()
    txt = F.coalesce(text, F.lit(""))
    toks = tokens(text) if toks is None else toks
    lex = _map_literal(sc.lexicon)
    boost = _map_literal(sc.boosters)
    negs = _array_literal(sc.negators)
    words = sorted(set(sc.lexicon) | set(sc.boosters) | set(sc.negators) | {BUT_WORD})
    known = F.filter(F.transform(toks, lambda t, i: F.when(F.lower(t).isin(words), F.struct(t.alias("t"), i.alias("i")))),
                     lambda x: x.isNotNull())
    zero, no = F.lit(0.0), F.lit(False)
    init = F.struct(
        zero.alias("s"), zero.alias("sb"), no.alias("but"),
        *[c for k in (1, 2, 3) for c in (F.lit(-9).alias(f"p{k}"), zero.alias(f"b{k}"), no.alias(f"n{k}"))],
        txt.rlike("[a-z]").alias("m"), _exclaim(txt, sc).alias("e"))

    def merge(acc: Column, x: Column) -> Column:
        low = F.lower(x["t"])
        v0 = F.coalesce(F.try_element_at(lex, low), zero)
        sgn = F.signum(v0)
        boost_sum, neg_any = zero, no
        for k in (1, 2, 3):
            dist = x["i"] - acc[f"p{k}"]
            near = dist <= F.lit(3)
            scale = (F.when(dist == 1, F.lit(float(sc.booster_scale[0]))).when(dist == 2, F.lit(float(sc.booster_scale[1])))
                     .otherwise(F.lit(float(sc.booster_scale[2]))))
            boost_sum = boost_sum + F.when(near, acc[f"b{k}"] * scale).otherwise(zero)
            neg_any = neg_any | (near & acc[f"n{k}"])
        v1 = v0 + F.when(_is_caps(x["t"]) & acc["m"], sgn * F.lit(sc.caps_boost)).otherwise(zero)
        v2 = v1 + sgn * boost_sum
        v3 = F.when(v0 == zero, zero).otherwise(F.when(neg_any, v2 * F.lit(sc.negation_scalar)).otherwise(v2))
        # the word itself, if the lexicon holds it, stands neither before nor after the first "but"
        is_but = low == F.lit(BUT_WORD)
        around = F.when(acc["but"], v3 * F.lit(sc.after_but)).when(is_but, v3).otherwise(v3 * F.lit(sc.before_but))
        return F.struct(
            (acc["s"] + v3).alias("s"), (acc["sb"] + around).alias("sb"), (acc["but"] | is_but).alias("but"),
            x["i"].alias("p1"), F.coalesce(F.try_element_at(boost, low), zero).alias("b1"),
            F.array_contains(negs, low).alias("n1"),
            *[acc[f"{c}{k - 1}"].alias(f"{c}{k}") for k in (2, 3) for c in "pbn"],
            acc["m"].alias("m"), acc["e"].alias("e"))

    def finish(acc: Column) -> Column:
        total = F.when(acc["but"], acc["sb"]).otherwise(acc["s"])
        s = total + F.signum(total) * acc["e"]
        return F.greatest(F.least(s / F.sqrt(s * s + F.lit(sc.alpha)), F.lit(1.0)), F.lit(-1.0))

    return F.aggregate(known, init, merge, finish)


def _exclaim(txt: Column, sc: LexiconScorer) -> Column:  # noqa: D103
    n = F.least(F.length(txt) - F.length(F.replace(txt, F.lit("!"), F.lit(""))), F.lit(sc.exclaim_max))
    return n.cast("double") * F.lit(sc.exclaim_boost)


def pandas_scorer(make_scorer):
    """Wrap a Python scorer as an Arrow-batched *iterator* pandas UDF: ``make_scorer()`` runs once per task (a
    model or analyser is built once, not per batch), then scores every batch of texts. Plug it into
    :func:`add_sentiment` as ``scorer=`` when a model must replace the lexicon rules."""
    from collections.abc import Iterator

    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    def score(batches):
        fn = make_scorer()
        for texts in batches:
            yield pd.Series([float(fn(t or "")) for t in texts], dtype="float64")

    # real (not string) annotations: they tell Spark this is the iterator-of-batches form
    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return pandas_udf(score, "double")


def add_sentiment(df: DataFrame, text_col: str = "review", scorer=None, keys: list[str] | None = None,
                  score_col: str = "sentiment_score", label_col: str = "sentiment_label") -> DataFrame:
    """Add ``sentiment_score`` (double) and ``sentiment_label`` (pos/neu/neg).

    With ``keys`` (columns that identify a row) the token-row form is used, without them the per-row fold.
    ``scorer`` may be a :class:`LexiconScorer` or any callable ``Column -> Column`` (for example a pandas UDF
    wrapping a model); the label rule is shared.
    """
    if scorer is not None and not isinstance(scorer, LexiconScorer):
        out = df.withColumn(score_col, scorer(F.col(text_col)).cast("double"))
    elif keys:
        out = _token_row_sentiment(df, list(keys), text_col, scorer or LexiconScorer(), score_col)
    else:
        tok = "__sentiment_tokens"
        out = (df.withColumn(tok, tokens(F.col(text_col)))
               .withColumn(score_col, lexicon_score(F.col(text_col), scorer, F.col(tok)))
               .drop(tok))
    return out.withColumn(label_col, sentiment_label(score_col))


def lexicon_frame(spark, sc: LexiconScorer) -> DataFrame:
    """(w, v, b, n): valence, booster value and negator flag per word that the rules know, ``but`` included."""
    import json

    words = sorted(set(sc.lexicon) | set(sc.boosters) | set(sc.negators) | {BUT_WORD})
    negators = set(sc.negators)
    rows = json.dumps([{"w": w, "v": float(sc.lexicon.get(w, 0.0)), "b": float(sc.boosters.get(w, 0.0)),
                        "n": w in negators} for w in words])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<w:string,v:double,b:double,n:boolean>>")))


def _token_row_sentiment(df: DataFrame, keys: list[str], text_col: str, sc: LexiconScorer,
                         score_col: str) -> DataFrame:
    """Every input row becomes one *anchor* row (its first token, or no token) that keeps all columns, plus one row
    per further token that the rules know, which keeps only the keys. Tokens meet the lexicon in a hash join with its
    table (as large as the lexicon, so it may hold thousands of words), and two windows give each token its
    three-token context and the anchor the row's total; then only anchors are kept.

    The windows are keyed by ``keys`` and a row id: rows may share their keys, and the partitioning that the dedup
    window left behind still serves (no shuffle).
    """
    cols = df.columns
    lexicon = F.broadcast(lexicon_frame(df.sparkSession, sc))
    txt = F.coalesce(F.col(text_col), F.lit(""))

    gen = df.select("*", F.monotonically_increasing_id().alias("__row")).select(
        "*", txt.rlike("[a-z]").alias("__m"), _exclaim(txt, sc).alias("__e"),
        F.posexplode_outer(tokens(F.col(text_col))).alias("__pos", "__tok"))
    anchor = F.coalesce(F.col("__pos"), F.lit(0)) == F.lit(0)
    gen = gen.withColumn("__lw", F.lower(F.col("__tok"))).join(lexicon, F.col("__lw") == F.col("w"), "left")
    gen = gen.where(anchor | F.col("w").isNotNull()).select(
        *[F.col(c) if c in keys else F.when(anchor, F.col(c)).alias(c) for c in cols],
        "__row", anchor.alias("__a"), F.col("__m"), F.col("__e"),
        F.coalesce(F.col("__pos"), F.lit(0)).alias("__pos"),
        F.coalesce("v", F.lit(0.0)).alias("__v"),
        F.coalesce("b", F.lit(0.0)).alias("__b"),
        F.coalesce("n", F.lit(False)).alias("__n"),
        F.coalesce(_is_caps(F.col("__tok")), F.lit(False)).alias("__c"),
        F.coalesce(F.col("w") == F.lit(BUT_WORD), F.lit(False)).alias("__but"),
    )
    w = Window.partitionBy(*keys, "__row").orderBy("__pos")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.struct(F.col("__pos").alias("pos"), F.col("__b").alias("b"), F.col("__n").alias("n"))
    ctx = gen.select("*", F.min(F.when(F.col("__but"), F.col("__pos"))).over(whole).alias("__p"),
                     *[F.lag(before, k).over(w).alias(f"__l{k}") for k in (1, 2, 3)])
    v0 = F.col("__v")
    sgn = F.signum(v0)
    boost_sum, neg_any = F.lit(0.0), F.lit(False)
    for k in (1, 2, 3):
        prev = F.col(f"__l{k}")
        dist = F.col("__pos") - prev["pos"]
        near = F.coalesce(dist <= F.lit(3), F.lit(False))
        scale = (F.when(dist == 1, F.lit(float(sc.booster_scale[0])))
                 .when(dist == 2, F.lit(float(sc.booster_scale[1])))
                 .otherwise(F.lit(float(sc.booster_scale[2]))))
        boost_sum = boost_sum + F.when(near, prev["b"] * scale).otherwise(F.lit(0.0))
        neg_any = neg_any | (near & prev["n"])
    v1 = v0 + F.when(F.col("__c") & F.col("__m"), sgn * F.lit(sc.caps_boost)).otherwise(F.lit(0.0))
    v2 = v1 + sgn * boost_sum
    v3 = F.when(neg_any, v2 * F.lit(sc.negation_scalar)).otherwise(v2)
    p = F.col("__p")
    v4 = (F.when(p.isNotNull() & (F.col("__pos") < p), v3 * F.lit(sc.before_but))
          .when(p.isNotNull() & (F.col("__pos") > p), v3 * F.lit(sc.after_but))
          .otherwise(v3))
    contrib = F.when(v0 != F.lit(0.0), v4).otherwise(F.lit(0.0))
    total = ctx.withColumn("__x", contrib).withColumn("__s0", F.sum("__x").over(whole)).where(F.col("__a"))
    s = F.col("__s0") + F.signum(F.col("__s0")) * F.col("__e")
    score = F.greatest(F.least(s / F.sqrt(s * s + F.lit(sc.alpha)), F.lit(1.0)), F.lit(-1.0))
    return total.select(*cols, score.alias(score_col))


# ---------------------------------------------------------------------------------------------------------
# SQL form of the same rules, for an independent engine (used by the oracle). Token positions come from
# unnest + window lags instead of a fold, so agreement checks the semantics, not shared code.
# ---------------------------------------------------------------------------------------------------------
def sentiment_sql(source: str, id_col: str, text_col: str, sc: LexiconScorer | None = None) -> str:
    """DuckDB SQL producing (id, sentiment_score) for every row of ``source``."""
    sc = sc or LexiconScorer()

    def values(d: dict[str, float]) -> str:
        return ", ".join(f"('{k.replace(chr(39), chr(39) * 2)}', {float(v)!r})" for k, v in sorted(d.items()))

    negs = ", ".join("'" + w.replace("'", "''") + "'" for w in sc.negators)
    s1, s2, s3 = sc.booster_scale
    return f"""
with lex(w, v) as (values {values(sc.lexicon)}),
boost(w, b) as (values {values(sc.boosters)}),
src as (select {id_col} as sid, coalesce({text_col}, '') as txt from {source}),
tk as (
  select sid, regexp_extract_all(txt, '{TOKEN_PATTERN.replace("'", "''")}') as toks,
         regexp_matches(txt, '[a-z]') as m,
         least(length(txt) - length(replace(txt, '!', '')), {sc.exclaim_max}) as n_excl
  from src),
u as (
  select sid, n_excl, m, unnest(toks) as tok, generate_subscripts(toks, 1) as pos from tk),
f as (
  select u.sid, u.pos, u.tok, u.m, lower(u.tok) as lw,
         coalesce(lex.v, 0.0) as v, coalesce(boost.b, 0.0) as b,
         lower(u.tok) in ({negs}) as n,
         (u.tok = upper(u.tok) and u.tok <> lower(u.tok) and length(u.tok) >= 2) as c
  from u left join lex on lex.w = lower(u.tok) left join boost on boost.w = lower(u.tok)),
d as (
  select sid, coalesce(min(pos) filter (where lw = '{BUT_WORD}'), 0) as p from f group by sid),
w as (
  select f.*, d.p,
         coalesce(lag(b, 1) over o, 0.0) as b1, coalesce(lag(b, 2) over o, 0.0) as b2,
         coalesce(lag(b, 3) over o, 0.0) as b3,
         coalesce(lag(n, 1) over o, false) or coalesce(lag(n, 2) over o, false)
           or coalesce(lag(n, 3) over o, false) as neg
  from f join d using (sid)
  window o as (partition by f.sid order by f.pos)),
c as (
  select sid,
    case when v = 0.0 then 0.0 else
      (case when neg then
         (v + case when c and m then sign(v) * {sc.caps_boost!r} else 0.0 end
            + sign(v) * (b1 * {float(s1)!r} + b2 * {float(s2)!r} + b3 * {float(s3)!r})) * {sc.negation_scalar!r}
       else
         (v + case when c and m then sign(v) * {sc.caps_boost!r} else 0.0 end
            + sign(v) * (b1 * {float(s1)!r} + b2 * {float(s2)!r} + b3 * {float(s3)!r}))
       end)
      * case when p > 0 and pos < p then {sc.before_but!r} when p > 0 and pos > p then {sc.after_but!r} else 1.0 end
    end as contrib
  from w),
agg as (select sid, sum(contrib) as s from c group by sid),
tot as (
  select tk.sid, coalesce(agg.s, 0.0) as s0, tk.n_excl from tk left join agg on agg.sid = tk.sid),
fin as (
  select sid,
         case when s0 > 0 then s0 + n_excl * {sc.exclaim_boost!r}
              when s0 < 0 then s0 - n_excl * {sc.exclaim_boost!r} else s0 end as s
  from tot)
select sid as {id_col}, greatest(least(s / sqrt(s * s + {sc.alpha!r}), 1.0), -1.0) as sentiment_score from fin
"""
