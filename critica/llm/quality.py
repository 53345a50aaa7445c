"""Operator 4 [native]: quality rules with adaptive thresholds from mergeable quantile sketches.

Fixed base rules reject documents with under 50 words or with more than half of their words in repeated three-word
windows. Instead of further fixed cutoffs, every (language, source) gets its own fences per ratio: quartiles plus
``FENCE`` interquartile ranges. Quartiles come from integer histograms with a relative bin width of 1/32, which merge by
adding counts, so they are exact to a bin, do not depend on partitioning, and cover every document that passes the base
rules. A group with under ``MIN_GROUP`` documents takes the merged sketch of its language, a language with too few that
of the corpus. Fences have a least width per ratio (``RATIOS``), so a group of uniform documents keeps small deviations.

Scale: ratios are computed where the texts are read and stored narrow; histograms are pre-aggregated by map tasks, so a
source that holds a third of all rows adds no more than its bins per task; the fences, one row per group, are joined by
broadcast below ``BROADCAST_GROUPS`` groups and by a salted join above.

Defined results: null, empty and blank texts have zero words and fail the base; null languages and sources form groups
of their own; repeated rows are judged alike; an empty table gives an empty result; extra columns are ignored by
``quality_rules`` and pass through ``keep_quality``; texts of any length are counted whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from critica.llm.common import has_word, read, stored, with_row_id, words_array

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FENCE = 3
MIN_GROUP = 50
BROADCAST_GROUPS = 50_000
SALTS = 16
SYMBOLS = "[#*$%&|<>]"
# ratio (in thousandths) -> (numerator, denominator, least width of the fence step, lower fence too)
RATIOS = {
    "mean_word": ("word_chars", "n_words", 500, True),
    "symbols": ("n_symbols", "n_words", 60, False),
    "bangs": ("n_bangs", "n_words", 60, False),
    "dup_lines": ("n_dup_lines", "n_lines", 200, False),
    "repeats": ("n_repeat_words", "n_words", 120, False),
}
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words):
    """Number of words inside three-word windows that occur at least twice (first occurrence included).

    Windows are sorted with their positions; equal neighbours mark the positions they cover.
    """

    def covered(w):
        n = F.size(w)
        windows = F.zip_with(F.zip_with(F.slice(w, 1, n - 2), F.slice(w, 2, n - 2), lambda a, b: F.concat_ws(" ", a, b)),
                             F.slice(w, 3, n - 2), lambda ab, c: F.concat_ws(" ", ab, c))
        return F.transform(windows, lambda s, i: F.struct(s.alias("s"), i.alias("i")))

    def marks(a, b):
        i, j = a["i"], b["i"]
        return F.when(a["s"] == b["s"], F.array(i, i + 1, i + 2, j, j + 1, j + 2)) \
            .otherwise(F.array().cast("array<int>"))

    def count(s):
        return F.size(F.array_distinct(F.flatten(F.zip_with(
            F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), marks))))

    # lambdas over one-element arrays bind the word array and the sorted windows once
    bound = F.transform(F.array(words), lambda w: F.when(F.size(w) > 3, F.sort_array(covered(w))))
    return F.coalesce(F.transform(bound, lambda s: F.when(F.size(s) > 1, count(s)))[0], F.lit(0)).cast("bigint")


def measures(text):
    """Named count columns of a text column."""
    t = F.coalesce(text, F.lit(""))

    def all_counts(w, lines):
        real = F.filter(lines, has_word)
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("bigint").alias("n_bangs"),
            F.size(real).cast("bigint").alias("n_lines"),
            (F.size(real) - F.size(F.array_distinct(real))).cast("bigint").alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"))

    return F.transform(F.array(words_array(text)), lambda w: all_counts(w, F.split(t, "\n", -1)))[0]


def measured(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
             prefix: str = "") -> DataFrame:
    """``docs`` with the count columns, base_failed, the group (g_lang, g_source) and the ratios in thousandths."""
    m = docs.withColumn(f"{prefix}m", measures(F.col(text_col).cast("string")))
    for c in (*BASE_COLUMNS, "n_bangs", "n_lines"):
        m = m.withColumn(prefix + c, F.col(f"{prefix}m")[c])
    words = F.col(prefix + "n_words")
    m = m.withColumn(prefix + "base_failed", (words < MIN_WORDS)
                     | (100 * F.col(prefix + "n_repeat_words") > MAX_REPEAT_PERCENT * words))
    for name, (over, under, _, _) in RATIOS.items():
        m = m.withColumn(prefix + name, F.when(F.col(prefix + under) > 0, F.expr(
            f"1000 * `{prefix}{over}` div `{prefix}{under}`")).otherwise(F.lit(0).cast("bigint")))
    return (m.withColumn(prefix + "g_lang", F.col(lang_col).cast("string"))
            .withColumn(prefix + "g_source", F.col(source_col).cast("string")).drop(f"{prefix}m"))


def bin_of(v):
    """Lower edge of the bin of a non-negative integer: its six leading bits."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketches(passed: DataFrame) -> DataFrame:
    """Histograms (g_lang, g_source, ratio, bin, n): one row per occupied bin; adding counts merges them."""
    pairs = F.explode(F.map_from_arrays(F.array(*[F.lit(r) for r in RATIOS]), F.array(*[bin_of(F.col(r)) for r in RATIOS])))
    return (passed.select("g_lang", "g_source", pairs.alias("ratio", "bin"))
            .groupBy("g_lang", "g_source", "ratio", "bin").agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, *group: str) -> DataFrame:
    """(group, ratio, docs, q25, q75) of merged histograms: the first bin whose running count reaches the rank."""
    merged = sketch.groupBy(*group, "ratio", "bin").agg(F.sum("n").alias("n"))
    w = W.partitionBy(*group, "ratio")
    ranked = (merged.withColumn("upto", F.sum("n").over(w.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)))
              .withColumn("docs", F.sum("n").over(w)))
    at = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("docs"), F.col("bin")))
    return ranked.groupBy(*group, "ratio").agg(F.max("docs").alias("docs"), at(1).alias("q25"), at(3).alias("q75"))


def fences(sketch: DataFrame) -> DataFrame:
    """(g_lang, g_source, ratio, lo, hi): every group's fences, from the first level with enough documents."""
    own = quartiles(sketch, "g_lang", "g_source").alias("o")
    lang = quartiles(sketch, "g_lang").alias("l")
    whole = quartiles(sketch).alias("w")
    both = (own.join(lang, F.col("o.g_lang").eqNullSafe(F.col("l.g_lang")) & (F.col("o.ratio") == F.col("l.ratio")))
            .join(whole, F.col("o.ratio") == F.col("w.ratio")))
    pick = lambda q: (F.when(F.col("o.docs") >= MIN_GROUP, F.col(f"o.{q}"))
                      .when(F.col("l.docs") >= MIN_GROUP, F.col(f"l.{q}")).otherwise(F.col(f"w.{q}")))
    q = both.select("o.g_lang", "o.g_source", "o.ratio", pick("q25").alias("q25"), pick("q75").alias("q75"))
    least = F.element_at(F.create_map(*[F.lit(x) for r, (_, _, s, _) in RATIOS.items() for x in (r, s)]), F.col("ratio"))
    step = F.greatest(F.col("q75") - F.col("q25"), least)
    return q.select("g_lang", "g_source", "ratio", (F.col("q25") - FENCE * step).alias("lo"),
                    (F.col("q75") + FENCE * step).alias("hi"))


def fence_table(narrow: DataFrame) -> DataFrame:
    """One row per group with a lower and an upper fence column per ratio (stored)."""
    f = fences(sketches(narrow.where(~F.col("base_failed"))))
    wide = f.groupBy("g_lang", "g_source").agg(*[
        F.max(F.when(F.col("ratio") == r, F.col(side))).alias(f"{side}_{r}") for r in RATIOS for side in ("lo", "hi")])
    return stored(wide, "fences")


def judged(rows: DataFrame, table: DataFrame, prefix: str = "") -> DataFrame:
    """``rows`` (output of ``measured``) with the column kept, by the fences of each row's group."""
    t = table.select(*[F.col(c).alias(f"{prefix}t_{c}") for c in table.columns])
    same = F.col(f"{prefix}g_lang").eqNullSafe(F.col(f"{prefix}t_g_lang")) \
        & F.col(f"{prefix}g_source").eqNullSafe(F.col(f"{prefix}t_g_source"))
    if table.count() <= BROADCAST_GROUPS:  # one narrow row per (language, source)
        joined = rows.join(F.broadcast(t), same, "left")
    else:  # spread each group's documents over several tasks
        salt = f"{prefix}salt"
        t = t.withColumn(f"{prefix}t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")) \
            .join(t, same & (F.col(salt) == F.col(f"{prefix}t_salt")), "left").drop(salt, f"{prefix}t_salt")
    ok = ~F.col(f"{prefix}base_failed")
    for r, (_, _, _, lower) in RATIOS.items():
        ok = ok & (F.col(prefix + r) <= F.col(f"{prefix}t_hi_{r}"))
        if lower:
            ok = ok & (F.col(prefix + r) >= F.col(f"{prefix}t_lo_{r}"))
    return joined.withColumn(f"{prefix}kept", F.coalesce(ok, F.lit(False))).drop(*t.columns)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratios) per row."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                    F.col(source_col).alias("source"))
    narrow = stored(measured(d).drop("text", "lang", "source"), "measures")
    return judged(narrow, fence_table(narrow)).select("doc_id", *BASE_COLUMNS, "base_failed", "kept", *RATIOS)


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns. Texts are stored once with their measures and then
    filtered in place; they are not shuffled."""
    p = "q4__"
    wide = stored(measured(docs, text_col, lang_col, source_col, p), "measured")
    narrow = wide.select(*[F.col(p + c).alias(c) for c in ("base_failed", "g_lang", "g_source", *RATIOS)])
    return judged(wide, fence_table(narrow), p).where(F.col(p + "kept")).select(*docs.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


_RATIO_SQL = ", ".join(f"case when {u} > 0 then 1000 * {o} // {u} else 0 end as {r}" for r, (o, u, _, _) in RATIOS.items())
_LEVELS = {"o": "g_lang, g_source, ", "l": "g_lang, ", "w": ""}


def _quartile_sql(group: str) -> str:
    return f"""select {group}ratio, max(docs) as docs, min(case when 4 * upto >= docs then bin end) as q25,
      min(case when 4 * upto >= 3 * docs then bin end) as q75
    from (select {group}ratio, bin, sum(n) over (partition by {group}ratio order by bin
                 rows between unbounded preceding and current row) as upto, sum(n) over (partition by {group}ratio) as docs
          from (select {group}ratio, bin, sum(n) as n from sketch group by {group}ratio, bin)) group by {group}ratio"""


def _pick(q: str) -> str:
    return (f"case when o.docs >= {MIN_GROUP} then o.{q} when l.docs >= {MIN_GROUP} then l.{q} else w.{q} end as {q}")


OP4_SQL = f"""
with d as (
  select row_number() over () as rid, doc_id, lang as g_lang, source as g_source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
l as (
  select rid, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select rid, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by rid),
win as (select rid, i, w[i:i + 2] as s from (select rid, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, s) as n from win) where n > 1),
cov as (select rid, count(distinct p) as n_repeat_words from (select rid, unnest([i, i + 1, i + 2]) as p from rep)
        group by rid),
m as (
  select d.rid, doc_id, g_lang, g_source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, length(text) - length(replace(text, '!', '')) as n_bangs,
         coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from d left join l using (rid) left join cov using (rid)),
r as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
      {_RATIO_SQL} from m),
sketch as (
  select g_lang, g_source, ratio, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) as bin,
         count(*) as n
  from (select g_lang, g_source, unnest([{', '.join(f"'{r}'" for r in RATIOS)}]) as ratio,
               unnest([{', '.join(RATIOS)}]) as v from r where not base_failed) group by all),
own as ({_quartile_sql(_LEVELS["o"])}),
lang as ({_quartile_sql(_LEVELS["l"])}),
whole as ({_quartile_sql(_LEVELS["w"])}),
q as (select o.g_lang, o.g_source, o.ratio, {_pick("q25")}, {_pick("q75")} from own o
      join lang l on o.g_lang is not distinct from l.g_lang and o.ratio = l.ratio join whole w on o.ratio = w.ratio),
f as (select g_lang, g_source, ratio, q25 - {FENCE} * greatest(q75 - q25, least) as lo,
             q75 + {FENCE} * greatest(q75 - q25, least) as hi
      from (select *, case ratio {' '.join(f"when '{r}' then {s}" for r, (_, _, s, _) in RATIOS.items())} end as least
            from q)),
t as (select g_lang, g_source, {', '.join(f"max(case when ratio = '{r}' then {s} end) as {s}_{r}"
                                          for r in RATIOS for s in ("lo", "hi"))} from f group by g_lang, g_source)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       coalesce(not base_failed and {' and '.join(f"{r} <= hi_{r}" for r in RATIOS)}
                and {' and '.join(f"{r} >= lo_{r}" for r, x in RATIOS.items() if x[3])}, false) as kept,
       {', '.join(f"cast({r} as bigint) as {r}" for r in RATIOS)}
from r left join t on r.g_lang is not distinct from t.g_lang and r.g_source is not distinct from t.g_source
"""
