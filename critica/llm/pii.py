"""Operator 8 [native]: personal data by weak supervision.

Candidates are all matches of the strict patterns (also those that fail their check) and of wider patterns per kind:
spelled-out addresses, bracketed dots, national phone numbers, card numbers with other separators, and numbers inside a
strict match that ran on into its neighbours. Five labelers vote on
each candidate (+1 personal, -1 not, 0 no opinion): the strict pattern with its check, a plausibility rule, a gazetteer
(top-level domains, reserved networks, issuer and dialling prefixes), the words before the span, and its borders. The
number of candidates per vote pattern is counted over the whole corpus; expectation-maximisation on these counts (at
most 3^5 patterns per kind) estimates the labelers' reliabilities, its posteriors train a logistic span classifier
(Spark ML on the aggregated patterns), and the classifier decides which candidates are added. Valid strict matches
always stay; added spans never overlap them.

Text offsets come from splitting a text at its matches, in code points, by running sums in chunks; overlaps are found
from spans sorted by place; so a text takes time linear in its matches, but for the sort. Patterns repeat possessively where nothing can
be given back and start at run borders only, so long runs cost linear time and no deep recursion.

Defined results: null and empty texts have no spans (base_sha256 of the empty string); repeated rows and null doc_ids
are kept as they are; an empty table gives an empty result; extra columns are ignored; texts are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import let, read, stored

KINDS = ("email", "ip", "card", "phone")
EM_ROUNDS = 25
ACCEPT = 0.9
CONTEXT = 32
CHUNK = 256  # values folded at a time

# strict patterns: the same matches as the plain forms
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   [0-9]([\x20-]?[0-9])+                                  \+[0-9][\x20().0-9-]+[0-9]
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64} ?[\[({]? ?(?:at|AT|@) ?[\])}]? ?[A-Za-z0-9-]{2,63}"
             r"(?: ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?[A-Za-z]{2,24}| dot [A-Za-z]{2,24}){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}(?:\[?\(?(?:\.|dot)\)?\]?[0-9]{1,3}){2}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{16}|[0-9]{4}(?:[ ._/-][0-9]{4}){3})(?![0-9])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])|(?<![0-9])00[1-9][0-9]{0,2}"
             r"(?:[ -][0-9]{2,4}){3,4}(?![0-9])",
}
# words before a span that speak for or against it
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|mailto|correo|courriel|kontakt)\W*\w*\W*$",
    "ip": r"(?i)(?:\bip|address|host|server|login|from)\W*\w*\W*$",
    "card": r"(?i)(?:card|visa|credit|debit|payment|karte|tarjeta|carte)\W*\w*\W*$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|whatsapp|handy|anruf|ruf)\W*\w*\W*$",
}
AGAINST = r"(?i)(?:version|release|isbn|issn|order|invoice|serial|part|item|sku|token|build|chapter|section)\W*\w*\W*$"
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at",
             "us", "ca", "au", "in", "jp", "cn", "br", "mx", "biz", "me", "app", "dev")
VOTES = ("v_strict", "v_plausible", "v_gazetteer", "v_context", "v_border")
SPAN_TYPE = "array<struct<start:int,end:int,txt:string,before:string,after:string>>"
CAND_FIELDS = "kind:string,start:int,end:int,base:boolean," + ",".join(f"{v}:int" for v in VOTES)


def running(values, op, start: int):
    """Running results of an associative ``op`` with neutral element ``start`` over an array of integers.

    A fold that appends copies its array at every step, so values are folded in chunks and the chunks' results carried on:
    the work is linear in the values, times a constant.
    """
    zero, none = F.lit(start).cast("int"), F.array().cast("array<int>")
    last = lambda acc: F.get(acc, F.size(acc) - 1)

    def fold(v):
        return F.aggregate(v, none, lambda acc, x: F.concat(acc, F.array(op(F.coalesce(last(acc), zero), x))))

    def carry(parts):
        before = F.aggregate(parts, F.array(zero), lambda acc, p: F.concat(acc, F.array(op(last(acc), last(p)))))
        return let(before, lambda b: F.flatten(F.transform(parts, lambda p, k: F.transform(p, lambda x: op(b[k], x)))))

    def whole(v):
        chunks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / CHUNK).cast("int"))
        return let(F.transform(chunks, lambda k: fold(F.slice(v, k * CHUNK + 1, CHUNK))), carry)

    return let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def matches(text, pattern: str, guard, worth=None):
    """Matches with code-point offsets and their surroundings, from the pieces between them; ``worth`` picks some of them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def offsets(m, p):
        ends = running(F.zip_with(F.slice(p, 1, F.size(m)), m, lambda a, b: F.length(a) + F.length(b)), lambda a, b: a + b, 0)

        def placed(e):
            at = F.sequence(F.lit(0), F.size(m) - 1)
            return F.transform(F.filter(at, lambda i: worth(m[i])) if worth else at, lambda i: F.struct(
                (e[i] - F.length(m[i])).alias("start"), e[i].alias("end"), m[i].alias("txt"),
                F.right(p[i], F.lit(CONTEXT)).alias("before"), F.left(p[i + 1], F.lit(1)).alias("after")))

        return let(ends, placed)

    bound = let(found, lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda p: offsets(m, p))))
    return F.coalesce(F.when(guard, bound), F.array()).cast(SPAN_TYPE)


def clear_of(spans, blocking, same):
    """The ``spans`` (structs with start and end) that overlap none of ``blocking`` and equal none of ``same`` in place.

    All are sorted by place once. A span overlaps an earlier one if the largest end so far is beyond its start, and a
    later one if the least start to come is before its end: two running passes instead of comparing all pairs. Spans of
    ``same`` have different starts.
    """
    far = 2 ** 31 - 1

    def rows(found, tag):
        return F.transform(found, lambda s, i: F.struct(s["start"].alias("start"), F.lit(tag).alias("tag"),
                                                        s["end"].alias("end"), i.alias("at")))

    def picked(r):
        ends = F.transform(r, lambda x: F.when(x["tag"] == 0, x["end"]).otherwise(0))
        starts = F.reverse(F.transform(r, lambda x: F.when(x["tag"] == 0, x["start"]).otherwise(far)))

        def free(until, since):
            def alone(i):
                x, y = r[i], F.get(r, i - 1)
                equal = (y["tag"] == 1) & (y["start"] == x["start"]) & (y["end"] == x["end"])
                return (x["tag"] == 2) & (until[i] <= x["start"]) & (since[i] >= x["end"]) & ~F.coalesce(equal, F.lit(False))

            return F.transform(F.filter(F.sequence(F.lit(0), F.size(r) - 1), alone), lambda i: spans[r[i]["at"]])

        return let(running(ends, F.greatest, 0), lambda until: let(
            F.reverse(running(starts, F.least, far)), lambda since: free(until, since)))

    return F.when((F.size(spans) == 0) | ((F.size(blocking) == 0) & (F.size(same) == 0)), spans).otherwise(
        let(F.sort_array(F.concat(rows(blocking, 0), rows(same, 1), rows(spans, 2))), picked))


def digits(s):
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(d):
    """Luhn sum of a digit string is a multiple of ten."""
    n = F.length(d)

    def add(total, i):
        v = d.substr(n - i, F.lit(1)).cast("int") * (1 + F.pmod(i, F.lit(2)))
        return total + F.when(v > 9, v - 9).otherwise(v)

    return F.pmod(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add), F.lit(10)) == 0


def small_parts(s):
    """All number parts of a dotted quad are at most 255."""
    parts = F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0))
    return F.forall(parts, lambda p: F.transform(F.array(F.ltrim(p, F.lit("0"))), lambda q: (F.length(q) < 3) | (
        (F.length(q) == 3) & (q <= "255")))[0])


def strict_check(kind: str, txt):
    """The check a strict match must pass."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return small_parts(txt)
    d = F.transform(F.array(digits(txt)), lambda d: F.length(d).between(16, 19) & luhn(d) if kind == "card"
                    else F.length(d).between(8, 15))
    return d[0]


def plausible(kind: str, txt):
    if kind == "email":
        return F.length(txt).between(6, 254) & ~txt.rlike(r"\.\.|^\.")
    if kind == "ip":
        return small_parts(txt) & (F.length(digits(txt)) >= 4)
    d = F.transform(F.array(digits(txt)), lambda d: F.length(d).between(13, 19) & luhn(d) if kind == "card"
                    else F.length(d).between(9, 15))
    return d[0]


def listed(kind: str, txt):
    """Gazetteer vote: known top-level domain, public network, issuer prefix, dialling prefix."""
    if kind == "email":
        return F.lower(F.regexp_extract(txt, r"([A-Za-z]+)\W*$", 1)).isin(*TOP_LEVEL)
    if kind == "ip":
        first = F.regexp_extract(txt, "^0*([0-9]{1,3})", 1).cast("int")
        return F.coalesce(~first.isin(0, 10, 127) & (first < 224), F.lit(False))
    if kind == "card":
        return digits(txt).rlike("^(?:3[47]|30|36|38|4|5[1-5]|2[2-7]|6)")
    return digits(txt).rlike("^(?:00)?[1-9]")


def vote(condition):
    return F.when(condition, 1).otherwise(-1)


def candidates_of(kind: str, spans, strict: bool):
    """Spans of one kind as candidates with their votes."""

    def row(s):
        ok = strict_check(kind, s["txt"]) if strict else F.lit(False)
        clean = ~s["before"].rlike("[A-Za-z0-9]$") & ~s["after"].rlike("^[A-Za-z0-9]")
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), ok.alias("base"),
                        (vote(ok) if strict else F.lit(0)).alias("v_strict"),
                        vote(plausible(kind, s["txt"])).alias("v_plausible"),
                        vote(listed(kind, s["txt"])).alias("v_gazetteer"),
                        F.when(s["before"].rlike(CUES[kind]), 1).when(s["before"].rlike(AGAINST), -1).otherwise(0)
                        .alias("v_context"),
                        vote(clean).alias("v_border"))

    return F.transform(spans, row).cast(f"array<struct<{CAND_FIELDS}>>")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, cands) of (doc_id, text): candidates of all kinds in the order of kind and start."""
    t = F.coalesce(F.col("text"), F.lit(""))
    marks = docs.select("doc_id", t.alias("t"), t.contains("@").alias("at"), t.contains("+").alias("plus"),
                        t.rlike("[0-9]").alias("num"))
    num = F.col("num")
    guards = {"email": F.col("at"), "ip": num & F.col("t").contains("."), "card": num, "phone": num & F.col("plus")}
    spelled = F.col("at") | F.col("t").contains("dot") | F.col("t").contains("DOT")
    wide = {"email": spelled & (F.col("t").rlike(r"[\[({] ?(?:dot|DOT|\.) ?[\])}]| dot ")),
            "ip": num & F.col("t").rlike(r"[0-9][\[(](?:\.|dot)"), "card": num & F.col("t").rlike("[0-9]{4}[ ._/-]?[0-9]{4}"),
            "phone": num & F.col("t").rlike("[0-9]{3}[ .-]?[0-9]{4}|00[1-9]")}
    # digit runs far from a card number are no candidates
    worth = {"card": lambda s: F.length(digits(s)) >= 13}
    found = marks.select("doc_id", *[matches(F.col("t"), STRICT[k], guards[k], worth.get(k)).alias(f"s_{k}") for k in KINDS],
                         *[matches(F.col("t"), WIDE[k], wide[k]).alias(f"w_{k}") for k in KINDS])

    def of_kind(k):
        strict, loose = F.col(f"s_{k}"), F.col(f"w_{k}")
        # a strict match that fails its check may have run on into neighbouring digits: look inside it
        fresh = clear_of(loose, F.filter(strict, lambda s: strict_check(k, s["txt"])), strict)
        return F.sort_array(F.concat(candidates_of(k, strict, True), candidates_of(k, fresh, False)))

    return found.select("doc_id", F.concat(*[of_kind(k) for k in KINDS]).alias("cands"))


def fit_reliabilities(patterns: list[tuple]) -> dict[tuple, float]:
    """Posterior of 'personal' per (kind, votes), by expectation-maximisation over pattern counts.

    ``patterns``: (kind, votes, n). One prior per kind; every labeler has a probability of each vote given the class,
    shared by the kinds, smoothed, and started from a labeler that is right four times out of five.
    """
    kinds = sorted({k for k, _, _ in patterns})
    prior = dict.fromkeys(kinds, 0.5)
    like = {(j, v, c): {(1, 1): 0.7, (-1, 1): 0.15, (0, 1): 0.15, (1, 0): 0.15, (-1, 0): 0.7, (0, 0): 0.15}[(v, c)]
            for j in range(len(VOTES)) for v in (-1, 0, 1) for c in (0, 1)}
    post: dict[tuple, float] = {}
    for _ in range(EM_ROUNDS):
        for kind, votes, _ in patterns:
            w = [math.log(prior[kind] if c else 1 - prior[kind])
                 + sum(math.log(like[(j, v, c)]) for j, v in enumerate(votes)) for c in (0, 1)]
            post[(kind, votes)] = 1 / (1 + math.exp(max(-60.0, min(60.0, w[0] - w[1]))))
        for kind in kinds:
            n = sum(m for k, _, m in patterns if k == kind)
            prior[kind] = (1 + sum(m * post[(k, v)] for k, v, m in patterns if k == kind)) / (n + 2)
        for c in (0, 1):
            mass = sum(m * (post[(k, v)] if c else 1 - post[(k, v)]) for k, v, m in patterns)
            for j in range(len(VOTES)):
                for v in (-1, 0, 1):
                    hit = sum(m * (post[(k, vs)] if c else 1 - post[(k, vs)]) for k, vs, m in patterns if vs[j] == v)
                    # the smoothing keeps a labeler's start as a weak prior, which also fixes which class is which
                    start = 0.7 if v == (1 if c else -1) else 0.15
                    like[(j, v, c)] = (hit + 10 * start) / (mass + 10)
    return post


def train_classifier(spark: SparkSession, patterns: list[tuple]):
    """(intercept, weights by feature) of a logistic classifier on posterior-weighted patterns."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    post = fit_reliabilities(patterns)
    rows = []
    for kind, votes, n in patterns:
        features = [float(kind == k) for k in KINDS[1:]] + [float(v) for v in votes]
        for label in (0.0, 1.0):
            p = post[(kind, votes)]
            rows.append((label, n * (p if label else 1 - p) + 1e-6, *features))
    names = [f"kind_{k}" for k in KINDS[1:]] + list(VOTES)
    body = ", ".join("(" + ", ".join(f"{float(x)!r}D" for x in r) + ")" for r in rows)
    table = spark.sql(f"select * from values {body} as t(label, weight, {', '.join(names)})").coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(
        VectorAssembler(inputCols=names, outputCol="features").transform(table))
    return float(model.intercept), dict(zip(names, (float(x) for x in model.coefficients)))


def score(c, intercept: float, weights: dict[str, float]):
    """Probability of a candidate struct."""
    z = F.lit(intercept)
    for k in KINDS[1:]:
        z = z + F.when(c["kind"] == k, F.lit(weights[f"kind_{k}"])).otherwise(F.lit(0.0))
    for v in VOTES:
        z = z + c[v] * F.lit(weights[v])
    return 1 / (1 + F.exp(-z))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end, base, votes) in the order of kind and start."""
    spark = docs.sparkSession
    found = stored(candidates(docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                                          F.col(text_col).cast("string").alias("text"))), "candidates")
    counted = (found.select(F.explode("cands").alias("c")).groupBy("c.kind", *[f"c.{v}" for v in VOTES])
               .agg(F.count(F.lit(1)).alias("n")).collect())  # at most 4 x 3^5 rows
    patterns = sorted((r.kind, tuple(r[v] for v in VOTES), r.n) for r in counted)
    if patterns:
        intercept, weights = train_classifier(spark, patterns)
        good = lambda c: score(c, intercept, weights) >= accept
    else:
        good = lambda c: F.lit(False)
    base = F.filter("cands", lambda c: c["base"])
    added = F.filter("cands", lambda c: ~c["base"] & good(c))
    split = found.select("doc_id", base.alias("base"), added.alias("added"))
    free = clear_of(F.col("added"), F.col("base"), F.array().cast(f"array<struct<{CAND_FIELDS}>>"))
    order = F.transform(F.concat("base", free), lambda c: F.struct(
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), c["kind"]).alias("k"), c["start"].alias("start"),
        c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base")))
    return split.select("doc_id", "base", F.sort_array(order).alias("spans"))


def spelled(spans):
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"),
                                                                 c["end"].cast("string"))), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))

    def number(kind):
        return F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
                        spelled(F.col("spans")).alias("spans"))
