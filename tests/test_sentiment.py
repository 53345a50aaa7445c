import math

import pytest
from pyspark.sql import functions as F

from critica.functions.sentiment import LexiconScorer, add_sentiment, lexicon_score


def reference_score(text, sc=LexiconScorer()):
    """Plain-Python statement of the rules, used as the brute-force oracle."""
    import re
    text = text or ""
    toks = re.findall(r"[A-Za-z']+", text)
    low = [t.lower() for t in toks]
    mixed = re.search("[a-z]", text) is not None
    p = low.index("but") + 1 if "but" in low else 0
    s = 0.0
    for i, t in enumerate(toks):
        v = sc.lexicon.get(low[i], 0.0)
        if v == 0:
            continue
        sgn = 1.0 if v > 0 else -1.0
        if t == t.upper() and t != t.lower() and len(t) >= 2 and mixed:
            v += sgn * sc.caps_boost
        neg = False
        for k in (1, 2, 3):
            if i - k >= 0:
                v += sgn * sc.boosters.get(low[i - k], 0.0) * sc.booster_scale[k - 1]
                neg = neg or low[i - k] in sc.negators
        if neg:
            v *= sc.negation_scalar
        pos = i + 1
        if p and pos < p:
            v *= sc.before_but
        elif p and pos > p:
            v *= sc.after_but
        s += v
    e = min(text.count("!"), sc.exclaim_max) * sc.exclaim_boost
    s = s + e if s > 0 else (s - e if s < 0 else s)
    return max(-1.0, min(1.0, s / math.sqrt(s * s + sc.alpha)))


TEXTS = [
    "This game is great, I love it", "Terrible. Broken and boring", "It is a game.", "", None,
    "not good", "very very good", "GREAT game", "GREAT GAME", "good but boring", "bad but great!!!",
    "I don't like it at all, never fun", "absolutely awful, hardly fun", "ok!!!!!!", "Good good good!",
    "the best worst game", "slightly good but extremely bad", "no no no good", "isn't great but not bad",
]


@pytest.mark.parametrize("use_keys", [True, False])
def test_matches_plain_python_rules(spark, use_keys):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")
    out = add_sentiment(df, "text", keys=["id"] if use_keys else None).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        assert r["sentiment_score"] == pytest.approx(reference_score(TEXTS[r["id"]]), abs=1e-9), TEXTS[r["id"]]


def test_labels_and_range(spark):
    df = spark.createDataFrame([(1, "What a great and fun game"), (2, "Awful, terrible, a waste"),
                                (3, "The game has levels"), (4, "")], "id long, text string")
    out = {r["id"]: r for r in add_sentiment(df, "text", keys=["id"]).collect()}
    assert out[1]["sentiment_label"] == "pos" and out[1]["sentiment_score"] >= 0.05
    assert out[2]["sentiment_label"] == "neg" and out[2]["sentiment_score"] <= -0.05
    assert out[3]["sentiment_label"] == "neu" and out[4]["sentiment_score"] == 0.0
    assert all(-1 <= r["sentiment_score"] <= 1 for r in out.values())


def test_rules_move_the_score(spark):
    def score(t):
        return spark.range(1).select(lexicon_score(F.lit(t)).alias("s")).first()["s"]
    assert score("not good") < 0 < score("good")
    assert score("very good") > score("good")
    assert score("GOOD game") > score("good game")
    assert score("good!!") > score("good")
    assert score("bad but good") > 0


def test_custom_scorer_plugin(spark):
    df = spark.createDataFrame([(1, "anything")], "id long, text string")
    out = add_sentiment(df, "text", scorer=lambda c: F.lit(-0.5)).first()
    assert out["sentiment_label"] == "neg"


def test_sql_twin_agrees(spark):
    import duckdb
    from critica.functions.sentiment import sentiment_sql
    con = duckdb.connect()
    con.execute("create table t(id bigint, text varchar)")
    con.executemany("insert into t values (?, ?)", [(i, t) for i, t in enumerate(TEXTS)])
    got = dict(con.execute(sentiment_sql("t", "id", "text")).fetchall())
    for i, t in enumerate(TEXTS):
        assert got[i] == pytest.approx(reference_score(t), abs=1e-9), t


def test_rows_that_share_their_keys_are_scored_on_their_own(spark):
    from critica.functions.sentiment import add_sentiment
    df = spark.createDataFrame([(1, "good"), (1, "bad bad"), (1, "good"), (2, None)], "k int, review string")
    keyed = sorted((str(r["review"]), round(r["sentiment_score"], 6)) for r in add_sentiment(df, keys=["k"]).collect())
    folded = sorted((str(r["review"]), round(r["sentiment_score"], 6)) for r in add_sentiment(df).collect())
    assert keyed == folded


def test_large_lexicon(spark):
    from critica.functions.sentiment import LexiconScorer, add_sentiment
    sc = LexiconScorer(lexicon={f"word{chr(97 + i % 26)}{'x' * (i // 26)}": (i % 9) - 4.0 for i in range(2000)})
    df = spark.createDataFrame([(1, "wordb wordaxx wordcxxx")], "k int, review string")
    a = add_sentiment(df, scorer=sc, keys=["k"]).first()["sentiment_score"]
    assert abs(a - add_sentiment(df, scorer=sc).first()["sentiment_score"]) < 1e-9
