import json

from critica.sources import drift as D

SCHEMA = "dt string, value string"


def pages(spark):
    def page(*reviews):
        return json.dumps({"success": 1, "reviews": list(reviews)})

    old = {"recommendationid": "1", "author": {"steamid": "u"}, "votes_up": 3, "voted_up": True}
    new = {"recommendationid": "2", "author": {"steamid": "u"}, "votes_up": "12", "voted_up": None, "badge": {"x": 1}, "tags": ["a"]}
    odd = {"recommendationid": 3, "votes_up": "many"}
    return spark.createDataFrame([("d1", page(old, old)), ("d2", page(new, odd)), ("d2", '{"cut'), ("d3", page()), ("d3", "[1]"), ("d4", None)], SCHEMA)


def test_report_per_day(spark):
    got = {tuple(r) for r in D.drift_report(D.raw_reviews(pages(spark), "value", "dt"), "dt").collect()}
    assert got == {("d1", "recommendationid", "STRING", 2, "known"), ("d1", "author", "OBJECT", 2, "known"),
                   ("d1", "votes_up", "BIGINT", 2, "known"), ("d1", "voted_up", "BOOLEAN", 2, "known"),
                   ("d2", "recommendationid", "STRING", 1, "known"), ("d2", "recommendationid", "BIGINT", 1, "retyped"),
                   ("d2", "author", "OBJECT", 1, "known"), ("d2", "votes_up", "STRING", 2, "retyped"), ("d2", "voted_up", "VOID", 1, "known"),
                   ("d2", "badge", "OBJECT", 1, "unknown"), ("d2", "tags", "ARRAY", 1, "unknown")}


def test_values_survive_a_change_of_type(spark):
    raw = D.raw_reviews(pages(spark), "value", "dt")
    assert [r.bad for r in raw.where("bad is not null").collect()] == ['{"cut']
    got = D.typed(raw.where("review is not null"), {"id": ("$.recommendationid", "string"), "votes": ("$.votes_up", "bigint"),
                                                     "user": ("$.author.steamid", "string"), "x": ("$.badge.x", "bigint")}, "dt")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        ("d1", "1", 3, "u", None), ("d1", "1", 3, "u", None), ("d2", "2", 12, "u", 1), ("d2", "3", None, None, None)]))


def test_empty(spark):
    none = pages(spark).limit(0)
    assert D.drift_report(D.raw_reviews(none, "value", "dt"), "dt").count() == 0
