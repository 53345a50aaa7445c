import re
from collections import Counter

from critica.llm import quality as Q
from tests.llm.data import SCHEMA, empty, frame, prose, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    w = WORD.findall(text)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(wins)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len({p for i, x in enumerate(wins) if n[x] > 1 for p in (i, i + 1, i + 2)}))


def test_counts_equal_plain_python(spark):
    extra = [(100 + i, t, "en", "s", 0, *["x"] * 6) for i, t in enumerate(
        ["a b c a b c", "x " * 400, "l1 a\nl1 a\n\n l1 a\nl2", "# $ %w &|", (prose(7, 40) + "\n") * 3 + prose(8, 50), "a b c d a b c"])]
    data = rows() + extra
    got = Q.quality_rules(frame(spark, data)).collect()
    want = []
    for r in data:
        n, chars, symbols, dups, repeat = slow(r[1])
        want.append((r[0], n, chars, symbols, dups, repeat, n < 50 or 100 * repeat > 50 * n))
    assert sorted(repr(tuple(r)[:7]) for r in got) == sorted(map(repr, want))
    assert not any(r.kept for r in got if r.base_failed)


def test_fences_adapt_to_the_group(spark):
    plain = [prose(i, 80) for i in range(80)]
    code = [" # ".join(prose(500 + i, 80).split()) for i in range(80)]  # half of the words are symbols
    data = [(i, t, "en", "plain", 0, *["x"] * 6) for i, t in enumerate(plain)]
    data += [(100 + i, t, "en", "code", 0, *["x"] * 6) for i, t in enumerate(code)]
    data += [(300, code[0] + " x", "en", "plain", 0, *["x"] * 6), (301, plain[0] + " #", "en", "plain", 0, *["x"] * 6)]
    kept = {r.doc_id: r.kept for r in Q.quality_rules(frame(spark, data)).collect()}
    assert all(kept[i] for i in range(80)) and all(kept[100 + i] for i in range(80))
    assert not kept[300] and kept[301]


def test_bins_hold_their_values(spark):
    for r in spark.range(0, 200000, 37).select("id", Q.bin_of(Q.F.col("id")).alias("b")).collect():
        assert r.b <= r.id < r.b + max(1, r.id / 31)


def test_salted_join_judges_alike(spark, monkeypatch):
    data = [(i, prose(i, 60) + " #" * (i % 40), "en", f"s{i % 3}", 0, *["x"] * 6) for i in range(120)]
    a = sorted(map(tuple, Q.quality_rules(frame(spark, data)).collect()))
    monkeypatch.setattr(Q, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, Q.quality_rules(frame(spark, data)).collect())) == a


def test_keep_quality_passes_columns_through(spark):
    kept = Q.keep_quality(frame(spark))
    assert kept.columns == SCHEMA.names
    judged = Q.quality_rules(frame(spark)).where("kept")
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in judged.collect())
    plan = kept._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert Q.quality_rules(empty(spark)).count() == 0
    assert Q.keep_quality(empty(spark)).count() == 0
