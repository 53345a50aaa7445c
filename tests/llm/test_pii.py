import hashlib
import re

from critica.llm import pii as P
from tests.llm.data import SCHEMA, empty, frame, rows

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in re.findall("[0-9]+", s)),
            "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def slow_base(text):
    return [(k, m.start(), m.end()) for k in P.KINDS for m in re.finditer(PLAIN[k], text or "") if passes(k, m[0])]


TEXTS = [
    "write to jo.do+x@mail.example.com, or a@b.c_d@e.f and x@@y.z q@w",
    "host 10.0.0.255 and 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.4 9.9.9",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 6 7 378282246310005 1234567890123456789012",
    "tel +1 (456) 555-2186. +49 30 1234567 +1 +12 +1234567890123456 ++44 20 7946 0958",
    "é😀 漢 +33 1 23 45 67 89 ü a@ex.org 192.168.1.1 😀b@ex.org",
    "call (456) 555-2186 or 456-555-2187 today; phone 456-555-2188",
    "jane [at] example [dot] com or jane at example dot com",
    "9" * 5000, "a" * 40000 + "@" + "b." * 3000 + "c", "1.1.1.1" * 50, "+" * 300 + "1 2" * 4000, "@" * 2000,
]


def data():
    return rows() + [(200 + i, t, "en", "s", 0, *["x"] * 6) for i, t in enumerate(TEXTS)]


def test_base_spans_equal_plain_patterns(spark):
    found = P.find_pii(frame(spark, data()))
    got = found.select("doc_id", P.spelled(P.F.col("base")).alias("b"), "spans").collect()
    want = [(r[0], ",".join(f"{k}:{a}:{b}" for k, a, b in slow_base(r[1]))) for r in data()]
    assert sorted(repr((r.doc_id, r.b)) for r in got) == sorted(map(repr, want))
    for r in got:  # base spans stay, added ones do not overlap them
        spans = [(s.kind, s.start, s.end) for s in r.spans]
        base = [tuple(x.split(":")) for x in r.b.split(",") if x]
        assert {(k, int(a), int(b)) for k, a, b in base} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (P.KINDS.index(s[0]), s[1]))
        for k, a, b in spans:
            if (k, str(a), str(b)) not in base:
                assert not any(a < int(y) and int(x) < b for _, x, y in base)


def test_digest_columns(spark, monkeypatch):
    monkeypatch.setattr(P, "read", lambda s, d, t: frame(s, data()))
    got = {r.doc_id: r for r in P.op8_pii(spark, "").where("doc_id >= 200").collect()}
    for i, t in enumerate(TEXTS):
        base = slow_base(t)
        r = got[200 + i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in P.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()


def test_em_finds_the_reliable_labelers():
    """Four labelers mostly agree, one votes at random: the posterior follows the four."""
    patterns = [("card", (1, 1, 1, 0, 1), 900), ("card", (1, 1, -1, 0, 1), 100), ("card", (-1, -1, -1, 0, 1), 450),
                ("card", (-1, -1, 1, 0, -1), 400), ("card", (-1, -1, -1, 0, -1), 500)]
    post = P.fit_reliabilities(patterns)
    assert post[("card", (1, 1, -1, 0, 1))] > 0.9 and post[("card", (-1, -1, 1, 0, -1))] < 0.1


def test_classifier_accepts_plausible_additions(spark):
    strict = [(i, f"tel +1 (456) 555-{i:04d} mail x{i}@mail.example.com ip 8.8.{i % 256}.1", "en", "s", 0, *["x"] * 6)
              for i in range(1000, 1200)]
    loose = [(3, "call +1 (456) 555-2186 10.0.0.1", "en", "s", 0, *["x"] * 6), (1, "phone 456-555-2187 please", "en", "s", 0, *["x"] * 6), (2, "order 4929 1234 5678 9999 9 8", "en", "s", 0, *["x"] * 6)]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in P.find_pii(frame(spark, strict + loose)).where("doc_id < 10").collect()}
    assert got[1] == [("phone", 6, 18)] and got[2] == []
    assert got[3] == [("ip", 23, 31), ("phone", 5, 22)]  # the strict phone ran on into the address and failed


def test_running_results(spark):
    rows = [(i, [(i * 7 + k * k) % 23 - 11 for k in range(n)]) for i, n in enumerate((0, 1, 2, 255, 256, 257, 1000))]
    got = spark.createDataFrame(rows, "i int, v array<int>").select(
        "v", P.running(P.F.col("v"), lambda a, b: a + b, 0).alias("s"), P.running(P.F.col("v"), P.F.greatest, -99).alias("g")).collect()
    import itertools

    for r in got:
        assert list(r.s) == list(itertools.accumulate(r.v)) and list(r.g) == list(itertools.accumulate(r.v, max))


def test_clear_spans_equal_all_pairs(spark):
    import random

    rng = random.Random(4)

    def spans(n, apart):
        out, at = [], 0
        for _ in range(n):
            at += rng.randrange(apart)
            end = at + rng.randrange(1, 9)
            out.append((at, end))
            at = end
        return out

    rows = [(spans(rng.randrange(30), 6), spans(rng.randrange(30), 6), spans(rng.randrange(30), 6)) for _ in range(60)]
    kind = "array<struct<start:int,end:int>>"
    for r in spark.createDataFrame(rows, f"a {kind}, b {kind}, c {kind}").select(
            "*", P.clear_of(P.F.col("a"), P.F.col("b"), P.F.col("c")).alias("free")).collect():
        want = [x for x in r.a if not any(x.start < y.end and y.start < x.end for y in r.b) and x not in r.c]
        assert sorted(r.free) == sorted(want)


def test_texts_with_very_many_numbers(spark):
    import time

    texts = [" ".join(str(100000 + i) for i in range(120_000)), "a@b.co " * 30_000, "4111 1111 1111 1111, " * 20_000,
             "10.0.0.1 10.[.]0.0.1 " * 10_000]
    df = frame(spark, [(i, t, "en", "s", 0, *["x"] * 6) for i, t in enumerate(texts)])
    P.find_pii(frame(spark)).count()
    for i, t in enumerate(texts):
        began = time.time()
        got = P.find_pii(df.where(f"doc_id = {i}")).select(P.spelled(P.F.col("base")).alias("b")).first().b
        assert time.time() - began < 20
        assert got == ",".join(f"{k}:{a}:{b}" for k, a, b in slow_base(t))


def test_native_plan(spark):
    plan = P.candidates(frame(spark).select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert P.find_pii(empty(spark)).count() == 0
    assert SCHEMA.names[0] == "doc_id"
