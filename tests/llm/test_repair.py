import hashlib
import itertools
import random
import re
import zlib

from critica.llm.conversation_repair import (OP13_SQL, SuffixChain, apply_audits, audits, common_prefix, conversation_rows,
                                             damaged, op13_conversation_repair, repair_conversations, reports, stored)
from critica.plans.check import _digest, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, signature string, audit string, kind string, present string"
GOOD = re.compile(r"(s?(ua)+)?$")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "p") for r in rows], SCHEMA)


def slow_best(signature, extra=2):
    """(cost, audit) by trying every edit of every symbol and every insertion between them (short signatures)."""
    found = []

    def go(k, roles, cost, audit, room):
        if k == len(signature):
            if GOOD.match(roles):
                found.append((cost, audit))
        else:
            c = signature[k]
            go(k + 1, roles, cost + 2, audit + "D", room)
            if c != "g":
                late = 5 if c.isupper() else 0
                if c.lower() in "sua":
                    go(k + 1, roles + c.lower(), cost + late, audit + "K", room)
                for r in "ua":
                    go(k + 1, roles + r, cost + late + 1, audit + "R", room)
        if room:
            for r in "ua":
                go(k, roles + r, cost + 5, audit + "I", room - 1)

    go(0, "", 0, "", extra)
    return min(found)


def test_best_audit_equals_every_audit_tried():
    words = ["".join(p) for n in range(4) for p in itertools.product("suaoSUAOg", repeat=n)]
    chain = SuffixChain()
    for w in sorted(words, key=lambda x: x[::-1]):
        chain.load(w)
        assert chain.best() == slow_best(w), w
    nodes = len({w[i:] for w in words for i in range(len(w))})
    assert chain.built == nodes  # every distinct suffix is one node, built once
    rng = random.Random(3)
    for _ in range(15):
        w = "".join(rng.choice("suaoSUAOg") for _ in range(6))
        chain.load(w)
        assert chain.best() == slow_best(w), w


def test_common_prefix():
    for a, b in (("", ""), ("a", ""), ("ab", "ac"), ("x" * 5000, "x" * 5000), ("x" * 5000 + "y", "x" * 5000 + "z"), ("x" * 299, "x" * 400)):
        n = common_prefix(a, b)
        assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def test_signature_audits_over_many_partitions(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("suaoSUAOg") for _ in range(rng.randrange(9))) for _ in range(400)})
    got = {r.signature: (r.cost, r.audit) for r in
           audits(spark.createDataFrame([(w,) for w in words], "signature string").repartition(5)).collect()}
    chain = SuffixChain()
    assert len(got) == len(words)
    for w in words:
        chain.load(w)
        assert got[w] == chain.best()


def slow(rows):
    """Plain-Python statement of the whole contract without damage: {conv_id: (report..., hash)} of ordered rows."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, found in convs.items():
        found.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(v[2].encode()).hexdigest()))
        seen, sig, counts = set(), "", [0, 0, 0]
        for _, r, x in found:
            body = x.strip(" \t\n\x0b\x0c\r")
            letter = r[:1] if r[:1] in ("s", "u", "a") else "o"
            if not body:
                counts[0] += 1
                letter = "g"
            elif (r, x) in seen:
                counts[1] += 1
                letter = "g"
            elif body[-1] not in ".!?":
                counts[2] += 1
                letter = letter.upper()
            seen.add((r, x))
            sig += letter
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        chain = SuffixChain()
        chain.load(sig)
        cost, audit = chain.best()
        made, at, state = [], iter(found), ""
        for e in audit:
            if e == "D":
                next(at)
                continue
            expects = "assistant" if state.endswith("u") else "user"
            role, text = (expects, "") if e == "I" else next(at)[1:]
            role = expects if e == "R" else role
            state += role[0]
            made.append(f"{role}:{text}")
        assert GOOD.match(state)
        out[c] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def awkward():
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 3, "assistant", "More?"), (1, 4, "user", "cut")]
    rows += [(2, None, None, None), (2, None, "user", "a."), (2, 5, "assistant", "b. \n\t"), (2, 5, "assistant", "b. \n\t")]
    rows += [(3, 0, "", "x."), (3, 1, "tool", "y."), (3, 2, "system", "late."), (4, 0, "system", "alone.")]
    rows += [(None, 2, "user", "q?"), (None, 1, "system", "s."), (None, 3, "assistant", "ends in nbsp.\u00a0")]
    rows += [(5, k, ("user", "assistant")[k % 2], f"turn {k}.") for k in range(3000)]
    rows += [(6, 0, "user", "word " * 200_000 + "."), (6, 1, "assistant", " " * 300_000)]
    rows += [(c, t, ("system", "user", "assistant")[(c * 7 + t * 5) % 3], ("Ok.", "no", "", "Fine!")[(c + t * t) % 4])
             for c in range(10, 60) for t in range(c % 7)]
    return rows


def test_reports_and_repaired_rows(spark):
    rows = awkward()
    expected = slow(rows)
    table = conversation_rows(frame(spark, rows).repartition(6))
    report = stored(reports(table), "reports")
    got = {r.conv_id: tuple(r)[1:] for r in report.collect()}
    assert got == {c: v[:-1] for c, v in expected.items()}
    closing = {r.conv_id: r.repaired_sha256 for r in apply_audits(table, report, messages=False).collect()}
    assert closing == {c: v[-1] for c, v in expected.items()}
    made = {}
    for r in sorted(repair_conversations(frame(spark, rows)).collect(), key=lambda r: r.position):
        made.setdefault(r.conv_id, []).append(r)
    for c, v in expected.items():
        messages = made.get(c, [])
        assert [m.position for m in messages] == list(range(len(messages)))
        assert "".join(m.edit for m in messages) == v[6].replace("D", "")
        assert GOOD.match("".join(m.role[0] for m in messages))
        assert hashlib.sha256("\n".join(f"{m.role}:{m.text}" for m in messages).encode()).hexdigest() == v[-1]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in (*range(12), None)]
    table = frame(spark, rows)
    got = {}
    for r in damaged(table).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.present, r.role, r.text))
    for c, t, role, text in rows:
        code = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        one = {0: (False, role, text), 1: (True, role, ""), 2: (True, role, "One Two Three"), 4: (True, "user", text)}.get(code, (True, role, text))
        assert got[c, t] == [one] * (2 if code == 3 else 1)


def test_conversation_without_rows_and_empty_table(spark):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = damaged(frame(spark, [(lost, 0, "user", "x.")]))
    report = stored(reports(table), "reports")
    assert tuple(report.first()) == (lost, 0, 0, 0, 0, 0, 0, "")
    assert apply_audits(table, report).collect()[0].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair_conversations(frame(spark, [])).collect() == []
    assert reports(conversation_rows(frame(spark, []))).collect() == []


def test_query_equals_sql(spark):
    df = op13_conversation_repair(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = duck(SF).execute(OP13_SQL)
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns) and len(rows) > 0
    assert _digest(df.columns, rows) == _digest(cols, r.fetchall())
