import numpy as np

from critica.llm import decontaminate as D
from tests.llm.data import empty, frame, prose, raw, rows

ITEM = "item_id bigint, text string, doc_id string"


def shingles(text):
    w = raw(text).lower().split()
    return {b" ".join(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    out = []
    for d, text in docs:
        held = shingles(text)
        for k, item in set(items):
            s = shingles(item)
            few = raw(item).lower().split()
            if few and not s:
                if b" ".join([b"", *few, b""]) in b" ".join([b"", *raw(text).lower().split(), b""]):
                    out.append((d, k, 1, 1, 1.0))
            elif s and len(s & held) >= 0.8 * len(s):
                out.append((d, k, len(s), len(s & held), len(s & held) / len(s)))
    return sorted(out)


def cases():
    items = [(1, prose(11, 30)), (2, prose(12, 60)), (3, prose(13, 5)), (4, "too short"), (5, None), (6, prose(14, 8)),
             (7, prose(15, 300)), (1, prose(11, 30)), (8, "Zebra"), (9, "one two three four"), (10, "four  one"), (11, " \n"),
             (12, "TOO short")]
    long = prose(20, 20000).split()
    w = dict((k, t.split()) for k, t in items if t)
    edited = [*w[2][:30], "changed", *w[2][31:]]
    docs = [" ".join(long[:9000] + w[1] + long[9000:]), " ".join(long[:50] + edited + long[50:100]),
            " ".join(w[3]).upper(), " ".join(w[1][:20] + long[:100]), " ".join(long[:10] + w[6] + w[7] + long[10:30]),
            " ".join(w[7][:250]), None, "", prose(30, 500), " ".join(w[1][:15] + w[1][15:]),
            "too\tSHORT", "ends in too short", "tootoo short shorts", "a zebra's zebra", "one two three four one two three"]
    return [(i, t) for i, t in enumerate(docs)], items


def test_matches_equal_brute_force(spark):
    docs, items = cases()
    got = D.contained_items(spark.createDataFrame(docs, "doc_id bigint, text string"),
                            spark.createDataFrame([(*x, "x") for x in items], ITEM))
    assert sorted(map(tuple, got.collect())) == brute(docs, items)


def test_random_items_in_long_documents():
    rng = np.random.default_rng(1)
    items = [(k, prose(1000 + k, int(rng.integers(6, 70)))) for k in range(150)]
    index = D.ItemIndex([(k, t.encode()) for k, t in items], 5, 0.8)
    raws = []
    for k, t in items:
        body = prose(5000 + k, int(rng.integers(20, 3000))).split()
        at = int(rng.integers(len(body)))
        raws.append(" ".join(body[:at] + t.split() + body[at:]).encode())
    assert sorted((d, index.ids[k]) for d, k, _ in index.search(raws)) == [(k, k) for k in range(150)]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = cases()
    frame_ = spark.createDataFrame([(*x, "x") for x in items], ITEM)
    assert len(list(D.item_blocks(frame_, "item_id", "text", 400))) > 1
    assert sorted(x for b in D.item_blocks(frame_, "item_id", "text", 400) for x in b) == sorted(
        (k, t.encode()) for k, t in set(items) if t is not None)


def test_drop_keeps_clean_rows_and_all_columns(spark):
    data = rows()
    items = spark.createDataFrame([(1, " ".join(data[9][1].split()[500:540]), "x")], ITEM)
    out = D.drop_contaminated(frame(spark), items)
    assert out.schema == frame(spark).schema
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, data[:9] + data[10:]))


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEM)
    assert D.contained_items(empty(spark), none).count() == 0
    assert D.contained_items(frame(spark), none).count() == 0
    assert D.drop_contaminated(frame(spark), none).count() == len(rows())
