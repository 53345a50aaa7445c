import random

import pytest
from pyspark.sql import functions as F

from critica.operators import timejoin as J

LEFT, RIGHT = "k string, t int, x string", "k string, u int, v int, w string"


def slow_asof(left, right):
    out = []
    for k, t, x in left:
        found = [(u, v, w) for kk, u, v, w in right if k is not None and kk == k and t is not None and u is not None and u <= t]
        _, v, w = max(found, key=lambda r: (r[0], (r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""))) if found else (None, None, None)
        out.append((k, t, x, v, w))
    return sorted(map(str, out))


@pytest.mark.parametrize("partitions", [1, 2, 13])
def test_asof_equals_brute_force_with_a_hot_key(spark, partitions):
    rng = random.Random(partitions)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    left = [(rng.choice(keys), rng.choice([None, *range(200)]), str(i)) for i in range(700)] + [("only left", 5, "x")]
    right = [(rng.choice(keys), rng.choice([None, *range(0, 200, 3)]), rng.choice([None, 1, 2, 3]), rng.choice("pq")) for _ in range(150)]
    left += left[:20]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = J.asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "u", ["v", "w"])
        assert got.columns == ["k", "t", "x", "v", "w"]
        assert sorted(str(tuple(r)) for r in got.collect()) == slow_asof(left, right)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_values_cross_partition_edges(spark):
    """One key, one value at the very start, all else far behind it in other partitions."""
    left = [("hot", i, str(i)) for i in range(1, 4000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = J.asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame([("hot", 0, 7, "first")], RIGHT), ["k"], "t", "u", ["v"])
        assert got.where("v = 7").count() == 3999
        parts = spark.createDataFrame(left, LEFT).repartitionByRange("k", "t").select(F.spark_partition_id().alias("p"))
        assert parts.groupBy("p").count().agg(F.max("count")).first()[0] < 1500  # the hot key spans tasks
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_asof_within_a_limit_empty_sides_and_clashes(spark):
    left, right = spark.createDataFrame([("a", 10, "x"), ("a", 30, "y")], LEFT), spark.createDataFrame([("a", 9, 1, "p")], RIGHT)
    got = J.asof_join(left, right, ["k"], "t", "u", ["v"], F.col("t") - F.col("asof_time") <= 5)
    assert sorted(map(tuple, got.collect())) == [("a", 10, "x", 1), ("a", 30, "y", None)]
    assert J.asof_join(left.limit(0), right, ["k"], "t", "u", ["v"]).count() == 0
    assert [r.v for r in J.asof_join(left, right.limit(0), ["k"], "t", "u", ["v"]).collect()] == [None, None]
    with pytest.raises(ValueError):
        J.asof_join(left, right.withColumnRenamed("v", "x"), ["k"], "t", "u", ["x"])


def test_dyadic_cover_is_disjoint_and_complete(spark):
    rng = random.Random(1)
    rows = [(a, a + rng.choice([1, 2, 3, 7, 64, 1000, 123_457])) for a in [rng.randrange(-500, 500) for _ in range(60)]]
    for r in spark.createDataFrame(rows, "a long, b long").select("*", J.dyadic_cover(F.col("a"), F.col("b")).alias("n")).collect():
        spans = sorted((x.node << x.level, (x.node + 1) << x.level) for x in r.n)
        assert spans[0][0] == r.a and spans[-1][1] == r.b and all(p[1] == q[0] for p, q in zip(spans, spans[1:]))
        assert len(r.n) <= 2 * (r.b - r.a).bit_length()


@pytest.mark.parametrize("cell", [1, 7, 100, 10 ** 6])
def test_interval_join_equals_brute_force(spark, cell):
    rng = random.Random(cell)
    keys = ["hot"] * 4 + ["a", "b", None]
    points = [(rng.choice(keys), rng.choice([None, *range(-300, 300)]), i) for i in range(400)]
    spans = []
    for i in range(120):
        a = rng.randrange(-300, 300)
        spans.append((rng.choice(keys), a, rng.choice([a, a - 1, a + 1, a + 5, a + 90, a + 100_000, None]), i))
    spans += spans[:5]
    got = J.interval_join(spark.createDataFrame(points, "k string, t long, p int"), spark.createDataFrame(spans, "k string, a long, b long, s int"),
                          ["k"], "t", "a", "b", cell)
    want = [(p, s) for k, t, p in points for kk, a, b, s in spans if k is not None and k == kk and t is not None and b is not None and a <= t < b]
    assert sorted((r.p, r.s) for r in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_interval_join_of_empty_sides(spark):
    points, spans = spark.createDataFrame([], "k string, t long"), spark.createDataFrame([], "k string, a long, b long")
    assert J.interval_join(points, spans, ["k"], "t", "a", "b", 5).count() == 0
    with pytest.raises(ValueError):
        J.interval_join(points.withColumnRenamed("t", "a"), spans, ["k"], "a", "a", "b", 5)
