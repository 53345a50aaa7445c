import datetime as dt
import random

from pyspark.sql import functions as F

from critica.operators.cube import day_sketches, merged_sketches, quantiles, review_cube
from critica.streaming import sessions as S

T0 = dt.datetime(2024, 1, 1)


def test_cube_equals_one_group_by_per_set(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 2, None]), rng.choice("pq"), rng.choice([True, False, None]), rng.randrange(9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, b string, voted_up boolean, votes_up int")
    got = sorted(map(str, (tuple(r) for r in review_cube(df, [["g", "b"], ["g"], []], ["g", "b"]).collect())))
    want = []
    for level, keys in ((0, ("g", "b")), (1, ("g",)), (3, ())):
        groups = {}
        for g, b, up, votes in rows:
            groups.setdefault((g if "g" in keys else None, b if "b" in keys else None), []).append((up, votes))
        want += [(g, b, level, len(v), sum(u is True for u, _ in v), max(x for _, x in v)) for (g, b), v in groups.items()]
    assert got == sorted(map(str, want))


def test_merged_sketches_stay_within_their_bounds(spark):
    days = spark.range(60_000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("dt"),
                                      (F.col("id") * 7919 % 20_011).cast("string").alias("steamid"),
                                      (F.col("id") * 104_729 % 50_021).alias("playtime_at_review"))
    r = quantiles(merged_sketches(day_sketches(days), F.lit(1))).first()
    exact = sorted(x[0] for x in days.select("playtime_at_review").collect())
    assert r.n == 60_000 and abs(r.n_users - 20_011) < 0.03 * 20_011
    for share, q in ((0.25, r.q25), (0.5, r.q50), (0.9, r.q90)):
        assert abs(sum(x <= q for x in exact) / len(exact) - share) < 0.02


def events(rows):
    return [(i, t, u, "e", 1.0, None) for i, (t, u) in enumerate(rows)]


def minutes(m):
    return T0 + dt.timedelta(minutes=m)


def slow_sessions(rows, gap=30):
    out = []
    for u in {u for _, u in rows}:
        times = sorted(t for t, x in rows if x == u)
        start = [times[0]]
        for t in times[1:]:
            if t - start[-1] > dt.timedelta(minutes=gap):
                out.append((u, start[0], start[-1], len(start), float(len(start))))
                start = []
            start.append(t)
        out.append((u, start[0], start[-1], len(start), float(len(start))))
    return sorted(out)


def test_drops_restarts_and_late_rows(spark, tmp):
    rng = random.Random(2)
    rows = [(minutes(m + rng.random()), u) for u in range(6) for m in sorted(rng.sample(range(1500), 60))] + [(minutes(5), 0), (minutes(35), 0)]
    add = lambda part: spark.createDataFrame(events(part), S.EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    run = lambda: S.run_sessions(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/cp")
    read = 0
    for a, b in ((0, 400), (400, 1000), (1000, 1600)):
        add([r for r in rows if minutes(a) <= r[0] < minutes(b)])
        read += run()["rows"]
    assert read == len(rows) and run()["rows"] == 0  # nothing new: nothing read
    some = S.read_sessions(spark, f"{tmp}/out").count()
    assert 0 < some < len(slow_sessions(rows))  # the last ones are still open
    add([(minutes(3), 5), (minutes(4), 4)])  # far behind the watermark
    late = run()
    assert late["rows"] == 2 and late["late"] == 2
    S.end_mark(spark, f"{tmp}/in", minutes(1700), "30 minutes", "10 minutes")
    run()
    got = sorted(tuple(r) for r in S.read_sessions(spark, f"{tmp}/out").collect())
    assert got == slow_sessions(rows)
    batch = S.sessions(spark.createDataFrame(events(rows), S.EVENTS), "30 minutes", "10 minutes")
    assert sorted(tuple(r) for r in batch.collect()) == got
