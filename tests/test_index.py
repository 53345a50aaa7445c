import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from critica.operators.index import dense_index, row_index


def test_dense_index_equals_dense_rank(spark):
    rnd = random.Random(7)
    keys = [f"u{rnd.randint(0, 3000)}" for _ in range(5000)] + [None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["idx"] for r in dense_index(df, "k").collect()}
    want = {r["k"]: r["i"] for r in df.where("k is not null").distinct()
            .select("k", (F.dense_rank().over(Window.orderBy("k")) - 1).alias("i")).collect()}
    assert got == want
    assert dense_index(df, "k").schema["idx"].dataType.simpleString() == "int"


def test_row_index_per_group_with_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.random()) for _ in range(20000)] + [(f"g{i % 50}", rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = row_index(df, [F.col("v").desc()], groups=["g"], name="j", start=1, num_partitions=16)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    want = df.withColumn("j2", F.row_number().over(w))
    diff = got.join(want, ["g", "v"]).where(F.col("j") != F.col("j2")).count()
    assert diff == 0 and got.count() == len(rows)
