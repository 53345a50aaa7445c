"""Event-time sessions as a stateful stream: state store, watermark, late rows counted.

Events arrive as files. A session of a user ends ``gap`` after its last event; the stream keeps open sessions in its state
store and writes a session once the watermark (the newest event time less ``late``) has passed its end. Every run picks
up the files that are new since its checkpoint, with ``trigger(availableNow=True)``, and stops; the next run, also after a
failure, goes on from the state of the last finished batch. Rows behind the watermark are left out and counted.

State holds open sessions only: the watermark bounds it by the users active within ``gap + late``, not by history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    """(user_id, session_start, last_ts, n_events, value) per session; the same expression for tables and streams."""
    return (events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
            .agg(F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value"))
            .select("user_id", F.col("w.start").alias("session_start"), "last_ts", "n_events", "value"))


def run_sessions(spark: SparkSession, source: str, out: str, checkpoint: str, gap: str = "30 minutes",
                 late: str = "10 minutes", files_per_batch: int = 8) -> dict:
    """Process the event files added since the last run; returns the numbers of batches, rows read and late rows."""
    events = (spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(source)
              .select("ts", "user_id", "value"))
    q = (sessions(events, gap, late).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start())
    q.awaitTermination()
    log = {"batches": 0, "rows": 0, "late": 0}
    for p in q.recentProgress:
        log["batches"] += 1
        log["rows"] += p.numInputRows
        log["late"] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
    return log


def end_mark(spark: SparkSession, source: str, after, gap: str, late: str) -> None:
    """Add a file with one event of no user, far enough behind ``after`` (a timestamp) to close every open session."""
    mark = spark.range(1).select(F.lit(after).cast("timestamp").alias("ts")).withColumn(
        "ts", F.col("ts") + F.expr(f"interval {gap}") + F.expr(f"interval {late}") + F.expr("interval 1 hour"))
    fields = {f.split()[0]: f.split()[1] for f in EVENTS.split(", ")}
    mark.select(*[F.col("ts") if n == "ts" else F.lit(None).cast(k).alias(n) for n, k in fields.items()]) \
        .coalesce(1).write.mode("append").parquet(source)


def read_sessions(spark: SparkSession, out: str) -> DataFrame:
    """The sessions written so far; those of end marks are no sessions."""
    schema = "user_id bigint, session_start timestamp, last_ts timestamp, n_events bigint, value double"
    return spark.read.schema(schema).parquet(out).where(F.col("user_id").isNotNull())
