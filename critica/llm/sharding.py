"""Operator 5 [native]: consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` cells; every shard owns ``VIRTUAL_NODES`` tokens at fixed cells. A key hashes to a cell and
belongs to the first token clockwise. Shards hold at most their capacity - floor or ceiling of rows / shards, so the
law is ``rows`` - and keys that overflow a full shard continue clockwise to the next shard with room.

All cells of an arc between two tokens see the same clockwise order of shards, so the overflow is settled on the counts
per arc (at most shards x virtual nodes numbers): hop by hop, each arc hands its remaining keys to the next shard. Keys
then find their shard from their rank within the arc, which is a prefix count per cell plus a rank inside the cell.
Nothing is ever ordered in one place: cells are ranked in parallel, and only arc counts reach the driver. A cell with more
than ``CELL_ROWS`` rows (a doc_id or a group of copies that repeats very often) is dealt by hash of size, crc32 and stored
row into pieces that are ranked on their own, each behind the counts of those before it.

Defined results: a null text has size 8 and crc32 0; null doc_ids hash by size and crc32; rows with equal doc_id keep
separate slots; ties are ordered by size, crc32 and stored row (inside the pieces of a split cell); an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from critica.llm.common import read, stored, with_row_id

SHARDS = 24
VIRTUAL_NODES = 64
CELLS = 16_384
CELL_ROWS = 100_000  # rows of one cell that are ordered in one piece


def ring_tokens(shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """Sorted (cell, shard) tokens; a cell that is taken already passes the token on to the next free cell."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for v in range(virtual_nodes):
            cell = zlib.crc32(f"{shard}/{v}".encode()) % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


def settle(counts: list[int], tokens: list[tuple[int, int]], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces (arc, lo, hi, shard, slot_base): the keys of rank lo <= r < hi in the arc go to the shard."""
    n = len(tokens)
    free = list(capacity)
    given = [0] * len(capacity)
    done = [0] * n
    order = []
    for arc in range(n):  # clockwise shards as seen from the arc
        seen: list[int] = []
        for k in range(n):
            shard = tokens[(arc + k) % n][1]
            if shard not in seen:
                seen.append(shard)
                if len(seen) == len(capacity):
                    break
        order.append(seen)
    pieces = []
    for hop in range(len(capacity)):
        for arc in range(n):
            left = counts[arc] - done[arc]
            if left and hop < len(order[arc]):
                shard = order[arc][hop]
                take = min(left, free[shard])
                if take:
                    pieces.append((arc, done[arc], done[arc] + take, shard, given[shard]))
                    done[arc] += take
                    given[shard] += take
                    free[shard] -= take
    return pieces


def _table(spark: SparkSession, rows, columns: str) -> DataFrame:
    """A small literal table."""
    if not rows:
        return spark.sql(f"select * from values ({', '.join(['0L'] * (columns.count(',') + 1))}) as t({columns}) where false")
    body = ", ".join("(" + ", ".join(f"{int(v)}L" for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {body} as t({columns})")


def ring_shards(rows: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> DataFrame:
    """Add (shard, slot) to stored rows (rid, doc_id, size, text_crc32)."""
    spark = rows.sparkSession
    tokens = ring_tokens(shards, virtual_nodes, cells)
    position = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text_crc32", "size"))
    placed = rows.withColumn("h", position).withColumn("cell", F.pmod(F.col("h"), F.lit(cells)))
    counted = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))

    # cell -> arc (the first token at or after the cell, clockwise) and the keys before the cell in its arc
    arcs = _table(spark, [(cell, i) for i, (cell, _) in enumerate(tokens)], "cell, arc")
    back = W.orderBy(F.desc("cell")).rowsBetween(W.unboundedPreceding, 0)  # bounded: one row per cell
    ring = (spark.range(0, cells, 1, 1).withColumnRenamed("id", "cell").join(F.broadcast(arcs), "cell", "left")
            .withColumn("arc", F.coalesce(F.last("arc", ignorenulls=True).over(back), F.lit(0)))
            .join(counted, "cell", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            # cells beyond the last token wrap round to arc 0 and come before its other cells
            .withColumn("turn", (F.col("cell") <= tokens[-1][0]).cast("int")))
    before = W.partitionBy("arc").orderBy("turn", "cell").rowsBetween(W.unboundedPreceding, -1)
    ring = stored(ring.select("cell", "arc", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "ring")

    per_arc = {r.arc: r.n for r in ring.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    counts = [per_arc.get(i, 0) for i in range(len(tokens))]
    total = sum(counts)
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    pieces = _table(spark, settle(counts, tokens, capacity), "arc, lo, hi, shard, slot_base")

    most = max(CELL_ROWS, total // 10_000)  # so there are at most 10,000 more pieces than cells
    size = F.greatest(F.lit(1), F.ceil(F.col("n") / most))
    dealt = (placed.join(F.broadcast(ring.select("cell", "arc", "n", "before")), "cell")  # at most ``cells`` rows
             .withColumn("sub", F.when(size > 1, F.pmod(F.xxhash64("size", "text_crc32", "rid"), size)).otherwise(F.lit(0))))
    inside = W.partitionBy("cell", "sub").orderBy("h", "doc_id", "size", "text_crc32", "rid")
    ranked = dealt.withColumn("r", F.row_number().over(inside) - 1 + F.col("before"))
    if total and ring.agg(F.max("n").alias("n")).first().n > most:
        skip = W.partitionBy("p_cell").orderBy("p_sub").rowsBetween(W.unboundedPreceding, -1)  # bounded: one row per piece
        parts = (dealt.where(F.col("n") > most).groupBy(F.col("cell").alias("p_cell"), F.col("sub").alias("p_sub"))
                 .agg(F.count(F.lit(1)).alias("k")).withColumn("skip", F.coalesce(F.sum("k").over(skip), F.lit(0))).drop("k"))
        ranked = (ranked.join(F.broadcast(parts), (F.col("cell") == F.col("p_cell")) & (F.col("sub") == F.col("p_sub")), "left")
                  .withColumn("r", F.col("r") + F.coalesce("skip", F.lit(0))))
    return (ranked.join(F.broadcast(pieces.withColumnRenamed("arc", "p_arc")),
                        (F.col("arc") == F.col("p_arc")) & (F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi")))
            .withColumn("shard", F.col("shard").cast("int"))
            .withColumn("slot", F.col("slot_base") + F.col("r") - F.col("lo")))


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(with_row_id(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))), "sizes")
    return ring_shards(rows, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                            F.lit(None).cast("int").alias("grown_shard"))


def op5_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"))
