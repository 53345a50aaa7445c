"""Shared helpers: scratch tables in the shared folder, row ids, worker-wide store, word rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.session import scratch_path

# The ASCII white space that separates words, as Spark SQL string, Java class and DuckDB class
WS_CHARS = " \t\n\u000b\f\r"
WS_CLASS = "[\\x20\\x09-\\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts lineage, survives lost executors,
    and gives later passes a narrow columnar input instead of recomputing the texts."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def heaviest(df: DataFrame, count_col: str, size: int) -> DataFrame:
    """The rows with the largest counts, at most ``size`` of them: all rows above a cutoff.

    The cutoff comes from a histogram of the counts (bins of six leading bits, a few hundred rows), so no task and no
    driver ever sorts or holds more than the result. Rows of the bin that would exceed ``size`` are left out together.
    """
    c = F.col(count_col)
    shift = F.greatest(F.length(F.bin(c)) - 6, F.lit(0))
    edge = F.call_function("shiftleft", F.call_function("shiftright", c, shift), shift)
    bins = df.groupBy(edge.alias("edge")).agg(F.count(F.lit(1)).alias("n")).collect()
    cutoff, total = None, 0
    for r in sorted(bins, key=lambda r: -r.edge):
        total += r.n
        if total > size:
            break
        cutoff = r.edge
    return df.where(c >= cutoff) if cutoff is not None else df.where(F.lit(False))


def with_row_id(df: DataFrame, name: str = "rid") -> DataFrame:
    """Unique row id (rows may repeat and doc_id may be null). Only stable once the result is stored."""
    return df.withColumn(name, F.monotonically_increasing_id())


def free_name(df: DataFrame, name: str) -> str:
    """A column name that does not clash with any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value, body):
    """``body(value)`` with the value evaluated once, however often the body or its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def words_array(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; empty for null, empty and blank texts."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS_CLASS + "+", -1))


def has_word(s):
    return F.btrim(s, F.lit(WS_CHARS)) != ""


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker process (tokenizers and their caches)."""
    import sys
    import types

    m = sys.modules.get("critica_worker_store")
    if m is None:
        m = sys.modules["critica_worker_store"] = types.ModuleType("critica_worker_store")
        m.data = {}
    return m.data


def slices(batch, text: int | None = None, rows: int = 1024, size: int = 4 << 20):
    """Slices of an Arrow batch of at most ``rows`` rows and ``size`` bytes in column ``text`` (a longer value alone).

    Python objects are made for a slice at a time, so their memory does not grow with the batch.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if text is None:
        yield from (batch.slice(a, rows) for a in range(0, batch.num_rows, rows))
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = int(upto[at - 1]) if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(upto, before + size, "right"))))
        yield batch.slice(at, end - at)
        at = end


def bytes_list(column):
    """Values of an Arrow string or binary column as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]
