"""Operator 10: token counts by a map-side two-tier lookup.

Tier 1 is a broadcast table of frequent pre-tokens (white-space-delimited chunks) and their token counts; tier 2 is a
bounded cache in every Python worker that encodes each missing chunk once with the tokenizer itself. No pre-token is
shuffled: the frequent chunks come from per-partition summaries of bounded size that cover every document.

Chunks are cut at U+0020 and U+000A only. The tokenizer (lower case, white space dropped, no pre-token and no special
token spans white space) encodes each chunk independently of its neighbours, so chunk counts add up exactly.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows and null doc_ids are kept as they are;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import bytes_list, heaviest, read, stored, worker_store

TIER1_SIZE = 65_536  # broadcast entries (a few MB at most: chunks longer than 64 bytes are left to tier 2)
SUMMARY_SIZE = 16_384  # entries each partition reports
CACHE_SIZE = 400_000  # entries of a worker's cache; it starts anew when full
MAX_KEY = 64

COUNT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def chunks_of(raw: bytes) -> list[bytes]:
    return raw.replace(b"\n", b" ").split(b" ")


def frequent_chunks(docs: DataFrame, text_col: str = "text", size: int = TIER1_SIZE) -> list[bytes]:
    """The most frequent chunks over all documents, from mergeable per-partition summaries.

    Each task keeps a counter that is cut back to its heaviest half when it outgrows its bound (lossy counting), and
    reports at most SUMMARY_SIZE entries. The set only decides which tier answers, never the result.
    """

    def summarise(batches):
        import pyarrow as pa

        seen: Counter = Counter()
        for batch in batches:
            for raw in bytes_list(batch.column(0)):
                seen.update(chunks_of(raw))
            if len(seen) > 16 * SUMMARY_SIZE:
                seen = Counter(dict(seen.most_common(8 * SUMMARY_SIZE)))
        top = [(k, n) for k, n in seen.most_common(SUMMARY_SIZE) if 0 < len(k) <= MAX_KEY and n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.binary()),
                                          pa.array([n for _, n in top], pa.int64())], ["chunk", "n"])

    merged = (docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(summarise, "chunk binary, n bigint")
              .groupBy("chunk").agg(F.sum("n").alias("n")))
    return [bytes(r.chunk) for r in heaviest(stored(merged, "chunks"), "n", size).collect()]  # bounded by size


def _encoder(path: str):
    """bytes -> number of tokens, by the library of the vocabulary file."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda raws: [len(x) for x in sp.encode([r.decode("utf-8", "replace") for r in raws])]
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(path)
    tk.no_truncation()
    tk.no_padding()
    return lambda raws: [len(e.ids) for e in
                         tk.encode_batch_fast([r.decode("utf-8", "replace") for r in raws], add_special_tokens=False)]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 tier1_size: int = TIER1_SIZE) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` by a word-level vocabulary file at ``vocabulary``.

    The file must lie at the same path on every executor. ``vocabulary`` must drop white space (see module text).
    """
    spark = docs.sparkSession
    frequent = frequent_chunks(docs, text_col, tier1_size)
    table = spark.sparkContext.broadcast((frequent, _encoder(vocabulary)(frequent) if frequent else []))
    version = uuid.uuid4().hex

    def count(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        store = worker_store()
        if ("enc", vocabulary) not in store:
            store[("enc", vocabulary)] = _encoder(vocabulary)
            store[("cache", vocabulary)] = {}
        encode, cache = store[("enc", vocabulary)], store[("cache", vocabulary)]
        key = ("tier1", vocabulary, version)
        if key not in store:
            for old in [k for k in store if k[:2] == key[:2]]:
                del store[old]
            store[key] = dict(zip(*table.value)) | {b"": 0}
        tier1 = store[key].get
        for batch in batches:
            totals, sizes = [], []
            for raw in bytes_list(batch.column(1)):
                chunks = chunks_of(raw)
                got = list(map(tier1, chunks))
                misses = [c for c, n in zip(chunks, got) if n is None]
                total = sum(filter(None, got))
                if misses:
                    new = [c for c in set(misses) if c not in cache]
                    if len(cache) + len(new) > CACHE_SIZE:
                        cache.clear()
                        new = list(set(misses))
                    cache.update(zip(new, encode(new)))
                    total += sum(map(cache.__getitem__, misses))
                totals.append(total)
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(count, COUNT_SCHEMA))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
