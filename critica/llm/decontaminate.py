"""Operator 9: benchmark decontamination by size-partitioned MinHash containment search.

Short test items are looked for inside documents of any length. Items fall into size classes u = 8, 16, 32, ...
(u / 2 < distinct shingles <= u). For a class, documents are seen as windows of 2u shingles starting every u shingles,
so any run of u shingles lies whole in one window and an item that is contained to 80 % has a Jaccard similarity of at
least 0.19 with a window, however long the document is. Block minima of 8 shingles are computed once per document and
combined for every class. One equal minimum out of ``FUNCTIONS`` = 64 makes a candidate: an item held by one window to
80 % is missed with probability below 0.81^64 (1e-6). Items of at most ``TINY`` distinct shingles are their own sketch
(any shingle is looked up directly). Every candidate is verified by exact containment of its word shingles in the whole
document. An item whose shingles are spread over distant windows is found if any window shares a minimum.

The search runs where the documents are read; nothing of them is shuffled. The item index is broadcast in blocks of at
most about ``BLOCK_BYTES`` of text: a larger benchmark takes more passes, not a larger broadcast.

Defined results: an item with fewer than five words is one shingle, its whole word sequence; items without words match
nothing; null and empty texts match nothing; repeated items count once; repeated rows and null doc_ids give their own rows; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import bytes_list, read, slices

SHINGLE = 5
THRESHOLD = 0.8
FUNCTIONS = 64
BASE = 8
TINY = 4
BLOCK_BYTES = 8 << 20

MATCH_SCHEMA = "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint, containment double"


def shingle_hashes(words: list[bytes], size: int):
    """64-bit hashes of the word shingles, combined from word hashes."""
    import numpy as np
    import xxhash

    if len(words) < size:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - size + 1
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = (h ^ w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def hash_functions(n: int = FUNCTIONS):
    """Odd multipliers and offsets of the MinHash functions, by a fixed rule."""
    import numpy as np

    rng = np.random.default_rng(9)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), \
        rng.integers(0, 1 << 63, n, dtype=np.uint64)


class ItemIndex:
    """Sketches and exact shingles of one block of items: [(item_id, text bytes)]."""

    def __init__(self, items, size: int, threshold: float):
        import numpy as np

        self.size, self.threshold = size, threshold
        self.a, self.c = hash_functions()
        self.ids, self.sets, self.by_hash = [], [], {}
        self.tiny: dict[int, list[int]] = {}
        self.brief: dict[int, dict[bytes, list[int]]] = {}  # number of words -> items of fewer words than a shingle
        sketches: dict[int, list] = {}
        for item_id, raw in items:
            words = raw.lower().split()
            if not words:
                continue
            k = len(self.ids)
            self.ids.append(item_id)
            if len(words) < size:
                self.sets.append({b" ".join(words)})
                self.brief.setdefault(len(words), {}).setdefault(b" ".join(words), []).append(k)
                continue
            h = np.unique(shingle_hashes(words, size))
            self.sets.append({b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)})
            if len(h) <= TINY:
                for x in h.tolist():
                    self.tiny.setdefault(x, []).append(k)
                continue
            u = BASE
            while u < len(h):
                u *= 2
            sketches.setdefault(u, []).append((k, [int(((h * a + c) >> np.uint64(32)).min())
                                                   for a, c in zip(self.a, self.c)]))
        self.brief_hashes = {n: np.unique(np.concatenate([shingle_hashes(x.split(b" "), n) for x in by]))
                             for n, by in self.brief.items()}
        self.tiny_hashes = np.array(sorted(self.tiny), np.uint64)
        # per class and function: sorted minima, and the items behind each
        self.classes = {}
        for u, rows in sketches.items():
            per = []
            for j in range(len(self.a)):
                owners: dict[int, list[int]] = {}
                for k, sig in rows:
                    owners.setdefault(sig[j], []).append(k)
                per.append((np.array(sorted(owners), np.uint64), owners))
            self.classes[u] = per

    def candidates(self, hashes, starts):
        """{(document, item)} over the concatenated shingle hashes of documents that start at ``starts``."""
        import numpy as np

        found = set()
        sizes = np.diff(np.append(starts, len(hashes)))
        live = np.flatnonzero(sizes)
        if not len(live):
            return found
        owner = np.repeat(np.arange(len(starts)), sizes)
        if len(self.tiny_hashes):
            for p in np.flatnonzero(_among(hashes, self.tiny_hashes)).tolist():
                found.update((int(owner[p]), k) for k in self.tiny[int(hashes[p])])
        if not self.classes:
            return found
        n_base = -(-sizes[live] // BASE)
        base_doc = np.repeat(live, n_base)
        within = np.arange(len(base_doc)) - np.repeat(np.cumsum(n_base) - n_base, n_base)
        base_at = starts[base_doc] + within * BASE
        layout = {}
        for u in self.classes:
            head = np.flatnonzero(within % (u // BASE) == 0)  # base blocks that begin a block of u shingles
            doc = base_doc[head]
            joined = np.append(doc[1:] == doc[:-1], False)
            layout[u] = (head, doc, joined)
        for j, (a, c) in enumerate(zip(self.a, self.c)):
            low = np.minimum.reduceat((hashes * a + c) >> np.uint64(32), base_at)
            for u, per in self.classes.items():
                head, doc, joined = layout[u]
                m = np.minimum.reduceat(low, head) if u > BASE else low
                window = np.where(joined, np.minimum(m, np.append(m[1:], m[-1])), m)
                values, owners = per[j]
                for p in np.flatnonzero(_among(window, values)).tolist():
                    found.update((int(doc[p]), k) for k in owners[int(window[p])])
        return found

    def brief_items(self, words: list[bytes]):
        """Items of fewer words than a shingle that the document holds: by hash, then by the words themselves."""
        found = set()
        for n, by in self.brief.items():
            for p in _among(shingle_hashes(words, n), self.brief_hashes[n]).nonzero()[0].tolist():
                found.update(by.get(b" ".join(words[p:p + n]), ()))
        return sorted(found)

    def shared(self, words: list[bytes], items: list[int]):
        """Exact number of distinct item shingles that the document holds, per item."""
        size = self.size
        held = {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}
        return [len(self.sets[k] & held) for k in items]

    def search(self, raws: list[bytes]):
        """[(document, item, shared)] of the verified matches in a batch of texts, in slices of bounded size."""
        import numpy as np

        out, part, words, total = [], [], [], 0
        for at, raw in enumerate(raws):
            w = raw.lower().split()
            h = shingle_hashes(w, self.size)
            if self.brief:
                out += [(at, k, 1) for k in self.brief_items(w)]
            part.append((at, h))
            words.append(w)
            total += len(h)
            if total > 400_000 or at == len(raws) - 1:
                sizes = np.array([len(h) for _, h in part])
                starts = np.cumsum(sizes) - sizes
                wanted: dict[int, list[int]] = {}
                for d, k in self.candidates(np.concatenate([h for _, h in part]), starts):
                    wanted.setdefault(d, []).append(k)
                for d, ks in wanted.items():
                    ks.sort()
                    out += [(part[d][0], k, s) for k, s in zip(ks, self.shared(words[d], ks))
                            if s >= self.threshold * len(self.sets[k])]
                part, words, total = [], [], 0
        return out


def _among(values, table):
    """Mask of the values that occur in a sorted table."""
    import numpy as np

    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    return table[np.minimum(at, len(table) - 1)] == values


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES):
    """Lists of (item_id, text bytes), each of about ``block_bytes`` at most, one after the other."""
    rows = (items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("t"))
            .where(F.col("t").isNotNull()).distinct())
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    slot = F.pmod(F.xxhash64("item_id", "t"), F.lit(n))
    for b in range(n):
        part = rows.where(slot == b) if n > 1 else rows
        yield [(r.item_id, r.t.encode("utf-8")) for r in part.collect()]  # one bounded block of the query set


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text", size: int = SHINGLE,
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every document and item with containment >= threshold."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    result = None
    for block in item_blocks(items, item_id_col, item_text_col):
        shipped = spark.sparkContext.broadcast(block)

        def run(batches, shipped=shipped):
            import pyarrow as pa

            index = ItemIndex(shipped.value, size, threshold)
            names = ["doc_id", "item_id", "n_shingles", "n_shared", "containment"]
            kinds = [pa.int64()] * 4 + [pa.float64()]
            for batch in (part for whole in batches for part in slices(whole, 1)):
                ids = batch.column(0).to_pylist()
                rows = [(ids[d], index.ids[k], len(index.sets[k]), s, s / len(index.sets[k]))
                        for d, k, s in index.search(bytes_list(batch.column(1)))]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        part = narrow.mapInArrow(run, MATCH_SCHEMA)
        result = part if result is None else result.unionByName(part)
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns pass through where they are read."""
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    for block in item_blocks(items, item_id_col, item_text_col):
        shipped = spark.sparkContext.broadcast(block)

        def run(batches, shipped=shipped):
            import numpy as np
            import pyarrow as pa

            index = ItemIndex(shipped.value, size, threshold)
            for batch in (part for whole in batches for part in slices(whole, at)):
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, _, _ in index.search(bytes_list(batch.column(at)))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP9_SQL = """
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
b as (
  select distinct item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from benchmark),
bs as (select distinct item_id, array_to_string(w[i:i + 4], ' ') as s
       from (select item_id, w, unnest(range(1, len(w) - 3)) as i from b where len(w) >= 5)),
brief as (select item_id, ' ' || array_to_string(w, ' ') || ' ' as s from b where len(w) between 1 and 4),
n as (select item_id, count(*) as n_shingles from bs group by item_id),
ds as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
       from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5)),
hit as (select doc_id, item_id, count(*) as n_shared from ds join bs using (s) group by doc_id, item_id)
select doc_id, item_id, n_shingles, n_shared, n_shared::double / n_shingles as containment
from hit join n using (item_id) where n_shared >= 0.8::double * n_shingles
union all
select doc_id, item_id, 1, 1, 1.0::double from d join brief on contains(' ' || array_to_string(w, ' ') || ' ', s)
"""
