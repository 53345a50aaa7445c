"""Operator 6: SimHash near-duplicates by vantage-point trees over 64-bit fingerprints.

1. Every text becomes one fingerprint where it is read (numpy in Arrow batches); only (row, fingerprint) moves on.
   Copies collapse to one distinct fingerprint before any search, so hot groups of copies cost nothing further.
2. The upper trees come from a bounded hash sample of the distinct fingerprints. Each node holds a vantage point and a
   radius t over some of the bits; linked points differ by at most ``slack`` in these bits. Points at distance <= t go
   inside, the others outside, and outside points at distance <= t + slack go inside as well. By the triangle
   inequality two such points meet in at least one leaf, so querying each leaf (shard) on its own finds them exactly.
   - The bits are cut into r + 1 blocks (r: the largest linking distance), with a tree for each. Linked points agree in
     at least one block; in its tree slack is 0, so nothing is copied over a boundary. A fingerprint thus goes to r + 1
     shards, however many fingerprints there are. One tree over all bits would copy a fifth of the points at every
     cut, and so ever more of them as the table grows.
   - Where points agree in a whole block and are still too many, cuts go on over all bits, with slack r and boundary
     copies. A cut is taken only if repeating it would make at most about the square root of n copies of a point.
3. Inside a shard the same recursion goes on in memory, down to small blocks that are compared bit by bit. A block
   that no vantage point can split is searched by flipping up to r of the bits that vary in it, which is linear in its
   size.
4. Shards emit a spanning forest (a point and the representative it hangs on), never all pairs of a group; components
   of the forest edges are found with Spark joins.

Defined results: null, empty and blank texts have fingerprint zero and link like any other; repeated rows share their
component; rows with a null doc_id take part, and component_id is the smallest non-null doc_id (null if there is none);
an empty table gives an empty result; extra columns are ignored; texts are hashed whole, whatever their length.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import bytes_list, free_name, read, slices, stored, with_row_id
from critica.llm.graph import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SHARD_POINTS = 50_000  # distinct fingerprints a shard should hold
SAMPLE_POINTS = 100_000  # size of the sample from which the upper trees are built (at most twice as many)
LEAF_SAMPLE = 8  # sampled points a leaf holds at least: beyond 6e8 fingerprints shards grow instead (8 bytes a point)
DEAL_POINTS = 1 << 18  # points a task routes at once: a tree of many leaves is walked once for all of them
BLOCK = 384  # points compared bit by bit
ALL_BITS = (1 << 64) - 1


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """SimHash (as a signed 64-bit integer) of the XXH64 values of a text's word shingles."""
    import numpy as np
    import xxhash

    words = raw.lower().split()  # bytes: lower-cases A-Z and splits at ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return int(np.array([digest(joined, SEED)], np.uint64).view(np.int64)[0])
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    n = len(words) - shingle + 1
    votes = np.zeros(64, np.int64)
    for a in range(0, n, 65_536):
        b = min(n, a + 65_536)
        h = np.array([digest(joined[i:j], SEED)
                      for i, j in zip(starts[a:b].tolist(), ends[a + shingle - 1:b + shingle - 1].tolist())], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(rid, doc_id, fp) of (rid, doc_id, text)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = [fingerprint(raw, shingle) for part in slices(batch, 2) for raw in bytes_list(part.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                             ["rid", "doc_id", "fp"])

    return docs.select("rid", "doc_id", "text").mapInArrow(run, "rid bigint, doc_id bigint, fp bigint")


# --- vantage-point tree ------------------------------------------------------------------------------------------

def bit_blocks(r: int):
    """r + 1 masks that share the 64 bits out: points that differ in at most r bits agree in one of them."""
    edges = [64 * k // (r + 1) for k in range(r + 2)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def distance(points, vantage, mask: int = ALL_BITS):
    import numpy as np

    return np.bitwise_count((points ^ vantage) & np.uint64(mask))


def best_cut(points, mask: int, slack: int, tries: int = 6):
    """(vantage, t, mask, slack) of the cut whose repetition makes the fewest copies, None if no cut helps.

    A cut that makes T * n points of n, the larger side holding m * n, leads to about n ** (log T / log(1 / m)) copies
    of a point. Without slack there are no copies and the even cut is best.
    """
    import numpy as np

    n, best, found = len(points), (0.5, 0.97 if slack == 0 else 0.9), None
    for k in range(tries):
        v = points[(k * n) // tries]
        if k % 2:
            v = ~v ^ (points[n // 3] >> np.uint64(k))  # also points outside the data
        below = np.cumsum(np.bincount(distance(points, v, mask), minlength=65 + slack))
        inside, outside = below[slack:65 + slack], n - below[:65]  # for t = 0 .. 64, inside with boundary copies
        larger = np.maximum(inside, outside) / n
        for t in np.flatnonzero(larger < best[1] if slack == 0 else larger < 0.9).tolist():
            growth = np.log((inside[t] + outside[t]) / n) / -np.log(larger[t]) if slack else 0.0
            if growth <= 0.5 and (growth, larger[t]) < best:
                best, found = (growth, larger[t]), (v, t, mask, slack)
    return found


def cut_for(points, mask: int, r: int):
    """A cut in the block ``mask``, in which linked points agree; over all bits where the block holds nothing more."""
    return best_cut(points, mask, 0) or best_cut(points, ALL_BITS, r)


def sides(points, cut):
    """The points inside a cut, with boundary copies, and those outside."""
    v, t, mask, slack = cut
    d = distance(points, v, mask)
    return points[d <= t + slack], points[d > t]


def build_forest(points, r: int, leaf_points: float):
    """Upper trees over a sample, one per block of bits: nested (cut, inside, outside) tuples with shard numbers as
    leaves; the number modulo r + 1 tells the block."""
    def grow(p, mask, numbers):
        cut = cut_for(p, mask, r) if len(p) > leaf_points else None
        if cut is None:
            return next(numbers)
        inside, outside = sides(p, cut)
        return cut, grow(inside, mask, numbers), grow(outside, mask, numbers)

    return [grow(points, mask, count(k, r + 1)) for k, mask in enumerate(bit_blocks(r))]


def route(points, tree):
    """[(shard, points)] of every leaf of a tree that a point or its boundary copies reach."""
    if not isinstance(tree, tuple):
        return [(tree, points)] if len(points) else []
    inside, outside = sides(points, tree[0])
    return route(inside, tree[1]) + route(outside, tree[2])


def _hook(labels, i, j):
    """Union of the pairs (i, j) in an array of parent labels."""
    import numpy as np

    while True:
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
        a, b = labels[i], labels[j]
        open_ = a != b
        if not open_.any():
            return labels
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))


def _block_links(p, r: int):
    """Spanning edges of a small block, by comparing all its points."""
    import numpy as np

    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= r
    i, j = np.nonzero(np.triu(near, 1))
    if not len(i):
        return p[:0], p[:0]
    labels = _hook(np.arange(len(p)), i, j)
    k = np.flatnonzero(labels != np.arange(len(p)))
    return p[k], p[labels[k]]


def _flip_links(p, r: int):
    """Spanning edges of a block that cannot be split: look up every neighbour made by flipping up to r bits that vary."""
    import numpy as np
    from itertools import combinations

    p = np.sort(p)
    labels = np.arange(len(p))
    vary = int(np.bitwise_or.reduce(p ^ p[0]))
    for w in range(1, r + 1):
        for bits in combinations([b for b in range(64) if vary >> b & 1], w):
            other = p ^ np.uint64(sum(1 << b for b in bits))
            at = np.searchsorted(p, other)
            hit = np.flatnonzero(p[np.minimum(at, len(p) - 1)] == other)
            hit = hit[at[hit] > hit]
            if len(hit):
                labels = _hook(labels, hit, at[hit])
    k = np.flatnonzero(labels != np.arange(len(p)))
    return p[k], p[labels[k]]


def shard_links(points, r: int, mask: int, block: int = BLOCK):
    """[(points, representatives)]: spanning edges that connect every pair of distinct points (uint64) that is within
    distance r and agrees in the bits of ``mask``."""
    if len(points) < 2:
        return []
    if len(points) <= block:
        return [_block_links(points, r)]
    cut = cut_for(points, mask, r)
    if cut is None:
        return [_block_links(points, r) if len(points) <= 8 * block else _flip_links(points, r)]
    inside, outside = sides(points, cut)
    return shard_links(inside, r, mask, block) + shard_links(outside, r, mask, block)


def link_edges(fps: DataFrame, n: int, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS,
               sample_points: int = SAMPLE_POINTS) -> DataFrame:
    """Spanning edges (u, v) over the distinct fingerprints ``fps`` (column fp; ``n`` rows)."""
    import numpy as np

    masks = bit_blocks(max_bits)
    forest = list(range(len(masks)))  # a small table has one shard per block
    if n > shard_points:
        every = max(1, -(-n // sample_points))
        sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).limit(2 * sample_points).toPandas()["fp"]
        points = np.sort(sample.to_numpy(np.int64).view(np.uint64))
        forest = build_forest(points, max_bits, max(LEAF_SAMPLE, len(points) * shard_points / n))

    def deal(batches):
        import pyarrow as pa

        def routed(points):
            parts = [part for tree in forest for part in route(points, tree)]
            shards = np.repeat(np.array([k for k, _ in parts], np.int64), [len(p) for _, p in parts])
            return pa.RecordBatch.from_arrays([pa.array(shards), pa.array(np.concatenate([p for _, p in parts]).view(np.int64))],
                                              ["shard", "fp"])

        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += len(held[-1])
            if n >= DEAL_POINTS:
                yield routed(np.concatenate(held))
                held, n = [], 0
        if n:
            yield routed(np.concatenate(held))

    def search(key, table):
        import pyarrow as pa

        p = table.column("fp").to_numpy().view(np.uint64)
        parts = shard_links(np.sort(p), max_bits, masks[key[0].as_py() % len(masks)])
        u = np.concatenate([a for a, _ in parts] + [p[:0]])
        v = np.concatenate([b for _, b in parts] + [p[:0]])
        both = np.unique(np.stack([u, v], axis=1), axis=0) if len(u) else np.zeros((0, 2), np.uint64)
        return pa.table({"u": pa.array(both[:, 0].copy().view(np.int64)), "v": pa.array(both[:, 1].copy().view(np.int64))})

    return (fps.select("fp").mapInArrow(deal, "shard bigint, fp bigint")
            .groupBy("shard").applyInArrow(search, "u bigint, v bigint"))


def simhash_groups(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, first_id) for every distinct fingerprint of ``marked`` (rid, doc_id, fp; stored): the component's
    root fingerprint and the fingerprint's smallest doc_id."""
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    edges = link_edges(fps, fps.count(), max_bits)
    roots = connected_components(edges)
    return (fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root"), "first_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    narrow = with_row_id(docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                                     F.col(text_col).cast("string").alias("text")))
    marked = stored(fingerprints(narrow, shingle), "fingerprints")
    groups = stored(simhash_groups(marked, max_bits), "groups")
    first = stored(groups.groupBy("root").agg(F.min("first_id").alias("component_id")), "first-ids")
    by_fp = groups.join(first, "root").select("fp", "component_id")
    return (marked.join(by_fp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row left of each component: the smallest doc_id (nulls last), one of its rows."""
    rid = free_name(docs, "rid__")
    keyed = stored(with_row_id(docs, rid), "docs")
    narrow = keyed.select(F.col(rid).alias("rid"), F.col(id_col).cast("bigint").alias("doc_id"),
                          F.col(text_col).cast("string").alias("text"))
    marked = stored(fingerprints(narrow, shingle), "fingerprints")
    groups = simhash_groups(marked, max_bits).select("fp", "root")
    # one candidate row per fingerprint before anything is grouped by component
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    per_fp = marked.groupBy("fp").agg(first.alias("first"))
    keep = (per_fp.join(groups, "fp").groupBy("root").agg(F.min("first").alias("first"))
            .select(F.col("first.rid").alias(rid)))
    return keyed.join(keep, rid, "left_semi").drop(rid)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
