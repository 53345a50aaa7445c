from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from critica.llm import simhash_dedup as S
from critica.llm.graph import connected_components
from tests.llm.data import empty, frame, rows


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    votes = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        votes.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))


def components(fps, r):
    group = list(range(len(fps)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= r:
            a, b = find(i), find(j)
            group[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_components_by_brute_force(spark):
    data = rows()
    fps = [slow_fingerprint(r[1]) for r in data]
    roots = components(fps, 2)
    ids: dict = {}
    for r, root in zip(data, roots):
        if r[0] is not None:
            ids[root] = min(r[0], ids.get(root, r[0]))
    want = [(r[0], f"{f:016x}", ids.get(root)) for r, f, root in zip(data, fps, roots)]
    got = S.near_duplicates(frame(spark)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def planted(n, seed=0):
    """Random fingerprints with a dense cluster and scattered close pairs."""
    rng = np.random.default_rng(seed)
    p = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    for k in range(n // 5):
        flips = rng.integers(0, 64, rng.integers(1, 4))
        p[n // 2 + k] = p[k] ^ np.uint64(sum(1 << int(b) for b in set(flips.tolist())))
    centre = p[0]
    for k in range(n // 4):
        p[n - 1 - k] = centre ^ np.uint64(sum(1 << int(b) for b in set(rng.integers(0, 16, 5).tolist())))
    return np.unique(p)


def same_partition(points, parts, r):
    labels = {int(x): int(x) for x in points}

    def find(x):
        while labels[x] != x:
            x = labels[x]
        return x

    for u, v in parts:
        for a, b in zip(u.tolist(), v.tolist()):
            assert bin(a ^ b).count("1") <= 64
            x, y = find(a), find(b)
            labels[max(x, y)] = min(x, y)
    want = components([int(x) for x in points], r)
    mine = [find(int(x)) for x in points]
    return len(set(want)) == len(set(mine)) and len(set(zip(want, mine))) == len(set(want))


def test_blocks_share_the_bits():
    for r in range(6):
        masks = S.bit_blocks(r)
        assert len(masks) == r + 1 and sum(masks) == S.ALL_BITS
        assert all(a & b == 0 for a, b in combinations(masks, 2))


@pytest.mark.parametrize("r", [0, 1, 2, 5])
def test_shards_find_every_link(r):
    p = planted(900)
    parts = [e for mask in S.bit_blocks(r) for e in S.shard_links(p, r, mask, block=32)]
    assert same_partition(p, parts, r)


@pytest.mark.parametrize("r", [1, 2])
def test_upper_trees_lose_no_link(r):
    p = planted(900, seed=3)
    forest = S.build_forest(p[::3], r, 40)
    masks = S.bit_blocks(r)
    assert all(isinstance(tree, tuple) for tree in forest)
    shards = [part for tree in forest for part in S.route(p, tree)]
    assert len({k for k, _ in shards}) == len(shards)
    parts = [e for k, shard in shards for e in S.shard_links(shard, r, masks[k % len(masks)], block=16)]
    assert same_partition(p, parts, r)


def test_boundary_copies_lose_no_link():
    """Points that agree in a block are cut over all bits: whoever is near the boundary is on both sides."""
    rng = np.random.default_rng(7)
    mask = S.bit_blocks(2)[0]
    p = np.unique(planted(3000, seed=5) & ~np.uint64(mask) | np.uint64(0x155))
    cut = S.cut_for(p, mask, 2)
    assert cut[2:] == (S.ALL_BITS, 2)
    inside, outside = S.sides(p, cut)
    assert set(inside.tolist()) & set(outside.tolist())
    assert max(len(inside), len(outside)) < 0.9 * len(p)
    assert same_partition(p, S.shard_links(p[rng.permutation(len(p))], 2, mask, block=64), 2)


@pytest.mark.parametrize("n", [100_000, 400_000, 1_600_000])
def test_copies_and_shards_do_not_grow_with_the_table(n):
    rng = np.random.default_rng(n)
    p = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64))
    sample = np.sort(rng.permutation(p)[:20_000])
    forest = S.build_forest(sample, 2, max(S.LEAF_SAMPLE, len(sample) * 20_000 / n))
    sizes = [len(part) for tree in forest for _, part in S.route(p, tree)]
    assert sum(sizes) == 3 * len(p)
    assert max(sizes) < 25_000


def test_links_through_shards_equal_one_shard(spark):
    p = planted(6000, seed=11)
    fps = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp bigint").repartition(4)
    found = [{(r.node, r.root) for r in connected_components(S.link_edges(fps, len(p), 2, shard_points, 1500)).collect()}
             for shard_points in (300, len(p))]
    assert found[0] == found[1] and found[0]


def test_block_that_cannot_be_split():
    base = np.uint64(0x0123456789ABCDEF)
    p = np.unique(np.array([base ^ np.uint64(1 << b) for b in range(64)] + [base ^ np.uint64(0xFF << 40)], np.uint64))
    assert same_partition(p, [S._flip_links(p, 2)], 2)


def test_connected_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "u bigint, v bigint")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_drop_keeps_one_row_per_component(spark):
    data = rows()
    kept = S.drop_near_duplicates(frame(spark))
    assert kept.columns == frame(spark).columns
    roots = components([slow_fingerprint(r[1]) for r in data], 2)
    first: dict = {}
    for r, root in zip(data, roots):
        key = (r[0] is None, r[0] or 0)
        first[root] = min(key, first.get(root, key))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(k[1] for k in first.values() if not k[0])


def test_empty_table(spark):
    assert S.near_duplicates(empty(spark)).count() == 0
    assert S.drop_near_duplicates(empty(spark)).count() == 0
