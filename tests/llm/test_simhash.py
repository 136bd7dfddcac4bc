import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import connected_components


def plain_fingerprint(text, width=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, distance):
    """Smallest id reachable for each ``(id, fingerprint)``, by all pairs."""
    parent = list(range(len(items)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(items):
        r = find(i)
        if k is not None:
            least[r] = min(least.get(r, k), k)
    return [least.get(find(i)) for i in range(len(items))]


def test_awkward_rows_equal_brute_force(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    fps = [(k, plain_fingerprint(t)) for k, t in rows]
    want = sorted(zip([k for k, _ in fps], [f for _, f in fps], brute_components(fps, 3)), key=str)
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.simhash_components(awkward).collect()]
    assert sorted(got, key=str) == want


def test_empty_table(empty):
    assert simhash.simhash_components(empty).collect() == []


@pytest.mark.parametrize("distance, segments", [(3, 8), (2, 8), (3, 4), (1, 4), (4, 10), (0, 2)])
def test_chain_keys_lose_no_pair(distance, segments):
    """Every pair within the distance shares a key that keeps all chain budgets from its first segment on."""
    rng = random.Random(distance * 100 + segments)
    plans = simhash.chain_plan(distance, segments)
    edges = simhash._segment_edges(segments)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, distance)):
            b ^= 1 << bit
        found = False
        for first, chosen in plans:
            if all((a ^ b) >> edges[s] & ((1 << (edges[s + 1] - edges[s])) - 1) == 0 for s in chosen):
                pair = [np.array([x], dtype=np.uint64) for x in (a, b)]
                found |= bool(simhash._linked(*pair, np.array([first]), distance, segments)[0])
        assert found


@pytest.mark.parametrize("block", [4096, 7])
def test_edges_connect_what_all_pairs_connect(spark, block):
    """A large group of near copies, also when its bucket is dealt as pairs of blocks."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base, 0, (1 << 64) - 1, 7}
    for _ in range(120):
        x = base
        for bit in rng.sample(range(12), rng.randint(0, 5)):
            x ^= 1 << bit
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    items = [(int(np.uint64(f).astype(np.int64)), f) for f in fps]
    df = spark.createDataFrame([(k,) for k, _ in items], "fp bigint")
    edges = simhash.fingerprint_edges(df, 3, block=block)
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert [roots.get(k, k) for k, _ in items] == brute_components(items, 3)


def test_keep_one_returns_whole_rows(spark, awkward):
    kept = simhash.keep_one(awkward, simhash.simhash_components(awkward))
    assert kept.columns == awkward.columns
    rows = kept.collect()
    classes = simhash.simhash_components(awkward).collect()
    assert len(rows) == len({r.root for r in classes})
    ids = [r.doc_id for r in rows]
    assert 5 in ids and 6 not in ids and ids.count(5) == 1 and 1 in ids and 2 not in ids


def test_components_of_paths_hubs_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 60)]
    odd = [(500, 500), (None, 3), (700, 701), (701, 700), (702, 701)]
    df = spark.createDataFrame(path + hub + odd, "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(df).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 60)} | {700: 700, 701: 700, 702: 700}
    assert got == want
    assert connected_components(df.limit(0)).collect() == []
