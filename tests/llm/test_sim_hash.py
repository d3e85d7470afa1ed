import re

import numpy as np
import pytest
import xxhash

from tillroll.llm import sim_hash as S

from .helpers import documents, folder, odd_rows, prose, rng


def slow_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(pairs, reach=2):
    """(id, fp) to the smallest id reachable, by comparing all."""
    fps = sorted({fp for _, fp in pairs})
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= reach:
                root[find(a)] = find(b)
    least = {}
    for i, fp in pairs:
        if i is not None:
            least[find(fp)] = min(i, least.get(find(fp), i))
    return [(i, fp, least.get(find(fp))) for i, fp in pairs]


def test_query_equals_brute_force(spark, tmp_root):
    rows = odd_rows()
    got = S.op7_sim_hash(spark, folder(spark, tmp_root, rows)).collect()
    want = slow_components([(r[0], slow_fingerprint(r[1])) for r in rows])
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == sorted(str((i, f"{fp:016x}", c)) for i, fp, c in want)


@pytest.mark.parametrize("shard", [8, 40, 10_000])
def test_chains_and_clusters_over_many_shards(spark, shard):
    """Links across shard borders, long chains and a dense cluster: each as brute force finds it."""
    r = rng(3)
    fps = [r.getrandbits(64) for _ in range(150)]
    x = r.getrandbits(64)
    chain = [x]
    for bit in range(0, 60, 2):
        chain.append(chain[-1] ^ (3 << bit))
    center = r.getrandbits(64)
    cluster = [center ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(120)]
    every = fps + chain + cluster + [center, center]
    r.shuffle(every)
    pairs = list(enumerate(every))
    frame = spark.createDataFrame([(i, int(np.uint64(fp).astype(np.int64))) for i, fp in pairs], "id long, fp long")
    got = sorted((row.id, row.component_id) for row in S.components(frame, shard=shard).collect())
    assert got == sorted((i, c) for i, _, c in slow_components(pairs))


def test_tree_finds_all_close_pairs():
    r = np.random.default_rng(1)
    points = r.integers(0, 1 << 63, 900, dtype=np.uint64)
    points[300:600] = points[:300] ^ (np.uint64(1) << r.integers(0, 63, 300).astype(np.uint64))
    found = set()
    for q, m in S.close_pairs(points, points, 2, r):
        found.update(zip(q.tolist(), m.tolist()))
    want = {tuple(x) for x in np.argwhere(np.bitwise_count(points[:, None] ^ points[None, :]) <= 2).tolist()}
    assert found == want


def test_equal_points_end_in_one_leaf():
    points = np.full(500, 7, np.uint64)
    leaf = S.build(points, 10, np.random.default_rng(0))
    assert len(leaf) == 500


def test_keep_one(spark):
    r = rng(8)
    a, b = prose(r, 200, 5000), prose(r, 200, 5000)
    rows = [(5, a, "en", "s", 0), (3, a, "en", "s", 0), (3, a, "en", "s", 0), (9, b, None, None, 0), (None, a, "en", "s", 0), (4, None, None, None, None)]
    docs = documents(spark, rows, clash=True)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == ["3", "4", "9", "None"]


def test_empty_table(spark, tmp_root):
    assert S.op7_sim_hash(spark, folder(spark, tmp_root, [])).count() == 0
