"""SimHash by vantage-point trees against brute force (operator 10)."""

import numpy as np
import pandas as pd
import pytest
import xxhash

from llm.helpers import ODD
from loglark.llm import simhash_vptree as vp


def brute_components(ids, fps, bits):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            best = min(label[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= bits)
            changed, label[i] = changed or best != label[i], best
    least = {}
    for k, i in zip(label, ids):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    return [least.get(k) for k in label]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in values) * 2 > len(values))


def test_components_match_brute_force(make, prose):
    rows = [(i, prose(60)) for i in range(40)]
    rows += [(100 + i, rows[i % 5][1]) for i in range(30)]  # copies
    rows += [(200 + i, rows[i][1].replace(" ", "  ", 3).upper()) for i in range(5)]
    rows += [(300 + i, rows[7][1] + " " + prose(1)) for i in range(10)] + ODD
    got = vp.near_duplicates(make(rows)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    want = sorted(zip([r[0] for r in rows], [f"{f:016x}" for f in fps], brute_components([r[0] for r in rows], fps, 4)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == want


@pytest.mark.parametrize("leaf,tile", [(40, 25), (300, 10_000)])
def test_no_link_is_lost(spark, monkeypatch, leaf, tile):
    monkeypatch.setattr(vp, "LEAF", leaf)
    monkeypatch.setattr(vp, "TILE", tile)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 1500, dtype=np.int64).view(np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64) for _ in range(4)]
    near = base[:400] ^ flips[0] ^ flips[1] ^ flips[2] ^ flips[3]
    cluster = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))
    points = np.unique(np.concatenate([base, near, cluster]))
    links = vp.links(spark.createDataFrame(pd.DataFrame({"fp": points.view(np.int64)}))).toPandas()
    up = {}

    def find(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in zip(links["a"], links["b"]):
        up[find(a)] = find(b)
    i, j = np.nonzero(np.bitwise_count(points[:, None] ^ points[None]) <= 4)
    signed = points.view(np.int64)
    close = {(a, b) for a, b in zip(signed[i].tolist(), signed[j].tolist()) if a < b}
    assert all(find(a) == find(b) for a, b in close)
    assert len({find(a) for a in signed.tolist()}) == len(_groups(close, signed.tolist()))  # and none is invented


def _groups(pairs, nodes):
    up = {n: n for n in nodes}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in pairs:
        up[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), []).append(n)
    return list(out.values())


def test_parts_cover_every_distance():
    for bits in range(9):
        parts = vp.parts(bits)
        assert sum(r + 1 for _, r in parts) == bits + 1
        assert sum(m for m, _ in parts) == (1 << 64) - 1


def test_one_of_each_group_stays(make, prose):
    rows = [(i, prose(50)) for i in range(6)]
    rows += [(50, rows[0][1]), (51, rows[0][1]), (3, rows[3][1]), (None, rows[1][1])]
    kept = vp.keep_one_each(make(rows))
    assert kept.columns == make(rows).columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([0, 1, 2, 3, 4, 5, None], key=repr)


def test_empty_table(make):
    assert vp.near_duplicates(make([])).collect() == [] and vp.keep_one_each(make([])).collect() == []
