"""Mixing by min-cost flow (operator 1)."""

from pyspark.sql import functions as F

from llm.helpers import ODD
from loglark.llm import mixing
from loglark.llm.common import word_count


def test_quotas_stop_at_three_times_and_add_up():
    sizes, weights = [10, 1000, 5, 300, 0], [1, 2, 3, 1, 2]
    got = mixing.quotas(sizes, weights)
    assert abs(sum(got) - sum(sizes)) < 1e-6
    assert all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))
    assert got[0] == 30 and got[2] == 15 and got[4] == 0
    assert abs(got[1] / 2 - got[3]) < 1e-6  # those below their stop share by weight


def test_flow_is_cheapest():
    # pattern 0 feeds both sources, 1 only the first: nothing is repeated while fresh words are left
    flow = mixing.min_cost_flow([100, 50], [[0, 1], [0]], [60, 90])
    assert flow == [{0: 10, 1: 90}, {0: 50}] and sum(sum(f.values()) for f in flow) == 150
    # the second pass costs less than the third, so two patterns are repeated before one is taken three times
    flow = mixing.min_cost_flow([10, 10], [[0], [0]], [40])
    assert [f[0] for f in flow] == [20, 20]
    assert mixing.min_cost_flow([5], [[]], [9]) == [{}]


def brute_cost(take, size):
    return sum(c * max(0, min(take - k * size, size)) for k, c in enumerate(mixing.COSTS))


def test_flow_against_enumeration():
    import itertools
    supply, members, demand = [3, 2, 2], [[0], [0, 1], [1]], [6, 5]
    flow = mixing.min_cost_flow(supply, members, demand)
    cost = sum(brute_cost(sum(f.values()), s) for f, s in zip(flow, supply))
    best = None
    for a, (b0, b1), c in itertools.product(range(10), itertools.product(range(7), range(7)), range(7)):
        if a + b0 <= demand[0] and b1 + c <= demand[1] and b0 + b1 <= 6:
            key = (-(a + b0 + b1 + c), brute_cost(a, 3) + brute_cost(b0 + b1, 2) + brute_cost(c, 2))
            best = key if best is None or key < best else best
    assert (-sum(sum(f.values()) for f in flow), cost) == best


def test_mix_meets_targets_and_repeats(make, prose):
    rows = [(i, prose(5 + i % 30), "en", f"s{i % 7 if i % 7 < 4 else 0}") for i in range(600)]
    rows += [(1000 + i, prose(20), "en", None) for i in range(40)] + [(*o, "en", "s1") for o in ODD]
    docs = make(rows)
    got = mixing.mix_by_source(docs).collect()
    again = mixing.mix_by_source(docs.repartition(5)).collect()
    key = lambda r: (repr(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert len(got) == len(rows)
    sizes, targets, taken = {}, {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        targets[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.quotas([sizes[n] for n in names], [1, 2, 3, 1, 2][:len(names)])
    for n, w in zip(names, want):
        assert abs(targets[n] - w) < 1e-6 and abs(taken[n] - w) <= 20


def test_overlapping_sources(spark, make, prose):
    docs = make([(i, prose(10)) for i in range(300)])
    member = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("a"))).when(F.col("doc_id") % 3 == 1, F.array(F.lit("b"), F.lit("a"))).otherwise(
        F.array(F.lit("b")))
    sized = docs.select("doc_id", member.alias("member"), word_count(F.col("text")).alias("size"), F.xxhash64("doc_id").alias("digest"))
    taken = mixing.mix(sized, {"a": 1500.0, "b": 1000.0}, seed=3)
    total = taken.agg(F.sum("taken")).first()[0]
    assert abs(total - 2500) <= 30  # all fresh words but 500 would be left: nothing is taken twice
    assert taken.where("taken > size").count() == 0


def test_mixed_documents_repeat_rows(make, prose):
    rows = [(i, prose(10), "en", "small") for i in range(20)] + [(100 + i, prose(10), "en", "a") for i in range(400)]
    docs = make(rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    n = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert n["small"] == 60 and 355 <= n["a"] <= 365
    assert mixing.mixed_documents(make([])).collect() == []
