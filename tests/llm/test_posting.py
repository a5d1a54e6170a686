"""Nearest neighbours by posting lists (operator 9): recall and exact scores."""

import numpy as np

from loglark.llm import posting_lists as pl
from loglark.llm.common import prepare
from loglark.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def brute(ids, x, asked, k=5):
    x = x.astype(float)
    norm = np.sqrt((x * x).sum(1))
    out = {}
    for q in asked:
        i = int(np.flatnonzero(ids == q)[0])
        s = (x @ x[i]) / (norm * norm[i])
        s[i] = -9
        out[q] = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -np.round(s, 12)))[:k]]
    return out


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_list())
    got = QUERIES["op9_posting_search"](spark, SF).toPandas()
    want = brute(ids, x, [i for i in ids if i % 50 == 0])
    found = {q: g.sort_values("rank") for q, g in got.groupby("query_id")}
    assert set(found) == set(want)
    hits = sum(len({v for v, _ in want[q]} & set(found[q]["vec_id"])) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q, g in found.items():
        exact = {v: s for v, s in brute(ids, x, [q], len(ids) - 1)[q]} if q % 1000 == 0 else {}
        assert all(abs(exact[v] - s) < 1e-12 for v, s in zip(g["vec_id"], g["score"]) if v in exact)
        assert list(g["rank"]) == list(range(1, 6)) and list(g["score"]) == sorted(g["score"], reverse=True)


def test_copies_odd_vectors_and_ties(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(pl, "TILE", 40)
    rng = np.random.default_rng(2)
    vec = [rng.standard_normal(8).astype(float).tolist() for _ in range(120)]
    rows = [(i, v, 1) for i, v in enumerate(vec)] + [(1000 + i, vec[0], 2) for i in range(300)]
    rows += [(2000, None, 1), (2050, [0.0] * 8, 1), (2100, [float("nan")] * 8, 1), (2150, [None] * 8, 1), (2200, [float("inf")] * 8, 1),
             (2250, [1.0] * 3, 1), (None, vec[3], 1)]
    got = pl.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, list int"), "id % 50 = 0").toPandas()
    assert set(got["query_id"]) == {0, 50, 100, 1000, 1050, 1100, 1150, 1200, 1250}
    copies = got[got["query_id"] == 1050].sort_values("rank")
    assert list(copies["vec_id"]) == [0, 1000, 1001, 1002, 1003] and np.allclose(copies["score"], 1)
    assert list(got[got["query_id"] == 0].sort_values("rank")["vec_id"]) == [1000, 1001, 1002, 1003, 1004]


def test_few_and_none(spark):
    prepare(spark)
    shape = "vec_id long, embedding array<double>"
    assert pl.search(spark.createDataFrame([], shape), "id % 50 = 0").collect() == []
    assert pl.search(spark.createDataFrame([(0, [1.0, 0.0])], shape), "id % 50 = 0").collect() == []
    got = pl.search(spark.createDataFrame([(0, [1.0, 0.0]), (7, [1.0, 1.0]), (8, [0.0, -1.0])], shape), "id % 50 = 0").collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 7), (2, 8)]


def test_recall_holds_as_the_lists_grow():
    """Vectors without clusters, many more lists than PROBES: the share of true neighbours in a probed list."""
    rng = np.random.default_rng(4)
    for n, floor in ((20_000, 0.97), (100_000, 0.96), (200_000, 0.96)):
        x = pl.unit(rng.standard_normal((n, 64)))
        graph = pl.CentroidGraph(pl.fit_centroids(x[:pl.SAMPLE], n // pl.PER_LIST))
        asked = rng.choice(n, 100, replace=False)
        score = x[asked] @ x.T
        score[np.arange(100), asked] = -9
        near = np.argpartition(-score, 5, axis=1)[:, :5]
        probed = graph.probe(x[asked])
        assert len(graph.centres) > pl.PROBES
        hits = [np.isin(held, probed[i]).any() for i, top in enumerate(near) for held in graph.store(x[top])]
        assert np.mean(hits) >= floor, (n, np.mean(hits))


def test_isolated_query_gets_its_neighbours(spark, monkeypatch):
    """A vector that is a list of its own lies on its centroid; its queries come in several blocks."""
    prepare(spark)
    monkeypatch.setattr(pl, "PER_LIST", 10)
    monkeypatch.setattr(pl, "ASKED", 3, raising=False)
    rng = np.random.default_rng(6)
    near = rng.standard_normal((120, 8)) * 0.01 + np.eye(8)[0]
    x = np.concatenate([near, [-np.eye(8)[k] for k in range(8)]])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = pl.search(table, "vec_id >= 100").toPandas()
    assert all(list(got[got["query_id"] == q].sort_values("rank")["rank"]) == [1, 2, 3, 4, 5] for q in range(100, 128))
