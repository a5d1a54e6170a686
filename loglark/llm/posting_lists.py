"""Approximate nearest neighbours by balanced posting lists (operator 9).

Equal vectors are folded to one class, so copies cost one posting.  Centroids
are fitted on a bounded hash sample (``SAMPLE`` vectors, at most ``LISTS``
lists of about ``PER_LIST`` vectors each); clusters of more than twice the mean are split again.  Vectors find
their lists through an in-memory neighbour graph of the centroids (beam search).  A vector goes to its
nearest list and, near a boundary, to further lists whose centroid is almost as
near and not closer to a list already taken.  A query scans the lists whose
centroid is within a distance ratio of its nearest one, of all centroids, up to a share
of the lists (``SHARE``, at least ``PROBES``): in vectors without clusters the ratio
prunes nothing, and a fixed number of lists would lose neighbours as the table grows.
Lists beyond the ratio are scanned too until those taken must hold the neighbours asked for.
Every vector is indexed; a list with more than ``TILE`` postings is cut into tiles, its queries
into blocks of about ``ASKED``, and each tile meets each block.

Scores are cosines of the original vectors in double precision.  Recall against
brute force is measured by the tests.  Defined results: vectors that are null,
zero, of another length than the sample's commonest, or hold null or non-finite
values take no part; equal scores go by id; repeated rows with one id are one
candidate each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglark.llm.common import saved

SAMPLE = 32_768
LISTS = 4_096
PER_LIST = 250
TILE = 4_096
ASKED = 4_096
NEAR = 16          # neighbours of a centroid in the graph
COPIES = 4         # lists a vector may be in
STORE_RATIO = 1.10
PROBES = 48        # lists a query may scan in a small index
SHARE = 4          # it may scan one list in so many in a large one
SEARCH_RATIO = 1.35


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(points: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Balanced k-means on unit vectors."""
    rng = np.random.default_rng(seed)

    def kmeans(x: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        centres = x[rng.choice(len(x), k, replace=False)]
        for _ in range(rounds):
            label = np.concatenate([(x[i:i + 4096] @ centres.T).argmax(1) for i in range(0, len(x), 4096)])
            sums = np.zeros_like(centres)
            np.add.at(sums, label, x)
            size = np.linalg.norm(sums, axis=1)
            centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
        return centres, label

    centres, label = kmeans(points, min(lists, len(points)), 8)
    most, found, todo = 2 * len(points) / max(1, lists), [], [points[label == k] for k in range(len(centres))]
    while todo:
        part = todo.pop()
        if len(part) > max(most, 8):
            two, side = kmeans(part, 2, 4)
            if 0 < side.sum() < len(part):
                todo += [part[side == 0], part[side == 1]]
                continue
        if len(part):
            mean = part.mean(0)
            found.append(mean / max(np.linalg.norm(mean), 1e-9))
    return np.array(found)


class CentroidGraph:
    """Neighbour graph over the centroids with a batched beam search."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        n, near = len(centres), min(NEAR, len(centres) - 1)
        links = [(-(centres[i:i + 1024] @ centres.T)).argsort(1, kind="stable")[:, 1:near + 1] for i in range(0, n, 1024)]
        rng = np.random.default_rng(11)
        far = rng.integers(0, n, (n, 4))  # long links keep the graph in one piece
        self.links = np.concatenate([np.concatenate(links), far], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, distances) of the ``beam`` nearest centroids found per row, nearest first."""
        n, m = len(x), len(self.centres)
        rows = np.arange(n)[:, None]
        beam = min(beam, m)
        seen = np.zeros((n, m), bool)
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        seen[:, self.entries] = True
        dist = self._distance(x, ids)
        done = np.zeros(ids.shape, bool)
        while True:
            order = dist.argsort(1, kind="stable")[:, :beam]
            ids, dist, done = ids[rows, order], dist[rows, order], done[rows, order]
            open_ = ~done & np.isfinite(dist)
            if not open_.any():
                return ids, dist
            pick = open_.argmax(1)[:, None]
            busy = open_.any(1)
            done[rows, pick] = True
            more = self.links[ids[rows, pick][:, 0]]
            d = self._distance(x, more)
            d[seen[rows, more] | ~busy[:, None]] = np.inf
            for k in range(1, more.shape[1]):  # a centroid linked twice counts once
                d[(more[:, :k] == more[:, k:k + 1]).any(1), k] = np.inf
            seen[rows, more] = True
            ids, dist, done = np.hstack([ids, more]), np.hstack([dist, d]), np.hstack([done, np.zeros(more.shape, bool)])

    def _distance(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,nkd->nk", x, self.centres[ids])))

    def store(self, x: np.ndarray) -> list[np.ndarray]:
        ids, dist = self.search(x, 16)
        out = []
        for i, d in zip(ids, dist, strict=True):
            chosen = [i[0]]
            for c, dc in zip(i[1:], d[1:], strict=True):
                if len(chosen) == COPIES or not dc <= STORE_RATIO * d[0]:
                    break
                if (np.linalg.norm(self.centres[chosen] - self.centres[c], axis=1) > dc).all():
                    chosen.append(c)
            out.append(np.array(chosen, np.int32))
        return out

    def probe(self, x: np.ndarray, sizes: np.ndarray | None = None, least: int = 0) -> list[np.ndarray]:
        """Lists to scan per row; with the lists' ``sizes``, they hold at least ``least`` classes if the table does."""
        most, out = min(len(self.centres), max(PROBES, -(-len(self.centres) // SHARE))), []
        for lo in range(0, len(x), 256):  # so many lists are ranked faster than walked to
            d = np.sqrt(np.maximum(0, 2 - 2 * x[lo:lo + 256] @ self.centres.T))
            near = d.argsort(1, kind="stable")
            d = np.take_along_axis(d, near, 1)
            take = d <= SEARCH_RATIO * d[:, :1] + 1e-9
            take[:, most:] = False
            if sizes is not None:  # a class is in at most COPIES lists
                held = np.cumsum(sizes[near], axis=1)
                take |= held - sizes[near] < COPIES * least
            out += [n[t].astype(np.int32) for n, t in zip(near, take, strict=True)]
        return out


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("v")
    good = (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
            & F.col("id").isNotNull())
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(good)


def search(vectors: DataFrame, queries_where: str, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for the rows whose
    ``id`` meets ``queries_where``, among all rows but the query's own."""
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, id_col, vec_col).withColumn("key", F.xxhash64("v"))
    folded = saved(rows.groupBy("key", "v").agg(F.min("id").alias("c")), "ann-classes")
    sample = folded.orderBy(F.xxhash64("key", F.lit(3)), "c").limit(SAMPLE).toPandas()["v"]
    if not len(sample):
        return spark.createDataFrame([], out)
    size = sample.map(len).mode()[0]
    sample = np.stack([x for x in sample if len(x) == size]).astype(float)
    folded = folded.where(F.size("v") == int(size))
    total = folded.count()
    graph = CentroidGraph(fit_centroids(unit(sample), int(np.clip(total // PER_LIST, 1, min(LISTS, max(1, len(sample) // 8))))))

    def routed(name: str, *more):
        def lists(batches):
            for b in batches:
                x = unit(np.stack(b["v"].to_list()).astype(float))
                found = getattr(graph, name)(x, *more)
                n = [len(f) for f in found]
                yield pd.DataFrame({"list": np.concatenate(found), "c": np.repeat(b["c"].to_numpy(), n),
                                    "v": b["v"].repeat(n).to_numpy()})
        return lists

    # queries of one class share one search
    asked = rows.where(queries_where).where(F.size("v") == int(size)).select(F.col("id").alias("query_id"), "key", "v")
    asked = saved(asked.join(folded, ["key", "v"]).select("query_id", "c"), "ann-queries")
    distinct = folded.join(asked.select("c").distinct(), "c").select("c", "v")
    shape = "list int, c long, v array<double>"
    postings = saved(folded.select("c", "v").mapInPandas(routed("store"), shape), "ann-postings")
    held = {r["list"]: r["n"] for r in postings.groupBy("list").agg(F.count("*").alias("n")).collect()}  # at most one row per list
    sizes = np.array([held.get(i, 0) for i in range(len(graph.centres))])
    probes = saved(distinct.mapInPandas(routed("probe", sizes, k + 2), shape), "ann-probes")
    asks = {r["list"]: r["n"] for r in probes.groupBy("list").agg(F.count("*").alias("n")).collect()}
    cut = [(i, -(-n // TILE), max(1, -(-asks.get(i, 0) // ASKED))) for i, n in held.items() if n > TILE or asks.get(i, 0) > ASKED]
    cuts = F.broadcast(spark.createDataFrame(cut, "list int, tiles int, parts int"))
    n_tiles, n_parts = F.coalesce("tiles", F.lit(1)), F.coalesce("parts", F.lit(1))
    postings = (postings.join(cuts, "list", "left").withColumn("tile", F.pmod(F.xxhash64("c"), n_tiles).cast("int"))
                .withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))))
    probes = (probes.join(cuts, "list", "left").withColumn("part", F.pmod(F.xxhash64("c", F.lit(5)), n_parts).cast("int"))
              .withColumn("tile", F.explode(F.sequence(F.lit(0), n_tiles - 1))))

    def scan(key, one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(one) and len(two):
            x = np.stack(two["v"].to_list()).astype(float)
            ids, nx = two["c"].to_numpy(), np.sqrt((x * x).sum(1))
            for lo in range(0, len(one), 64):
                q = np.stack(one["v"].iloc[lo:lo + 64].to_list()).astype(float)
                s = np.einsum("qd,xd->qx", q, x) / (np.sqrt((q * q).sum(1))[:, None] * nx[None])
                for row, qc in zip(s, one["c"].iloc[lo:lo + 64], strict=True):
                    best = np.lexsort((ids, -row))[:k + 1]
                    found.append(pd.DataFrame({"q": qc, "c": ids[best], "score": row[best]}))
        return pd.concat(found) if found else pd.DataFrame({"q": [], "c": [], "score": []})

    hits = (probes.select("list", "tile", "part", "c", "v").groupBy("list", "tile", "part")
            .cogroup(postings.select("list", "tile", "part", "c", "v").groupBy("list", "tile", "part"))
            .applyInPandas(scan, "q long, c long, score double"))
    hits = hits.groupBy("q", "c").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    top = saved(hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "ann-top")
    # the k + 1 smallest ids of each class that was found: enough after the query's own is left out
    wanted = rows.join(folded, ["key", "v"]).join(top.select("c").distinct(), "c").select("c", "id")
    few = wanted.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy("id"))).where(F.col("r") <= k + 1).drop("r")
    near = top.join(few, "c").select("q", F.col("id").alias("vec_id"), "score")
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1).drop("r")
    final = asked.join(near, asked["c"] == near["q"]).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return final.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
