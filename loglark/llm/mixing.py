"""Mixing sources to target weights by min-cost flow (operator 1).

Documents may belong to several sources.  They are aggregated to membership
patterns (the set of a document's sources); a flow then carries words from
patterns to source quotas.  Taking a pattern's words once costs nothing, a
second time more, a third time more still (``COSTS``, convex), so words are
repeated only where quotas cannot be met otherwise.  The flow is solved on the
patterns, whose number depends on the declared sources and not on the
documents; more than ``MAX_PATTERNS`` raise an error.

Of a pattern's flow, whole passes take every document, and the rest is filled
with documents in the order of a seeded hash.  Where that order crosses the
rest is found by histograms of the hash (4,096 slices, then 4,096 slices of the
one slice that crosses), so no source is ever sorted or gathered in one task; a
document is taken if more than half of it fits.

Defined results: null or blank text has size 0 and takes 0 words; repeated rows
are documents of their own; a null source is a source, last in order; an empty table
gives an empty result.  Other columns may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglark.llm.common import packed, saved, unpacked, word_count

COSTS = (0, 1, 3)
MAX_PATTERNS = 100_000
SLICE_BITS = 12


def quotas(sizes: Sequence[int], weights: Sequence[float], most: float = 3.0) -> list[float]:
    """Targets in proportion to ``weights`` that add up to all sizes; none is
    above ``most`` times its source's size, the excess is shared by weight."""
    total, targets, free = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while free:
        scale = left / sum(weights[i] for i in free)
        full = [i for i in free if scale * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                targets[i] = scale * weights[i]
            break
        for i in full:
            targets[i] = most * sizes[i]
            free.discard(i)
        left = total - sum(t for i, t in enumerate(targets) if i not in free)
    return targets


def min_cost_flow(supply: Sequence[int], members: Sequence[Sequence[int]], demand: Sequence[int],
                  costs: Sequence[int] = COSTS) -> list[dict[int, int]]:
    """Flow pattern -> {source: words}, of largest amount and least cost.

    Pattern p offers ``supply[p]`` words at each of the rising ``costs``; it may
    feed the sources ``members[p]``, each up to ``demand``.  Shortest augmenting
    paths with potentials, on integers.
    """
    n_p, n_s = len(supply), len(demand)
    end = 1 + n_p + n_s
    graph: list[list[list[int]]] = [[] for _ in range(end + 1)]  # to, capacity, cost, index of the reverse arc

    def arc(a: int, b: int, capacity: int, cost: int) -> None:
        graph[a].append([b, capacity, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p, size in enumerate(supply):
        for cost in costs:
            arc(0, 1 + p, size, cost)
        for s in members[p]:
            arc(1 + p, 1 + n_p + s, len(costs) * size, 0)
    for s, want in enumerate(demand):
        arc(1 + n_p + s, end, want, 0)
    price = [0] * (end + 1)
    while True:
        far: list = [None] * (end + 1)
        far[0], came, heap = 0, {}, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k, (b, capacity, cost, _) in enumerate(graph[a]):
                if capacity > 0 and (far[b] is None or d + cost + price[a] - price[b] < far[b]):
                    far[b] = d + cost + price[a] - price[b]
                    came[b] = (a, k)
                    heapq.heappush(heap, (far[b], b))
        if far[end] is None:
            break
        most = max(d for d in far if d is not None)
        price = [x + (most if d is None else d) for x, d in zip(price, far, strict=True)]
        path, at = [], end
        while at:
            a, k = came[at]
            path.append(graph[a][k])
            at = a
        amount = min(x[1] for x in path)
        for x in path:
            x[1] -= amount
            graph[x[0]][x[3]][1] += amount
    return [{b - 1 - n_p: graph[b][back][1] for b, _, cost, back in graph[1 + p] if b > n_p and graph[b][back][1] > 0}
            for p in range(n_p)]


def by_source(docs: DataFrame, source: Column, text: Column) -> DataFrame:
    """Size and hash of every document, the rest of its columns dropped."""
    return docs.select(F.col("doc_id"), source.alias("member"), word_count(text).alias("size"), F.xxhash64("doc_id", text).alias("digest"))


def mix(sized: DataFrame, targets: dict[str | None, float], seed: int = 0) -> DataFrame:
    """``sized(doc_id, member, size, digest)`` plus ``taken``: words the mix takes.

    ``member`` is an array of source names (a document without a named source
    is not taken); ``targets`` gives each source's words.
    """
    spark = sized.sparkSession
    rows = sized.withColumn("pattern", F.to_json(F.struct(F.sort_array(F.array_distinct("member")).alias("m"))))
    rows = saved(rows.withColumn("order", F.xxhash64("digest", F.lit(seed))), "mix-sized")
    patterns = (rows.groupBy("pattern").agg(F.first("member").alias("member"), F.sum("size").alias("size"))
                .orderBy("pattern").limit(MAX_PATTERNS + 1).collect())
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    names = sorted(targets, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    flow = min_cost_flow([p["size"] for p in patterns], [sorted({number[s] for s in p["member"] or [] if s in number}) for p in patterns],
                         [round(targets[s]) for s in names])
    plan = [(p["pattern"], sum(f.values()) // p["size"] if p["size"] else 0, sum(f.values()) % p["size"] if p["size"] else 0)
            for p, f in zip(patterns, flow, strict=True)]
    # at most MAX_PATTERNS rows
    plan_df = F.broadcast(spark.createDataFrame(plan, "pattern string, passes long, rest long"))
    planned = rows.join(plan_df, "pattern")
    slice_of = lambda level: F.shiftrightunsigned("order", 64 - SLICE_BITS * level)

    def crossing(found: DataFrame, level: int, before: Column) -> DataFrame:
        """Per pattern the slice in which the running size passes the rest, and the size before it."""
        slices = found.groupBy("pattern", "rest", before.alias("start"), slice_of(level).alias("slice")).agg(F.sum("size").alias("in_slice"))
        run = F.sum("in_slice").over(Window.partitionBy("pattern").orderBy("slice")) + F.col("start")
        return (slices.withColumn("upto", run).where("upto >= rest").groupBy("pattern")
                .agg(F.min(F.struct(F.col("slice"), (F.col("upto") - F.col("in_slice")).alias("before"))).alias("x"))
                .select("pattern", F.col("x.slice").alias(f"slice{level}"), F.col("x.before").alias(f"before{level}")))

    one = crossing(planned, 1, F.lit(0).cast("long"))
    inside = planned.join(F.broadcast(one), "pattern").where(slice_of(1) == F.col("slice1"))
    two = crossing(inside, 2, F.col("before1"))
    marked = planned.join(F.broadcast(one.join(two, "pattern")), "pattern", "left")
    at = slice_of(2)
    edge = marked.where(at == F.col("slice2"))
    run = F.sum("size").over(Window.partitionBy("pattern").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    fits = F.coalesce(run, F.lit(0)) + F.col("before2") + F.col("size") / 2 <= F.col("rest")
    columns = [*sized.columns]
    taken = lambda chosen: (F.col("size") * (F.col("passes") + F.when(chosen & (F.col("rest") > 0), 1).otherwise(0))).cast("long")
    sure = marked.where("slice2 is null or not (" + f"shiftrightunsigned(order, {64 - 2 * SLICE_BITS}) = slice2)")
    return (sure.select(*columns, taken(F.coalesce(at < F.col("slice2"), F.lit(False))).alias("taken"))
            .unionByName(edge.withColumn("fits", fits).select(*columns, taken(F.col("fits")).alias("taken"))))


def weigh(sized: DataFrame, cycle: Sequence[float] = (1, 2, 3)) -> tuple[dict, dict]:
    """(source -> size, source -> target) for documents of one source each:
    sources in code point order, null last, weigh ``cycle`` over and over."""
    per = sized.groupBy(F.col("member")[0].alias("source")).agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(per) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources")
    sizes = {r["source"]: r["size"] for r in sorted(per, key=lambda r: (r["source"] is None, r["source"] or ""))}
    weights = [cycle[i % len(cycle)] for i in range(len(sizes))]
    return sizes, dict(zip(sizes, quotas([*sizes.values()], weights), strict=True))


def mix_by_source(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Every document with size, source_size, target (of its source) and taken."""
    sized = saved(by_source(docs, F.array("source"), F.col("text")), "mix-sizes")
    sizes, targets = weigh(sized)
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, source string, size long, source_size long, target double, taken long, digest long")
    per = F.broadcast(docs.sparkSession.createDataFrame([(s, sizes[s], float(targets[s])) for s in sizes],
                                                        "source string, source_size long, target double"))
    mixed = mix(sized, targets, seed).withColumn("source_", F.col("member")[0])
    return (mixed.join(per, mixed["source_"].eqNullSafe(per["source"]))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "digest"))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` that the mix takes, a document taken k times k times over."""
    taken = mix_by_source(docs, seed).where("taken > 0").select("doc_id", "digest", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    # repeated rows are alike: their passes are added up and dealt to one of them
    taken = taken.groupBy("doc_id", "digest").agg(F.sum("times").cast("int").alias("times"))
    keyed = packed(docs, id=F.col("doc_id"), key=F.xxhash64("doc_id", "text"), source=F.col("source"))
    joined = keyed.join(taken, keyed["id"].eqNullSafe(taken["doc_id"]) & (keyed["key"] == taken["digest"]))
    alike = Window.partitionBy("id", "key").orderBy("source")
    first = joined.withColumn("nth", F.row_number().over(alike)).where("nth = 1")
    return unpacked(first.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times")))), docs.columns)
