"""SimHash near-duplicates by vantage-point trees (operator 10).

A document's 64-bit fingerprint is the bitwise majority of the XXH64 values of
its word shingles.  Two fingerprints link when they differ in at most
``max_bits`` bits; linked fingerprints form components.

Search.  Equal fingerprints are folded first, so a group of copies costs one
point.  Distances between random 64-bit values crowd around 32, where triangle
bounds prune little, so the forest measures distance on parts of the
fingerprint: radii are dealt so that a pair within ``max_bits`` is within a
part's radius in at least one part (for 4 bits: 21 bits within 1, 21 bits
within 1, 22 bits equal).  Each part has one vantage-point tree: an inner node
holds a point and a cut, fingerprints within the cut go inside, others outside.
If d(x, vp) <= cut < d(y, vp) and x, y are within r, the triangle bound puts
d(x, vp) above cut - r: exactly those x also visit the outer shards as guests
and are compared with the points that live there.  No pair is lost.

Trees are shaped on a bounded hash sample of the distinct fingerprints
(``SAMPLE``); the shape only decides where work goes, never what is found.
A shard with more than ``TILE`` residents is cut into tiles, residents of
earlier tiles being guests of later ones.  A tile returns its local components as
(point, local root) links: fewer rows than points, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglark.llm.common import packed, saved, unpacked
from loglark.llm.graph import connected_components

SAMPLE = 20_000
LEAF = 1_500
TILE = 6_000


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash.  Words are ``[^\\x20\\x09-\\x0D]+`` of the text
    with A-Z lower-cased; shorter texts are one shingle, no words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    last = ends[width - 1:] if len(words) >= width else ends[-1:]
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        h = np.fromiter((xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in
                         zip(starts[lo:hi].tolist(), last[lo:hi].tolist(), strict=True)), "<u8", hi - lo)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp) with fp the fingerprint as a signed long; null text has fp 0."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"))


def parts(max_bits: int) -> list[tuple[int, int]]:
    """(mask, radius) per part: radii + 1 add up to ``max_bits`` + 1."""
    radii = [1] * ((max_bits + 1) // 2) + [0] * ((max_bits + 1) % 2)
    cuts = [round(64 * i / len(radii)) for i in range(len(radii) + 1)]
    return [(((1 << (b - a)) - 1) << a, r) for a, b, r in zip(cuts[:-1], cuts[1:], radii, strict=True)]


def distance(x: np.ndarray, y, mask: int) -> np.ndarray:
    return np.bitwise_count((x ^ np.uint64(y)) & np.uint64(mask)).astype(np.int16)


def build_tree(sample: np.ndarray, total: int, mask: int, radius: int, leaf: int = LEAF) -> list:
    """Nodes (vp, cut, inner, outer), or None for a leaf, in a list; the root is 0."""
    nodes: list = []
    scale = total / max(1, len(sample))
    rng = np.random.default_rng(7)

    def grow(points: np.ndarray, guests: float) -> int:
        at = len(nodes)
        nodes.append(None)
        if len(points) * scale <= leaf or len(points) < 8:
            return at
        best = None
        for vp in points[rng.integers(0, len(points), 6)]:
            d = distance(points, vp, mask)
            seen = np.bincount(d, minlength=66)
            upto = np.cumsum(seen)
            for cut in range(65):
                inside, outside = upto[cut], len(points) - upto[cut]
                visit = upto[cut] - (upto[cut - radius] if cut >= radius else 0) if radius else 0
                if inside and outside:
                    cost = inside * inside + outside * (outside + 2 * visit)
                    if best is None or cost < best[0]:
                        best = (cost, int(vp), cut, d, visit)
        if best is None or best[0] > 0.9 * len(points) ** 2:
            return at
        _, vp, cut, d, visit = best
        inner = grow(points[d <= cut], 0)
        outer = grow(points[d > cut], visit)
        nodes[at] = (vp, cut, inner, outer)
        return at

    grow(sample, 0)
    return nodes


def route(points: np.ndarray, nodes: list, mask: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of point, leaf, guest?) for every leaf a point lives in or visits."""
    found: list = []
    todo = [(0, np.arange(len(points)), np.zeros(len(points), bool))]
    while todo:
        at, idx, guest = todo.pop()
        if not len(idx):
            continue
        if nodes[at] is None:
            found.append((idx, np.full(len(idx), at), guest))
            continue
        vp, cut, inner, outer = nodes[at]
        d = distance(points[idx], vp, mask)
        inside = d <= cut
        go_in = np.where(guest, d - radius <= cut, inside)
        go_out = np.where(guest, d + radius > cut, ~inside | (d + radius > cut))
        todo.append((inner, idx[go_in], guest[go_in]))
        todo.append((outer, idx[go_out], (guest | inside)[go_out]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def tile_links(points: np.ndarray, guest: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Local components over all (resident, anyone) pairs within ``max_bits``:
    (point, root) rows for the points that are not their own root."""
    points = points[np.argsort(guest, kind="stable")]
    homes = int((~guest).sum())
    label = np.arange(len(points))
    block = max(1, (1 << 20) // max(1, len(points)))
    for lo in range(0, homes, block):
        hi = min(homes, lo + block)
        near = np.bitwise_count(points[lo:hi, None] ^ points[None, :]) <= max_bits
        for i in np.flatnonzero(near.sum(1) > 1):
            roots = np.unique(label[near[i]])
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    moved = label != np.arange(len(points))
    return points[moved], points[label[moved]]


def links(distinct_fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are
    those of the graph of all pairs within ``max_bits`` bits."""
    spark = distinct_fps.sparkSession
    total = distinct_fps.count()
    sample = (distinct_fps.select("fp").orderBy(F.xxhash64("fp", F.lit(1)), "fp").limit(SAMPLE).toPandas()["fp"]
              .to_numpy(np.int64).view(np.uint64))
    trees = [(mask, r, build_tree(sample, total, mask, r)) for mask, r in parts(max_bits)]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            for t, (mask, r, nodes) in enumerate(trees):
                idx, leaf, guest = route(fps.view(np.uint64), nodes, mask, r)
                yield pd.DataFrame({"tree": t, "leaf": leaf, "fp": fps[idx], "guest": guest})

    dealt = saved(distinct_fps.select("fp").mapInPandas(deal, "tree int, leaf int, fp long, guest boolean"), "vp-dealt")
    # one row per leaf: bounded by the sample the trees were shaped on
    big = {(r.tree, r.leaf): -(-r.n // TILE) for r in dealt.where("not guest").groupBy("tree", "leaf")
           .agg(F.count("*").alias("n")).where(F.col("n") > TILE).collect()}
    if big:
        tiles = spark.createDataFrame([(*k, n) for k, n in big.items()], "tree int, leaf int, tiles int")
        dealt = dealt.join(F.broadcast(tiles), ["tree", "leaf"], "left").fillna(1, ["tiles"])
        own = F.pmod(F.xxhash64("fp", F.lit(2)), F.col("tiles")).cast("int")
        dealt = (dealt.withColumn("own", own)
                 .withColumn("tile", F.explode(F.when(F.col("guest"), F.sequence(F.lit(0), F.col("tiles") - 1))
                                               .otherwise(F.sequence(F.col("own"), F.col("tiles") - 1))))
                 .withColumn("guest", F.col("guest") | (F.col("tile") != F.col("own"))))
    else:
        dealt = dealt.withColumn("tile", F.lit(0))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = tile_links(pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["guest"].to_numpy(bool), max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (dealt.select("tree", "leaf", "tile", "fp", "guest").groupBy("tree", "leaf", "tile")
            .applyInPandas(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id
    (smallest doc_id reachable over links).

    Null text counts as empty; empty texts share fingerprint zero, which links
    like any other.  Repeated rows give repeated rows.  A row with a null doc_id
    gets its component's smallest id, null if there is none.  Other columns are
    ignored; an empty table gives an empty result.
    """
    fps = saved(fingerprints(docs, id_col, text_col, width), "simhash")
    distinct = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    roots = connected_components(links(distinct, max_bits))
    rooted = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return (fps.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one_each(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest doc_id, then the
    smallest hash of doc_id and text (one of them if rows repeat).  Two texts under one doc_id are two
    documents: each stays unless it is a copy.  Rows without a doc_id
    cannot be named as a copy of another and stay.  Columns may have any names.
    """
    key = F.xxhash64("doc_id", "text")
    known = docs.where("doc_id is not null")
    # the id that names a component is the pair, so no two components share one
    found = near_duplicates(known.select(F.struct("doc_id", key.alias("key")).alias("id"), "text"), "id", "text", width, max_bits)
    kept = found.select(F.col("component_id.key").alias("kept")).distinct()
    rows = packed(known, key=key)
    chosen = rows.join(kept, rows["key"] == kept["kept"], "left_semi")
    # the join deals rows by key, and numbering the few rows of one key needs no second shuffle
    again = F.row_number().over(Window.partitionBy("key").orderBy(F.to_json("doc")))
    named = unpacked(chosen.withColumn("again", again).where("again = 1"), docs.columns)
    return named.unionByName(docs.where("doc_id is null"))
