"""Connected components of a link table by randomised contraction.

Every round each node points to the least-ranked node among itself and its
neighbours (ranks are a hash seeded by the round, so a long chain shrinks by a
constant factor, not by one node), and the links are rewritten between those
targets.  A round is one partial+final aggregate and two equi joins; nothing is
collected but a row count, and each round's tables are written to the shared
folder, so lineage stays short and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import saved


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``links(a, b)`` -> ``(node, root)`` for every node that has a link.

    ``root`` is one node of the component, the same for all of it.  Links to
    self, null ends, repeated and reversed links change nothing; an empty table
    gives an empty result.
    """
    edges = (links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct())
    edges = saved(edges, "cc-links")
    result = None
    for seed in range(1000):
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(seed)).alias("k"), F.col(c).alias("n"))
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = (both.groupBy("a").agg(F.min(rank("b")).alias("m"))
              .select(F.col("a").alias("node"), F.least(rank("a"), F.col("m"))["n"].alias("root")))
        up = saved(up, "cc-up")
        if result is None:
            result = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
            result = result.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        one = up.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        two = up.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = saved(edges.join(one, "a").join(two, "b").where("ra <> rb")
                      .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-links")
        if edges.isEmpty():
            return result
    raise RuntimeError("components did not settle")
