"""Language identification by Bayesian evidence fusion (operator 5).

Evidence for a row's language, combined as log odds:

* text likelihood: byte trigrams of the whole text under one smoothed model per
  language.  The mean log likelihood counts as at most ``FULL`` trigrams, since neighbouring
  trigrams are not independent;
* declared language (markup): P(declared | language) from counts over all rows;
* host: a prior smoothed down the hierarchy all rows -> address suffix -> host,
  from summed text posteriors, by grouped aggregation.

Models are fitted on at most ``TRAIN_ROWS`` rows per language (lowest hash of
id), labelled by ``lang``; every count and prior covers all rows.  A row is
accepted if its best posterior is at least ``ACCEPT`` and its text is not far
less likely than the texts of the sample.  That floor goes by length: ``FLOOR``
standard deviations for a long text, and more by the sampling error of the mean over
few trigrams (``SHORT``), but never more than ``DEEP`` of the way to a text of unseen
trigrams only.  At most ``UNSEEN`` of a text's trigrams, and ``SPARE`` more, may be unseen.
Other languages of like letters in fewer than about 150 bytes are told only in part.

Defined results: null, empty or shorter than three bytes: no text evidence,
not accepted; null host or declared language: no such evidence; equal posteriors go by
language name; repeated rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglark.llm.common import broadcast_if_few, packed, saved, unpacked

TRAIN_ROWS = 400
FULL = 40
ACCEPT = 0.5
FLOOR = 12.0
SHORT = 170.0
DEEP = 0.8
UNSEEN, SPARE = 0.4, 6
KAPPA = 20.0
BINS = 1 << 16


def trigrams(text: str | None) -> np.ndarray:
    raw = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.uint32)
    return (raw[:-2] * 40503 + raw[1:-1] * 10007 + raw[2:] * 257) & (BINS - 1)


class TextModel:
    """Log likelihood tables per language, and the floor of a likely text."""

    def __init__(self, names: list[str], table: np.ndarray, mean: float, spread: float):
        self.names, self.table, self.mean, self.spread = names, table, mean, max(spread, 0.05 * abs(mean))
        least = table.min(0)
        self.seen, self.deep = (table > least).any(1), mean - DEEP * (mean - float(least.max()))

    def score(self, text: str | None) -> tuple[np.ndarray, int]:
        """(mean log likelihood per language, trigrams)."""
        return self.scored(text)[:2]

    def scored(self, text: str | None) -> tuple[np.ndarray, int, int]:
        """``score`` and the trigrams that no text of the sample has."""
        grams, total, seen = trigrams(text), np.zeros(len(self.names)), 0
        for lo in range(0, len(grams), 1 << 18):
            some = grams[lo:lo + (1 << 18)]
            total += self.table[some].sum(0, dtype=float)
            seen += int(self.seen[some].sum())
        return total / max(1, len(grams)), len(grams), len(grams) - seen

    def likely(self, best: Column, grams: Column, unseen: Column) -> Column:
        """Whether a text with this best mean log likelihood can be of a language at all."""
        low = self.mean - self.spread * F.sqrt(FLOOR ** 2 + SHORT ** 2 / F.greatest(grams, F.lit(1)))
        return (best >= F.greatest(low, F.lit(self.deep))) & (unseen <= UNSEEN * grams + SPARE)


def fit(rows: DataFrame) -> TextModel | None:
    """``rows(id, lang, text)``, labelled."""
    pick = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    sample = rows.where("lang is not null and text is not null").withColumn("r", pick).where(F.col("r") <= TRAIN_ROWS)

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BINS, np.int64)
        for text in pdf["text"]:
            total += np.bincount(trigrams(text), minlength=BINS)
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "counts": [total.tobytes()]})

    sample = saved(sample.select("lang", "text"), "lang-sample")
    found = sorted((r["lang"], np.frombuffer(r["counts"], np.int64)) for r in
                   sample.groupBy("lang").applyInPandas(count, "lang string, counts binary").collect())
    if not found:
        return None
    counts = np.stack([c for _, c in found], axis=1).astype(float) + 0.2
    model = TextModel([name for name, _ in found], np.log(counts / counts.sum(0)).astype(np.float32), -1e9, 0.0)

    @F.pandas_udf("double")
    def best(texts: pd.Series) -> pd.Series:
        return pd.Series([float(model.score(t)[0].max()) if t and len(t) > 100 else None for t in texts], dtype="float64")

    r = sample.select(best("text").alias("x")).agg(F.avg("x"), F.stddev_pop("x")).first()
    return TextModel(model.names, model.table, r[0] if r[0] is not None else -1e9, r[1] or 0.0)


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """``rows(*keys, text, declared, host, suffix)`` -> keys, lang, posterior, accepted."""
    names, n = model.names, len(model.names)
    keys = [c for c in rows.columns if c not in ("text", "declared", "host", "suffix")]

    @F.pandas_udf("struct<ll: array<double>, grams: long, unseen: long>")
    def likelihood(texts: pd.Series) -> pd.DataFrame:
        found = [model.scored(t) for t in texts]
        return pd.DataFrame({"ll": [x.tolist() for x, _, _ in found], "grams": [g for _, g, _ in found], "unseen": [u for _, _, u in found]})

    slim = saved(rows.select(*keys, F.lower("declared").alias("declared"), "host", "suffix", likelihood("text").alias("s"))
                 .select(*keys, "declared", "host", "suffix", "s.*"), "lang-text")
    ll = [F.col("ll")[i] * F.least(F.col("grams"), F.lit(FULL)) for i in range(n)]
    most = F.greatest(*ll) if n > 1 else ll[0]
    weights = [F.exp(x - most) for x in ll]
    p = [(w / sum(weights[1:], weights[0])) for w in weights]
    slim = slim.select("*", *[x.alias(f"p{i}") for i, x in enumerate(p)], *[x.alias(f"t{i}") for i, x in enumerate(ll)])
    known = slim.where("grams > 0")
    sums = [F.sum(f"p{i}").alias(f"c{i}") for i in range(n)]
    overall = known.agg(*sums).first()
    total = sum(overall[i] or 0 for i in range(n))
    base = [((overall[i] or 0) + 1) / (total + n) for i in range(n)]

    def smoothed(counts: DataFrame, parent: list[Column], out: str) -> DataFrame:
        size = sum((F.col(f"c{i}") for i in range(1, n)), F.col("c0"))
        return counts.select("*", *[((F.col(f"c{i}") + KAPPA * parent[i]) / (size + KAPPA)).alias(f"{out}{i}") for i in range(n)])

    hosts = saved(known.where("host is not null").groupBy("suffix", "host").agg(*sums), "lang-hosts")
    suffixes = smoothed(hosts.groupBy("suffix").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(n)]), [F.lit(b) for b in base], "s")
    suffixes = suffixes.select(F.col("suffix").alias("suffix_"), *[f"s{i}" for i in range(n)])
    prior = smoothed(hosts.join(suffixes, hosts["suffix"].eqNullSafe(suffixes["suffix_"])), [F.col(f"s{i}") for i in range(n)], "h")
    prior = prior.select(F.col("suffix").alias("suffix_"), F.col("host").alias("host_"), *[f"h{i}" for i in range(n)])
    # P(declared | language): a declared value is one of the languages or 'other'
    said = F.when(F.col("declared").isin(names), F.col("declared")).otherwise(F.when(F.col("declared").isNotNull(), "other"))
    table = {r["said"]: [r[f"c{i}"] for i in range(n)] for r in known.groupBy(said.alias("said")).agg(*sums).collect()}
    in_all = [sum(v[i] for k, v in table.items() if k is not None) for i in range(n)]

    def declared(i: int) -> Column:
        out = F.lit(0.0)
        for k, v in table.items():
            if k is not None:
                out = F.when(said == k, float(np.log((v[i] + 1) / (in_all[i] + n + 1)))).otherwise(out)
        return out

    joined = slim.join(prior, slim["host"].eqNullSafe(prior["host_"]) & slim["suffix"].eqNullSafe(prior["suffix_"]), "left")
    post = [F.col(f"t{i}") + declared(i) + F.log(F.coalesce(F.col(f"h{i}"), F.lit(base[i]))) for i in range(n)]
    rows = joined.select(*keys, "grams", "unseen", F.array(*[F.col("ll")[i] for i in range(n)]).alias("raw"),
                         F.array_sort(F.array(*[F.struct((-x).alias("bad"), F.lit(name).alias("lang")) for x, name in zip(post, names, strict=True)])).alias("all"))
    top = F.col("all")[0]
    posterior = 1 / F.aggregate("all", F.lit(0.0), lambda a, x: a + F.exp(top["bad"] - x["bad"]))
    return (rows.select(*keys, "grams", "unseen", F.array_max("raw").alias("likely"), top["lang"].alias("lang"), F.round(posterior, 6).alias("posterior"))
            .select(*keys, "lang", "posterior", ((F.col("grams") > 0) & (F.col("posterior") >= ACCEPT)
                                                 & model.likely(F.col("likely"), F.col("grams"), F.col("unseen"))).alias("accepted")))


def document_evidence(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("declared"),
                       F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))


def page_evidence(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"(?s)<[^>]*+>", " ")
    declared = F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1), F.lit(""))
    return pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", text.alias("text"), declared.alias("declared"),
                        F.nullif(host, F.lit("")).alias("host"), F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("suffix"))


def labelled(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), "lang", "text")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is accepted.  Decisions follow doc_id
    and text; rows without a doc_id stay if a like row is accepted."""
    model = fit(labelled(docs))
    if model is None:
        return docs.limit(0)
    evidence = document_evidence(docs).withColumn("digest", F.xxhash64("text"))
    bad = identify(evidence, model).where("not accepted").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    bad = broadcast_if_few(bad)
    keyed = packed(docs, id=F.col("doc_id"), key=F.xxhash64("text"))
    left = keyed.join(bad, keyed["id"].eqNullSafe(bad["_id"]) & keyed["key"].eqNullSafe(bad["_digest"]), "left_anti")
    return unpacked(left, docs.columns)
