"""Benchmark decontamination by latent semantic retrieval (operator 3).

Terms are the words of the benchmark (at most ``TERMS``, else an error); words
that no item has cannot raise an item's score.  Each text is turned into term
numbers once, in a written table that all later steps read.  Every document is cut into
passages of ``SPAN`` words, side by side for the statistics and every ``STEP``
words for the search:

1. passage frequencies over all passages of all documents give the TF-IDF weights;
2. a randomised SVD finds the latent subspace, the index of the search. It is fitted on all
   passages: with a seeded random matrix R,
   each task adds up A'(A R) over its passages (A: unit TF-IDF rows), the sums of the terms met are grouped by
   term, the items' own rows join with a set weight, and an orthonormal basis of the result spans the leading directions
   (one power iteration; the basis is terms x ``RANK``);
3. all passages and items are projected, and a pair whose latent cosine reaches
   ``COSINE`` is a candidate.

The items are searched in blocks of about ``ITEMS`` (hash ranges; every item is in one), each
sent to every task of a pass over the documents; terms, weights and basis are fitted once over all.  A candidate
leaks if the longest common subsequence of words of the item and a stretch of
the document around the passage covers ``COVER`` of the item, and of its answer
(its last sentence) at least ``ANSWER``.

Defined results: null or blank texts and items match nothing; items of fewer
than ``LEAST`` words are not searched; repeated rows give repeated rows; an
empty table gives an empty result; null doc_ids stay null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import broadcast_if_few, saved

SPAN, STEP = 32, 16
RANK, COSINE = 64, 0.5
ITEM_WEIGHT = 0.6
COVER, ANSWER = 0.6, 0.5
TERMS, LEAST = 200_000, 6
BLOCK = 1_024
ITEMS = 50_000
SAMPLE = 0  # read by nothing any more: the subspace is fitted on all passages

#: ASCII signs that are no part of a word become blanks.
_BLANKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_BLANKS).split()


class Items:
    """Items in numbers: words and answer of every item; their terms are added to ``term``."""

    def __init__(self, rows: list[tuple[int, str]], term: dict[bytes, int] | None = None):
        self.ids, self.tokens, self.answers = [], [], []
        self.term = {} if term is None else term
        for item, text in rows:
            w = words(text)
            if item is None or len(w) < LEAST:
                continue
            numbers = np.array([self.term.setdefault(x, len(self.term)) for x in w], np.int32)
            if len(self.term) > TERMS:
                raise ValueError(f"the benchmark has more than {TERMS} different words")
            sentences = [s for s in re.split(r"(?<=[.?!])\s+|\n", text) if words(s)]
            tail = len(words(sentences[-1])) if len(sentences) > 1 else 0
            self.ids.append(item)
            self.tokens.append(numbers)
            self.answers.append(numbers[-max(tail, min(3, len(w))):])
        row = np.repeat(np.arange(len(self.ids)), [len(t) for t in self.tokens])
        key, self.count = np.unique(row * len(self.term) + np.concatenate([*self.tokens, np.zeros(0, np.int32)]), return_counts=True)
        self.row, self.column = (key // len(self.term), key % len(self.term)) if len(key) else (key, key)

    def numbers(self, text: str | None) -> np.ndarray:
        w = words(text)
        return np.fromiter(map(self.term.get, w, repeat(-1)), np.int32, len(w))


def item_parts(benchmark: DataFrame) -> list[DataFrame]:
    """All items in blocks of about ``ITEMS`` rows."""
    rows = saved(benchmark.select("item_id", "text").where("item_id is not null and text is not null").distinct(), "items")
    n = max(1, -(-rows.count() // ITEMS))
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def part_items(part: DataFrame, term: dict[bytes, int]) -> Items:
    return Items(sorted((r["item_id"], r["text"]) for r in part.collect()), term)


def blocks(texts: Iterator[tuple], n_terms: int, step: int) -> Iterator[tuple]:
    """Passages of (document, numbers) that hold a term, about ``BLOCK`` at a time: ``owner``, which names the
    (document, numbers, start) of a row, the number of rows, and the term counts as (row, term, count)."""
    pieces, keys, size = [], [], 0

    def made():
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        passage = key // n_terms
        first = np.concatenate(([True], passage[1:] != passage[:-1]))
        kept, bases = passage[first], np.array([p[0] for p in pieces])

        def owner(row: int) -> tuple:
            base, doc, numbers, lo = pieces[np.searchsorted(bases, kept[row], "right") - 1]
            return doc, numbers, (lo + int(kept[row]) - base) * step

        return owner, len(kept), np.cumsum(first) - 1, key - passage * n_terms, count

    for doc, numbers in texts:
        at = np.flatnonzero(numbers >= 0)
        n = len(range(0, max(1, len(numbers) - SPAN + step), step))
        base = at // step * n_terms + numbers[at]
        for lo in range(0, n if len(at) else 0, BLOCK):  # a very long text comes in sections
            hi = min(n, lo + BLOCK)
            made_keys = []
            for back in range(SPAN // step):  # a word stands in SPAN / step passages
                first, end = np.searchsorted(at, ((lo + back) * step, (hi + back) * step))
                made_keys.append(base[first:end] + (size - lo - back) * n_terms)
            made_keys = np.concatenate(made_keys)
            if len(made_keys):
                pieces.append((size, doc, numbers, lo))
                keys.append(made_keys)
                size += hi - lo
                if size >= BLOCK:
                    yield made()
                    pieces, keys, size = [], [], 0
    if keys:
        yield made()


def weighted(row: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Unit TF-IDF weights of the (row, term) entries."""
    w = (1 + np.log(count)) * idf[term]
    norm = np.sqrt(np.bincount(row, w * w, n))
    return w / np.maximum(norm[row], 1e-12)


def times(row: np.ndarray, term: np.ndarray, w: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """A @ right for the sparse rows (entries come sorted by row, and every row has one)."""
    starts = np.searchsorted(row, np.arange(n + 1))
    return summed_rows(starts[:-1], np.diff(starts), w.astype(np.float32), term, right)


def summed_rows(starts: np.ndarray, lengths: np.ndarray, w: np.ndarray, index: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A row per group of entries (start, length; none is empty): the sum of ``w * right[index]``, in float32.

    The groups' k-th entries are added together, longest group first, so that every step works on the leading rows;
    groups of more than ``SPAN`` entries are products of their own."""
    out = np.empty((len(starts), right.shape[1]), np.float32)
    for g in np.flatnonzero(lengths > SPAN):
        a, b = starts[g], starts[g] + lengths[g]
        out[g] = w[a:b] @ right[index[a:b]]
    short = np.flatnonzero(lengths <= SPAN)
    if not len(short):
        return out
    short = short[np.argsort(-lengths[short], kind="stable")]
    at, size = starts[short], lengths[short]
    total = right[index[at]] * w[at, None]
    for k in range(1, size[0]):
        m = np.searchsorted(-size, -k)  # groups of more than k entries
        some = right[index[at[:m] + k]]
        some *= w[at[:m] + k, None]
        total[:m] += some
    out[short] = total
    return out


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one bit per place of ``a``."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = at.get(x)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


def leaks(item: np.ndarray, answer: np.ndarray, doc: np.ndarray, start: int, mark: np.ndarray | None = None) -> float:
    """Coverage of the item by the best stretch near the passage, 0 if a check fails.
    ``mark``, to be used again: false for every term and at the end for -1; it comes back so."""
    m = len(item)
    if mark is None:
        mark = np.zeros(max(int(item.max()), int(doc.max(initial=0))) + 2, bool)
    lo, hi = max(0, start - m), min(len(doc), start + SPAN + m)
    near = doc[lo:hi]
    mark[item] = True
    inside = mark[near]
    mark[item] = False
    if np.count_nonzero(inside) < COVER * m:  # no stretch holds enough of the item's words
        return 0.0
    width, best = m + m // 2, 0.0
    sums = np.concatenate(([0], np.cumsum(inside)))
    step = max(1, m // 4)
    starts = np.arange(0, max(1, len(near) - width + 1 + step), step)
    most = sums[np.minimum(len(near), starts + width)] - sums[np.minimum(len(near), starts)]
    a = item.tolist()
    for s in starts[most >= COVER * m].tolist():  # a common subsequence needs that many of the item's words
        if sums[min(len(near), s + width)] - sums[s] < best * m:
            continue
        stretch = near[s:s + width][inside[s:s + width]].tolist()
        cover = lcs(a, stretch) / m
        if cover >= COVER and cover > best and lcs(answer.tolist(), stretch) >= ANSWER * len(answer):
            best = cover
    return best


def numbered(slim: DataFrame, term: dict[bytes, int]) -> DataFrame:
    """``slim(doc_id, row, text)`` with its words as numbers (int32, -1 for a word of no item) in place of the text."""
    items = Items([], term)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "row": batch["row"],
                                "numbers": [items.numbers(t).tobytes() for t in batch["text"]]})

    return slim.mapInPandas(encode, "doc_id long, row long, numbers binary")


def arrays(batch: pd.DataFrame, key: str) -> Iterator[tuple]:
    return ((k, np.frombuffer(x, np.int32)) for k, x in zip(batch[key], batch["numbers"], strict=True))


def latent_basis(docs: DataFrame, term: dict[bytes, int], parts: list[DataFrame], n_items: int) -> tuple[np.ndarray, np.ndarray]:
    """(idf, basis): frequencies over all passages of ``docs(row, numbers)``, the sketch over all of them and all items."""
    n_terms = len(term)
    slim = docs.select("row", "numbers")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            for _, n, _, term, _ in blocks(arrays(batch, "row"), n_terms, SPAN):
                seen += np.bincount(term, minlength=n_terms)
                total += n
        met = np.flatnonzero(seen)
        yield pd.DataFrame({"term": np.concatenate(([-1], met)), "n": np.concatenate(([total], seen[met]))})

    counted = slim.mapInPandas(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counted = counted.set_index("term")["n"].reindex(range(-1, n_terms), fill_value=0).to_numpy()  # a row per term
    idf = (np.log((counted[0] + 1) / (counted[1:] + 1)) + 1) ** 2  # squared: words that all passages share say little
    rank = min(RANK, n_terms)
    random = np.random.default_rng(17).standard_normal((n_terms, rank + 8)).astype(np.float32)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, met = np.zeros(random.shape), np.zeros(n_terms, bool)  # memory for the rows that are met only
        for batch in batches:
            for _, n, row, term, count in blocks(arrays(batch, "row"), n_terms, SPAN):
                w = weighted(row, term, count, idf, n).astype(np.float32)
                y = times(row, term, w, random, n)
                by_term = np.argsort(term, kind="stable")
                term = term[by_term]
                first = np.flatnonzero(np.concatenate(([True], term[1:] > term[:-1])))
                total[term[first]] += summed_rows(first, np.diff(first, append=len(term)), w[by_term], row[by_term], y)
                met[term[first]] = True
        met = np.flatnonzero(met)
        for lo in range(0, len(met), BLOCK):
            some = met[lo:lo + BLOCK]
            yield pd.DataFrame({"term": some.astype(np.int32), "row": [x.tobytes() for x in total[some]]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x) for x in pdf["row"]], axis=0)
        return pd.DataFrame({"term": pdf["term"].iloc[:1], "row": [total.tobytes()]})

    summed = slim.mapInPandas(sketch, "term int, row binary").groupBy("term").applyInPandas(add, "term int, row binary").toPandas()
    z = np.zeros((n_terms, random.shape[1]))
    for t, r in zip(summed["term"], summed["row"], strict=True):
        z[t] = np.frombuffer(r)
    # the items are rows too; together they weigh ITEM_WEIGHT times all passages, or the
    # leading directions would hold only the corpus' common words
    passages = max(1, counted[0])
    for part in parts:
        some = part_items(part, term)
        w = weighted(some.row, some.column, some.count, idf, len(some.ids))
        y = times(some.row, some.column, w, random, len(some.ids))
        np.add.at(z, some.column, ITEM_WEIGHT * passages / n_items * w[:, None] * y[some.row])
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    return idf, u[:, :rank][:, s[:rank] > 1e-9 * max(s[0], 1e-300)].astype(np.float32)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document that holds an item: doc_id, items (ids), coverage (of the best), row key."""
    slim = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    parts = item_parts(benchmark)
    term: dict[bytes, int] = {}
    sizes = [len(part_items(p, term).ids) for p in parts]
    parts = [p for p, n in zip(parts, sizes, strict=True) if n]
    if not parts:
        return slim.limit(0).select("doc_id", "row", F.array(F.lit(0).cast("long")).alias("items"), F.lit(0.0).alias("coverage"))
    texts = saved(numbered(slim, term), "leak-numbers")
    idf, basis = latent_basis(texts, term, parts, sum(sizes))
    hits = [saved(found(texts, part_items(p, term), idf, basis), "leaks") for p in parts]
    return (reduce(DataFrame.unionByName, hits).groupBy("doc_id", "row")
            .agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage")))


def found(texts: DataFrame, items: Items, idf: np.ndarray, basis: np.ndarray) -> DataFrame:
    """doc_id, row, item_id, coverage: the leaks of one block of items."""

    def latent(row, term, count, n):
        x = times(row, term, weighted(row, term, count, idf, n), basis, n)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    target = latent(items.row, items.column, items.count, len(items.ids))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark = np.zeros(len(items.term) + 1, bool)
        for batch in batches:
            best: dict[tuple[int, int], float] = {}
            docs_ = batch["doc_id"].to_list()
            for owner, n, row, term, count in blocks(enumerate(x for _, x in arrays(batch, "row")), len(items.term), STEP):
                x = latent(row, term, count, n)
                for lo in range(0, len(target), 2_048):
                    for p, i in zip(*np.nonzero(x @ target[lo:lo + 2_048].T >= COSINE), strict=True):
                        doc, numbers, start = owner(p)
                        if best.get((doc, lo + i), 0) < 1:
                            cover = leaks(items.tokens[lo + i], items.answers[lo + i], numbers, start, mark)
                            if cover > best.get((doc, lo + i), 0):
                                best[doc, lo + i] = cover
            rows = [(docs_[d], batch["row"].iloc[d], items.ids[i], c) for (d, i), c in sorted(best.items())]
            yield pd.DataFrame({"doc_id": pd.array([None if pd.isna(r[0]) else r[0] for r in rows], "Int64"),
                                "row": np.array([r[1] for r in rows], np.int64), "item_id": np.array([r[2] for r in rows], np.int64),
                                "coverage": np.array([r[3] for r in rows], float)})

    return texts.mapInPandas(search, "doc_id long, row long, item_id long, coverage double")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    bad = broadcast_if_few(contaminated(docs, benchmark).select(F.col("row").alias("_row")).distinct())
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["_row"], "left_anti")
