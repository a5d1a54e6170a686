"""Paragraph deduplication by MinHash banding (operator 2).

A paragraph is a line of at least ``LEAST`` words (A-Z lower-cased, white space
folded); its set is the 64-bit hashes of its word shingles.  Paragraphs of
equal words are folded to one class first (two 64-bit hashes of different
kind), so a passage copied into a third of all documents is one class.  Shorter
lines that repeat are the business of operator 6, unless several in a row make a passage.

Each class has ``BANDS`` bands of ``ROWS`` MinHash values: at Jaccard 0.8 a pair
meets in some band with probability 1 - (1 - 0.8^4)^14 = 0.9994.  Classes that
share a band meet in a bucket; buckets travel as a hash and a class number of 8 bytes each, and the shuffle files of a
step go once its result is written.  Buckets of more than ``TILE`` classes are cut
into tiles, and every pair of tiles is a group of its own, so no task holds more
than two tiles of a bucket.  Inside a group a pair is
verified by exact Jaccard of the shingle sets unless its two classes already
hang together, so no group emits more links than it has classes.  Components
over all links are the clusters; in each, the first paragraph (smallest doc_id, then
position) stays and the others are removed.

Passages that lie inside longer lines, run over several lines or are wrapped anew
are found by units cut by content: over all words of a text, line ends folded too, the
shingle of least hash (a MinHash) in every ``SPAN`` shingles in a row is an anchor, and
``UNIT`` words from it on are a unit.  Anchors depend on the words around alone, so a run
of ``LEAST`` = ``SPAN`` + ``UNIT`` - 1 words that stands in two places has a unit in both, whatever
stands around it.  Units with equal words (the same two hashes) are one class, whose first
stays.  Units of a document that overlap and whose first ones stand in one document are
merged; such a passage is left out if it lies within one line that is reported itself.
A run with words changed in its midst is found as a passage if ``LEAST`` words on end are left.

Defined results: null text has no paragraph; paragraphs and runs shorter than ``UNIT``
words never match; rows with equal doc_id are different documents with one id; rows
with a null doc_id are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loglark.llm.common import dropped, saved, saved_at
from loglark.llm.graph import connected_components
from loglark.session import new_scratch, shuffles_freed

SHINGLE, LIKE = 5, 0.8
BANDS, ROWS = 14, 4
SPAN, UNIT = 16, 35  # shingles that share an anchor; words of a unit
LEAST = SPAN + UNIT - 1  # words of a paragraph, and of a passage that is always found
PIECE = 50_000  # words of a text hashed at once
HOT = 10_000  # units of a class that is broadcast
TILE = 1_500
BLOCK_BYTES = 1 << 20
GROUP = ("bucket", "one", "two")
LINKS = 10_000  # rows of an output batch

_SEED = np.random.default_rng(2024)
_MIX = (_SEED.integers(1, 1 << 62, BANDS * ROWS, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Slices:
    """Hashes of byte ranges of one buffer, from running sums of b * r^i modulo 2^64."""

    def __init__(self, raw: np.ndarray, base: np.uint64):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        powers = np.cumprod(np.full(len(raw), base, np.uint64))
        self.back = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(raw), inverse, np.uint64))))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def folded_paragraphs(text: str) -> list[tuple[int, bytes]]:
    """(line number, folded words) of the lines with at least ``LEAST`` words."""
    return [(at, b" ".join(words)) for at, words in enumerate(folded_lines(text)) if len(words) >= LEAST]


def folded_lines(text: str) -> list[list[bytes]]:
    return [line.split() for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]


def shingle_ranges(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, paragraph) of each shingle of the paragraphs that begin at
    ``starts`` in a buffer where every paragraph ends in a line feed."""
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    begin = np.concatenate(([0], ends[:-1] + 1))
    paragraph = np.searchsorted(starts, begin, "right") - 1
    n = len(begin) - SHINGLE + 1
    inside = paragraph[:n] == paragraph[SHINGLE - 1:]
    return begin[:n][inside], ends[SHINGLE - 1:][inside], paragraph[:n][inside]


def signatures(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class keys (n, 2), bands (n, BANDS), shingles per paragraph)."""
    joined = b"\n".join(parts) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    one, two = (Slices(raw, b) for b in _BASES)
    keys = np.stack([one.of(starts, starts + lengths), two.of(starts, starts + lengths)], axis=1)
    a, b, paragraph = shingle_ranges(raw, starts)
    h = one.of(a, b)
    cuts = np.searchsorted(paragraph, np.arange(len(parts)))
    mins = np.empty((len(parts), BANDS * ROWS), np.uint64)
    for k, m in enumerate(_MIX):
        mins[:, k] = np.minimum.reduceat((h * m) ^ ((h * m) >> np.uint64(29)), cuts)
    bands = np.zeros((len(parts), BANDS), np.uint64)
    for r in range(ROWS):
        bands = mixed(bands * np.uint64(31) + mins[:, r::ROWS])
    return keys, mixed(bands + np.arange(BANDS, dtype=np.uint64)), np.diff(np.concatenate((cuts, [len(h)])))


def over_spans(pick: np.ufunc, h: np.ndarray) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``SPAN`` (a power of 2) values in a row."""
    step = 1
    while step < SPAN:
        h = pick(h[:-step], h[step:])
        step *= 2
    return h


def units(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first word in it, class keys (n, 2)) of the units of each part."""
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    one = Slices(raw, _BASES[0])
    a, b, part = shingle_ranges(raw, starts)
    h, reach = one.of(a, b), UNIT - SHINGLE  # shingles from a unit's first to its last
    if len(h) <= max(SPAN, reach):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2), np.uint64)
    least = over_spans(np.minimum, h)
    least[part[:len(least)] != part[SPAN - 1:]] = 0  # spans over two parts have no anchor
    edge = np.zeros(SPAN - 1, np.uint64)
    anchor = over_spans(np.maximum, np.concatenate((edge, least, edge))) == h
    at = np.flatnonzero(anchor[:len(h) - reach] & (part[:len(h) - reach] == part[reach:]))
    keys = np.stack([s.of(a[at], b[at + reach]) for s in (one, Slices(raw, _BASES[1]))], axis=1)
    return part[at], at - np.searchsorted(part, part[at]), keys


def pieces(words: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(word it begins at, first word whose units count, folded words) of a text, cut so that
    the anchors of a long one are those of the whole."""
    for start in range(0, len(words) if len(words) >= UNIT else 0, PIECE):
        before = max(start - SPAN, 0)
        yield before, start, b" ".join(words[before:start + PIECE + LEAST + SHINGLE])


def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, row, text -> one row per paragraph with class keys and bands, and one per unit, without bands."""

    def paragraph_rows(found):
        owner, parts = zip(*found, strict=True)
        keys, bands, _ = signatures(parts)
        doc, row, at, word, n = zip(*owner, strict=True)
        return pd.DataFrame({"doc_id": doc, "row": row, "at": at, "word": word, "words": n, "k1": keys[:, 0].view(np.int64),
                             "k2": keys[:, 1].view(np.int64), "bands": list(bands.view(np.int64))})

    def unit_rows(found):
        owner, parts = zip(*found, strict=True)
        part, word, keys = units(parts)
        doc, row, before, start, upto = (np.array(c)[part] for c in list(zip(*owner, strict=True))[:5])
        word = word + before
        at = np.empty(len(part), np.int64)
        cuts = np.searchsorted(part, np.arange(len(parts) + 1))
        for k in range(len(parts)):
            here = slice(cuts[k], cuts[k + 1])
            at[here] = np.searchsorted(owner[k][5], word[here], "right")
        keep = (word >= start) & (word < upto)
        return pd.DataFrame({"doc_id": doc, "row": row, "at": at, "word": word, "words": UNIT, "k1": keys[:, 0].copy().view(np.int64),
                             "k2": keys[:, 1].copy().view(np.int64), "bands": None})[keep]

    for batch in batches:
        lines, texts, size = [], [], 0
        for doc, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
            split = folded_lines(text)
            upto = np.cumsum([len(words) for words in split])  # words before the end of each line
            for at, words in enumerate(split):
                if len(words) >= LEAST:
                    lines.append(((doc, row, at, int(upto[at]) - len(words), len(words)), b" ".join(words)))
            for before, start, part in pieces([w for words in split for w in words]):
                texts.append(((doc, row, before, start, start + PIECE, upto), part))
                size += len(part)
                if size > BLOCK_BYTES:
                    yield unit_rows(texts)
                    texts, size = [], 0
                    if lines:
                        yield paragraph_rows(lines)
                        lines = []
        if texts:
            yield unit_rows(texts)
        if lines:
            yield paragraph_rows(lines)


def shingles(words: bytes) -> set[tuple[bytes, ...]]:
    w = words.split(b" ")
    return set(zip(*(w[i:] for i in range(SHINGLE)), strict=False))


def verified_links(texts: Sequence[bytes], guest: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (i, j) with Jaccard of at least ``LIKE`` that hang all such pairs together:
    (resident, guest) pairs, or all pairs if there is no guest."""
    sets = [shingles(t) for t in texts]
    if len(sets) == 2:
        both = len(sets[0] & sets[1])
        return [(0, 1)] if both >= LIKE * (len(sets[0]) + len(sets[1]) - both) else []
    label, found = np.arange(len(texts)), []
    size = np.array([len(s) for s in sets])
    homes = np.flatnonzero(~guest)
    others = guest if guest.any() else ~guest
    for i in homes:
        near = (np.minimum(size, size[i]) >= LIKE * np.maximum(size, size[i])) & (label != label[i]) & others & (guest | (np.arange(len(texts)) > i))
        for j in np.flatnonzero(near):
            if label[j] != label[i]:
                both = len(sets[i] & sets[j])
                if both >= LIKE * (size[i] + size[j] - both):
                    found.append((int(i), int(j)))
                    label[label == label[j]] = label[i]
    return found


def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) of the groups (bucket, one, two), whose rows arrive one after another; one group is held at a time."""
    rows = (row for batch in batches for row in zip(*(batch[c] for c in GROUP), batch["no"], batch["guest"], batch["words"], strict=True))
    found = []
    for _, group in groupby(rows, key=itemgetter(0, 1, 2)):
        no, guest, words = zip(*(row[len(GROUP):] for row in group), strict=True)
        found += [(no[i], no[j]) for i, j in verified_links(words, np.array(guest, bool))]
        if len(found) > LINKS:
            yield pd.DataFrame(found, columns=["a", "b"])
            found = []
    yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def tile_pairs(members: DataFrame, key: tuple[str, ...] = ("k1", "k2")) -> DataFrame:
    """``members(bucket, size, *key, ...)`` dealt to groups (bucket, one, two) of two
    tiles, one <= two; the members of tile ``two`` are guests where the tiles differ."""
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    dealt = (members.withColumn("own", F.pmod(F.xxhash64(*key), tiles).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1))))
    return (dealt.withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))
            .withColumn("guest", F.col("own") > F.col("other")).drop("own", "other", "size"))


def paragraph_classes(slim: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The paragraphs (doc_id, row, at, word, words, k1, k2), their classes of equal words (no, k1, k2, n, first,
    bands), and the units that stand in two places or more (like paragraphs)."""
    spark, path = slim.sparkSession, new_scratch(slim.sparkSession, "mh-signed")
    both = saved_at(slim.mapInPandas(sign, "doc_id long, row long, at int, word int, words int, k1 long, k2 long, bands array<long>"), path)
    signed, units_ = both.where("bands is not null"), both.where("bands is null").drop("bands")
    # most units stand in one place: a count of the keys first, then an equi join
    many = saved(units_.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1"), "mh-many")
    met = saved(with_classes(units_, many), "mh-units")
    classes = saved(signed.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at", "row")).alias("first"),
                                                   F.first("bands").alias("bands"))
                    .withColumn("no", F.monotonically_increasing_id()), "mh-classes")
    paragraphs = saved(signed.drop("bands"), "mh-paragraphs")
    dropped(spark, path)
    return paragraphs, classes, met


def met_classes(classes: DataFrame) -> DataFrame:
    """bucket, size, no: the classes of each bucket that holds two or more."""
    banded = classes.select("no", F.explode("bands").alias("bucket"))
    # all classes of a bucket are needed only where there are two: a count of the buckets first, then an equi join
    full = saved(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "mh-buckets")
    members = saved(banded.join(full, "bucket"), "mh-members")
    # buckets with the same two members verify the same pair: one of them is enough
    two = members.where("size = 2").groupBy("bucket").agg(F.min("no").alias("lead"), F.max("no").alias("tail"))
    two = two.groupBy("lead", "tail").agg(F.min("bucket").alias("bucket")).select(
        "bucket", F.lit(2).cast("long").alias("size"), F.explode(F.array("lead", "tail")).alias("no"))
    return saved(members.where("size > 2").select("bucket", "size", "no").unionByName(two), "mh-met")


def with_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows(k1, k2, ...)`` joined to ``classes(k1, k2, n, ...)``, without ``n``.  Classes of over ``HOT``
    rows, of which there is at most one in ``HOT`` rows, are broadcast, so no task gets all rows of one."""
    key, hot = ["k1", "k2"], F.broadcast(classes.where(F.col("n") > HOT))
    cold = rows.join(hot.select(*key), key, "left_anti").join(classes.where(F.col("n") <= HOT).hint("merge"), key)
    return cold.unionByName(rows.join(hot, key)).drop("n")


def repeated_passages(met: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows of ``repeated_paragraphs`` that are no whole lines, from the units that repeat."""
    first = saved(met.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "word", "row", "at")).alias("keeper")), "mh-firsts")
    # rows with equal doc_id and text have the same units: merged as one, repeated after it
    places = met.groupBy("k1", "k2", "doc_id", "row", "word", "at").agg(F.count("*").alias("copies"))
    hits = with_classes(places, first).select(
        "doc_id", "row", "word", "at", "copies", F.col("keeper.doc_id").alias("first_doc_id"), F.col("keeper.row").alias("first_row"),
        F.col("keeper.at").alias("first_at"), (~((F.col("row") == F.col("keeper.row")) & (F.col("word") == F.col("keeper.word")))).alias("removed"))
    whose = ["doc_id", "row", "first_doc_id", "first_row", "removed"]
    in_order = Window.partitionBy(*whose).orderBy("word")
    begins = F.coalesce(F.col("word") > F.lag("word").over(in_order) + UNIT, F.lit(True))
    runs = hits.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(in_order))
    runs = (runs.groupBy(*whose, "run").agg(F.min(F.struct("word", "at", "first_at")).alias("start"), F.max("word").alias("last"), F.max("copies").alias("copies"))
            .select("doc_id", F.col("start.at").alias("paragraph"), "first_doc_id", F.col("start.first_at").alias("first_paragraph"), "removed", "row",
                    F.col("start.word").alias("word"), (F.col("last") + UNIT - F.col("start.word")).alias("words"), "copies"))
    whole = lines.select("row", "paragraph", (F.col("word") + F.col("words")).alias("end")).distinct()
    runs = runs.join(whole.hint("merge"), ["row", "paragraph"], "left").where("end is null or word + words > end")
    return runs.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*lines.columns)


def repeated_paragraphs(docs: DataFrame) -> DataFrame:
    """One row per paragraph or passage that has an equal or near-equal one elsewhere:
    doc_id, paragraph (line it begins in, from 0), first_doc_id, first_paragraph (of
    the one that stays), removed (false for that one), word (its first word in the
    document, from 0) and words."""
    slim = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    with shuffles_freed(docs.sparkSession):
        paragraphs, classes, met = paragraph_classes(slim)
        named = saved(kept_paragraphs(slim, classes), "mh-named")
        lines = saved(paragraphs.join(named, ["k1", "k2"])
                      .select("doc_id", F.col("at").alias("paragraph"), F.col("keeper.doc_id").alias("first_doc_id"),
                              F.col("keeper.at").alias("first_paragraph"),
                              (~((F.col("row") == F.col("keeper.row")) & (F.col("at") == F.col("keeper.at")))).alias("removed"),
                              "row", "word", "words"), "mh-lines")
    return lines.unionByName(repeated_passages(met, lines))


def kept_paragraphs(slim: DataFrame, classes: DataFrame) -> DataFrame:
    """k1, k2, keeper (doc_id, at, row) of each class in a cluster of two or more paragraphs."""
    members = met_classes(classes)
    # texts of the classes that met another one, by their first paragraph
    wanted = (members.select("no").distinct().join(classes.select("no", "first"), "no")
              .select("no", F.col("first.row").alias("row"), F.col("first.at").alias("at")))
    per_row = wanted.groupBy("row").agg(F.collect_set(F.struct("at", "no")).alias("ats"))
    lines = slim.join(per_row, "row")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, ats in zip(batch["text"], batch["ats"], strict=True):
                parts = dict(folded_paragraphs(text))
                out += [(a["no"], parts[a["at"]]) for a in ats]
            yield pd.DataFrame(out, columns=["no", "words"])

    texts = lines.select("text", "ats").mapInPandas(fetch, "no long, words binary")
    texts = saved(texts.groupBy("no").agg(F.first("words").alias("words")), "mh-texts")
    dealt = tile_pairs(members.join(texts, "no"), ("no",))

    # one call per task, not per group: most groups are pairs, and a call costs more than comparing them
    links = (dealt.select(*GROUP, "no", "guest", "words").repartition(*GROUP).sortWithinPartitions(*GROUP)
             .mapInPandas(linked, "a long, b long"))
    roots = connected_components(links).select(F.col("node").alias("no"), "root")
    rooted = saved(classes.select("no", "k1", "k2", "n", "first").join(roots, "no", "left").where("n > 1 or root is not null")
                   .select("k1", "k2", "n", "first", F.coalesce("root", "no").alias("root")), "mh-rooted")
    clusters = rooted.groupBy("root").agg(F.min("first").alias("keeper"))
    return rooted.join(clusters, "root").select("k1", "k2", "keeper")


@F.pandas_udf(StringType())
def cut_out(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of their removed spans that stand in no kept one.  A line that loses all its words goes whole."""

    def cut(text, spans):
        if spans is None:
            return text
        raw = text.encode("utf-8", "surrogatepass")
        words = np.array([m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)])
        gone = np.zeros(len(words), bool)
        for removed in (True, False):
            for s in spans:
                if s["removed"] == removed:
                    gone[s["word"]:s["word"] + s["words"]] = removed
        out, begin = [], 0
        for line in re.findall(rb"[^\n]*\n|[^\n]+$", raw):
            first, last = np.searchsorted(words[:, 0], (begin, begin + len(line)))
            if first == last or not gone[first:last].any():
                out.append(line)
            elif not gone[first:last].all():
                at = 0
                for k in range(first, last):
                    if gone[k]:
                        upto = words[k, 0] - begin
                        out.append(line[at:upto])
                        at = (words[k + 1, 0] if k + 1 < last else words[k, 1]) - begin
                out.append(line[at:])
            begin += len(line)
        whole = b"".join(out)
        return (whole if raw.endswith(b"\n") else whole.removesuffix(b"\n")).decode("utf-8", "surrogatepass")

    return pd.Series([cut(t, s) for t, s in zip(texts, spans, strict=True)])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed paragraphs and passages taken out of ``text``."""
    spans = (repeated_paragraphs(docs).groupBy(F.col("row").alias("_row"))
             .agg(F.collect_set(F.struct("word", "words", "removed")).alias("_spans")).where(F.exists("_spans", lambda s: s["removed"])))
    joined = docs.join(spans, F.xxhash64(docs["doc_id"], docs["text"]) == spans["_row"], "left")
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut_out("text", "_spans"))).select(*docs.columns)
