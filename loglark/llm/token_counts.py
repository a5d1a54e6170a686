"""Token counts by a compiled finite-state transducer (operator 8).

A byte-level BPE tokenizer is compiled, state by state as texts need them, to
a deterministic transducer over characters.  Every transition carries the next
state and the change in the number of tokens; their sum over a text is its
token count.  A state has two parts:

* the splitter: what kind of piece is open (letters, numbers, other signs,
  white space with its look-ahead, contractions);
* the merger: an encoding is the BPE encoding exactly if every two adjacent
  tokens encode to themselves, so the last token of each prefix is decided by
  the last tokens of shorter prefixes.  The state keeps, for each place from
  which a vocabulary entry can still reach beyond the end, the characters since
  then, the last token there and its count relative to the end.  All three are
  bounded, so the states are finitely many, and long rare words share them.

The table is bounded: beyond ``STATES`` states it is dropped and grows again.

Long texts are cut into chunks.  A chunk's state map (entry state -> exit
state, tokens) is held as (head, inner, tail): whatever the entry state, the
transducer has a boundary at the first white space after a letter or number, so
the map is fixed by the text before the first such place, the tokens
between the first and last, and the text after the last.  Maps compose
associatively (tail + head is counted at the seam); a window scan numbers the
seams of a document and each seam is counted in parallel.

Defined results: null text is empty and has 0 bytes and 0 tokens; repeated rows
give repeated rows; null ids stay null; an empty table gives an empty result;
other columns are ignored.  The tokenizer's special strings count as one token
wherever they stand, as the library's default has it.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglark.llm.common import saved

STATES = 250_000
CHUNK = 1 << 16

LETTER, NUMBER, SPACE = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")
SYNC = regex.compile(r"(?<=[\p{L}\p{N}])(?=\s)")
SYNC_BACK = regex.compile(r"(?r)(?<=[\p{L}\p{N}])(?=\s)")
#: Two-letter contractions, by first letter, and the one-letter ones (fixed values of the splitter's pattern).
TWO, ONE = {"r": "e", "v": "e", "l": "l"}, "stmd"


def kind(c: str) -> str:
    return "L" if LETTER.match(c) else "N" if NUMBER.match(c) else "S" if SPACE.match(c) else "O"


def byte_alphabet() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable
    ones stand for themselves, the others are numbered from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merger:
    """States and transitions of the BPE part: a state is a tuple of
    (signs since a place, last token there, tokens there less tokens at the end)."""

    START = (("", None, 0),)

    def __init__(self, vocabulary: list[str], merges: list):
        self.rank = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(merges)}
        self.tokens = set(vocabulary)
        self.ordered = sorted(vocabulary)
        self.alphabet = byte_alphabet()
        self.fits: dict = {}

    def encode(self, signs: str) -> list[str]:
        parts = list(signs)
        while len(parts) > 1:
            rank, at = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            pair, merged, i = (parts[at], parts[at + 1]), [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def adjacent(self, one: str | None, two: str) -> bool:
        """Whether ``two`` can follow ``one`` (None: can begin) in an encoding."""
        known = self.fits.get((one, two))
        if known is None:
            if len(self.fits) > 4 * STATES:
                self.fits.clear()
            known = self.fits[one, two] = self.encode((one or "") + two) == ([two] if one is None else [one, two])
        return known

    def opens(self, signs: str) -> bool:
        """Whether a vocabulary entry begins with ``signs``."""
        i = bisect_left(self.ordered, signs)
        return i < len(self.ordered) and self.ordered[i].startswith(signs)

    def feed(self, state: tuple, c: str) -> tuple[tuple, int]:
        """(state, change in tokens) after a character."""
        change = 0
        for byte in c.encode("utf-8", "surrogatepass"):
            sign = self.alphabet[byte]
            last, delta = next((since + sign, there + 1) for since, token, there in state
                               if since + sign in self.tokens and self.adjacent(token, since + sign))
            state = (*((since + sign, token, there - delta) for since, token, there in state if self.opens(since + sign)),
                     ("", last, 0))
            change += delta
        return state, change


class State(dict):
    """Transitions character -> (next state, change in tokens), made when first asked for."""

    __slots__ = ("key", "machine")

    def __init__(self, machine: Transducer, key: tuple):
        self.machine, self.key = machine, key

    def __missing__(self, c: str):
        key, change = self.machine.step(self.key, c)
        made = self[c] = (self.machine.state(key), change)
        return made


class Transducer:
    """State keys are (kind of the open piece, merger state, held-back character)."""

    BEGIN = ("", Merger.START, "")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merger = Merger(list(spec["model"]["vocab"]), spec["model"]["merges"])
        added = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.states: dict[tuple, State] = {}

    def state(self, key: tuple) -> State:
        found = self.states.get(key)
        if found is None:
            if len(self.states) >= STATES:
                self.states = {}
            found = self.states[key] = State(self, key)
        return found

    def open(self, c: str, k: str, blank: bool = False) -> tuple[tuple, int]:
        """Begin a piece at a sure boundary; ``blank``: a blank goes before it."""
        if k == "S":
            return ("S", Merger.START, c), 0  # the last white space of a run is held back
        state, change = self.merger.feed(Merger.START, " ") if blank else (Merger.START, 0)
        state, more = self.merger.feed(state, c)
        return ("'" if c == "'" and not blank else k, state, ""), change + more

    def step(self, key: tuple, c: str) -> tuple[tuple, int]:
        opened, state, held = key
        k = kind(c)
        if opened == "":
            return self.open(c, k)
        if opened == "'":
            if c in ONE:
                return self.BEGIN, self.merger.feed(state, c)[1]
            if c in TWO:
                return ("'2", state, c), 0
            opened = "O"
        if opened == "'2":
            if TWO[held] == c:
                state, change = self.merger.feed(state, held)
                return self.BEGIN, change + self.merger.feed(state, c)[1]
            key, change = self.open(held, "L")  # no contraction: a sign, then a word
            key, more = self.step(key, c)
            return key, change + more
        if opened == "S":
            if k == "S":
                state, change = self.merger.feed(state, held)
                return ("S", state, c), change
            if held == " ":
                return self.open(c, k, blank=True)
            alone = self.merger.feed(Merger.START, held)[1]
            key, change = self.open(c, k)
            return key, alone + change
        if opened == k:
            state, change = self.merger.feed(state, c)
            return (k, state, ""), change
        return self.open(c, k)

    def finish(self, key: tuple) -> int:
        """Tokens that the end of the text adds."""
        opened, state, held = key
        if opened == "'2":
            return self.merger.feed(Merger.START, held)[1]
        return self.merger.feed(state, held)[1] if held else 0

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        total, node = 0, self.state(self.BEGIN)
        for c in text:
            node, change = node[c]
            total += change
        return total + self.finish(node.key)

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, inner tokens, tail); inner is None if the chunk has no sure boundary."""
        first = SYNC.search(chunk)
        if first is None:
            return chunk, None, ""
        last = SYNC_BACK.search(chunk).start()
        return chunk[:first.start()], self.count(chunk[first.start():last]), chunk[last:]


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, chunk: int = CHUNK) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        machine = transducer(tokenizer_path)
        return pd.Series(np.fromiter(map(machine.count, texts), np.int64, len(texts)))

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(tokenizer_path)
        for batch in batches:
            found = [machine.chunk_map(t) for t in batch["chunk"]]
            yield pd.DataFrame({"row": batch["row"], "part": batch["part"], "head": [f[0] for f in found],
                                "inner": pd.array([f[1] for f in found], "Int64"), "tail": [f[2] for f in found]})

    small = slim.where(F.length("text") <= chunk).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                                                        counted("text").alias("n_tokens"))
    # rows are numbered once, in a written table: a repeated task reads the same numbers
    long = saved(slim.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    cut = F.expr(f"transform(sequence(0, cast((length(text) - 1) div {chunk} as int)), i -> substring(text, i * {chunk} + 1, {chunk}))")
    pieces = long.select("row", F.posexplode(cut).alias("part", "chunk")).repartition("row", "part")
    mapped = saved(pieces.mapInPandas(maps, "row long, part int, head string, inner long, tail string"), "chunk-maps")
    # scan: every sure boundary closes a seam, and seam s holds the tail after it up to the next head
    upto = Window.partitionBy("row").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sure = F.col("inner").isNotNull().cast("int")
    scanned = mapped.select("*", F.sum(sure).over(upto).alias("seam"))
    text_of = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "end", "piece"))), lambda x: x["piece"]), "")
    seams = (scanned.select("row", F.explode(F.array(
                 F.struct((F.col("seam") - sure).alias("seam"), "part", F.lit(0).alias("end"), F.col("head").alias("piece")),
                 F.struct(F.col("seam"), "part", F.lit(1).alias("end"), F.col("tail").alias("piece")))).alias("x"))
             .select("row", "x.*").groupBy("row", "seam").agg(text_of.alias("text"))
             .select("row", counted("text").alias("n")))
    summed = (seams.union(mapped.select("row", F.coalesce("inner", F.lit(0)).alias("n")))
              .groupBy("row").agg(F.sum("n").alias("n_tokens")))
    large = (long.select("row", "doc_id", F.octet_length("text").cast("long").alias("n_bytes")).join(summed, "row")
             .select("doc_id", "n_bytes", "n_tokens"))
    return small.union(large).withColumn("over_limit", F.col("n_tokens") > limit)
