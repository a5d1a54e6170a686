r"""Conversation structure repair with scalar big-integer weights (operator 12).

A conversation is repaired by edits of its turns: Keep costs 0, Rerole to user or
assistant 1, Delete 2 (required for blank and duplicate turns), Insert of an empty user or assistant
turn 5; a truncated turn that is not deleted costs 5 more.  The roles that remain must read
``(s?(ua)+)?`` by their initials.  Of the cheapest ways the one whose letters (K, R, D, I, in
order) are ASCII-least is taken.

Both wishes are one integer: the high digits of a weight are the cost, below them stands
one base-8 digit per letter (D < I < K < R are 1 to 4, 0 pads the end) at the place that
the letter has in the audit.  Weights of edges add up, so the repair is an ordinary shortest
path by least integer over (turn, grammar state).  Taking the least weight in each state is
sound: two ways of equal cost into one state never have one audit as the beginning of the other,
as the rest would be inserts that come back to the state they left, at a cost.

The same holds for a stretch of turns from any state to any state, so a conversation is cut
into blocks of ``BLOCK`` turns, each block gives a 4 x 4 matrix of (cost, audit), and matrices are
multiplied (least weight over the middle state) in a tree.  No conversation, however long, is
collected: turns are ordered by a range partitioning, and what meets in one group is
``FAN_IN`` matrices.  Only the last pass, whose SHA-256 runs over a conversation's text in order,
reads a conversation in one task, as a stream of batches.

Defined results: a null role or text is one space; turns are ordered by turn (null first),
then role, then text; rows with null conv_id are one conversation; repeated rows are duplicate turns; very long
texts are read whole; other columns are not looked at; an empty table gives an empty result.
A role whose initial is none of s, u, a can only be rerolled or deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglark.llm.common import prepare, saved

#: Turns to a block (a power of two), matrices multiplied in one group, keys a repeated turn is spread over.
BLOCK_BITS, FAN_IN, SALT = 8, 64, 16

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn with this initial, by the state before it.
STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The state after a user or assistant turn that is made to fit, by the state before it.
FITS = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ACCEPTED = (START, ASSISTANT)
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_TO_DIGITS = str.maketrans({k: str(v) for k, v in DIGIT.items()})
_TO_LETTERS = str.maketrans({str(v): k for k, v in DIGIT.items()})

MATRIX = "costs array<bigint>, audits array<string>"


def weight(cost: int, audit: str, width: int) -> int:
    """Cost above ``width`` letter places; unused places at the end are zero."""
    return cost << 3 * width | int(audit.translate(_TO_DIGITS).ljust(width, "0") or "0", 8)


def read_weight(w: int, width: int) -> tuple[int, str]:
    digits = f"{w & ((1 << 3 * width) - 1):0{width}o}" if width else ""
    return w >> 3 * width, digits.rstrip("0").translate(_TO_LETTERS)


def with_inserts(best: dict[int, tuple[int, int]], width: int) -> dict[int, tuple[int, int]]:
    """Up to two inserts after what is there; a third would be back in a state already left."""
    out, last = dict(best), best
    for _ in range(2):
        more = {}
        for state, (w, at) in last.items():
            new = (w + (INSERT << 3 * width) + (DIGIT["I"] << 3 * (width - 1 - at)), at + 1)
            to = FITS[state]
            more[to] = min(more.get(to, new), new)
        for state, new in more.items():
            out[state] = min(out.get(state, new), new)
        last = more
    return out


@lru_cache(maxsize=100_000)
def block_matrix(turns: str) -> tuple[tuple[int | None, str | None], ...]:
    """The cheapest way through a block from each state to each state, 16 entries.

    ``turns`` has one character per turn: its initial (``x`` for none of s, u, a), in capitals if
    it is truncated, or ``-`` if it must be deleted."""
    width = 3 * len(turns)
    out = []
    for start in range(4):
        best = {start: (0, 0)}  # state: weight, letters so far
        for turn in turns:
            after: dict[int, tuple[int, int]] = {}
            fault = TRUNCATED if turn.isupper() else 0
            for state, (w, at) in with_inserts(best, width).items():
                edits = [("D", DELETE, state)]
                if turn != "-":
                    edits.append(("R", REROLE + fault, FITS[state]))
                    if (to := STEP.get(turn.lower(), {}).get(state)) is not None:
                        edits.append(("K", KEEP + fault, to))
                for letter, cost, to in edits:
                    new = (w + (cost << 3 * width) + (DIGIT[letter] << 3 * (width - 1 - at)), at + 1)
                    after[to] = min(after.get(to, new), new)
            best = after
        out += [read_weight(best[to][0], width) if to in best else (None, None) for to in range(4)]
    return tuple(out)


def times(a, b):
    """The matrix of one stretch after another: least weight over the state in the middle."""
    out = []
    for i in range(4):
        for k in range(4):
            ways = [(a[4 * i + j][0] + b[4 * j + k][0], a[4 * i + j][1] + b[4 * j + k][1]) for j in range(4)
                    if a[4 * i + j][0] is not None and b[4 * j + k][0] is not None]
            width = max((len(audit) for _, audit in ways), default=0)
            out.append(min(ways, key=lambda x: weight(*x, width), default=(None, None)))
    return tuple(out)


def cheapest(matrix) -> tuple[int, str]:
    """Cost and audit from the start to an accepted end, with inserts at the end."""
    ways = {to: matrix[to] for to in range(4) if matrix[to][0] is not None}
    width = max(len(audit) for _, audit in ways.values()) + 2
    ends = with_inserts({to: (weight(*way, width), len(way[1])) for to, way in ways.items()}, width)
    return read_weight(min(ends[to] for to in ACCEPTED if to in ends)[0], width)


def as_columns(matrices) -> pd.DataFrame:
    return pd.DataFrame({"costs": [[c for c, _ in m] for m in matrices], "audits": [[a for _, a in m] for m in matrices]})


def as_matrix(costs, audits):
    return tuple((None if c is None or c != c else int(c), a) for c, a in zip(costs, audits, strict=True))


def faults(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` in order: adds pos, increasing along each conversation, and the first fault."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", or_space("role"), or_space("text"))
    last = F.regexp_extract(F.reverse("text"), r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D])", 1)
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    turns = saved(rows.select("conv_id", "turn", "role", "text", same.alias("same"), last.alias("last"),
                              F.monotonically_increasing_id().alias("at")), "turns")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    first = (turns.groupBy("conv_id", "same").agg(F.min(F.struct("turn", "at")).alias("first"), F.count("*").alias("times"))
             .where("times > 1").select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first", salts.alias("salt")))
    left = turns.withColumn("spread", F.pmod("at", F.lit(SALT)).cast("int"))
    marked = left.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")) & (F.col("spread") == F.col("salt")), "left")
    fault = (F.when(F.col("last") == "", "blank").when(F.col("first")["at"] != F.col("at"), "duplicate")
             .when(~F.col("last").isin(".", "!", "?"), "truncated"))
    order = ["conv_id", "turn", "role", "text", "at"]
    # the id numbers the rows of one task in order, and tasks in the order of their ranges
    return saved(marked.select(*order, fault.alias("fault")).repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("pos", F.monotonically_increasing_id()).drop("at"), "turns-in-order")


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, cost and audit of every conversation of ``faults``."""
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    sign = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    letters = turns.select("conv_id", "pos", sign.alias("sign"), F.shiftright("pos", BLOCK_BITS).alias("block"))
    blocks = (letters.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "sign"))).alias("t"))
              .select("conv_id", "block", F.array_join(F.transform("t", lambda t: t["sign"]), "").alias("turns")))

    @F.pandas_udf(MATRIX)
    def solve(turns: pd.Series) -> pd.DataFrame:
        return as_columns([block_matrix(t) for t in turns])

    @F.pandas_udf(MATRIX)
    def multiply(parts: pd.Series) -> pd.DataFrame:
        out = []
        for group in parts:
            matrices = [as_matrix(p["costs"], p["audits"]) for p in group]
            product = matrices[0]
            for m in matrices[1:]:
                product = times(product, m)
            out.append(product)
        return as_columns(out)

    @F.pandas_udf("cost bigint, audit string")
    def finish(m: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([cheapest(as_matrix(c, a)) for c, a in zip(m["costs"], m["audits"], strict=True)], columns=["cost", "audit"])

    blocks = blocks.select("conv_id", "block", solve("turns").alias("m"))
    of_one = F.count("*").over(Window.partitionBy("conv_id"))
    level = saved(blocks.withColumn("n", of_one), "blocks")
    ready, level = level.where("n = 1").select("conv_id", "m"), level.where("n > 1")  # nearly all are one block
    while not level.isEmpty():
        nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("block")) - 1
        groups = (level.select("conv_id", nth.alias("nth"), "m").withColumn("block", F.floor(F.col("nth") / FAN_IN))
                  .groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("nth", "m"))).alias("t")))
        level = saved(groups.select("conv_id", "block", multiply(F.transform("t", lambda t: t["m"])).alias("m")).withColumn("n", of_one), "products")
        ready, level = ready.unionByName(level.where("n = 1").select("conv_id", "m")), level.where("n > 1")
    return ready.select("conv_id", finish("m").alias("f")).select("conv_id", "f.cost", "f.audit")


def in_order(turns: DataFrame, found: DataFrame, ids: DataFrame) -> DataFrame:
    """The turns of each conversation after one row with its audit, one conversation after another in a task."""
    nothing = lambda t, c: F.lit(None).cast(t).alias(c)
    head = ids.select("conv_id").unionByName(found.select("conv_id")).distinct()
    known = found.select(F.col("conv_id").alias("c"), "cost", "audit")
    head = head.join(known, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", F.lit(-1).cast("long").alias("pos"), nothing("long", "turn"), nothing("string", "role"), nothing("string", "text"),
        nothing("string", "fault"), F.coalesce("cost", F.lit(0)).cast("long").alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"))
    body = turns.select("conv_id", "pos", "turn", "role", "text", "fault", nothing("long", "cost"), nothing("string", "audit"))
    return head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "pos")


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, dict, str | None, str | None, str | None]]:
    """Along the rows of ``in_order``: ("head", row, ..) per conversation, then ("edit", row, letter, role, text) per letter
    of its audit; an insert has no row of its own (an empty dict), a deleted turn no role."""
    audit, at, state = "", 0, START

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, FITS[state]
            yield "edit", {}, "I", "user" if state == USER else "assistant", ""

    for batch in batches:
        for row in batch.to_pylist():
            if row["pos"] < 0:
                yield from inserts()
                audit, at, state = row["audit"], 0, START
                yield "head", row, None, None, None
                continue
            yield from inserts()
            letter, at = audit[at], at + 1
            if letter == "D":
                yield "edit", row, letter, None, None
                continue
            state = STEP[row["role"][0]][state] if letter == "K" else FITS[state]
            role = row["role"] if letter == "K" else "user" if state == USER else "assistant"
            yield "edit", row, letter, role, row["text"]
    yield from inserts()


TURNS = "conv_id long, nth long, edit string, role string, text string"


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, nth (from 0), edit (K, R or I), role, text."""
    prepare(rows.sparkSession)
    turns = faults(rows)

    def run(batches):
        conv, nth, out = None, 0, []
        for kind, row, letter, role, text in walked(batches):
            if kind == "head":
                conv, nth = row["conv_id"], 0
            elif letter != "D":
                out.append({"conv_id": conv, "nth": nth, "edit": letter, "role": role, "text": text})
                nth += 1
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("nth", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    return in_order(turns, audits(turns), turns).mapInArrow(run, TURNS)


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation its faults, the cheapest repair and the digest of the repaired text.

    ``ids(conv_id)`` names conversations that are to come back even without rows."""
    prepare(rows.sparkSession)
    turns = faults(rows)
    legal = ("su", "ua", "au")

    def run(batches):
        out, now = [], None

        def close():
            one = {k: now[k] for k in schema.names if k in now}
            gaps = now["last"] - now["first"] + 1 - now["distinct"] if now["distinct"] else 0
            return one | {"gaps": gaps, "repaired_sha256": now["sha"].hexdigest()}

        for kind, row, _, role, text in walked(batches):
            if kind == "head":
                if now:
                    out.append(close())
                    if len(out) >= 512:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
                now = {"conv_id": row["conv_id"], "cost": row["cost"], "audit": row["audit"], "blank": 0, "duplicate": 0, "truncated": 0,
                       "illegal": 0, "first": None, "last": None, "distinct": 0, "role": None, "sha": hashlib.sha256(), "any": False}
                continue
            if row:
                if row["fault"]:
                    now[row["fault"]] += 1
                if now["role"] is not None and now["role"][:1] + row["role"][:1] not in legal:
                    now["illegal"] += 1
                now["role"] = row["role"]
                if row["turn"] is not None and row["turn"] != now["last"]:
                    now["first"] = row["turn"] if now["first"] is None else now["first"]
                    now["last"], now["distinct"] = row["turn"], now["distinct"] + 1
            if role is not None:
                now["sha"].update((("\n" if now["any"] else "") + role + ":" + text).encode())
                now["any"] = True
        if now:
            out.append(close())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in REPORT.split(", ")])
    return in_order(turns, audits(turns), turns if ids is None else ids).mapInArrow(run, REPORT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with seeded faults, by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 takes away
    its ``[.!?]``, 3 repeats it, 4 sets role user."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), how.alias("how"))
    text: Column = (F.when(F.col("how") == 1, F.lit("")).when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    return rows.where("how <> 0").select(
        "conv_id", "turn", F.when(F.col("how") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
