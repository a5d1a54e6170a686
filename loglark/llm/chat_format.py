r"""Chat formatting with a grammar round trip (operator 7), DataFrame functions only.

Template, per turn::

    ### <Role>: <text></turn>\n

A text may itself hold control strings.  Escaping puts a backslash in front of
every backslash and inside ``##`` and ``</turn>``, so an escaped text holds no control string, and
dropping one backslash before each escaped character gives the text back.

Formatting is a round trip: a text is first rendered as it is, the rendering of
the turn is parsed, and only if the parser does not recover role and text, or a
control string is inside, the escaped form is taken.  The whole conversation
is parsed again, and one whose turns differ from the source in any character
fails the job instead of passing on a changed text.

Defined results: null text and null role are empty; turns are ordered by turn
(null first), then role, then text; repeated rows are repeated turns; rows with
null conv_id form one conversation of that name; an empty table gives an
empty result; other columns are ignored.

A conversation is one output string, so its turns meet in one row; long rows
share no task-wide state with others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP, END_LINE = "### ", "</turn>", "\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("##"), F.lit("#\\#"))  # no run of three is left
    return F.replace(out, F.lit(STOP), F.lit("<\\/turn>"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(":"), F.lit("\\:")), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def header(role: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit(": "))


def parse_turn(piece: Column) -> Column:
    """(role, text, header length) of one rendered turn without its stop."""
    head = F.regexp_extract(piece, r"(?s)^### ((?:[^:\\\n]++|\\.)*+): ", 0)
    role = F.substring(head, F.lit(5), F.length(head) - 6)
    text = F.substring(piece, F.length(head) + 1, F.length(piece))
    return F.struct(unescape(role).alias("role"), unescape(text).alias("text"), F.length(head).alias("head"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, by the grammar above."""
    pieces = F.split(formatted, STOP + END_LINE, -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), parse_turn)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start from 0 and
    length, in characters of ``formatted``, of every assistant text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", F.col("turn"), role.alias("role"), text.alias("text"))
    plain = F.concat(header(F.col("role")), F.col("text"))
    read = parse_turn(plain)
    same = ((read["role"] == F.col("role")) & (read["text"] == F.col("text"))
            & ~F.contains("text", F.lit("###")) & ~F.contains("text", F.lit(STOP)))
    turns = rows.select("conv_id", F.struct("turn", "role", "text",
                                            F.when(same, F.col("text")).otherwise(escape(F.col("text"))).alias("body")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # spans: a running start over the turns, kept where the assistant speaks
    spans = F.expr(f"""aggregate(turns, named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, length: bigint>>)),
        (acc, t) -> named_struct(
            'at', acc.at + length(t.head) + length(t.body) + {len(STOP + END_LINE)},
            'spans', if(t.role = '{ASSISTANT}',
                        concat(acc.spans, array(named_struct('start', acc.at + length(t.head), 'length', cast(length(t.body) as bigint)))),
                        acc.spans)),
        acc -> acc.spans)""")
    wide = grouped.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"),
                                                                               t["body"].alias("body"), header(t["role"]).alias("head"))))
    made = wide.select("conv_id", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(STOP + END_LINE))), "")
                       .alias("formatted"), spans.alias("loss_spans"),
                       F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("source"))
    back = F.transform(parse(F.col("formatted")), lambda t: F.struct(t["role"], t["text"]))
    checked = F.when(back == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("round trip differs in conversation "), F.col("conv_id").cast("string"))))
    return made.select("conv_id", checked.alias("formatted"), "loss_spans")


def digest(formatted: DataFrame) -> DataFrame:
    """Digest columns, all read from the formatted text and its loss spans."""
    turns = parse(F.col("formatted"))
    masked = F.transform("loss_spans", lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    loss = F.array_join(F.transform(masked, unescape), "")
    rows = formatted.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
