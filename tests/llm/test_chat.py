"""Chat formatting: grammar round trip and digests (operator 7)."""

import hashlib
import random

import duckdb

from loglark.llm import chat_format as cf
from loglark.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, head string"
SF = "/root/testdata/sf0.001"


def test_round_trip_of_hostile_texts(spark):
    rnd = random.Random(4)
    parts = ["#", "##", "###", "### ", "### Assistant: ", "</turn>", "</turn>\n", "\\", "\\#", "<\\/turn>", "\n", ": ", "a", "é", "😀", "</", "turn>"]
    roles = ["user", "assistant", "system", None, "", "odd: role\n###", "back\\slash", "</turn>\n### x: "]
    rows = [(c, t, rnd.choice(roles), None if rnd.random() < .1 else "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))), "x")
            for c in range(40) for t in range(rnd.randint(1, 6))]
    rows += [(None, None, "assistant", "no id", "x"), (50, 1, "assistant", "same", "x"), (50, 1, "assistant", "same", "x"),
             (51, 0, "assistant", "long " * 20_000, "x")]
    made = cf.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {r["conv_id"]: r for r in cf.digest(spark.createDataFrame(made, "conv_id long, formatted string, loss_spans array<struct<start:bigint,length:bigint>>")).collect()}
    by = {}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    formatted = {r["conv_id"]: r["formatted"] for r in made}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(turns) == formatted[c].count("</turn>\n")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(formatted[c])
        assert formatted[c].count("###") == len(turns)  # no control string is left inside a text or role


def test_empty_table(spark):
    assert cf.digest(cf.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_matches_sql(spark):
    got = QUERIES["op7_chat"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(ORACLE["op7_chat"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
