import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from loglark.llm.conversation_repair import damaged, repair_report, repaired_turns

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def cheapest(turns):
    """Least (cost, letters) by recursion over suffixes; ``turns`` of (initial, fault)."""
    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        ways = [(0, "")] if i == len(turns) and state in ("", "a") else []
        fit = "a" if state == "u" else "u"
        if inserted < 2 and (more := best(i, fit, inserted + 1)):
            ways.append((5 + more[0], "I" + more[1]))
        if i < len(turns):
            initial, fault = turns[i]
            edits = [("D", 2, state)]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                edits.append(("R", 1 + extra, fit))
                if (state, initial) in NEXT:
                    edits.append(("K", extra, NEXT[state, initial]))
            ways += [(cost + rest[0], letter + rest[1]) for letter, cost, to in edits if (rest := best(i + 1, to, 0))]
        return min(ways, default=None)
    for i in range(len(turns), 0, -1):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def brute(rows, ids):
    out = []
    for conv in set(ids):
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            signs = re.findall(r"[^\x20\x09-\x0d]", text)
            fault = ("blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            turns.append((role[:1], fault))
        numbers = {t for t, _, _ in mine if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = cheapest(tuple(turns))
        lines, at, state = [], 0, ""
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            fit = "a" if state == "u" else "u"
            state = mine[at][1][:1] if letter == "K" else fit
            name = mine[at][1] if letter == "K" else {"a": "assistant", "u": "user"}[fit]
            lines.append(name + ":" + ("" if letter == "I" else mine[at][2]))
            at += letter != "I"
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, pos int").repartition(3)


@pytest.fixture(scope="module")
def many():
    rnd = random.Random(8)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unicorn"]
    texts = ["", " ", "Yes.", "No!", "why?", "half a", "é. \n", "trailing .  ", "同", None, "Yes."]
    rows = []
    for conv in range(120):
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv if conv else None, turn if rnd.random() < 0.9 else rnd.choice((None, turn + 5)),
                         rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"said {rnd.random()}" + rnd.choice(".!?,")))
    for turn in range(1500):  # many blocks
        rows.append((500, turn, rnd.choice(roles[:5]), f"long {turn}" + rnd.choice(("?", ".", ".", ","))))
    return rows + [(501, 3, "user", "same.")] * 30


def test_report_matches_recursion(spark, many, monkeypatch):
    monkeypatch.setattr("loglark.llm.conversation_repair.BLOCK_BITS", 4)
    monkeypatch.setattr("loglark.llm.conversation_repair.FAN_IN", 4)  # several levels of products
    got = repair_report(conversations(spark, many))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(many, {r[0] for r in many})


def test_damage(spark, many):
    rows = []
    for conv, turn, role, text in many:
        role, text = role if role is not None else " ", text if text is not None else " "
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        rows += [(conv, turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    docs = conversations(spark, many)
    assert sorted(map(tuple, damaged(docs).collect()), key=repr) == sorted(rows, key=repr)
    assert sorted(map(tuple, repair_report(damaged(docs), docs).collect()), key=repr) == brute(rows, {r[0] for r in many})


def test_conversations_without_rows_and_empty_tables(spark):
    none = conversations(spark, [])
    assert repair_report(none).count() == 0 and repaired_turns(none).count() == 0
    ids = spark.createDataFrame([(5,), (None,), (5,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, repair_report(none, ids).collect()), key=repr) == [(5, *[0] * 6, "", empty), (None, *[0] * 6, "", empty)]


def test_repaired_turns_follow_the_grammar(spark, many):
    got = sorted((r.conv_id is not None, r.conv_id or 0, r.nth, r.role, r.edit, r.text) for r in repaired_turns(conversations(spark, many)).collect())
    by = {}
    for has, conv, nth, role, *_ in got:
        by.setdefault((has, conv), []).append(role[0])
        assert nth == len(by[has, conv]) - 1
    assert all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in by.values())


def test_ties_take_the_least_letters(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b."), (2, 0, "user", "q?"), (3, 0, "user", "x" * 200_000), (3, 1, "assistant", "y.")]
    got = {r.conv_id: (r.cost, r.audit) for r in repair_report(conversations(spark, rows)).collect()}
    assert got == {1: (2, "RR"), 2: (2, "D"), 3: (4, "DD")}
