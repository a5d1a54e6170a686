"""Paragraph MinHash (operator 2) and line chunks (operator 6) against brute force."""


import numpy as np

from llm.helpers import ODD
from loglark.llm import line_chunks as lc
from loglark.llm import paragraph_minhash as pm


def sets(text):
    return [(at, pm.shingles(p)) for at, p in pm.folded_paragraphs(text)]


def brute_clusters(rows):
    """{(doc_id, paragraph): first of its cluster} for paragraphs with an alike one."""
    parts = sorted((i, at, s) for i, t in rows if i is not None and t is not None for at, s in sets(t))
    label = list(range(len(parts)))
    for a in range(len(parts)):
        for b in range(a):
            one, two = parts[a][2], parts[b][2]
            if len(one & two) >= pm.LIKE * len(one | two):
                x, y = label[a], label[b]
                label = [min(x, y) if v in (x, y) else v for v in label]
    groups = {}
    for v, p in zip(label, parts):
        groups.setdefault(v, []).append(p[:2])
    return {k: g[0] for g in groups.values() if len(g) > 1 for k in g}


def test_repeats_match_brute_force(make, prose, monkeypatch):
    monkeypatch.setattr(pm, "TILE", 4)
    passages = [prose(60) for _ in range(5)]
    near = [" ".join(w if k != 30 else "changed" for k, w in enumerate(p.split())) for p in passages]
    rows = [(i, "\n".join([prose(20), passages[i % 5] if i % 2 else near[i % 5], prose(12), "short line"])) for i in range(24)]
    rows += [(100, passages[0] + "\n" + passages[0].upper()), (101, prose(80)), *ODD, (905, passages[1].replace(" ", "  "))]
    got = pm.repeated_paragraphs(make(rows)).collect()
    want = brute_clusters(rows)
    assert {(r["doc_id"], r["paragraph"]): (r["first_doc_id"], r["first_paragraph"]) for r in got} == want
    assert {(r["doc_id"], r["paragraph"]) for r in got if not r["removed"]} == set(want.values())


def test_removed_paragraphs_leave_the_text(make, prose):
    same = prose(55)
    docs = make([(1, f"{prose(9)}\n{same}\nend"), (2, f"start\n{same}"), (3, prose(30)), (None, same)])
    left = {r["doc_id"]: r["text"] for r in pm.without_repeats(docs).collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert left[2] == "start" and all(left[i] == before[i] for i in (1, 3, None))
    assert pm.without_repeats(docs).columns == docs.columns
    assert pm.repeated_paragraphs(make([])).collect() == []


def test_signatures_do_not_depend_on_neighbours(prose):
    parts = [prose(n).encode() for n in (5, 60, 7, 300)]
    keys, bands, n = pm.signatures(parts)
    for k, p in enumerate(parts):
        one, band, m = pm.signatures([p])
        assert (keys[k] == one[0]).all() and (bands[k] == band[0]).all() and n[k] == m[0] == len(p.split()) - 4
    assert len(np.unique(bands)) == bands.size


def test_banding_recall(prose):
    """Pairs at Jaccard 0.8 to 0.85 meet in some band."""
    met = total = 0
    for k in range(150):
        w = prose(200).split()
        other = [*w]
        for i in range(4):
            other[10 + 45 * i] = f"other{i}"
        one, two = " ".join(w).encode(), " ".join(other).encode()
        a, b = pm.shingles(one), pm.shingles(two)
        if 0.8 <= len(a & b) / len(a | b) <= 0.85:
            bands = pm.signatures([one, two])[1]
            met, total = met + bool((bands[0] == bands[1]).any()), total + 1
    assert total > 100 and met / total >= 0.99


def plain_chunks(spark, texts):
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, row long, text string")
    return {r["doc_id"]: [(c["start"], c["lines"]) for c in r["cuts"]] for r in lc.with_chunks(rows).collect()}


def test_chunks_cover_lines_and_resist_shifts(spark, prose):
    body = [prose(4) for _ in range(80)]
    texts = ["\n".join(body), "\n".join([prose(3), prose(3), *body]), "", "x", "\n\n\n"]
    cuts = plain_chunks(spark, texts)
    for i, t in enumerate(texts):
        lines = t.split("\n")
        assert sum(n for _, n in cuts[i]) == len(lines) and [s for s, _ in cuts[i]] == [sum(n for _, n in cuts[i][:k]) for k in range(len(cuts[i]))]
    plain = lambda i: {"\n".join(texts[i].split("\n")[s:s + n]) for s, n in cuts[i]}
    assert len(plain(0) & plain(1)) >= len(plain(0)) - 2


def test_line_dedup_matches_brute_force(spark, make, prose):
    block = "\n".join(prose(5) for _ in range(30))
    rows = [(i, f"{prose(6)}\n{block}\n{prose(6)}" if i % 3 else "\n".join(prose(6) for _ in range(8))) for i in range(12)]
    rows += [*ODD, (30, block + "\n" + block), (31, "a\nb\nc"), (32, "a\nb\nc")]
    got = lc.dedup_lines(make(rows)).collect()
    unique = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    cuts = plain_chunks(spark, [t for _, t in unique])
    seen = {}
    for k, (i, t) in enumerate(unique):
        for s, n in cuts[k]:
            if n >= lc.LEAST:
                seen.setdefault("\n".join(t.split("\n")[s:s + n]), []).append(((i is not None, i or 0, s), k, s, n))
    gone = {}
    for places in seen.values():
        for _, k, s, n in sorted(places)[1:]:
            gone.setdefault(k, set()).update(range(s, s + n))
    want = {}
    for k, (i, t) in enumerate(unique):
        lines = t.split("\n")
        left = [x for j, x in enumerate(lines) if j not in gone.get(k, ())]
        want[i, t] = (len(lines), len(lines) - len(left), "\n".join(left))
    expected = [(i, *(want[i, t] if t is not None else (0, 0, None))) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert sum(r["n_removed"] for r in got) > 100
    assert lc.dedup_lines(make([])).collect() == []


def test_every_repeated_run_of_lines_goes(make, prose):
    """Short blocks in the midst of other lines, against all pairs of lines in a row."""
    blocks = [[prose(5) for _ in range(n)] for n in (2, 2, 3, 4, 6) for _ in range(4)]
    rows = [(i, "\n".join([prose(4), *blocks[i % 20], prose(4), *blocks[(7 * i + 3) % 20], prose(4)])) for i in range(40)]
    rows += [(50, "\n".join([blocks[0][1], *blocks[1], blocks[5][0]])), (51, "same\nsame\nsame"), (52, f"{blocks[3][0]}\nalone")]
    seen, want = set(), {}
    for i, text in rows:
        lines, gone = text.split("\n"), set()
        for k in range(len(lines) - 1):
            pair = (lines[k], lines[k + 1])
            gone |= {k, k + 1} if pair in seen else set()
            seen.add(pair)
        want[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    got = {r["doc_id"]: r["text"] for r in lc.dedup_lines(make(rows)).collect()}
    assert got == want
    assert got[52] == rows[-1][1] and got[50] == f"{blocks[0][1]}\n{blocks[5][0]}"


def test_no_group_of_a_hot_bucket_holds_more_than_two_tiles(spark, monkeypatch):
    monkeypatch.setattr(pm, "TILE", 20)
    members = spark.createDataFrame([(7, 200, k, k * k) for k in range(200)] + [(8, 3, k, 1) for k in range(3)], "bucket long, size long, k1 long, k2 long")
    groups = {}
    for r in pm.tile_pairs(members).collect():
        groups.setdefault((r["bucket"], r["one"], r["two"]), []).append((r["k1"], r["guest"]))
    own = {t: len(g) for (b, t, u), g in groups.items() if t == u and b == 7}
    assert len(own) == 10 and sum(own.values()) == 200 and max(map(len, groups.values())) <= 2 * max(own.values()) <= 80
    met = [(b, *sorted((x, y))) for (b, t, u), g in groups.items() for k, (x, gx) in enumerate(g) for y, gy in g[:k] if t == u or gx != gy]
    assert len(met) == len(set(met)) == 200 * 199 // 2 + 3  # every pair once


def test_hot_bucket_of_a_templated_line(make, prose, monkeypatch):
    monkeypatch.setattr(pm, "TILE", 6)
    words = prose(80).split()
    rows = [(i, " ".join([*words[:40], f"number{i}", *words[40:]])) for i in range(70)] + [(200 + i, prose(40)) for i in range(10)]
    got = pm.repeated_paragraphs(make(rows)).collect()
    assert {r["doc_id"]: r["first_doc_id"] for r in got} == {i: 0 for i in range(70)}


def test_groups_may_lie_across_batches():
    import pandas as pd
    words = b"one two three four five six seven eight"
    rows = [(7, 0, 0, no, False, words) for no in range(4)] + [(9, 0, 1, 10, False, words), (9, 0, 1, 11, True, words), (9, 1, 1, 12, False, b"a b c d e")]
    cols = [*pm.GROUP, "no", "guest", "words"]
    for size in (1, 2, 3, 7):
        batches = (pd.DataFrame(rows[i:i + size], columns=cols) for i in range(0, len(rows), size))
        links = pd.concat(list(pm.linked(batches)))
        assert sorted(zip(links["a"], links["b"], strict=True)) == [(0, 1), (0, 2), (0, 3), (10, 11)]
    assert sum(map(len, pm.linked(iter([])))) == 0


def found_in(rows):
    return {r["doc_id"] for r in rows}


def test_passages_inside_lines_across_lines_and_wrapped_anew(make, prose):
    """Runs of 50 words or more in longer lines, over line ends and in other line widths, in upper case too; short stock lines are no repeats."""
    rows, runs, stock = [], [prose(n) for n in (50, 51, 64, 120)], [prose(13), prose(30)]
    for k, run in enumerate(runs):
        w = run.split()
        wrapped = "\n".join(" ".join(w[i:i + 7]) for i in range(0, len(w), 7))
        rows += [(10 * k, f"{prose(9)}\n{prose(70)} {run} {prose(40)}"), (10 * k + 1, f"{prose(3)} {run.upper()} {prose(80)}\n{prose(60)}"),
                 (10 * k + 2, f"{prose(11)}\n{prose(5)} {wrapped} {prose(6)}")]
    clean = [(100 + i, "\n".join([prose(60), stock[i % 2], prose(200), stock[0], prose(5)])) for i in range(20)]
    got = pm.repeated_paragraphs(make([*rows, *clean])).collect()
    assert found_in(got) == {i for i, _ in rows}
    text = dict(rows)
    for r in got:
        words = " ".join(text[r["doc_id"]].lower().split()[r["word"]:r["word"] + r["words"]])
        first = r["doc_id"] // 10 * 10
        assert (r["first_doc_id"], r["removed"]) == (first, r["doc_id"] != first) and words in runs[first // 10].lower()
        lines = [at for at, line in enumerate(text[r["doc_id"]].split("\n")) for _ in line.split()]
        assert r["paragraph"] == lines[r["word"]] and r["words"] >= pm.UNIT


def test_no_task_holds_all_rows_of_a_hot_class(spark, monkeypatch):
    monkeypatch.setattr(pm, "HOT", 10)
    rows = spark.createDataFrame([(7, 7, i) for i in range(400)] + [(i, 1, i) for i in range(40)] + [(99, 9, 0)], "k1 long, k2 long, word int")
    classes = spark.createDataFrame([(7, 7, 400, "hot")] + [(i, 1, 1, "cold") for i in range(40)], "k1 long, k2 long, n long, name string")
    got = pm.with_classes(rows.repartition(8), classes)
    assert sorted((r["k1"], r["word"], r["name"]) for r in got.collect()) == sorted([(7, i, "hot") for i in range(400)] + [(i, i, "cold") for i in range(40)])
    sizes = got.where("name = 'hot'").rdd.glom().map(len).collect()
    assert sum(sizes) == 400 and max(sizes) < 100


def test_removed_passages_leave_the_text(make, prose):
    run, before, after, end = prose(60), prose(40), prose(45), prose(8)
    docs = make([(1, f"{before} {run} {after}"), (2, f"x\n{after[::-1]} {run}\n{end}"), (3, "spam " * 200)])
    left = {r["doc_id"]: r["text"] for r in pm.without_repeats(docs).collect()}
    assert left[1] == f"{before} {run} {after}" and left[3].split() == ["spam"] * pm.UNIT
    assert left[2].startswith(f"x\n{after[::-1]} ") and left[2].endswith(f"\n{end}")
    rest = left[2].removeprefix(f"x\n{after[::-1]} ").removesuffix(f"\n{end}").split()
    assert len(rest) <= 60 - pm.UNIT  # what of the run lies outside its units stays


def test_units_do_not_depend_on_neighbours_or_pieces(prose, monkeypatch):
    texts = [prose(n).encode() for n in (34, 35, 400, 20, 90)]
    part, word, keys = pm.units(texts)
    for k, t in enumerate(texts):
        _, one_word, one_keys = pm.units([t])
        assert (word[part == k] == one_word).all() and (keys[part == k] == one_keys).all()
    whole = set(word[part == 2].tolist())
    assert len(whole) > 20 and max(np.diff(sorted(whole))) <= pm.SPAN and not (part == 0).any()
    for size in (20, 57, 200):
        monkeypatch.setattr(pm, "PIECE", size)
        cut = []
        for before, start, words in pm.pieces(texts[2].split()):
            cut += [w + before for w in pm.units([words])[1].tolist() if start <= w + before < start + size]
        assert len(cut) == len(set(cut)) and set(cut) == whole


def test_repeated_rows_have_their_passages_each(make, prose):
    run = prose(80)
    rows = [(1, f"{prose(60)} {run} {prose(9)}"), (2, f"{prose(30)} {run}"), (2, f"{prose(31)} {run}"), (5, f"{run} {prose(20)}")]
    got = pm.repeated_paragraphs(make([*rows, rows[3]])).collect()
    assert sorted((r["doc_id"], r["first_doc_id"], r["removed"]) for r in got if r["doc_id"] < 5) == [(1, 1, False), (2, 1, True), (2, 1, True)]
    # (5, ...) twice: its one line repeats whole, and holds the passage
    assert sorted((r["paragraph"], r["word"], r["words"], r["removed"]) for r in got if r["doc_id"] == 5) == [(0, 0, 100, False)] * 2
