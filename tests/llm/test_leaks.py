"""Decontamination by latent retrieval (operator 3)."""

import random

import numpy as np

from llm.helpers import ODD
from loglark.llm import decontamination as dc


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_lcs_matches_the_table_form():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.randint(0, 6) for _ in range(rnd.randint(0, 30))] for _ in range(2))
        assert dc.lcs(a, b) == plain_lcs(a, b)


def test_leaks_are_found_and_clean_documents_left(spark, make, prose):
    items = [(i, f"{prose(15)}. {prose(9)}?\n{prose(6)}.") for i in range(12)] + [(50, None), (51, ""), (52, "too short"), (None, prose(20))]
    rnd = random.Random(2)

    def paraphrase(text):  # every eighth word replaced, signs and case changed
        return " ".join("other" if k % 8 == 5 else w.upper() for k, w in enumerate(text.replace(".", ",").split()))

    rows, leaks = [(i, prose(rnd.randint(1, 400))) for i in range(60)], {}
    for i in range(12):
        rows.append((100 + i, f"{prose(rnd.randint(0, 200))} {items[i][1]} {prose(rnd.randint(0, 200))}"))
        rows.append((200 + i, f"{prose(150)} {paraphrase(items[i][1])} {prose(90)}"))
        leaks[100 + i] = leaks[200 + i] = [i]
    rows += [(300, items[0][1] + " " + prose(500) + " " + items[3][1]), (301, " ".join(prose(20) for _ in range(800)) + items[5][1]),
             (302, items[4][1].split("?")[0]), *ODD]  # the last leak lacks the answer
    leaks |= {300: [0, 3], 301: [5]}
    docs = make(rows)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, row string")
    got = {r["doc_id"]: r["items"] for r in dc.contaminated(docs, bench).collect()}
    assert got == leaks
    clean = dc.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted((i for i, _ in rows if i not in leaks), key=repr)


def test_empty_tables(spark, make, prose):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, prose(30))], "item_id long, text string")
    docs = make([(1, prose(30))])
    assert dc.contaminated(docs, none).collect() == [] and dc.clean_documents(docs, none).count() == 1
    assert dc.contaminated(make([]), some).collect() == [] and dc.clean_documents(make([]), some).count() == 0


def test_all_full_item_copies_of_the_tables_are_found(spark):
    from loglark.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    found = {(r["doc_id"], i) for r in QUERIES["op3_benchmark_leaks"](spark, sf).collect() for i in r["items"]}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [(r["item_id"], b" ".join(dc.words(r["text"]))) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = {(d["doc_id"], i) for d in docs for i, t in items if t in b" ".join(dc.words(d["text"]))}
    assert held and held <= found
    assert len(found) <= 1.1 * len(held)


def test_every_item_of_a_large_benchmark_is_searched(spark, make, prose, monkeypatch):
    """More items than TERMS over fewer words: none is dropped, whatever the block."""
    monkeypatch.setattr(dc, "TERMS", 900)
    monkeypatch.setattr(dc, "ITEMS", 400, raising=False)
    items = [(i, f"{prose(20)}.") for i in range(1000)]
    docs = make([(i, f"{prose(40)} {items[i][1]} {prose(40)}") for i in range(0, 1000, 5)] + [(5000, prose(60))])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in dc.contaminated(docs, bench).collect()}
    assert got == {i: [i] for i in range(0, 1000, 5)}


def test_recall_against_an_exhaustive_search_with_a_sampled_basis(spark, make, prose, monkeypatch):
    """Items copied with growing shares of changed words, against the same checks at every place of every
    document; the basis is fitted on a part of the passages only."""
    rnd = random.Random(5)
    items = [(i, f"{prose(rnd.randint(12, 40))}. {prose(6)}?") for i in range(40)]

    def changed(text, share):
        return " ".join(prose(1) if rnd.random() < share else w for w in text.split())

    rows = [(1000 * k + i, f"{prose(rnd.randint(0, 300))} {changed(t, 0.09 * k)} {prose(rnd.randint(0, 300))}") for k in range(5) for i, t in items]
    rows += [(9000 + i, prose(rnd.randint(1, 600))) for i in range(100)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = dc.Items(items)
    want = set()
    for d, text in rows:
        numbers = known.numbers(text)
        for k, i in enumerate(known.ids):
            if any(dc.leaks(known.tokens[k], known.answers[k], numbers, s) for s in range(0, len(numbers), dc.STEP)):
                want.add((d, i))
    monkeypatch.setattr(dc, "SAMPLE", 1000)
    got = {(r["doc_id"], i) for r in dc.contaminated(make(rows), bench).collect() for i in r["items"]}
    assert got <= want and len(want) > 120
    assert len(got) >= 0.9 * len(want)


def test_the_subspace_is_fitted_on_all_passages(make, prose, monkeypatch):
    """Against the same sketch from the whole passage matrix at once."""
    import numpy as np
    monkeypatch.setattr(dc, "SAMPLE", 20)
    monkeypatch.setattr(dc, "RANK", 8)
    items = [(i, prose(20)) for i in range(5)]
    known = dc.Items(items)
    n_terms = len(known.term)
    rows = [(i, f"{prose(120)} {items[i % 5][1]} {prose(40)}") for i in range(60)]
    passages = []
    for _, text in rows:
        numbers = known.numbers(text)
        for a in range(0, len(numbers), dc.SPAN):
            part = numbers[a:a + dc.SPAN]
            if (part >= 0).any():
                passages.append(np.bincount(part[part >= 0], minlength=n_terms))
    passages = np.array(passages)
    idf = (np.log((len(passages) + 1) / ((passages > 0).sum(axis=0) + 1)) + 1) ** 2

    def unit(counts):
        w = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
        return w / np.linalg.norm(w, axis=1, keepdims=True)

    a = unit(passages)
    mine = unit(np.array([np.bincount(t, minlength=n_terms) for t in known.tokens]))
    right = np.random.default_rng(17).standard_normal((n_terms, 16))
    z = a.T @ (a @ right) + dc.ITEM_WEIGHT * len(passages) / len(items) * mine.T @ (mine @ right)
    u = np.linalg.svd(z, full_matrices=False)[0][:, :8]
    slim = make(rows).selectExpr("doc_id", "doc_id as row", "text")
    bench = slim.sparkSession.createDataFrame(items, "item_id long, text string")
    got_idf, got = dc.latent_basis(dc.numbered(slim, known.term), known.term, [bench], len(items))
    assert np.allclose(got_idf, idf)
    assert np.allclose(got @ got.T, u @ u.T, atol=1e-3)


def test_blocks_hold_every_passage_once(prose):
    """Against passages cut one by one, for lengths around the borders and a text of several sections."""
    import numpy as np
    rnd = np.random.default_rng(3)
    texts = [(k, rnd.integers(-3, 40, n).clip(-1).astype(np.int32)) for k, n in enumerate([0, 1, 15, 16, 17, 31, 32, 33, 48, 49, 200, 40_000])]
    for step in (dc.SPAN, dc.STEP):
        got = {}
        for owner, n, row, term, count in dc.blocks(iter(texts), 40, step):
            assert sorted(set(row)) == list(range(n))
            for r, t, c in zip(row.tolist(), term.tolist(), count.tolist()):
                doc, _, start = owner(r)
                got.setdefault((doc, start), {})[t] = c
        want = {}
        for doc, numbers in texts:
            for a in range(0, max(1, len(numbers) - dc.SPAN + step), step):
                t, c = np.unique(numbers[a:a + dc.SPAN][numbers[a:a + dc.SPAN] >= 0], return_counts=True)
                if len(t):
                    want[doc, a] = dict(zip(t.tolist(), c.tolist()))
        assert got == want


def test_summed_rows_is_the_sparse_product():
    """Short groups step by step, groups of more than SPAN entries as products: F op3, CPU seconds a GB."""
    rng = np.random.default_rng(5)
    for lengths in ([1, 3, 32, 33, 500, 2], [40, 60], [1], [7] * 9):
        lengths = np.array(lengths)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        index, w = rng.integers(0, 50, lengths.sum()), rng.standard_normal(lengths.sum()).astype(np.float32)
        right = rng.standard_normal((50, 8)).astype(np.float32)
        plain = np.array([(w[a:a + n, None].astype(float) * right[index[a:a + n]]).sum(axis=0) for a, n in zip(starts, lengths, strict=True)])
        assert np.allclose(dc.summed_rows(starts, lengths, w, index, right), plain, atol=1e-3)


def test_leak_check_without_enough_words_leaves_its_marks_clean():
    mark = np.zeros(21, bool)
    item, doc = np.arange(10, dtype=np.int32), np.array([-1, 3, 4, -1, 12, 13] * 8, np.int32)
    assert dc.leaks(item, item[-3:], doc, 0, mark) == 0.0 and not mark.any()
    full = np.concatenate((doc, item, doc)).astype(np.int32)
    assert dc.leaks(item, item[-3:], full, len(doc), mark) == 1.0 and not mark.any()
