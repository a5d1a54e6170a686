"""The pipeline's stages on what each predecessor kept, and its effect on planted cases."""

import public_tokenizers

import corpus_pipeline
from loglark.llm import decontamination, mixing
from loglark.llm.token_output import load_tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        sizes.append(docs.count())
        if name == "near_duplicates":
            assert docs.select("doc_id").distinct().count() == sizes[-1]
            texts = [r["text"] for r in docs.collect()]
            assert len(set(texts)) == len(texts)
        if name == "decontamination":
            items = [b" ".join(decontamination.words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            kept = [b" ".join(decontamination.words(r["text"])) for r in docs.collect()]
            assert not any(i in t for i in items for t in kept)
            before = docs
        if name == "mixing":
            taken = mixing.mix_by_source(before).selectExpr("sum(taken div size)").where("true").first()[0]
            assert taken == sizes[-1]
            mixed = docs.select("doc_id", "text").collect()
        if name != "tokens":
            assert docs.columns == columns
    assert sizes[0] >= sizes[1] > sizes[2] >= sizes[3]
    library = load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], len(library.encode(r["text"]).ids) + 1) for r in mixed)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in docs.collect()) == want


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted((r["start"], r["n_tokens"]) for r in got.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:]))


def test_stages_keep_columns_of_any_name_and_every_document_of_an_id(spark, prose):
    """Names that the stages use themselves, a dot, a map; two texts under one id."""
    names = "doc_id long, text string, lang string, source string, _digest string, _first int, _again int, _id long, _key string, _gone int, " \
            "key int, doc string, row int, `a.b` string, m map<string,int>"
    texts = [prose(60) for _ in range(24)]
    rows = [(i // 2, texts[i], "en", "abc"[i % 3], f"d{i}", 1, 2, 3, "k", 4, 5, "doc", 6, f"dot {i}", {"x": i}) for i in range(24)]
    docs = spark.createDataFrame(rows + [(90, *rows[3][1:]), rows[5]], names)  # a copy under another id, a repeated row
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in kept.collect())
    assert got == sorted((i // 2, texts[i]) for i in range(24))
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.decontaminate, corpus_pipeline.mix_sources):
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns and out.schema == kept.schema
        back = out.collect()
        assert back or stage is corpus_pipeline.identify_language
        for r in back:
            i = texts.index(r.text)
            assert (r["_digest"], r["_id"], r["_key"], r["a.b"], r["m"], r["doc"]) == (f"d{i}", 3, "k", f"dot {i}", {"x": i}, "doc")
