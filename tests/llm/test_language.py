"""Language identification (operator 5): held-out accuracy and defined results."""

import base64
import math
import random

import numpy as np
from pyspark.sql import functions as F

from llm.helpers import ODD
from loglark.llm import language_id as li
from loglark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_documents_and_pages_of_the_tables(spark):
    got = QUERIES["op5_language"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert got["doc_id"].notna().sum() == len(docs) and got["page_id"].notna().sum() == spark.read.parquet(f"{SF}/pages.parquet").count()
    mine = got[got["doc_id"].notna()].set_index("doc_id")
    assert mine["accepted"].mean() > 0.99
    assert (mine["lang"] == docs.loc[mine.index, "lang"]).mean() > 0.98


def test_text_alone_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fit, held = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    model = li.fit(li.labelled(fit))
    bare = li.document_evidence(held).withColumn("declared", F.lit(None).cast("string")).withColumn("host", F.lit(None).cast("string"))
    got = li.identify(bare, model).toPandas().set_index("doc_id")
    want = held.toPandas().set_index("doc_id")
    assert (got["lang"] == want.loc[got.index, "lang"]).mean() > 0.97


def test_priors_and_posterior_match_a_plain_computation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120).cache()
    model = li.fit(li.labelled(docs))
    rows = li.document_evidence(docs).withColumn("suffix", F.when(F.col("doc_id") % 2 == 0, "com").otherwise("org"))
    rows = rows.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.substring("text", 1, 6)).otherwise(F.col("text")))
    got = {r["doc_id"]: (r["lang"], r["posterior"]) for r in li.identify(rows, model).collect()}
    data, n = rows.collect(), len(model.names)
    score = {r["doc_id"]: model.score(r["text"]) for r in data}
    ll = {i: s * min(g, li.FULL) for i, (s, g) in score.items()}
    p = {i: np.exp(x - x.max()) / np.exp(x - x.max()).sum() for i, x in ll.items()}
    base = (sum(p.values()) + 1) / (sum(map(sum, p.values())) + n)

    def smooth(parent, members):
        c = sum((p[i] for i in members), np.zeros(n))
        return (c + li.KAPPA * parent) / (c.sum() + li.KAPPA)

    said = sum(p.values())
    for r in data:
        suffix = smooth(base, [x["doc_id"] for x in data if x["suffix"] == r["suffix"]])
        host = smooth(suffix, [x["doc_id"] for x in data if (x["suffix"], x["host"]) == (r["suffix"], r["host"])])
        alike = sum(p[x["doc_id"]] for x in data if x["declared"] == r["declared"])
        total = ll[r["doc_id"]] + np.log(host) + np.log((alike + 1) / (said + n + 1))
        best = int(total.argmax())
        lang, posterior = got[r["doc_id"]]
        assert lang == model.names[best] and math.isclose(posterior, 1 / np.exp(total - total[best]).sum(), abs_tol=2e-6)


def test_odd_rows_and_empty_tables(spark, make, prose):
    rows = [(i, prose(40), "aa" if i % 2 else "bb", "h") for i in range(20)] + [(*o, "aa", None) for o in ODD]
    docs = make(rows)
    model = li.fit(li.labelled(docs))
    got = li.identify(li.document_evidence(docs), model).collect()
    assert len(got) == len(rows)
    assert all(not r["accepted"] for r in got if r["doc_id"] in (900, 901))
    kept = li.accepted_documents(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {900, 901} & set(ids) and set(range(20)) <= set(ids)
    assert li.fit(li.labelled(make([]))) is None and li.accepted_documents(make([])).collect() == []


def test_page_evidence(spark):
    pages = spark.createDataFrame([(1, "https://u@News.Example.fr:80/a?b", "<html class=x lang='fr-FR'><script>bad</script><p>oui</p>"),
                                   (2, None, None), (3, "nonsense", "<p>x</p>")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["suffix"], r["declared"], (r["text"] or "").split()) for r in li.page_evidence(pages).collect()}
    assert got == {1: ("news.example.fr", "fr", "fr", ["oui"]), 2: (None, None, None, []), 3: (None, None, None, ["x"])}


def test_short_texts_of_no_modelled_language_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model, rnd = li.fit(li.labelled(docs)), random.Random(8)
    short = [r["text"] for r in docs.where("length(text) between 3 and 350").select("text").collect()]
    numbers = [f"{t[:200]} {rnd.randrange(10 ** 9)} {rnd.randrange(3000)}-{rnd.randrange(12)}" for t in short if len(t) > 80]
    words = ("вчера мы долго шли через старый город потому что автобус не пришёл а дождь закончился только вечером "
             "когда открылись магазины").split()
    finnish = ("vanha kalastaja istui hiljaa veneessään eikä puhunut mitään kun myrsky lähestyi saarta jossa hänen "
               "perheensä oli asunut jo kymmeniä vuosia").split()
    kinds = {"clean": short, "numbers": numbers}
    cut = lambda make, least=60: [make()[:rnd.randint(least, 390)] for _ in range(150)]
    kinds["russian"] = cut(lambda: " ".join(rnd.choices(words, k=80)), 30)
    kinds["finnish"] = cut(lambda: " ".join(rnd.choices(finnish, k=80)), 160)
    kinds["chinese"] = cut(lambda: "".join(rnd.choices("他们昨天晚上在老城的小饭馆里吃面条聊了很久才回家", k=390)), 20)
    kinds["digits"] = cut(lambda: "".join(rnd.choices("0123456789 ", k=390)))
    kinds["base64"] = cut(lambda: base64.b64encode(rnd.randbytes(390)).decode())
    kinds["signs"] = cut(lambda: "".join(rnd.choices("!@#$%^&*()_+{}[]<>|~;:", k=390)))
    kinds["letters"] = cut(lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=390)))
    rows = [(k, t, None, None, None) for k, texts in kinds.items() for t in texts]
    got = li.identify(spark.createDataFrame(rows, "kind string, text string, declared string, host string, suffix string"), model)
    share = {r["kind"]: r["a"] for r in got.groupBy("kind").agg(F.avg(F.col("accepted").cast("int")).alias("a")).collect()}
    print(share)
    assert len(short) > 300 and share["clean"] > 0.99 and share["numbers"] > 0.99, share
    assert all(v < 0.05 for k, v in share.items() if k not in ("clean", "numbers")), share
