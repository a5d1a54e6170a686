import random
import zlib

from llm.helpers import ODD
from loglark.llm.byte_shards import shard_documents, write_shards


def brute(rows, shards):
    """The rule over one sorted list: doc_id, checksum, size."""
    slim = sorted(((doc, zlib.crc32((text or "").encode()), len((text or "").encode()) + 1) for doc, text, *_ in rows),
                  key=lambda r: (r[0] is not None, r))
    whole, upto, slots, out = sum(r[2] for r in slim), 0, [0] * shards, []
    for doc, crc, size in slim:
        shard = (2 * upto + size) * shards // (2 * whole)
        out.append((doc, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        upto += size
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(3)
    rows = [(i, "é" * rnd.randint(0, 400)) for i in rnd.sample(range(5000), 400)]
    return rows + [(7, "hot id %d" % (i % 5)) for i in range(200)] + [(9999, "x" * 100_000)] + [(None, "no id")] * 3 + ODD


def test_matches_one_sorted_list(make):
    rows = corpus()
    for shards in (8, 3, 1):
        assert sorted(map(tuple, shard_documents(make(rows), shards).collect()), key=repr) == brute(rows, shards)


def test_sizes_are_near_equal_and_reruns_agree(make):
    rows = [(i, "t" * (i * 37 % 300)) for i in range(3000)]
    first, again = (sorted(map(tuple, shard_documents(make(rows)).collect())) for _ in range(2))
    assert first == again
    by = [sum(r[1] for r in first if r[4] == s) for s in range(8)]
    assert max(by) - min(by) <= 300 and sum(by) == sum(r[1] for r in first)


def test_one_row_larger_than_all_targets(make):
    got = shard_documents(make([(1, "a"), (2, "b" * 10_000), (3, "c")])).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == [(1, 0, 0), (2, 4, 0), (3, 7, 0)]


def test_empty_table_and_clashing_columns(spark, make):
    assert shard_documents(make([])).count() == 0
    docs = spark.createDataFrame([(i, "text %d" % i, i, "r", "a", 5, {"k": i}) for i in range(40)],
                                 "doc_id long, text string, run long, row string, `a.b` string, size long, m map<string,int>")
    got = shard_documents(docs, 4, ["text", "run", "row", "a.b", "size", "m"])
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "text", "run", "row", "a.b", "m"]
    assert all(r["text"] == f"text {r.doc_id}" and r["run"] == r.doc_id and r["a.b"] == "a" and r["m"] == {"k": r.doc_id} for r in got.collect())


def test_written_shards_hold_every_document(spark, make, tmp_path):
    rows = corpus()
    back = write_shards(make(rows), str(tmp_path / "shards"), 8)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == sorted(((d, t) for d, t, *_ in rows), key=repr)
    slots = [sorted(r.slot for r in back.where(f"shard = {s}").collect()) for s in range(8)]
    assert all(s == list(range(len(s))) for s in slots)
