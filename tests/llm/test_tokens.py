"""Token shards (operator 4) and transducer counts (operator 8) against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import ODD
from loglark.llm import token_counts as tc
from loglark.llm import token_output as to
from loglark.session import new_scratch

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SIGNS = [*"abcserTvtlmdé ß'  \n\t.,123٣²½   \x85\x1c\x0b中ñ😀<|>_-\"ΣİÇ", "'re", "'ll", "'s", " '", "<|endoftext|>", "  ", "\n\n",
         "<|startoftext|>", "ΑΣ", "I'm", "é"]


@given(st.lists(st.integers(0, 400), max_size=300))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(steps):
    values = np.cumsum(np.array(steps, np.int64) ** 2)
    coded = to.EliasFano.encode(values).to_bytes()
    back = to.EliasFano.from_bytes(coded)
    assert back.all().tolist() == values.tolist()
    assert [back.select(i) for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(0, 2000, 20_000))
    assert len(to.EliasFano.encode(values).to_bytes()) * 8 / len(values) < 2.2 + np.log2(values[-1] / len(values)) + 0.5
    with pytest.raises(ValueError):
        to.EliasFano.encode(np.array([2, 1]))


def test_encoder_equals_the_library():
    rnd, encoder, library = random.Random(5), to.TextEncoder(WORD), to.load_tokenizer(WORD)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode_all(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(to, "MEMO", 20)
    encoder, library = to.TextEncoder(WORD), to.load_tokenizer(WORD)
    for lo in range(0, 200, 10):
        texts = [f"word{i} the word{i - 15} again" for i in range(lo, lo + 10)]
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode_all(texts)] == [library.encode(t).ids for t in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_shards_read_back(spark, make, prose, path):
    rows = [(i * 3, prose(i % 40)) for i in range(60)] + [(7, prose(30_000)), *ODD]
    out = new_scratch(spark, "test-tokens")
    shards = to.write_shards(make(rows), out, path, 1, shard_text_bytes=20_000)
    back = to.read_shards(spark, out, shards).select("start", "doc_id", "n_tokens", "ids_crc32")
    got = sorted(map(tuple, back.collect()), key=lambda r: r[0])
    library, at = to.load_tokenizer(path), 0
    for (start, doc, n, crc), (want, text) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")), strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (start, doc, n, crc) == (at, want, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    file = spark.read.format("binaryFile").load(out).orderBy("path").first()["content"]
    shard = to.Shard(file)
    bounds = shard.bounds.all()
    assert all(shard.document(i).tolist() == shard.ids[bounds[i]:bounds[i + 1]].tolist() for i in range(shard.footer["n_docs"]))


def test_no_documents_no_shards(spark, make):
    assert to.encode_corpus(make([]), WORD, 1).collect() == []
    assert tc.token_counts(make([]), BYTE).collect() == []


def test_transducer_equals_the_library():
    rnd, machine, library = random.Random(9), tc.Transducer(BYTE), to.load_tokenizer(BYTE)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 500, " " * 300 + "x", "'" * 60 + "re", "\n" * 99 + "abc", "z" * 200 + "'re" + "z" * 100 + "'r", " " * 99 + "\na"]
    for t in texts:
        assert machine.count(t) == len(library.encode(t, add_special_tokens=False).ids), t


def test_table_is_bounded(monkeypatch, prose):
    monkeypatch.setattr(tc, "STATES", 50)
    machine, library = tc.Transducer(BYTE), to.load_tokenizer(BYTE)
    for _ in range(20):
        text = prose(30)
        assert machine.count(text) == len(library.encode(text).ids)
        assert len(machine.states) <= 50


def test_chunk_maps_compose(make, prose):
    library = to.load_tokenizer(BYTE)
    rows = [(1, prose(3000)), (2, "x" * 5000), (3, " " * 900 + "a<|endoftext|>b " * 90), (3, " " * 900 + "a<|endoftext|>b " * 90), (4, prose(5)), *ODD]
    got = sorted(map(tuple, tc.token_counts(make(rows), BYTE, chunk=64).collect()), key=repr)
    want = [(i, len((t or "").encode()), len(library.encode(t or "").ids), len(library.encode(t or "").ids) > 512) for i, t in rows]
    assert got == sorted(want, key=repr)


def test_a_shard_file_is_a_small_part_of_a_tasks_memory():
    """A file is read whole, in the JVM, in Arrow and in Python: pipeline, memory of an executor."""
    assert to.SHARD_TEXT_BYTES <= 8 << 20
