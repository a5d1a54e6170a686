"""Token-ID binary output with Elias-Fano document boundaries (operator 4).

Documents are dealt by ranges of doc_id and sorted, so shard k holds the k-th
range; each task streams its shard to one file.  A shard file is

    ids of all documents, one after the other (2 bytes each if the vocabulary
    fits, else 4; little-endian) | boundaries (Elias-Fano) | doc_ids
    (Elias-Fano, relative to the first) | JSON footer | footer length (4 bytes)
    | magic ``EFTOKENS``

The n+1 boundaries of n documents take about 2 + log2(ids/n) bits each instead
of 64.  ``EliasFano.select(i)`` finds one offset from 4-byte samples of the
upper bits, without decoding the others.

A file is written under a name of its own attempt and then renamed, so a
repeated task replaces it by the same bytes.  Files go where the caller says
(a URI that pyarrow.fs knows, such as file://, s3://, hdfs://).

Defined results: null text is empty; an empty document has only the end id;
rows with equal doc_id are all kept, ordered by text; rows without a doc_id
come first, in shard order; an empty table gives no shard; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path, PurePosixPath

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglark.llm.common import saved
from loglark.session import new_scratch

MAGIC = b"EFTOKENS"
SHARD_TEXT_BYTES = 8 << 20  # a file is read back whole, with copies in the JVM, in Arrow and in Python
MEMO = 500_000
SAMPLE_EVERY = 256


class EliasFano:
    """A non-decreasing sequence: the low bits of each value packed, the rest
    in unary; every 256th one bit of the unary part is indexed."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        if n and (np.diff(v.astype(np.int64)) < 0).any():
            raise ValueError("values must not fall")
        low_bits = max(0, ((top + 1) // n).bit_length() - 1) if n else 0
        low = ((v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        at = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        bits[at] = 1
        return cls(n, low_bits, np.packbits(low, bitorder="little"), np.packbits(bits, bitorder="little"),
                   at[::SAMPLE_EVERY].astype("<u4"))

    def _low(self, i: int, count: int) -> np.ndarray:
        b = self.low_bits
        first = i * b
        bits = np.unpackbits(self.low[first // 8:-(-(first + count * b) // 8)], bitorder="little")[first % 8:][:count * b]
        return bits.reshape(count, b).astype(np.int64) @ (1 << np.arange(b, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value (from 0), from the nearest sample at or before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE_EVERY])
        left, byte = i % SAMPLE_EVERY, at // 8
        window = np.unpackbits(self.high[byte:byte + 64], bitorder="little")
        window[:at % 8] = 0
        while True:
            ones = np.flatnonzero(window)
            if len(ones) > left:
                return ((byte * 8 + int(ones[left]) - i) << self.low_bits) | int(self._low(i, 1)[0])
            left, byte = left - len(ones), byte + len(window) // 8
            window = np.unpackbits(self.high[byte:byte + 64], bitorder="little")

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        return ((at - np.arange(self.n)) << self.low_bits) | self._low(0, self.n)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)], "<u8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, a, b, c = (int(x) for x in np.frombuffer(data, "<u8", 5))
        raw = np.frombuffer(data, np.uint8)
        return cls(n, low_bits, raw[40:40 + a], raw[40 + a:40 + a + b],
                   np.frombuffer(data, "<u4", c, 40 + a + b))


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class TextEncoder:
    """Whole texts to id bytes.  If the tokenizer drops white space it never
    joins across it: the library then encodes each distinct piece between ASCII
    white space (many in one call, set apart by a special token), a text is the
    concatenation of its pieces, and pieces are kept in a memo of two
    generations of bounded size.  Other tokenizers get whole texts."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_piece = any(p.get("behavior") == "Removed" and p.get("invert") for p in splits)
        self.mark = next((t["content"] for t in spec["added_tokens"] if t["special"]), None)
        self.mark_id = self.tokenizer.token_to_id(self.mark) if self.mark else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _learn(self, pieces: list[bytes]) -> None:
        unseen = []
        for p in pieces:
            known = self.old.get(p)
            if known is None:
                unseen.append(p)
            else:
                self.memo[p] = known
        odd = [p for p in unseen if self.mark is None or self.mark.encode() in p]
        for p in odd:
            self.memo[p] = self._ids(p.decode("utf-8")).tobytes()
        plain = [p for p in unseen if p not in self.memo]
        texts = [self.mark.join(p.decode("utf-8") for p in plain[lo:lo + 256]) for lo in range(0, len(plain), 256)]
        for k, e in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            raw, width, marks = ids.tobytes(), self.dtype.itemsize, np.flatnonzero(ids == self.mark_id)
            starts = [0, *((marks + 1) * width).tolist()]
            ends = [*(marks * width).tolist(), len(raw)]
            self.memo.update(zip(plain[k * 256:(k + 1) * 256], map(raw.__getitem__, map(slice, starts, ends)), strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return [self._ids(t).tobytes() for t in texts]
        cut = [t.encode("utf-8").split() for t in texts]
        if len(self.memo) > MEMO:
            self.memo, self.old = {}, self.memo
        memo = self.memo
        self._learn([p for p in set().union(*cut) if p not in memo])
        return [b"".join(map(self.memo.__getitem__, pieces)) for pieces in cut]


@lru_cache(maxsize=1)
def encoder_for(path: str) -> TextEncoder:
    """One encoder per Python worker: its memo serves all tasks of the worker."""
    return TextEncoder(path)


def _filesystem(uri: str):
    from pyarrow import fs
    uri = "file://" + uri if uri.startswith("/") else uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
    return fs.FileSystem.from_uri(uri)


def write_shards(docs: DataFrame, out: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_text_bytes: int = SHARD_TEXT_BYTES) -> DataFrame:
    """Write the shard files and return one row per shard: shard, file, n_docs, n_ids."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-size // shard_text_bytes))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        encoder, lengths, ids, sink, shard = encoder_for(tokenizer_path), [], [], None, TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            if sink is None:
                fs, base = _filesystem(out)
                fs.create_dir(base)
                name = f"shard-{shard:06d}.bin"
                draft = f"{base}/_{name}.{uuid.uuid4().hex}"
                sink = fs.open_output_stream(draft)
            for lo in range(0, len(batch), 256):
                for raw in encoder.encode_all(batch["text"].iloc[lo:lo + 256].tolist()):
                    lengths.append(len(raw) // encoder.dtype.itemsize + 1)
                    sink.write(raw + end)
            ids.append(batch["doc_id"])
        if sink is None:
            return
        ids = pd.concat(ids)
        named = ids.dropna().to_numpy(np.int64)
        bounds = EliasFano.encode(np.concatenate(([0], np.cumsum(lengths)))).to_bytes()
        first = int(named[0]) if len(named) else 0
        names = EliasFano.encode(named - first).to_bytes()
        footer = json.dumps({"width": encoder.dtype.itemsize, "n_docs": len(lengths), "n_ids": sum(lengths), "bounds": len(bounds),
                             "names": len(names), "unnamed": int(ids.isna().sum()), "first": first}).encode()
        sink.write(bounds + names + footer + len(footer).to_bytes(4, "little") + MAGIC)
        sink.close()
        fs.move(draft, f"{base}/{name}")
        yield pd.DataFrame({"shard": [shard], "file": [name], "n_docs": [len(lengths)], "n_ids": [sum(lengths)]})

    dealt = slim.repartitionByRange(int(shards), "doc_id").sortWithinPartitions("doc_id", "text")
    return saved(dealt.mapInPandas(write, "shard int, file string, n_docs long, n_ids long"), "token-shards")


class Shard:
    """A shard file's content: ``document(i)`` reads one document's ids."""

    def __init__(self, content: bytes):
        if content[-8:] != MAGIC:
            raise ValueError("not a token shard")
        n = int.from_bytes(content[-12:-8], "little")
        self.footer = json.loads(content[-12 - n:-12])
        self.dtype = np.dtype(f"<u{self.footer['width']}")
        at = self.footer["n_ids"] * self.dtype.itemsize
        self.ids = np.frombuffer(content, self.dtype, self.footer["n_ids"])
        self.bounds = EliasFano.from_bytes(content[at:at + self.footer["bounds"]])
        self.names = EliasFano.from_bytes(content[at + self.footer["bounds"]:][:self.footer["names"]])

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.footer["unnamed"] + (self.names.all() + self.footer["first"]).tolist()


def read_shards(spark: SparkSession, out: str, shards: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    starts, total = {}, 0
    for r in shards.orderBy("shard").collect():  # one row per shard file
        starts[r.file] = total
        total += r.n_ids

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                shard = Shard(content)
                bounds = shard.bounds.all()
                crc = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pd.DataFrame({"doc_id": pd.array(shard.doc_ids(), "Int64"), "start": bounds[:-1] + starts[PurePosixPath(path).name],
                                    "n_tokens": np.diff(bounds), "ids_crc32": np.array(crc, np.int64)})

    if not starts:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(out)
    return files.select("path", "content").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(docs: DataFrame, tokenizer_path: str, end_id: int, out: str | None = None) -> DataFrame:
    """Write ``docs`` as shard files (a fresh scratch folder unless ``out`` names one) and read them back."""
    spark = docs.sparkSession
    out = out or new_scratch(spark, "tokens")
    return read_shards(spark, out, write_shards(docs, out, tokenizer_path, end_id))
