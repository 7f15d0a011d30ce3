"""Token ids in binary segments with Elias-Fano document boundaries.

A store is a Parquet folder with a row for each segment. Segments follow the ascending
document ids, a document lies in one segment, and a segment holds about
``SEGMENT_IDS`` ids (more if one document has more):

* ``shard``, ``segment``: place of the segment in the store's order;
* ``doc_ids``: ids of its documents; ``n_docs``, ``n_ids``: how many documents and ids;
* ``width``: bytes of an id; ``ids``: all ids in a row, little-endian;
* ``low_bits``, ``low``, ``high``, ``samples``: the end of each document among the ids,
  in Elias-Fano form. The low bits of each end are packed, its high part is unary in a
  bit vector, and ``samples`` holds the place of every 64th one of that vector. About
  2 + log2(ids per document) bits a document replace a table of 64-bit offsets.

``bases`` beside the segments holds how many ids come before each of them.

Defined results: a null or empty text has only the end id. Documents without an id come
first. Rows with the same id keep their own entry each, in the order of their texts.
Other columns are not stored. An empty table makes an empty store.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlens.llm.arrays import slices
from starlens.llm.encode import tokenizer_path, word_encoder
from starlens.session import scratch_path

END_ID = 0
SEGMENT_IDS = 1 << 20
SHARD_BYTES = 16_000_000
SAMPLE_EVERY = 64

SEGMENT = (
    "shard int, segment int, doc_ids array<long>, n_docs long, n_ids long, width int, ids binary, "
    "low_bits int, low binary, high binary, samples binary"
)


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing sequence of numbers from 0 to a bound."""

    size: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @staticmethod
    def of(values: np.ndarray, bound: int) -> EliasFano:
        n = len(values)
        bits = max(0, int(bound // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        lows = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[ones] = 1
        pack = lambda x: np.packbits(x, bitorder="little").tobytes()
        return EliasFano(
            n, bits, pack(lows.astype(np.uint8).ravel()), pack(unary), ones[::SAMPLE_EVERY].astype("<u4").tobytes()
        )

    def all(self) -> np.ndarray:
        unary = np.unpackbits(np.frombuffer(self.high, dtype=np.uint8), bitorder="little")
        high = np.flatnonzero(unary)[: self.size] - np.arange(self.size)
        return (high << self.low_bits) + self._lows(0, self.size)

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it and a few bytes after."""
        at = int(np.frombuffer(self.samples, dtype="<u4")[i // SAMPLE_EVERY])
        left = i % SAMPLE_EVERY
        byte, step = at // 8, 64
        seen = -int(np.unpackbits(np.frombuffer(self.high[byte : byte + 1], np.uint8), bitorder="little")[: at % 8].sum())
        while True:
            part = np.unpackbits(np.frombuffer(self.high[byte : byte + step], np.uint8), bitorder="little")
            ones = np.flatnonzero(part)
            if seen + len(ones) > left:
                place = byte * 8 + int(ones[left - seen])
                return ((place - i) << self.low_bits) + int(self._lows(i, i + 1)[0])
            seen, byte = seen + len(ones), byte + step

    def _lows(self, start: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - start, dtype=np.int64)
        first, last = start * self.low_bits, end * self.low_bits
        held = np.frombuffer(self.low[first // 8 : (last + 7) // 8], dtype=np.uint8)
        bits = np.unpackbits(held, bitorder="little")[first % 8 : first % 8 + last - first]
        return bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))


def _segment_row(shard: int, number: int, docs: list, sizes: list[int], ids: list[bytes], width: int) -> dict:
    ends = np.cumsum(sizes)
    coded = EliasFano.of(ends, int(ends[-1]))
    return {
        "shard": shard, "segment": number, "doc_ids": docs, "n_docs": len(docs), "n_ids": int(ends[-1]),
        "width": width, "ids": b"".join(ids), "low_bits": coded.low_bits, "low": coded.low, "high": coded.high,
        "samples": coded.samples,
    }


SEGMENT_TYPES = pa.schema(
    [("shard", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_docs", pa.int64()),
     ("n_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32()),
     ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary())]
)


def _to_segments(path: str):
    """Encode rows that come in order of their ids, and cut them into segments."""

    def run(batches):
        shard, number = TaskContext.get().partitionId(), 0
        encoder = word_encoder(path)
        size = encoder.kind.itemsize
        end = np.array([END_ID], dtype=encoder.kind).tobytes()
        docs, sizes, ids, held = [], [], [], 0

        def row():
            return pa.RecordBatch.from_pylist([_segment_row(shard, number, docs, sizes, ids, size)], SEGMENT_TYPES)

        for batch in slices(batches, "text"):
            encoded = encoder.batch(batch.column("text").to_pylist())
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                count = len(own) // size + 1
                if docs and held + count > SEGMENT_IDS:
                    yield row()
                    number += 1
                    docs, sizes, ids, held = [], [], [], 0
                docs.append(doc_id)
                sizes.append(count)
                ids.append(own + end)
                held += count
        if docs:
            yield row()

    return run


def write_store(documents: DataFrame, folder: str, path: str | None = None) -> None:
    """Encode all documents and write them to a store, in ascending order of their ids."""
    spark = documents.sparkSession
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    ordered = narrow.repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered.mapInArrow(_to_segments(path or tokenizer_path()), SEGMENT).write.parquet(f"{folder}/segments")
    sizes = spark.read.parquet(f"{folder}/segments").select("shard", "segment", "n_ids")
    # One row for each shard; the sum over them is the only step in one task.
    by_shard = sizes.groupBy("shard").agg(F.sum("n_ids").alias("in_shard"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    by_shard = by_shard.select("shard", F.coalesce(F.sum("in_shard").over(earlier), F.lit(0)).alias("before_shard"))
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(by_shard, "shard")
    bases.select("shard", "segment", (F.col("before_shard") + F.col("before")).alias("base")).write.parquet(
        f"{folder}/bases"
    )


def _to_documents(batches):
    for batch in batches:
        for s in batch.to_pylist():
            ends = EliasFano(s["n_docs"], s["low_bits"], s["low"], s["high"], s["samples"]).all()
            ids = np.frombuffer(s["ids"], dtype=f"<u{s['width']}")
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(s["doc_ids"], pa.int64()),
                    "start": pa.array(starts + s["base"], pa.int64()),
                    "n_tokens": pa.array(ends - starts, pa.int64()),
                    "ids_crc32": pa.array(
                        [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)],
                        pa.int64(),
                    ),
                }
            )


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and checksum of every document, decoded from the store."""
    segments = spark.read.parquet(f"{folder}/segments").drop("n_ids")
    bases = spark.read.parquet(f"{folder}/bases")
    joined = segments.join(bases, ["shard", "segment"])
    return joined.mapInArrow(_to_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Write the documents to a new store in the shared folder and read it back."""
    folder = scratch_path(spark, "token-store")
    write_store(documents, folder)
    return read_store(spark, folder)


def op4_token_store(spark, sf_dir: str) -> DataFrame:
    return store_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
