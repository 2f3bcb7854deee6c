"""Token ids in fixed-width bit-packed blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from assay.llm.textkit import short_batches
from assay.llm.tokens import encoder

_BLOCKS = "shard int, block int, first_id long, last_id long, local_start long, n_ids long, bits int, doc_ids array<long>, counts array<long>, payload binary"

#: Shards up to which their starts (16 bytes each) travel to every task; beyond, they are joined by a shuffle.
_MOST_SHARDS = 1_000_000


def bits_for(vocab_size: int) -> int:
    """The fewest bits that hold every id below ``vocab_size``."""
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a little-endian bit stream of ``bits`` each, padded with zeros to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits(((ids[:, None].astype(np.uint32) >> np.arange(bits, dtype=np.uint32)) & 1).astype(np.uint8), bitorder="little").tobytes()


def unpack(payload: bytes | pa.Buffer, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from the ``start``-th on; only their own bytes are read."""
    lo = start * bits
    part = np.frombuffer(payload, np.uint8)[lo // 8 : -(-(lo + count * bits) // 8)]
    if bits in (8, 16, 32):
        return part.view(f"<u{bits // 8}").astype(np.uint32)
    stream = np.unpackbits(part, bitorder="little")[lo % 8 : lo % 8 + count * bits].reshape(count, bits)
    return (stream.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    enc, tail = encoder(path), np.array([end_id], "<u4").tobytes()
    bits = bits_for(max(enc.vocab_size, end_id + 1))
    docs: list[int | None] = []
    parts: list[bytes] = []
    shard = block = start = held = 0

    def flush() -> pa.RecordBatch:
        nonlocal block, start, held
        ids = np.frombuffer(b"".join(parts), "<u4")
        named = [d for d in docs if d is not None]
        row = {"shard": shard, "block": block, "first_id": min(named, default=None), "last_id": max(named, default=None), "local_start": start, "n_ids": len(ids), "bits": bits, "doc_ids": list(docs), "counts": [len(p) // 4 for p in parts], "payload": pack(ids, bits)}
        block, start, held = block + 1, start + len(ids), 0
        docs.clear()
        parts.clear()
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))

    for batch in short_batches(batches, lambda b: b.column(2)):
        shards = batch.column(0)
        for k, ids in enumerate(enc.encode(batch.column(2).to_pylist())):
            shard = shards[k].as_py()
            docs.append(batch.column(1)[k].as_py())
            parts.append(ids + tail)
            held += len(ids) // 4 + 1
            if held >= block_ids:
                yield flush()
    if docs:
        yield flush()


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 2, block_ids: int = 1 << 18, shards: int | None = None) -> DataFrame:
    """Encodes every text, appends ``end_id``, and writes the ids in ascending id order; returns the blocks read back.

    The format: Parquet rows in (shard, block) order, one per block of about ``block_ids`` ids (a document is
    never split), with the ids in ``payload`` at the fewest bits the vocabulary needs, the documents' ids and
    counts in order, and the block's place in its shard. First and last id of each block are plain columns, so a reader finds a
    document by pushed-down filters and unpacks only its slice. Null text is empty; null ids come first;
    rows of one id follow each other in order of a hash of their text; other columns are ignored; an empty table
    writes no blocks. Spark's committer writes the files, so a lost executor's tasks are done again.
    """
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("spot"))
    # by the text's hash where an id repeats, and by place among equal rows, which any number of shards may share
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("spot")]
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered = ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    blocks = ordered.mapInArrow(lambda it: _write(it, tokenizer_path, end_id, block_ids), _BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(path)
    return spark.read.schema(_BLOCKS).parquet(path)


def _read(batches: Iterator[pa.RecordBatch], keep_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            get = lambda c: batch.column(c)[row].as_py()
            counts = np.array(get("counts"), np.int64)
            at = np.cumsum(counts) - counts
            payload, bits = get("payload"), get("bits")
            data = unpack(payload, bits, 0, int(counts.sum())).astype("<u4").tobytes()
            parts = [data[4 * a : 4 * (a + c)] for a, c in zip(at.tolist(), counts.tolist())]
            cols = [batch.column("doc_ids")[row].values, pa.array(at + get("start")), pa.array(counts), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(parts if keep_ids else [None] * len(parts), pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def read_tokens(blocks: DataFrame, *, keep_ids: bool = True) -> DataFrame:
    """Rows ``(doc_id, start, n_tokens, ids_crc32, ids)`` of written blocks; ``start`` counts the ids of all documents before.

    The shards' starts come from one sum per shard; they are counted and, where they are few, sent to the tasks
    that read the blocks. Documents of null ids come first, repeated rows each have their own place, empty texts hold the end id
    alone, and no blocks give no rows.
    """
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = shards.select("shard", base.alias("base"))
    if shards.count() <= _MOST_SHARDS:
        starts = F.broadcast(starts)
    placed = blocks.join(starts, "shard").withColumn("start", F.col("base") + F.col("local_start"))
    placed = placed.select("doc_ids", "counts", "payload", "bits", "start")
    return placed.mapInArrow(lambda it: _read(it, keep_ids), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _find(batches: Iterator[pa.RecordBatch], doc_id: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, parts = [], []
        for row in range(len(batch)):
            get = lambda c: batch.column(c)[row]
            every = np.array(get("counts").values, np.int64)
            at = np.cumsum(every) - every
            mine = np.flatnonzero(np.array(get("doc_ids").values.fill_null(doc_id - 1)) == doc_id)
            for k in mine:
                counts.append(int(every[k]))
                parts.append(unpack(get("payload").as_buffer(), get("bits").as_py(), int(at[k]), int(every[k])).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(parts), pa.int64()), pa.array(counts, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(parts if keep_ids else [None] * len(parts), pa.binary())], ["doc_id", "n_tokens", "ids_crc32", "ids"])


def lookup(blocks: DataFrame, doc_id: int, *, keep_ids: bool = True) -> DataFrame:
    """Rows ``(doc_id, n_tokens, ids_crc32, ids)`` of one document by random access.

    Only blocks whose range holds the id are read, and of their payloads only the document's slice is unpacked. An id that
    isn't there gives no row, one that repeats a row each time; null ids can't be looked up.
    """
    one = blocks.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).select("doc_ids", "counts", "payload", "bits")
    return one.mapInArrow(lambda it: _find(it, doc_id, keep_ids), "doc_id long, n_tokens long, ids_crc32 long, ids binary")
