"""Media columns: bytes kept as FLAC streams, read back as PCM blocks and features."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from assay.llm import flac
from assay.llm.textkit import slices

#: Payload bytes coded at a time; a longer payload is coded by itself, in runs of frames.
_AT_ONCE = 1 << 21
#: Samples of a PCM block.
_PCM = 1 << 14


def pad(data: bytes) -> bytes:
    """Bytes 255 after the data, up to a positive multiple of the block."""
    return data + b"\xff" * (-len(data) % flac.BLOCK or (0 if data else flac.BLOCK))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        for lo, hi in slices(sizes, _AT_ONCE):
            media = flac.encode([pad(b or b"") for b in batch.column(1)[lo:hi].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sizes[lo:hi], pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])


def encode_media(rows: DataFrame, id_col: str = "doc_id", bytes_col: str = "payload") -> DataFrame:
    """Rows ``(id, n_bytes, media)``: each row's bytes (null: none), padded with 255 to whole blocks, as a FLAC stream of 8-bit samples.

    Repeated rows and null ids keep their rows; equal bytes give equal streams; an empty table gives an
    empty result; other columns are ignored. Text columns count as their UTF-8 bytes. A payload of any length is coded in runs of
    frames, so a task holds a few times its bytes.
    """
    source = rows.select(F.col(id_col).cast("long").alias("id"), F.col(bytes_col).cast("binary").alias("data"))
    return source.mapInArrow(_encode, "id long, n_bytes long, media binary")


def pcm_parts(samples: np.ndarray, size: int = _PCM) -> list[tuple[int, np.ndarray]]:
    """A stream's samples as blocks of ``size``, each with the offset of its first sample."""
    return [(lo, samples[lo : lo + size]) for lo in range(0, len(samples), size)]


def pcm_at(parts: list[tuple[int, np.ndarray]], offset: int, count: int) -> np.ndarray:
    """``count`` samples from ``offset`` on, from the blocks that hold them."""
    size = len(parts[0][1])
    held = parts[offset // size : -(-(offset + count) // size)]
    return np.concatenate([p for _, p in held])[offset - held[0][0] :][:count]


class Features:
    """Whole-number features of a stream's PCM blocks, taken in one after the other: count, mean, energy, zero crossings, peak, and mean step, per thousand where fractions."""

    def __init__(self):
        self.n = self.total = self.energy = self.crossings = self.peak = self.step = 0
        self.last: list[int] = []

    def add(self, block: np.ndarray) -> None:
        x = np.concatenate([np.array(self.last, np.int64), block.astype(np.int64)])
        self.crossings += int(((x[1:] < 0) != (x[:-1] < 0)).sum())
        self.step += int(np.abs(np.diff(x)).sum())
        x = x[len(self.last) :]
        self.n, self.total, self.energy, self.peak = self.n + len(x), self.total + int(x.sum()), self.energy + int((x * x).sum()), max(self.peak, int(np.abs(x).max(initial=0)))
        self.last = [int(x[-1])]

    def __str__(self) -> str:
        m = max(1, self.n)
        return f"samples={self.n};mean={self.total * 1000 // m};energy={self.energy // m};crossings={self.crossings};peak={self.peak};step={self.step * 1000 // m}"


def features(parts: list[tuple[int, np.ndarray]]) -> str:
    """``Features`` of blocks with their offsets."""
    out = Features()
    for _, block in parts:
        out.add(block)
    return str(out)


def _streams(batches: Iterator[pa.RecordBatch]):
    """Runs of rows, each with its stream and the runs of samples decoded from it: one for a short stream, many for a long one."""
    for batch in batches:
        column = batch.column("media")
        for lo, hi in slices(pc.binary_length(column).to_pylist(), _AT_ONCE):
            media = column[lo:hi].to_pylist()
            if hi - lo == 1 and len(media[0]) > _AT_ONCE:
                yield batch.slice(lo, 1), media, [flac.decode_runs(media[0])]
            else:
                yield batch.slice(lo, hi - lo), media, [[s] for s in flac.decode(media)]


def _blocks_of(runs: Iterator[np.ndarray], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Runs of samples as blocks of ``size``, each with the offset of its first sample; a block may join two runs."""
    rest, at = np.empty(0, np.int8), 0
    for samples in runs:
        rest = np.concatenate([rest, samples]) if len(rest) else samples
        whole = len(rest) - len(rest) % size
        yield from ((at + lo, part) for lo, part in pcm_parts(rest[:whole], size))
        rest, at = rest[whole:], at + whole
    yield from ((at + lo, part) for lo, part in pcm_parts(rest, size))


def _payload(pcm: np.ndarray) -> bytes:
    return (pcm.view(np.uint8) ^ 0x80).tobytes()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, media, streams in _streams(batches):
        out = []
        for runs in streams:
            digest, feature, tail = hashlib.sha256(), Features(), b""
            for _, pcm in _blocks_of(runs, _PCM):
                data = _payload(pcm)
                digest.update(data)
                feature.add(pcm)
                tail = (tail + data[-32:])[-32:]
            out.append((feature.n, digest.hexdigest(), zlib.crc32(tail), str(feature)))
        n, digests, tails, found = zip(*out)
        cols = [
            *part.select(["id", "n_bytes"]).columns, pa.array(n, pa.int64()), pa.array(digests), pa.array(tails, pa.int64()), pa.array([len(m) for m in media], pa.int64()),
            pa.array([hashlib.sha256(m).hexdigest() for m in media]), pa.array(found),
        ]
        yield pa.RecordBatch.from_arrays(cols, ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def describe_media(media: DataFrame) -> DataFrame:
    """Decodes every stream of ``encode_media`` into PCM blocks and returns digests of payload and stream and the features of the blocks.

    A stream with a wrong header, frame checksum, sample count or MD5 raises an error that names what is wrong.
    Samples that look like a frame header do no harm; streams of any length are read whole, long ones in runs between their seek points. Repeated rows
    and null ids keep their rows; an empty table gives an empty result; other columns are ignored.
    """
    return media.select("id", "n_bytes", "media").mapInArrow(_describe, "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for part, _, streams in _streams(batches):
        rows, held = [], 0
        for key, runs in zip(part.column("id").to_pylist(), streams):
            for lo, pcm in _blocks_of(runs, size):
                rows.append((key, lo, pcm))
                held += len(pcm)
                if held >= _AT_ONCE:
                    yield _pcm_rows(rows)
                    rows, held = [], 0
        yield _pcm_rows(rows)


def _pcm_rows(rows: list[tuple[int | None, int, np.ndarray]]) -> pa.RecordBatch:
    ids, at, pcm = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int64()), pa.array([len(p) for p in pcm], pa.int32()), pa.array([p.tobytes() for p in pcm], pa.binary())], ["id", "sample_offset", "n_samples", "pcm"])


_PCM_ROWS = "id long, sample_offset long, n_samples int, pcm binary"


def pcm_blocks(media: DataFrame, samples_per_block: int = _PCM) -> DataFrame:
    """Rows ``(id, sample_offset, n_samples, pcm)``: decoded signed 8-bit samples in blocks, to be written and sought by offset.

    Every stream gives its blocks, repeated rows and null ids too; an empty table gives an empty result.
    """
    return media.select("id", "media").mapInArrow(lambda it: _blocks(it, samples_per_block), _PCM_ROWS)


def _sought(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, offsets, media = (batch.column(k).to_pylist() for k in range(3))
        for lo, hi in slices([len(m) for m in media], _AT_ONCE):
            got = flac.read_samples(media[lo:hi], offsets[lo:hi], [count] * (hi - lo))
            yield _pcm_rows(list(zip(ids[lo:hi], offsets[lo:hi], got)))


def samples_at(media: DataFrame, offset: Column | int, count: int) -> DataFrame:
    """Rows ``(id, sample_offset, n_samples, pcm)``: ``count`` samples of each stream from ``offset`` (null: 0) on, fewer where it ends.

    Random access: the streams' seek tables lead to the frames that are decoded, and no other is.
    """
    offset = offset if isinstance(offset, Column) else F.lit(offset)
    return media.select("id", F.greatest(F.lit(0), F.coalesce(offset.cast("long"), F.lit(0))).alias("at"), "media").mapInArrow(lambda it: _sought(it, count), _PCM_ROWS)
