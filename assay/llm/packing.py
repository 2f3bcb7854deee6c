"""Packing token sequences by length patterns fitted with non-negative least squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from assay.llm.textkit import short_batches
from assay.llm.tokens import encoder
from assay.scratch import Scratch

#: Rows of a plan that are sent to every task, 5 MB.
_BROADCAST_ROWS = 100_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def _cut(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    enc, tail = encoder(path), np.array([end_id], "<u4").tobytes()
    for batch in short_batches(batches):
        at, piece, start, length, crc, data = [], [], [], [], [], []
        for k, ids in enumerate(enc.encode(batch.column(1).to_pylist())):
            ids += tail
            for p, lo in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[lo : lo + 4 * capacity]
                at.append(k)
                piece.append(p)
                start.append(lo // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                data.append(part if keep_ids else None)
        cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)], pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 1, capacity: int = 4096, keep_ids: bool = True) -> DataFrame:
    """Rows ``(doc_id, piece, start, length, ids_crc32, ids)``: every text's ids and the end id, cut where longer than ``capacity``.

    Null text counts as empty (one piece of the end id). ``ids`` holds little-endian unsigned 32-bit ids, or
    null with ``keep_ids=False``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _cut(it, tokenizer_path, end_id, capacity, keep_ids), _PIECES)


# ---- the plan: all of it on the histogram of lengths, at most ``capacity`` rows whatever the corpus


def patterns(bins: int, most: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Patterns that fill ``bins`` exactly: up to three parts, or up to ``most`` equal parts and a filler.

    Two arrays of shape (patterns, 3): part sizes (0: none) and how often each stands in the pattern.
    """
    size, times = [(bins, 0, 0)], [(1, 0, 0)]
    for a in range(1, bins):
        for b in range(1, min(a, bins - a) + 1):
            c = bins - a - b
            if c <= b:
                size.append((a, b, c))
                times.append((1, 1, int(c > 0)))
    for b in range(1, bins // 3 + 1):
        for m in range(3, min(most, bins // b) + 1):
            if (rest := bins - m * b) != b:
                size.append((b, rest, 0))
                times.append((m, int(rest > 0), 0))
    return np.array(size), np.array(times, float)


def fit_repeats(size: np.ndarray, times: np.ndarray, histogram: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Non-negative repeat counts x that minimise the squared error of the patterns' total against the histogram.

    Accelerated projected gradient; ``histogram[k]`` counts pieces of bin k (index 0 unused).
    """
    n = len(histogram)
    apply = lambda x: np.bincount(size.ravel(), (times * x[:, None]).ravel(), n)
    back = lambda r: (times * r[size]).sum(axis=1)
    x = np.ones(len(size))
    for _ in range(30):  # largest eigenvalue of the normal matrix, for the step
        y = apply(x)
        y[0] = 0
        x = back(y)
        top = np.linalg.norm(x)
        x /= top
    total = max(1.0, histogram.sum())
    h = histogram / total
    x, y, t = np.zeros(len(size)), np.zeros(len(size)), 1.0
    for _ in range(rounds):
        r = apply(y) - h
        r[0] = 0
        new = np.maximum(0, y - back(r) / (1.05 * top))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x * total


def plan_sequences(counts: dict[int, int], capacity: int = 4096, grain: int = 8) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups ``(sequences, [(length, times), ...])`` that hold every piece of the histogram once.

    Lengths are rounded up to ``grain`` for the patterns; fitted repeats are rounded down to what the
    histogram has; the exact lengths then fill the patterns. What is left goes best-fit into the room left,
    longest first, a length at a time.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    groups: list[list] = []  # [sequences, parts, room]
    if left[capacity]:
        groups.append([int(left[capacity]), [(capacity, 1)], 0])
        left[capacity] = 0
    bins = capacity // grain
    if grain > 1 and capacity % grain == 0 and left.any():
        by_bin = np.bincount((np.arange(capacity + 1) + grain - 1) // grain, left, bins + 1)
        size, times = patterns(bins)
        x = fit_repeats(size, times, by_bin)
        stock = by_bin.astype(np.int64)
        queue = {b: [[n, int(left[n])] for n in range(min(b * grain, capacity), (b - 1) * grain, -1) if left[n]] for b in range(1, bins + 1)}
        for p in np.argsort(-x, kind="stable"):
            need: dict[int, int] = {}
            for s, m in zip(size[p], times[p]):
                if m:
                    need[int(s)] = need.get(int(s), 0) + int(m)
            repeats = min(int(x[p] + 0.5), *(int(stock[s]) // m for s, m in need.items()))
            if repeats <= 0:
                continue
            for s, m in need.items():
                stock[s] -= repeats * m
            slots = [s for s, m in need.items() for _ in range(m)]
            # a run for each slot: (length, sequences) in order; cut where any of them changes
            runs = []
            for s in slots:
                run, want = [], repeats
                while want:
                    head = queue[s][0]
                    take = min(want, head[1])
                    run.append([head[0], take])
                    head[1] -= take
                    left[head[0]] -= take
                    want -= take
                    if not head[1]:
                        queue[s].pop(0)
                runs.append(run)
            while runs[0]:
                k = min(run[0][1] for run in runs)
                lengths = [run[0][0] for run in runs]
                groups.append([k, [(n, lengths.count(n)) for n in dict.fromkeys(lengths)], capacity - sum(lengths)])
                for run in runs:
                    run[0][1] -= k
                    if not run[0][1]:
                        run.pop(0)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    for g, (_, _, room) in enumerate(groups):
        if room:
            rooms[room].append(g)
    for length in range(capacity, 0, -1):
        n, room = int(left[length]), length
        while n:
            while room < capacity and not rooms[room]:
                room += 1
            if rooms[room]:
                g = rooms[room].pop()
            else:
                g = len(groups)
                groups.append([n, [], capacity])
            have, parts, space = groups[g]
            times = space // length
            full = min(have, n // times)
            if not full:
                full, times = 1, n
            if full < have and parts:
                groups.append([have - full, parts, space])
                rooms[space].append(len(groups) - 1)
            groups[g] = [full, [*parts, (length, times)], space - times * length]
            if groups[g][2]:
                rooms[groups[g][2]].append(g)
            n -= full * times
            room = length
    return [(k, parts) for k, parts, _ in groups]


def _placement(groups: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple]:
    """Rows (length, first, last, times, sequence, offset): pieces of a length numbered from first to last fill these sequences."""
    rows, used, sequence = [], {}, 0
    for k, parts in groups:
        offset = 0
        for length, times in parts:
            first = used.get(length, 0)
            used[length] = first + k * times
            rows.append((length, first, used[length] - 1, times, sequence, offset))
            offset += length * times
        sequence += k
    return rows


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 1, capacity: int = 4096, grain: int = 8, keep_ids: bool = True, scratch: Scratch | None = None
) -> DataFrame:
    """Every piece of ``token_pieces`` with its ``sequence_id`` and ``offset``; sequences are gapless from 0 and at most ``capacity`` long.

    Only the histogram of lengths (at most ``capacity`` rows) reaches the driver, and the plan that comes back
    has a few rows per length and pattern, so both stay the same for any corpus. Pieces of one length are
    interchangeable: they are numbered by a count per (length, salt) first, so a length that a third of all
    pieces share spreads over many groups, and take the plan's places in that order.
    Repeated rows and null ids are packed like any other; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "packing")
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, end_id=end_id, capacity=capacity, keep_ids=keep_ids)
    pieces = scratch.save(pieces if keep_ids else pieces.drop("ids"), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    rows = _placement(plan_sequences(histogram, capacity, grain))
    plan = spark.createDataFrame(rows, "length long, first long, last long, times long, sequence long, at long")

    salts = max(16, -(-max(histogram.values(), default=0) // 100_000))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("length", "salt", before.alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    numbered = salted.withColumn("number", number).join(counts, ["length", "salt"]).withColumn("number", F.col("number") + F.col("before"))
    if len(rows) <= _BROADCAST_ROWS:
        met, plan = F.lit(True), F.broadcast(plan)
    else:
        # a length that many pieces share meets its places in spans of numbers, not in one task
        met = F.col("n.span") == F.col("p.span")
        plan = plan.withColumn("span", F.explode(F.sequence(F.shiftright("first", 16), F.shiftright("last", 16))))
        numbered = numbered.withColumn("span", F.shiftright("number", 16))
    n, p = numbered.alias("n"), plan.alias("p")
    placed = n.join(p, (F.col("n.length") == F.col("p.length")) & met & F.col("n.number").between(F.col("p.first"), F.col("p.last")))
    step = F.col("n.number") - F.col("p.first")
    kept = [c for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids") if c in pieces.columns]
    return placed.select(
        *[F.col(f"n.{c}") for c in kept], (F.col("p.sequence") + F.floor(step / F.col("p.times"))).alias("sequence_id"), (F.col("p.at") + F.pmod(step, F.col("p.times")) * F.col("n.length")).alias("offset")
    )
