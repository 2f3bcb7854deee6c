"""Vectorised word and shingle hashing over batches of texts, for use inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | U64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_BYTES = _LOWER.tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[U64(1)], np.full(max(0, n - 1), U64(_BASE), U64)]).astype(U64), dtype=U64)


def spans(parts: list[bytes], table: bytes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words (runs of bytes other than ASCII white space) of ``parts``, which are translated by ``table`` and laid end to end.

    Returns the bytes, each word's first byte, the byte behind its last, its hash, and its part's number.
    """
    buf = b" ".join(parts)
    arr = np.frombuffer(buf.translate(table) if table else buf, np.uint8)
    space = _SPACE[arr]
    inside = ~space
    if not inside.any():
        return arr, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U64), np.empty(0, np.int64)
    first = inside.copy()
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(inside & np.append(space[1:], True)) + 1
    place = np.zeros(len(arr), np.int64)
    place[starts[0] :] = np.arange(starts[0], len(arr)) - np.repeat(starts, np.diff(np.append(starts, len(arr))))
    length = ends - starts
    powers = _powers(int(length.max()) + 1)
    place[space] = 0
    hashed = np.add.reduceat(_BYTE[arr] * powers[place], starts)
    begin = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    owner = np.searchsorted(begin, starts, "right") - 1
    return arr, starts, ends, mix(hashed ^ (length.astype(U64) * U64(0xD6E8FEB86659FD93))), owner


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word (runs of bytes other than ASCII white space, A-Z lower-cased) and its text's number."""
    *_, hashed, owner = spans([b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts], _LOWER_BYTES)
    return hashed, owner


def shingles(texts: list[str | None], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    A text of fewer words has its whole sequence as its one shingle; a null, empty or blank text has none.
    """
    h, owner = words(texts)
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), np.int64)
    at = np.concatenate([[0], np.cumsum(counts)])
    rolled = np.zeros(max(0, len(h) - width + 1), U64)
    for j in range(width):
        rolled += h[j : len(h) - width + 1 + j] * _PLACE[j]
    rolled = mix(rolled)
    out = []
    for k, n in enumerate(counts):
        lo = at[k]
        if n >= width:
            out.append(np.unique(rolled[lo : lo + n - width + 1]))
        elif n:
            out.append(mix(np.array([(h[lo : lo + n] * _PLACE[:n]).sum(dtype=U64) + U64(n)], U64)))
        else:
            out.append(np.empty(0, U64))
    return out


def slices(lengths: list[int], most: int = 1_000_000):
    """Consecutive ranges of items whose lengths add up to about ``most``; one long item is a range of its own."""
    lo = total = 0
    for k, n in enumerate(lengths):
        if k > lo and total + n > most:
            yield lo, k
            lo, total = k, 0
        total += n
    if lo < len(lengths):
        yield lo, len(lengths)


def short_batches(batches: Iterator[pa.RecordBatch], texts: Callable[[pa.RecordBatch], pa.Array] = lambda b: b.column(1), most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts add up to about ``most`` bytes, so that what a task makes of them at a time is bounded."""
    for batch in batches:
        for lo, hi in slices(pc.fill_null(pc.binary_length(texts(batch)), 0).to_pylist(), most):
            yield batch.slice(lo, hi - lo)


def forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``ids`` the smallest id it reaches over the links (i[k], j[k]) of positions."""
    order = np.argsort(ids, kind="stable")
    low = np.empty(len(ids), np.int64)
    low[order] = np.arange(len(ids))
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = np.minimum(new, new[order[new]])
        if (new == low).all():
            return ids[order[low]]
        low = new
