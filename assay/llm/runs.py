"""Periodic runs of words by recursive frequency splitting, then a lag scan of what survives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from assay.llm.textkit import U64, mix, slices, spans

#: Lags below this are compared at every place; longer ones only where a block of words comes again.
_SHORT = 16

RUNS = "id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _split(h: np.ndarray, owner: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words in surviving segments, and each one's segment.

    A word of a run stands in it ``times`` times at least, so one that is rarer in its segment belongs to no run there
    and splits it. What is left of a segment is counted anew, until nothing more splits.
    """
    at, segment = np.arange(len(h)), owner
    while len(at):
        _, inverse, count = np.unique(mix(h[at] ^ mix(segment.astype(U64) + U64(1))), return_inverse=True, return_counts=True)
        keep = count[inverse] >= times
        kept, old = at[keep], segment[keep]
        if not len(kept):
            return kept, old
        new = np.cumsum(np.append(False, (np.diff(kept) != 1) | (np.diff(old) != 0)))
        long = np.bincount(new)[new] >= least
        kept, new = kept[long], new[long]
        if len(kept) == len(at):
            break
        at, segment = kept, new
    return at, segment


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the stretches of consecutive numbers in a sorted array."""
    cut = np.flatnonzero(np.diff(same) != 1)
    first = same[np.append(0, cut + 1)]
    return first, same[np.append(cut, len(same) - 1)] - first + 1


def _extent(x: np.ndarray, s: int, q: int) -> tuple[int, int]:
    """The stretch around place ``s`` in which words ``q`` apart are equal, as its first place and the one behind its last."""
    hi, step = s, 64
    while True:
        part = x[hi : min(hi + step, len(x) - q)] != x[hi + q : hi + q + step][: max(0, len(x) - q - hi)]
        if part.any() or not len(part):
            hi += int(part.argmax()) if len(part) else 0
            break
        hi, step = hi + len(part), step * 2
    lo, step = s, 64
    while lo:
        from_ = max(0, lo - step)
        part = (x[from_:lo] != x[from_ + q : lo + q])[::-1]
        if part.any():
            lo -= int(part.argmax())
            break
        lo, step = from_, step * 2
    return lo, hi


def lag_scan(x: np.ndarray, longest: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """Every run ``(start, length, period)`` of ``x``, whose segments (the longest has ``longest`` words) end in numbers that stand nowhere else.

    Short lags are compared at all places. Of the lags from w to 2w only those are scanned for which a block of w words at a
    multiple of w comes again that far behind: a run holds such a block whatever its start, so none is lost, and the work
    is n log n besides what is found. Blocks inside a run of a shorter period would only find it again and are passed over.
    """
    found: dict[tuple[int, int], int] = {}

    def note(start: int, stretch: int, q: int) -> None:
        if stretch + q >= max(least, times * q):
            found.setdefault((start, stretch + q), q)  # periods come in ascending order, so the first is the smallest

    for q in range(1, min(_SHORT, longest // times + 1)):
        same = np.flatnonzero(x[:-q] == x[q:])
        if len(same):
            first, length = _stretches(same)
            for k in np.flatnonzero(length >= max(least, times * q) - q):
                note(int(first[k]), int(length[k]), q)
    w, blocks = 1, mix(x.astype(np.int64).view(U64) + U64(0x9E3779B97F4A7C15))
    while w * times <= longest:
        if w >= _SHORT:
            _scan_blocks(x, blocks, w, times, found, note)
        blocks = mix(blocks[:-w] * U64(0x2545F4914F6CDD1D) + blocks[w:])
        w *= 2
    return [(s, n, q) for (s, n), q in found.items()]


def _scan_blocks(x: np.ndarray, blocks: np.ndarray, w: int, times: int, found: dict, note) -> None:
    anchors = len(x) // w
    padded = np.zeros((anchors + 2) * w, U64)
    padded[: len(blocks)] = blocks
    again = padded[w : (anchors + 1) * w].reshape(anchors, w) == padded[: anchors * w : w][:, None]
    again &= (padded[: anchors * w : w] != 0)[:, None]
    if times > 3:  # a stretch of three blocks' length holds two aligned ones in a row
        again[:-1] &= again[1:]
        again[-1] = False
    anchor, t = np.nonzero(again)
    if not len(anchor):
        return
    ends = np.zeros(anchors + 1, np.int64)
    for start, n in found:
        k = min(-(-start // w), anchors)
        ends[k] = max(ends[k], start + n)
    covered = np.maximum.accumulate(ends)[anchor]
    place, q = anchor * w, w + t
    fresh = place + q + w > covered
    place, q = place[fresh], q[fresh]
    order = np.lexsort((place, q))
    last_q, end = 0, 0
    for s, lag in zip(place[order].tolist(), q[order].tolist()):
        if lag == last_q and s < end:
            continue
        lo, hi = _extent(x, s, lag)
        last_q, end = lag, hi
        note(lo, hi - lo, lag)


def find_runs(texts: list[bytes], least: int = 6, times: int = 4) -> tuple[list[list[tuple[int, int, int]]], list[int], list[bytes]]:
    """Of each text its runs in order of start, then period; its number of words; and its words, joined by one space, without those that only repeat."""
    buf, starts, ends, h, owner = spans(texts)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    count = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(np.append(0, count))
    at, segment = _split(h, owner, least, times)
    if len(at):
        # hashes only decide what may be left out; survivors are told apart by their words
        data, seen = buf.tobytes(), {}
        ids = [seen.setdefault(data[a:b], len(seen)) for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        segment = np.cumsum(np.append(False, np.diff(segment) != 0))
        sizes = np.bincount(segment)
        x = -1 - np.arange(len(at) + len(sizes))
        x[np.arange(len(at)) + segment] = ids
        back = np.zeros(len(x), np.int64)
        back[np.arange(len(at)) + segment] = at
        for s, n, q in lag_scan(x, int(sizes.max()), least, times):
            word = int(back[s])
            runs[owner[word]].append((word - int(first[owner[word]]), n, q))
    out = []
    for k, text in enumerate(texts):
        kept = text.split()
        if runs[k]:
            runs[k].sort(key=lambda r: (r[0], r[2]))
            drop = np.zeros(len(kept) + 1, np.int64)
            for s, n, q in runs[k]:
                drop[s + q] += 1
                drop[s + n] -= 1
            drop = np.cumsum(drop)
            kept = [word for word, d in zip(kept, drop.tolist()) if not d]
        out.append(b" ".join(kept))
    return runs, count.tolist(), out


def _rows(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lo, hi in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 2_000_000):
            runs, n, kept = find_runs([t or b"" for t in texts[lo:hi].to_pylist()], least, times)
            found = pa.array([[{"start": s, "length": k, "period": q} for s, k, q in r] for r in runs], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(n, pa.int64()), found, pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 6, times: int = 4) -> DataFrame:
    """One row ``(id, n_words, runs, collapsed)`` per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with smallest period q, at least ``least`` and
    ``times`` times q words long, that no neighbouring word extends. ``runs`` lists all by start, then period. ``collapsed``
    joins by one space the words that no run holds after its first q words.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Texts of any length are read whole; one of n
    bytes takes about 60 n bytes of its task's memory, as it isn't cut. Repeated rows and null ids keep a row each; equal texts give equal
    values; other columns are ignored, and an empty table gives an empty result. Every row is judged by itself, without a shuffle.
    """
    if times < 3:
        raise ValueError("times below 3 aren't supported")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda it: _rows(it, least, times), RUNS)


def plant_repeats(docs: DataFrame) -> DataFrame:
    """``documents`` whose texts get a repeated tail where crc32 of the id, as text, is divisible by ten; other rows stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(h / 10)
    d = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    d = d.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), rest)), " ")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest, and digests of all runs and of the collapsed words, from what ``periodic_runs`` gives."""
    best = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"])).when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    longest = F.try_element_at(best, F.lit(1))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), longest["start"].alias("start"), longest["length"].alias("length"), longest["period"].alias("period"),
        F.floor(F.lit(1000) * longest["length"] / longest["period"]).cast("long").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


RUNS_SQL = r"""
WITH hashed AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) AS h
  FROM documents
), placed AS (
  SELECT *, len(w0) AS n, CASE WHEN h % 10 = 0 AND len(w0) > 0 THEN (h // 10) % len(w0) END AS a FROM hashed
), shaped AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed
), words AS (
  SELECT row_id, n, i, w0[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM shaped)
), equal_pairs AS (
  SELECT x.row_id, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.row_id = y.row_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT row_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row_id, q ORDER BY i) AS island FROM equal_pairs)
  GROUP BY row_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT row_id, start, length, min(q) AS period FROM stretches GROUP BY row_id, start, length
), listed AS (
  SELECT row_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS all_runs,
    first(struct_pack(s := start, l := length, p := period) ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY row_id
), kept AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words
  WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.row_id = words.row_id AND words.i >= runs.start + runs.period AND words.i < runs.start + runs.length)
  GROUP BY row_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.p::BIGINT AS period,
  (1000 * best.l // best.p)::BIGINT AS exponent_milli, sha256(coalesce(all_runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM hashed LEFT JOIN listed USING (row_id) LEFT JOIN kept USING (row_id)
"""
