"""Phrase collocations by Toivonen's sampling: a sample proposes, full passes count exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from assay.llm.textkit import U64, mix, slices, spans
from assay.scratch import Scratch

_MOST = 4  # words of a phrase
_NEXT = U64(0x9E3779B97F4A7C15)
_CLEAR = ~U64(_MOST - 1)  # the last two bits of a key hold its number of words, less one
#: Lower-cases A-Z, makes every break between pieces a line feed and every gap between words a space.
_TABLE = bytearray(range(256))
_TABLE[65:91] = bytes(range(97, 123))
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = 10
_TABLE[9] = 32
_TABLE = bytes(_TABLE)
_SLICE, _ROWS = 1_500_000, 200_000
#: The longest bit table that tasks get to know phrases by, in bits: 32 MB, whatever the corpus.
_MOST_BITS = 1 << 28
_COUNTS, _KEYED = "lang string, phrase string, a long", "key long, a long"


@lru_cache(maxsize=4096)
def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Bits:
    """A set of phrase keys as a bit table of bounded size; what isn't in the set may seem to be, which only costs counting."""

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, U64(8 * len(table) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self.mask
        return (self.table[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 == 1


class _Grams:
    """The phrases of some texts: for each length the key at each place, and whether the words there are in one piece."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        arr, self.starts, self.ends, h, self.owner = spans(texts, _TABLE)
        self.arr, self.langs = arr, langs
        seeds = np.array([_seed(x) for x in langs], U64)
        n = len(h)
        key = mix(h + seeds[self.owner]) & _CLEAR if n else h
        apart = np.ones(n, bool)
        if n:
            line = np.cumsum(arr == 10, dtype=np.int32)
            apart[:-1] = (line[self.starts[1:]] != line[self.ends[:-1] - 1]) | (self.owner[1:] != self.owner[:-1])
        self.keys, self.whole = [key], [np.ones(n, bool)]
        for m in range(1, _MOST):
            k, w = self.keys[-1], self.whole[-1]
            self.keys.append(mix(k[:-1] * _NEXT + key[m:][: max(0, len(k) - 1)]) & _CLEAR | U64(m))
            self.whole.append(w[:-1] & ~apart[m - 1 : -1][: max(0, len(w) - 1)])

    def counts(self, m: int, chosen: np.ndarray) -> pa.RecordBatch:
        """The distinct keys of the phrases of ``m`` words at the chosen places, and how often each stands there."""
        keys = np.sort(self.keys[m - 1][chosen])
        first = _firsts(keys)
        return pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(np.diff(np.append(first, len(keys))))], ["key", "a"])

    def phrases(self, m: int, places: np.ndarray) -> pa.Array:
        """The words of each phrase, joined by one space."""
        if not hasattr(self, "text"):
            gap = (self.arr == 32) | (self.arr == 10)
            keep = ~gap
            keep[1:] |= ~gap[:-1]  # the first byte of each gap stays
            self.text = np.where(gap, np.uint8(32), self.arr)[keep]
            self.new = np.cumsum(keep) - 1
        a, b = self.new[self.starts[places]], self.new[self.ends[places + m - 1] - 1] + 1
        at = np.cumsum(np.append(0, b - a))
        data = self.text[np.repeat(a - at[:-1], b - a) + np.arange(at[-1])]
        return pa.StringArray.from_buffers(len(places), pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))

    def spelled(self, m: int, chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The same with the phrases themselves and their languages."""
        places = np.flatnonzero(chosen)
        keys = self.keys[m - 1][places]
        order = np.argsort(keys)
        first = _firsts(keys[order])
        places, count = places[order[first]], np.diff(np.append(first, len(keys)))
        langs = pa.array(self.langs, pa.string())
        for lo in range(0, len(places), _ROWS):
            here = places[lo : lo + _ROWS]
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(self.owner[here])), self.phrases(m, here), pa.array(count[lo : lo + _ROWS])], ["lang", "phrase", "a"])


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[_Grams]:
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1).cast(pa.binary())
        for lo, hi in slices(pc.binary_length(texts).to_pylist(), _SLICE):
            yield _Grams(texts[lo:hi].to_pylist(), langs[lo:hi].to_pylist())


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for g in _grams(batches):
        for m in range(1, _MOST):
            yield g.counts(m, g.whole[m - 1])


def _full_counts(batches: Iterator[pa.RecordBatch], proposed: Bits) -> Iterator[pa.RecordBatch]:
    """All words, and every longer phrase whose two parts of one word less are proposed: those proposed and the negative border."""
    for g in _grams(batches):
        known = None
        for m in range(1, _MOST + 1):
            yield g.counts(m, g.whole[m - 1] if m == 1 else g.whole[m - 1] & known[:-1] & known[1:])
            if m < _MOST:
                known = proposed.has(g.keys[m - 1]) & g.whole[m - 1]


def _spelled_counts(batches: Iterator[pa.RecordBatch], proposed: Bits, frequent: Bits, closed: bool) -> Iterator[pa.RecordBatch]:
    """The phrases that were counted and found frequent; unless all are, also those that no pass has counted and that may be frequent by all that is known of their parts.

    A row with an empty phrase counts the words of a language.
    """
    for g in _grams(batches):
        langs, number = np.unique(np.array(g.langs, object), return_inverse=True)
        total = np.bincount(number[g.owner], minlength=len(langs))
        yield pa.RecordBatch.from_arrays([pa.array(langs.tolist(), pa.string()), pa.array([""] * len(langs)), pa.array(total, pa.int64())], ["lang", "phrase", "a"])
        alive = known = None
        for m in range(1, _MOST + 1):
            whole = g.whole[m - 1]
            possible = whole if m == 1 else whole & alive[:-1] & alive[1:]
            counted = whole if m == 1 or closed else known[:-1] & known[1:]
            alive = possible & (~counted | frequent.has(g.keys[m - 1]))
            known = whole & proposed.has(g.keys[m - 1])
            yield from g.spelled(m, alive)


def _bits(keys: DataFrame) -> Bits:
    """The bit table of a column ``key``: sixteen bits a key up to the bound; each block of it is put together in a task of its own."""
    count = keys.count()
    bits = min(_MOST_BITS, 1 << max(16, (16 * count - 1).bit_length()))
    block = bits >> 8

    def build(key: tuple, part: pa.Table) -> pa.Table:
        table = np.zeros(block, bool)
        table[part.column("spot").to_numpy()] = True
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "data": [np.packbits(table, bitorder="little").tobytes()]})

    spot = F.col("key").bitwiseAND(F.lit(bits - 1))
    spots = keys.select(spot.alias("spot")).distinct().select(F.floor(F.col("spot") / block).cast("int").alias("block"), (F.col("spot") % block).cast("int").alias("spot"))
    table = np.zeros(bits // 8, np.uint8)
    for k, data in spots.groupBy("block").applyInArrow(build, "block int, data binary").collect():
        table[k * (block // 8) : (k + 1) * (block // 8)] = np.frombuffer(data, np.uint8)
    return Bits(table)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = 30, sample: int = 16, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """Every phrase of one to four words that stands ``least`` times or more in the texts of its language, and the number of words of each language.

    Rows ``(lang, phrase, a, m)`` with m words, and ``(lang, n)``. Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]``
    and split into words ``[^\\x20\\x09]+``; occurrences within a piece count, overlaps included. A null language is ``und``.

    About one document in ``sample``, drawn by a hash, proposes the phrases that stand in them as often as ``least`` asks of the sample (twice at
    the fewest). A full pass counts all words, the proposals and their negative border: longer phrases both of whose parts of one
    word less are proposed. It counts by 64-bit keys, summed before and after the shuffle. A last pass spells the phrases found frequent
    and counts them by their words. Where one of them hadn't been proposed, its extensions weren't all counted; then this pass also
    counts every phrase still open, of all lengths at once, so that none is left. Counts are exact for any sample.
    Tasks know phrases by bit tables of 32 MB at most.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "phrases")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).where("text != ''")
    drawn = rows.where(F.pmod(F.xxhash64("lang", "text"), F.lit(sample)) == 0).mapInArrow(_sample_counts, _KEYED)
    drawn = drawn.groupBy("key").agg(F.sum("a").alias("a")).where(F.col("a") >= max(2, least // sample)).select("key")
    drawn = scratch.save(drawn, "proposed")
    proposed = _bits(drawn)

    full = rows.mapInArrow(lambda it: _full_counts(it, proposed), _KEYED).groupBy("key").agg(F.sum("a").alias("a"))
    full = scratch.save(full.where(F.col("a") >= least).select("key"), "counted")
    frequent = _bits(full)

    def unproposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(U64)
            yield batch.filter(pa.array(~proposed.has(keys) & (keys & U64(_MOST - 1) < U64(_MOST - 1))))

    closed = full.mapInArrow(unproposed, "key long").isEmpty()
    spelled = rows.mapInArrow(lambda it: _spelled_counts(it, proposed, frequent, closed), _COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    spelled = scratch.save(spelled.where((F.col("a") >= least) | (F.col("phrase") == "")), "spelled")
    scratch.drop(drawn, full)
    found = spelled.where("phrase != ''").withColumn("m", F.size(F.split("phrase", " ")))
    return found, spelled.where("phrase = ''").select("lang", F.col("a").alias("n"))


def _inner(size: int) -> Column:
    """The phrases of ``size`` words inside a longer one, from its words w and their number m."""
    each = F.transform(F.sequence(F.lit(1), F.col("m") - size + 1), lambda i: F.array_join(F.slice("w", i, F.lit(size)), " "))
    return F.when(F.col("m") > size, each).otherwise(F.array().cast("array<string>"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = 30, absorb: int = 80, top: int | None = 2000, sample: int = 16, scratch: Scratch | None = None) -> DataFrame:
    """Rows ``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of two to four words (None: all).

    a counts the phrase. Cut after its first k words it scores floor(2000000 a / (l + r)), with l and r the counts of both parts; the
    lowest-scoring cut counts, the first of equals. A phrase goes if its words lie inside a longer frequent one that stands at
    least ``absorb`` percent as often. Order: score and a descending, then the phrase's bytes.

    Null and empty texts have no words; a null language is ``und``; texts of any length are read whole; repeated rows count each time;
    other columns are ignored, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "phrases")
    found, words = frequent_phrases(docs, text_col, lang_col, least=least, sample=sample, scratch=scratch)
    longer = found.where("m > 1").withColumn("w", F.split("phrase", " "))
    parts = F.concat(*[_inner(size) for size in range(2, _MOST)])
    beside = longer.where("m > 2").select("lang", F.explode(F.array_distinct(parts)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = longer.join(beside, ["lang", "phrase"], "left").where(F.coalesce(F.col("most").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(20,0)") * absorb, F.lit(True)))

    cuts = kept.select("lang", "phrase", "a", "m", "w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("right"))
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    score = F.expr("cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))").cast("long")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    best = best.select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    order = "ORDER BY score DESC, a DESC, phrase"
    if top is not None:
        # a language's rows meet in one place only after each shard has kept its own first ones
        shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
        best = best.withColumn("near", F.expr(f"row_number() OVER (PARTITION BY lang, pmod(xxhash64(phrase), {shards}) {order})")).where(F.col("near") <= top).drop("near")
    ranked = best.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})").cast("long"))
    ranked = ranked.where(F.col("rank") <= top) if top is not None else ranked
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, text FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS text
    FROM documents)
), spoken AS (
  SELECT lang, regexp_extract_all(text, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM spoken, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
), f AS (
  SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM spoken GROUP BY lang
), inner_parts AS (
  SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, string_split(phrase, ' ') AS w, a, size, unnest(range(1, m - size + 2)) AS i FROM f, (SELECT unnest([2, 3]) AS size) WHERE m > size)
  GROUP BY ALL
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS lhs, array_to_string(w[k + 1 :], ' ') AS rhs
  FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f LEFT JOIN inner_parts USING (lang, phrase)
        WHERE m > 1 AND (most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT))
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * cuts.a // (x.a + y.a))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lhs JOIN f y ON y.lang = cuts.lang AND y.phrase = rhs
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best JOIN totals USING (lang) QUALIFY rank <= 2000
"""
