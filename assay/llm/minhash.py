"""Near-duplicate groups of texts by MinHash with tensored banding.

Two small collections of ``groups`` hash values each (every value drawn from ``half`` minhashes) are
formed per text; every pair of one value from each collection is a table key. So ``groups ** 2`` tables of
``2 * half`` minhashes cost ``2 * groups * half`` minhashes instead of ``2 * half * groups ** 2``. At a
similarity of 0.8 the defaults miss a pair with probability 0.0004; at 0.85, 0.00002. Candidates are
confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from assay.llm.textkit import U64, forest, mix, shingles, short_batches, slices
from assay.operators.components import connected_components
from assay.scratch import Scratch

#: Longs of a sketch, of 16 nibbles each; every minhash gives a nibble.
_SKETCH = 5
#: Agreeing share of a sketch's nibbles below which a pair isn't confirmed: at similarity 0.8 a pair has 58.5
#: of 72 expected with a deviation of 3.3, so this is 6 deviations down.
_LEAST_NIBBLES = 38 / 72
#: Documents of a tile where members of one family are compared with each other.
_TILE = 256
#: Shingles of such a tile on average, so that tiles of long documents hold fewer of them.
_TILE_ITEMS = 1 << 20
#: Of one class in so many the keys are counted, and a key with so many of them belongs to a large bucket; of those the largest, no more than this.
_SAMPLE, _HOT, _MOST_HOT = 64, 32, 100_000


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in short_batches(batches):
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for lo, hi in slices([len(t or "") for t in texts]):
            sets = shingles(texts[lo:hi], width)
            flat = np.concatenate(sets).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "items"])


def _signatures(batches: Iterator[pa.RecordBatch], width: int, groups: int, half: int) -> Iterator[pa.RecordBatch]:
    n_hash = 2 * groups * half
    factors = np.random.default_rng(1913).integers(1, 2**63, n_hash, dtype=np.uint64) * U64(2) + U64(1)
    lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel().view(np.int64)))
    for batch in short_batches(batches):
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        for lo, hi in slices([len(t or "") for t in texts]):
            sets = shingles(texts[lo:hi], width)
            size = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(size)
            keys = np.zeros((hi - lo, 2 * groups), U64)
            sketch = np.zeros((hi - lo, _SKETCH), U64)
            c1, c2 = np.zeros(hi - lo, U64), np.zeros(hi - lo, U64)
            if len(full):
                flat = np.concatenate(sets)
                at = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                least = np.stack([np.minimum.reduceat(flat * f, at) for f in factors], axis=1)
                mixed = mix(least + np.arange(n_hash, dtype=np.uint64))
                keys[full] = mix(mixed.reshape(len(full), 2 * groups, half).sum(axis=2, dtype=U64) + np.arange(2 * groups, dtype=np.uint64) * U64(0x632BE59BD9B4E019))
                for j in range(n_hash):
                    sketch[full, j % _SKETCH] |= (mixed[:, j] & U64(15)) << U64(4 * (j // _SKETCH % 16))
                c1[full] = np.add.reduceat(mix(flat), at)
                c2[full] = np.add.reduceat(mix(flat ^ U64(0xA5A5A5A55A5A5A5A)), at)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(size), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)), lists(keys[:, :groups]), lists(keys[:, groups:]), lists(sketch)],
                ["id", "n", "c1", "c2", "left", "right", "sketch"],
            )


def _agreeing(a: list[Column], b: list[Column], n_hash: int) -> Column:
    """How many of the sketches' nibbles are equal."""
    total = F.lit(0)
    for x, y in zip(a, b):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftright(d, 1)).bitwiseOR(F.shiftright(d, 2)).bitwiseOR(F.shiftright(d, 3))
        total = total + F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(n_hash) - total


def _close(similarity: float, n_hash: int) -> Column:
    """What a pair ``ka``, ``kb`` at or above ``similarity`` satisfies, by set sizes surely and by sketches almost surely."""
    na, nb = F.col("ka.n"), F.col("kb.n")
    sizes = F.least(na, nb) * 100 >= F.greatest(na, nb) * round(100 * similarity)
    return sizes & (_agreeing([F.col(f"ka.s{k}") for k in range(_SKETCH)], [F.col(f"kb.s{k}") for k in range(_SKETCH)], n_hash) >= F.lit(int(_LEAST_NIBBLES * n_hash)))


def _intersect(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Links between two tiles of documents of different components, as edges to the smallest id linked within the tiles."""
    for batch in batches:
        for row in range(len(batch)):
            (ids, parts, flat, owner), (ids2, parts2, flat2, owner2) = (_tile(batch.column(c)[row].values) for c in (0, 1))
            n, n2 = len(ids), len(ids2)
            values, codes = np.unique(np.concatenate([flat, flat2]), return_inverse=True)
            mine, theirs = codes[: len(flat)], codes[len(flat) :]
            by_code = np.argsort(theirs, kind="stable")
            count = np.bincount(theirs, minlength=len(values))
            first = np.cumsum(count) - count
            common = np.zeros(n * n2, np.int64)
            size, size2 = np.bincount(owner, minlength=n), np.bincount(owner2, minlength=n2)
            bounds = np.concatenate([[0], np.cumsum(size)])
            for lo, hi in slices(np.bincount(owner, count[mine], n).astype(int).tolist(), 4_000_000):
                c = mine[bounds[lo] : bounds[hi]]
                times = count[c]
                at = np.repeat(first[c] - np.cumsum(times) + times, times) + np.arange(times.sum())
                pair = np.repeat(owner[bounds[lo] : bounds[hi]], times) * n2 + owner2[by_code[at]]
                common += np.bincount(pair, minlength=n * n2)
            common = common.reshape(n, n2)
            linked = (common * 100 >= (size[:, None] + size2[None] - common) * round(100 * similarity)) & (parts[:, None] != parts2[None])
            i, j = np.nonzero(linked)
            every = np.concatenate([ids, ids2])
            low = forest(every, i, j + n)
            at = np.flatnonzero(low != every)
            yield pa.RecordBatch.from_arrays([pa.array(low[at]), pa.array(every[at])], ["a", "b"])


def _near(batches: Iterator[pa.RecordBatch], similarity: float, n_hash: int) -> Iterator[pa.RecordBatch]:
    """Close pairs of two tiles of bucket mates, one of them at least not close to the bucket's lead: of every member the smallest it is close to, and what joins all that closeness joins."""
    for batch in batches:
        for row in range(len(batch)):
            (ids, n, rest, sketch), (ids2, n2, rest2, sketch2) = (_mates(batch.column(c)[row].values) for c in (0, 1))
            apart = np.zeros((len(ids), len(ids2)), np.int64)
            for k in range(_SKETCH):
                d = sketch[:, k, None] ^ sketch2[None, :, k]
                d |= d >> U64(1)
                d |= d >> U64(2)
                apart += np.bitwise_count(d & U64(0x1111111111111111))
            sizes = np.minimum(n[:, None], n2[None]) * 100 >= np.maximum(n[:, None], n2[None]) * round(100 * similarity)
            near = sizes & (n_hash - apart >= int(_LEAST_NIBBLES * n_hash)) & (rest[:, None] | rest2[None]) & (ids[:, None] != ids2[None])
            i, j = np.nonzero(near)
            if not len(i):
                continue
            every, at = np.unique(np.concatenate([ids, ids2]), return_inverse=True)
            x, y = at[: len(ids)][i], at[len(ids) :][j]
            first = np.arange(len(every))
            np.minimum.at(first, x, y)
            np.minimum.at(first, y, x)
            low = np.searchsorted(every, forest(every, x, y))
            edges = np.unique(np.concatenate([np.stack([e, np.arange(len(every))], axis=1) for e in (first, low)]), axis=0)
            edges = edges[edges[:, 0] != edges[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(every[edges[:, 0]]), pa.array(every[edges[:, 1]])], ["a", "b"])


def _mates(docs: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, set sizes, whether apart from the lead, and sketches."""
    sketch = np.stack([np.array(docs.field(3 + k)) for k in range(_SKETCH)], axis=1).view(U64)
    return np.array(docs.field(0)), np.array(docs.field(1)), docs.field(2).to_numpy(zero_copy_only=False), sketch


def _mixed_buckets(mates: DataFrame, far: DataFrame, known: DataFrame, similarity: float, n_hash: int, scratch: Scratch) -> DataFrame:
    """Edges ``(a, b)`` that hold together all close pairs of bucket mates of which one at least is ``far`` from the bucket's lead.

    Only members of ``mates(key, id, lead)`` that aren't the lead are there. Buckets of equal members are compared once. Members
    go by set size into bands, so that only equal and adjacent bands can hold pairs, and bands into tiles of bounded size.
    """
    rest = F.col("far").isNotNull()
    flagged = mates.join(far.withColumn("far", F.lit(True)), ["lead", "id"], "left").select("key", "id", rest.alias("rest"))
    h = F.xxhash64("id", "rest")
    buckets = flagged.groupBy("key").agg(F.count("*").alias("m"), F.count_if("rest").alias("m_rest"), F.bit_xor(h).alias("x1"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("x2"))
    buckets = buckets.where("m > 1 and m_rest > 0").groupBy("m", "x1", "x2").agg(F.min("key").alias("key"))
    band = F.floor(F.log(F.col("n")) / F.lit(max(0.01, 1.001 * float(np.log(1 / similarity))))).alias("band")
    held = flagged.join(buckets.select("key"), "key").join(known, "id").withColumn("band", band)
    held = scratch.save(held, "mixed", compression="lz4")
    tiles = held.groupBy("key", "band", "rest").agg(F.ceil(F.count("*") / _TILE).alias("tiles"))
    docs = F.collect_list(F.struct("id", "n", "rest", *[f"s{k}" for k in range(_SKETCH)]))
    tiled = held.join(tiles, ["key", "band", "rest"]).groupBy("key", "band", "rest", F.pmod(F.xxhash64("id"), "tiles").alias("tile")).agg(docs.alias("docs"))
    tiled = scratch.save(tiled, "mixed_tiles", compression="lz4")
    scratch.drop(held)
    p, q = tiled.where("rest").alias("p"), tiled.alias("q")
    once = F.expr("not q.rest or p.band < q.band or (p.band = q.band and p.tile <= q.tile)")
    work = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.abs(F.col("p.band") - F.col("q.band")) <= 1) & once).select(F.col("p.docs").alias("x"), F.col("q.docs").alias("y"))
    return work.mapInArrow(lambda it: _near(it, similarity, n_hash), "a long, b long").distinct()


def _tile(docs: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, components, all items and the position of the document that each item belongs to."""
    ids, parts, items = (docs.field(k) for k in range(3))
    lengths = np.array(pa.compute.list_value_length(items))
    return np.array(ids), np.array(parts), np.array(items.flatten()), np.repeat(np.arange(len(ids)), lengths)


def _table_keys(classes: DataFrame) -> DataFrame:
    """Rows ``(key, id)``: a class's key in each table, of one value from each collection."""
    left = classes.select("id", F.posexplode("left").alias("i", "x"), "right")
    return left.select("id", "i", "x", F.posexplode("right").alias("j", "y")).select(F.xxhash64("i", "x", "j", "y").alias("key"), "id")


def _bucket_mates(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows ``(key, id, lead)``: each class of a bucket with the smallest of the bucket, which leads it.

    Buckets that a sample of the classes shows to be large, at most ``_MOST_HOT``, never meet in one task: their leads are
    minima that combine before the shuffle and travel to the rows. All others are sorted by key. The sample decides the way, not the result.
    """
    keys = _table_keys(classes)
    seen = _table_keys(classes.where(F.pmod(F.xxhash64("id"), F.lit(_SAMPLE)) == 0)).groupBy("key").count().where(F.col("count") >= _HOT)
    hot = scratch.save(seen.orderBy(F.desc("count"), "key").limit(_MOST_HOT).select("key"), "hot")
    if hot.isEmpty():
        small, large = keys, None
    else:
        small, large = keys.join(F.broadcast(hot), "key", "left_anti"), keys.join(F.broadcast(hot), "key", "left_semi")
    mates = small.select("key", "id", F.min("id").over(Window.partitionBy("key")).alias("lead")).where("id != lead")
    if large is None:
        return mates
    leads = scratch.save(large.groupBy("key").agg(F.min("id").alias("lead")), "leads")
    return mates.unionByName(large.join(F.broadcast(leads), "key").where("id != lead").select("key", "id", "lead"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, similarity: float = 0.8, groups: int = 12, half: int = 3, scratch: Scratch | None = None
) -> DataFrame:
    """One row ``(id, n_shingles, component_id, kept)`` per row of ``docs``.

    Words are runs of characters other than ASCII white space with A-Z lower-cased; a text's set holds its
    distinct shingles of ``width`` words, or its whole sequence where it has fewer words. Texts with
    100 * intersection >= 100 * similarity * union are linked; ``component_id`` is the smallest id reachable
    by links and ``kept`` marks the rows that carry it. Null, empty and blank texts have an empty set and link
    with nothing. Rows of one id count as one document; rows with a null id stay alone (component null, kept).
    An empty table gives an empty result; other columns are ignored.

    Equal sets collapse to one class first, so thousands of copies cost one signature. In each table every
    class is compared with the smallest of its bucket, and those not close to it with all others of the bucket,
    in tiles of bounded size; pairs whose sketches agree well enough are confirmed.
    Pairs that agree, confirmed or not, join classes into families. Where a family is left with more than one
    component, all its members outside the largest are compared with all others of the family, in tiles of
    bounded size whose sets are intersected in memory and which emit links only. No bucket or family is
    gathered whole and none is capped. Pairs are confirmed between sets at most a quarter apart in size, so what
    travels for a class is in proportion to its set and the leads that it meets.
    """
    if not 2 <= 2 * groups * half <= 16 * _SKETCH:
        raise ValueError("2 * groups * half must be at most 80")
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "minhash")
    n_hash = 2 * groups * half
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType.fromDDL("id long, n long, c1 long, c2 long, left array<long>, right array<long>, sketch array<long>")
    sig = scratch.save(rows.mapInArrow(lambda it: _signatures(it, width, groups, half), schema), "signatures", compression="lz4")
    named = sig.where("n > 0 and id is not null")
    classes = named.groupBy("c1", "c2", "n").agg(F.min(F.struct("id", "left", "right", "sketch")).alias("m"))
    classes = scratch.save(classes.select("c1", "c2", "n", "m.*"), "classes", compression="lz4")
    known = classes.select("id", "n", *[F.col("sketch")[k].alias(f"s{k}") for k in range(_SKETCH)])

    mates = scratch.save(_bucket_mates(classes, scratch), "mates", compression="lz4")
    stars = mates.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    ka, kb = known.alias("ka"), known.alias("kb")
    judged = stars.join(ka, stars.a == F.col("ka.id")).join(kb, stars.b == F.col("kb.id")).select("a", "b", _close(similarity, n_hash).alias("close"))
    judged = scratch.save(judged, "stars")
    close = judged.where("close").select("a", "b")
    far = judged.where("not close").select(F.col("a").alias("lead"), F.col("b").alias("id"))
    if not far.isEmpty():
        mixed = _mixed_buckets(mates, far, known, similarity, n_hash, scratch)
        close = scratch.save(close.unionByName(mixed).distinct(), "close")
    scratch.drop(mates)

    ids = close.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # a merge join at every size: the ids grow with the corpus, so they are no side to broadcast
    sets = rows.join(ids.hint("merge"), "id", "left_semi").mapInArrow(lambda it: _sets(it, width), "id long, items array<long>")
    sets = scratch.save(sets.groupBy("id").agg(F.max("items").alias("items")), "sets", compression="lz4")
    a, b = sets.select(F.col("id").alias("a"), F.col("items").alias("x")), sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    links = close.join(a, "a").join(b, "b").where(both * 100 >= (F.size("x") + F.size("y") - both) * round(100 * similarity)).select("a", "b")
    links = scratch.save(links, "links")

    found = connected_components(links, scratch)
    families = connected_components(close, scratch).withColumnRenamed("component", "family")
    members = families.join(found, "id", "left").join(known.select("id", "n"), "id").select("id", "family", F.coalesce("component", "id").alias("component"), "n")
    members = scratch.save(members, "members")
    parts = members.groupBy("family", "component").agg(F.count("*").alias("count"), F.sum("n").alias("items"))
    split = parts.groupBy("family").agg(F.count("*").alias("parts"), F.max(F.struct("count", "component", "items")).alias("main"), F.sum("count").alias("n"), F.sum("items").alias("items")).where("parts > 1")
    split = split.select("family", F.col("main.component").alias("main"), F.col("main.count").alias("n_main"), F.col("main.items").alias("items_main"), F.col("n").alias("n_all"), F.col("items").alias("items_all"))
    inside = F.col("component") == F.col("main")
    share = lambda c: F.when(inside, F.col(f"{c}_main")).otherwise(F.col(f"{c}_all") - F.col(f"{c}_main"))
    tiles = F.greatest(F.ceil(share("n") / _TILE), F.ceil(share("items") / _TILE_ITEMS))
    dealt = members.join(split, "family").select("id", "family", "component", inside.alias("inside"), F.pmod(F.xxhash64("id"), tiles).alias("tile"))
    tiled = dealt.join(sets, "id").groupBy("family", "inside", "tile").agg(F.collect_list(F.struct("id", "component", "items")).alias("docs"))
    tiled = scratch.save(tiled, "tiles", compression="lz4")
    p, q = tiled.where("not inside").alias("p"), tiled.alias("q")
    work = p.join(q, (F.col("p.family") == F.col("q.family")) & (F.col("q.inside") | (F.col("p.tile") <= F.col("q.tile")))).select(F.col("p.docs").alias("x"), F.col("q.docs").alias("y"))
    extra = work.mapInArrow(lambda it: _intersect(it, similarity), "a long, b long")
    extra = scratch.save(extra.distinct(), "links2")
    if not extra.isEmpty():
        found = connected_components(links.unionByName(extra), scratch)

    by_class = classes.select("c1", "c2", "n", F.col("id").alias("rep")).join(found.withColumnRenamed("id", "rep"), "rep", "left")
    by_class = by_class.select("c1", "c2", "n", F.coalesce("component", "rep").alias("component"))
    out = sig.select("id", "n", "c1", "c2").join(by_class, ["c1", "c2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
