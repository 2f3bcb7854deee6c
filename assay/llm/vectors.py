"""Near-duplicate vectors by PCA-ordered tiled comparison."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from assay.llm.textkit import forest
from assay.operators.components import connected_components
from assay.scratch import Scratch

#: Leading shares of the dimensions after which a comparison may stop.
_STEPS = (0.25, 0.5)
_BLOCK = 512
#: Far above the rounding of the partial products, far below any distance that matters.
_EPS = 1e-9
#: Lengths of vectors, the commonest first, that get principal axes, and the longest that do: bounds what the driver gathers.
_LENGTHS, _MOST_AXES = 8, 4096


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1: cosines stay as they are, squares neither overflow nor vanish."""
    # in two steps, as the factor for subnormal components is itself beyond the range
    shift = -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]
    return np.ldexp(np.ldexp(x, shift // 2), shift - shift // 2)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / norms(x)[:, None]


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length the count, sum and second moments of a partition's unit vectors, as one row (dim, sums)."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = np.array(batch.column(0))
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = _unit(np.array(batch.column(1).take(pa.array(at)).flatten(), float).reshape(len(at), d))
            x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            sums[d] = sums.get(d, 0) + x.T @ x
    yield from _sum_rows(sums)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[d] = sums.get(d, 0) + np.frombuffer(data).reshape(d + 1, d + 1)
    yield from _sum_rows(sums)


def _sum_rows(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for d, m in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([m.tobytes()], pa.binary())], ["dim", "sums"])


class Axes:
    """Of each common length the principal axes, by which products are summed up, and the direction in which vectors spread most, by which they are dealt.

    Other lengths keep their own axes; the result is the same with any, only the work differs.
    """

    def __init__(self, sums: dict[int, np.ndarray]):
        self.turn, self.spread = {}, {}
        for d, m in sums.items():
            m = (m + m.T) / 2
            mean = m[:d, d] / m[d, d]
            self.turn[d] = np.linalg.eigh(m[:d, :d])[1][:, ::-1]
            self.spread[d] = np.linalg.eigh(m[:d, :d] / m[d, d] - np.outer(mean, mean))[1][:, -1]

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.turn[x.shape[1]] if x.shape[1] in self.turn else x

    def lead(self, x: np.ndarray) -> np.ndarray:
        return x @ self.spread[x.shape[1]] if x.shape[1] in self.spread else x[:, 0]


def _project(batches: Iterator[pa.RecordBatch], axes: Axes) -> Iterator[pa.RecordBatch]:
    """Adds the leading coordinate by which vectors are dealt into tiles."""
    for batch in batches:
        dims, lead = np.array(batch.column("dim")), np.zeros(len(batch))
        vectors = batch.column("vector")
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            lead[at] = axes.lead(_unit(np.array(vectors.take(pa.array(at)).flatten(), float).reshape(len(at), d)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lead)], [*batch.schema.names, "lead"])


def _pack(key: tuple, tile: pd.DataFrame, kind: str) -> pd.DataFrame:
    x = np.stack(tile["vector"].to_numpy()).astype(kind)
    return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "stripe": [key[2]], "tile": [key[3]], "ids": [tile["rep"].to_numpy(np.int64).tobytes()], "sizes": [tile["size"].to_numpy(np.int64).tobytes()], "data": [x.tobytes()], "lo": [tile["lead"].min()], "hi": [tile["lead"].max()]})


class _Side:
    """Vectors on one side of a comparison: of unit length, along the axes, and the norms of what lies behind each cut."""

    def __init__(self, x: np.ndarray, axes: Axes):
        self.x = scaled(x)
        self.norm = norms(self.x)
        self.unit = self.x / self.norm[:, None]
        self.along = axes.project(self.unit)
        d = x.shape[1]
        self.cuts = [0, *sorted({max(1, round(d * s)) for s in _STEPS}), d]
        self.rest = [np.sqrt((self.along[:, c:] ** 2).sum(axis=1)) for c in self.cuts]


def _linked(a: _Side, b: _Side, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows with cosine >= least.

    Partial products over the leading axes plus the product of the suffix norms bound the cosine from above;
    pairs whose bound falls short are given up, and a block with few left goes on pair by pair.
    """
    cuts, out = a.cuts, []
    for lo in range(0, len(a.unit), _BLOCK):
        hi = min(lo + _BLOCK, len(a.unit))
        for lo2 in range(0, len(b.unit), _BLOCK):
            hi2 = min(lo2 + _BLOCK, len(b.unit))
            part = a.along[lo:hi, : cuts[1]] @ b.along[lo2:hi2, : cuts[1]].T
            i, j = np.nonzero(part + a.rest[1][lo:hi, None] * b.rest[1][None, lo2:hi2] >= least - _EPS)
            part = part[i, j]
            i, j = i + lo, j + lo2
            for k in range(1, len(cuts) - 1):
                if len(i) * (cuts[k + 1] - cuts[k]) > 1 << 21:
                    break  # many are left: the exact products below are cheaper in blocks
                part = part + np.einsum("nd,nd->n", a.along[i, cuts[k] : cuts[k + 1]], b.along[j, cuts[k] : cuts[k + 1]])
                keep = part + a.rest[k + 1][i] * b.rest[k + 1][j] >= least - _EPS
                i, j, part = i[keep], j[keep], part[keep]
            if len(i) * 4 > (hi - lo) * (hi2 - lo2):
                exact = (a.unit[lo:hi] @ b.unit[lo2:hi2].T)[i - lo, j - lo2]
            else:
                exact = np.concatenate([np.einsum("nd,nd->n", a.unit[i[s : s + 65536]], b.unit[j[s : s + 65536]]) for s in range(0, len(i), 65536)]) if len(i) else np.empty(0)
            # at the threshold one formula decides, whatever way the pair came
            close = np.flatnonzero(np.abs(exact - least) < _EPS)
            exact[close] = (a.x[i[close]] * b.x[j[close]]).sum(axis=1) / (a.norm[i[close]] * b.norm[j[close]])
            keep = exact >= least
            out.append((i[keep], j[keep]))
    return np.concatenate([i for i, _ in out]), np.concatenate([j for _, j in out])


class _Stripe:
    """The tiles of one stripe, the links found so far, and for each vector the least one it is joined with in the stripe."""

    def __init__(self):
        self.tiles: list[tuple[np.ndarray, np.ndarray, np.ndarray, float, float]] = []

    def close(self, axes: Axes, least: float, reach: float) -> None:
        """Compares the tiles with each other."""
        ids, sizes, data, self.lo, self.hi = zip(*self.tiles)
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.sides = [_Side(x, axes) for x in data]
        self.at = np.cumsum([0, *map(len, ids)])
        self.low, self.links = self.ids.copy(), np.zeros(len(self.ids), np.int64)
        self.tiles = []
        for s in range(len(self.sides)):
            for t in range(s, len(self.sides)):
                if self.lo[t] - self.hi[s] <= reach and self.lo[s] - self.hi[t] <= reach:
                    i, j = _linked(self.sides[s], self.sides[t], least)
                    if s == t:
                        i, j = i[i < j], j[i < j]
                    i, j = i + self.at[s], j + self.at[t]
                    np.add.at(self.links, i, self.sizes[j])
                    np.add.at(self.links, j, self.sizes[i])
                    self.join(i, j)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            order = np.argsort(self.ids, kind="stable")
            known = order[np.searchsorted(self.ids, self.low, sorter=order)]
            self.low = forest(self.ids, np.concatenate([np.arange(len(self.ids)), i]), np.concatenate([known, j]))

    def against(self, tile: tuple[np.ndarray, np.ndarray, np.ndarray, float, float], axes: Axes, least: float, reach: float) -> pa.RecordBatch:
        """A tile of another stripe: its vectors' links into this one, each with a vector here that it is joined with."""
        ids, sizes, data, lo, hi = tile
        side, found = _Side(data, axes), []
        for s, own in enumerate(self.sides):
            if lo - self.hi[s] <= reach and self.lo[s] - hi <= reach:
                i, j = _linked(own, side, least)
                found.append((i + self.at[s], j))
        i, j = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2
        np.add.at(self.links, i, sizes[j])
        links, first = np.zeros(len(ids), np.int64), np.full(len(ids), len(self.ids))
        np.add.at(links, j, self.sizes[i])
        np.minimum.at(first, j, i)
        self.join(i, first[j])
        at = np.flatnonzero(links)
        return _found(ids[at], links[at], self.low[first[at]])

    def rows(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.links)
        return _found(self.ids[at], self.links[at], self.low[at])


def _found(ids: np.ndarray, links: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(low)], ["rep", "links", "low"])


def _compare(batches: Iterator[pa.RecordBatch], axes: Axes, least: float, reach: float, kind: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by stripe, its own tiles first, then each tile of another stripe that it is to meet; one tile of these is held at a time."""
    key = stripe = None
    for batch in batches:
        for row in range(len(batch)):
            get = lambda c: batch.column(c)[row].as_py()
            if (here := (get("label"), get("dim"), get("stripe"))) != key:
                if stripe:
                    yield from _finish(stripe, axes, least, reach)
                key, stripe = here, _Stripe()
            tile = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("sizes"), np.int64), np.frombuffer(get("data"), kind).reshape(-1, get("dim")).astype(float), get("lo"), get("hi")
            if not get("other"):
                stripe.tiles.append(tile)
                continue
            if stripe.tiles:
                stripe.close(axes, least, reach)
            yield stripe.against(tile, axes, least, reach)
    if stripe:
        yield from _finish(stripe, axes, least, reach)


def _finish(stripe: _Stripe, axes: Axes, least: float, reach: float) -> Iterator[pa.RecordBatch]:
    if stripe.tiles:
        stripe.close(axes, least, reach)
    yield stripe.rows()


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, cosine: float = 0.93, tile: int = 1024, scratch: Scratch | None = None
) -> DataFrame:
    """One row ``(id, n_links, component_id, kept)`` per row of ``vectors``.

    Two vectors of one label (not null) and one length are linked if their cosine in double precision reaches
    ``cosine``. ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id
    reachable, ``kept`` marks the row that carries it. Vectors that are null, empty or zero or hold null, NaN or
    infinity link with nothing, nor do rows with a null label or id (for a null id component_id is null and
    kept true). Rows that repeat an id count as vectors of their own in n_links and share a component. An
    empty table gives an empty result; other columns are ignored.

    Equal vectors collapse to one class, so copies cost nothing. Classes of a label are dealt along the axis in which
    vectors spread most into tiles of about ``tile``, and neighbouring tiles form stripes. A task holds one stripe and
    passes tiles of other stripes along it (each pair of stripes meets once, by turns here and there), unless their intervals on that axis are too far apart. It emits one row
    per linked class, not per link: its links counted, and a class that it is joined with. Components follow from those rows.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "vectors")
    v = F.col("vector")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = v.isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).cast("string").alias("label"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumns({"c1": F.xxhash64("label", "vector"), "c2": F.xxhash64(F.lit(1), "vector", "label")})
    classes = rows.where("usable").groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.min(F.struct("label", "vector")).alias("m"))
    classes = classes.select("rep", "size", "c1", "c2", "m.*").withColumn("dim", F.size("vector"))
    classes = scratch.save(classes, "classes")

    common = [r[0] for r in classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(_LENGTHS).collect()]
    moments = classes.where(F.col("dim").isin(common) & (F.col("dim") <= _MOST_AXES)).select("dim", "vector").mapInArrow(_moments, "dim int, sums binary")
    width = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sums: dict[int, np.ndarray] = {}
    for d, data in moments.repartition(width).mapInArrow(_add, "dim int, sums binary").collect():
        sums[d] = sums.get(d, 0) + np.frombuffer(data).reshape(d + 1, d + 1)
    axes = Axes(sums)

    led = classes.mapInArrow(lambda it: _project(it, axes), T.StructType([*classes.schema, T.StructField("lead", T.DoubleType())]))
    led = scratch.save(led.select("rep", "size", "label", "dim", "vector", "lead"), "led")
    # a slight shift by id, so that equal coordinates spread over tiles too
    spot = F.col("lead") + F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) * 1e-12
    count = led.groupBy("label", "dim").agg(F.count("*").alias("n"), F.percentile_approx(spot, [k / 256 for k in range(1, 256)], 10_000).alias("q"))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("n") / tile))
    near = F.filter("q", lambda e: e <= spot)
    # 256 quantiles, and beyond that many tiles an even deal by hash within each quantile
    coarse = F.least(tiles, F.lit(256))
    deal = F.floor(F.size(near) * coarse / 256) * F.ceil(tiles / coarse) + F.pmod(F.xxhash64("rep", F.lit(7)), F.ceil(tiles / coarse))
    # a stripe grows with the label up to 16 tiles or 64 MB, so that each of the other tiles travels once for many
    per = F.greatest(F.lit(1), F.least(F.lit(16), F.floor(F.lit(1 << 23) / (F.col("dim") * tile)), F.ceil(tiles / 16)))
    tiled = led.join(count, ["label", "dim"]).withColumn("tile", deal.cast("long")).withColumn("stripe", F.floor(F.col("tile") / per).cast("long"))
    kind = "<f4" if isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), T.FloatType) else "<f8"
    packed = tiled.select("label", "dim", "stripe", "tile", "rep", "size", "vector", "lead").groupBy("label", "dim", "stripe", "tile")
    packed = packed.applyInPandas(lambda key, part: _pack(key, part, kind), "label string, dim int, stripe long, tile long, ids binary, sizes binary, data binary, lo double, hi double")
    packed = scratch.save(packed, "tiles")

    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6
    spans = packed.groupBy("label", "dim", "stripe").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    a, b = spans.alias("a"), packed.select("label", "dim", "stripe", "tile", "lo", "hi").alias("b")
    meets = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.stripe") != F.col("b.stripe"))
    # of two stripes the lower is host to the other's tiles if their sum is even, else the higher: all have as many guests
    meets = meets & ((F.col("a.stripe") < F.col("b.stripe")) == ((F.col("a.stripe") + F.col("b.stripe")) % 2 == 0))
    meets = meets & (F.col("b.lo") - F.col("a.hi") <= reach) & (F.col("a.lo") - F.col("b.hi") <= reach)
    visits = a.join(b, meets).select("b.label", "b.dim", "b.tile", F.col("a.stripe").alias("to"))
    others = packed.drop("stripe").join(visits, ["label", "dim", "tile"]).withColumnRenamed("to", "stripe").withColumn("other", F.lit(True))
    work = packed.withColumn("other", F.lit(False)).unionByName(others)
    work = work.repartition("label", "dim", "stripe").sortWithinPartitions("label", "dim", "stripe", "other", "tile")
    found = work.mapInArrow(lambda it: _compare(it, axes, cosine, reach, kind), "rep long, links long, low long")
    found = scratch.save(found, "found")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("rep != low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct(), scratch)
    per = classes.select("c1", "c2", "size", "rep").join(links, "rep", "left").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    per = per.select("c1", "c2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = rows.select("id", "usable", "c1", "c2").join(per, ["c1", "c2"], "left")
    component = F.when(F.col("usable"), F.col("component")).otherwise(F.col("id"))
    return out.select("id", F.when(F.col("usable"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
