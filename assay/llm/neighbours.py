"""Approximate nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from assay.llm.vectors import norms, scaled
from assay.scratch import Scratch

#: Lengths of vectors, the commonest first, that get learned partitions; others are searched whole.
_LENGTHS = 8
_SAMPLE_BYTES = 1 << 26
_NEIGHBOURS = 10
_MOST_PARTS = 256
_QUERIES = 1024
_TILE_BYTES = 1 << 24
_EPS = 1e-9
_FOUND = "query_id long, id long, score double"


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return scaled(np.array(column.flatten(), float).reshape(len(column), dim))


def graph(x: np.ndarray, at: np.ndarray, k: int = _NEIGHBOURS) -> np.ndarray:
    """Of each of the rows ``at`` of unit vectors ``x`` its k nearest others."""
    out = np.empty((len(at), k), np.int64)
    for lo in range(0, len(at), 512):
        here = at[lo : lo + 512]
        s = x[here] @ x.T
        s[np.arange(len(here)), here] = -np.inf
        out[lo : lo + len(here)] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _halves(nodes: np.ndarray, near: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Deals nodes into two halves of equal size with few edges between them: a spectral start, then swaps of the best pairs."""
    n = len(nodes)
    place = np.full(near.shape[0], -1)
    place[nodes] = np.arange(n)
    j = place[near[nodes]]
    i = np.repeat(np.arange(n), near.shape[1])[j.ravel() >= 0]
    j = j.ravel()[j.ravel() >= 0]
    i, j = np.append(i, j), np.append(j, i)  # edges count both ways
    degree = np.bincount(i, minlength=n) + 1e-9
    v = rng.standard_normal(n)
    for _ in range(40):  # power iteration towards the second eigenvector of the random walk
        v = 0.5 * v + 0.5 * np.bincount(i, v[j], n) / degree
        v -= (v * degree).sum() / degree.sum()
        v /= np.abs(v).max() + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    for _ in range(20):
        inside = np.bincount(i, side[i] == side[j], n)
        gain = degree - 2 * inside
        a, b = np.flatnonzero(~side), np.flatnonzero(side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        better = int((gain[a[:m]] + gain[b[:m]] > 0.5).sum())
        if not better:
            break
        better = max(1, better // 2)  # neighbours that swap together undo each other's gain
        before = inside.sum()
        side[a[:better]], side[b[:better]] = True, False
        if np.bincount(i, side[i] == side[j], n).sum() <= before:
            side[a[:better]], side[b[:better]] = False, True
            break
    return side


def balanced_parts(near: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part of each node of a neighbour graph: ``parts``, a power of two, of equal size, halved again and again."""
    rng = np.random.default_rng(seed)
    part = np.zeros(len(near), np.int64)
    for _ in range(parts.bit_length() - 1):
        new = part * 2
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            new[nodes] += _halves(nodes, near, rng)
        part = new
    return part


class Router:
    """A network of one hidden layer that gives the probable partitions of a vector."""

    def __init__(self, parts: int, weights: list[np.ndarray] | None = None):
        self.parts, self.weights = parts, weights

    @classmethod
    def learn(cls, x: np.ndarray, target: np.ndarray, hidden: int = 128, rounds: int = 12, seed: int = 0) -> Router:
        """Fits ``target``, for each row the share of its neighbours in each partition, by Adam on the cross entropy."""
        rng = np.random.default_rng(seed)
        d, parts = x.shape[1], target.shape[1]
        w = [rng.standard_normal((d, hidden)) * math.sqrt(2), np.zeros(hidden), rng.standard_normal((hidden, parts)) / math.sqrt(hidden), np.zeros(parts)]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for r in range(rounds):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 128):
                at = order[lo : lo + 128]
                z = x[at] @ w[0] + w[1]
                h = np.maximum(z, 0)
                error = (_softmax(h @ w[2] + w[3]) - target[at]) / len(at)
                back = (error @ w[2].T) * (z > 0)
                step += 1
                for k, g in enumerate((x[at].T @ back, back.sum(0), h.T @ error, error.sum(0))):
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    w[k] -= 0.01 * 0.7**r * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return cls(parts, w)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the partitions for unit vectors, up to a constant a row."""
        w = self.weights
        return np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3] if w else np.zeros((len(x), 1))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _order(router: Router, x: np.ndarray) -> np.ndarray:
    return np.argsort(-router.scores(x / norms(x)[:, None]), axis=1, kind="stable")


def _by_dim(batches: Iterator[pa.RecordBatch], give) -> Iterator[pa.RecordBatch]:
    """``give(rows, dim, vectors)`` for the rows of each length of vectors in each batch; columns are dim, vector and others."""
    for batch in batches:
        dims = np.array(batch.column("dim"))
        for d in np.unique(dims):
            part = batch.take(pa.array(np.flatnonzero(dims == d)))
            yield give(part, int(d), _rows(part.column("vector"), int(d)))


class _Tile:
    """Vectors to search, each of them once: of equal ones the smallest ids are kept, as many as an answer can hold."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        _, group = np.unique(np.ascontiguousarray(x).view(f"V{x.dtype.itemsize * x.shape[1]}").ravel(), return_inverse=True)
        order = np.lexsort((ids, group))
        g, i = group[order], ids[order]
        once = np.append(True, (g[1:] != g[:-1]) | (i[1:] != i[:-1]))
        order, g = order[once], g[once]
        rank = np.arange(len(g)) - np.searchsorted(g, g)
        keep = order[rank <= k]
        self.ids, self.x = ids[keep], x[keep]
        self.norm = norms(self.x)
        self.unit = self.x / self.norm[:, None]
        self.repeats = len(self.ids) - len(np.unique(self.ids))

    def search(self, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (query's place, id, score): each query's k nearest ids here besides its own, by products in blocks and then by the exact measure."""
        norm, out = norms(x), []
        unit = x / norm[:, None]
        most = min(len(self.ids), k + 1 + self.repeats)
        for lo in range(0, len(x), 256):
            s = unit[lo : lo + 256] @ self.unit.T
            least = np.partition(s, len(self.ids) - most, axis=1)[:, len(self.ids) - most] - _EPS
            q, j = np.nonzero(s >= least[:, None])
            q += lo
            q, j = (c[ids[q] != self.ids[j]] for c in (q, j))
            score = np.concatenate([(x[q[a : a + 65536]] * self.x[j[a : a + 65536]]).sum(axis=1) for a in range(0, len(q), 65536)] or [np.empty(0)]) / (norm[q] * self.norm[j])
            order = np.lexsort((self.ids[j], -score, q))
            q, i, score = q[order], self.ids[j][order], score[order]
            if self.repeats:
                _, first = np.unique(np.stack([q, i]), axis=1, return_index=True)
                first.sort()
                q, i, score = q[first], i[first], score[first]
            near = np.arange(len(q)) - np.searchsorted(q, q) < k
            out.append((q[near], i[near], score[near]))
        return tuple(np.concatenate(c) for c in zip(*out))


def _found(ids: np.ndarray, got: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids[got[0]]), pa.array(got[1]), pa.array(got[2])], ["query_id", "id", "score"])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: its own vectors first, then one pack of queries after another."""
    tile = None
    for batch in batches:
        for row in range(len(batch)):
            get = lambda c: batch.column(c)[row].as_py()
            ids = np.frombuffer(get("ids"), np.int64)
            x = np.frombuffer(get("data")).reshape(len(ids), get("dim"))
            if not get("asks"):
                tile = _Tile(ids, x, k)
            else:
                yield _found(ids, tile.search(ids, x, k))


def _pack(part: pa.Table) -> pa.Table:
    dim = part.column("dim")[0].as_py()
    x = np.concatenate([_rows(c, dim) for c in part.column("vector").chunks if len(c)])
    ids = part.column("id").to_numpy().astype(np.int64)
    first = {c: [part.column(c)[0].as_py()] for c in ("dim", "part", "block", "number")}
    return pa.table({**first, "ids": [ids.tobytes()], "data": [np.ascontiguousarray(x).tobytes()]}).cast(_PACKED)


_PACKED = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("number", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())])
_PACKED_DDL = "dim int, part int, block long, number long, ids binary, data binary"


def _best(found: DataFrame, k: int) -> DataFrame:
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


@dataclass
class Index:
    """Every usable vector with its partition, the routers that gave it, and for each length how many partitions to ask and the recall measured with these."""

    rows: DataFrame
    routers: dict[int, Router]
    probes: dict[int, int]
    recall: dict[int, float]
    scratch: Scratch


def build_index(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 5, recall: float = 0.95, sample: int = 16_384, checked: int = 256, part_rows: int = 2048, carry: dict[str, Column] | None = None, scratch: Scratch | None = None
) -> Index:
    """Learned partitions of all vectors.

    Fitted on at most ``sample`` vectors of each common length (and 64 MB), drawn by a hash: their graph of nearest neighbours is cut into balanced parts, of about
    ``part_rows`` rows of the whole table each and at most 256, and a router learns in which parts a vector's neighbours lie. Then every row
    goes to its most probable part. Of each length ``checked`` vectors, drawn alike, are compared with all rows; the number of parts to
    ask is the least with which ``recall`` of their k nearest are found. ``carry`` names further columns of ``rows``.

    Null and empty vectors, zeros, and those that hold null, NaN or infinity are left out, as are rows with a null id. Vectors of another
    length aren't comparable. Tables of fewer than two parts, and lengths beyond the eight commonest, are one part, which is searched whole.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "neighbours")
    v = F.col("vector")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), *[c.alias(name) for name, c in (carry or {}).items()])
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)).withColumn("dim", F.size("vector"))
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(_LENGTHS).collect()

    routers, fitted = {}, {}
    for dim, count in common:
        parts = 1 << max(0, min(_MOST_PARTS.bit_length() - 1, round(math.log2(max(1, count / part_rows)))))
        most = min(sample, _SAMPLE_BYTES // (8 * dim))
        parts = min(parts, 1 << max(0, (min(most, count) // 32).bit_length() - 1))
        if parts < 2:
            continue
        drawn = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("id", "vector"), "id").limit(most).select("vector").toArrow()
        x = np.concatenate([_rows(c, dim) for c in drawn.column(0).chunks if len(c)])
        x /= norms(x)[:, None]
        fitted[dim] = x
        sent = spark.sparkContext.broadcast(x)

        def neighbours(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.array(batch.column(0))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(graph(sent.value, at, min(_NEIGHBOURS, len(sent.value) - 1))))], ["node", "near"])

        near = np.zeros((len(x), min(_NEIGHBOURS, len(x) - 1)), np.int64)
        for node, others in spark.range(0, len(x), 1, 32).mapInArrow(neighbours, "node long, near array<long>").collect():
            near[node] = others
        part = balanced_parts(near, parts)
        target = np.zeros((len(x), parts))
        for column in (part[:, None], part[near]):
            np.add.at(target, (np.repeat(np.arange(len(x)), column.shape[1]), column.ravel()), 1)
        routers[dim] = Router.learn(x, target / target.sum(axis=1, keepdims=True))
        sent.unpersist()

    def assign(part: pa.RecordBatch, dim: int, x: np.ndarray) -> pa.RecordBatch:
        to = _order(routers[dim], x)[:, 0] if dim in routers else np.zeros(len(x), np.int64)
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(to.astype(np.int32))], [*part.schema.names, "part"])

    placed = rows.mapInArrow(lambda it: _by_dim(it, assign), T.StructType([*rows.schema, T.StructField("part", T.IntegerType())]))
    placed = scratch.save(placed, "placed")
    probes, measured = {}, {}
    for dim, router in routers.items():
        asked = placed.where(F.col("dim") == dim).orderBy(F.xxhash64("id", "vector", F.lit(1)), "id").limit(checked).select("id", "vector").toArrow()
        ids, x = asked.column(0).to_numpy(), np.concatenate([_rows(c, dim) for c in asked.column(1).chunks if len(c)])

        def compare(part: pa.RecordBatch, dim: int, y: np.ndarray, ids=ids, x=x) -> pa.RecordBatch:
            own, to = np.array(part.column("id")), np.array(part.column("part"))
            query, id_, score = _Tile(own, y, k).search(ids, x, k)
            # an id that repeats may lie in several parts; the first is as good as any for measuring
            order = np.argsort(own, kind="stable")
            lies = to[order[np.searchsorted(own, id_, sorter=order)]]
            return pa.RecordBatch.from_arrays([pa.array(query), pa.array(id_), pa.array(score), pa.array(lies)], ["query_id", "id", "score", "part"])

        exact = placed.where(F.col("dim") == dim).mapInArrow(lambda it: _by_dim(it, compare), f"{_FOUND}, part int")
        nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        exact = exact.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "part").toPandas()
        rank = np.argsort(_order(router, x), axis=1)[exact["query_id"].to_numpy(), exact["part"].to_numpy()]
        share = np.cumsum(np.bincount(rank, minlength=router.parts)) / max(1, len(rank))
        probes[dim] = min(int((share < recall).sum()) + 1, router.parts)
        measured[dim] = float(share[probes[dim] - 1])
    return Index(placed, routers, probes, measured, scratch)


def search_index(index: Index, queries: DataFrame, k: int = 5) -> DataFrame:
    """Rows ``(query_id, rank, id, score)``: of each query's k nearest found, by cosine in double precision, then the smaller id.

    ``queries`` has rows of ``index.rows`` or of its columns id, vector, dim. Each goes to its most probable parts and is compared with all their rows but
    those of its own id. An id that stands in several rows is one candidate with its best score, and as a query asks for all its rows.

    A part is held in blocks by a hash, of at most 16 MB, and its queries in packs; a task holds one block and passes the packs along it, so no part, however large, meets in one task.
    """
    routers, probes, scratch = index.routers, index.probes, index.scratch

    def route(part: pa.RecordBatch, dim: int, x: np.ndarray) -> pa.RecordBatch:
        to = _order(routers[dim], x)[:, : probes[dim]] if dim in routers else np.zeros((len(x), 1), np.int64)
        at = pa.array(np.repeat(np.arange(len(x)), to.shape[1]))
        return pa.RecordBatch.from_arrays([part.column(c).take(at) for c in ("dim", "id", "vector")] + [pa.array(to.ravel().astype(np.int32))], ["dim", "id", "vector", "part"])

    size = index.rows.groupBy("dim", "part").agg(F.count("*").alias("n"))
    size = scratch.save(size.withColumn("blocks", F.ceil(F.col("n") * F.col("dim") * 8 / _TILE_BYTES)), "sizes")
    # a row for each part of each common length, and one for each other length
    deal = lambda n: F.pmod(F.xxhash64("id", "vector"), n)
    held = index.rows.select("dim", "part", "id", "vector").join(size, ["dim", "part"]).withColumns({"block": deal(F.col("blocks")), "number": F.lit(0).cast("long")})
    tiles = held.select("dim", "part", "block", "number", "id", "vector").groupBy("dim", "part", "block").applyInArrow(_pack, _PACKED_DDL).withColumn("asks", F.lit(False))
    asked = queries.select("dim", "id", "vector").mapInArrow(lambda it: _by_dim(it, route), "dim int, id long, vector array<double>, part int")
    asked = scratch.save(asked, "routed")
    packs = asked.groupBy("dim", "part").agg(F.ceil(F.count("*") / _QUERIES).alias("packs"))
    packed = asked.join(packs, ["dim", "part"]).select("dim", "part", F.lit(0).cast("long").alias("block"), deal(F.col("packs")).alias("number"), "id", "vector")
    packed = packed.groupBy("dim", "part", "number").applyInArrow(_pack, _PACKED_DDL).withColumn("asks", F.lit(True))
    sent = packed.join(size, ["dim", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    work = tiles.unionByName(sent.select(*tiles.columns)).repartition("dim", "part", "block").sortWithinPartitions("dim", "part", "block", "asks", "number")
    return _best(work.mapInArrow(lambda it: _search(it, k), _FOUND), k)


def nearest_neighbours(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 5, **options) -> DataFrame:
    """Rows ``(query_id, rank, id, score)`` for the rows of ``vectors`` that meet the condition ``queries``, searched among all rows.

    See ``build_index``, which takes ``options``, and ``search_index``. Rows that can't be compared have no neighbours and are nobody's; an empty
    table, or one without queries, gives an empty result; other columns are ignored.
    """
    index = build_index(vectors, id_col, vector_col, k=k, carry={"asks": F.coalesce(queries, F.lit(False))}, **options)
    return search_index(index, index.rows.where("asks"), k)
