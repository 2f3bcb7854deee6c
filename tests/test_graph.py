"""Levels, strong components and curricula against plain restatements."""

import itertools
import random

import pytest

from assay.operators import graph as g
from assay.scratch import Scratch

EDGE = "subject_id long, object_id long"


def plain_levels(edges):
    nodes = {x for e in edges for x in e}
    into = {n: {a for a, b in edges if b == n} for n in nodes}
    level, k = {}, 0
    while True:
        free = [n for n in nodes - level.keys() if into[n] <= level.keys()]
        if not free:
            return level
        level |= dict.fromkeys(free, k)
        k += 1


def plain_components(edges):
    nodes = {x for e in edges for x in e}
    reach = {n: {b for a, b in edges if a == n} for n in nodes}
    for _ in nodes:
        reach = {n: r.union(*(reach[x] for x in r)) for n, r in reach.items()}
    return {n: min(m for m in reach[n] if n in reach[m]) for n in nodes if n in reach[n]}


def random_edges(seed):
    rng = random.Random(seed)
    n = rng.choice([6, 12, 25])
    e = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([n // 2, n, 2 * n]))]
    e += [(100 * k + i, 100 * k + i + 1) for k in range(1, 3) for i in range(rng.randrange(9))]  # chains
    e += [(300 + i, 300 + (i + 1) % 7) for i in range(7)] if rng.random() < 0.5 else []  # a ring
    e += [(303, 100), (rng.randrange(n), 300)][: rng.randrange(3)]
    return e if rng.random() < 0.7 else [(min(x), max(x)) for x in e if x[0] != x[1]]


@pytest.mark.parametrize("seed", range(8))
def test_levels_and_components(spark, seed):
    e = random_edges(seed)
    d = spark.createDataFrame(e + e[:3] + [(None, 1), (2, None)], EDGE)
    levels, left = g.topological_levels(d, Scratch(spark, "t"))
    want = plain_levels(e)
    assert {r.id: r.level for r in levels.collect()} == want and levels.count() == len(want)
    assert {tuple(r) for r in left.collect()} == {x for x in e if x[0] not in want}
    got = g.strong_components(d, Scratch(spark, "t"))
    assert {r.id: r.component for r in got.collect()} == plain_components(e) and got.count() == len(plain_components(e))


def test_a_chain_of_fifty_thousand(spark):
    n = 50_000
    d = spark.range(n).selectExpr("(id * 7919) % 50000 AS k").selectExpr("k AS subject_id", "k + 1 AS object_id")
    levels, left = g.topological_levels(d, Scratch(spark, "t"))
    assert levels.where("level = id").count() == n + 1 and left.isEmpty()


def test_two_long_rings_and_the_way_between(spark):
    ring = lambda first, n: [(first + k, first + (k + 1) % n) for k in range(n)]
    path = list(itertools.pairwise([20, *range(5000, 5300), 2040]))
    d = spark.createDataFrame(ring(0, 1000) + ring(2000, 777) + path + [(2100, 9000), (9001, 3)], EDGE)
    got = {r.id: r.component for r in g.strong_components(d, Scratch(spark, "t")).collect()}
    assert got == {k: 0 for k in range(1000)} | {k: 2000 for k in range(2000, 2777)}
    assert g.cycle_edges(d, Scratch(spark, "t")).count() == 1777


def test_confirmed_loops_need_no_review(spark):
    e = [(1, "causes", 2), (2, "causes", 1), (3, "prevents", 4), (4, "causes", 3), (5, "likes", 6), (6, "likes", 5), (7, "part_of", 7), (1, "causes", 3)]
    kinds = "subject_id long, predicate string, object_id long"
    got = g.cycle_review(spark.createDataFrame(e, kinds), spark.createDataFrame([e[0], e[1], e[2]], kinds), Scratch(spark, "t"))
    assert sorted(map(tuple, got.collect())) == [(1, 2, 2, 0, False), (3, 2, 2, 1, True), (7, 1, 1, 1, True)]


def test_curriculum_of_a_domain(spark):
    cards = spark.createDataFrame([(1, "A", 1), (2, "A", 2), (3, "A", 3), (4, "B", 1), (5, "A", 1), (6, "A", None), (7, None, 1)], "id long, domain string, skill_level int")
    e = spark.createDataFrame([(1, "prerequisite_of", 2), (3, "prerequisite_of", 2), (2, "requires", 5), (4, "prerequisite_of", 5), (1, "causes", 5)], "subject_id long, predicate string, object_id long")
    assert sorted(map(tuple, g.curriculum(cards, e, "A", 2, Scratch(spark, "t")).collect())) == [(1, 0), (2, 1), (5, 0)]
    assert g.curriculum(cards.limit(0), e, "A", 2, Scratch(spark, "t")).count() == 0


def test_betweenness_writes_a_row_per_node_and_block_of_pivots(spark, monkeypatch):
    rng = random.Random(11)
    n = 90
    e = spark.createDataFrame([(k, rng.randrange(n)) for k in range(n) for _ in range(4)] + [(k, 7) for k in range(n)], EDGE)
    scratch, most, save = Scratch(spark, "t"), [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name, *a, **o: (most.append((name, (out := save(self, df, name, *a, **o)).count())), out)[1])
    got = g.betweenness(e, spark.range(n).withColumnRenamed("id", "pivot"), scratch, None)
    assert max(rows for name, rows in most if name.startswith(("level", "share"))) <= n * 2  # not a row per node and pivot
    assert {r.id for r in got.collect()} <= set(range(n)) and got.count() > 0


def test_small_graphs_are_walked_where_their_pivots_lie(spark, monkeypatch):
    rng = random.Random(12)
    n = 70
    e = spark.createDataFrame([(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(5 * n)] + [(f"n{k}", f"n{k + 1}") for k in range(n, n + 4)], "subject_id string, object_id string")
    pivots = spark.createDataFrame([(f"n{k}",) for k in [*range(0, n + 4, 3), 999]], "pivot string")
    rows = lambda d: {r.id: round(r.score, 9) for r in d.collect()}
    want = rows(g.betweenness(e, pivots, Scratch(spark, "t"), None))
    assert rows(g.betweenness_where_sent(e.where("subject_id <> object_id").distinct(), pivots)) == want and len(want) > 60
    monkeypatch.setattr(g, "betweenness", None)  # no rounds
    assert g.sampled_betweenness(e, Scratch(spark, "t"), error=0.01).count() > 60
