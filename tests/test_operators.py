"""Fixtures for rules that the driver tables don't reach."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from assay.functions import columns as fc
from assay.operators import dedupe as dd, evidence as ev, graph as g, ops, retrieve as rt
from assay.operators.components import connected_components
from assay.scratch import Scratch, shared_dir


def one(spark, expr, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(expr).first()[0]


@pytest.mark.parametrize("score,band", [(1.0, "very_high"), *[x for edge, name, below in ((0.85, "very_high", "high"), (0.70, "high", "moderate"), (0.55, "moderate", "low"), (0.35, "low", "very_low")) for x in ((edge, name), (edge - 1e-9, below))], (0.0, "very_low")])
def test_bands(spark, score, band):
    assert one(spark, ev.band_for(F.col("s")), s=score) == band


def test_corroboration_grows_and_saturates(spark):
    values = [one(spark, ev.corroboration(F.col("n")), n=n) for n in (-1, 0, 1, 3, 9, 40)]
    assert values[0] == values[1] == 0 and values == sorted(values) and values[4] == pytest.approx(0.950, abs=1e-3) and values[-1] < 1


def star(spark, claims, groups, specific=True):
    c = spark.createDataFrame([(i, i, "k", t, s, 0.0, False, 1.0) for i, (t, s) in enumerate(claims)], "source_id int, line int, concept_id string, evidence_tier string, stance string, hedge_level double, is_reported_from_other boolean, extraction_certainty double")
    s = spark.createDataFrame([(i, i, date(2025, 1, 1), "organic", 1.0) for i in range(len(claims))], "source_id int, creator_id int, published_at date, commercial_context string, asr_confidence double")
    k = spark.createDataFrame([(i, gr, 0.5) for i, gr in enumerate(groups)], "creator_id int, independence_group string, reliability double")
    p = spark.createDataFrame([("k", "ADH", 0, date(2020, 1, 1), *[specific] * 4, False)], "concept_id string, domain string, risk_tier int, first_seen date, has_parameters boolean, has_conditions boolean, has_mechanism boolean, has_implementation_steps boolean, unresolved_contradiction boolean")
    return ev.promotion(ev.confidence(ev.evidence(c, s, k), p, "2026-08-10"), "2026-08-10").first()


def test_one_lineage_is_one_voice(spark):
    echo = star(spark, [("expert_assertion", "supports")] * 40, ["g"] * 40)
    few = star(spark, [("expert_assertion", "supports")] * 6, ["a", "b", "c", "d", "e", "e"])
    assert echo.groups == 1 and few.groups == 5 and few.confidence > echo.confidence
    assert (echo.state, echo.rule) == ("provisional", "single_lineage")


def test_missing_groups_are_lineages_of_their_own(spark):
    assert star(spark, [("anecdote", "supports")] * 4, [None, "", "a", "a"]).groups == 3


def test_hearsay_stays_low_and_strong_sources_count(spark):
    assert star(spark, [("hearsay", "supports")] * 50, ["a", "b"] * 25, False).confidence < 0.55
    strong, weak = star(spark, [("peer_reviewed", "supports")] * 3, ["a", "b", "c"]), star(spark, [("anecdote", "supports")] * 30, ["a", "b", "c"] * 10)
    assert strong.confidence > weak.confidence and strong.state == "published"


def test_noisy_or(spark):
    assert spark.createDataFrame([(0.44,), (0.44,), (-1.0,)], "p double").agg(ev.noisy_or(F.col("p"))).first()[0] == pytest.approx(0.686)


def features(spark, **b):
    base = dict(title="humidity control", domain="RET", path=["RET", "env"], entities=["rh"], predicates=["affects"], parameters=["rh"], polarity="positive", scope="general", contexts=["home"])
    cols = "id string, title string, domain string, path array<string>, entities array<string>, predicates array<string>, parameters array<string>, polarity string, scope string, contexts array<string>"
    f = spark.createDataFrame([("a", *base.values()), ("b", *(base | b).values())], cols)
    pairs = spark.createDataFrame([("a", "b", 0.98)], "a_id string, b_id string, embedding_similarity double")
    return dd.score_pairs(pairs, f).first()


def test_pair_scores(spark):
    assert features(spark).verdict == "auto_merge"
    assert features(spark, polarity="negative").score == pytest.approx(features(spark).score - 0.20)
    assert features(spark, contexts=["salon"]).score == pytest.approx(features(spark).score - 0.25)
    assert features(spark, entities=["x"]).verdict != "auto_merge"
    assert features(spark, path=["RET", "env", "deep"]).score == pytest.approx(features(spark).score - 0.03)


@pytest.mark.parametrize("parts", [1, 7])
def test_components_of_odd_shapes(spark, parts):
    rng = random.Random(5)
    chain = [(k, k + 1) for k in range(100, 160)]
    hub = [(500, k) for k in range(501, 620)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    edges = chain + hub + loose + [(7, 7), (None, 3), (100, 101), (101, 100)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    d = spark.createDataFrame(edges, "a long, b long").repartition(parts)
    got = {r.id: r.component for r in connected_components(d, Scratch(spark, "t")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_tombstones(spark):
    c = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", None), ("x", "y"), ("y", "x")], "id string, merged_into string")
    got = {r.id: r.final_id for r in dd.resolve_tombstones(c, Scratch(spark, "t")).collect()}
    assert got == {"a": "e", "b": "e", "c": "e", "d": "e", "e": "e", "x": None, "y": None}


def test_echo_pairs_need_different_creators(spark):
    t = "bread rises slowly where the kitchen stays cold overnight in winter"
    d = spark.createDataFrame([(1, "x", t), (2, "y", t + " today"), (3, "x", t), (4, "z", "nothing like it at all here"), (5, "x", t + " again")], "id int, creator string, text string")
    scratch = Scratch(spark, "echo")
    members, classes = dd.echo_classes(d, scratch)
    assert sorted((r.a_id, r.b_id) for r in dd.echo_members(members, dd.echo_pairs(classes, scratch)).collect()) == [(1, 2), (2, 3), (2, 5)]


def test_cycles_and_levels(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (0, 1), (5, 5)], "subject_id long, object_id long")
    assert sorted(map(tuple, g.cycle_edges(e, Scratch(spark, "t")).collect())) == [(1, 2), (2, 3), (3, 1), (5, 5)]
    levels, left = g.topological_levels(spark.createDataFrame([(0, 1), (1, 2), (0, 2)], "subject_id long, object_id long"), Scratch(spark, "t"))
    assert {r.id: r.level for r in levels.collect()} == {0: 0, 1: 1, 2: 2} and left.isEmpty()


def test_context_match(spark):
    c = "array<struct<variable:string,operator:string,value:string>>"
    rows = [([("rh", ">", "60")], 1.0), ([("rh", "<", "60")], 0.0), ([("rh", ">", "60"), ("temp", "=", "x")], 0.5), ([], 1.0), (None, 1.0), ([("rh", "between", "60,70"), ("lash", "in", "a,b")], 1.0), ([("lash", "not", "a")], 0.0)]
    d = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], f"k int, c {c}").withColumn("ctx", F.create_map(F.lit("rh"), F.lit("65"), F.lit("lash"), F.lit("a")))
    assert [r[0] for r in d.orderBy("k").select(g.context_match(F.col("c"), F.col("ctx"))).collect()] == [r[1] for r in rows]


def test_nearest_is_exact_with_ties(spark):
    v = spark.createDataFrame([(k, [float(k % 3), 1.0]) for k in range(9)], "id long, vector array<double>").repartition(3)
    q = spark.createDataFrame([(100, [0.0, 2.0])], "query long, vector array<double>")
    assert [(r.id, r.rank) for r in rt.nearest(q, v, 4).orderBy("rank").collect()] == [(0, 1), (3, 2), (6, 3), (1, 4)]


def test_prices(spark):
    usage = spark.createDataFrame([(m, 1_000_000, 0, 0, 0) for m in ("alpha", "alpha-mini-3", "other", "")], "model string, input_tokens long, output_tokens long, cache_read_tokens long, cache_write_tokens long")
    prices = spark.createDataFrame([("alpha", 5.0, 25.0), ("alpha-mini", 1.0, 5.0)], "prefix string, price_in double, price_out double")
    assert {r.model: r.cost_usd for r in ops.price_usage(usage, prices).collect()} == {"alpha": 5.0, "alpha-mini-3": 1.0, "other": 5.0, "": 5.0}


@pytest.mark.parametrize("text,slug", [("The Café of Humidity & Glue!", "cafe-humidity-glue"), ("on the", "on-the"), ("!!!", None), ("x" * 80, "x" * 60)])
def test_slug(spark, text, slug):
    assert one(spark, fc.slugify(F.col("t")), t=text) == slug


def test_shared_folder_is_the_one_named(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named.rstrip("/") if named else shared_dir(spark))


def test_betweenness_against_brute_force(spark):
    rng = random.Random(9)
    edges = {(rng.randrange(12), rng.randrange(12)) for _ in range(30)} | {(1, 1)}
    nodes, out = range(12), {}
    after = {v: [w for a, w in edges if a == v and w != v] for v in nodes}
    for s in nodes:  # every shortest path, listed
        paths, front, seen = {s: [[s]]}, [s], {s}
        while front:
            nxt = {}
            for v in front:
                for w in after[v]:
                    if w not in seen:
                        nxt.setdefault(w, []).extend(p + [w] for p in paths[v])
            paths |= nxt
            front, seen = list(nxt), seen | set(nxt)
        for t, ps in paths.items():
            for p in ps:
                for v in p[1:-1]:
                    out[v] = out.get(v, 0) + 1 / len(ps)
    e = spark.createDataFrame(list(edges), "subject_id long, object_id long")
    got = {r.id: r.score for r in g.betweenness(e, spark.range(12).withColumnRenamed("id", "pivot"), Scratch(spark, "t")).collect()}
    assert got == {k: pytest.approx(v) for k, v in out.items()}


@pytest.mark.parametrize("shared", [1, 2])
def test_large_blocks_give_all_their_pairs(spark, monkeypatch, shared):
    monkeypatch.setattr(dd, "_BLOCK_TILE", 7)
    rng = random.Random(8)
    keys = {k: sorted({"hot", *(rng.choice("abcd") for _ in range(2))} - ({"hot"} if k % 3 == 0 else set())) for k in range(60)}
    d = spark.createDataFrame(list(keys.items()), "id long, keys array<string>")
    want = {(a, b) for a in keys for b in keys if a < b and len(set(keys[a]) & set(keys[b])) >= shared}
    got = [(r.a_id, r.b_id) for r in dd.block_pairs(d, F.col("keys"), "g", shared=shared).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_blocking_query_keeps_a_leaf_of_more_than_a_thousand(spark, tmp_path):
    from assay.plans import dedupe as plans

    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    many = spark.range(1002).crossJoin(part.limit(1)).withColumn("p_partkey", F.col("id").cast(part.schema["p_partkey"].dataType)).select(part.columns)
    many.write.parquet(f"{tmp_path}/part.parquet")
    assert plans.blocking_pairs(spark, str(tmp_path)).count() == 1002 * 1001 // 2


def test_widespread_copies_are_all_echoes(spark):
    """Thirty equal texts by thirty creators are one group with 435 pairs, and a near copy links with them all."""
    text = " ".join(f"said{k}" for k in range(40))
    rows = [(k, f"c{k}", text) for k in range(30)] + [(30, "d", text + " and more"), (31, "e", "another text of its own that nobody repeats"), (32, None, text), (33, "f", "few words")]
    scratch = Scratch(spark, "echo")
    members, classes = dd.echo_classes(spark.createDataFrame(rows, "id long, creator string, text string"), scratch, width=3)
    pairs = dd.echo_pairs(classes, scratch)
    assert [(r.a_id, r.b_id) for r in pairs.collect()] == [(0, 30)]
    every = {(r.a_id, r.b_id) for r in dd.echo_members(members, pairs).collect()}
    assert every == {(a, b) for a in range(31) for b in range(a + 1, 31)} and len([p for p in every if p[1] < 30]) == 435


def test_echoes_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.choice([6, 20, 60]))]
        for _ in range(rng.choice([1, 4, 9])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 3])):
                copy[rng.randrange(len(copy))] = "x"
            rows.append((len(rows), f"c{rng.randrange(3)}", " ".join(copy)))
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, _, t in rows}
    creator = {i: c for i, c, _ in rows}
    want = {(a, b) for a in sets for b in sets if a < b and creator[a] != creator[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) > 0.6}
    scratch = Scratch(spark, "echo")
    members, classes = dd.echo_classes(spark.createDataFrame(rows, "id long, creator string, text string"), scratch)
    assert {(r.a_id, r.b_id) for r in dd.echo_members(members, dd.echo_pairs(classes, scratch)).collect()} == want
