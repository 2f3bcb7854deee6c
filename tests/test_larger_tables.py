"""Odd texts and tables in which keys repeat often."""

import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from assay.operators import dedupe as dd, evidence as ev, graph as g, knowledge as kn, retrieve as rt, validate as va
from assay.plans import registry
from assay.scratch import Scratch, tasks_for


def test_invented_quotes_of_words_with_many_tokens(spark, tmp_path):
    text = "Mi%%% raóes### queñmijañ*** se%%% de%%% asó&&& ciónadoraos,%%% del,*** ar%%% cillque%%% mentemico*** doóbo### un%%% arquemi%%% las&&& osesdobo&&& óadoes$$$"
    rows = [(1, text), (2, text), (3, text), (4, "a b"), (6, "a b"), (10, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.code for r in registry.QUERIES["rewritten_quotes"](spark, str(tmp_path)).collect()}
    assert got == {1: "quote_paraphrased", 2: "quote_not_found", 3: "none", 4: "none", 6: "none", 10: "quote_not_found"}


def test_rewritten_quotes_of_texts_that_repeat_or_have_no_tokens(spark, tmp_path):
    eight, greek = "one red fox ran over the old hill", "\u03b1\u03b2 \u03b3\u03b4 \u03b5 \u03b6\u03b7 \u03b8 \u03b9\u03ba \u03bb\u03bc \u03bd \u03be\u03bf \u03c0 \u03c1\u03c3 \u03c4\u03c5 \u03c6 \u03c7\u03c8 \u03c9 \u03b1 \u03b2 \u03b3"
    other = "  a b\tc d  e f g h\n i j k l m n o p q"
    rows = [(n, t) for n in (None, *range(8, 12)) for t in (" ".join([eight] * 9), greek, greek + " a1 2", other, f"{other} {eight}", "a b", " ", "", None)] + [(13, eight + " " + eight[4:])] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(registry.ORACLE_SQL["rewritten_quotes"]).fetchall()
    assert sorted(map(repr, map(tuple, registry.QUERIES["rewritten_quotes"](spark, str(tmp_path)).collect()))) == sorted(map(repr, want))


def test_a_text_is_cut_into_tokens_once_for_all_of_a_quote(spark):
    d = spark.createDataFrame([("a b a 40% x", "a z forty percent"), ("", "a"), ("q", None)], "q string, s string").select(va.quote_ceiling("q", "s").alias("top"))
    assert [r.top for r in d.collect()] == [4 / 6, 0.0, 0.0]
    lambdas = d._jdf.queryExecution().optimizedPlan().toString().split("lambdafunction(")
    assert not any("array_contains(array_distinct" in x for x in lambdas)


def test_surest_parameters_of_repeated_ranges(spark):
    rng = random.Random(5)
    contexts = [(k, rng.choice("ab"), float(rng.randrange(12))) for k in range(60)] + [(7, "a", 3.0), (7, "a", 3.0), (8, None, 1.0), (9, "b", None)]
    lows = [(rng.choice("ab"), float(rng.randrange(6))) for _ in range(400)]
    parameters = [(n, lo, lo + 4, rng.choice([0.5, 0.7, 0.9]), e) for e, (n, lo) in enumerate(lows)]
    c, p = spark.createDataFrame(contexts, "context_id long, name string, value double"), spark.createDataFrame(parameters, "name string, lo double, hi double, confidence double, entity_id long")
    columns = ["context_id", "name", "value", "entity_id", "confidence", "place"]
    rows = lambda d: sorted(tuple(r) for r in d.select(*columns).collect())
    assert rows(rt.matching_parameters(c, p, most=3)) == rows(rt.matching_parameters(c, p).where("place <= 3"))


def _evidence_input(spark):
    rng = random.Random(6)
    tiers = ["peer_reviewed", "anecdote", "folklore", "odd"]
    claims = [(rng.randrange(40), rng.choice([1, 1, 1, 2, 3]), rng.choice(tiers), rng.choice(["supports", "contradicts", "qualifies"]), rng.random(), rng.random() < 0.5, rng.random()) for _ in range(400)]
    c = spark.createDataFrame(claims, "source_id long, concept_id long, evidence_tier string, stance string, hedge_level double, is_reported_from_other boolean, extraction_certainty double")
    s = spark.createDataFrame([(k, k % 9 if k % 8 else None, None, rng.choice(["organic", "sponsored", None]), rng.choice([0.5, None])) for k in range(35)], "source_id long, creator_id long, published_at date, commercial_context string, asr_confidence double")
    return c, s, spark.createDataFrame([(k, rng.choice(["a", "b", "", None]), 0.1 * k) for k in range(7)], "creator_id long, independence_group string, reliability double")


def test_evidence_moves_claims_twice_and_then_only_sums(spark, monkeypatch):
    c, s, k = _evidence_input(spark)
    rows = lambda: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in ev.evidence(c, s, k).collect())
    plan = ev.evidence(c, s, k)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(concept_id") == 1 and "gkey" not in " ".join(x for x in plan.splitlines() if "hashpartitioning" in x)
    whole = rows()
    monkeypatch.setattr(ev, "_MANY", 100)  # concept 1 is summed in several places
    assert rows() == whole and {r[0]: r[1] for r in whole} == {r.concept_id: r["count"] for r in c.groupBy("concept_id").count().collect()}


def test_low_thresholds_are_compared_in_memory(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((300, 6))
    d = spark.createDataFrame([(k, [float(y) for y in v]) for k, v in enumerate(x)] + [(998, [0.0] * 6), (999, None)], "id long, vector array<double>")
    monkeypatch.setattr(rt, "pair_cosines", None)  # no pair is shuffled
    got = {(r.query, r.id): r.score for r in rt.similar_vectors(d.withColumnRenamed("id", "query"), d, 0.5, Scratch(spark, "t"), recall=0.9).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(u @ u.T >= 0.5))}
    assert set(got) == want and all(abs(s - u[i] @ u[j]) < 1e-12 for (i, j), s in got.items())


def test_best_of_repeated_sets(spark):
    rng = random.Random(8)
    kinds = [sorted(rng.sample("abcdefg", rng.randrange(1, 5))) for _ in range(9)]
    rows = spark.createDataFrame([(k, rng.choice(kinds)) for k in range(80)] + [(90, ["z"]), (91, [])], "id long, items array<string>")
    close = dd.similar_sets(rows, Scratch(spark, "t"), 0.4)
    want = {tuple(r) for r in dd.best_pairs(close.withColumn("generator", F.lit("g")).withColumnRenamed("overlap", "score"), 3).collect()}
    assert {tuple(r) for r in dd.similar_best(rows, Scratch(spark, "t"), 0.4, 3, "g").collect()} == want and len(want) < 80 * 3 + 1 < close.count()


def _copies(spark, tmp_path, sf="/root/testdata/sf0.001"):
    """Parts in five copies with shifted keys, and their vectors; the SQL's view of them."""
    part = spark.read.parquet(f"{sf}/part.parquet").where("p_partkey < 60")
    rows = part.crossJoin(spark.range(5).withColumnRenamed("id", "copy")).withColumn("p_partkey", F.expr("p_partkey + 60 * copy")).drop("copy")
    rows.write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(k, [0.1 * (k % 7) + 0.3, 0.7, -0.2 * k, 1 / (k + 3)]) for k in range(30)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    for t in ("part", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    return con


def test_pairs_are_scored_once_a_class_and_never_moved(spark, tmp_path, monkeypatch):
    con = _copies(spark, tmp_path)
    monkeypatch.setattr(dd, "_BLOCK_TILE", 8)
    d = registry.QUERIES["pair_scores"](spark, str(tmp_path))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query" not in plan and "hashpartitioning(a_id" not in plan
    assert sorted(map(tuple, d.collect())) == sorted(con.sql(registry.ORACLE_SQL["pair_scores"]).fetchall())


def test_blocks_are_paired_by_classes(spark, tmp_path, monkeypatch):
    con = _copies(spark, tmp_path)
    monkeypatch.setattr(dd, "_BLOCK_TILE", 8)
    d = registry.QUERIES["blocking_pairs"](spark, str(tmp_path))
    assert d._jdf.queryExecution().executedPlan().toString().count("explode(") >= 4  # the ids of both sides, in each generator
    got = sorted(map(tuple, d.collect()))
    assert got == sorted(con.sql(registry.ORACLE_SQL["blocking_pairs"]).fetchall()) and len(got) == 600


def test_pairs_of_many_generators_move_once_and_as_numbers(spark, monkeypatch):
    rng = random.Random(13)
    rows = spark.createDataFrame([(k, rng.choice("ab"), [rng.choice("xyz"), rng.choice("xyzw")]) for k in range(60)], "id long, p string, q array<string>")
    monkeypatch.setattr(dd, "_BLOCK_TILE", 9)
    want = sorted(map(tuple, dd.union_pairs(dd.block_pairs(rows, F.array("p"), "p"), dd.block_pairs(rows, F.col("q"), "q")).collect()))
    d = dd.named_pairs({"q": dd.block_pairs(rows, F.col("q"), "q", repeats=True), "p": dd.block_pairs(rows, F.array("p"), "p", repeats=True, tasks=5)}, 5)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(a_id") == 1 and "collect_set" not in plan and sorted(map(tuple, d.collect())) == want


def test_pairs_of_one_key_each_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(9)
    rows = spark.createDataFrame([(k, rng.choice(["a", "b", "", None]), rng.choice("xyz")) for k in range(90)], "id long, p string, q string")
    want = sorted(map(tuple, dd.union_pairs(dd.block_pairs(rows, F.array("p"), "p"), dd.block_pairs(rows, F.array("q"), "q")).collect()))
    monkeypatch.setattr(dd, "_BLOCK_TILE", 7)
    d = dd.keyed_pairs(rows, {"p": F.col("p"), "q": F.col("q")})
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a_id" not in plan and sorted(map(tuple, d.collect())) == want


def test_totals_of_recommendations_meet_by_classes(spark):
    rng = random.Random(10)
    c = spark.createDataFrame([(k, float(rng.randrange(8)), rng.randrange(3), rng.choice([None, 0, 1])) for k in range(50)] + [(60, None, 1, 1)], "context_id long, value double, condition long, use long")
    r = spark.createDataFrame([(k, float(k % 4), float(k % 4 + 3)) for k in range(120)], "entity_id long, lo double, hi double")
    kinds = ["suitable_for", "contraindicated_with", "incompatible_with", "compatible_with"]
    e = spark.createDataFrame([(k, p, rng.randrange(2), 0.5, 1.0) for k in range(120) for p in rng.sample(kinds, rng.randrange(1, 4))], "entity_id long, predicate string, target long, strength double, confidence double")
    want = kn.recommend(c, r, e).groupBy("context_id").agg(F.count("*").alias("entities"), F.sum("score").alias("score"))
    rows = lambda d: sorted((x.context_id, x.entities, round(x.score, 9)) for x in d.collect())
    assert rows(kn.recommendation_totals(c, r, e)) == rows(want) and want.count() > 20


def test_every_customer_is_a_context_of_recommendations(spark, tmp_path):
    spark.createDataFrame([(k, 1000.0 + k, k % 3) for k in range(1, 25)], "c_custkey long, c_acctbal double, c_nationkey long").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(k, 1 + k % 9) for k in range(40)], "p_partkey long, p_size long").write.parquet(str(tmp_path / "part.parquet"))
    got = registry.QUERIES["recommendations"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    for t in ("customer", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.sql(registry.ORACLE_SQL["recommendations"]).fetchall()) and {r.context_id for r in got} == set(range(1, 25))


def test_entities_are_ranked_once_for_all_contexts_with_the_same_set(spark, monkeypatch):
    rng = random.Random(12)
    c = spark.createDataFrame([(k, k / 40, k % 3) for k in range(90)] + [(900 + k, 1.0, 0) for k in range(200)], "context_id long, value double, condition long")
    r = spark.createDataFrame([(k, float(k % 2), float(k % 2 + 1)) for k in range(150)], "entity_id long, lo double, hi double")
    e = spark.createDataFrame([(k, p, rng.randrange(2), rng.choice([0.5, 0.25]), 1.0) for k in range(150) for p in ("suitable_for", "contraindicated_with")], "entity_id long, predicate string, target long, strength double, confidence double")
    for name, n in (("_BLOCKS", 3), ("_BLOCK_IDS", 40), ("_EQUALS", 64), ("_RANKED_ROWS", 50)):
        monkeypatch.setattr(kn, name, n)
    d = kn.recommend(c, r, e)
    rows, places = {}, {}
    for x in kn._scored(c, r, e).collect():
        rows.setdefault(x.context_id, []).append((-x.score, x.entity_id, tuple(x.because)))
    for x in d.collect():
        places.setdefault(x.context_id, []).append((x.place, (-x.score, x.entity_id, tuple(x.because))))
    assert {k: [(n, x) for n, x in enumerate(sorted(v), 1)] for k, v in rows.items()} == {k: sorted(v) for k, v in places.items()} and len(rows) > 200
    windows = [x for x in d._jdf.queryExecution().executedPlan().toString().split("windowspecdefinition(")[1:] if "entity_id" in x.split("specifiedwindowframe")[0]]
    assert windows and all(x.startswith("no#") for x in windows)


def test_equal_contexts_share_one_ranking(spark):
    rng = random.Random(11)
    c = spark.createDataFrame([(k, float(k % 3), k % 2) for k in range(60)] + [(70, 1.0, 0), (70, 2.0, 1), (71, None, 1)], "context_id long, value double, condition long")
    r = spark.createDataFrame([(k, float(k % 2), float(k % 2 + 1)) for k in range(50)] + [(3, 0.0, 2.0)], "entity_id long, lo double, hi double")
    e = spark.createDataFrame([(k, p, rng.randrange(2), rng.choice([0.5, 0.25]), 1.0) for k in range(50) for p in ("suitable_for", "suitable_for", "contraindicated_with")[rng.randrange(2) :]], "entity_id long, predicate string, target long, strength double, confidence double")
    d = kn.recommend(c, r, e)
    plain = sorted((x.context_id, x.entity_id, x.score, tuple(x.because)) for x in kn._scored(c, r, e).collect())
    got = d.collect()
    assert sorted((x.context_id, x.entity_id, x.score, tuple(x.because)) for x in got) == plain and len(plain) > 500
    for k in {x.context_id for x in got}:
        mine = sorted((x for x in got if x.context_id == k), key=lambda x: x.place)
        assert [x.place for x in mine] == list(range(1, len(mine) + 1)) and mine == sorted(mine, key=lambda x: (-x.score, x.entity_id))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "row_number" in plan and "windowspecdefinition(rep" in plan  # sorted by classes, not by contexts


def _plan(d):
    return d._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_dealt_by_number_not_bytes(spark):
    assert tasks_for(spark.range(30_001)) == min(4, 4 * spark.sparkContext.defaultParallelism) and tasks_for(spark.range(1_000_000), 10_000) >= 100 and tasks_for(spark.range(0)) == 1
    assert "RepartitionByExpression" in _plan(registry.QUERIES["typed_ids"](spark, "/root/testdata/sf0.001"))


def test_relations_and_their_steps_are_dealt_by_number(spark):
    for name in ("claim_relations", "transitive_edges"):
        assert "RepartitionByExpression" in _plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_an_id_in_several_rows_shares_a_key_once(spark):
    rows = spark.createDataFrame([(1, ["k"]), (1, ["k"]), (2, ["k"]), (2, ["m"]), (3, ["m"]), (3, ["k"])], "id long, keys array<string>")
    assert {tuple(r) for r in dd.block_pairs(rows, F.col("keys"), "g", shared=2).collect()} == {(2, 3, "g")}


def test_claims_move_without_their_words(spark):
    """What a claim says of itself travels to its concept as one number."""
    c, s, k = _evidence_input(spark)
    lines = ev.evidence(c, s, k)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    moved = lines[next(i for i, x in enumerate(lines) if "RepartitionByExpression" in x) + 1]
    assert "code" in moved and "stance" not in moved.split("AS code")[-1] and " AS w#" not in moved
    odd = spark.createDataFrame([(1, 1, None, None, None, None, None), (1, 1, "odd", "qualifies", 0.5, True, 0.5), (2, 2, "marketing", "contradicts", 0.5, True, 0.5)], c.schema)
    got = {r.concept_id: (r.claims, r.highest_tier, r.supporting, r.contradicting, r.secondhand) for r in ev.evidence(odd, s, k).collect()}
    assert got == {1: (2, None, 0, 0, True), 2: (1, "marketing", 0, 1, True)}


def test_pairs_of_a_common_name_are_no_rows(spark, monkeypatch):
    rng = random.Random(12)
    some = lambda xs, n: rng.choice([None, [], rng.sample(xs, rng.randrange(1, n))])
    vector = lambda: rng.choice([None, [0.0, 0.0, 0.0], [float(rng.randrange(-2, 3)) for _ in range(3)]])
    name = lambda: rng.choice(["Big", "big ", "big", "big", f"small {rng.randrange(9)}", "none", None])
    claims = [(k, name(), rng.choice(["big words", "small 3", None]), rng.choice([*"xyz", None]), rng.choice(["p", "q", None]), some(["e", "f", "g", None], 4), vector()) for k in range(90)]
    concepts = [(k, rng.choice(["big", "small 3", "big words of old", "", "other"]), some(["big", "Small 4 ", "small 5"], 3), rng.choice([*"xy", None]), some(["p", "q", "r"], 3), some(["e", "f", "h", None], 4), vector()) for k in range(1000, 1160)]
    q = spark.createDataFrame(claims, "claim_id long, subject string, statement string, domain string, predicate string, entities array<string>, vector array<double>")
    c = spark.createDataFrame(concepts, "concept_id long, title string, aliases array<string>, domain string, predicates array<string>, entities array<string>, vector array<double>")
    every = kn.resolution_candidates(q, c, near=3, siblings=2).cache()
    by = lambda how: F.count_if(F.array_contains("by", how)).alias(how)
    want = kn.resolve_claims(every).join(every.groupBy("claim_id").agg(F.count("*").alias("candidates"), by("vector"), by("alias"), by("sibling")), "claim_id")
    for limit, tile in (("_NAMED_PAIRS", 50), ("_CLAIM_TILE", 7), ("_CONCEPT_TILE", 20)):
        monkeypatch.setattr(kn, limit, tile)
    scratch = Scratch(spark, "t")
    got = kn.resolve_among(q, c, scratch, near=3, siblings=2)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and want.count() > 50
    kept = spark.read.parquet(f"{scratch.root}/*candidates").count()
    assert kept < 0.4 * every.count()
    # the query doesn't form them either
    monkeypatch.setattr(kn, "resolution_candidates", None)
    assert registry.QUERIES["claim_candidates"](spark, "/root/testdata/sf0.001").count() == 50


def test_shingles_move_once_and_then_only_those_of_pairs(spark, monkeypatch):
    rng = random.Random(13)
    base = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(30)) for _ in range(12)]
    texts = [(k, rng.choice(["s", "t", None]), base[k % 12] + rng.choice([" end of it", " other end", "", ""]) * (k % 3)) for k in range(80)] + [(90, "s", "lone words that nobody else has said"), (91, "s", None), (92, "t", "two words")]
    d = spark.createDataFrame(texts, "id long, creator string, text string")
    saved = {}

    class Kept(Scratch):
        def save(self, df, name, **options):
            plan = df._jdf.queryExecution().executedPlan().toString()
            saved[name] = plan, super().save(df, name, **options)
            return saved[name][1]

    def run():
        saved.clear()
        members, classes = dd.echo_classes(d, scratch := Kept(spark, "t"))
        found = dd.echo_pairs(classes, scratch)
        return tuple(sorted(map(tuple, x.collect()), key=repr) for x in (members, classes.select("id", "n", "lo", "hi"), found))

    monkeypatch.setattr(dd, "_LOOKED_UP", 0)
    want = run()
    monkeypatch.undo()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = run()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    creators = {k: c for k, c, _ in texts}
    for class_id in {m[2] for m in got[0]}:
        own = sorted(creators[m[0]] for m in got[0] if m[2] == class_id and creators[m[0]])
        assert [c[2:] for c in got[1] if c[0] == class_id] == [(own[0], own[-1]) if own else (None, None)]
    assert got == want and got[2] and "sets" not in saved and "ReusedExchange" in saved["prefix"][0]
    met = {x for r in saved["pairs"][1].collect() for x in r}
    assert {r.id for r in saved["compared"][1].collect()} == met and 90 not in met


def test_rounds_send_no_large_table_to_the_driver(spark):
    name = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before, seen = spark.conf.get(name, None), []

    class Kept(Scratch):
        def save(self, df, label, **options):
            seen.append((spark.conf.get(name, None), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")))
            return super().save(df, label, **options)

    e = spark.createDataFrame([(1, "causes", 2), (2, "causes", 1), (2, "causes", 3)], "subject_id long, predicate string, object_id long")
    got = g.cycle_review(e, e.where("subject_id = 1"), Kept(spark, "t"))
    assert set(seen) == {("64k", "64k")} and spark.conf.get(name, None) == before and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("64k", 65536)
    assert list(map(tuple, got.collect())) == [(1, 2, 2, 1, True)]


def test_claims_are_dealt_by_their_number(spark, monkeypatch):
    c, s, k = _evidence_input(spark)
    monkeypatch.setattr(ev, "tasks_for", lambda claims: 77 if claims is c else None)
    dealt = [x for x in ev.evidence(c, s, k)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in x]
    assert sorted(x.split("[")[1].split("#")[0] for x in dealt) == ["concept_id", "source_id", "source_id"] and all(x.rstrip().endswith(", 77") for x in dealt)
