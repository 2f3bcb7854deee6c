"""Signals, states, storage and exports at shapes that the queries' tables don't have."""

import random

import pytest
from pyspark.sql import functions as F

from assay.functions import columns as fc
from assay.operators import graph as g, knowledge as kn, ops, validate as va
from assay.scratch import Scratch
from assay.sources import transcripts as tr


def test_bursts_around_high_reach(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"p{rng.randrange(4)}", k, rng.randrange(12), rng.choice([1, 50, 200]), f"2024-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d}") for k in range(300)]
    d = spark.createDataFrame(rows + [(None, 900, 1, 500, "2024-01-01"), ("hot", 901, None, 500, "2024-01-01"), ("hot", 902, 3, 500, None)], "phrase string, claim_id long, creator_id long, reach int, at string").withColumn("at", F.col("at").cast("date"))
    bursts, links = ops.echo_bursts(d, 100, 10, 3)
    import datetime

    day = lambda s: datetime.date.fromisoformat(s).toordinal()
    want, pairs = {}, set()
    for phrase, claim, creator, reach, at in rows:
        if reach >= 100:
            others = {c for p, _, c, _, t in rows if p == phrase and c != creator and 0 <= day(t) - day(at) <= 10}
            if len(others) >= 3:
                want[claim] = len(others)
                pairs |= {(min(creator, o), max(creator, o)) for o in others}
    assert {r.seed_id: r.followers for r in bursts.collect()} == want and {tuple(r) for r in links.collect()} == pairs


def test_signals_make_groups(spark):
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    s = kn.independence_signals(one([(1, 2), (3, None)], "creator_id long, from_creator long"), one([(2, 1), (4, 5)], "a long, b long"), one([(5, 6), (7, 7)], "a long, b long"), one([(8, "x"), (9, "x"), (6, "x"), (10, None)], "creator_id long, brand string"))
    assert {(r.a, r.b): r.kinds for r in s.collect()} == {(1, 2): ["attribution", "echo"], (4, 5): ["echo"], (5, 6): ["burst"], (6, 8): ["brand"], (6, 9): ["brand"]}
    groups = kn.independence_groups(spark.range(1, 11).withColumnRenamed("id", "creator_id"), s, Scratch(spark, "t"))
    assert {r.creator_id: r.independence_group for r in groups.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 4, 9: 4, 10: 10}


def test_states_compare_by_checksums(spark, tmp_path):
    rows = [(k, f"v{k % 7}", None if k % 5 == 0 else k / 3) for k in range(3000)] + [(None, "x", 1.0)] * 3
    changed = [(k, "new" if k == 77 else v, x) for k, v, x in rows if k != 1234] + [(2000, "v5", 2000 / 3), (None, "x", 1.0), (50_000, "v", None)]
    schema = "id long, v string, x double"
    a, b, c = (str(tmp_path / n) for n in "abc")
    ops.fingerprint(spark.createDataFrame(rows, schema).repartition(3), "id", a, buckets=32, leaves=16)
    ops.fingerprint(spark.createDataFrame(changed, schema).repartition(5), "id", b, buckets=32, leaves=16)
    ops.fingerprint(spark.createDataFrame(rows[::-1], schema).select("x", "id", "v").repartition(2), "id", c, buckets=32, leaves=16)
    same, none = ops.differing(spark, a, c)
    assert none == [] and same.isEmpty()
    found, read = ops.differing(spark, a, b)
    want = ops.set_difference(spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema))
    key = lambda d: sorted(str((r.id, r.v, r.x, r.side)) for r in d.collect())
    assert key(found) == key(want) and len(key(found)) == 6 and 0 < len(read) <= 5


def test_buckets_join_without_moving_and_are_found_alone(spark):
    claims = spark.range(2000).selectExpr("id % 50 AS source_id", "id AS claim_id")
    chunks = spark.range(500).selectExpr("id % 50 AS source_id", "id AS chunk_id")
    tables = {"bucketed_claims": claims, "bucketed_chunks": chunks}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for name, d in tables.items():
            kn.bucket_evidence(d, name, buckets=8)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table("bucketed_claims").join(spark.table("bucketed_chunks"), "source_id")
        assert joined.count() == 20_000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # only then does the plan say how many buckets it reads
        one = kn.source_evidence(spark, "bucketed_claims", 7)
        assert one.count() == 40 and "SelectedBucketsCount: 1 out of 8" in one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_estimates_from_sketches_stay_near_the_truth(spark):
    d = spark.range(200_000).selectExpr("id % 7 AS k", "id % 31 AS day", "hash(id) % 40000 AS v")
    est = ops.distinct_estimates(ops.distinct_sketches(d, ["k", "day"], "v"), ["k"])
    true = {r.k: r.n for r in d.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    got = {r.k: (r.distinct, r.rows) for r in est.collect()}
    assert got.keys() == true.keys() and all(abs(got[k][0] - n) <= 0.04 * n for k, n in true.items()) and sum(r for _, r in got.values()) == 200_000


def test_betweenness_stays_within_its_bound(spark):
    rng = random.Random(3)
    e = [(rng.randrange(60), rng.randrange(60)) for _ in range(150)] + [(k, k + 1) for k in range(100, 140)]
    d = spark.createDataFrame(e, "subject_id long, object_id long")
    exact = {r.id: (r.score, r.bound) for r in g.sampled_betweenness(d, Scratch(spark, "t"), error=0.01).collect()}
    assert all(b == 0 for _, b in exact.values()) and exact[120][0] == pytest.approx(20 * 20)
    rough = {r.id: (r.score, r.bound) for r in g.sampled_betweenness(d, Scratch(spark, "t"), error=0.25).collect()}
    assert all(abs(exact.get(k, (0, 0))[0] - rough.get(k, (0, 0))[0]) <= next(iter(rough.values()))[1] for k in exact.keys() | rough.keys())


def test_ceiling_is_never_below_the_similarity(spark):
    rng = random.Random(4)
    w = ["alpha", "beta", "60", "%", "sixty", "gamma", "it", "is"]
    rows = [(" ".join(rng.choices(w, k=rng.randrange(8))), " ".join(rng.choices(w[: rng.choice([3, 8])], k=rng.randrange(30)))) for _ in range(200)] + [(None, "x"), ("x", None), ("", "")]
    d = spark.createDataFrame(rows, "q string, s string").select(va.quote_ceiling("q", "s").alias("top"), va.quote_similarity("q", "s").alias("real"))
    assert all(r.top >= r.real - 1e-12 for r in d.collect())


def test_claims_come_back_from_their_lines(spark, tmp_path):
    schema = "id string, source_id string, chunk_id string, chunk_sequence int, speaker string, t_start double, t_end double, prompt_version string, findings array<struct<code:string,severity:string>>, repairs map<string,string>, payload struct<claim_type:string,speaker:string,parameters:array<struct<name:string,value:string>>>"
    rows = [("c1", "s", "k", 0, "a", 1.0, None, "v1", [("unit_unknown", "flag")], {"unit": "mm"}, ("causal", "b", [("rh", "60")])), ("c2", "s", "k", 1, None, None, None, "v1", [], {}, ("factual", None, None))]
    d = spark.createDataFrame(rows, schema)
    kn.write_claims(d, str(tmp_path / "claims"))
    flat = kn.claim_lines(d)
    assert flat.columns == ["id", "source_id", "chunk_id", "chunk_sequence", "speaker", "t_start", "t_end", "prompt_version", "findings", "repairs", "claim_type", "parameters"]
    back = kn.read_claims(spark, str(tmp_path / "claims"), flat.schema).orderBy("id").collect()
    assert back == flat.orderBy("id").collect() and back[0].speaker == "b" and back[0].findings == ["unit_unknown"]


def test_front_matter_and_tags(spark):
    row = {"id": "k1", "title": "T", "version": 2, "schema_version": "1", "domain": "ADH", "domain_name": "Adhesion & Cure", "subcategory": "s", "knowledge_type": "principle", "epistemic_status": "settled", "risk_tier": 3, "confidence": 0.9, "confidence_band": "high", "status": "published", "created": "2024-01-01", "updated": "2024-02-01", "claim_count": 7, "other": 1}
    got = kn.export_rows(spark.createDataFrame([row])).first()
    assert got.tags == ["kb/card", "domain/adhesion-cure", "type/principle", "conf/high", "risk/3", "status/published"] and got.type == "knowledge-card" and got.claim_count == 7 and "other" not in got.asDict()


def test_shapes_fans_and_labels(spark):
    d = spark.createDataFrame([("cc curl", "3d", 0.9), ("L plus", "1D", None), ("x curl", "11D", 0.5), (None, None, 0.97)], "c string, f string, q double")
    got = [tuple(r) for r in d.select(fc.curl_shape(F.col("c")), fc.fan_systems(F.col("f")), tr.quality_label(F.col("q"))).collect()]
    assert got == [("CC", ["hybrid", "volume"], "good"), ("L+", ["classic", "hybrid"], "verbatim"), (None, [], "poor"), (None, [], "verbatim")]


def test_verdicts_carried_out(spark):
    rows = [(1, 2, "duplicate", 0.9), (3, 4, "variant", 0.8), (6, 5, "contradictory", 0.7), (5, 6, "contradictory", 0.9), (7, 8, "evolving", 0.99), (9, 10, "distinct", 1.0), (11, 12, "duplicate", 0.69), (13, 14, "what", 0.9)]
    got = kn.adjudicated(spark.createDataFrame(rows, "a_id long, b_id long, verdict string, certainty double"), spark.createDataFrame([(7, 3), (1, 1)], "id long, version int"))
    assert [tuple(r) for r in got["merge"].collect()] == [(1, 2)] and {tuple(r) for r in got["relations"].collect()} == {(4, "subclass_of", 3), (8, "supersedes", 7)}
    assert [tuple(r)[1:] for r in got["contradictions"].collect()] == [(5, 6)] and [tuple(r) for r in got["versions"].collect()] == [(7, 4)]
    assert sorted(r.a_id for r in got["review"].collect()) == [11, 13]
