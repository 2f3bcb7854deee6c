"""Streams give what the batch job gives, once, however often they are run."""

from pyspark.sql import functions as F

from assay.streaming import flows


def test_append_once_and_recompute(spark, tmp_path):
    src, schema = tmp_path / "in", "claim_id string, concept_id string, gkey string"
    spark.sql("DROP TABLE IF EXISTS stream_claims")
    rows = [("c1", "k1", "a"), ("c2", "k1", "b"), ("c1", "k1", "a"), ("c3", "k2", "a")]
    spark.createDataFrame(rows[:3], schema).coalesce(1).write.mode("append").parquet(str(src))
    sink = flows.append_once("stream_claims", "claim_id")
    counts = lambda d: d.groupBy("concept_id").agg(F.count("*").alias("claims"), F.count_distinct("gkey").alias("groups"))
    again = flows.recompute_touched("stream_claims", str(tmp_path / "out"), "concept_id", counts)
    try:
        for n in (1, 2):
            flows.each_batch(flows.arrivals(spark, str(src), schema), sink, str(tmp_path / "ck1"))
            flows.each_batch(flows.arrivals(spark, str(src), schema), again, str(tmp_path / "ck2"))
            if n == 1:
                spark.createDataFrame(rows[3:] + rows[:1], schema).coalesce(1).write.mode("append").parquet(str(src))
        assert spark.table("stream_claims").count() == 3
        got = {r.concept_id: (r.claims, r.groups) for r in flows.latest(spark, str(tmp_path / "out"), "concept_id").collect()}
        assert got == {"k1": (2, 2), "k2": (1, 1)}
    finally:
        spark.sql("DROP TABLE IF EXISTS stream_claims")


def test_arriving_transcripts_become_chunks_once(spark, tmp_path):
    from assay.operators.chunks import segment

    src, schema = tmp_path / "in", "source_id string, suffix string, content string"
    spark.sql("DROP TABLE IF EXISTS stream_chunks")
    rows = [("a", "txt", "One paragraph.\n\nAnother one."), ("b", "vtt", "WEBVTT\n\n00:00:01.0 --> 00:00:02.0\nhello")]
    sink = flows.transcripts_to_chunks("stream_chunks", segment)
    try:
        for part in (rows, rows[:1]):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(src))
            flows.each_batch(flows.arrivals(spark, str(src), schema), sink, str(tmp_path / "ck"))
        got = spark.table("stream_chunks").orderBy("chunk_id").collect()
        assert [(r.source_id, r.raw_text) for r in got] == [("a", "One paragraph. Another one."), ("b", "hello")]
    finally:
        spark.sql("DROP TABLE IF EXISTS stream_chunks")


def test_running_evidence_survives_a_restart(spark, tmp_path):
    """Claims come in five folders' worth of files, the query stops after each; counts equal the batch's, settled shards say so, and nothing is counted twice."""
    import datetime
    import random

    rng, src, ck, out = random.Random(1), str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out")
    schema, every = "concept_id long, gkey string, ts timestamp", []
    with flows.with_state_store(spark):
        for day in range(5):
            rows = [(0 if rng.random() < 0.5 else rng.randrange(1, 6), rng.choice([None, *"abcdefghijkl"]), datetime.datetime(2024, 1, 1 + day, rng.randrange(24))) for _ in range(60)]
            rows = [r for r in rows if r[0] != 5 or day == 0]  # concept 5 comes on the first day only
            every += rows
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
            for _ in range(2):  # the second run finds nothing new
                flows.run_once(flows.running_evidence(flows.arrivals(spark, src, schema), rest=3600, shards=3), out, ck)
    found = spark.read.parquet(out)
    got = {r.concept_id: (r.claims, r["groups"]) for r in flows.current_evidence(found).collect()}
    assert got == {c: (sum(x == c for x, _, _ in every), len({g for x, g, _ in every if x == c})) for c in {r[0] for r in every}}
    assert found.groupBy("concept_id", "shard", "version").count().where("count > 1").isEmpty()
    assert found.where("concept_id = 5 and settled").select("shard").distinct().count() == found.where("concept_id = 5").select("shard").distinct().count() > 0


def test_few_groups_take_one_read_and_one_write(monkeypatch):
    """Groups lie beside the counts until there are too many, then in the map; counts stay right across the change."""
    import datetime
    from types import SimpleNamespace

    calls, held, stored = [], {}, {}
    value = SimpleNamespace(get=lambda: calls.append("get") or held.get("v"), update=lambda v: calls.append("update") or held.update(v=v))
    groups = SimpleNamespace(keys=lambda: calls.append("keys") or iter(stored), containsKey=lambda k: calls.append("has") or k in stored, updateValue=lambda k, v: calls.append("put") or stored.update({k: v}))
    timers = {"registerTimer": lambda t: None, "deleteTimer": lambda t: None}
    p = flows.RunningEvidence(60)
    p.init(SimpleNamespace(getValueState=lambda *_: value, getMapState=lambda *_: groups, **timers))
    monkeypatch.setattr(flows, "_FEW", 5)
    at, every = datetime.datetime(2024, 1, 1), []
    for batch in (["a", "b", "a"], ["b", "c", "d"], ["e", "f"], ["a"], ["g", "f", "h"]):
        every += batch
        row = next(iter(p.handleInputRows((1, 0), [{"gkey": g, "ts": at} for g in batch], None)))
        assert (row.claims, row.asDict()["groups"]) == (len(every), len(set(every)))
        if len(set(every)) <= 5:
            assert calls == ["get", "update"] and not stored
        calls.clear()
    assert {g for (g,) in stored} == set(every)
