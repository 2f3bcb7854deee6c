"""Streams replayed over the events table, each beside the SQL of what the watermark lets out."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.scratch import Scratch
from assay.sources.star import table
from assay.streaming import flows

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _arrivals(spark, sf_dir, name):
    stored = table(spark, sf_dir, name)
    if stored.inputFiles()[0].endswith(f"/{name}.parquet"):  # one file: the stream watches its folder
        return flows.arrivals(spark, sf_dir, stored.schema, pathGlobFilter=f"{name}.parquet")
    return flows.arrivals(spark, f"{sf_dir}/{name}.parquet", stored.schema)


def _events(spark, sf_dir):
    return _arrivals(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _replay(spark, stream, label):
    scratch = Scratch(spark, label)
    path = scratch.path("out")
    flows.run_once(stream, path, scratch.path("checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


@query(
    """WITH g AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events), r AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 1 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
    SELECT user_id, count(*) AS events, min(ts) AS first, max(ts) AS last FROM r GROUP BY user_id, n HAVING max(ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""
)
def stream_sessions(spark, sf_dir):
    d = _replay(spark, flows.sessions(_events(spark, sf_dir), "user_id", "ts", "1 day", "1 hour"), "sessions")
    return d.select("user_id", F.col("rows").alias("events"), F.col("first").cast("timestamp_ntz").alias("first"), F.col("last").cast("timestamp_ntz").alias("last"))


@query(
    """WITH d AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, value FROM events) SELECT event_type, day, count(*) AS events, round(avg(value) + 1e-9, 6) AS mean, max(value) AS largest FROM d WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2"""
)
def stream_metrics(spark, sf_dir):
    d = _replay(spark, flows.stage_metrics(_events(spark, sf_dir), "ts", "1 day", "1 hour", key="event_type", value="value"), "metrics")
    return d.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("day"), F.col("rows").alias("events"), F.round(F.col("mean") + 1e-9, 6).alias("mean"), "largest")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, sf_dir):
    """The first event of each kind of each user lets the key through, all later ones are dropped; the horizon is longer than the stream."""
    s = _events(spark, sf_dir).withColumn("key", F.concat_ws("|", F.col("user_id").cast("string"), "event_type"))
    return _replay(spark, flows.first_seen(s, "key", "ts", "3650 days"), "first").select("user_id", "event_type")


@query("SELECT l_partkey AS concept_id, count(*) AS claims, count(DISTINCT l_suppkey % 25) AS groups FROM lineitem GROUP BY l_partkey")
def stream_evidence(spark, sf_dir):
    """Claims replayed into state: what is kept per concept equals the batch's distinct count."""
    claims = _arrivals(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("concept_id"), (F.col("l_suppkey") % 25).cast("string").alias("gkey"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    with flows.with_state_store(spark):
        return flows.current_evidence(_replay(spark, flows.running_evidence(claims), "evidence"))
