"""Incremental flows with Structured Streaming; each gives what the batch job gives over the same rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery


def arrivals(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """Files as they come into a folder."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def first_seen(stream: DataFrame, key: str, time: str, horizon: str) -> DataFrame:
    """Rows whose key wasn't seen within the horizon; beyond it, ``append_once`` holds against the stored table."""
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark([key])


def sessions(stream: DataFrame, key: str, time: str, gap: str, late: str) -> DataFrame:
    """Rows of a key with no gap of ``gap`` and more between them, once the watermark has passed; later rows are dropped."""
    return stream.withWatermark(time, late).groupBy(F.col(key), F.session_window(time, gap).alias("w")).agg(F.count("*").alias("rows"), F.min(time).alias("first"), F.max(time).alias("last"))


def stage_metrics(stream: DataFrame, time: str, window: str, late: str, slide: str | None = None, *, key: str, value: str) -> DataFrame:
    """Count, mean and largest value per key and window of time (tumbling, or sliding with ``slide``)."""
    w = F.window(time, window, slide) if slide else F.window(time, window)
    return stream.withWatermark(time, late).groupBy(F.col(key), w.alias("w")).agg(F.count("*").alias("rows"), F.avg(value).alias("mean"), F.max(value).alias("largest"))


EVIDENCE = "concept_id long, shard int, claims long, groups long, version long, settled boolean"


#: Groups of a shard that are kept beside its counts; every call to the state store is a message of its own.
_FEW = 256


class RunningEvidence(StatefulProcessor):
    """Per shard of a concept: how many claims and which groups have come so far.

    Up to ``_FEW`` groups lie beside the counts, read and written with them at once; more are a map in the state store, a key each, so what a batch then writes is its new groups. Each batch
    that brings claims gives a row with the counts so far; once the watermark has passed the newest claim by ``rest`` seconds, a last
    row says that the shard has settled, until new claims come.
    """

    def __init__(self, rest: int):
        self.rest = rest

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "claims long, groups long, version long, newest long, few array<string>")
        self.groups = handle.getMapState("groups", "gkey string", "since long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        claims, groups, version, newest, few = self.counts.get() or (0, 0, 0, -1, [])
        seen, latest = Counter(), newest
        for row in rows:
            seen[row["gkey"]] += 1
            latest = max(latest, int(row["ts"].timestamp() * 1000))
        if few is not None:
            known = set(few)
        elif groups <= 4 * len(seen):  # read at once
            known = {g for (g,) in self.groups.keys()}
        else:
            known = {g for g in seen if self.groups.containsKey((g,))}
        new = seen.keys() - known
        groups += len(new)
        if few is not None and groups <= _FEW:
            few = sorted(known | new)
        else:
            for gkey in new if few is None else known | new:
                self.groups.updateValue((gkey,), (version,))
            few = None
        if latest > newest:
            if newest >= 0:
                self.handle.deleteTimer(newest + self.rest * 1000)
            self.handle.registerTimer(latest + self.rest * 1000)
        claims, version = claims + sum(seen.values()), version + 1
        self.counts.update((claims, groups, version, latest, few))
        yield Row(concept_id=key[0], shard=key[1], claims=claims, groups=groups, version=version, settled=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        claims, groups, version, newest, few = self.counts.get()
        self.counts.update((claims, groups, version + 1, newest, few))
        yield Row(concept_id=key[0], shard=key[1], claims=claims, groups=groups, version=version + 1, settled=True)

    def close(self) -> None:
        pass


def running_evidence(stream: DataFrame, *, late: str = "1 hour", rest: int = 86_400, shards: int = 1) -> DataFrame:
    """Rows ``(concept_id, shard, claims, groups, version, settled)`` as claims ``(concept_id, gkey, ts)`` come: claims and distinct groups so far.

    A null group is a group of its own kind, counted once. Claims later than the watermark count too, as none is dropped here. ``shards``
    splits the state of a concept by a hash of the group, so that a concept with a third of all claims isn't one task's; ``current_evidence`` adds the
    shards up. The store must be RocksDB (``with_state_store``).
    """
    keyed = stream.select("concept_id", F.coalesce("gkey", F.lit("")).alias("gkey"), "ts").withColumn("shard", F.pmod(F.xxhash64("gkey"), F.lit(shards)).cast("int")).withWatermark("ts", late)
    return keyed.groupBy("concept_id", "shard").transformWithState(RunningEvidence(rest), EVIDENCE, "Append", "EventTime")


def current_evidence(found: DataFrame) -> DataFrame:
    """Rows ``(concept_id, claims, groups)``: the newest row of each shard, summed; re-run batches repeat a version and change nothing."""
    newest = found.groupBy("concept_id", "shard").agg(F.max_by(F.struct("claims", "groups"), "version").alias("n"))
    return newest.groupBy("concept_id").agg(F.sum("n.claims").alias("claims"), F.sum("n.groups").alias("groups"))


@contextmanager
def with_state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that arbitrary state needs, for the queries started inside."""
    name, store = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, store)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def append_once(table: str, key: str) -> Callable[[DataFrame, int], None]:
    """A sink that adds only rows whose content id the stored table doesn't have, so a batch that is run again adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key])
        if spark.catalog.tableExists(table):
            new = new.join(spark.table(table).select(key), key, "left_anti")
        new.write.mode("append").saveAsTable(table)

    return write


def recompute_touched(facts: str, result_path: str, key: str, job: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A sink that recomputes the whole group of every key that a batch touches from the stored facts; results carry the batch's number.

    The newest number of a key holds (``latest``), so the outcome doesn't depend on the order of arrival.
    """

    def write(batch: DataFrame, number: int) -> None:
        touched = batch.select(key).distinct()
        every = batch.sparkSession.table(facts).join(touched, key, "left_semi")
        job(every).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{result_path}/batch={number}")

    return write


def latest(spark: SparkSession, result_path: str, key: str) -> DataFrame:
    d = spark.read.parquet(result_path)
    newest = d.groupBy(key).agg(F.max("batch").alias("batch"))
    return d.join(newest, [key, "batch"], "left_semi")


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that has come, then stop."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def each_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def transcripts_to_chunks(table: str, segment: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A sink for arriving transcript files ``(source_id, suffix, content)``: parsed, segmented and added once, by source and sequence.

    The same functions as in batch run on each batch; a source that was stored before adds nothing.
    """
    from assay.sources.transcripts import parse_transcripts

    add = append_once(table, "chunk_id")

    def write(batch: DataFrame, number: int) -> None:
        cues, _ = parse_transcripts(batch.dropDuplicates(["source_id"]))
        add(segment(cues).withColumn("chunk_id", F.concat_ws("#", "source_id", "sequence")), number)

    return write
