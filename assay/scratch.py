"""Intermediate tables in the folder that every executor shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset and all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "local")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="assay-")
    return _LOCAL[app]


def tasks_for(df: DataFrame, rows: int = 250_000) -> int:
    """How many tasks give each about ``rows`` rows of ``df``: four a core at least, as far as there are rows, however few bytes they have."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(4 * cores, -(-n // 10_000)), -(-n // rows))


#: Size of the tables that jobs of many rounds still send whole to the driver and to all tasks.
_BROADCAST = "64k"


def in_rounds(job: Callable) -> Callable:
    """For a job of many rounds over its first argument, a DataFrame: larger tables are joined by shuffles in it, so what its rounds send to the driver doesn't grow with them."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")

    @wraps(job)
    def run(df: DataFrame, *args, **kwargs):
        conf = df.sparkSession.conf
        before = {n: conf.get(n, None) for n in names}
        for n in names:
            conf.set(n, _BROADCAST)
        try:
            return job(df, *args, **kwargs)
        finally:
            for n, v in before.items():
                conf.unset(n) if v is None else conf.set(n, v)

    return run


class Scratch:
    """Writes DataFrames as Parquet below the shared folder, which cuts their lineage.

    A lost executor costs only the tasks that ran on it: what was written before is read again
    by whoever needs it. ``drop`` removes tables that later steps no longer read.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/assay/{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None, **options) -> DataFrame:
        path = self.path(name)
        writer = df.write.options(**options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for t in tables:
            if path := getattr(t, "_scratch_path", None):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)
