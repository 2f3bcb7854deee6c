"""URL allow and block rules by a sort-merge range join on reversed-host keys."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: After a rule's key, so that it ends the interval of the keys that begin with it.
_END = "\U0010ffff"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """The labels in reverse, each followed by a dot, so that a domain's key begins the keys of all below it."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _deal(batches: Iterator[pa.RecordBatch], bounds: list[str]) -> Iterator[pa.RecordBatch]:
    """Each row once for every key range that its interval from ``key`` to ``last`` meets."""
    for batch in batches:
        rows, buckets = [], []
        for k, (key, last) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            lo = bisect_right(bounds, key)
            for b in range(lo, (lo if last == key else bisect_right(bounds, last)) + 1):
                rows.append(k)
                buckets.append(b)
        kept = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), kept.column(0), *kept.columns[2:]], ["bucket", "key", *batch.schema.names[2:]])


def _sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and key, a rule before the urls it covers; the stack holds the nested active rules."""
    stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []
    bucket = None
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in ("bucket", "key", "host", "path", "verdict")}
        at, rules, verdicts = [], [], []
        for k, (b, key, host, path, verdict) in enumerate(zip(*cols.values())):
            if b != bucket:
                bucket, stack = b, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if verdict is not None:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, []))
                _, by_path, lengths = stack[-1]
                # of one rule given twice with both verdicts, block holds
                if path not in by_path or verdict == "block":
                    by_path[path] = (host + path, verdict)
                if len(path) not in lengths:
                    lengths.append(len(path))
                continue
            best = None
            for _, by_path, lengths in stack:
                for n in lengths:
                    if (found := by_path.get(path[:n])) and len(path) >= n and (best is None or len(found[0]) >= len(best[0])):
                        best = found
            at.append(k)
            rules.append(best and best[0])
            verdicts.append(best[1] if best else default)
        kept = batch.take(pa.array(at, pa.int64())).select(["id", "url", "host", "path"])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["id", "url", "host", "path", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", *, default: str = "allow", rows_per_bucket: int = 100_000) -> DataFrame:
    """One row ``(id, url, host, path, rule, verdict)`` per row of ``pages``.

    ``rules`` has rows ``(host, path, verdict)``, verdict ``allow`` or ``block``. A rule fits its host and all
    subdomains where the url's path starts with the rule's. Of the rules that fit, the longest (host and path
    together, then host) decides; without any, rule is null and the verdict ``default``. If one rule is given
    with both verdicts, block holds; rules with a null part are ignored. A url that is null or has no ``://``
    has empty host and path, which only a rule with both empty fits. Repeated rows and null ids keep their
    rows; an empty table of pages gives an empty result; other columns are ignored.

    A rule's reversed-host key opens an interval of keys; intervals are nested or disjoint. Urls are dealt into
    key ranges of about ``rows_per_bucket`` rows (the bounds come from a sample and decide only the balance),
    a rule goes to every range that its interval meets, and one sweep over each sorted range keeps the active
    rules on a stack. A key ends with the path and a hash of the row's place, so a hot host, one url, or one row repeated, is
    dealt over several ranges.
    """
    u = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    u = u.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    u = u.withColumn("key", F.concat(host_key(F.col("host")), F.lit("/"), F.col("path"), F.lit("\u0001"), F.hex(F.xxhash64("id", "url", F.monotonically_increasing_id()))))
    total = u.count()
    n = max(1, min(10_000, max(-(-total // rows_per_bucket), min(64, total // 50))))
    bounds: list[str] = []
    if n > 1:
        share = min(1.0, 30 * n / total)
        sample = sorted(r[0] for r in u.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20))).select("key").limit(40 * n).collect())
        bounds = sorted({sample[k * len(sample) // n] for k in range(1, n)} if sample else set())
    url_rows = u.select("key", F.col("key").alias("last"), "id", "url", "host", "path", F.lit(None).cast("string").alias("verdict"))
    r = rules.where("host is not null and path is not null and verdict is not null")
    r = r.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").withColumn("key", host_key(F.col("host")))
    rule_rows = r.select("key", F.concat("key", F.lit(_END)).alias("last"), F.lit(None).cast(u.schema["id"].dataType).alias("id"), F.lit(None).cast("string").alias("url"), "host", "path", "verdict")
    both = url_rows.unionByName(rule_rows)
    dealt = both.mapInArrow(lambda it: _deal(it, bounds), T.StructType([T.StructField("bucket", T.LongType()), *both.drop("last").schema]))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "key", F.col("verdict").isNull())
    out = u.select("id", "url", "host", "path").schema.add("rule", "string").add("verdict", "string")
    return dealt.mapInArrow(lambda it: _sweep(it, default), out)


#: The rules of the contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

RULES_SQL = r"""
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
numbered AS (SELECT *, row_number() OVER () AS n FROM parsed),
fits AS (
  SELECT p.n, arg_max(r.rhost || r.rpath, length(r.rhost || r.rpath)) AS rule, arg_max(r.verdict, length(r.rhost || r.rpath)) AS verdict
  FROM numbered p JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
  GROUP BY p.n
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM numbered p LEFT JOIN fits f ON p.n = f.n
"""
