"""The evidence star over relational tables: orders are sources, line items claims, parts concepts, customers creators.

Every column is an expression that Spark and ANSI SQL engines read alike, so a query and its SQL start from
the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES: dict[str, tuple[str, list[str]]] = {
    "creators": (
        "customer",
        [
            "c_custkey AS creator_id",
            "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS independence_group",
            "(c_acctbal + 1000e0) / 11000e0 AS reliability",
            "c_mktsegment AS segment",
        ],
    ),
    "sources": (
        "orders",
        [
            "o_orderkey AS source_id",
            "o_custkey AS creator_id",
            "CAST(o_orderdate AS DATE) AS published_at",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'own_product' WHEN '2-HIGH' THEN 'sponsored' WHEN '3-MEDIUM' THEN 'affiliate' ELSE 'organic' END AS commercial_context",
            "0.5e0 + (o_orderkey % 50) / 100e0 AS asr_confidence",
            "CASE o_orderkey % 4 WHEN 0 THEN 'verbatim' WHEN 1 THEN 'good' WHEN 2 THEN 'fair' ELSE 'poor' END AS transcript_quality",
            "CASE o_orderkey % 6 WHEN 0 THEN 'lecture' WHEN 1 THEN 'interview' WHEN 2 THEN 'panel' WHEN 3 THEN 'monologue' WHEN 4 THEN 'demo' ELSE 'short' END AS format",
            "o_orderstatus AS status",
            "o_totalprice AS reach",
        ],
    ),
    "claims": (
        "lineitem",
        [
            "l_orderkey AS source_id",
            "l_partkey AS concept_id",
            "l_suppkey AS speaker_id",
            "l_linenumber AS line",
            "CASE (CAST(l_quantity AS INT) + l_linenumber) % 11 WHEN 0 THEN 'peer_reviewed' WHEN 1 THEN 'regulatory' WHEN 2 THEN 'manufacturer_spec' WHEN 3 THEN 'controlled_test' WHEN 4 THEN 'deliberated_consensus' "
            "WHEN 5 THEN 'structured_experience' WHEN 6 THEN 'expert_assertion' WHEN 7 THEN 'anecdote' WHEN 8 THEN 'hearsay' WHEN 9 THEN 'marketing' ELSE 'folklore' END AS evidence_tier",
            "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'contradicts' WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'qualifies' ELSE 'supports' END AS stance",
            "abs(l_discount) * 10e0 AS hedge_level",
            "l_quantity > 12e0 AS is_reported_from_other",
            "1e0 - l_tax AS extraction_certainty",
            "CAST(l_shipdate AS DATE) AS claimed_at",
            "l_extendedprice AS weight",
        ],
    ),
    "concepts": (
        "part",
        [
            "p_partkey AS concept_id",
            "concat(p_name, ' ', p_brand) AS title",
            "CASE p_type WHEN 'STANDARD' THEN 'ADH' WHEN 'ECONOMY' THEN 'RET' WHEN 'MEDIUM' THEN 'HLT' WHEN 'PROMO' THEN 'MKT' WHEN 'LARGE' THEN 'STY' ELSE 'ANA' END AS domain",
            "p_brand AS category",
            "CASE WHEN p_size > 40 THEN p_size % 5 ELSE 0 END AS risk_tier",
            "p_size % 2 = 0 AS has_parameters",
            "p_size % 3 = 0 AS has_conditions",
            "p_size % 5 = 0 AS has_mechanism",
            "p_size % 7 = 0 AS has_implementation_steps",
            "p_size % 11 = 0 AS unresolved_contradiction",
            "CAST('1995-01-01' AS DATE) + CAST(p_size AS INT) AS first_seen",
            "p_size AS size",
            "p_retailprice AS value",
        ],
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = TABLES[name]
    return table(spark, sf_dir, source).selectExpr(*columns)


def star_sql(*names: str) -> str:
    """The same tables as the start of a WITH clause."""
    return ",\n".join(f"{n} AS (SELECT {', '.join(TABLES[n][1])} FROM {TABLES[n][0]})" for n in names)
