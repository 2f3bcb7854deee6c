import pytest
from pyspark.sql import functions as F

from assay.functions import columns as fc
from assay.operators import knowledge as kn

SHEET = """# Audit
## SOURCE src_a
- missed_claims: 3
- verbatim_failures: 2
- quote_paraphrased: 1
### clm_1
- verdict: correct
### clm_2
- verdict:
### clm_3
- verdict: `Fabricated`
### clm_4
- verdict: maybe
## SOURCE src_b
### clm_5
text
- verdict: tier_wrong
"""


def test_sheets(spark):
    sources, claims = kn.parse_sheets(spark.createDataFrame([(SHEET,), ("nothing here",)], "sheet string"))
    assert sorted(map(tuple, sources.collect())) == [("src_a", 3, 2, 1), ("src_b", 0, 0, 0)]
    assert sorted(map(tuple, claims.collect())) == [("src_a", "clm_1", "correct"), ("src_a", "clm_3", "fabricated"), ("src_b", "clm_5", "tier_wrong")]


def test_outputs_are_taken_or_quarantined(spark):
    rows = [("a", '{"claims": [{"subject": "x"}]}'), ("b", '{"claims": []}'), ("c", '{"claims": [], "no_claims_reason": "chat"}'), ("d", "{broken"), ("e", '{"claims": 5}')]
    good, bad = kn.parse_outputs(spark.createDataFrame(rows, "chunk_id string, line string"), "no_claims_reason string, claims array<struct<subject:string>>")
    assert sorted(r.chunk_id for r in good.collect()) == ["a", "c"]
    assert sorted(map(tuple, bad.collect())) == [("b", "extraction_failure"), ("d", "schema_violation"), ("e", "schema_violation")]


def test_evidence_is_partitioned_by_source(spark, tmp_path):
    d = spark.range(100).selectExpr("concat('s', id % 10) AS source_id", "id AS n")
    kn.write_evidence(d, f"file://{tmp_path}/e", buckets=8)
    back = spark.read.parquet(f"file://{tmp_path}/e")
    assert back.count() == 100 and back.groupBy("source_id").agg(F.count_distinct("source_bucket").alias("n")).where("n > 1").isEmpty()


@pytest.mark.parametrize("text,mm", [(".07", 0.07), ("07", 0.07), ("0.07 mm", 0.07), ("0.15mm", 0.15), ("7", None), ("thick", None)])
def test_diameter(spark, text, mm):
    assert spark.createDataFrame([(text,)], "t string").select(fc.diameter_mm(F.col("t"))).first()[0] == mm


def test_small_columns(spark):
    d = spark.createDataFrame([(75.4, 212.0, "°F", "“a” ‘b’"), (None, 20.0, "°C", "x")], "s double, v double, u string, t string")
    rows = d.select(fc.clock(F.col("s")), fc.celsius(F.col("v"), F.col("u")), fc.straight_quotes(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("01:15", 100.0, "\"a\" 'b'"), ("--:--", 20.0, "x")]


def test_ids(spark):
    d = spark.createDataFrame([("x", "y", "Ångström ﬁne of ½ the Day")], "a string, b string, t string")
    r = d.select(fc.pair_id("ctr", F.col("a"), F.col("b")).alias("p"), fc.pair_id("ctr", F.col("b"), F.col("a")).alias("q"), fc.content_id("c", F.col("a"), F.col("b")).alias("c"), fc.slugify(F.col("t")).alias("s")).first()
    assert r.p == r.q and r.p.startswith("ctr_") and len(r.c) == 14 and r.s == "angstrom-fine-12-day"
