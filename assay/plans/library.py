"""Retrieval and bookkeeping queries, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from assay import vocab
from assay.functions import columns as fc
from assay.operators import evidence as ev, ops, retrieve as rt
from assay.plans.evidence import _EVIDENCE, AS_OF, case, cards
from assay.scratch import tasks_for
from assay.sources.star import star, star_sql, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _near(spark, sf_dir, k):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 20 = 0").selectExpr("vec_id AS query", "embedding AS vector")
    return rt.nearest(q, e.selectExpr("vec_id AS id", "embedding AS vector"), k)


_COS = "list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[]))"


@query(
    f"""WITH s AS (SELECT q.vec_id AS query, v.vec_id AS id, {_COS} AS score FROM embeddings q JOIN embeddings v ON q.vec_id % 20 = 0)
    SELECT query, id, round(score + 1e-9, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY round(score, 12) DESC, id) AS rank FROM s QUALIFY rank <= 15"""
)
def nearest_vectors(spark, sf_dir):
    """The 15 nearest of all vectors for every twentieth vector."""
    return _near(spark, sf_dir, 15).select("query", "id", F.round(F.col("score") + 1e-9, 6).alias("score"), "rank")


_BM25_SQL = r"""d AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
    size AS (SELECT count(*) AS n_docs, avg(len(w)) AS mean_len FROM d),
    terms AS (SELECT DISTINCT item_id AS query, unnest(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS term FROM benchmark),
    x AS (SELECT id, len(w) AS len, unnest(w) AS term FROM d),
    tf AS (SELECT term, id, len, count(*) AS tf FROM x WHERE term IN (SELECT term FROM terms) GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    s AS (SELECT query, id, sum(ln(1 + (n_docs - df + 0.5e0) / (df + 0.5e0)) * tf * 2.2e0 / (tf + 1.2e0 * (0.25e0 + 0.75e0 * len / mean_len))) AS score FROM terms JOIN tf USING (term) JOIN df USING (term), size GROUP BY ALL)"""


def _lexical(spark, sf_dir, k):
    q = table(spark, sf_dir, "benchmark").selectExpr("item_id AS query", "text")
    return rt.bm25(q, table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "text"), k)


@query(f"WITH {_BM25_SQL} SELECT query, id, round(score + 1e-9, 5) AS score, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, id) AS rank FROM s QUALIFY rank <= 50")
def lexical_search(spark, sf_dir):
    return _lexical(spark, sf_dir, 50).select("query", "id", F.round(F.col("score") + 1e-9, 5).alias("score"), "rank")


_HITS = "WITH h AS (SELECT item_id AS query, doc_id AS id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"


@query(
    f"""WITH {_BM25_SQL}, runs AS (SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, id) AS rank FROM s QUALIFY rank <= 20),
    gold AS (SELECT item_id AS query, doc_id AS id FROM benchmark b JOIN documents d ON contains(d.text, b.text)), n AS (SELECT query, count(*) AS n FROM gold GROUP BY query),
    per AS (SELECT query, count(*) AS found, sum(CASE WHEN rank <= 10 THEN 1 / log2(rank + 1.0e0) ELSE 0 END) AS dcg, min(rank) AS first FROM runs SEMI JOIN gold USING (query, id) GROUP BY query)
    SELECT count(*) AS queries, round(avg(coalesce(found / n, 0)), 6) AS recall, round(avg(coalesce(dcg / list_sum(list_transform(range(1, CAST(least(n, 10) AS BIGINT) + 1), lambda i: 1 / log2(i + 1.0e0))), 0)), 6) AS ndcg, round(avg(coalesce(1 / first, 0)), 6) AS mrr
    FROM n LEFT JOIN per USING (query)"""
)
def retrieval_eval(spark, sf_dir):
    """Lexical search held against the documents that contain the passage."""
    gold = rt.containing(table(spark, sf_dir, "benchmark").selectExpr("item_id AS query", "text AS passage"), table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "text"))
    d = rt.eval_retrieval(_lexical(spark, sf_dir, 20), gold)
    return d.select("queries", *[F.round(c, 6).alias(c) for c in ("recall", "ndcg", "mrr")])


@query(
    """WITH a AS (SELECT vec_id % 40 AS query, vec_id AS id, row_number() OVER (PARTITION BY vec_id % 40 ORDER BY label, vec_id) AS rank FROM embeddings),
    b AS (SELECT vec_id % 40 AS query, vec_id AS id, row_number() OVER (PARTITION BY vec_id % 40 ORDER BY vec_id DESC) AS rank FROM embeddings WHERE label < 5),
    f AS (SELECT query, id, sum(1 / (60 + rank)) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL)
    SELECT query, id, round(score + 1e-9, 8) AS score, row_number() OVER (PARTITION BY query ORDER BY round(score, 12) DESC, id) AS rank FROM f QUALIFY rank <= 20"""
)
def rank_fusion(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").selectExpr("vec_id % 40 AS query", "vec_id AS id", "label")
    a = e.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("label", "id")))
    b = e.where("label < 5").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("id"))))
    return rt.fuse(a, b).select("query", "id", F.round(F.col("score") + 1e-9, 8).alias("score"), "rank")


_CTX = "SELECT c_custkey AS context_id, 'n' || (c_custkey % 6) AS name, abs(c_acctbal) / 200e0 AS value FROM customer"
_PAR = "SELECT 'n' || (p_size % 6) AS name, p_size - 4e0 AS lo, p_size + 4e0 AS hi, 0.5e0 + p_size / 100e0 AS confidence, p_partkey AS entity_id FROM part"


def _ranges(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS context_id", "concat('n', c_custkey % 6) AS name", "abs(c_acctbal) / 200e0 AS value")
    p = table(spark, sf_dir, "part").selectExpr("concat('n', p_size % 6) AS name", "p_size - 4e0 AS lo", "p_size + 4e0 AS hi", "0.5e0 + p_size / 100e0 AS confidence", "p_partkey AS entity_id")
    return c, p


@query(f"WITH c AS ({_CTX}), p AS ({_PAR}), d AS (SELECT context_id, name, entity_id, row_number() OVER (PARTITION BY context_id, name ORDER BY confidence DESC, entity_id) AS place FROM c JOIN p USING (name) WHERE value BETWEEN lo AND hi AND confidence >= 0.6) SELECT * FROM d WHERE place <= 5")
def matching_parameters(spark, sf_dir):
    return rt.matching_parameters(*_ranges(spark, sf_dir), most=5).select("context_id", "name", "entity_id", "place")


@query(
    f"WITH c AS ({_CTX}), p AS ({_PAR}) SELECT context_id, count(*) AS flags, count(*) FILTER (greatest(lo - value, value - hi) > greatest(hi - lo, 1e-9)) AS high FROM c JOIN p USING (name) WHERE (value < lo OR value > hi) GROUP BY context_id"
)
def context_flags(spark, sf_dir):
    c, p = _ranges(spark, sf_dir)
    return rt.conflict_counts(c, p).groupBy("context_id").agg(F.sum("flags").alias("flags"), F.sum("high").alias("high"))


@query(
    f"""WITH c AS (SELECT c_custkey AS context_id, abs(c_acctbal) % 100 AS rh FROM customer), b(band, lo, hi) AS (VALUES {", ".join(f"('{n}', {a}, {z})" for n, a, z in vocab.CLIMATE_BANDS)})
    SELECT context_id, band FROM c JOIN b ON rh >= lo AND rh < hi"""
)
def climate_bands(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS context_id", "abs(c_acctbal) % 100 AS rh")
    b = spark.createDataFrame(vocab.CLIMATE_BANDS, "band string, lo double, hi double")
    return c.join(F.broadcast(b), (F.col("rh") >= F.col("lo")) & (F.col("rh") < F.col("hi"))).select("context_id", "band")  # five fixed rows


@query(
    _EVIDENCE
    + """, r AS (SELECT domain AS query, concept_id AS id, 0.55e0 * ((concept_id * 7 % 100) / 100e0) + 0.20e0 * confidence + 0.15e0 * consensus + 0.10e0 * recency AS final FROM cards WHERE state = 'published')
    SELECT query, id, round(final + 1e-9, 6) AS final, row_number() OVER (PARTITION BY query ORDER BY round(final, 9) DESC, id) AS place FROM r QUALIFY place <= 8"""
)
def final_rank(spark, sf_dir):
    c = cards(spark, sf_dir).where("state = 'published'").select(F.col("domain").alias("query"), F.col("concept_id").alias("id"), F.expr("(concept_id * 7 % 100) / 100e0").alias("rerank"), "confidence", F.col("consensus").alias("context"), "recency")
    return rt.final_rank(c).select("query", "id", F.round(F.col("final") + 1e-9, 6).alias("final"), "place")


# ---- bookkeeping


@query(
    r"""WITH h AS (SELECT doc_id, sha256(trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g'))) AS content_hash FROM documents)
    SELECT content_hash, min(doc_id) AS source_id, count(*) AS copies FROM h GROUP BY content_hash"""
)
def duplicate_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), fc.content_hash(F.col("text")).alias("content_hash"), F.col("doc_id").alias("registered"))
    return ops.dedup_sources(d).select("content_hash", "source_id", "copies")


@query(
    r"""SELECT doc_id AS source_id, CASE WHEN (doc_id % 100) / 100e0 < 0.1 THEN 'low_asr_confidence' WHEN len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+')) < 200 THEN 'too_short' WHEN lang NOT IN ('en', 'de') THEN 'wrong_language' END AS quarantine_reason FROM documents"""
)
def quarantined_sources(spark, sf_dir):
    from assay.sources.transcripts import quarantine

    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_id"), F.expr("(doc_id % 100) / 100e0 + 0.45e0").alias("asr_confidence"), F.regexp_count("text", F.lit(r"[^ \t\n\r\f\x0B]+")).alias("n_words"), "lang")
    return quarantine(d, languages=("en", "de")).select("source_id", "quarantine_reason")


@query(
    """SELECT 'art_' || substr(sha256('S2-v1' || chr(31) || o_orderkey || chr(31) || 'cfg'), 1, 12) AS artifact_id, o_orderkey AS input_id FROM orders WHERE o_orderkey % 3 <> 0"""
)
def pending_work(spark, sf_dir):
    w = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS input_id")
    done = w.where("input_id % 3 = 0").select(fc.content_id("art", F.lit("S2-v1"), F.col("input_id"), F.lit("cfg")).alias("artifact_id"))
    return ops.pending(w, done, stage_version="S2-v1", config="cfg").select("artifact_id", "input_id")


@query("SELECT doc_id AS object_id FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 = 0")
def stale_embeddings(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("object_id"), F.lit("docs").alias("collection"), F.lit("m2").alias("model_version"), fc.content_hash(F.col("text")).alias("text_hash"))
    stored = d.withColumns({"model_version": F.when(F.col("object_id") % 7 == 0, "m1").otherwise(F.col("model_version")), "text_hash": F.when(F.col("object_id") % 5 == 0, "old").otherwise(F.col("text_hash"))})
    return ops.stale_embeddings(d, stored).select("object_id")


_PRICES = [("alpha", 5.0, 25.0), ("alpha-mini", 1.0, 5.0), ("beta", 3.0, 15.0)]
_USAGE = [
    "l_orderkey AS source_id", "CASE l_returnflag WHEN 'A' THEN 'extract' WHEN 'R' THEN 'resolve' ELSE 'write' END AS stage",
    "CASE l_linenumber % 4 WHEN 0 THEN 'alpha-mini-2025' WHEN 1 THEN 'ALPHA-2' WHEN 2 THEN 'beta-1' ELSE 'gamma' END AS model", "CAST(l_quantity AS BIGINT) * 1000 AS input_tokens",
    "CAST(l_quantity AS BIGINT) * 100 AS output_tokens", "CAST(l_linenumber AS BIGINT) * 500 AS cache_read_tokens", "CAST(l_linenumber AS BIGINT) * 50 AS cache_write_tokens",
]


@query(
    f"""WITH u AS (SELECT {", ".join(_USAGE)} FROM lineitem), c AS (SELECT *, CASE WHEN model = 'alpha-mini-2025' THEN 1e0 WHEN model = 'beta-1' THEN 3e0 ELSE 5e0 END AS pi, CASE WHEN model = 'alpha-mini-2025' THEN 5e0 WHEN model = 'beta-1' THEN 15e0 ELSE 25e0 END AS po FROM u)
    SELECT stage, model, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, round(sum((input_tokens * pi + cache_read_tokens * pi * 0.1e0 + cache_write_tokens * pi * 1.25e0 + output_tokens * po) / 1e6) + 1e-9, 4) AS cost_usd FROM c GROUP BY CUBE (stage, model)"""
)
def usage_cost(spark, sf_dir):
    """Cost by stage, by model and in total."""
    u = table(spark, sf_dir, "lineitem").selectExpr(*_USAGE)
    d = ops.price_usage(u, spark.createDataFrame(_PRICES, "prefix string, price_in double, price_out double"))
    d = d.groupBy("stage", "model").agg(F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("cost_usd").alias("cost_usd"))
    return d.cube("stage", "model").agg(F.sum("calls").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.round(F.sum("cost_usd") + 1e-9, 4).alias("cost_usd"))


@query(
    f"""WITH {star_sql("claims")}, o AS (SELECT *, {case("evidence_tier", {t: i for i, t in enumerate(vocab.TIER_WEIGHT)}, 99)} AS ordinal FROM claims),
    s AS (SELECT *, row_number() OVER (PARTITION BY concept_id, stance ORDER BY ordinal, claimed_at DESC, weight DESC, source_id, line, speaker_id) AS of_stance FROM o),
    p AS (SELECT *, row_number() OVER (PARTITION BY concept_id ORDER BY CAST(of_stance > 3 AS INT), ordinal, claimed_at DESC, weight DESC, source_id, line, speaker_id) AS place FROM s)
    SELECT concept_id, source_id, line, stance, place FROM p WHERE place <= 10"""
)
def claim_selection(spark, sf_dir):
    order = [ev.lookup(F.col("evidence_tier"), {t: i for i, t in enumerate(vocab.TIER_WEIGHT)}, 99), F.desc("claimed_at"), F.desc("weight"), F.col("source_id"), F.col("line"), F.col("speaker_id")]
    return ops.select_claims(star(spark, sf_dir, "claims"), order, per_stance=3, most=10).select("concept_id", "source_id", "line", "stance", "place")


@query(
    """WITH o AS (SELECT p_partkey AS k, p_size AS v FROM part WHERE p_partkey % 11 <> 0), n AS (SELECT p_partkey AS k, CASE WHEN p_size = 5 THEN 6 ELSE p_size END AS v FROM part WHERE p_partkey % 13 <> 0),
    d AS (SELECT CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'deleted' WHEN o.v <> n.v THEN 'changed' ELSE 'same' END AS change FROM o FULL JOIN n ON o.k = n.k),
    c AS (SELECT change, count(*) AS n FROM d GROUP BY change) SELECT change, n, change = 'deleted' AND n > 0.05 * (SELECT count(*) FROM o) AS halt FROM c"""
)
def snapshot_diff(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    old, new = p.where("p_partkey % 11 <> 0").selectExpr("p_partkey AS k", "p_size AS v"), p.where("p_partkey % 13 <> 0").selectExpr("p_partkey AS k", "CASE WHEN p_size = 5 THEN 6 ELSE p_size END AS v")
    return ops.snapshot_diff(old, new, "k")


@query(f"WITH {star_sql('sources')}, n AS (SELECT source_id, format, status, row_number() OVER (PARTITION BY format, status ORDER BY sha256(CAST(source_id AS VARCHAR)), source_id) AS n FROM sources) SELECT source_id, format, status FROM n WHERE n <= 12")
def stratified_seed(spark, sf_dir):
    return ops.stratified(star(spark, sf_dir, "sources"), ["format", "status"], "source_id", 12).select("source_id", "format", "status")


@query(
    """WITH r AS (SELECT o_custkey AS k, o_totalprice AS a, EXTRACT(YEAR FROM o_orderdate) AS b FROM orders), x AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2e0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2e0 AS rb FROM r)
    SELECT count(*) AS n, round(corr(ra, rb), 6) AS spearman FROM x"""
)
def calibration(spark, sf_dir):
    r = table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("a"), F.year("o_orderdate").alias("b"))
    return ops.spearman(r, "a", "b").select("n", F.round("spearman", 6).alias("spearman"))


@query(
    f"""WITH {star_sql("claims", "concepts")}, m AS (SELECT p.domain, EXTRACT(YEAR FROM c.claimed_at) AS period, avg(c.hedge_level) AS mean FROM claims c JOIN concepts p USING (concept_id) GROUP BY ALL),
    d AS (SELECT *, mean - lag(mean) OVER (PARTITION BY domain ORDER BY period) AS change FROM m) SELECT domain, CAST(period AS INT) AS period, round(mean + 1e-9, 6) AS mean, round(change + 1e-9, 6) AS change, coalesce(abs(change) > 0.005, false) AS alert FROM d"""
)
def confidence_drift(spark, sf_dir):
    c = star(spark, sf_dir, "claims").join(star(spark, sf_dir, "concepts").select("concept_id", "domain"), "concept_id")
    d = ops.drift(c.select("domain", F.year("claimed_at").alias("period"), F.col("hedge_level").alias("score")), 0.005)
    return d.select("domain", "period", F.round(F.col("mean") + 1e-9, 6).alias("mean"), F.round(F.col("change") + 1e-9, 6).alias("change"), "alert")


@query(
    """WITH v AS (SELECT l_partkey AS card_id, l_orderkey AS version, l_shipdate AS version_time FROM lineitem), p AS (SELECT o_orderkey AS pin_id, o_orderkey % (SELECT count(*) FROM part) AS card_id, o_orderdate AS pinned_at FROM orders)
    SELECT pin_id, p.card_id, max(v.version_time) AS version_time, arg_max(v.version, (v.version_time, v.version)) AS version FROM p JOIN v ON p.card_id = v.card_id AND v.version_time <= p.pinned_at GROUP BY pin_id, p.card_id"""
)
def cards_as_of(spark, sf_dir):
    n = table(spark, sf_dir, "part").count()
    v = table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS card_id", "l_orderkey AS version", "l_shipdate AS version_time")
    p = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS pin_id", f"o_orderkey % {n} AS card_id", "o_orderdate AS pinned_at")
    return ops.as_of(v, p)


@query(
    """WITH g AS (SELECT event_id, user_id, ts, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events), r AS (SELECT *, sum(CASE WHEN gap >= 86400 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM g)
    SELECT user_id, CAST(run AS BIGINT) AS run, count(*) AS events, min(event_id) AS first_event FROM r GROUP BY ALL"""
)
def gap_runs(spark, sf_dir):
    """Runs of a user's events without a gap of a day."""
    d = ops.gap_runs(table(spark, sf_dir, "events"), "user_id", "ts", 86400)
    return d.groupBy("user_id", "run").agg(F.count("*").alias("events"), F.min("event_id").alias("first_event"))


@query(
    """WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events), w AS (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 172800 PRECEDING AND CURRENT ROW) AS recent FROM e) SELECT event_id, user_id, recent FROM w WHERE recent >= 8"""
)
def bursts(spark, sf_dir):
    return ops.bursts(table(spark, sf_dir, "events"), "user_id", "ts", 172800, 8).select("event_id", "user_id", "recent")


@query(
    f"""WITH {star_sql("claims", "sources")}, f AS (SELECT c.*, s.creator_id FROM claims c JOIN sources s USING (source_id)),
    h AS (SELECT concept_id FROM claims WHERE evidence_tier IN ('peer_reviewed', 'regulatory', 'manufacturer_spec') GROUP BY concept_id)
    SELECT creator_id, count(*) AS claims, count(*) FILTER (concept_id IN (SELECT concept_id FROM h)) AS corroborated, round(0.5e0 + 0.5e0 * count(*) FILTER (concept_id IN (SELECT concept_id FROM h)) / count(*) - 0.5e0 * count(*) FILTER (stance = 'contradicts') / count(*) + 1e-9, 6) AS track_record FROM f GROUP BY creator_id"""
)
def creator_track_record(spark, sf_dir):
    """Up with claims on concepts that strong sources carry, down with claims on the losing side."""
    c = star(spark, sf_dir, "claims").join(star(spark, sf_dir, "sources").select("source_id", "creator_id"), "source_id")
    strong = star(spark, sf_dir, "claims").where(F.col("evidence_tier").isin(*vocab.AUTHORITATIVE_TIERS)).select("concept_id").distinct().withColumn("strong", F.lit(1))
    n = F.count("*")
    d = c.join(strong, "concept_id", "left").groupBy("creator_id").agg(n.alias("claims"), F.count("strong").alias("corroborated"), F.round(0.5 + 0.5 * F.count("strong") / n - 0.5 * F.count_if(F.col("stance") == "contradicts") / n + 1e-9, 6).alias("track_record"))
    return d


@query(f"WITH {star_sql('claims')} SELECT source_id, count(*) AS claims_extracted, count(DISTINCT concept_id) AS cards_touched FROM claims GROUP BY source_id")
def source_contribution(spark, sf_dir):
    return star(spark, sf_dir, "claims").groupBy("source_id").agg(F.count("*").alias("claims_extracted"), F.count_distinct("concept_id").alias("cards_touched"))


@query(
    f"""WITH {star_sql("claims")}, m AS (SELECT 'e' || (speaker_id % 50) AS entity, source_id FROM claims) SELECT entity, count(*) AS mentions, count(DISTINCT source_id) AS sources, count(DISTINCT source_id) >= 3 AS candidate FROM m GROUP BY entity"""
)
def entity_candidates(spark, sf_dir):
    m = star(spark, sf_dir, "claims").selectExpr("concat('e', speaker_id % 50) AS entity", "source_id")
    d = m.groupBy("entity").agg(F.count("*").alias("mentions"), F.count_distinct("source_id").alias("sources"))
    return d.withColumn("candidate", F.col("sources") >= 3)


@query(
    """WITH f AS (SELECT concept_id, min(source_id) AS source_id FROM (SELECT l_partkey AS concept_id, l_orderkey AS source_id FROM lineitem) GROUP BY concept_id), b AS (SELECT o_orderkey // 500 AS bucket, count(*) AS sources FROM orders GROUP BY 1),
    n AS (SELECT source_id // 500 AS bucket, count(*) AS created FROM f GROUP BY 1), r AS (SELECT bucket, sources, coalesce(created, 0) AS created FROM b LEFT JOIN n USING (bucket))
    SELECT count(*) AS buckets, CAST(sum(created) AS BIGINT) AS created, round(regr_slope(created / sources, bucket) + 1e-12, 9) AS slope, regr_slope(created / sources, bucket) < 0 AS falling FROM r"""
)
def concept_creation_rate(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    first = l.groupBy("l_partkey").agg(F.min("l_orderkey").alias("source_id"))
    b = table(spark, sf_dir, "orders").groupBy(F.expr("o_orderkey div 500").alias("bucket")).agg(F.count("*").alias("sources"))
    n = first.groupBy(F.expr("source_id div 500").alias("bucket")).agg(F.count("*").alias("created"))
    r = b.join(n, "bucket", "left").fillna(0, ["created"])
    slope = F.regr_slope(F.col("created") / F.col("sources"), F.col("bucket"))
    return r.agg(F.count("*").alias("buckets"), F.sum("created").alias("created"), F.round(slope + 1e-12, 9).alias("slope"), (slope < 0).alias("falling"))


@query(
    _EVIDENCE
    + f""", t AS (SELECT concept_id, 'P0' AS priority FROM cards WHERE risk_tier >= 3 UNION ALL SELECT concept_id, 'P1' FROM cards WHERE unresolved_contradiction UNION ALL SELECT concept_id, 'P1' FROM cards WHERE risk_tier >= 2 AND confidence < 0.65
    UNION ALL SELECT concept_id, 'P2' FROM cards WHERE groups <= 12 UNION ALL SELECT concept_id, 'P2' FROM cards WHERE date_diff('day', newest, DATE '{AS_OF}') > 730) SELECT concept_id, min(priority) AS priority, count(*) AS triggers FROM t GROUP BY concept_id"""
)
def review_escalation(spark, sf_dir):
    c = cards(spark, sf_dir)
    risky, weak = F.col("risk_tier") >= 3, (F.col("risk_tier") >= 2) & (F.col("confidence") < 0.65)
    stale = F.datediff(F.lit(AS_OF).cast("date"), "newest") > 730
    found = F.array(F.when(risky, "P0"), F.when(F.col("unresolved_contradiction"), "P1"), F.when(weak, "P1"), F.when(F.col("groups") <= 12, "P2"), F.when(stale, "P2"))
    d = c.select("concept_id", F.array_compact(found).alias("p")).where(F.size("p") > 0)
    return d.select("concept_id", F.array_min("p").alias("priority"), F.size("p").cast("long").alias("triggers"))


@query(
    r"""SELECT doc_id, 'doc_' || substr(sha256(source || chr(31) || doc_id), 1, 12) AS content_id, sha256(trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g'))) AS content_hash FROM documents"""
)
def content_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", fc.content_id("doc", F.col("source"), F.col("doc_id")).alias("content_id"), fc.content_hash(F.col("text")).alias("content_hash"))


@query(
    """WITH p AS (SELECT p_partkey AS card_id, p_type AS domain, CAST(p_size AS VARCHAR) AS size FROM part) SELECT card_id, 'domain/' || domain || ',size/' || size AS tags, CASE WHEN count(*) OVER (PARTITION BY domain) > 350 THEN 'overflow' ELSE 'ok' END AS shelf FROM p"""
)
def card_export(spark, sf_dir):
    """Flat export rows with tags; shelves with too many cards are marked."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("card_id"), F.col("p_type").alias("domain"), F.col("p_size").cast("string").alias("size"))
    sizes = p.groupBy("domain").agg(F.when(F.count("*") > 350, "overflow").otherwise("ok").alias("shelf"))
    return p.join(sizes, "domain").select("card_id", F.concat_ws(",", F.concat(F.lit("domain/"), "domain"), F.concat(F.lit("size/"), "size")).alias("tags"), "shelf")


@query(
    f"""WITH {star_sql("claims")}, m AS (SELECT speaker_id AS entity_id, count(*) AS mentions FROM claims GROUP BY speaker_id HAVING count(*) >= 10) SELECT entity_id, mentions FROM m WHERE entity_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0)"""
)
def entity_gaps(spark, sf_dir):
    """Entities that many claims mention and no card covers."""
    m = star(spark, sf_dir, "claims").groupBy(F.col("speaker_id").alias("entity_id")).agg(F.count("*").alias("mentions")).where("mentions >= 10")
    return m.join(table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").selectExpr("s_suppkey AS entity_id"), "entity_id", "left_anti")


@query(
    """WITH a AS (SELECT o_orderpriority AS v FROM orders), b AS (SELECT CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE o_orderpriority END AS v FROM orders),
    l AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b), r AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a) SELECT v, 'left' AS side, count(*) AS n FROM l GROUP BY v UNION ALL SELECT v, 'right', count(*) FROM r GROUP BY v"""
)
def state_difference(spark, sf_dir):
    """Rows by which a recomputed state differs from the stored one, with how often."""
    o = table(spark, sf_dir, "orders")
    d = ops.set_difference(o.selectExpr("o_orderpriority AS v"), o.selectExpr("CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE o_orderpriority END AS v"))
    return d.groupBy("v", "side").agg(F.count("*").alias("n"))


@query(
    """WITH r AS (SELECT p_type AS query, CASE WHEN p_type < 'M' THEN 'diagnostic' ELSE 'procedural' END AS qtype, p_partkey AS id, p_size / 50e0 AS score FROM part), e AS (SELECT p_partkey AS s, p_partkey // 2 AS o, CASE p_size % 4 WHEN 0 THEN 'indicates' WHEN 1 THEN 'requires' WHEN 2 THEN 'precedes' ELSE 'likes' END AS predicate FROM part),
    q(qtype, predicate) AS (VALUES ('diagnostic', 'indicates'), ('procedural', 'requires'), ('procedural', 'precedes'), ('procedural', 'part_of'))
    SELECT query, e.o AS id, round(max(score * 0.7e0) + 1e-9, 6) AS score FROM r JOIN q USING (qtype) JOIN e ON e.s = r.id AND e.predicate = q.predicate WHERE NOT EXISTS (SELECT 1 FROM r x WHERE x.query = r.query AND x.id = e.o) GROUP BY query, e.o"""
)
def graph_expansion(spark, sf_dir):
    from assay.operators import graph as g

    p = table(spark, sf_dir, "part")
    r = p.selectExpr("p_type AS query", "CASE WHEN p_type < 'M' THEN 'diagnostic' ELSE 'procedural' END AS qtype", "p_partkey AS id", "p_size / 50e0 AS score")
    e = p.selectExpr("p_partkey AS subject_id", "p_partkey div 2 AS object_id", "CASE p_size % 4 WHEN 0 THEN 'indicates' WHEN 1 THEN 'requires' WHEN 2 THEN 'precedes' ELSE 'likes' END AS predicate")
    used = spark.createDataFrame([("diagnostic", "indicates"), ("procedural", "requires"), ("procedural", "precedes"), ("procedural", "part_of")], "qtype string, predicate string")
    return g.expand(r, e, used).select("query", "id", F.round(F.col("score") + 1e-9, 6).alias("score"))


@query(
    """WITH f AS (SELECT source, CASE WHEN n_chars < 300 THEN 'quote_too_short' END AS a, CASE WHEN lang <> 'en' THEN 'scope_invalid' END AS b FROM documents), x AS (SELECT source AS source_id, unnest([a, b]) AS code FROM f), y AS (SELECT source_id, code FROM x WHERE code IS NOT NULL)
    SELECT source_id, code, CASE code WHEN 'quote_too_short' THEN 'discard' ELSE 'flag' END AS severity, count(*) AS n FROM y GROUP BY source_id, code UNION ALL SELECT NULL, code, CASE code WHEN 'quote_too_short' THEN 'discard' ELSE 'flag' END, count(*) FROM y GROUP BY code"""
)
def extraction_stats(spark, sf_dir):
    """Findings by source and code, with totals."""
    from assay.operators.validate import extraction_stats as stats

    one = lambda when, code, severity: F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit("").alias("detail")))
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("source_id"), F.array_compact(F.array(one(F.col("n_chars") < 300, "quote_too_short", "discard"), one(F.col("lang") != "en", "scope_invalid", "flag"))).alias("findings"))
    return stats(d).select("source_id", "code", "severity", "n")


_SLUG = lambda t: f"substr(array_to_string(list_filter(string_split_regex(lower({t}), '[^a-z0-9]+'), lambda w: w NOT IN ('', 'of', 'the', 'and', 'a')), '-'), 1, 60)"
_SHA = lambda p, *xs: f"'{p}_' || substr(sha256({' || chr(31) || '.join(xs)}), 1, 12)"


@query(
    f"""WITH p AS (SELECT *, p_name || ' of the ' || p_brand AS title, CAST(p_partkey AS VARCHAR) AS k, left(p_type, 3) AS domain FROM part), s AS (SELECT *, 'src_you-tube_202401_' || substr(sha256(title), 1, 8) AS source_id FROM p)
    SELECT p_partkey, source_id, 'chk_' || substr(sha256(title), 1, 8) || '_' || lpad(CAST(p_size AS VARCHAR), 5, '0') AS chunk_id, {_SHA("clm", "source_id", "k", "CAST(p_size AS VARCHAR)", "lower(title)")} AS claim_id,
      'cpt_' || domain || '_' || {_SLUG("title")} AS concept_id, 'kc_' || domain || '_' || {_SLUG("title")} AS card_id, 'ent_chem_' || {_SLUG("p_name")} AS entity_id, {_SHA("rel", "k", "'causes'", "domain", "''")} AS relation_id,
      {_SHA("ctr", "k", "least(lower(p_name), lower(p_brand))", "greatest(lower(p_name), lower(p_brand))")} AS contradiction_id, 'prm_' || {_SLUG("title")} || '_optimal-rh' AS parameter_id,
      'https://v.example/w' || CASE WHEN p_size % 2 = 0 THEN '?v=' || k || '&t=' ELSE '?t=' END || p_size || 's' AS link FROM s"""
)
def typed_ids(spark, sf_dir):
    """Ids of every shape, and links into a source at a time."""
    from assay.functions import columns as fc

    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # a file of many short rows is one task's, and each row's ids take long
    d = part.repartition(tasks_for(part, 50_000), "p_partkey").withColumns({"title": F.concat("p_name", F.lit(" of the "), "p_brand"), "domain": F.substring("p_type", 1, 3)})
    d = d.withColumn("source_id", fc.source_id(F.lit("You Tube"), F.lit("202401"), fc.content_hash(F.col("title"))))
    url = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://v.example/w?v="), F.col("p_partkey").cast("string"))).otherwise(F.lit("https://v.example/w"))
    return d.select(
        "p_partkey", "source_id", fc.chunk_id(F.col("source_id"), F.col("p_size")).alias("chunk_id"), fc.claim_id(F.col("source_id"), F.col("p_partkey"), F.col("p_size"), F.concat(F.lit("  "), F.upper("title"))).alias("claim_id"),
        fc.titled_id("cpt", F.col("domain"), F.col("title")).alias("concept_id"), fc.titled_id("kc", F.col("domain"), F.col("title")).alias("card_id"), fc.titled_id("ent", F.lit("chem"), F.col("p_name")).alias("entity_id"),
        fc.relation_id(F.col("p_partkey"), F.lit("causes"), F.col("domain")).alias("relation_id"), fc.contradiction_id(F.col("p_partkey"), F.col("p_brand"), F.concat("p_name", F.lit(" "))).alias("contradiction_id"),
        fc.parameter_id(fc.slugify(F.col("title")), F.lit("Optimal RH")).alias("parameter_id"), fc.deep_link(url, F.col("p_size") + 0.7).alias("link"),
    )
