"""Resolution, linking and policy queries, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import dedupe as dd, knowledge as kn, retrieve as rt
from assay.scratch import Scratch
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


_COS = lambda a, b: f"list_cosine_similarity(CAST({a}.embedding AS DOUBLE[]), CAST({b}.embedding AS DOUBLE[]))"


@query(
    f"""WITH m AS (SELECT vec_id AS id, vec_id % 50 AS k, embedding FROM embeddings WHERE vec_id % 20 = 0), e AS (SELECT vec_id AS entity_id, vec_id % 50 + 8 AS k, embedding FROM embeddings WHERE vec_id % 20 <> 0),
    a AS (SELECT k, min(entity_id) AS entity_id FROM e GROUP BY k), n AS (SELECT m.id, arg_max(e.entity_id, ({_COS("m", "e")}, -e.entity_id)) AS near_id, max({_COS("m", "e")}) AS c FROM m, e GROUP BY m.id)
    SELECT m.id, CASE WHEN a.entity_id IS NOT NULL THEN a.entity_id WHEN c >= 0.3 THEN near_id END AS entity_id, CASE WHEN a.entity_id IS NOT NULL THEN 'alias' WHEN c >= 0.3 THEN 'vector' ELSE 'unlinked' END AS method FROM m LEFT JOIN a USING (k) JOIN n USING (id)"""
)
def entity_linking(spark, sf_dir):
    """By alias, else by vector (the floor is a parameter; these vectors are rarely as close as 0.88)."""
    e = table(spark, sf_dir, "embeddings")
    m = e.where("vec_id % 20 = 0").selectExpr("vec_id AS id", "concat('A', vec_id % 50) AS alias", "embedding AS vector")
    n = e.where("vec_id % 20 <> 0").selectExpr("vec_id AS entity_id", "concat('a', vec_id % 50 + 8, ' ') AS alias", "embedding AS vector")
    return kn.link_mentions(m, n, 0.3)


@query(
    f"""WITH q AS (SELECT * FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT q.vec_id AS claim_id, v.vec_id AS concept_id, {_COS("q", "v")} AS cosine, q.label AS la, v.label AS lb FROM q, embeddings v WHERE v.vec_id % 20 <> 0),
    t AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY round(cosine, 12) DESC, concept_id) AS rank FROM s QUALIFY rank <= 15),
    c AS (SELECT claim_id, concept_id, 0.45e0 * cosine + 0.20e0 * (concept_id % 5) / 4e0 + 0.15e0 * (concept_id % 2) + 0.10e0 * CASE WHEN la = lb THEN 1e0 ELSE 0e0 END + 0.10e0 * (concept_id % 3) / 2e0 AS score FROM t),
    b AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY round(score, 9) DESC, concept_id) AS n FROM c QUALIFY n = 1)
    SELECT claim_id, CASE WHEN round(score, 9) >= 0.68 THEN concept_id END AS concept_id, round(score + 1e-9, 6) AS score, CASE WHEN round(score, 9) >= 0.82 THEN 'assign' WHEN round(score, 9) >= 0.68 THEN 'adjudicate' ELSE 'new' END AS decision FROM b"""
)
def concept_resolution(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 20 = 0").selectExpr("vec_id AS query", "embedding AS vector", "label AS la")
    near = rt.nearest(q, e.where("vec_id % 20 <> 0").selectExpr("vec_id AS id", "embedding AS vector"), 15)
    c = near.join(q.select("query", "la"), "query").join(e.selectExpr("vec_id AS id", "label AS lb"), "id")
    c = c.selectExpr("query AS claim_id", "id AS concept_id", "score AS cosine", "(id % 5) / 4e0 AS entities", "id % 2 AS predicate", "CASE WHEN la = lb THEN 1e0 ELSE 0e0 END AS taxonomy", "(id % 3) / 2e0 AS title")
    d = kn.resolve_claims(c)
    return d.select("claim_id", "concept_id", F.round(F.col("score") + 1e-9, 6).alias("score"), "decision")


_P = "WITH p AS (SELECT p_partkey AS s, p_partkey // 4 AS o, CASE WHEN p_size % 3 = 0 THEN 'causes' WHEN p_size % 3 = 1 THEN 'requires' ELSE 'likes' END AS predicate FROM part), e AS (SELECT s AS subject_id, o AS object_id, p.predicate, a.p_type AS st, b.p_type AS ot FROM p JOIN part a ON p.s = a.p_partkey JOIN part b ON p.o = b.p_partkey)"


@query(f"{_P} SELECT subject_id, object_id, predicate, (predicate = 'causes' AND st = 'SMALL') OR (predicate = 'requires' AND ot = 'LARGE') AS allowed FROM e")
def edge_types(spark, sf_dir):
    """Edges split by whether their predicate allows the types at their ends."""
    p = table(spark, sf_dir, "part")
    t = p.selectExpr("p_partkey AS id", "p_type AS type")
    e = p.selectExpr("p_partkey AS subject_id", "p_partkey div 4 AS object_id", "CASE WHEN p_size % 3 = 0 THEN 'causes' WHEN p_size % 3 = 1 THEN 'requires' ELSE 'likes' END AS predicate")
    e = e.join(t.selectExpr("id AS subject_id", "type AS subject_type"), "subject_id").join(t.selectExpr("id AS object_id", "type AS object_type"), "object_id")
    allowed = spark.createDataFrame([("causes", "SMALL", None), ("requires", None, "LARGE")], "predicate string, subject_type string, object_type string")
    good, bad = kn.compatible(e, allowed)
    cols = ["subject_id", "object_id", "predicate"]
    return good.select(*cols, F.lit(True).alias("allowed")).unionByName(bad.select(*cols, F.lit(False).alias("allowed")))


@query(
    """WITH r AS (SELECT p_type AS query, p_partkey AS id FROM part WHERE p_size % 6 = 1), c AS (SELECT p_partkey AS a, p_partkey + 7 AS b FROM part WHERE p_size % 4 = 1), s AS (SELECT a AS id, b AS other FROM c UNION ALL SELECT b, a FROM c)
    SELECT query, id, false AS forced FROM r UNION ALL SELECT DISTINCT query, other, true FROM r JOIN s USING (id) WHERE NOT EXISTS (SELECT 1 FROM r x WHERE x.query = r.query AND x.id = s.other)"""
)
def opposing_positions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    c = p.where("p_size % 4 = 1").selectExpr("p_partkey AS a_id", "p_partkey + 7 AS b_id", "true AS open").unionByName(p.where("p_size % 4 = 2").selectExpr("p_partkey AS a_id", "p_partkey + 9 AS b_id", "false AS open"))
    return kn.with_opposition(p.where("p_size % 6 = 1").selectExpr("p_type AS query", "p_partkey AS id"), c)


@query(
    """WITH c AS (SELECT c_custkey AS context_id, abs(c_acctbal) / 250e0 AS value, c_nationkey AS cond FROM customer), r AS (SELECT p_partkey AS entity_id, p_size - 3e0 AS lo, p_size + 3e0 AS hi FROM part),
    e AS (SELECT p_partkey AS entity_id, p_size % 25 AS target, 0.5e0 AS w FROM part UNION ALL SELECT p_partkey, p_size % 7, p_size / 100e0 FROM part), x AS (SELECT p_partkey AS entity_id, (p_partkey // 10) % 25 AS cond FROM part),
    f AS (SELECT context_id, entity_id FROM c JOIN r ON value >= lo AND value <= hi WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.entity_id = r.entity_id AND x.cond = c.cond))
    SELECT context_id, entity_id, round(sum(w) + 1e-9, 6) AS score, row_number() OVER (PARTITION BY context_id ORDER BY round(sum(w), 9) DESC, entity_id) AS place FROM f JOIN e USING (entity_id) GROUP BY context_id, entity_id"""
)
def recommendations(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS context_id", "abs(c_acctbal) / 250e0 AS value", "CAST(c_nationkey AS BIGINT) AS condition")
    p = table(spark, sf_dir, "part")
    r = p.selectExpr("p_partkey AS entity_id", "p_size - 3e0 AS lo", "p_size + 3e0 AS hi")
    edge = lambda pred, target, s: p.selectExpr("p_partkey AS entity_id", f"'{pred}' AS predicate", f"CAST({target} AS BIGINT) AS target", f"{s} AS strength", "1e0 AS confidence")
    e = edge("suitable_for", "p_size % 25", "0.5e0").unionByName(edge("suitable_for", "p_size % 7", "p_size / 100e0")).unionByName(edge("contraindicated_with", "(p_partkey div 10) % 25", "1e0"))
    return kn.recommend(c, r, e).select("context_id", "entity_id", F.round(F.col("score") + 1e-9, 6).alias("score"), "place")


@query(
    """WITH i AS (SELECT l_orderkey AS card_id, l_linenumber AS item, l_suppkey AS ref FROM lineitem), k AS (SELECT DISTINCT l_orderkey AS card_id, l_suppkey AS ref FROM lineitem WHERE l_returnflag <> 'A'),
    c AS (SELECT i.card_id, item, count(k.ref) AS cited FROM i LEFT JOIN k ON i.card_id = k.card_id AND i.ref = k.ref GROUP BY i.card_id, item) SELECT card_id, count(*) AS items, count(*) FILTER (cited = 0) AS uncited, round(count(*) FILTER (cited = 0) / count(*) + 1e-9, 6) AS uncited_rate FROM c GROUP BY card_id"""
)
def citation_coverage(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    items = l.groupBy(F.col("l_orderkey").alias("card_id"), F.col("l_linenumber").alias("item")).agg(F.collect_set("l_suppkey").alias("claim_refs"))
    known = l.where("l_returnflag <> 'A'").selectExpr("l_orderkey AS card_id", "l_suppkey AS claim_id").distinct()
    return kn.uncited(items, known).withColumn("uncited_rate", F.round(F.col("uncited_rate") + 1e-9, 6))


@query("SELECT conv_id, turn, CASE WHEN role = 'user' AND conv_id % 3 = 0 THEN CAST(conv_id + 1000 AS VARCHAR) ELSE conv_id || '#' || role END AS speaker_id FROM conversations")
def speaker_map(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    cues = c.selectExpr("conv_id AS source_id", "turn", "role AS speaker")
    known = c.where("conv_id % 3 = 0").selectExpr("conv_id AS source_id", "'user' AS label", "conv_id + 1000 AS creator_id").distinct()
    return kn.map_speakers(cues, known).select(F.col("source_id").alias("conv_id"), "turn", "speaker_id")


@query(
    """WITH r AS (SELECT o_orderkey % 40 AS run_id, count(*) AS n, avg(CASE WHEN o_orderstatus = 'P' THEN 1e0 ELSE 0e0 END) AS p, avg(o_totalprice) AS cost, count(*) FILTER (o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY 1)
    SELECT run_id, concat_ws(',', CASE WHEN n < 0.7e0 * 400 THEN 'claims_drop' END, CASE WHEN p > 0.34 THEN 'verbatim_failure' END, CASE WHEN p < 0.32 THEN 'merge_rate' END, CASE WHEN u > 75 THEN 'queue' END, CASE WHEN cost > 1.3e0 * 190000 THEN 'cost' END) AS alerts FROM r"""
)
def pipeline_health(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    r = o.groupBy(F.expr("o_orderkey % 40").alias("run_id")).agg(F.count("*").alias("n"), F.avg(F.when(F.col("o_orderstatus") == "P", 1.0).otherwise(0.0)).alias("p"), F.avg("o_totalprice").alias("cost"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u"))
    m = r.selectExpr("run_id", "n AS claims_per_1k", "400 AS baseline_per_1k", "CASE WHEN p > 0.34 THEN 0.03 ELSE 0.01 END AS verbatim_failure", "0.0 AS schema_failure", "CASE WHEN p < 0.32 THEN 0.1 ELSE 0.2 END AS merge_rate", "0.0 AS orphan_rate", "u + 125 AS queue", "cost", "190000 AS budget")
    return kn.health(m).select("run_id", F.array_join("alerts", ",").alias("alerts"))


@query(
    """WITH c AS (SELECT l_partkey AS card_id, count(*) % 12 AS n, bool_or(l_quantity > 49) AS p, avg(l_discount) - 0.05 AS delta, bool_or(l_tax = 0 AND l_linenumber = 7) AS x, min(l_linenumber) = 2 AS s FROM lineitem GROUP BY 1)
    SELECT card_id, CASE WHEN s THEN 'supersede' WHEN x THEN 'contested' WHEN n >= 5 OR p OR abs(delta) >= 0.05 THEN 'regenerate' ELSE 'counts_only' END AS action FROM c"""
)
def card_regeneration(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("card_id")).agg(
        (F.count("*") % 12).alias("new_claims"), F.expr("bool_or(l_quantity > 49)").alias("new_parameter"), (F.avg("l_discount") - 0.05).alias("delta"), F.expr("bool_or(l_tax = 0 AND l_linenumber = 7)").alias("new_contradiction"), F.expr("min(l_linenumber) = 2").alias("superseded"),
    )
    return kn.regeneration(c).select("card_id", "action")


@query(
    """WITH s AS (SELECT o_custkey AS card_id, o_orderdate AS t, o_orderkey AS seq, o_orderpriority AS body, o_totalprice / 500000e0 AS confidence FROM orders), c AS (SELECT *, body IS DISTINCT FROM lag(body) OVER w OR lag(seq) OVER w IS NULL AS changed FROM s WINDOW w AS (PARTITION BY card_id ORDER BY t, seq)),
    v AS (SELECT card_id, seq, row_number() OVER w AS version, lag(confidence) OVER w - confidence AS d FROM c WHERE changed WINDOW w AS (PARTITION BY card_id ORDER BY t, seq)) SELECT card_id, seq, CAST(version AS INT) AS version, round(d + 1e-9, 6) AS confidence_drop, coalesce(d > 0.15, false) AS alert FROM v"""
)
def card_versions(spark, sf_dir):
    s = table(spark, sf_dir, "orders").selectExpr("o_custkey AS card_id", "o_orderdate AS at", "o_orderkey AS seq", "o_orderpriority AS body", "o_totalprice / 500000e0 AS confidence")
    return kn.version_history(s).select("card_id", "seq", "version", F.round(F.col("confidence_drop") + 1e-9, 6).alias("confidence_drop"), "alert")


@query(
    f"""WITH {star_sql("claims", "sources", "creators")}, j AS (SELECT c.concept_id, c.stance, date_diff('day', DATE '1970-01-01', c.claimed_at) AS day, coalesce(k.reliability, 0.5e0) AS r FROM claims c JOIN sources s USING (source_id) LEFT JOIN creators k ON s.creator_id = k.creator_id),
    p AS (SELECT concept_id, avg(day) FILTER (stance = 'supports') AS ds, avg(day) FILTER (stance = 'contradicts') AS dc, avg(r) FILTER (stance = 'supports') AS rs, avg(r) FILTER (stance = 'contradicts') AS rc FROM j GROUP BY concept_id)
    SELECT concept_id, round((dc - ds) / 365.25e0 + 1e-9, 6) AS years, CASE WHEN dc - ds > 182.625e0 AND rc > rs THEN 'contradicts' WHEN dc - ds < -182.625e0 AND NOT rc > rs THEN 'supports' END AS supersedes FROM p WHERE dc - ds IS NOT NULL"""
)
def concept_evolution(spark, sf_dir):
    c = star(spark, sf_dir, "claims").join(star(spark, sf_dir, "sources").select("source_id", "creator_id"), "source_id").join(star(spark, sf_dir, "creators").select("creator_id", "reliability"), "creator_id", "left")
    d = kn.evolution(c.select("concept_id", "stance", "claimed_at", F.coalesce("reliability", F.lit(0.5)).alias("r")), 0.5)
    return d.select("concept_id", F.round(F.col("years") + 1e-9, 6).alias("years"), "supersedes")


@query(
    """WITH r AS (SELECT p_type AS query, p_partkey AS id, row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) AS place FROM part QUALIFY place <= 8)
    SELECT query, array_to_string(list(CAST(id AS VARCHAR) ORDER BY place), ',') AS ids, coalesce(array_to_string(list(CAST(id AS VARCHAR) ORDER BY place) FILTER (id % 3 = 0), ','), '') AS contested, count(*) FILTER (id % 2 = 0) AS quotes FROM r GROUP BY query"""
)
def context_assembly(spark, sf_dir):
    from pyspark.sql import Window

    p = table(spark, sf_dir, "part")
    r = p.select(F.col("p_type").alias("query"), F.col("p_partkey").alias("id"), F.row_number().over(Window.partitionBy("p_type").orderBy(F.desc("p_size"), "p_partkey")).alias("place"))
    d = kn.assemble_context(r, p.where("p_partkey % 3 = 0").selectExpr("p_partkey AS id"), p.where("p_partkey % 2 = 0").selectExpr("p_partkey AS id", "p_name AS quote"))
    return d.select("query", F.array_join("ids", ",").alias("ids"), F.array_join("contested", ",").alias("contested"), F.size("quotes").cast("long").alias("quotes"))


@query("SELECT o_orderkey AS task_id, o_orderpriority AS priority FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_orderdate, o_orderkey LIMIT 200")
def review_queue(spark, sf_dir):
    t = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS task_id", "CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'done' END AS state", "o_orderpriority AS priority", "o_orderdate AS created")
    return kn.review_queue(t, 200).select("task_id", "priority")


@query(
    """SELECT p_partkey AS a_id, p_partkey + 1 AS b_id, CASE WHEN (p_size % 10) / 10e0 < 0.3 THEN 'review' WHEN p_size % 6 = 0 THEN 'merge' WHEN p_size % 6 = 1 THEN 'subclass_of' WHEN p_size % 6 = 2 THEN 'contradiction' WHEN p_size % 6 = 3 THEN 'version' WHEN p_size % 6 = 4 THEN 'keep' ELSE 'review' END AS outcome FROM part"""
)
def adjudication(spark, sf_dir):
    p = table(spark, sf_dir, "part").selectExpr("p_partkey AS a_id", "p_partkey + 1 AS b_id", "CASE p_size % 6 WHEN 0 THEN 'duplicate' WHEN 1 THEN 'variant' WHEN 2 THEN 'contradictory' WHEN 3 THEN 'evolving' WHEN 4 THEN 'distinct' ELSE 'dunno' END AS verdict", "(p_size % 10) / 10e0 AS certainty")
    return kn.apply_adjudication(p, 0.3).select("a_id", "b_id", "outcome")


@query(
    """WITH RECURSIVE e AS (SELECT c_custkey AS x, c_custkey // 5 AS y FROM customer WHERE c_custkey % 4 = 0 AND c_custkey > 0), b AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
    r AS (SELECT x AS id, x AS reach FROM b UNION SELECT r.id, b.y FROM r JOIN b ON r.reach = b.x), g AS (SELECT id, min(reach) AS component FROM r GROUP BY id)
    SELECT c_custkey AS creator_id, coalesce(component, c_custkey) AS independence_group FROM customer LEFT JOIN g ON c_custkey = id"""
)
def independence_groups(spark, sf_dir):
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS creator_id")
    s = c.where("creator_id % 4 = 0 and creator_id > 0").selectExpr("creator_id AS a", "creator_id div 5 AS b")
    return kn.independence_groups(c, s, Scratch(spark, "independence"))


@query(
    """WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations) SELECT conv_id, turn, count(*) FILTER (lower(word) IN ('the', 'la', 'die')) AS corrections FROM w GROUP BY conv_id, turn"""
)
def lexicon_repair(spark, sf_dir):
    d = kn.repair_words(table(spark, sf_dir, "conversations"), {"the": "THE", "la": "LA", "die": "DIE"})
    return d.select("conv_id", "turn", F.size("corrections").cast("long").alias("corrections"))


@query(
    f"""WITH {star_sql("concepts", "claims")}, n AS (SELECT DISTINCT concept_id FROM claims WHERE speaker_id % 40 = 0), s AS (SELECT concept_id, max(line % 4) AS signal FROM claims WHERE weight > 90000 GROUP BY concept_id)
    SELECT c.concept_id, CAST(greatest(CASE c.domain WHEN 'HLT' THEN 2 WHEN 'ADH' THEN 1 ELSE 0 END, CASE WHEN n.concept_id IS NULL THEN 0 ELSE 3 END, coalesce(s.signal, 0)) AS INT) AS risk_floor FROM concepts c LEFT JOIN n USING (concept_id) LEFT JOIN s USING (concept_id)"""
)
def risk_floor(spark, sf_dir):
    c = star(spark, sf_dir, "claims")
    m = c.selectExpr("concept_id", "CASE WHEN speaker_id % 40 = 0 THEN 'condition' ELSE 'product' END AS entity_type")
    return kn.risk_floor(star(spark, sf_dir, "concepts"), m, c.where("weight > 90000").selectExpr("concept_id", "line % 4 AS risk_signal"), {"HLT": 2, "ADH": 1})


@query(
    f"""WITH {star_sql("concepts")}, e AS (SELECT CAST(concept_id AS VARCHAR) AS s, 'part_of' AS predicate, category AS o FROM concepts UNION SELECT category, 'part_of', domain FROM concepts UNION SELECT CAST(concept_id AS VARCHAR), 'requires', CAST(concept_id // 2 AS VARCHAR) FROM concepts WHERE size % 5 = 0)
    SELECT s AS subject_id, predicate, o AS object_id, 1e0 AS confidence FROM e"""
)
def structural_edges(spark, sf_dir):
    c = star(spark, sf_dir, "concepts").withColumn("requires", F.expr("CASE WHEN size % 5 = 0 THEN array(concept_id div 2) ELSE array() END"))
    return kn.structural_edges(c)


@query("SELECT p_brand AS module, count(*) FILTER (p_size % 7 <> 0) AS cards, min(p_retailprice) FILTER (p_size % 7 <> 0) AS lowest, count(*) FILTER (p_size % 7 = 0) AS left_out, count(*) FILTER (p_size % 7 <> 0) < 3 AS gap FROM part GROUP BY p_brand")
def curriculum_summary(spark, sf_dir):
    return kn.curriculum_summary(table(spark, sf_dir, "part").selectExpr("p_brand AS module", "p_size % 7 = 0 AS contested", "p_retailprice AS confidence"))


@query(
    r"""WITH t AS (SELECT min(p_partkey) AS id, p_name || ' ' || p_brand AS title FROM part GROUP BY title),
    g AS (SELECT id, list_distinct(flatten(list_transform(list_filter(string_split_regex(lower(title), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda k: substr('  ' || w || ' ', k, 3))))) AS g FROM t),
    x AS (SELECT a.id AS a_id, b.id AS b_id, len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))) AS similarity FROM g a JOIN g b ON a.id < b.id) SELECT a_id, b_id, round(similarity + 1e-9, 6) AS similarity FROM x WHERE similarity >= 0.5"""
)
def trigram_pairs(spark, sf_dir):
    """Different titles whose trigrams are half the same and more, each by the first part that has it."""
    t = table(spark, sf_dir, "part").groupBy(F.expr("concat(p_name, ' ', p_brand)").alias("title")).agg(F.min("p_partkey").alias("id"))
    pairs = dd.similar_sets(t.select("id", dd.trigrams(F.col("title")).alias("items")), Scratch(spark, "trigrams"), 0.5)
    return pairs.select("a_id", "b_id", F.round(F.col("overlap") + 1e-9, 6).alias("similarity"))


@query(
    f"""WITH q AS (SELECT * FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT q.vec_id AS query, v.vec_id AS id, {_COS("q", "v")} AS score FROM q, embeddings v WHERE v.label IN (1, 4, 7) AND v.vec_id % 3 <> 0)
    SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY round(score, 12) DESC, id) AS rank FROM s QUALIFY rank <= 5"""
)
def filtered_search(spark, sf_dir):
    """Vectors filtered by their metadata before the ranking, not after it."""
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 20 = 0").selectExpr("vec_id AS query", "embedding AS vector")
    return rt.nearest(q, e.where("label in (1, 4, 7) and vec_id % 3 <> 0").selectExpr("vec_id AS id", "embedding AS vector"), 5).select("query", "id", "rank")
