"""Graph queries over edges drawn from parts, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import graph as g
from assay.scratch import Scratch
from assay.sources.star import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: Every part has an edge to a part some steps on (so hubs and chains arise), some also an opposite edge.
_A = "SELECT p_partkey AS s, (p_partkey * 3 + p_size) % (SELECT count(*) FROM part) AS o, CASE WHEN p_size % 3 = 0 THEN 'prevents' ELSE 'causes' END AS predicate, 0.5e0 + p_size / 100e0 AS strength, 0.4e0 + p_size / 100e0 AS confidence FROM part"
_B = "SELECT p_partkey AS s, (p_partkey * 3 + p_size) % (SELECT count(*) FROM part) AS o, 'causes' AS predicate, 0.9e0 AS strength, 0.9e0 AS confidence FROM part WHERE p_size % 6 = 0"
_C = "SELECT p_partkey AS s, p_partkey // 8 AS o, 'causes' AS predicate, 0.95e0 AS strength, 0.6e0 + p_size / 200e0 AS confidence FROM part"
_EDGES_SQL = f"edges AS (SELECT s AS subject_id, predicate, o AS object_id, strength, confidence FROM ({_A} UNION ALL {_B} UNION ALL {_C}) WHERE s <> o)"


def _edges(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    n = part.count()
    to = f"(p_partkey * 3 + p_size) % {n}"
    a = part.selectExpr("p_partkey AS subject_id", "CASE WHEN p_size % 3 = 0 THEN 'prevents' ELSE 'causes' END AS predicate", f"{to} AS object_id", "0.5e0 + p_size / 100e0 AS strength", "0.4e0 + p_size / 100e0 AS confidence")
    b = part.where("p_size % 6 = 0").selectExpr("p_partkey AS subject_id", "'causes' AS predicate", f"{to} AS object_id", "0.9e0 AS strength", "0.9e0 AS confidence")
    c = part.selectExpr("p_partkey AS subject_id", "'causes' AS predicate", "p_partkey div 8 AS object_id", "0.95e0 AS strength", "0.6e0 + p_size / 200e0 AS confidence")
    return a.unionByName(b).unionByName(c).where("subject_id <> object_id")


@query(
    f"""WITH RECURSIVE {_EDGES_SQL}, step AS (SELECT object_id AS node, subject_id AS nxt, max(strength * confidence) AS w FROM edges WHERE predicate = 'causes' AND confidence >= 0.5 GROUP BY ALL),
    p AS (SELECT p_partkey AS start, p_partkey AS node, 0 AS hops, [p_partkey] AS path, 1e0 AS score FROM part WHERE p_partkey % 20 = 0
      UNION ALL SELECT p.start, s.nxt, p.hops + 1, list_append(p.path, s.nxt), p.score * s.w FROM p JOIN step s ON p.node = s.node WHERE p.hops < 4 AND NOT list_contains(p.path, s.nxt) AND p.score * s.w > 0.05)
    SELECT start AS symptom, node AS cause, round(1 - product(1 - score) + 1e-9, 6) AS score, count(*) AS paths, CAST(min(hops) AS INT) AS hops FROM p WHERE hops > 0 GROUP BY ALL"""
)
def diagnose(spark, sf_dir):
    s = table(spark, sf_dir, "part").where("p_partkey % 20 = 0").selectExpr("p_partkey AS start")
    return g.diagnose(s, _edges(spark, sf_dir)).select(F.col("start").alias("symptom"), F.col("node").alias("cause"), F.round(F.col("score") + 1e-9, 6).alias("score"), "paths", "hops")


@query(
    f"""WITH RECURSIVE {_EDGES_SQL}, used AS (SELECT *, object_id % 4 AS k, object_id % 30 AS bar FROM edges WHERE predicate = 'causes' AND confidence >= 0.5),
    n AS (SELECT p_partkey AS id, p_size % 3 AS kind, p_size AS bar, 0.5e0 + p_size / 100e0 AS sure FROM part WHERE p_size % 7 <> 0), best AS (SELECT subject_id, object_id, max(confidence) AS c FROM used GROUP BY ALL),
    p AS (SELECT p_partkey AS start, p_size * 2 % 61 AS rh, p_partkey AS node, 0 AS hops, [p_partkey] AS path, 1e0 AS score, 1e0 AS sure FROM part WHERE p_partkey % 10 = 0
      UNION ALL SELECT p.start, p.rh, s.subject_id, p.hops + 1, list_append(p.path, s.subject_id), p.score * max(s.strength * s.confidence), p.sure * any_value(b.c) * any_value(coalesce(n.sure, 1e0)) FROM p JOIN used s ON p.node = s.object_id JOIN best b ON b.subject_id = s.subject_id AND b.object_id = s.object_id LEFT JOIN n ON n.id = s.subject_id
        WHERE p.hops < 3 AND NOT list_contains(p.path, s.subject_id) AND p.score * s.strength * s.confidence > 0.05 AND (s.k <> 1 OR p.rh > s.bar) GROUP BY p.start, p.rh, p.node, p.hops, p.path, p.score, p.sure, s.subject_id),
    m AS (SELECT p.*, n.sure AS card, CASE n.kind WHEN 0 THEN CASE WHEN p.rh > n.bar THEN 1e0 ELSE 0e0 END WHEN 1 THEN CASE WHEN p.rh <= n.bar THEN 0.5e0 ELSE 0e0 END ELSE 1e0 END AS fit, n.kind, n.bar FROM p LEFT JOIN n ON n.id = p.node WHERE hops > 0)
    SELECT start AS symptom, node AS cause, round(1 - product(1 - score * fit * coalesce(card, 1)) + 1e-9, 6) AS score, round(1 - product(1 - sure) + 1e-9, 6) AS path_confidence, max(fit) AS context_match, count(*) AS paths, max(fit) = 0 AS ruled_out,
      CASE WHEN max(fit) = 0 THEN max(CASE kind WHEN 0 THEN 'rh > ' || bar ELSE 'rh <= ' || bar END) END AS violated FROM m GROUP BY start, node"""
)
def diagnose_in_context(spark, sf_dir):
    """Causes under each symptom's humidity: some apply above a limit, some below (with a second condition that nothing is known of), some always; a quarter of the edges need one too."""
    part = table(spark, sf_dir, "part")
    cond = "array<struct<variable:string,operator:string,value:string>>"
    symptoms = part.where("p_partkey % 10 = 0").selectExpr("p_partkey AS start", "map('rh', CAST(p_size * 2 % 61 AS STRING)) AS context")
    edges = _edges(spark, sf_dir).selectExpr("*", f"CASE WHEN object_id % 4 = 1 THEN CAST(array(struct('rh', '>', CAST(object_id % 30 AS STRING))) AS {cond}) END AS conditions")
    nodes = part.where("p_size % 7 <> 0").selectExpr(
        "p_partkey AS id", "0.5e0 + p_size / 100e0 AS card_confidence",
        f"CAST(CASE p_size % 3 WHEN 0 THEN array(struct('rh', '>', CAST(p_size AS STRING))) WHEN 1 THEN array(struct('rh', '<=', CAST(p_size AS STRING)), struct('skin', '=', 'oily')) END AS {cond}) AS conditions",
    )
    d = g.diagnose_in_context(symptoms, edges, nodes, predicates=("causes",), depth=3)
    return d.select(F.col("start").alias("symptom"), F.col("node").alias("cause"), F.round(F.col("score") + 1e-9, 6).alias("score"), F.round(F.col("path_confidence") + 1e-9, 6).alias("path_confidence"), "context_match", "paths", "ruled_out", "violated")


@query(
    f"""WITH RECURSIVE {_EDGES_SQL}, step AS (SELECT subject_id AS node, object_id AS nxt, max(strength * confidence) AS w FROM edges WHERE predicate = 'causes' GROUP BY ALL),
    p AS (SELECT p_partkey AS start, p_partkey AS node, 0 AS hops, [p_partkey] AS path, 1e0 AS score FROM part
      UNION ALL SELECT p.start, s.nxt, p.hops + 1, list_append(p.path, s.nxt), p.score * s.w FROM p JOIN step s ON p.node = s.node WHERE p.hops < 3 AND NOT list_contains(p.path, s.nxt) AND p.score * s.w > 0.05)
    SELECT start, node AS metric, round(max(score) + 1e-9, 6) AS score, CAST(min(hops) AS INT) AS hops FROM p JOIN part k ON p.node = k.p_partkey AND k.p_type = 'LARGE' WHERE hops > 0 GROUP BY start, node"""
)
def impact(spark, sf_dir):
    """Forward effects on nodes of one type."""
    part = table(spark, sf_dir, "part")
    paths = g.walk(part.selectExpr("p_partkey AS start"), _edges(spark, sf_dir).where("predicate = 'causes'"), depth=3)
    d = paths.join(part.where("p_type = 'LARGE'").selectExpr("p_partkey AS node"), "node", "left_semi")
    return d.groupBy("start", F.col("node").alias("metric")).agg(F.round(F.max("score") + 1e-9, 6).alias("score"), F.min("hops").alias("hops"))


@query(
    f"""WITH RECURSIVE {_EDGES_SQL}, step AS (SELECT DISTINCT subject_id AS node, object_id AS nxt FROM edges), want AS (SELECT p_partkey AS a, p_partkey // 64 AS b FROM part),
    p AS (SELECT DISTINCT a AS start, a AS node, 0 AS hops, [a] AS path FROM want
      UNION ALL SELECT p.start, s.nxt, p.hops + 1, list_append(p.path, s.nxt) FROM p JOIN step s ON p.node = s.node WHERE p.hops < 4 AND NOT list_contains(p.path, s.nxt))
    SELECT a, b, CAST(min(hops) AS INT) AS hops FROM p JOIN want ON a = start AND b = node WHERE hops > 0 GROUP BY a, b"""
)
def shortest_paths(spark, sf_dir):
    want = table(spark, sf_dir, "part").selectExpr("p_partkey AS a", "p_partkey div 64 AS b")
    return g.first_paths(want, _edges(spark, sf_dir), scratch=Scratch(spark, "paths")).select("a", "b", "hops")


@query(f"WITH {_EDGES_SQL} SELECT DISTINCT a.subject_id AS x, a.object_id AS y, a.predicate, b.predicate AS other FROM edges a JOIN edges b ON a.subject_id = b.subject_id AND a.object_id = b.object_id AND a.predicate = 'causes' AND b.predicate = 'prevents'")
def contradictory_edges(spark, sf_dir):
    return g.opposites(_edges(spark, sf_dir))


@query(f"WITH {_EDGES_SQL} SELECT id, count(*) AS degree FROM (SELECT subject_id AS id FROM edges UNION ALL SELECT object_id FROM edges) GROUP BY id HAVING count(*) > 10")
def hub_alerts(spark, sf_dir):
    return g.degrees(_edges(spark, sf_dir)).where("degree > 10")


@query(f"WITH {_EDGES_SQL} SELECT p_partkey AS id FROM part WHERE p_partkey NOT IN (SELECT object_id FROM edges WHERE predicate = 'prevents') AND p_partkey NOT IN (SELECT subject_id FROM edges WHERE predicate = 'prevents')")
def orphan_cards(spark, sf_dir):
    """Nodes without any edge of one kind."""
    return g.orphans(table(spark, sf_dir, "part").selectExpr("p_partkey AS id"), _edges(spark, sf_dir).where("predicate = 'prevents'"))


@query(
    """WITH RECURSIVE e AS (SELECT p_partkey AS b, p_partkey // 3 AS a FROM part WHERE p_partkey > 0 UNION SELECT p_partkey + 1, p_partkey FROM part WHERE p_partkey % 4 = 0 AND p_partkey + 1 < (SELECT count(*) FROM part)),
    r AS (SELECT 0::BIGINT AS id, 0 AS level UNION SELECT e.b, r.level + 1 FROM r JOIN e ON e.a = r.id)
    SELECT id, max(level) AS level FROM r GROUP BY id"""
)
def curriculum_levels(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    n = part.count()
    e = part.where("p_partkey > 0").selectExpr("p_partkey div 3 AS subject_id", "p_partkey AS object_id").unionByName(part.where(f"p_partkey % 4 = 0 and p_partkey + 1 < {n}").selectExpr("p_partkey AS subject_id", "p_partkey + 1 AS object_id"))
    return g.topological_levels(e, Scratch(spark, "levels"))[0]


_RING = "SELECT p_partkey AS a, CASE WHEN p_partkey % 50 = 49 THEN p_partkey - 49 ELSE p_partkey + 1 END AS b FROM part WHERE p_partkey % 50 < 50 AND p_partkey - p_partkey % 50 + 49 < (SELECT count(*) FROM part) AND (p_partkey // 50) % 3 = 0"


@query(f"{_RING}")
def cycle_edges(spark, sf_dir):
    """Every part is on a ring of fifty or on a tree hanging from one: only the rings remain."""
    part = table(spark, sf_dir, "part")
    n = part.count()
    ring = part.where(f"p_partkey - p_partkey % 50 + 49 < {n} and (p_partkey div 50) % 3 = 0").selectExpr("p_partkey AS subject_id", "CASE WHEN p_partkey % 50 = 49 THEN p_partkey - 49 ELSE p_partkey + 1 END AS object_id")
    tree = part.where("(p_partkey div 50) % 3 = 1").selectExpr("p_partkey - 50 AS subject_id", "p_partkey AS object_id").unionByName(part.where("(p_partkey div 50) % 3 = 2").selectExpr("p_partkey AS subject_id", "p_partkey - 100 AS object_id"))
    return g.cycle_edges(ring.unionByName(tree), Scratch(spark, "cycles"))


_LOOPS = "l AS (SELECT s AS a, o AS b, predicate FROM (SELECT p_partkey AS s, (p_partkey * 7 + p_size) % (SELECT count(*) FROM part) AS o, CASE p_size % 3 WHEN 0 THEN 'prevents' WHEN 1 THEN 'precedes' ELSE 'affects' END AS predicate FROM part UNION SELECT p_partkey, p_partkey + 1, 'part_of' FROM part WHERE p_partkey % 10 < 7) WHERE predicate <> 'affects')"


@query(
    f"""WITH RECURSIVE {_LOOPS}, r AS (SELECT DISTINCT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), c AS (SELECT x.a AS id, least(x.a, min(x.b)) AS component FROM r x JOIN r y ON x.a = y.b AND x.b = y.a GROUP BY x.a),
    e AS (SELECT DISTINCT l.a, l.b, l.predicate, ca.component FROM l JOIN c ca ON ca.id = l.a JOIN c cb ON cb.id = l.b WHERE ca.component = cb.component)
    SELECT e.component, (SELECT count(*) FROM c WHERE c.component = e.component) AS nodes, count(*) AS edges, count_if(NOT (predicate = 'part_of' AND a % 2 = 0)) AS open_edges, count_if(NOT (predicate = 'part_of' AND a % 2 = 0)) > 0 AS review FROM e GROUP BY e.component"""
)
def cycle_review(spark, sf_dir):
    """Cycles of predicates that should have none, over a graph without order; every second step of the chains in it is confirmed."""
    part = table(spark, sf_dir, "part")
    n = part.count()
    some = part.selectExpr("p_partkey AS subject_id", "CASE p_size % 3 WHEN 0 THEN 'prevents' WHEN 1 THEN 'precedes' ELSE 'affects' END AS predicate", f"(p_partkey * 7 + p_size) % {n} AS object_id")
    steps = part.where("p_partkey % 10 < 7").selectExpr("p_partkey AS subject_id", "'part_of' AS predicate", "p_partkey + 1 AS object_id")
    return g.cycle_review(some.unionByName(steps), steps.where("subject_id % 2 = 0"), Scratch(spark, "review"))


@query(
    """WITH RECURSIVE c AS (SELECT p_partkey AS id FROM part WHERE p_type IN ('STANDARD', 'PROMO', 'LARGE') AND p_size <= 35),
    e AS (SELECT a, b FROM (SELECT p_partkey // 2 AS a, p_partkey AS b FROM part WHERE p_partkey > 0 UNION SELECT p_partkey // 5, p_partkey FROM part WHERE p_partkey > 0 UNION SELECT p_partkey - 1, p_partkey FROM part WHERE p_partkey % 3 = 0 AND p_partkey > 0) WHERE a IN (FROM c) AND b IN (FROM c)),
    r AS (SELECT id, 0 AS level FROM c UNION SELECT e.b, r.level + 1 FROM r JOIN e ON e.a = r.id)
    SELECT id, max(level) AS level FROM r GROUP BY id"""
)
def curriculum_order(spark, sf_dir):
    """Levels of the cards of three domains up to a level of skill, by two kinds of prerequisite; what the others need isn't asked."""
    part = table(spark, sf_dir, "part")
    cards = part.selectExpr("p_partkey AS id", "p_type AS domain", "p_size AS skill_level")
    e = part.where("p_partkey > 0").selectExpr("p_partkey div 2 AS subject_id", "'prerequisite_of' AS predicate", "p_partkey AS object_id")
    e = e.unionByName(part.where("p_partkey > 0").selectExpr("p_partkey AS subject_id", "'requires' AS predicate", "p_partkey div 5 AS object_id"))
    e = e.unionByName(part.where("p_partkey % 3 = 0 and p_partkey > 0").selectExpr("p_partkey - 1 AS subject_id", "'prerequisite_of' AS predicate", "p_partkey AS object_id"))
    return g.curriculum(cards, e, ["STANDARD", "PROMO", "LARGE"], 35, Scratch(spark, "curriculum"))


@query(
    """WITH c AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS claim_id, CASE l_returnflag WHEN 'A' THEN 'causal' WHEN 'R' THEN 'correlational' ELSE 'definitional' END AS claim_type, l_suppkey AS subject, CASE WHEN l_linenumber < 3 THEN 'causes' WHEN l_linenumber < 5 THEN 'prevents' ELSE 'likes' END AS predicate,
      l_partkey AS object, CASE WHEN l_linestatus = 'F' THEN least(0.75e0, 1e0 - l_tax) ELSE 1e0 - l_tax END AS confidence FROM lineitem)
    SELECT 'rel_' || substr(sha256(subject || chr(31) || predicate || chr(31) || object), 1, 12) AS id, subject AS subject_id, predicate, object AS object_id, round(max(confidence), 6) AS confidence, count(DISTINCT claim_id) AS evidence
    FROM c WHERE claim_type <> 'definitional' AND predicate IN ('causes', 'prevents') GROUP BY subject, predicate, object"""
)
def claim_relations(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS claim_id", "CASE l_returnflag WHEN 'A' THEN 'causal' WHEN 'R' THEN 'correlational' ELSE 'definitional' END AS claim_type", "l_suppkey AS subject",
        "CASE WHEN l_linenumber < 3 THEN 'causes' WHEN l_linenumber < 5 THEN 'prevents' ELSE 'likes' END AS predicate", "l_partkey AS object", "1e0 - l_tax AS confidence", "l_linestatus = 'F' AS model_inferred",
    )
    known = spark.createDataFrame([("causes",), ("prevents",)], "predicate string")
    d = g.relations_from_claims(c, known)
    return d.select("id", "subject_id", "predicate", "object_id", F.round("confidence", 6).alias("confidence"), F.size("evidence_claims").cast("long").alias("evidence"))


@query(
    """WITH e AS (SELECT p_partkey AS s, p_partkey // 3 AS o, [p_partkey] AS ev FROM part WHERE p_partkey // 3 <> p_partkey UNION ALL SELECT p_partkey, p_partkey // 9, CASE WHEN p_size % 2 = 0 THEN [p_partkey] ELSE [p_partkey, -1] END FROM part WHERE p_partkey // 9 <> p_partkey AND p_partkey // 9 <> p_partkey // 3)
    SELECT DISTINCT c.s AS subject_id, c.o AS object_id FROM e a JOIN e b ON a.o = b.s JOIN e c ON c.s = a.s AND c.o = b.o WHERE a.s <> b.o AND a.o <> a.s AND a.o <> b.o AND len(list_filter(c.ev, lambda x: NOT list_contains(list_concat(a.ev, b.ev), x))) = 0"""
)
def transitive_edges(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    a = part.where("p_partkey div 3 <> p_partkey").selectExpr("p_partkey AS subject_id", "'part_of' AS predicate", "p_partkey div 3 AS object_id", "array(p_partkey) AS evidence_claims")
    b = part.where("p_partkey div 9 <> p_partkey and p_partkey div 9 <> p_partkey div 3").selectExpr("p_partkey AS subject_id", "'part_of' AS predicate", "p_partkey div 9 AS object_id", "CASE WHEN p_size % 2 = 0 THEN array(p_partkey) ELSE array(p_partkey, -1L) END AS evidence_claims")
    return g.prunable(a.unionByName(b)).select("subject_id", "object_id")


_VOTES = "SELECT id, module FROM (SELECT b.id, l.module, row_number() OVER (PARTITION BY b.id ORDER BY count(*) DESC, l.module) AS place FROM both_ways b JOIN {0} l ON l.id = b.n GROUP BY b.id, l.module) WHERE place = 1"


@query(
    f"WITH {_EDGES_SQL}, both_ways AS (SELECT subject_id AS id, object_id AS n FROM edges UNION SELECT object_id, subject_id FROM edges), l0 AS (SELECT DISTINCT id, id AS module FROM both_ways), "
    + ", ".join(f"l{k + 1} AS MATERIALIZED ({_VOTES.format(f'l{k}')})" for k in range(5))
    + " SELECT id, module FROM l5"
)
def modules(spark, sf_dir):
    """Five rounds of label propagation over all edges."""
    return g.communities(_edges(spark, sf_dir), Scratch(spark, "modules"))


@query()
def acquisition_gaps(spark, sf_dir):
    """Nodes that many shortest paths run through, with little confidence in their own edges; the bound of the estimate is in the rows."""
    e = _edges(spark, sf_dir)
    b = g.sampled_betweenness(e, Scratch(spark, "betweenness"), error=0.2)
    weak = e.groupBy(F.col("subject_id").alias("id")).agg(F.avg("confidence").alias("confidence")).where("confidence < 0.7")
    return b.join(weak, "id").where("score > 500").select("id", F.round("score", 6).alias("score"), "bound", F.round("confidence", 6).alias("confidence"))
