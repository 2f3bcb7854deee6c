"""Dedupe and contradiction queries, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay import vocab
from assay.operators import dedupe as dd, evidence as ev
from assay.operators.retrieve import similar_vectors
from assay.plans.evidence import _EVIDENCE, AS_OF, case, steps
from assay.scratch import Scratch, tasks_for
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


_FEATURES = [
    "p_partkey AS id", "concat(p_name, ' ', p_brand) AS title", "p_type AS domain", "array(p_type, p_brand) AS path",
    "CASE WHEN p_size % 4 = 0 THEN array() ELSE array(concat('e', p_size % 9), concat('e', p_size % 5)) END AS entities",
    "CASE WHEN p_size % 3 = 0 THEN array() ELSE array(concat('r', p_size % 4)) END AS predicates", "array(concat('p', p_size % 6)) AS parameters",
    "CASE WHEN p_size % 10 = 0 THEN 'negative' ELSE 'positive' END AS polarity", "CASE WHEN p_size % 8 = 0 THEN 'conditional' ELSE 'general' END AS scope",
    "CASE WHEN p_size % 5 = 0 THEN array() ELSE array(concat('c', p_size % 3)) END AS contexts",
]


def _features(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    d = part.repartition(tasks_for(part), "p_partkey").selectExpr(*_FEATURES)
    return d.withColumns({c: F.array_distinct(F.col(c).cast("array<string>")) for c in ("entities", "predicates", "contexts")})


def _keys():
    return {"title": dd.normal_title(F.col("title")), "leaf": F.concat_ws("|", "domain", F.col("path")[1], F.substring_index("title", " ", 1))}


_LIST = lambda c: f"list_sort({c})"
_CAND_SQL = f"""f AS (
  SELECT p_partkey AS id, p_name || ' ' || p_brand AS title, p_type AS domain, p_brand AS brand, split_part(p_name, ' ', 1) AS w,
    list_distinct(CASE WHEN p_size % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['e' || (p_size % 9), 'e' || (p_size % 5)] END) AS entities,
    CASE WHEN p_size % 3 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['r' || (p_size % 4)] END AS predicates, ['p' || (p_size % 6)] AS parameters,
    CASE WHEN p_size % 10 = 0 THEN 'negative' ELSE 'positive' END AS polarity, CASE WHEN p_size % 8 = 0 THEN 'conditional' ELSE 'general' END AS scope,
    CASE WHEN p_size % 5 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['c' || (p_size % 3)] END AS contexts FROM part
), cand AS (
  SELECT a.id AS a_id, b.id AS b_id, list_sort(list_filter([CASE WHEN a.domain = b.domain AND a.brand = b.brand AND a.w = b.w THEN 'leaf' END, CASE WHEN a.title = b.title THEN 'title' END], lambda x: x IS NOT NULL)) AS generators
  FROM f a JOIN f b ON a.id < b.id AND (a.title = b.title OR (a.domain = b.domain AND a.brand = b.brand AND a.w = b.w))
)"""


@query(f"WITH {_CAND_SQL} SELECT a_id, b_id, array_to_string(generators, ',') AS generators FROM cand")
def blocking_pairs(spark, sf_dir):
    classes = dd.class_pairs(_features(spark, sf_dir), _keys()).withColumn("generators", F.array_join("generators", ","))
    return dd.member_pairs(classes, "generators")


def _jac(c: str) -> str:
    return f"coalesce(len(list_intersect(a.{c}, b.{c})) / nullif(len(list_distinct(list_concat(a.{c}, b.{c}))), 0), 0)"


_SCORE_SQL = f"""WITH {_CAND_SQL}, v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (
  SELECT a_id, b_id, greatest(0, list_cosine_similarity(va.v, vb.v)) AS sim, len(list_intersect(string_split(lower(a.title), ' '), string_split(lower(b.title), ' '))) / len(list_distinct(list_concat(string_split(lower(a.title), ' '), string_split(lower(b.title), ' ')))) AS title,
    {_jac("entities")} AS entities, {_jac("predicates")} AS predicate, {_jac("parameters")} AS parameters,
    CASE WHEN len(a.entities) + len(b.entities) > 0 THEN 1e0 ELSE 0e0 END AS ne, CASE WHEN len(a.predicates) + len(b.predicates) > 0 THEN 1e0 ELSE 0e0 END AS np,
    CASE WHEN a.domain <> b.domain THEN 0e0 WHEN a.brand = b.brand THEN 1e0 ELSE 0.4e0 END AS taxonomy,
    CASE WHEN a.polarity <> b.polarity THEN 0.20e0 ELSE 0e0 END + CASE WHEN a.scope <> b.scope THEN 0.15e0 ELSE 0e0 END
      + CASE WHEN len(a.contexts) > 0 AND len(b.contexts) > 0 AND len(list_intersect(a.contexts, b.contexts)) = 0 THEN 0.25e0 ELSE 0e0 END AS cost
  FROM cand JOIN f a ON a.id = a_id JOIN f b ON b.id = b_id JOIN v va ON va.vec_id = a_id % (SELECT count(*) FROM embeddings) JOIN v vb ON vb.vec_id = b_id % (SELECT count(*) FROM embeddings)
), t AS (SELECT a_id, b_id, greatest(0, (0.4e0 * sim + 0.15e0 * title + 0.15e0 * entities * ne + 0.1e0 * predicate * np + 0.1e0 * taxonomy + 0.1e0 * parameters) / (0.4e0 + 0.15e0 + 0.15e0 * ne + 0.1e0 * np + 0.1e0 + 0.1e0) - cost) AS score FROM s)
SELECT a_id, b_id, round(score + 1e-9, 6) AS score, {steps("score", vocab.ROUTES, vocab.LOWEST_ROUTE)} AS verdict FROM t"""


@query(_SCORE_SQL)
def pair_scores(spark, sf_dir):
    """Candidate pairs scored with the cosine of their vectors; a concept has the vector of its number, counted round."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("vec"), F.col("embedding").cast("array<double>").alias("vector"))
    n, product = e.count(), lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda t, p: t + p)
    v = e.where("vector is not null").withColumn("square", product("vector", "vector"))
    f = _features(spark, sf_dir).withColumn("vec", F.col("id") % n)
    # concepts of equal features and vector are scored once, where their class meets another; no pair is shuffled or written
    classes = dd.class_pairs(f, _keys(), tuple(c for c in f.columns if c != "id"), lambda d: d.join(v, "vec"))
    # equal vectors have exactly 1 so, and pairs on a threshold the verdict of the SQL
    squares = F.col("a_square") * F.col("b_square")
    cosine = F.when(squares > 0, product("a_vector", "b_vector") / F.sqrt(squares)).otherwise(0.0)
    scored = dd.scored_pairs(classes.withColumn("embedding_similarity", cosine)).select("a_ids", "b_ids", "same", F.round(F.col("score") + 1e-9, 6).alias("score"), "verdict")
    return dd.member_pairs(scored, "score", "verdict")


@query(
    """WITH pairs AS (SELECT p_partkey AS a_id, p_partkey + 97 AS b_id FROM part WHERE p_size % 3 = 0 AND p_partkey + 97 < (SELECT count(*) FROM part)),
    apart AS (SELECT p_partkey AS a_id, p_partkey + 97 AS b_id FROM part WHERE p_size % 9 = 0),
    forced AS (SELECT p_partkey AS a_id, p_partkey + 1 AS b_id FROM part WHERE p_size = 7 AND p_partkey + 1 < (SELECT count(*) FROM part))
    SELECT * FROM (SELECT * FROM pairs EXCEPT SELECT * FROM apart) UNION SELECT * FROM forced"""
)
def human_decisions(spark, sf_dir):
    return dd.apply_decisions(*_merge_input(spark, sf_dir))


def _merge_input(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    n = part.count()
    pairs = part.where(f"p_size % 3 = 0 and p_partkey + 97 < {n}").selectExpr("p_partkey AS a_id", "p_partkey + 97 AS b_id")
    apart = part.where("p_size % 9 = 0").selectExpr("p_partkey + 97 AS a_id", "p_partkey AS b_id", "'not_merge' AS decision", "true AS active")
    forced = part.where(f"p_size = 7 and p_partkey + 1 < {n}").selectExpr("p_partkey AS a_id", "p_partkey + 1 AS b_id", "'merge' AS decision", "true AS active")
    old = part.where("p_size = 8").selectExpr("p_partkey AS a_id", "p_partkey + 2 AS b_id", "'merge' AS decision", "false AS active")
    return pairs, apart.unionByName(forced).unionByName(old)


@query(
    f"""WITH RECURSIVE e AS ({ORACLE_SQL["human_decisions"].replace("WITH pairs", "WITH pairs", 1)}),
    b AS (SELECT a_id AS x, b_id AS y FROM e UNION SELECT b_id, a_id FROM e),
    r AS (SELECT x AS id, x AS reach FROM b UNION SELECT r.id, b.y FROM r JOIN b ON r.reach = b.x),
    g AS (SELECT id, min(reach) AS component FROM r GROUP BY id)
    SELECT g.id, first_value(g.id) OVER (PARTITION BY component ORDER BY p.p_size DESC, p.p_retailprice DESC, p.p_partkey) AS canonical_id FROM g JOIN part p ON g.id = p.p_partkey"""
)
def merge_groups(spark, sf_dir):
    pairs = dd.apply_decisions(*_merge_input(spark, sf_dir))
    concepts = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_size AS groups", "p_retailprice AS claims", "p_partkey AS created")
    return dd.merge_groups(pairs, concepts, Scratch(spark, "merge"))


_GROUPS_SQL = ORACLE_SQL["merge_groups"].replace("WITH RECURSIVE e AS", "WITH RECURSIVE e0 AS", 1).replace("FROM e UNION SELECT b_id", "FROM e0 UNION SELECT b_id").replace("a_id FROM e)", "a_id FROM e0)")


@query(
    f"""WITH gr AS ({_GROUPS_SQL}), c AS (SELECT p.p_partkey AS id, p_name || ' ' || p_brand AS title, ['n' || (p_partkey % 5)] AS aliases, CASE WHEN gr.canonical_id <> gr.id THEN gr.canonical_id END AS merged_into FROM part p LEFT JOIN gr ON gr.id = p.p_partkey),
    x AS (SELECT merged_into AS id, unnest(list_concat([title], aliases)) AS alias FROM c WHERE merged_into IS NOT NULL UNION SELECT id, unnest(aliases) FROM c), al AS (SELECT x.id, list_sort(list(DISTINCT alias) FILTER (alias <> title)) AS aliases FROM x JOIN c USING (id) GROUP BY x.id),
    k AS (SELECT coalesce(c.merged_into, c.id) AS id, count(*) AS claims FROM lineitem JOIN c ON l_partkey = c.id GROUP BY 1),
    e AS (SELECT coalesce(a.merged_into, a.id) AS s, coalesce(b.merged_into, b.id) AS o, p.p_size / 100e0 AS confidence FROM part p JOIN c a ON a.id = p.p_partkey JOIN c b ON b.id = p.p_partkey // 8), r AS (SELECT s AS id, count(DISTINCT o) AS relations, max(confidence) AS surest FROM e WHERE s <> o GROUP BY s)
    SELECT c.id, c.merged_into, coalesce(array_to_string(al.aliases, '|'), '') AS aliases, coalesce(k.claims, 0) AS claims, coalesce(r.relations, 0) AS relations, r.surest FROM c LEFT JOIN al USING (id) LEFT JOIN k USING (id) LEFT JOIN r USING (id)"""
)
def merge_application(spark, sf_dir):
    """Every concept after the merges: where it went, its aliases, and how many claims and relations it has now."""
    part = table(spark, sf_dir, "part")
    groups = merge_groups(spark, sf_dir)
    concepts = part.selectExpr("p_partkey AS id", "concat(p_name, ' ', p_brand) AS title", "array(concat('n', p_partkey % 5)) AS aliases")
    claims = table(spark, sf_dir, "lineitem").selectExpr("concat(l_orderkey, '-', l_linenumber) AS claim_id", "l_partkey AS concept_id")
    relations = part.selectExpr("p_partkey AS subject_id", "'causes' AS predicate", "p_partkey div 8 AS object_id", "p_size / 100e0 AS confidence")
    after, moved, edges = dd.apply_merges(groups, concepts, claims, relations)
    k = moved.groupBy(F.col("concept_id").alias("id")).agg(F.count("*").alias("claims"))
    r = edges.groupBy(F.col("subject_id").alias("id")).agg(F.count("*").alias("relations"), F.max("confidence").alias("surest"))
    d = after.join(k, "id", "left").join(r, "id", "left")
    return d.select("id", "merged_into", F.array_join("aliases", "|").alias("aliases"), F.coalesce("claims", F.lit(0)).alias("claims"), F.coalesce("relations", F.lit(0)).alias("relations"), "surest")


@query(
    """WITH RECURSIVE m AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 AND p_partkey > 0 THEN p_partkey // 2 END AS into_id FROM part),
    r AS (SELECT id, id AS place FROM m UNION ALL SELECT r.id, m.into_id FROM r JOIN m ON r.place = m.id WHERE m.into_id IS NOT NULL)
    SELECT id, min(place) AS final_id FROM r GROUP BY id"""
)
def resolve_tombstones(spark, sf_dir):
    c = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "CASE WHEN p_partkey % 3 = 0 AND p_partkey > 0 THEN p_partkey div 2 END AS merged_into")
    return dd.resolve_tombstones(c, Scratch(spark, "tombstones"))


_SIDES_SQL = (
    _EVIDENCE
    + f""", w AS (
  SELECT j.concept_id, p.risk_tier, j.stance, j.gkey, sum(j.w * j.r * exp(-ln(2e0) * greatest(date_diff('day', j.published_at, DATE '{AS_OF}'), 0) / 365.25e0 / {case("p.domain", vocab.HALF_LIFE, vocab.UNKNOWN_HALF_LIFE)})) AS w
  FROM joined j JOIN concepts p ON j.concept_id = p.concept_id WHERE j.stance IN ('supports', 'contradicts') GROUP BY ALL
), s AS (
  SELECT concept_id, risk_tier, sum(w) FILTER (stance = 'supports') AS w_a, count(*) FILTER (stance = 'supports') AS n_a, sum(w) FILTER (stance = 'contradicts') AS w_b, count(*) FILTER (stance = 'contradicts') AS n_b FROM w GROUP BY ALL
), t AS (SELECT *, w_a / sqrt(n_a) / (w_a / sqrt(n_a) + w_b / sqrt(n_b)) AS wa FROM s WHERE n_a > 0 AND n_b > 0)
SELECT concept_id, n_a, n_b, round(wa + 1e-9, 6) AS weight_a, CASE WHEN risk_tier >= 3 THEN 'refer_to_expert' WHEN abs(2 * wa - 1) <= 0.15 THEN 'present_both' WHEN greatest(wa, 1 - wa) >= 0.65 THEN 'present_majority_with_caveat' ELSE 'present_both' END AS ai_handling FROM t"""
)


@query(_SIDES_SQL)
def contradiction_weights(spark, sf_dir):
    c, s, k = (star(spark, sf_dir, n) for n in ("claims", "sources", "creators"))
    d = c.join(s.select("source_id", "creator_id", "published_at"), "source_id", "left").join(k, "creator_id", "left")
    d = d.join(star(spark, sf_dir, "concepts").select("concept_id", "domain", "risk_tier"), "concept_id")
    d = d.withColumns({"r": F.coalesce("reliability", F.lit(0.5)), "gkey": F.coalesce(ev.group_key(F.col("independence_group"), F.col("creator_id")), F.concat(F.lit("s:"), F.col("source_id").cast("string")))})
    out = dd.position_weights(d, AS_OF)
    return out.select("concept_id", "n_a", "n_b", F.round(F.col("weight_a") + 1e-9, 6).alias("weight_a"), "ai_handling")


@query(
    f"""WITH {star_sql("claims")}, s AS (SELECT concept_id, count(*) FILTER (stance = 'supports') AS supporting, count(*) FILTER (stance = 'contradicts') AS contradicting FROM claims GROUP BY concept_id)
    SELECT 'ctr_' || substr(sha256('supports' || chr(31) || 'contradicts' || chr(31) || concept_id), 1, 12) AS contradiction_id, concept_id, supporting, contradicting FROM s WHERE supporting > 0 AND contradicting > 0"""
)
def contradiction_candidates(spark, sf_dir):
    """Concepts with claims on both sides; the id doesn't depend on the order of the sides."""
    s = star(spark, sf_dir, "claims").groupBy("concept_id").agg(F.count_if(F.col("stance") == "supports").alias("supporting"), F.count_if(F.col("stance") == "contradicts").alias("contradicting"))
    key = F.concat_ws("\u001f", F.lit("supports"), F.lit("contradicts"), F.col("concept_id").cast("string"))
    return s.where("supporting > 0 and contradicting > 0").select(F.concat(F.lit("ctr_"), F.substring(F.sha2(key, 256), 1, 12)).alias("contradiction_id"), "concept_id", "supporting", "contradicting")


@query(
    """SELECT 'p' || (p_size % 6) AS name, CASE WHEN p_size % 2 = 0 THEN 'mm' ELSE 's' END AS unit, p_type AS entity_id, count(DISTINCT p_size) AS "values", min(p_size) AS lowest, max(p_size) AS highest, count(*) AS mentions, count(DISTINCT p_size) > 1 AS disputed
    FROM part GROUP BY 1, 2, 3"""
)
def parameter_merge(spark, sf_dir):
    p = table(spark, sf_dir, "part").selectExpr("concat('p', p_size % 6) AS name", "CASE WHEN p_size % 2 = 0 THEN 'mm' ELSE 's' END AS unit", "p_type AS entity_id", "p_size AS value")
    return dd.merge_parameters(p)


@query(
    f"""WITH {star_sql("claims", "sources")}, e AS (SELECT s.creator_id AS subject_id, c.stance AS predicate, c.concept_id AS object_id, c.hedge_level, c.extraction_certainty FROM claims c JOIN sources s ON c.source_id = s.source_id)
    SELECT subject_id, predicate, object_id, round(max(extraction_certainty), 6) AS confidence, round(avg(hedge_level) + 1e-9, 6) AS strength, count(*) AS merged FROM e GROUP BY ALL"""
)
def relation_merge(spark, sf_dir):
    c, s = star(spark, sf_dir, "claims"), star(spark, sf_dir, "sources").select("source_id", "creator_id")
    e = c.join(s, "source_id").select(F.col("creator_id").alias("subject_id"), F.col("stance").alias("predicate"), F.col("concept_id").alias("object_id"), F.col("extraction_certainty").alias("confidence"), F.col("hedge_level").alias("strength"), F.array(F.col("source_id")).alias("evidence_claims"))
    d = dd.merge_relations(e)
    return d.select("subject_id", "predicate", "object_id", F.round("confidence", 6).alias("confidence"), F.round(F.col("strength") + 1e-9, 6).alias("strength"), "merged")


@query(
    """WITH k AS (SELECT DISTINCT l_partkey AS id, l_orderkey AS key FROM lineitem), n AS (SELECT key FROM k GROUP BY key HAVING count(*) > 1)
    SELECT a.id AS a_id, b.id AS b_id, 'source' AS generator FROM k a JOIN k b ON a.key = b.key AND a.id < b.id JOIN n ON n.key = a.key GROUP BY a.id, b.id HAVING count(*) >= 2"""
)
def shared_source_pairs(spark, sf_dir):
    """Concepts that two sources and more have in common."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS id", "CAST(l_orderkey AS STRING) AS key")
    return dd.block_pairs(rows, F.array("key"), "source", shared=2)


@query(
    """WITH p AS (SELECT label AS concept_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS x FROM embeddings), c AS (SELECT label AS concept_id, count(*) AS claims, count(DISTINCT vec_id % 7) AS groups FROM embeddings GROUP BY label)
    SELECT concept_id, CAST(pos AS INT) AS pos, round(avg(CAST(x AS DOUBLE)) + 1e-9, 6) AS x, any_value(claims) AS claims, any_value(groups) AS groups FROM p JOIN c USING (concept_id) GROUP BY concept_id, pos"""
)
def concept_centroids(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").selectExpr("label AS concept_id", "embedding AS vector", "vec_id % 7 AS gkey")
    d = dd.centroids(v).select("concept_id", F.posexplode("centroid").alias("pos", "x"), "claims", "groups")
    return d.withColumn("x", F.round(F.col("x") + 1e-9, 6))


_ECHO_SQL = r"""t AS (SELECT doc_id AS id, source AS creator, list_filter(string_split_regex(lower(text), '[ \t\n\r\f\x0B]+'), lambda x: x <> '') AS w FROM documents),
    g AS (SELECT id, creator, list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] || ' ' || w[k + 3] || ' ' || w[k + 4]))) AS grams FROM t WHERE len(w) >= 5),
    cl AS (SELECT grams, min(id) AS id, min(creator) AS lo, max(creator) AS hi FROM g GROUP BY grams)"""


def _echo(spark, sf_dir):
    d = table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "source AS creator", "text")
    scratch = Scratch(spark, "echo")
    return *dd.echo_classes(d, scratch, width=5), scratch


@query(
    rf"""WITH {_ECHO_SQL}, k AS (SELECT id, unnest(grams) AS key FROM cl), c AS (SELECT DISTINCT a.id AS a_id, b.id AS b_id FROM k a JOIN k b ON a.key = b.key AND a.id < b.id)
    SELECT a_id, b_id, round(len(list_intersect(x.grams, y.grams)) / len(list_distinct(list_concat(x.grams, y.grams))) + 1e-9, 6) AS overlap FROM c JOIN cl x ON x.id = a_id JOIN cl y ON y.id = b_id
    WHERE (x.lo <> x.hi OR y.lo <> y.hi OR x.lo <> y.lo) AND len(list_intersect(x.grams, y.grams)) / len(list_distinct(list_concat(x.grams, y.grams))) > 0.6"""
)
def echo_pairs(spark, sf_dir):
    """Different texts of different sources that say nearly the same, each for all its copies (``echo_groups``)."""
    _, classes, scratch = _echo(spark, sf_dir)
    return dd.echo_pairs(classes, scratch).select("a_id", "b_id", F.round(F.col("overlap") + 1e-9, 6).alias("overlap"))


@query(rf"WITH {_ECHO_SQL} SELECT g.id, cl.id AS class_id, cl.lo <> cl.hi AS echoed FROM g JOIN cl ON g.grams = cl.grams")
def echo_groups(spark, sf_dir):
    """The group of equal texts that each document belongs to, and whether several sources have it."""
    members, classes, _ = _echo(spark, sf_dir)
    return members.join(classes.select(F.col("id").alias("class_id"), (F.col("lo") != F.col("hi")).alias("echoed")), "class_id").select("id", "class_id", "echoed")


_BEST = lambda p, k: f"SELECT DISTINCT least(e, o) AS a_id, greatest(e, o) AS b_id FROM (SELECT e, o, row_number() OVER (PARTITION BY e ORDER BY score DESC, o) AS place FROM (SELECT a_id AS e, b_id AS o, score FROM {p} UNION ALL SELECT b_id, a_id, score FROM {p})) WHERE place <= {k}"


@query(
    f"""WITH c AS (SELECT vec_id AS id, 'topic ' || (vec_id % 23) || ' of kind ' || (vec_id % 7) AS title, 'known ' || (vec_id % 61) AS alias, label AS domain, vec_id % 3 AS parent, vec_id % 11 AS leaf, CAST(embedding AS DOUBLE[]) AS v,
      list_distinct(['e' || (vec_id % 29), 'e' || (vec_id % 31), 'e' || (vec_id % 2)]) AS ents,
      list_distinct(flatten(list_transform(string_split('topic ' || (vec_id % 23) || ' of kind ' || (vec_id % 7), ' '), lambda w: list_transform(range(1, length(w) + 2), lambda k: substr('  ' || w || ' ', k, 3))))) AS g FROM embeddings),
    title AS (SELECT a.id AS a_id, b.id AS b_id FROM c a JOIN c b ON a.id < b.id AND list_sort(string_split(replace(a.title, ' of ', ' '), ' ')) = list_sort(string_split(replace(b.title, ' of ', ' '), ' '))), alias AS (SELECT a.id AS a_id, b.id AS b_id FROM c a JOIN c b ON a.id < b.id AND (a.alias = b.alias OR a.title = b.title)),
    n AS (SELECT a.id AS a, b.id AS b, row_number() OVER (PARTITION BY a.id ORDER BY round(list_cosine_similarity(a.v, b.v), 12) DESC, b.id) AS place, list_cosine_similarity(a.v, b.v) AS s FROM c a, c b),
    near AS (SELECT DISTINCT least(a, b) AS a_id, greatest(a, b) AS b_id FROM n WHERE a <> b AND place <= 21 AND s >= 0.75), t AS (SELECT a.id AS a_id, b.id AS b_id, len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))) AS score FROM c a JOIN c b ON a.id < b.id),
    t2 AS (SELECT * FROM t WHERE score >= 0.5), tri AS ({_BEST("t2", 10)}), x AS (SELECT a.id AS a_id, b.id AS b_id, 0 AS score FROM c a JOIN c b ON a.id < b.id AND a.domain = b.domain AND a.parent = b.parent AND a.leaf = b.leaf), tax AS ({_BEST("x", 30)}),
    k AS (SELECT id, unnest(ents) AS e FROM c), f AS (SELECT e FROM k GROUP BY e HAVING count(*) BETWEEN 2 AND 100), r AS (SELECT a.id AS a_id, b.id AS b_id, count(*) AS score FROM k a JOIN k b ON a.e = b.e AND a.id < b.id JOIN f ON f.e = a.e GROUP BY 1, 2 HAVING count(*) >= 2), ent AS ({_BEST("r", 15)}),
    u AS (SELECT *, 'title' AS g FROM title UNION ALL SELECT *, 'alias' FROM alias UNION ALL SELECT *, 'vector' FROM near UNION ALL SELECT *, 'trigram' FROM tri UNION ALL SELECT *, 'taxonomy' FROM tax UNION ALL SELECT *, 'entities' FROM ent)
    SELECT a_id, b_id, array_to_string(list_sort(list(DISTINCT g)), ',') AS generators FROM u GROUP BY a_id, b_id"""
)
def blocking_cascade(spark, sf_dir):
    """All six generators over concepts drawn from the vectors."""
    e = table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS id", "concat('topic ', vec_id % 23, ' of kind ', vec_id % 7) AS title", "array(concat('known ', vec_id % 61)) AS aliases", "embedding AS vector", "CAST(label AS STRING) AS domain",
        "array('top', CAST(vec_id % 3 AS STRING), CAST(vec_id % 11 AS STRING)) AS path", "array(concat('e', vec_id % 29), concat('e', vec_id % 31), concat('e', vec_id % 2)) AS entities",
    )
    return dd.candidate_pairs(e, Scratch(spark, "cascade"), rare=100).select("a_id", "b_id", F.array_join("generators", ",").alias("generators"))


@query(
    """WITH q AS (SELECT a.vec_id AS query, list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), lambda p: 0.8e0 * p[1] + 0.6e0 * p[2]) AS v FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
    SELECT query, vec_id AS id, round(list_cosine_similarity(v, CAST(embedding AS DOUBLE[])), 6) AS score FROM q JOIN embeddings ON list_cosine_similarity(v, CAST(embedding AS DOUBLE[])) >= 0.75"""
)
def indexed_vector_pairs(spark, sf_dir):
    """Blends of neighbouring vectors against all vectors, by the index: what shares no key is never compared."""
    v = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "CAST(embedding AS ARRAY<DOUBLE>) AS vector")
    q = v.join(v.selectExpr("id - 1 AS id", "vector AS other"), "id").selectExpr("id AS query", "zip_with(vector, other, (x, y) -> 0.8e0 * x + 0.6e0 * y) AS vector")
    return similar_vectors(q, v, 0.75, Scratch(spark, "index"), recall=0.9999).select("query", "id", F.round("score", 6).alias("score"))
