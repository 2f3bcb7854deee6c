"""Jobs over relation edges ``(subject_id, predicate, object_id, strength, confidence, ...)``."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from assay.scratch import Scratch, in_rounds, tasks_for

#: Predicate pairs that can't both hold between the same two things.
OPPOSITES = [("causes", "prevents"), ("suitable_for", "unsuitable_for"), ("compatible_with", "incompatible_with")]
ACYCLIC = ("causes", "prevents", "subclass_of", "prerequisite_of", "precedes", "supersedes", "part_of")


def walk(starts: DataFrame, edges: DataFrame, *, depth: int = 4, least: float = 0.05, reverse: bool = False) -> DataFrame:
    """Simple paths ``(start, node, hops, path, score)`` from ``starts(start)``, of up to ``depth`` edges.

    The score is the product of strength and confidence along the path; paths at ``least`` or below are pruned at every
    hop, and no node is visited twice, the start included. ``reverse`` walks from objects to subjects.
    Where starts have a ``context`` and edges ``conditions`` (``context_match``), an edge with a condition known to fail isn't walked, and paths keep their context.
    """
    a, b = ("object_id", "subject_id") if reverse else ("subject_id", "object_id")
    fits = "context" in starts.columns and "conditions" in edges.columns
    kept = ["context"] if "context" in starts.columns else []
    w = F.col("strength") * F.col("confidence")
    if fits:
        # an edge per set of conditions: which of them holds depends on the start
        step = edges.groupBy(F.col(a).alias("node"), F.col(b).alias("next"), "conditions").agg(F.max(w).alias("w"))
    else:
        step = edges.groupBy(F.col(a).alias("node"), F.col(b).alias("next")).agg(F.max(w).alias("w"))
    front = starts.select("start", F.col("start").alias("node"), F.lit(0).alias("hops"), F.array("start").alias("path"), F.lit(1.0).alias("score"), *kept)
    out = None
    for k in range(1, depth + 1):
        front = front.join(step, "node").where(~F.array_contains("path", F.col("next")) & (F.col("score") * F.col("w") > least))
        if fits:
            front = front.where(context_match(F.col("conditions"), F.col("context")) > 0)
        front = front.select("start", F.col("next").alias("node"), F.lit(k).alias("hops"), F.concat("path", F.array("next")).alias("path"), (F.col("score") * F.col("w")).alias("score"), *kept)
        if fits:
            # of edges that differ in conditions alone the best that holds
            front = front.groupBy("start", "node", "hops", "path").agg(F.max("score").alias("score"), F.any_value("context").alias("context"))
        out = front if out is None else out.unionByName(front)
    return out


def diagnose(symptoms: DataFrame, edges: DataFrame, *, predicates: tuple[str, ...] = ("causes",), least_confidence: float = 0.5, **options) -> DataFrame:
    """Causes of each symptom: paths combined as independent evidence, the best path, and how many there are."""
    used = edges.where(F.col("predicate").isin(*predicates) & (F.col("confidence") >= least_confidence))
    paths = walk(symptoms, used, reverse=True, **options)
    return paths.groupBy("start", "node").agg((1 - F.product(1 - F.col("score"))).alias("score"), F.count("*").alias("paths"), F.min("hops").alias("hops"), F.max(F.struct("score", "path"))["path"].alias("best_path"))


def diagnose_in_context(symptoms: DataFrame, edges: DataFrame, nodes: DataFrame, *, predicates: tuple[str, ...] = ("causes", "affects", "indicates"), least_confidence: float = 0.5, **options) -> DataFrame:
    """Causes of symptoms ``(start, context)`` and what is ruled out: rows ``(start, node, score, path_confidence, context_match, card_confidence, paths, hops, best_path, ruled_out, violated)``.

    ``nodes(id, conditions, card_confidence)`` says when a cause applies and how sure its card is; a node that it doesn't name applies always and is sure.
    A path's confidence is the product over its edges of confidence and over the nodes it comes through, the cause included, of theirs; the paths to
    a cause combine as independent evidence (``path_confidence``). A path's score is the product of strength and confidence, times how far the context meets the cause's
    conditions, times the card's confidence; scores combine alike. A cause with a condition known to fail has score 0 and is ruled out, with the first
    such condition as ``variable operator value``. Edges whose own conditions fail aren't walked, weak paths are pruned at every hop, and no more is kept
    of a path than its nodes and products.
    """
    used = edges.where(F.col("predicate").isin(*predicates) & (F.col("confidence") >= least_confidence))
    paths = walk(symptoms, used, reverse=True, **options)
    known = nodes.select(F.col("id").alias("node"), "conditions", F.coalesce("card_confidence", F.lit(1.0)).alias("sure"))
    # confidence along the path, by its steps; each step is one of the few edges walked
    steps = paths.select("start", "path", F.posexplode(F.zip_with(F.slice("path", F.lit(2), F.size("path") - 1), F.slice("path", F.lit(1), F.size("path") - 1), lambda x, y: F.struct(x.alias("subject_id"), y.alias("object_id")))).alias("at", "e"))
    best = used.groupBy("subject_id", "object_id").agg(F.max("confidence").alias("c"))
    steps = steps.select("start", "path", F.col("e.subject_id").alias("subject_id"), F.col("e.object_id").alias("object_id")).join(best, ["subject_id", "object_id"])
    steps = steps.join(known.select(F.col("node").alias("subject_id"), "sure"), "subject_id", "left")
    along = steps.groupBy("start", "path").agg(F.product(F.col("c") * F.coalesce("sure", F.lit(1.0))).alias("path_confidence"))
    d = paths.join(along, ["start", "path"]).join(known, "node", "left").withColumn("match", context_match(F.col("conditions"), F.col("context")))
    failed = F.try_element_at(F.filter("conditions", lambda c: context_match(F.array(c), F.col("context")) == 0), F.lit(1))
    d = d.withColumns({"sure": F.coalesce("sure", F.lit(1.0)), "violated": F.concat_ws(" ", failed["variable"], failed["operator"], failed["value"])})
    total = F.col("score") * F.col("match") * F.col("sure")
    return d.groupBy("start", "node").agg(
        (1 - F.product(1 - total)).alias("score"), (1 - F.product(1 - F.col("path_confidence"))).alias("path_confidence"), F.max("match").alias("context_match"), F.max("sure").alias("card_confidence"), F.count("*").alias("paths"),
        F.min("hops").alias("hops"), F.max(F.struct("score", "path"))["path"].alias("best_path"), (F.max("match") == 0).alias("ruled_out"), F.when(F.max("match") == 0, F.max("violated")).alias("violated"),
    )


def context_match(conditions: Column, context: Column) -> Column:
    """Share of the conditions ``(variable, operator, value)`` that the context map is known to meet; 0 if any is known to fail, 1 without conditions."""

    def met(c: Column) -> Column:
        known = F.try_element_at(context, c["variable"])
        x, y = known.try_cast("double"), c["value"].try_cast("double")
        lo, hi = (F.get(F.split(c["value"], ","), F.lit(k)).try_cast("double") for k in (0, 1))
        op = c["operator"]
        return (
            F.when(known.isNull(), None).when(op == "<", x < y).when(op == "<=", x <= y).when(op == ">", x > y).when(op == ">=", x >= y)
            .when(op == "between", x.between(lo, hi)).when(op == "in", F.array_contains(F.split(c["value"], ","), known)).when(op == "not", known != c["value"]).otherwise(known == c["value"])
        )

    n = F.size(conditions)
    failed = F.exists(conditions, lambda c: F.coalesce(~met(c), F.lit(False)))
    return F.when(conditions.isNull() | (n == 0), 1.0).when(failed, 0.0).otherwise(F.size(F.filter(conditions, lambda c: F.coalesce(met(c), F.lit(False)))) / n)


def opposites(edges: DataFrame, pairs: list[tuple[str, str]] = OPPOSITES, symmetric: tuple[str, ...] = ("compatible_with", "incompatible_with")) -> DataFrame:
    """Pairs of contradicting predicates between the same two nodes, in either direction where they are symmetric."""
    low, high = F.least("subject_id", "object_id"), F.greatest("subject_id", "object_id")
    both = F.col("predicate").isin(*symmetric)
    e = edges.select(F.when(both, low).otherwise(F.col("subject_id")).alias("x"), F.when(both, high).otherwise(F.col("object_id")).alias("y"), "predicate").distinct()
    known = edges.sparkSession.createDataFrame(pairs, "predicate string, other string")
    a = e.join(F.broadcast(known), "predicate")  # a fixed table of three rows
    return a.join(e.select("x", "y", F.col("predicate").alias("other")), ["x", "y", "other"]).select("x", "y", "predicate", "other")


def degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("subject_id", "object_id")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("degree"))


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.select("id").join(degrees(edges), "id", "left_anti")


def prunable(edges: DataFrame) -> DataFrame:
    """Edges A to C that only repeat A to B to C of the same predicate: all their evidence lies in the two steps.

    Rows are dealt into tasks by their number, as few bytes of ids make many rows.
    """
    n = tasks_for(edges)
    e = edges.select("subject_id", "predicate", "object_id", "evidence_claims")
    a = e.select("subject_id", "predicate", F.col("object_id").alias("mid"), F.col("evidence_claims").alias("e1"))
    b = e.select(F.col("subject_id").alias("mid"), "predicate", "object_id", F.col("evidence_claims").alias("e2"))
    via = a.repartition(n, "mid", "predicate").join(b.repartition(n, "mid", "predicate"), ["mid", "predicate"]).where("subject_id != object_id and mid != subject_id and mid != object_id")
    triple = ["subject_id", "predicate", "object_id"]
    d = via.repartition(n, *triple).join(e.repartition(n, *triple), triple).where(F.size(F.array_except("evidence_claims", F.concat("e1", "e2"))) == 0)
    return d.select("subject_id", "predicate", "object_id").distinct()


def relations_from_claims(claims: DataFrame, predicates: DataFrame, cap: float = 0.75) -> DataFrame:
    """Causal and correlational claims with subject, known predicate and object, as one edge per triple.

    The id is a hash of the triple; what a model inferred is capped in confidence. Claims are dealt into tasks by their number, so a task's sets don't grow with the table.
    """
    c = claims.where(F.col("claim_type").isin("causal", "correlational") & F.col("subject").isNotNull() & F.col("object").isNotNull()).join(predicates, "predicate", "left_semi")
    conf = F.when(F.col("model_inferred"), F.least(F.lit(cap), F.col("confidence"))).otherwise(F.col("confidence"))
    c = c.select(F.col("subject").alias("subject_id"), "predicate", F.col("object").alias("object_id"), "claim_id", conf.alias("confidence")).repartition(tasks_for(claims), "subject_id", "predicate", "object_id")
    d = c.groupBy("subject_id", "predicate", "object_id").agg(F.max("confidence").alias("confidence"), F.array_sort(F.collect_set("claim_id")).alias("evidence_claims"))
    key = F.concat_ws("\u001f", F.col("subject_id").cast("string"), "predicate", F.col("object_id").cast("string"))
    return d.withColumn("id", F.concat(F.lit("rel_"), F.substring(F.sha2(key, 256), 1, 12)))


def _jumped(single: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows ``(id, root, w)`` of nodes ``(id, root, w)`` that each follow one other: the first node up the chain that isn't one of them, and the length of the way.

    Pointers double, so a chain of n nodes takes log n rounds. Nodes on a ring, and those that follow one, have no such
    node and are left out: their number is what a doubling no longer lowers.
    """
    p, open_, before = single, None, None
    while True:
        up = p.select(F.col("id").alias("root"), F.col("root").alias("r2"), F.col("w").alias("w2"), F.lit(True).alias("on"))
        # nodes without a predecessor of their own, marked by null, are ends
        d = p.join(up, "root", "left").select("id", F.when(F.col("on"), F.col("r2")).otherwise(F.col("root")).alias("root"), (F.col("w") + F.coalesce("w2", F.lit(0))).alias("w"), F.coalesce("on", F.lit(False)).alias("open"))
        d = scratch.save(d, "jumped")
        if open_ is not None:
            scratch.drop(p)
        open_ = d.where("open").count()
        p = d.select("id", "root", "w")
        p._scratch_path = d._scratch_path
        if open_ == 0:
            return p
        if open_ == before:
            ends = d.where("not open").select("id", "root", "w")
            ends._scratch_path = d._scratch_path
            return ends
        before = open_


@in_rounds
def topological_levels(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows ``(id, level)``, the length of the longest way to a node, and the edges ``(a, b)`` left over, which lie on or behind cycles.

    In each round every node with one predecessor is drawn into the end of the chain of such nodes that it hangs on, at its distance; edges
    move along, and of those that now join the same two nodes the longest stays. Nodes without predecessors count
    as following the beginning, so what is level there falls away in the same step. Chains, however long, and trees take one round of
    doubling pointers; otherwise the rounds are at most as many as the longest way has nodes of several predecessors.
    Levels come back in the opposite order. Null ends are ignored; a loop is a cycle.
    """
    all_ = scratch.save(edges.select(F.col("subject_id").alias("a"), F.col("object_id").alias("b")).where("a is not null and b is not null").distinct(), "edges")
    nodes = all_.select(F.col("a").alias("b")).distinct().join(all_.select("b"), "b", "left_anti")
    start = nodes.select(F.lit(None).cast(all_.schema["a"].dataType).alias("a"), "b", F.lit(0).alias("w"))
    e, hung, k = scratch.save(all_.withColumn("w", F.lit(1)).unionByName(start), "open"), [], 0
    while True:
        into = e.groupBy("b").agg(F.count("*").alias("n"), F.min("a").alias("root"), F.max("w").alias("w"))
        single = scratch.save(into.where("n = 1").select(F.col("b").alias("id"), "root", "w"), f"single{k}")
        if single.isEmpty():
            break
        ends = _jumped(single, scratch)
        rest = e.join(single.select(F.col("id").alias("b")), "b", "left_anti")
        to = ends.select(F.col("id").alias("a"), "root", F.col("w").alias("more"), F.lit(True).alias("drawn"))
        # what hangs on a ring keeps its edge there and never comes free
        moved = rest.join(to, "a", "left").select(F.when(F.col("drawn"), F.col("root")).otherwise(F.col("a")).alias("a"), "b", (F.col("w") + F.coalesce("more", F.lit(0))).alias("w"))
        old, e = e, scratch.save(moved.groupBy("a", "b").agg(F.max("w").alias("w")), f"open{k}")
        scratch.drop(old, single)
        hung.append(ends)
        k += 1
    levels = None
    for ends in reversed(hung):
        here = ends.where("root is null").select("id", F.col("w").alias("level"))
        if levels is not None:
            # a root without a level is on or behind a cycle, and so is what hangs on it
            later = ends.where("root is not null").join(levels.select(F.col("id").alias("root"), "level"), "root").select("id", (F.col("level") + F.col("w")).alias("level"))
            here = levels.unionByName(here).unionByName(later)
        levels = scratch.save(here, "levels")
    if levels is None:
        levels = all_.select(F.col("a").alias("id"), F.lit(0).alias("level")).limit(0)
    scratch.drop(*hung)
    return levels, all_.join(levels.select(F.col("id").alias("a")), "a", "left_anti").select("a", "b")


@in_rounds
def strong_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows ``(id, component)`` of the nodes on cycles: the smallest id that a node reaches and that reaches it. Nodes on no cycle have no row.

    What topological levels leave from the front, and of that from the back, are cycles and the ways between them. Chains
    there, of nodes with one edge in and one out, shrink to single edges by doubling pointers, rings of them to one node. On the rest, colours: the
    smallest id that reaches a node is passed on until nothing changes, and the nodes that reach their colour's own node along that colour are its component;
    edges between colours fall away, and what isn't in a component yet goes on. Null ends are ignored.
    """
    own = edges.where("subject_id = object_id").select(F.col("subject_id").alias("id"))
    _, left = topological_levels(edges, scratch)
    _, both = topological_levels(left.select(F.col("b").alias("subject_id"), F.col("a").alias("object_id")), scratch)
    e = scratch.save(both.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a != b").distinct(), "core")
    ends = e.groupBy(F.col("b").alias("id")).agg(F.count("*").alias("n_in"), F.min("a").alias("root")).join(e.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_out"), F.min("b").alias("to")), "id")
    inner = scratch.save(ends.where("n_in = 1 and n_out = 1").select("id", "root", "to"), "inner")
    back = _jumped(inner.select("id", "root", F.lit(1).alias("w")), scratch).select("id", F.col("root").alias("from"))
    forth = _jumped(inner.select("id", F.col("to").alias("root"), F.lit(1).alias("w")), scratch).select("id", F.col("root").alias("to"))
    chains = scratch.save(back.join(forth, "id"), "chains")
    rings = _ring_minima(inner.join(chains, "id", "left_anti").select("id", F.col("to")), scratch)
    short = e.join(inner.select(F.col("id").alias("a")), "a", "left_anti").join(inner.select(F.col("id").alias("b")), "b", "left_anti").select("a", "b")
    open_ = scratch.save(short.unionByName(chains.select(F.col("from").alias("a"), F.col("to").alias("b"))).distinct(), "short")
    looped = open_.where("a = b").select(F.col("a").alias("id"))
    open_, found, k = scratch.save(open_.where("a != b"), "open"), looped.limit(0).select("id", F.col("id").alias("component")), 0
    while not open_.isEmpty():
        colour = _spread(open_.select("a", "b"), open_.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("c")), scratch)
        inside = open_.join(colour.select(F.col("id").alias("a"), "c"), "a").join(colour.select(F.col("id").alias("b"), F.col("c").alias("c2")), "b").where("c = c2").select("a", "b", "c")
        inside = scratch.save(inside, f"inside{k}")
        reached = front = colour.where("id = c").select("id", "c")
        while True:
            step = inside.join(front.select(F.col("id").alias("b"), "c"), ["b", "c"]).select(F.col("a").alias("id"), "c").distinct()
            front = scratch.save(step.join(reached, ["id", "c"], "left_anti"), "front")
            if front.isEmpty():
                break
            reached = reached.unionByName(front)
        done = scratch.save(reached.select("id", F.col("c").alias("component")), f"done{k}")
        sizes = done.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
        found = found.unionByName(done.join(sizes, "component", "left_semi"))
        rest = inside.join(done.select(F.col("id").alias("a")), "a", "left_anti").join(done.select(F.col("id").alias("b")), "b", "left_anti")
        open_ = scratch.save(rest.select("a", "b"), f"open{k}")
        k += 1
    core = scratch.save(found.unionByName(looped.join(found, "id", "left_anti").select("id", F.col("id").alias("component"))), "found")
    at = lambda name: core.select(F.col("id").alias(name), F.col("component").alias(f"{name}_c"))
    between = chains.join(at("from"), "from").join(at("to"), "to").where("from_c = to_c").select("id", F.col("from_c").alias("component"))
    all_ = core.unionByName(between)
    named = all_.groupBy("component").agg(F.min("id").alias("least"))
    all_ = all_.join(named, "component").select("id", F.col("least").alias("component")).unionByName(rings)
    alone = own.distinct().join(all_, "id", "left_anti").select("id", F.col("id").alias("component"))
    return scratch.save(all_.unionByName(alone), "components")


def _ring_minima(ring: DataFrame, scratch: Scratch) -> DataFrame:
    """Of nodes ``(id, to)`` on rings the smallest id of the ring, by doubling pointers until no minimum falls."""
    p, k = scratch.save(ring.select("id", "to", F.col("id").alias("low")), "ring"), 0
    while True:
        up = p.select(F.col("id").alias("to"), F.col("to").alias("t2"), F.col("low").alias("l2"))
        d = p.join(up, "to").select("id", F.col("t2").alias("to"), F.least("low", "l2").alias("low"), (F.col("l2") < F.col("low")).alias("fell"))
        d = scratch.save(d, f"ring{k}")
        scratch.drop(p)
        p, k = d, k + 1
        if d.where("fell").isEmpty():
            return d.select("id", F.col("low").alias("component"))


def _spread(edges: DataFrame, colours: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows ``(id, c)``: the smallest colour that reaches a node along the edges; only nodes whose colour fell pass it on."""
    all_ = scratch.save(colours, "colours")
    news = all_
    while True:
        got = edges.join(news.select(F.col("id").alias("a"), F.col("c").alias("n")), "a").groupBy(F.col("b").alias("id")).agg(F.min("n").alias("n"))
        d = scratch.save(all_.join(got, "id", "left").select("id", F.least("c", "n").alias("c"), F.coalesce(F.col("n") < F.col("c"), F.lit(False)).alias("fell")), "colours")
        scratch.drop(all_)
        all_ = d
        news = d.where("fell").select("id", "c")
        if news.isEmpty():
            return d.select("id", "c")


def cycle_edges(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges ``(a, b)`` on cycles: both ends are in one strong component."""
    c = strong_components(edges, scratch)
    e = edges.select(F.col("subject_id").alias("a"), F.col("object_id").alias("b")).distinct()
    at = lambda name: c.select(F.col("id").alias(name), F.col("component").alias(f"{name}_c"))
    return e.join(at("a"), "a").join(at("b"), "b").where("a_c = b_c").select("a", "b")


@in_rounds
def cycle_review(edges: DataFrame, allowed: DataFrame, scratch: Scratch, predicates: tuple[str, ...] = ACYCLIC) -> DataFrame:
    """Rows ``(component, nodes, edges, open_edges, review)``: the cycles of predicates that should have none.

    ``allowed(subject_id, predicate, object_id)`` lists the edges of feedback loops that a person has confirmed; a component is
    flagged for review unless all its edges are among them.
    """
    e = scratch.save(edges.where(F.col("predicate").isin(*predicates)).select("subject_id", "predicate", "object_id").distinct(), "acyclic")
    c = strong_components(e, scratch)
    at = lambda name: c.select(F.col("id").alias(name), F.col("component").alias(f"{name}_c"))
    inside = e.join(at("subject_id"), "subject_id").join(at("object_id"), "object_id").where("subject_id_c = object_id_c")
    known = allowed.select("subject_id", "predicate", "object_id", F.lit(True).alias("known")).distinct()
    judged = inside.join(known, ["subject_id", "predicate", "object_id"], "left").groupBy(F.col("subject_id_c").alias("component"))
    judged = judged.agg(F.count("*").alias("edges"), F.count_if(F.col("known").isNull()).alias("open_edges"))
    size = c.groupBy("component").agg(F.count("*").alias("nodes"))
    found = judged.join(size, "component").select("component", "nodes", "edges", "open_edges", (F.col("open_edges") > 0).alias("review"))
    return scratch.save(found, "reviewed")


def curriculum(cards: DataFrame, edges: DataFrame, domain: str | list[str], skill: int, scratch: Scratch) -> DataFrame:
    """Rows ``(id, level)`` of the cards of some domains up to a level of skill, by the prerequisites among them; a card without any is at level 0.

    ``cards(id, domain, skill_level)``; ``edges`` of the predicates ``prerequisite_of`` (subject first) and ``requires`` (object first). Cards on or behind a cycle have no row.
    """
    domains = [domain] if isinstance(domain, str) else domain
    c = scratch.save(cards.where(F.col("domain").isin(*domains) & (F.col("skill_level") <= skill)).select("id").distinct(), "cards")
    first = F.when(F.col("predicate") == "requires", F.col("object_id")).otherwise(F.col("subject_id"))
    then = F.when(F.col("predicate") == "requires", F.col("subject_id")).otherwise(F.col("object_id"))
    e = edges.where(F.col("predicate").isin("prerequisite_of", "requires")).select(first.alias("subject_id"), then.alias("object_id"))
    for end in ("subject_id", "object_id"):
        e = e.join(c.select(F.col("id").alias(end)), end, "left_semi")
    e = scratch.save(e, "prerequisites")
    levels, _ = topological_levels(e, scratch)
    lone = c.join(e.select(F.explode(F.array("subject_id", "object_id")).alias("id")).distinct(), "id", "left_anti")
    return levels.unionByName(lone.select("id", F.lit(0).alias("level")))


def communities(edges: DataFrame, scratch: Scratch, rounds: int = 5) -> DataFrame:
    """Rows ``(id, module)`` by label propagation: each round a node takes the label most of its neighbours have, the smallest on a tie."""
    both = edges.select(F.col("subject_id").alias("id"), F.col("object_id").alias("n")).unionAll(edges.select("object_id", "subject_id")).where("id != n").distinct()
    both = scratch.save(both, "both")
    labels = both.select("id").distinct().withColumn("module", F.col("id"))
    for k in range(rounds):
        votes = both.join(labels.select(F.col("id").alias("n"), "module"), "n").groupBy("id", "module").count()
        best = votes.groupBy("id").agg(F.max(F.struct("count", (-F.col("module")).alias("m")))["m"].alias("m"))
        labels = scratch.save(best.select("id", (-F.col("m")).alias("module")), f"labels{k}")
    return labels


def expand(results: DataFrame, edges: DataFrame, predicates: DataFrame, share: float = 0.7) -> DataFrame:
    """One hop from each result along the predicates of its query type; ``results(query, qtype, id, score)``, ``predicates(qtype, predicate)``."""
    d = results.join(F.broadcast(predicates), "qtype").join(edges.select("subject_id", "predicate", "object_id"), (F.col("id") == F.col("subject_id")) & (predicates["predicate"] == edges["predicate"]))
    hop = d.groupBy("query", F.col("object_id").alias("id")).agg(F.max(F.col("score") * share).alias("score"))
    return hop.join(results.select("query", "id"), ["query", "id"], "left_anti")


def first_paths(pairs: DataFrame, edges: DataFrame, depth: int = 4, scratch: Scratch | None = None) -> DataFrame:
    """The fewest hops from ``a`` to ``b`` along edges, up to ``depth``, with one path (the smallest).

    Breadth first: a node that a start has reached is never walked again from that start, and of the paths that reach it at once only
    the smallest goes on, so what is held grows with the nodes reached, not with the paths.
    """
    step = edges.select(F.col("subject_id").alias("node"), F.col("object_id").alias("next")).where("node <> next").distinct()
    front = pairs.select(F.col("a").alias("start")).distinct().select("start", F.col("start").alias("node"), F.lit(0).alias("hops"), F.array("start").alias("path"))
    seen = front
    for k in range(1, depth + 1):
        reached = front.join(step, "node").groupBy("start", "next").agg(F.min("path").alias("path"))
        front = reached.select("start", F.col("next").alias("node"), F.lit(k).alias("hops"), F.concat("path", F.array("next")).alias("path")).join(seen, ["start", "node"], "left_anti")
        front = scratch.save(front.select(*seen.columns), f"hop{k}") if scratch else front.select(*seen.columns)
        seen = seen.unionByName(front)
    d = seen.where("hops > 0").join(pairs.select(F.col("a").alias("start"), F.col("b").alias("node")).distinct(), ["start", "node"])
    return d.select(F.col("start").alias("a"), F.col("node").alias("b"), "hops", "path")


def sampled_betweenness(edges: DataFrame, scratch: Scratch, *, error: float = 0.1, doubt: float = 0.1) -> DataFrame:
    """Rows ``(id, score, bound)``: betweenness of every node that lies on a shortest path between others, from as many pivots as the bound asks for.

    With probability 1 - ``doubt`` no score is off by more than ``bound``, which is ``error`` times n (n - 2) for n nodes: ln(2 n / doubt) / (2 error ** 2) pivots
    suffice, since what a pivot adds lies between 0 and n - 2. Pivots are those of smallest hash; their scores are scaled to all nodes. Where that many
    are all nodes, scores are exact and the bound is 0. Paths of any length count. A graph of up to 64 MB is sent to the pivots, a larger one stays and is walked level by level.
    """
    ends = scratch.save(edges.where("subject_id <> object_id").select(F.explode(F.array("subject_id", "object_id")).alias("id")).distinct(), "nodes")
    n = ends.count()
    k = min(n, math.ceil(math.log(2 * max(n, 1) / doubt) / (2 * error**2)))
    pivots = ends.orderBy(F.xxhash64("id"), "id").limit(k).select(F.col("id").alias("pivot"))
    pivots = scratch.save(pivots, "pivots")
    steps = scratch.save(edges.where("subject_id <> object_id").select("subject_id", "object_id").distinct(), "steps")
    if steps.agg(F.coalesce(F.sum(sum(F.octet_length(F.col(c).cast("string")) if t == "string" else F.lit(8) for c, t in steps.dtypes)), F.lit(0))).first()[0] <= _SENT:
        found = betweenness_where_sent(steps, pivots)
    else:
        found = betweenness(steps, pivots, scratch, None)
    return found.select("id", (F.col("score") * (n / max(1, k))).alias("score"), F.lit(0.0 if k == n else error * n * (n - 2)).alias("bound"))


#: Bytes of a graph's ends up to which it is sent to where its pivots lie.
_SENT = 64 << 20


def _walked(first: np.ndarray, to: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """What ``betweenness`` counts for each node, over pivots whose paths have any length; node ``v`` has the steps ``to[first[v]:first[v + 1]]``."""
    n = len(first) - 1
    total, place = np.zeros(n), np.zeros(n, np.int64)
    degree = np.diff(first)

    def fan(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every step from the nodes the place of its start among them, and its end."""
        sizes = degree[nodes]
        at = np.repeat(np.arange(len(nodes)), sizes)
        return at, to[np.arange(len(at)) + (first[nodes] - np.cumsum(sizes) + sizes)[at]]

    for pivot in pivots:
        depth, paths, behind = np.full(n, -1, np.int32), np.zeros(n), np.zeros(n)
        depth[pivot], paths[pivot] = 0, 1
        levels = [np.array([pivot])]
        while True:
            at, end = fan(levels[-1])
            on = depth[end] < 0
            at, end = at[on], end[on]
            if not len(end):
                break
            place[end] = np.arange(len(end))
            fresh = end[place[end] == np.arange(len(end))]  # each once
            place[fresh] = np.arange(len(fresh))
            paths[fresh] = np.bincount(place[end], weights=paths[levels[-1]][at], minlength=len(fresh))
            depth[fresh] = len(levels)
            levels.append(fresh)
        for k in range(len(levels) - 2, 0, -1):
            at, end = fan(levels[k])
            on = depth[end] == k + 1
            at, end = at[on], end[on]
            behind[levels[k]] = paths[levels[k]] * np.bincount(at, weights=(1 + behind[end]) / paths[end], minlength=len(levels[k]))
        total += behind
    return total


def betweenness_where_sent(edges: DataFrame, pivots: DataFrame) -> DataFrame:
    """``betweenness`` over paths of any length of distinct edges ``(subject_id, object_id)`` between different nodes: the whole graph is sent to all tasks, which deal the pivots among them."""
    t = edges.select("subject_id", "object_id").where("subject_id is not null and object_id is not null").toArrow()
    both = pa.chunked_array([*t.column(0).chunks, *t.column(1).chunks], t.schema.field(0).type).combine_chunks().dictionary_encode()
    names, (v, w) = both.dictionary, np.split(np.array(both.indices, np.int32), 2)
    order = np.argsort(v, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(v, minlength=len(names)))]).astype(np.int64)
    sc = edges.sparkSession.sparkContext
    sent = sc.broadcast((names, first, w[order]))

    def walk_from(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, first, to = sent.value
        own = pc.drop_null(pc.index_in(pa.chunked_array([b.column(0) for b in batches], names.type), names))
        if len(own):
            total = _walked(first, to, np.array(own))
            some = np.flatnonzero(total > 0)
            yield from pa.table({"id": names.take(pa.array(some)), "score": total[some]}).combine_chunks().to_batches(max_chunksize=65536)

    tasks = max(1, min(sc.defaultParallelism, pivots.count()))
    numbered = pivots.select("pivot").distinct().withColumn("n", F.row_number().over(Window.orderBy("pivot")))  # as few as the bound asks for
    found = numbered.repartitionByRange(tasks, "n").select("pivot").mapInArrow(walk_from, f"id {edges.schema['subject_id'].dataType.simpleString()}, score double")
    return found.groupBy("id").agg(F.sum("score").alias("score")).where("score > 0")


#: Pivots of a block, which have a bit each in a node's row, and rows of a task.
_BLOCK, _TASK_ROWS = 64, 1 << 15


def _bits(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every bit set in the masks, by row and bit."""
    return np.nonzero(np.unpackbits(np.ascontiguousarray(masks, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.float64()))


def _keys(*tables: pa.Table) -> list[np.ndarray]:
    """A number for every row of each table, the same for the same block and id."""
    block, id_ = (pa.chunked_array([c for t in tables for c in t[name].chunks], tables[0].schema.field(name).type).combine_chunks().dictionary_encode() for name in ("block", "id"))
    both = np.array(block.indices, np.int64) * max(1, len(id_.dictionary)) + np.array(id_.indices, np.int64)
    return np.split(np.unique(both, return_inverse=True)[1], np.cumsum([len(t) for t in tables])[:-1])


def _added(t: pa.Table) -> pa.Table:
    """One row per block and id of rows ``(block, id, bits, vals)``: all bits set, and the sum of their values for each."""
    (key,) = _keys(t)
    row, bit = _bits(np.array(t["bits"]))
    n = int(key.max()) + 1 if len(key) else 0
    cell = key[row] * _BLOCK + bit
    total, on = np.bincount(cell, weights=np.array(t["vals"].combine_chunks().flatten()), minlength=n * _BLOCK), np.zeros(n * _BLOCK, bool)
    on[cell] = True
    first = np.unique(key, return_index=True)[1]
    masks = np.packbits(on.reshape(n, _BLOCK), axis=1, bitorder="little").view("<i8").ravel()
    return pa.table({"block": t["block"].take(first), "id": t["id"].take(first), "bits": masks.astype(np.int64), "vals": _lists(total[on], on.reshape(n, _BLOCK).sum(axis=1))})


def _sent(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows for the same node that leave one task, added up as they come, so the many neighbours of a node send few; with ``whole`` one row per block and node."""
    held, fresh = [], 0
    for batch in batches:
        if len(batch):
            held.append(pa.Table.from_batches([batch]))
            fresh += len(batch)
        if fresh >= 1 << 16:
            held, fresh = [_added(pa.concat_tables(held))], 0
            if not whole:
                yield from held.pop().combine_chunks().to_batches(max_chunksize=8192)
    if held:
        yield from _added(pa.concat_tables(held)).combine_chunks().to_batches(max_chunksize=None if whole else 8192)


def _all_sent(batches: Iterator[pa.RecordBatch], own: list[pa.Table]) -> pa.Table | None:
    """What was sent to the nodes of a task, ``(block, id, bits, vals)``, added up; the rows ``(block, id, kept, paths)`` that nodes keep of themselves go to ``own``."""
    names = ["block", "id", "bits", "vals"]

    def sent() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            mine = pc.is_valid(t["kept"])
            own.append(t.filter(mine).select(["block", "id", "kept", "paths"]))
            yield from t.filter(pc.invert(mine)).select(names).combine_chunks().to_batches()

    got = [pa.Table.from_batches([b]) for b in _sent(sent(), whole=True)]
    if got or not own:
        return pa.concat_tables(got) if got else None
    return own[0].select(["block", "id"]).slice(0, 0).append_column("bits", pa.array([], pa.int64())).append_column("vals", pa.array([], pa.list_(pa.float64())))


def betweenness(edges: DataFrame, pivots: DataFrame, scratch: Scratch, most: int | None = 20) -> DataFrame:
    """Rows ``(id, score)``: how many shortest paths from the pivots ``(pivot)`` run through a node, each path's share counted; up to ``most`` hops (None: any number).

    With all nodes as pivots it is exact; with a sample it is an estimate, to be scaled by the share of pivots.
    Paths are counted level by level outwards and their shares gathered level by level back. Pivots go in blocks of 64: a row is a node and a block, with
    a bit for each pivot that has reached it and the numbers of paths of those that do so at this level. So a level moves a row of marks per node and
    block and only the numbers that are new, whatever was reached before.
    """
    e = scratch.save(edges.select(F.col("subject_id").alias("v"), F.col("object_id").alias("w")).where("v != w").distinct(), "edges")
    chosen = scratch.save(pivots.select("pivot").distinct(), "chosen")
    k = chosen.count()
    # numbers run on within a task, so few tasks leave few blocks unfilled
    numbered = scratch.save(chosen.coalesce(-(-max(1, k) // 4096)).withColumn("n", F.monotonically_increasing_id()), "numbered")
    at = numbered.select(F.shiftright("n", 6).alias("block"), F.col("pivot").alias("id"), F.expr("shiftleft(1L, CAST(n & 63 AS INT))").alias("bits"))
    level = scratch.save(at.select("block", "id", F.col("bits").alias("seen"), "bits", F.array(F.lit(1.0)).alias("vals")), "level0")
    node = e.schema["v"].dataType.simpleString()
    # every node may meet every block
    rows = e.select(F.explode(F.array("v", "w")).alias("id")).distinct().count() * -(-max(1, k) // _BLOCK)
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-rows // _TASK_ROWS))

    def met(kept: DataFrame, send: DataFrame, to: str, by: str) -> DataFrame:
        """What nodes keep, ``(block, id, kept, paths)``, in one place with what their neighbours send."""
        out = send.join(e.select(F.col(by).alias("id"), F.col(to).alias("to")), "id").select("block", F.col("to").alias("id"), "bits", "vals")
        out = out.mapInArrow(_sent, f"block long, id {node}, bits long, vals array<double>")
        return kept.unionByName(out, allowMissingColumns=True).repartition(tasks, "block", "id")

    def forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, none = [], np.zeros(0)
        got = _all_sent(batches, own)
        if not own:
            return
        mine = pa.concat_tables(own)
        k_own, k_got = _keys(mine, got)
        seen = np.zeros(len(mine) + len(got), np.int64)
        seen[k_own] = np.array(mine["kept"], np.int64)
        sent = np.array(got["bits"], np.int64)
        new = sent & ~seen[k_got]
        row, bit = _bits(sent)
        fresh = (new[row] >> bit) & 1 == 1
        vals = _lists(np.array(got["vals"].combine_chunks().flatten())[fresh], np.bincount(row[fresh], minlength=len(got)))
        rest = mine.filter(pa.array(~np.isin(k_own, k_got)))
        zero = np.zeros(len(rest), np.int64)
        for t in (
            pa.table({"block": got["block"], "id": got["id"], "seen": seen[k_got] | new, "bits": new, "vals": vals}),
            pa.table({"block": rest["block"], "id": rest["id"], "seen": rest["kept"], "bits": zero, "vals": _lists(none, zero)}),
        ):
            yield from t.combine_chunks().to_batches(max_chunksize=8192)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = []
        got = _all_sent(batches, own)
        if not own:
            return
        mine = pa.concat_tables(own)
        k_own, k_got = _keys(mine, got)
        behind = np.zeros((len(mine) + len(got)) * _BLOCK)
        row, bit = _bits(np.array(got["bits"], np.int64))
        behind[k_got[row] * _BLOCK + bit] = np.array(got["vals"].combine_chunks().flatten())
        row, bit = _bits(np.array(mine["kept"], np.int64))
        paths = np.array(mine["paths"].combine_chunks().flatten())
        share = paths * behind[k_own[row] * _BLOCK + bit]
        vals = _lists((1 + share) / paths, np.bincount(row, minlength=len(mine)))
        t = pa.table({"block": mine["block"], "id": mine["id"], "bits": mine["kept"], "vals": vals, "share": np.bincount(row, weights=share, minlength=len(mine))})
        yield from t.combine_chunks().to_batches(max_chunksize=8192)

    levels = [level]
    while most is None or len(levels) <= most:
        kept = level.select("block", "id", F.col("seen").alias("kept"), F.lit(None).cast("array<double>").alias("paths"))
        step = met(kept, level.where("bits <> 0"), "w", "v").select("block", "id", "kept", "paths", "bits", "vals")
        level = scratch.save(step.mapInArrow(forth, f"block long, id {node}, seen long, bits long, vals array<double>"), f"level{len(levels)}")
        if level.where("bits <> 0").isEmpty():
            break
        levels.append(level)
    found = None
    share = levels[-1].where("bits <> 0").select("block", "id", "bits", F.transform("vals", lambda x: 1 / x).alias("vals"))
    for below in reversed(levels[1:-1]):
        kept = below.where("bits <> 0").select("block", "id", F.col("bits").alias("kept"), F.col("vals").alias("paths"))
        step = met(kept, share, "v", "w").select("block", "id", "kept", "paths", "bits", "vals")
        share = scratch.save(step.mapInArrow(back, f"block long, id {node}, bits long, vals array<double>, share double"), "share")
        part = share.select("id", "share")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = level.select("id", F.lit(0.0).alias("share")).limit(0)
    return found.groupBy("id").agg(F.sum("share").alias("score")).where("score > 0")
