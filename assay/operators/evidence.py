"""From claims to evidence, confidence and the decision to publish."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from assay import vocab
from assay.scratch import tasks_for


def lookup(key: Column, values: Mapping[str, float], default: float) -> Column:
    """A small fixed table as a map literal, with a default for unknown keys and nulls."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(default))


def tier_weight(tier: Column) -> Column:
    return lookup(tier, vocab.TIER_WEIGHT, vocab.UNKNOWN_TIER_WEIGHT)


def step(value: Column, steps: list[tuple[float, str]], lowest: str) -> Column:
    """The name of the first step that the value reaches."""
    first, *rest = steps
    return reduce(lambda c, s: c.when(value >= s[0], s[1]), rest, F.when(value >= first[0], first[1])).otherwise(lowest)


def band_for(score: Column) -> Column:
    return step(score, vocab.BANDS, vocab.LOWEST_BAND)


def corroboration(groups: Column, k: float = 3.0) -> Column:
    """Independent groups, not sources, earn trust, with falling returns; negative counts as none."""
    return 1 - F.exp(-F.greatest(groups, F.lit(0)) / F.lit(k))


def noisy_or(p: Column) -> Column:
    """Aggregate: one minus the product of the complements, clamped to 0..1."""
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    return F.round(1 - F.product(1 - clamped), 3)


def group_key(group: Column, creator: Column) -> Column:
    """A creator without a recorded group is a group of one."""
    return F.coalesce(F.when(group != "", F.concat(F.lit("g:"), group)), F.concat(F.lit("c:"), creator.cast("string")))


#: Claims from which on a concept is summed in several places.
_MANY = 1 << 17


def evidence(claims: DataFrame, sources: DataFrame, creators: DataFrame) -> DataFrame:
    """One row per concept with everything that confidence and promotion read.

    Sources join their creators first, then claims their source (missing ones count as unknown), so claims move once for it. They move
    once more, as they are, to where their concept is summed: by group and creator, by group, and as a whole, which gives the counts of distinct
    creators and groups without a row expanded, and only sums move after that. A concept with very many claims lies in as many places as it has groups.
    Claims are dealt into tasks by their number both times, so what a task sorts and sums doesn't grow with the table, and isn't spilled.
    """
    tasks = max(claims.sparkSession.sparkContext.defaultParallelism, tasks_for(claims))
    hot = [r[0] for r in claims.groupBy("concept_id").count().where(F.col("count") > _MANY).select("concept_id").collect()]
    s = sources.select("source_id", "creator_id", "published_at", "commercial_context", "asr_confidence")
    s = s.join(creators.select("creator_id", "independence_group", "reliability"), "creator_id", "left")
    tiers, stances = list(vocab.TIER_WEIGHT), ["supports", "contradicts"]
    place_of = lambda values, c: F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c)), F.lit(0)).cast("int")
    reported = F.when(F.col("is_reported_from_other").isNull(), 2).otherwise(F.col("is_reported_from_other").cast("int"))
    # what a claim says of itself travels as one number: its tier's place, its stance's and whether it is reported
    code = (place_of(tiers, "evidence_tier") * 3 + place_of(stances, "stance")) * 3 + reported
    c = claims.select("source_id", "concept_id", "hedge_level", "extraction_certainty", code.alias("code")).repartition(tasks, "source_id").join(s.repartition(tasks, "source_id"), "source_id", "left")
    key = F.coalesce(group_key(F.col("independence_group"), F.col("creator_id")), F.concat(F.lit("s:"), F.col("source_id").cast("string")))
    c = c.select("concept_id", "hedge_level", "extraction_certainty", "code", "creator_id", "published_at", "asr_confidence", "reliability", (F.col("commercial_context") != "organic").alias("commercial"), key.alias("gkey"))
    place = ["concept_id", "part"] if hot else ["concept_id"]
    c = (c.withColumn("part", F.when(F.col("concept_id").isin(hot), F.xxhash64("gkey")).otherwise(0)) if hot else c).repartition(tasks, *place)
    ordinal, stance, told = F.floor(F.col("code") / 9).cast("int"), F.floor(F.col("code") / 3) % 3, F.col("code") % 3
    weights = F.array(*[F.lit(float(w)) for w in [vocab.UNKNOWN_TIER_WEIGHT, *vocab.TIER_WEIGHT.values()]])
    c = c.withColumns({
        "w": F.get(weights, ordinal), "r": F.coalesce("reliability", F.lit(0.5)), "ordinal": F.when(ordinal > 0, ordinal.cast("long")),
        "stance": F.when(stance == 1, stances[0]).when(stance == 2, stances[1]), "is_reported_from_other": F.when(told < 2, told == 1),
    })
    when = lambda stance: F.sum(F.when(F.col("stance") == stance, F.col("w") * F.col("r")))
    count = lambda stance: F.count_if(F.col("stance") == stance)
    first = c.groupBy(*place, "gkey", "creator_id").agg(
        F.count("*").alias("claims"), F.sum("w").alias("w_sum"), F.max("w").alias("w_max"), F.sum("r").alias("r_sum"), when("supports").alias("w_for"), when("contradicts").alias("w_against"),
        count("supports").alias("supporting"), count("contradicts").alias("contradicting"), F.max("published_at").alias("newest"), F.min("published_at").alias("oldest"), F.sum("hedge_level").alias("hedge"),
        F.count_if("commercial").alias("commercial"), F.sum("asr_confidence").alias("asr"), F.count("asr_confidence").alias("asr_n"),
        F.sum("extraction_certainty").alias("certainty"), F.count("extraction_certainty").alias("certainty_n"), F.min("ordinal").alias("ordinal"), F.bool_and("is_reported_from_other").alias("secondhand"),
    )
    sums = ["claims", "w_sum", "r_sum", "w_for", "w_against", "supporting", "contradicting", "hedge", "commercial", "asr", "asr_n", "certainty", "certainty_n"]
    fold = [F.sum(s).alias(s) for s in sums] + [F.max("w_max").alias("w_max"), F.max("newest").alias("newest"), F.min("oldest").alias("oldest"), F.min("ordinal").alias("ordinal"), F.bool_and("secondhand").alias("secondhand")]
    second = first.groupBy(*place, "gkey").agg(*fold, F.count("creator_id").alias("creators"))
    out = second.groupBy("concept_id").agg(*fold, F.sum("creators").alias("creators"), F.count("*").alias("groups"))
    tier = F.element_at(F.array(*[F.lit(t) for t in vocab.TIER_WEIGHT]), F.col("ordinal").cast("int"))
    return out.withColumn("highest_tier", F.when(F.col("ordinal").isNotNull(), tier)).drop("ordinal")


def confidence(ev: DataFrame, concepts: DataFrame, as_of: str) -> DataFrame:
    """Adds components, penalties, the score and its band (taken from the unrounded score)."""
    d = ev.join(concepts.select("concept_id", "domain", "risk_tier", "first_seen", "has_parameters", "has_conditions", "has_mechanism", "has_implementation_steps", "unresolved_contradiction"), "concept_id")
    n = F.col("claims")
    age = F.greatest(F.datediff(F.lit(as_of).cast("date"), "newest"), F.lit(0)) / 365.25
    life = lookup(F.col("domain"), vocab.HALF_LIFE, vocab.UNKNOWN_HALF_LIFE)
    s, a = F.coalesce("w_for", F.lit(0.0)), F.coalesce("w_against", F.lit(0.0))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("double")
    parts = {
        "evidence_strength": 0.6 * F.col("w_max") + 0.4 * F.col("w_sum") / n,
        "source_quality": F.col("r_sum") / n,
        "consensus": F.when(s + a == 0, F.lit(0.5)).otherwise(((s - a) / (s + a) + 1) / 2),
        "corroboration": corroboration(F.col("groups")),
        "recency": F.coalesce(F.exp(-F.log(F.lit(2.0)) * age / life), F.lit(0.5)),
        "specificity": 0.4 * flag("has_parameters") + 0.3 * flag("has_conditions") + 0.2 * flag("has_mechanism") + 0.1 * flag("has_implementation_steps"),
    }
    mean = lambda total, count: F.coalesce(F.col(total) / F.col(count), F.lit(1.0))
    penalties = {
        "hedging": F.least(F.lit(0.08), 0.08 * F.coalesce(F.col("hedge"), F.lit(0.0)) / n),
        "commercial_bias": F.least(F.lit(0.10), 0.10 * F.col("commercial") / n),
        "single_source": F.when(F.col("groups") <= 1, 0.15).otherwise(0.0),
        "single_creator": F.when(F.col("creators") <= 1, 0.10).otherwise(0.0),
        "open_contradiction": F.when(F.col("unresolved_contradiction"), 0.12).otherwise(0.0),
        "asr_quality": F.least(F.lit(0.06), 0.06 * (1 - mean("asr", "asr_n"))),
        "extraction_uncertainty": F.least(F.lit(0.05), 0.05 * (1 - mean("certainty", "certainty_n"))),
    }
    d = d.withColumns(parts)
    raw = reduce(lambda x, y: x + y, [F.lit(vocab.CONFIDENCE_WEIGHT[k]) * F.col(k) for k in parts])
    d = d.withColumn("penalty", reduce(lambda x, y: x + y, penalties.values())).withColumn("raw", raw)
    d = d.withColumn("confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("raw") - F.col("penalty"))))
    return d.withColumn("band", band_for(F.col("confidence")))


def promotion(d: DataFrame, as_of: str, *, min_claims: int = 2, min_creators: int = 2, min_groups: int = 2, publish_groups: int = 3, publish_confidence: float = 0.55, max_risk: int = 1, sweep_days: int = 90) -> DataFrame:
    """Adds state, rule, needs_review, flags and sweep; the first rule that holds decides."""
    strong = F.coalesce(F.col("highest_tier").isin(*vocab.AUTHORITATIVE_TIERS), F.lit(False))
    bar = (F.col("claims") >= min_claims) & (F.col("creators") >= min_creators) & (F.col("groups") >= min_groups)
    conf = F.col("confidence")
    rule = (
        F.when(F.col("claims") < 1, "no_claims")
        .when(~strong & ~bar & (F.col("creators") >= min_creators) & (F.col("groups") < min_groups), "single_lineage")
        .when(~strong & ~bar, "insufficient_evidence")
        .when(F.col("risk_tier") > max_risk, "risk_needs_review")
        .when(conf.isNull(), "awaiting_confidence")
        .when(conf < publish_confidence, "below_confidence_floor")
        .when((F.col("groups") < publish_groups) & ~strong, "needs_groups")
        .when(F.col("secondhand"), "all_secondhand")
        .otherwise("published")
    )
    d = d.withColumn("rule", rule)
    early = F.col("rule").isin("no_claims", "single_lineage", "insufficient_evidence")
    d = d.withColumn("state", F.when(early, "provisional").when(F.col("rule") == "published", "published").otherwise("active"))
    return d.withColumns(
        {
            "needs_review": F.col("rule").isin("risk_needs_review", "all_secondhand"),
            "echo_suspected": ~early & F.coalesce(F.col("secondhand"), F.lit(False)),
            "sweep": (F.col("state") == "provisional") & F.coalesce(F.datediff(F.lit(as_of).cast("date"), "first_seen") > sweep_days, F.lit(False)),
        }
    )


def evidence_ledger(claims: DataFrame) -> DataFrame:
    """Claims per concept and tier, with the first and last claim date."""
    return claims.groupBy("concept_id", "evidence_tier").agg(F.count("*").alias("claims"), F.min("claimed_at").alias("first_claim"), F.max("claimed_at").alias("last_claim"))


def deliberations(positions: DataFrame, panels: DataFrame) -> DataFrame:
    """What each panel is worth: a conclusion is one voice, and never adds to the voices of its positions.

    ``positions(delib_id, speaker_id, stance, independence_group)``, ``panels(delib_id, participants, conclusion)``.
    A missing group counts as its own lineage.
    """
    g = F.col("independence_group")
    own = g.isNull() | (g == "")
    per = positions.groupBy("delib_id").agg(F.count("*").alias("positions"), (F.count_distinct(F.when(~own, g)) + F.count_if(own)).alias("position_groups"), F.count_if(F.col("stance") == "dissent").alias("dissent_count"))
    d = panels.join(per, "delib_id", "left").fillna(0, ["positions", "position_groups", "dissent_count"])
    done = F.col("conclusion").isNotNull()
    return d.select(
        "delib_id", "positions", "position_groups", F.when(done, "deliberated_consensus").alias("conclusion_tier"), F.when(done, 1).otherwise(0).alias("conclusion_groups"),
        F.when(done, F.greatest("position_groups", F.lit(1))).otherwise(F.col("position_groups")).alias("total_groups"), "dissent_count",
        (F.col("dissent_count") > 0).alias("creates_contradiction"), (F.col("position_groups") < F.col("positions")).alias("shared_lineage"), (~done | (F.col("dissent_count") > 0)).alias("unresolved"),
    )


def audit_score(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """One row of figures and gates from reviewed claims ``(source_id, claim_id, verdict)`` and sources ``(source_id, missed_claims, verbatim_failures, paraphrase_failures)``."""
    is_ = lambda v: F.col("verdict") == v
    c = claims.agg(F.count("*").alias("extracted"), F.count_if(F.col("verdict").isin(*vocab.REAL_VERDICTS)).alias("real"), *[F.count_if(is_(v)).alias(v) for v in ("type_wrong", "tier_wrong", "scope_wrong", "fabricated")])
    s = sources.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("missed_claims", "verbatim_failures", "paraphrase_failures")])
    d = c.withColumn("one", F.lit(1)).join(s.withColumn("one", F.lit(1)), "one").drop("one")
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    real, vf = F.col("real"), F.col("verbatim_failures")
    d = d.withColumns(
        {
            "precision": share(real, F.col("extracted")),
            "recall": share(real, real + F.col("missed_claims")),
            "type_accuracy": share(real - F.col("type_wrong"), real),
            "tier_accuracy": share(real - F.col("tier_wrong"), real),
            "scope_accuracy": share(real - F.col("scope_wrong"), real),
            "verbatim_failure_rate": share(vf, F.col("extracted") + vf),
            "paraphrase_failures": F.least("verbatim_failures", "paraphrase_failures"),
            "hard_stop": F.col("fabricated") > 0,
        }
    )
    d = d.withColumn("paraphrase_dominates", (vf > 0) & (F.col("paraphrase_failures") > vf - F.col("paraphrase_failures")))
    passed = ~F.col("hard_stop") & (F.col("verbatim_failure_rate") <= vocab.GATES["verbatim_failure_rate"])
    for k in ("precision", "type_accuracy", "tier_accuracy", "scope_accuracy", "recall"):
        passed = passed & (F.col(k) >= vocab.GATES[k])
    return d.withColumn("passed", passed)


def source_reliability(sources: DataFrame, creators: DataFrame) -> DataFrame:
    """Rows ``(source_id, reliability)``: expertise, track record, transcript, format and citation, less the commercial penalty."""
    d = sources.join(creators.select("creator_id", "expertise", "track_record", "citation"), "creator_id", "left")
    half = lambda c: F.coalesce(F.col(c), F.lit(0.5))
    score = (
        0.40 * half("expertise") + 0.20 * half("track_record") + 0.15 * lookup(F.col("transcript_quality"), vocab.TRANSCRIPT_QUALITY, 0.6)
        + 0.15 * lookup(F.col("format"), vocab.FORMAT_QUALITY, 0.75) + 0.10 * half("citation") - lookup(F.col("commercial_context"), vocab.COMMERCIAL_PENALTY, 0.0)
    )
    return d.select("source_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("reliability"))


def domain_coverage(cards: DataFrame) -> DataFrame:
    """Per domain of published cards: count, mean confidence, claims, mean groups, risky ones, weak ones."""
    p = cards.where(F.col("state") == "published")
    return p.groupBy("domain").agg(
        F.count("*").alias("cards"), F.avg("confidence").alias("mean_confidence"), F.sum("claims").alias("claims"), F.avg("groups").alias("mean_groups"),
        F.count_if(F.col("risk_tier") >= 2).alias("high_risk"), F.count_if(F.col("confidence") < 0.55).alias("weak"),
    )
