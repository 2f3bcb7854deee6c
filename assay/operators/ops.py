"""Bookkeeping of a growing corpus: duplicates, pending work, prices, health, drift, versions, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assay.functions.columns import content_id


def dedup_sources(sources: DataFrame) -> DataFrame:
    """Rows ``(content_hash, source_id, copies, others)`` of ``(source_id, content_hash, registered)``: the earliest stays, the rest are distributions of it."""
    d = sources.groupBy("content_hash").agg(F.min(F.struct("registered", "source_id")).alias("m"), F.count("*").alias("copies"), F.array_sort(F.collect_list("source_id")).alias("ids"))
    return d.select("content_hash", "m.source_id", "copies", F.array_remove("ids", F.col("m.source_id")).alias("others"))


def pending(work: DataFrame, done: DataFrame, *, stage_version: str, config: str) -> DataFrame:
    """Work whose artifact id (stage version, input id, configuration) isn't stored yet."""
    d = work.withColumn("artifact_id", content_id("art", F.lit(stage_version), F.col("input_id"), F.lit(config)))
    return d.join(done.select("artifact_id"), "artifact_id", "left_anti")


def stale_embeddings(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Objects whose stored vector is missing or of another text or model version."""
    return wanted.join(stored, ["object_id", "collection", "model_version", "text_hash"], "left_anti")


def price_usage(usage: DataFrame, prices: DataFrame, read: float = 0.1, write: float = 1.25) -> DataFrame:
    """Adds cost: rates of the longest model prefix, of the dearest row where none fits. ``prices(prefix, price_in, price_out)`` is a small fixed table."""
    top = prices.orderBy(F.desc("price_out"), F.desc("price_in"), "prefix").limit(1).select(F.col("price_in").alias("top_in"), F.col("price_out").alias("top_out"))
    models = usage.select("model").distinct()
    fit = models.join(F.broadcast(prices), F.lower(F.trim("model")).startswith(F.col("prefix")), "left")
    best = fit.groupBy("model").agg(F.max(F.struct(F.length("prefix").alias("n"), "price_in", "price_out")).alias("m"))
    best = best.withColumn("one", F.lit(1)).join(F.broadcast(top.withColumn("one", F.lit(1))), "one").select("model", F.coalesce("m.price_in", "top_in").alias("price_in"), F.coalesce("m.price_out", "top_out").alias("price_out"))
    cost = (F.col("input_tokens") * F.col("price_in") + F.col("cache_read_tokens") * F.col("price_in") * read + F.col("cache_write_tokens") * F.col("price_in") * write + F.col("output_tokens") * F.col("price_out")) / 1_000_000
    return usage.join(best, "model").withColumn("cost_usd", cost)


def select_claims(claims: DataFrame, order: list[Column], per_stance: int = 15, most: int = 40) -> DataFrame:
    """Up to ``most`` claims per concept: the best of each stance first, so a minority keeps its place, then the best of the rest."""
    w = Window.partitionBy("concept_id", "stance").orderBy(*order)
    d = claims.withColumn("of_stance", F.row_number().over(w))
    d = d.withColumn("place", F.row_number().over(Window.partitionBy("concept_id").orderBy((F.col("of_stance") > per_stance).cast("int"), *order)))
    return d.where(F.col("place") <= most)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, halt: float = 0.05) -> DataFrame:
    """Rows ``(change, n, halt)``: how many keys were added, changed, deleted or stayed; halt where too large a share of the old went."""
    h = lambda d: d.select(key, F.xxhash64(*[c for c in d.columns if c != key]).alias("h"))
    o, n = h(old).withColumnRenamed("h", "ho"), h(new).withColumnRenamed("h", "hn")
    d = o.join(n, key, "full").select(F.when(F.col("ho").isNull(), "added").when(F.col("hn").isNull(), "deleted").when(F.col("ho") != F.col("hn"), "changed").otherwise("same").alias("change"))
    counts = d.groupBy("change").agg(F.count("*").alias("n"))
    old_n = F.sum(F.when(F.col("change") != "added", F.col("n"))).over(Window.partitionBy())
    return counts.withColumn("halt", (F.col("change") == "deleted") & (F.col("n") > halt * old_n))


def stratified(rows: DataFrame, strata: list[str], key: str, quota: int) -> DataFrame:
    """Exactly ``quota`` rows per stratum (all where fewer), chosen by a hash of the key, so the same ones every time."""
    w = Window.partitionBy(*strata).orderBy(F.sha2(F.col(key).cast("string"), 256), key)
    return rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= quota).drop("n")


def average_ranks(rows: DataFrame, value: str, ranges: int = 64) -> DataFrame:
    """Adds rank with ties at their mean place, for numbers; rows without a value go.

    Counts per value are summed up in two levels, over ranges of values (the bounds, approximate quantiles, decide only the balance) and
    within each, so no task orders all values.
    """
    counts = rows.groupBy(value).agg(F.count("*").alias("__n")).where(F.col(value).isNotNull())
    bounds = counts.agg(F.percentile_approx(F.col(value).cast("double"), [k / ranges for k in range(1, ranges)], 10_000)).first()[0] or []
    bounds = F.array(*[F.lit(float(b)) for b in sorted(set(bounds))]).cast("array<double>")
    counts = counts.withColumn("__part", F.size(F.filter(bounds, lambda b: b < F.col(value).cast("double"))))
    parts = counts.groupBy("__part").agg(F.sum("__n").alias("__sum"))
    start = F.coalesce(F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("__n").over(Window.partitionBy("__part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.join(F.broadcast(parts.select("__part", start.alias("__start"))), "__part")  # one row per range
    return rows.join(placed.select(value, (F.col("__start") + inside + (F.col("__n") + 1) / 2).alias(f"{value}_rank")), value)


def spearman(rows: DataFrame, a: str, b: str) -> DataFrame:
    return average_ranks(average_ranks(rows, a), b).agg(F.count("*").alias("n"), F.corr(f"{a}_rank", f"{b}_rank").alias("spearman"))


def endorsement(rows: DataFrame, bands: list[tuple[str, float]], agree: float = 0.5) -> DataFrame:
    """Per band of confidence ``(name, least)`` the cards of ``(confidence, consensus)``, the share that experts endorse, and the mean consensus; cards without consensus aren't counted."""
    band = F.coalesce(*[F.when(F.col("confidence") >= least, name) for name, least in sorted(bands, key=lambda b: -b[1])], F.lit("none"))
    d = rows.where("consensus is not null").groupBy(band.alias("band"))
    return d.agg(F.count("*").alias("cards"), F.avg((F.col("consensus") >= agree).cast("double")).alias("endorsed"), F.avg("consensus").alias("mean_consensus"))


def track_record(claims: DataFrame, strong: DataFrame, resolved: DataFrame) -> DataFrame:
    """Per creator of ``claims(creator_id, claim_id, concept_id)``: claims, those on concepts of ``strong(concept_id)``, those on the losing side of a resolved contradiction, and the record that starts at a half.

    ``resolved(claim_id, lost)`` lists the claims of both sides of contradictions that have been resolved; open ones cost nobody anything.
    """
    d = claims.join(strong.select("concept_id", F.lit(1).alias("carried")).distinct(), "concept_id", "left").join(resolved.where("lost").select("claim_id", F.lit(1).alias("lost")).distinct(), "claim_id", "left")
    n = F.count("*")
    return d.groupBy("creator_id").agg(n.alias("claims"), F.count("carried").alias("corroborated"), F.count("lost").alias("lost"), (0.5 + 0.5 * F.count("carried") / n - 0.5 * F.count("lost") / n).alias("track_record"))


def shelves(cards: DataFrame, most: int = 25, thin: float = 3.0) -> DataFrame:
    """Per domain and subcategory of ``cards(domain, subcategory, groups)``: cards, whether an unsorted shelf overflows, the mean of independent groups over the domain, and whether that is thin.

    Cards without a subcategory are on the shelf ``_unsorted``.
    """
    shelf = cards.groupBy("domain", F.coalesce("subcategory", F.lit("_unsorted")).alias("shelf")).agg(F.count("*").alias("cards"), F.sum("groups").alias("groups"))
    mean = shelf.groupBy("domain").agg((F.sum("groups") / F.sum("cards")).alias("mean_groups"))
    d = shelf.join(mean, "domain")
    return d.select("domain", "shelf", "cards", ((F.col("shelf") == "_unsorted") & (F.col("cards") > most)).alias("overflow"), "mean_groups", (F.col("mean_groups") < thin).alias("thin"))


def distinct_sketches(rows: DataFrame, by: list[str], value: str, bits: int = 14) -> DataFrame:
    """A mergeable sketch of the distinct values per key; ``distinct_estimates`` reads and unites them. Nulls don't count."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(F.col(value), bits).alias("sketch"), F.count(value).alias("rows"))


def distinct_estimates(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Distinct values per coarser key, from sketches alone: within about 1.04 / sqrt(2 ** bits) of the truth (0.8 % at 14 bits) in two of three cases."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"), F.sum("rows").alias("rows"))


def drift(scores: DataFrame, alert: float = 0.05) -> DataFrame:
    """Mean score per domain and period with its change from the period before."""
    d = scores.groupBy("domain", "period").agg(F.avg("score").alias("mean"))
    change = F.col("mean") - F.lag("mean").over(Window.partitionBy("domain").orderBy("period"))
    return d.withColumn("change", change).withColumn("alert", F.coalesce(F.abs("change") > alert, F.lit(False)))


def as_of(versions: DataFrame, pins: DataFrame, key: str = "card_id") -> DataFrame:
    """For each pin ``(pin_id, card_id, pinned_at)`` the newest version ``(card_id, version, version_time)`` not later than it."""
    v = versions.select(key, F.col("version_time").alias("__at"), F.lit(None).cast(pins.schema["pin_id"].dataType).alias("pin_id"), F.struct("version_time", "version").alias("__v"))
    p = pins.select(key, F.col("pinned_at").alias("__at"), "pin_id", F.lit(None).cast(v.schema["__v"].dataType).alias("__v"))
    # versions and pins in one order of time, a version before the pins of its moment; each pin takes the last version before it
    w = Window.partitionBy(key).orderBy("__at", F.col("pin_id").isNotNull(), "__v.version").rowsBetween(Window.unboundedPreceding, 0)
    d = v.unionByName(p).withColumn("m", F.last("__v", ignorenulls=True).over(w)).where("pin_id is not null and m is not null")
    return d.select("pin_id", key, "m.version", "m.version_time")


def gap_runs(events: DataFrame, key: str, time: str, seconds: float) -> DataFrame:
    """Adds run: the number of gaps of ``seconds`` and more before the row, within its key."""
    w = Window.partitionBy(key).orderBy(time, "event_id")
    t = F.col(time).cast("timestamp_ntz")
    gap = F.timestamp_diff("MICROSECOND", F.lag(t).over(w), t) / 1e6
    return events.withColumn("run", F.sum(F.coalesce((gap >= seconds).cast("int"), F.lit(0))).over(w))


def bursts(events: DataFrame, key: str, time: str, seconds: int, least: int) -> DataFrame:
    """Rows with ``least`` and more rows of their key in the time before them."""
    w = Window.partitionBy(key).orderBy(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time).cast("timestamp_ntz"))).rangeBetween(-seconds, 0)
    return events.withColumn("recent", F.count("*").over(w)).where(F.col("recent") >= least)


def echo_bursts(claims: DataFrame, reach: float, days: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Bursts, and the links ``(a, b)`` between creators that they tell of.

    A burst is a claim ``(phrase, claim_id, creator_id, reach, at)`` of a creator with ``reach`` and more after which, within ``days``, at least
    ``least`` other creators say the same phrase. Rows ``(phrase, seed_id, seed_creator, at, followers)``; each follower is linked with the creator of the seed. Claims meet seeds in bins of time, so a phrase that
    everybody says isn't one task's. Claims without phrase, creator or time take no part.
    """
    span = days * 86_400
    c = claims.where("phrase is not null and creator_id is not null and at is not null").select("phrase", "claim_id", "creator_id", "reach", F.col("at").cast("timestamp").cast("long").alias("t"))
    bin_of = F.floor(F.col("t") / span)
    seeds = c.where(F.col("reach") >= reach).select("phrase", F.col("claim_id").alias("seed_id"), F.col("creator_id").alias("seed_creator"), F.col("t").alias("seed_t"), F.explode(F.array(bin_of, bin_of + 1)).alias("bin"))
    near = c.select("phrase", "creator_id", "t", bin_of.alias("bin")).distinct()
    after = near.join(seeds, ["phrase", "bin"]).where((F.col("t") - F.col("seed_t")).between(0, span) & (F.col("creator_id") != F.col("seed_creator")))
    after = after.groupBy("phrase", "seed_id", "seed_creator", "seed_t", "creator_id").agg(F.count("*").alias("n"))
    bursts_ = after.groupBy("phrase", "seed_id", "seed_creator", "seed_t").agg(F.count("*").alias("followers")).where(F.col("followers") >= least)
    links = after.join(bursts_.select("seed_id"), "seed_id", "left_semi").select(F.least("seed_creator", "creator_id").alias("a"), F.greatest("seed_creator", "creator_id").alias("b")).distinct()
    return bursts_.select("phrase", "seed_id", "seed_creator", F.timestamp_seconds("seed_t").alias("at"), "followers"), links


def fingerprint(rows: DataFrame, key: str, path: str, *, buckets: int = 256, leaves: int = 64) -> None:
    """Rows stored by a hash of their key, with checksums that don't depend on their order: of each bucket, and of each of its leaves.

    A checksum is a count and the sums of two hashes of whole rows, so rows that repeat count as often as they stand. Columns count in the order of their names.
    """
    named = rows.select(*sorted(rows.columns))
    value = F.to_json(F.struct(*named.columns), {"ignoreNullFields": "false"})
    spot = F.pmod(F.xxhash64(key), F.lit(buckets * leaves))
    d = named.withColumns({"__bucket": F.floor(spot / leaves).cast("int"), "__leaf": (spot % leaves).cast("int"), "__h1": F.xxhash64(value), "__h2": F.xxhash64(F.lit(1), value)})
    d.repartition("__bucket").sortWithinPartitions("__bucket", "__leaf").write.partitionBy("__bucket").parquet(f"{path}/rows")
    stored = rows.sparkSession.read.parquet(f"{path}/rows")
    # sums of decimals, which don't overflow
    sums = [F.count("*").alias("n"), *[F.sum(F.col(h).cast("decimal(20,0)")).alias(h) for h in ("__h1", "__h2")]]
    leaf = stored.groupBy("__bucket", "__leaf").agg(*sums)
    leaf.repartition(1, "__bucket").sortWithinPartitions("__bucket").write.parquet(f"{path}/leaves")  # at most buckets times leaves rows
    made = rows.sparkSession.read.parquet(f"{path}/leaves").groupBy("__bucket").agg(F.sum("n").alias("n"), F.sum("__h1").alias("__h1"), F.sum("__h2").alias("__h2"))
    made.coalesce(1).write.parquet(f"{path}/buckets")


def differing(spark, a: str, b: str) -> tuple[DataFrame, list[int]]:
    """Rows of one of two fingerprinted states only, with the side and how often more they stand there; and the buckets that were read.

    Checksums of buckets are compared first, of their leaves only where those differ, and rows are read from differing buckets and compared in differing leaves alone.
    """
    read = lambda path, what: spark.read.parquet(f"{path}/{what}")
    total = ["n", "__h1", "__h2"]

    def apart(what: str, keys: list[str], among: list[int] | None = None) -> DataFrame:
        x, y = (read(p, what) if among is None else read(p, what).where(F.col("__bucket").isin(among)) for p in (a, b))
        other = y.select(*keys, *[F.col(c).alias(f"o_{c}") for c in total])
        same = F.lit(True)
        for c in total:
            same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
        return x.join(other, keys, "full").where(~same).select(*keys)

    buckets = sorted(r[0] for r in apart("buckets", ["__bucket"]).collect())
    leaves = F.broadcast(apart("leaves", ["__bucket", "__leaf"], buckets))  # at most as many as there are leaves
    side = lambda path: read(path, "rows").where(F.col("__bucket").isin(buckets)).join(leaves, ["__bucket", "__leaf"], "left_semi").drop("__bucket", "__leaf", "__h1", "__h2")
    return set_difference(side(a), side(b)), buckets


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with the side; empty where both hold the same rows the same number of times."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
