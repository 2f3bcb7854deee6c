"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from assay.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the shuffle hash that deal a source's documents into 16 ** 3 buckets, so that no task holds a whole source.
_DIGITS = 3
#: Ranges of a unit of virtual time whose sums lead to the cut; ``fair_queue`` looks twice, so at a 16-millionth of the words.
_RANGES = 4096


def word_count(text: Column) -> Column:
    """Words of a text (runs of characters other than ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column, seed: str) -> Column:
    """The document's place in its source's shuffled order: a hash of the seed, the id and the text (nulls as empty)."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), part(doc_id), F.lit(":"), F.coalesce(F.md5(text.cast("string")), F.lit(""))))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target of each source: rows ``(source, source_size, target)`` from rows ``(source, size)``.

    Sources in code-point order, null last, take the weights in turn and share ``budget`` times all sizes.
    No target exceeds ``most`` times its source's size: in ascending order of that limit per weight the
    first sources are held at their limits and the rest share what is left by weight, which is where
    resharing an excess again and again ends. Windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("limit"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    held = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(every) * float(budget)
    per = per.withColumn("level", (total - held) / rest).withColumn("place", F.row_number().over(order))
    free = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("place"))
    level = F.min_by(F.col("level"), free).over(every)
    return per.withColumn("at", level).select("source", "source_size", F.least("limit", F.coalesce(F.col("at") * F.col("weight"), F.col("limit"))).alias("target"))


def _entries(queue: DataFrame, most: int) -> DataFrame:
    """Rows ``(time, hash, upto, size)`` of every copy that could be in the mix."""
    turn = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn")
    copies = queue.where("size > 0 and target > 0").select("hash", "upto", "size", "source_size", "target", turn)
    return copies.select(_time(F.col("turn")).alias("time"), "hash", (F.col("upto") + F.col("turn") * F.col("source_size")).alias("upto"), "size")


def _time(turn: Column) -> Column:
    """The virtual time at which half of a document's copy is through."""
    return (F.col("upto") + F.col("source_size") * turn - F.col("size") / 2) / F.nullif(F.col("target"), F.lit(0.0))


def _crossing(buckets: DataFrame, before: float, budget: float) -> Row | None:
    """The bucket in which the running sum, ``before`` at first, passes the budget: ``(bucket, before, lo, hi)``; null if none does."""
    upto = F.lit(before) + F.sum("words").over(Window.orderBy("bucket"))
    summed = buckets.select("bucket", "lo", "hi", (upto - F.col("words")).alias("before"), upto.alias("upto"))
    return summed.where(F.col("upto") > budget).orderBy("bucket").first()


def _budget_cut(entries: DataFrame, budget: float) -> tuple[float, str, int] | None:
    """The last entry ``(time, hash, upto)`` in order of virtual time that the budget holds by its larger part; null: all.

    Times fall into a fixed number of ranges, whose sums tell in which the budget runs out; that range is cut in
    the same way, and the few entries of what is left are summed one by one.
    """
    sums = lambda e: e.groupBy("bucket").agg(F.sum("size").alias("words"), F.min("time").alias("lo"), F.max("time").alias("hi"))
    fine = F.when(F.col("time") < 2, F.floor(F.col("time") * _RANGES)).otherwise(2 * _RANGES + F.floor(F.log2("time") * 64))
    first = entries.withColumn("bucket", fine)
    at = _crossing(sums(first), 0.0, budget)
    if at is None:
        return None
    within = first.where(F.col("bucket") == at["bucket"])
    if at["hi"] > at["lo"]:
        within = within.withColumn("bucket", F.floor((F.col("time") - at["lo"]) / (at["hi"] - at["lo"]) * (_RANGES - 1)))
        at = _crossing(sums(within), float(at["before"]), budget)
        within = within.where(F.col("bucket") == at["bucket"])
    upto = F.lit(float(at["before"])) + F.sum("size").over(Window.orderBy("time", "hash", "upto").rowsBetween(Window.unboundedPreceding, 0))
    held = within.withColumn("sum", upto).where(F.col("sum") - F.col("size") / 2 <= budget)
    last = held.orderBy(F.desc("time"), F.desc("hash"), F.desc("upto")).first()
    return (last["time"], last["hash"], last["upto"]) if last else (at["lo"], "", -1)


def fair_queue(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, most: int = 2, seed: str = "mix", scratch: Scratch | None = None
) -> DataFrame:
    """One row ``(id, source, hash, size, source_size, target, virtual_finish, virtual_time, copies, taken)`` per document.

    Each source's documents queue in a shuffled order that depends on the seed, the ids and the texts only,
    ``most`` times over. A document's virtual finish time is its source's words up to and including it, divided
    by the source's target. All copies are ordered over all sources by the virtual time at which their larger part is
    through (half a document before the finish, so that long documents gain or lose nothing) and the order is
    cut where the budget, ``budget`` times all words, runs out; the copy across the cut is in if its larger part
    lies before it. ``virtual_finish`` and ``virtual_time`` are those of the first copy; ``copies`` counts the times a document is in.

    Null text has size 0; a source of no words has target 0 and its documents are taken 0 times (copies 0);
    equal rows keep their rows and take consecutive places; a null id counts as empty in the hash; a null source is
    a source, the last. An empty table gives an empty result. Other columns are ignored.

    The running sums are two-level: words by source and hash bucket first, then within a bucket from the
    sum before it, so a source of any size spreads over 4096 groups; equal rows are counted per input
    partition before they are shuffled, so a row that a third of all repeat spreads like its partitions.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), shuffle_key(F.col(id_col), F.col(text_col), seed).alias("hash"), word_count(F.col(text_col)).alias("size"), F.spark_partition_id().alias("part"))
    rows = scratch.save(rows, "sizes")  # texts are read once
    equal = rows.groupBy("id", "source", "hash", "size", "part").agg(F.count("*").alias("rows")).withColumn("bucket", F.substring("hash", 1, _DIGITS))
    deals = rows.groupBy("source", F.substring("hash", 1, _DIGITS).alias("bucket")).agg(F.sum("size").alias("size"))
    deals = scratch.save(deals, "deals")
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    targets = source_targets(deals, weights, budget, most)
    offsets = deals.select("source", "bucket", before.alias("before")).alias("o")
    offsets = offsets.join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select("o.*", "t.source_size", "t.target")
    e, o = equal.alias("e"), offsets.alias("o")
    placed = e.join(o, (F.col("e.bucket") == F.col("o.bucket")) & F.col("e.source").eqNullSafe(F.col("o.source"))).select("e.*", "o.before", "o.source_size", "o.target")
    inside = F.sum(F.col("size") * F.col("rows")).over(Window.partitionBy("bucket", "source").orderBy("hash", "size", "part").rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("from", F.col("before") + inside - F.col("size") * F.col("rows"))
    queue = placed.select("id", "source", "hash", "size", "source_size", "target", "from", F.explode(F.sequence(F.lit(1), "rows")).alias("nth"))
    queue = scratch.save(queue.select("id", "source", "hash", "size", "source_size", "target", (F.col("from") + F.col("nth") * F.col("size")).alias("upto")), "queue")

    words = deals.agg(F.sum("size")).first()[0] or 0
    cut = _budget_cut(_entries(queue, most), float(words) * budget)
    copies = F.lit(0)
    for k in range(most):
        held = F.col("target") > 0
        if cut:
            time, at = _time(F.lit(k)), F.col("upto") + F.col("source_size") * k
            tie = (F.col("hash") < cut[1]) | ((F.col("hash") == cut[1]) & (at <= cut[2]))
            held = held & ((time < cut[0]) | ((time == cut[0]) & tie))
        copies = copies + F.when(held, 1).otherwise(0)
    out = queue.withColumns({"copies": copies, "virtual_finish": F.col("upto") / F.nullif(F.col("target"), F.lit(0.0)), "virtual_time": _time(F.lit(0))})
    return out.select("id", "source", "hash", "size", "source_size", "target", "virtual_finish", "virtual_time", "copies", (F.col("size") * F.col("copies")).alias("taken"))


#: Sources up to which their cuts (a hundred bytes each) travel to every task; beyond, they are joined by a shuffle.
_MOST_SOURCES = 100_000


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, seed: str = "mix", scratch: Scratch | None = None, **options) -> DataFrame:
    """The documents of the mix, each as many times as ``fair_queue`` takes it, with the columns of ``docs``.

    A source's cut is one point of its shuffled order, so whole rows need no shuffle: the cuts, one row per
    source, are counted and, where they are few, sent to the tasks that read the rows. Only rows that are equal
    in id and text and lie across a cut, so that some of them are in once more than others, are written
    and numbered, in parts. Documents of a source that has no words are left out. Nulls, ties, repeated
    rows and an empty table are as in ``fair_queue``; names of other columns may be any.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    plan = scratch.save(fair_queue(docs, id_col, text_col, source_col, seed=seed, scratch=scratch, **options), "plan")
    top = plan.groupBy("source").agg(F.max("copies").alias("top"), F.min("copies").alias("low"))
    p, t = plan.alias("p"), top.alias("t")
    leading = p.join(t, F.col("p.source").eqNullSafe(F.col("t.source"))).where("p.copies = t.top")
    cut = leading.groupBy("p.source").agg(F.max("p.hash").alias("cut"), F.first("t.top").alias("top"), F.first("t.low").alias("low")).alias("c")
    at_cut = p.join(cut, F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.hash") == F.col("c.cut")))
    cut = scratch.save(at_cut.groupBy("c.source", "c.cut", "c.top", "c.low").agg(F.count_if(F.expr("p.copies = c.top")).alias("n_top"), F.count("*").alias("n")), "cuts")
    few = cut.count() <= _MOST_SOURCES
    c = (F.broadcast(cut) if few else cut).alias("c")
    rows = docs.select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("source"), shuffle_key(F.col(id_col), F.col(text_col), seed).alias("hash")).alias("r")
    judged = rows.join(c, F.col("r.source").eqNullSafe(F.col("c.source")))
    parted = (F.col("hash") == F.col("cut")) & (F.col("n_top") < F.col("n"))
    times = F.when(F.col("hash") <= F.col("cut"), F.col("top")).otherwise(F.col("low"))
    taken = judged.where(~parted).select("row", times.alias("times"))
    if not cut.where("n_top < n").isEmpty():
        equal = judged.where(parted).select("row", "r.source", "top", "low", "n_top", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("spot"))
        equal = scratch.save(equal, "equal").alias("q")
        sums = equal.groupBy("source", "part").count()
        start = F.coalesce(F.sum("count").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = sums.select("source", "part", start.alias("start")).alias("s")
        placed = equal.join(starts, F.col("q.source").eqNullSafe(F.col("s.source")) & (F.col("q.part") == F.col("s.part")))
        number = F.col("start") + F.row_number().over(Window.partitionBy("q.source", "q.part").orderBy("q.spot"))
        taken = taken.unionByName(placed.select("q.row", F.when(number <= F.col("n_top"), F.col("top")).otherwise(F.col("low")).alias("times")))
    out = taken.where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select("row.*")


MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS hash,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source
), weighed AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS lim,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM per
), levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY lim / weight, source NULLS LAST) AS place
  FROM weighed
), found AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= lim
), targets AS (
  SELECT w.source, w.source_size, least(w.lim, coalesce(f.level * w.weight, w.lim)) AS target FROM weighed w CROSS JOIN found f
), placed AS (
  SELECT r.doc_id, r.hash, r.size, t.source_size, t.target,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.hash, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, row_number() OVER (ORDER BY hash, upto) AS n FROM placed
), entries AS (
  SELECT c.n, c.hash, c.size, c.upto + t.turn * c.source_size AS upto, (c.upto + c.source_size * t.turn - c.size / 2.0::DOUBLE) / c.target AS time
  FROM copies c, (VALUES (0), (1)) t(turn) WHERE c.size > 0 AND c.target > 0
), summed AS (
  SELECT n, size, sum(size) OVER (ORDER BY time, hash, upto ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words FROM entries
), held AS (
  SELECT n, sum(size) AS taken FROM summed WHERE words - size / 2.0::DOUBLE <= (SELECT sum(size) FROM rows) * 1.5::DOUBLE GROUP BY n
)
SELECT c.doc_id, c.size, c.source_size, c.target, CAST(coalesce(h.taken, 0) AS BIGINT) AS taken
FROM copies c LEFT JOIN held h ON c.n = h.n
"""
