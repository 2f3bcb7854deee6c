"""Cues to chunks: cleaning, segmentation, salience."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from assay import vocab

HARD_GAP = 25.0
GATED = ("promo", "intro", "outro")
#: Either case, and letters of every script count as letters.
_ANY = "(?iU)"


@dataclass(frozen=True)
class Lexicon:
    """The patterns (of Java) that tell promotion, small talk, explanation and the domain; another field brings its own."""

    promo: str = _ANY + vocab.PROMO
    admin: str = _ANY + vocab.ADMIN
    technical: str = _ANY + vocab.TECHNICAL
    domain: str = _ANY + vocab.DOMAIN
    numeric: str = _ANY + vocab.NUMERIC
    cause: str = _ANY + vocab.CAUSE
    advice: str = _ANY + vocab.ADVICE
    experience: str = _ANY + vocab.EXPERIENCE
    fillers: str = _ANY + vocab.FILLERS


def clean_text(raw: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """Fillers and stutters dropped, spaces collapsed, the first letter a capital; hedges stay."""
    t = F.regexp_replace(raw, lexicon.fillers, "")
    t = F.regexp_replace(t, "(?iU)" + vocab.STUTTER, "$1")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.substr(t, F.lit(2)))


def count_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def segment_type(text: Column, lexicon: Lexicon = Lexicon(), *, short: int = 150, density: float = 1.2, explains: int = 3) -> Column:
    """promo, intro or explanation, by how dense the signs are: any sign in a short text, enough per hundred words in a long one."""
    hits = lambda p: F.regexp_count(text, F.lit(p))
    words = F.greatest(count_words(text), F.lit(1))
    dense = lambda h: (h > 0) & ((words <= short) | (h * 100 / words >= density))
    plain = hits(lexicon.technical) + F.when(text.rlike(lexicon.numeric), 2).otherwise(0) < explains
    return F.when(dense(hits(lexicon.promo)) & plain, "promo").when(dense(hits(lexicon.admin)) & (hits(lexicon.promo) == 0) & plain, "intro").otherwise("explanation")


def salience(text: Column, kind: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """How likely a chunk carries knowledge: domain words, numbers, causes, advice and experience; short chunks damped."""
    has = lambda p, v: F.when(text.rlike(p), v).otherwise(0.0)
    score = F.least(F.lit(0.65), 0.13 * F.regexp_count(text, F.lit(lexicon.domain))) + has(lexicon.numeric, 0.20) + has(lexicon.cause, 0.12) + has(lexicon.advice, 0.10) + has(lexicon.experience, 0.10)
    words = count_words(text)
    score = score * F.when(words < 12, 0.55).when(words < 25, 0.85).otherwise(1.0)
    return F.when(kind.isin(*GATED), F.lit(0.05)).otherwise(F.round(F.least(F.lit(1.0), score), 3))


def _cut(parts: Iterator[pd.DataFrame], target: int, most: int, pause: float, pause_words: int, speaker_words: int) -> Iterator[pd.DataFrame]:
    """Chunk numbers for cues in order of source, run and cue; the decision before a cue reads only what is in the open chunk."""
    run, number, words, last_end, last_speaker = None, 0, 0, None, None
    for cues in parts:
        out = []
        for source, r, start, end, speaker, n in zip(cues["source_id"], cues["run"], cues["t_start"], cues["t_end"], cues["speaker"], cues["n_words"]):
            if (source, r) != run:
                run, number, words = (source, r), 0, 0
            else:
                gap = start - last_end if start == start and last_end == last_end else 0.0  # NaN: untimed
                turn = speaker is not None and last_speaker is not None and speaker != last_speaker
                if (turn and words >= speaker_words) or (gap >= pause and words >= pause_words) or words >= min(target, most):
                    number, words = number + 1, 0
            out.append(number)
            words += n
            last_end, last_speaker = end, speaker
        yield pd.DataFrame({"source_id": cues["source_id"], "run": cues["run"], "cue_no": cues["cue_no"], "part": out})


def segment(cues: DataFrame, lexicon: Lexicon = Lexicon(), *, target_words: int = 280, max_words: int = 600, hard_gap: float = HARD_GAP, pause: float = 2.5, pause_words: int = 25, speaker_words: int = 200, carry: float = 0.7) -> DataFrame:
    """Chunks of ordered cues ``(source_id, cue_no, t_start, t_end, speaker, text)``.

    A gap of ``hard_gap`` seconds always ends a chunk, so a source falls into runs that are cut apart from each
    other; inside a run only the open chunk's words decide. Only times, speakers and word counts go through the
    helper, not the texts. Chunks of blank text are dropped before they are numbered.
    """
    w = Window.partitionBy("source_id").orderBy("cue_no")
    gap = F.col("t_start") - F.lag("t_end").over(w)
    c = cues.withColumn("n_words", count_words(F.col("text"))).withColumn("jump", F.coalesce((gap >= hard_gap).cast("int"), F.lit(0)))
    c = c.withColumn("run", F.sum("jump").over(w))
    slim = c.select("source_id", "run", "cue_no", "t_start", "t_end", "speaker", "n_words").repartition("source_id", "run").sortWithinPartitions("source_id", "run", "cue_no")
    schema = slim.select("source_id", "run", "cue_no").schema.add("part", "integer")
    cut = slim.mapInPandas(lambda parts: _cut(parts, target_words, max_words, pause, pause_words, speaker_words), schema)
    d = c.join(cut, ["source_id", "run", "cue_no"]).groupBy("source_id", "run", "part").agg(F.array_sort(F.collect_list(F.struct("cue_no", "text", "t_start", "t_end", "speaker"))).alias("cues"))
    raw = F.trim(F.array_join(F.transform("cues", lambda x: x["text"]), " "))
    speakers = F.array_sort(F.array_distinct(F.filter(F.transform("cues", lambda x: x["speaker"]), lambda s: F.coalesce(s, F.lit("")) != "")))
    d = d.select("source_id", F.col("cues")[0]["cue_no"].alias("first_cue"), raw.alias("raw_text"), F.col("cues")[0]["t_start"].alias("t_start"), F.element_at("cues", -1)["t_end"].alias("t_end"), speakers.alias("speakers"))
    return finish(d.where("raw_text != ''"), lexicon, hard_gap, carry)


def finish(d: DataFrame, lexicon: Lexicon = Lexicon(), hard_gap: float = HARD_GAP, carry: float = 0.7) -> DataFrame:
    """Numbers, spans, kinds and salience of chunks ``(source_id, first_cue, raw_text, t_start, t_end, speakers)``.

    A chunk takes a share of a neighbour's own salience where both are of one run of talk and neither is gated.
    """
    w = Window.partitionBy("source_id").orderBy("first_cue")
    d = d.withColumns({"sequence": F.row_number().over(w) - 1, "char_start": F.coalesce(F.sum(F.length("raw_text") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    d = d.withColumn("segment_type", segment_type(F.col("raw_text"), lexicon))
    d = d.withColumn("base", salience(F.col("raw_text"), F.col("segment_type"), lexicon))
    gated = F.col("segment_type").isin(*GATED)
    open_ = F.when(~gated, F.col("base"))
    near = lambda a, b: F.coalesce(b - a < hard_gap, F.lit(True))
    before = F.when(near(F.lag("t_end").over(w), F.col("t_start")), F.lag(open_).over(w))
    after = F.when(near(F.col("t_end"), F.lead("t_start").over(w)), F.lead(open_).over(w))
    best = F.greatest(before, after)
    lifted = F.when(~gated & best.isNotNull(), F.round(F.greatest(F.col("base"), carry * best), 3)).otherwise(F.col("base"))
    return d.select(
        "source_id", "sequence", clean_text(F.col("raw_text"), lexicon).alias("text"), "raw_text", "t_start", "t_end", F.when(F.size("speakers") == 1, F.col("speakers")[0]).alias("speaker"), "speakers",
        lifted.alias("salience"), "segment_type", F.col("char_start").cast("int").alias("char_start"), (F.col("char_start") + F.length("raw_text")).cast("int").alias("char_end"),
    )


def salience_gate(chunks: DataFrame, least: float = 0.30) -> DataFrame:
    return chunks.where(F.col("salience") >= least)
