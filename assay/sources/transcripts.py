"""Transcript files to ordered cues, with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from assay import vocab

SUFFIXES = ("vtt", "srt", "json", "txt", "md")
_CUE = "source_id string, cue_no int, t_start double, t_end double, speaker string, text string"
_LEAST_LABELS = 3
#: Stands for a label's place while a text is cut at its labels; texts never hold it.
_MARK, _END = "\u0001", "\u0002"


def read_transcripts(spark: SparkSession, root: str) -> DataFrame:
    """Rows ``(path, suffix, content)`` of every transcript file below ``root``, whatever the case of its suffix."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).withColumn("path", F.input_file_name())
    files = files.withColumn("suffix", F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1)))
    return files.where(F.col("suffix").isin(*SUFFIXES)).select("path", "suffix", F.col("value").alias("content"))


def with_manifest(files: DataFrame, manifest: DataFrame, today: str) -> DataFrame:
    """Adds platform, published_at and creator of each file's manifest row, or defaults where it has none."""
    d = files.join(manifest, "path", "left")
    return d.select(files["*"], F.coalesce("platform", F.lit("other")).alias("platform"), F.coalesce("published_at", F.lit(today).cast("date")).alias("published_at"), F.coalesce("creator", F.lit("Unknown")).alias("creator"))


def _seconds(text: Column, group: int) -> Column:
    part = lambda k: F.regexp_extract(text, vocab.TIMING, group + k)
    return part(0).cast("double") * 3600 + part(1).cast("double") * 60 + part(2).cast("double") + F.rpad(part(3), 3, "0").cast("double") / 1000


def _words(text: Column) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _numbered(cues: DataFrame) -> DataFrame:
    """Cues numbered from 0 in the order of their place within each source."""
    from pyspark.sql import Window

    return cues.withColumn("cue_no", F.row_number().over(Window.partitionBy("source_id").orderBy("pos")) - 1)


def parse_timed(files: DataFrame) -> DataFrame:
    """VTT and SRT cues of rows ``(source_id, content)``: the first timing line of a block counts, later lines are text.

    The speaker is read before tags go, as a voice tag names it.
    """
    content = F.regexp_replace(F.col("content"), r"\r\n?", "\n")
    blocks = files.select("source_id", F.posexplode(F.split(content, r"\n\s*\n")).alias("pos", "block")).where(F.col("block").rlike(vocab.TIMING))
    after = F.regexp_replace("block", r"(?s)^.*?-->[^\n]*", "")
    lines = F.filter(F.split(after, "\n"), lambda x: F.trim(x) != "")
    d = blocks.select("source_id", "pos", _seconds(F.col("block"), 1).alias("t_start"), _seconds(F.col("block"), 5).alias("t_end"), F.trim(F.array_join(lines, " ")).alias("raw"))
    label = vocab.CAPTION_LABEL
    name = F.trim(F.concat(F.regexp_extract("raw", label, 1), F.regexp_extract("raw", label, 2)))
    text = F.trim(F.regexp_replace(F.regexp_replace("raw", label, ""), vocab.CAPTION_TAG, ""))
    d = d.select("source_id", "pos", "t_start", "t_end", F.when(name != "", name).alias("speaker"), text.alias("text")).where("text != ''")
    return _numbered(d).select("source_id", "cue_no", "t_start", "t_end", "speaker", "text")


_SEGMENT = "array<struct<text:string,transcript:string,start:string,t_start:string,startTime:string,end:string,t_end:string,endTime:string,speaker:string,speaker_label:string>>"


def parse_json(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cues of speech-recognition JSON, and the rows ``(source_id, reason)`` that have no known shape."""
    body = F.trim("content")
    keyed = F.from_json(body, f"struct<segments:{_SEGMENT},results:{_SEGMENT},transcript:{_SEGMENT},utterances:{_SEGMENT}>")
    listed = F.when(body.startswith("["), F.from_json(body, _SEGMENT))
    d = files.withColumn("k", keyed).withColumn("items", F.coalesce(listed, "k.segments", "k.results", "k.transcript", "k.utterances"))
    bad = d.where("items is null").select("source_id", F.lit("no recognised segment list").alias("reason"))
    s = d.select("source_id", F.posexplode("items").alias("pos", "s"))
    first = lambda *c: F.coalesce(*[F.when(F.col(f"s.{x}") != "", F.col(f"s.{x}")) for x in c])
    s = s.select(
        "source_id", "pos", F.coalesce("s.start", "s.t_start", "s.startTime").try_cast("double").alias("t_start"), F.coalesce("s.end", "s.t_end", "s.endTime").try_cast("double").alias("t_end"),
        first("speaker", "speaker_label").alias("speaker"), F.trim(first("text", "transcript")).alias("text"),
    ).where("text != ''")
    return _numbered(s).select("source_id", "cue_no", "t_start", "t_end", "speaker", "text"), bad


def parse_plain(files: DataFrame) -> DataFrame:
    """Cues of text and markdown: one per labelled turn where three labels or more of one shape are found, else one per paragraph.

    What comes before the first label is kept as a cue without speaker; a turn keeps its label in the text.
    """
    bold, plain = (F.regexp_count("content", F.lit(p)) >= _LEAST_LABELS for p in (vocab.BOLD_LABEL, vocab.PLAIN_LABEL))
    marked = F.when(bold, F.regexp_replace("content", vocab.BOLD_LABEL, f"{_MARK}$1{_END}")).when(plain, F.regexp_replace("content", vocab.PLAIN_LABEL, f"{_MARK}$1{_END}"))
    parts = F.when(marked.isNotNull(), F.split(marked, _MARK)).otherwise(F.split(F.trim("content"), r"\n\s*\n"))
    d = files.select("source_id", F.posexplode(parts).alias("pos", "part"))
    speaker = F.when(F.col("part").contains(_END), F.trim(F.substring_index("part", _END, 1)))
    said = _words(F.when(speaker.isNotNull(), F.substring_index("part", _END, -1)).otherwise(F.col("part")))
    d = d.select("source_id", "pos", speaker.alias("speaker"), said.alias("said")).where("said != ''")
    d = d.withColumn("text", F.when(F.col("speaker").isNotNull(), F.concat("speaker", F.lit(": "), "said")).otherwise(F.col("said")))
    return _numbered(d).select("source_id", "cue_no", F.lit(None).cast("double").alias("t_start"), F.lit(None).cast("double").alias("t_end"), "speaker", "text")


def parse_transcripts(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cues of rows ``(source_id, suffix, content)`` and the rejected rows ``(source_id, reason)``."""
    of = lambda *s: files.where(F.lower("suffix").isin(*s)).select("source_id", "content")
    spoken, bad = parse_json(of("json"))
    cues = parse_timed(of("vtt", "srt")).unionByName(spoken).unionByName(parse_plain(of("txt", "md")))
    unknown = files.where(~F.lower("suffix").isin(*SUFFIXES)).select("source_id", F.lit("unsupported format").alias("reason"))
    return cues, bad.unionByName(unknown)


def quarantine(sources: DataFrame, *, min_confidence: float = 0.55, min_words: int = 200, languages: tuple[str, ...] = ("en",)) -> DataFrame:
    """Adds ``quarantine_reason`` (null: accepted) from asr_confidence, n_words and lang."""
    reason = F.when(F.col("asr_confidence") < min_confidence, "low_asr_confidence").when(F.col("n_words") < min_words, "too_short").when(~F.col("lang").isin(*languages), "wrong_language")
    return sources.withColumn("quarantine_reason", reason)


def quality_label(asr_confidence: Column) -> Column:
    """How good a transcript is by its recognition's confidence; text without one was typed and counts as verbatim."""
    c = asr_confidence
    return F.when(c.isNull() | (c >= 0.95), "verbatim").when(c >= 0.85, "good").when(c >= 0.7, "fair").otherwise("poor")


def assess(cues: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Per source: whether it has times and speakers, and its words; with ``sources(source_id, asr_confidence)`` also how good its transcript is."""
    if sources is not None:
        return assess(cues).join(sources.select("source_id", quality_label(F.col("asr_confidence")).alias("transcript_quality")), "source_id", "left").withColumn("transcript_quality", F.coalesce("transcript_quality", F.lit("verbatim")))
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return cues.groupBy("source_id").agg(F.bool_or(F.col("t_start").isNotNull()).alias("has_timestamps"), F.bool_or(F.col("speaker").isNotNull()).alias("has_speaker_labels"), F.sum(words).alias("n_words"))
