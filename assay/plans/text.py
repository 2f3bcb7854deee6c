"""Text queries over conversations and documents, each beside its SQL where one exists."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay import vocab
from assay.operators import chunks as ch, validate as va
from assay.sources import transcripts as tr
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


#: Patterns that occur in invented prose; a real corpus brings its own.
LEXICON = ch.Lexicon(promo=r"[*]{3}|!!", admin=r"\|", technical="tion ", domain="ing |tion|heit", numeric="[0-9]+", cause="the ", advice="and ", experience="with ")


def _cues(spark, sf_dir):
    return table(spark, sf_dir, "conversations").selectExpr("CAST(conv_id AS STRING) AS source_id", "CAST(turn AS INT) AS cue_no", "CAST(NULL AS DOUBLE) AS t_start", "CAST(NULL AS DOUBLE) AS t_end", "role AS speaker", "text")


_N = lambda p, t="text": f"len(regexp_extract_all({t}, '{p}'))"
_WORDS = r"len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]+'))"
_TYPED = rf"""w AS (SELECT *, greatest({_WORDS}, 1) AS n, {_N("[*][*][*]|!!")} AS promo, {_N("[|]")} AS admin, {_N("tion ")} + CASE WHEN regexp_matches(text, '[0-9]+') THEN 2 ELSE 0 END < 3 AS plain FROM turns),
  k AS (SELECT *, CASE WHEN promo > 0 AND (n <= 150 OR promo * 100 / n >= 1.2) AND plain THEN 'promo' WHEN admin > 0 AND (n <= 150 OR admin * 100 / n >= 1.2) AND promo = 0 AND plain THEN 'intro' ELSE 'explanation' END AS segment_type FROM w),
  b AS (SELECT *, CASE WHEN segment_type <> 'explanation' THEN 0.05e0 ELSE round(least(1.0e0, (least(0.65e0, 0.13e0 * {_N("ing |tion|heit")}) + CASE WHEN regexp_matches(text, '[0-9]+') THEN 0.20e0 ELSE 0e0 END + CASE WHEN contains(text, 'the ') THEN 0.12e0 ELSE 0e0 END
    + CASE WHEN contains(text, 'and ') THEN 0.10e0 ELSE 0e0 END + CASE WHEN contains(text, 'with ') THEN 0.10e0 ELSE 0e0 END) * CASE WHEN {_WORDS} < 12 THEN 0.55e0 WHEN {_WORDS} < 25 THEN 0.85e0 ELSE 1e0 END), 3) END AS base FROM k)"""


@query(rf"WITH turns AS (SELECT conv_id, turn, text FROM conversations), {_TYPED} SELECT conv_id, turn, segment_type, base AS salience FROM b")
def turn_salience(spark, sf_dir):
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text").withColumn("segment_type", ch.segment_type(F.col("text"), LEXICON))
    return d.select("conv_id", "turn", "segment_type", ch.salience(F.col("text"), F.col("segment_type"), LEXICON).alias("salience"))


@query(
    rf"""WITH turns AS (SELECT conv_id, turn, trim(text) AS text FROM conversations WHERE trim(text) <> ''), {_TYPED},
    s AS (SELECT conv_id, row_number() OVER w - 1 AS sequence, coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS char_start, length(text) AS len, segment_type, base,
      lag(CASE WHEN segment_type = 'explanation' THEN base END) OVER w AS p, lead(CASE WHEN segment_type = 'explanation' THEN base END) OVER w AS q FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT CAST(conv_id AS VARCHAR) AS source_id, CAST(sequence AS INT) AS sequence, segment_type, CASE WHEN segment_type = 'explanation' AND greatest(p, q) IS NOT NULL THEN round(greatest(base, 0.7e0 * greatest(p, q)), 3) ELSE base END AS salience,
      CAST(char_start AS INT) AS char_start, CAST(char_start + len AS INT) AS char_end FROM s"""
)
def chunk_carry(spark, sf_dir):
    """Every turn as a chunk: numbers, spans, and salience carried from neighbours."""
    d = _cues(spark, sf_dir).where("trim(text) != ''").select("source_id", F.col("cue_no").alias("first_cue"), F.trim("text").alias("raw_text"), "t_start", "t_end", F.array("speaker").alias("speakers"))
    return ch.finish(d, LEXICON).select("source_id", "sequence", "segment_type", "salience", "char_start", "char_end")


@query()
def segments(spark, sf_dir):
    """Chunks of whole conversations."""
    return ch.segment(_cues(spark, sf_dir), LEXICON)


@query()
def timed_segments(spark, sf_dir):
    """Chunks of timed cues: a user's events, with an event's name as its words."""
    e = table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS source_id", "CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS cue_no", "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) / 1e9 AS t_start", "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) / 1e9 + 0.5 AS t_end",
        "CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'b' END AS speaker", "repeat(concat(event_type, ' '), CAST(value AS INT) % 40) AS text",
    )
    return ch.segment(e, LEXICON)


@query(
    r"""WITH p AS (SELECT d.doc_id, b.item_id, d.text AS source, b.text AS quote, trim(regexp_replace(d.text, '[ \t\n\r\f\x0B]+', ' ', 'g')) AS cs, trim(regexp_replace(b.text, '[ \t\n\r\f\x0B]+', ' ', 'g')) AS cq FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))
    SELECT doc_id, item_id, CASE WHEN strpos(source, quote) > 0 THEN 'exact' WHEN strpos(cs, cq) > 0 THEN 'whitespace_normalized' ELSE 'not_found' END AS match_kind, CAST(CASE WHEN strpos(source, quote) > 0 THEN strpos(source, quote) - 1 WHEN strpos(cs, cq) > 0 THEN strpos(cs, cq) - 1 END AS INT) AS quote_offset FROM p"""
)
def quote_matches(spark, sf_dir):
    """A benchmark passage looked for in each document."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("raw_text"))
    b = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("verbatim_quote"))
    claims = d.select("chunk_id").join(b, F.col("chunk_id") % b.count() == F.col("item_id"))
    return va.match_quotes(claims, d).select(F.col("chunk_id").alias("doc_id"), "item_id", "match_kind", "quote_offset")


@query(rf"WITH turns AS (SELECT conv_id, role, text, {_WORDS} AS n FROM conversations) SELECT CAST(conv_id AS VARCHAR) AS source_id, false AS has_timestamps, bool_or(role IS NOT NULL) AS has_speaker_labels, CAST(sum(n) AS BIGINT) AS n_words FROM turns GROUP BY conv_id")
def transcript_quality(spark, sf_dir):
    return tr.assess(_cues(spark, sf_dir))


@query()
def turn_labelled_text(spark, sf_dir):
    """Conversations written out as labelled text and parsed back into cues."""
    c = table(spark, sf_dir, "conversations")
    lines = F.array_sort(F.collect_list(F.struct("turn", F.concat(F.initcap("role"), F.lit(": "), F.regexp_replace("text", "\\s+", " ")).alias("line"))))
    files = c.groupBy(F.col("conv_id").cast("string").alias("source_id")).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("content"))
    return tr.parse_plain(files)


# ---- parsers: conversations written out as files and read back

_CLEAN = r"""'7x ' || trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N} .,:;!?''()-]+', ' ', 'g'), ' +', ' ', 'g'))"""


def _turns(spark, sf_dir):
    """Turns with a time each, on one line, without the signs of markup; letters of any alphabet, digits, colons and brackets stay. A first word keeps texts from looking like labels."""
    text = F.concat(F.lit("7x "), F.trim(F.regexp_replace(F.regexp_replace("text", r"[^\p{L}\p{N} .,:;!?'()-]+", " "), " +", " ")))
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("source_id"), "turn", "role", text.alias("said")).where("said <> ''")


def _files(turns, line, join, head=""):
    lines = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    return turns.groupBy("source_id").agg(F.concat(F.lit(head), F.array_join(F.transform(lines, lambda x: x["line"]), join)).alias("content"))


def _stamp(seconds, mark):
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.expr(f"CAST({seconds} div 3600 AS INT)"), F.expr(f"CAST({seconds} div 60 % 60 AS INT)"), F.expr(f"CAST({seconds} % 60 AS INT)"), F.lit(250))


_NUMBERED = f"t AS (SELECT CAST(conv_id AS VARCHAR) AS source_id, turn, role, {_CLEAN} AS said FROM conversations), n AS (SELECT *, CAST(row_number() OVER (PARTITION BY source_id ORDER BY turn) - 1 AS INT) AS cue_no FROM t WHERE said <> '')"


@query(f"WITH {_NUMBERED} SELECT source_id, cue_no, turn * 700 + 0.25e0 AS t_start, turn * 700 + 9.25e0 AS t_end, CASE WHEN role = 'user' THEN 'User' END AS speaker, said AS text FROM n")
def caption_cues(spark, sf_dir):
    """Captions with times, numbers, voice tags and markup: users are named, assistants' words are in tags."""
    voice = F.when(F.col("role") == "user", F.concat(F.lit("<v User>"), "said", F.lit("</v>"))).otherwise(F.concat(F.lit("<c.loud>"), "said", F.lit("</c>")))
    block = F.concat_ws("\n", F.col("turn").cast("string"), F.concat(_stamp("turn * 700", "."), F.lit(" --> "), _stamp("(turn * 700 + 9)", "."), F.lit(" align:start")), voice)
    return tr.parse_timed(_files(_turns(spark, sf_dir), block, "\n\n", "WEBVTT\n\n"))


@query(f"WITH {_NUMBERED} SELECT source_id, cue_no, turn * 700 + 0.25e0 AS t_start, turn * 700 + 9.25e0 AS t_end, 'Speaker ' || upper(left(role, 1)) AS speaker, said AS text FROM n")
def subtitle_cues(spark, sf_dir):
    """Subtitles with comma times, Windows line ends and labels before the words."""
    label = F.concat(F.lit("Speaker "), F.upper(F.substring("role", 1, 1)), F.lit(": "), "said")
    block = F.concat_ws("\r\n", F.col("turn").cast("string"), F.concat(_stamp("turn * 700", ","), F.lit(" --> "), _stamp("(turn * 700 + 9)", ",")), label)
    return tr.parse_timed(_files(_turns(spark, sf_dir), block, "\r\n\r\n"))


@query(
    f"""WITH {_NUMBERED} SELECT source_id, cue_no, CASE WHEN CAST(source_id AS BIGINT) % 5 < 4 THEN turn * 10e0 END AS t_start, CASE WHEN CAST(source_id AS BIGINT) % 5 < 4 THEN turn * 10 + 5e0 END AS t_end, CASE WHEN CAST(source_id AS BIGINT) % 5 < 4 THEN role END AS speaker, said AS text, CAST(NULL AS VARCHAR) AS reason FROM n WHERE CAST(source_id AS BIGINT) % 5 < 4
    UNION ALL SELECT source_id, NULL, NULL, NULL, NULL, NULL, 'no recognised segment list' FROM n WHERE CAST(source_id AS BIGINT) % 5 = 4 GROUP BY source_id"""
)
def speech_cues(spark, sf_dir):
    """Speech recognition output in four shapes, and in one that isn't known."""
    t = _turns(spark, sf_dir)
    shape = F.col("source_id").cast("long") % 5
    item = F.struct((F.col("turn") * 10).alias("start"), (F.col("turn") * 10 + 5).alias("end"), F.col("role").alias("speaker"), F.col("said").alias("text"))
    other = F.struct((F.col("turn") * 10).alias("startTime"), (F.col("turn") * 10 + 5).alias("endTime"), F.col("role").alias("speaker_label"), F.col("said").alias("transcript"))
    line = F.when(shape < 3, F.to_json(item)).otherwise(F.to_json(other))
    files = _files(t, line, ",")
    list_ = F.concat(F.lit("["), "content", F.lit("]"))
    keyed = lambda name: F.concat(F.lit('{"' + name + '":'), list_, F.lit("}"))
    body = F.when(shape == 0, list_).when(shape == 1, keyed("segments")).when(shape == 2, keyed("utterances")).when(shape == 3, keyed("results")).otherwise(keyed("entries"))
    cues, bad = tr.parse_json(files.withColumn("content", body))
    return cues.withColumn("reason", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


@query(
    rf"""WITH {_NUMBERED}, k AS (SELECT source_id, count(*) AS labels FROM n GROUP BY source_id), s AS (SELECT n.*, labels >= 3 AS named FROM n JOIN k USING (source_id))
    SELECT source_id, cue_no, CASE WHEN named THEN upper(left(role, 1)) || substr(role, 2) END AS speaker, upper(left(role, 1)) || substr(role, 2) || ': ' || said AS text FROM s WHERE CAST(source_id AS BIGINT) % 2 = 0
    UNION ALL SELECT source_id, cue_no, NULL, said FROM s WHERE CAST(source_id AS BIGINT) % 2 = 1"""
)
def plain_cues(spark, sf_dir):
    """Texts with labels, bold or not, as turns; texts with few labels or none as paragraphs."""
    kind = F.col("source_id").cast("long")
    name = F.initcap("role")
    line = F.when(kind % 4 == 0, F.concat(F.lit("**"), name, F.lit(":** "), "said")).when(kind % 4 == 2, F.concat(name, F.lit(": "), "said")).otherwise(F.col("said"))
    cues = tr.parse_plain(_files(_turns(spark, sf_dir), line, "\n\n"))
    # a text with fewer than three bold labels keeps them as they were written
    return cues.select("source_id", "cue_no", "speaker", F.regexp_replace("text", r"^\*\*(\w+):\*\* ", "$1: ").alias("text"))


@query(
    """WITH d AS (SELECT conv_id, turn, list_filter(string_split(regexp_replace(text, '[^a-zA-Z]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM conversations),
    s AS (SELECT conv_id, turn, flatten(list_transform(w, lambda x, i: CASE WHEN (i + turn) % 4 = 0 THEN [x, upper(x), x] ELSE [x] END)) AS v FROM d), f AS (SELECT conv_id, turn, list_filter(string_split(regexp_replace(array_to_string(v, ' '), 'hth|nen', '', 'g'), ' '), lambda x: x <> '') AS u FROM s),
    c AS (SELECT conv_id, turn, array_to_string(list_filter(u, lambda x, i: i = 1 OR lower(x) <> lower(u[i - 1])), ' ') AS c FROM f) SELECT conv_id, turn, upper(left(c, 1)) || substr(c, 2) AS text FROM c"""
)
def cleaned_turns(spark, sf_dir):
    """Turns without fillers (two syllables of these tables stand for them) and stutters (every fourth word is said three times), spaces collapsed, first letter a capital."""
    w = F.filter(F.split(F.regexp_replace("text", "[^a-zA-Z]+", " "), " "), lambda x: x != "")
    said = F.flatten(F.transform(w, lambda x, i: F.when((i + 1 + F.col("turn")) % 4 == 0, F.array(x, F.upper(x), x)).otherwise(F.array(x))))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(said, " ").alias("text"))
    return c.select("conv_id", "turn", ch.clean_text(F.col("text"), ch.Lexicon(fillers="hth|nen")).alias("text"))


@query(rf"WITH turns AS (SELECT conv_id, turn, text FROM conversations), {_TYPED} SELECT segment_type, count(*) AS chunks, round(sum(base), 6) AS salience FROM b WHERE base >= 0.30 GROUP BY segment_type")
def gated_turns(spark, sf_dir):
    """What passes the gate, by kind."""
    d = table(spark, sf_dir, "conversations").withColumn("segment_type", ch.segment_type(F.col("text"), LEXICON))
    d = ch.salience_gate(d.withColumn("salience", ch.salience(F.col("text"), F.col("segment_type"), LEXICON)))
    return d.groupBy("segment_type").agg(F.count("*").alias("chunks"), F.round(F.sum("salience"), 6).alias("salience"))


# ---- claims held against what was said

_CLAIM = "conv_id * 10 + turn"
_LIST = lambda xs: ", ".join(f"'{x}'" for x in xs)
#: A claim of every turn, with faults by number; the quote is a part of the turn, whole or spoilt.
_CLAIMS = f"""
  {_CLAIM} AS claim_id, CAST(conv_id AS {{text}}) || '-' || turn AS chunk_id,
  CASE ({_CLAIM}) % 7 WHEN 0 THEN replace(substr(text, 4, 60), ' ', '  ') WHEN 1 THEN 'zq' || substr(text, 4, 60) WHEN 2 THEN substr(text, 4, 6) WHEN 3 THEN NULL ELSE substr(text, 4, 60) END AS verbatim_quote,
  CASE ({_CLAIM}) % 5 WHEN 0 THEN ' ' || replace(substr(text, 4, 60), ' ', '   ') WHEN 1 THEN 'brief' ELSE 'What ' || role || ' says in turn ' || turn END AS normalized_statement,
  CASE ({_CLAIM}) % 11 WHEN 0 THEN 'guess' WHEN 1 THEN NULL ELSE '{vocab.CLAIM_TYPES[1]}' END AS claim_type,
  CASE ({_CLAIM}) % 13 WHEN 0 THEN 'rumour' ELSE '{list(vocab.TIER_WEIGHT)[6]}' END AS evidence_tier,
  CASE ({_CLAIM}) % 4 WHEN 0 THEN 'galaxy' WHEN 1 THEN 'conditional' WHEN 2 THEN NULL ELSE 'general' END AS scope,
  CASE ({_CLAIM}) % 6 WHEN 0 THEN 1.5e0 WHEN 1 THEN NULL ELSE 0.25e0 END AS hedge_level,
  ({_CLAIM}) % 3 AS n_conditions, CASE ({_CLAIM}) % 3 WHEN 0 THEN 'relative_humidity' WHEN 1 THEN 'length_mm' ELSE 'other' END AS name,
  CASE ({_CLAIM}) % 8 WHEN 0 THEN 'many' ELSE CAST(({_CLAIM}) * 7 % 130 AS {{text}}) END AS value, CASE ({_CLAIM}) % 5 WHEN 0 THEN 'Percent ' WHEN 1 THEN 'cubits' WHEN 2 THEN NULL ELSE 'mm' END AS unit,
  turn * 10 + ({_CLAIM}) % 4 * 5e0 - 5e0 AS t_start, turn * 10 + 8e0 + ({_CLAIM}) % 3 AS t_end, ({_CLAIM}) % 9 = 0 AS is_reported_from_other, CASE WHEN ({_CLAIM}) % 2 = 0 THEN 'someone' ELSE '' END AS reported_from
"""
_SPACE = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_CODES = [
    ("kind = 'lost'", "quote_lost"), ("kind = 'loose'", "quote_whitespace_normalized"), ("length(trim(q)) < 10", "quote_too_short"), ("length(trim(normalized_statement)) < 10", "statement_too_short"),
    (f"q <> '' AND lower({_SPACE.format('q')}) = lower({_SPACE.format('normalized_statement')})", "statement_not_normalized"), (f"claim_type IS NULL OR claim_type NOT IN ({_LIST(vocab.CLAIM_TYPES)})", "claim_type_invalid"),
    (f"evidence_tier NOT IN ({_LIST(vocab.TIER_WEIGHT)})", "evidence_tier_invalid"), (f"scope NOT IN ({_LIST(vocab.SCOPES)})", "scope_invalid"), ("hedge_level IS NULL OR hedge_level NOT BETWEEN 0 AND 1", "hedge_level_invalid"),
    ("scope = 'conditional' AND n_conditions = 0", "conditional_without_conditions"), ("t_start < lo OR t_start > hi", "timestamp_clamped"), ("t_end < lo OR t_end > hi", "timestamp_clamped"), ("is_reported_from_other AND reported_from = ''", "reported_from_missing"),
    ("unit = 'Percent '", "unit_normalized"), ("unit = 'cubits'", "unit_unknown"), ("(name = 'relative_humidity' AND v > 100) OR (name = 'length_mm' AND (v < 4 OR v > 25))", "value_implausible"),
]
_DISCARDS = ("quote_lost", "quote_too_short", "statement_too_short", "claim_type_invalid", "evidence_tier_invalid")
_JUDGED_SQL = rf"""c AS (SELECT {_CLAIMS.format(text="VARCHAR")}, text AS said, turn * 10e0 AS lo, turn * 10 + 9e0 AS hi FROM conversations),
  k AS (SELECT *, coalesce(verbatim_quote, '') AS q, TRY_CAST(value AS DOUBLE) AS v FROM c), m AS (SELECT *, CASE WHEN q <> '' AND strpos(said, q) > 0 THEN 'exact' WHEN q <> '' AND strpos({_SPACE.format("said")}, {_SPACE.format("q")}) > 0 THEN 'loose' ELSE 'lost' END AS kind FROM k),
  f AS (SELECT *, list_sort(list_filter([{", ".join(f"CASE WHEN {when} THEN '{code}' END" for when, code in _CODES)}], lambda x: x IS NOT NULL)) AS codes FROM m)"""


def _claims(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    d = c.selectExpr(f"inline(array(struct({_CLAIMS.format(text='STRING')})))")
    some = F.struct(F.lit("a").alias("variable"))
    d = d.withColumns({"conditions": F.slice(F.array(some), F.lit(1), F.least(F.col("n_conditions"), F.lit(1)).cast("int")), "parameters": F.array(F.struct("name", "value", "unit"))})
    chunks = c.selectExpr("concat(conv_id, '-', turn) AS chunk_id", "text AS raw_text", "turn * 10e0 AS t_start", "turn * 10 + 9e0 AS t_end")
    return d.drop("n_conditions", "name", "value", "unit"), chunks


@query(
    rf"""WITH {_JUDGED_SQL} SELECT claim_id, array_to_string(codes, ',') AS codes, len(list_filter(codes, lambda x: x IN ({_LIST(_DISCARDS)}))) = 0 AS ok, greatest(lo, least(hi, t_start)) AS t_start, greatest(lo, least(hi, t_end)) AS t_end,
      CASE unit WHEN 'Percent ' THEN '%RH' ELSE unit END AS unit, CAST(CASE kind WHEN 'exact' THEN strpos(said, q) - 1 WHEN 'loose' THEN strpos({_SPACE.format("said")}, {_SPACE.format("q")}) - 1 END AS INT) AS quote_offset FROM f"""
)
def claim_validation(spark, sf_dir):
    """Every rule over a claim of each turn; a quote that isn't found is lost here, paraphrased or not, as SQL has no likeness of token lists."""
    d = va.validate_claims(*_claims(spark, sf_dir))
    code = lambda f: F.when(f["code"].isin("quote_paraphrased", "quote_not_found"), "quote_lost").otherwise(f["code"])
    return d.select("claim_id", F.array_join(F.array_sort(F.transform("findings", code)), ",").alias("codes"), "ok", "t_start", "t_end", F.col("repaired_units")[0].alias("unit"), "quote_offset")


@query(
    rf"""WITH {_JUDGED_SQL}, x AS (SELECT claim_id % 5 AS source_id, unnest(codes) AS code FROM f), y AS (SELECT source_id, code, count(*) AS n FROM x GROUP BY ALL)
    SELECT source_id, code, n FROM y UNION ALL SELECT NULL, code, sum(n) FROM y GROUP BY code"""
)
def validation_stats(spark, sf_dir):
    """Findings by source and code, with totals."""
    d = va.validate_claims(*_claims(spark, sf_dir)).withColumn("source_id", F.col("claim_id") % 5)
    s = va.extraction_stats(d).withColumn("code", F.when(F.col("code").isin("quote_paraphrased", "quote_not_found"), "quote_lost").otherwise(F.col("code")))
    return s.groupBy("source_id", "code", "total").agg(F.sum("n").alias("n")).select("source_id", "code", "n")


@query("SELECT o_custkey AS claim_id, o_orderkey AS first FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_claims(spark, sf_dir):
    """Of rows that share an id the first by date, then key."""
    o = table(spark, sf_dir, "orders").selectExpr("o_custkey AS claim_id", "o_orderdate AS at", "o_orderkey AS first")
    return va.first_per_id(o, "claim_id", "at", "first").select("claim_id", "first")
