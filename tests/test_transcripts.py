from assay.sources import transcripts as tr

VTT = "WEBVTT\n\n1\n00:00:12.4 --> 00:00:18.100\n<v Jane Doe>Hello <c.yellow>there</c>\n\n00:21:28.4 --> 00:21:30.000\nfirst line\nsecond line\n"
SRT = "1\r\n00:00:01,500 --> 00:00:02,000\r\nBob: hi\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\n\r\n"


def parse(spark, *files):
    cues, bad = tr.parse_transcripts(spark.createDataFrame(files, "source_id string, suffix string, content string"))
    return [tuple(r) for r in cues.orderBy("source_id", "cue_no").collect()], [tuple(r) for r in bad.collect()]


def test_timed(spark):
    cues, bad = parse(spark, ("v", "vtt", VTT), ("w", "SRT", SRT))
    assert cues == [("v", 0, 12.4, 18.1, "Jane Doe", "Hello there"), ("v", 1, 1288.4, 1290.0, None, "first line second line"), ("w", 0, 1.5, 2.0, "Bob", "hi")]
    assert bad == []


def test_json(spark):
    cues, bad = parse(
        spark, ("a", "json", '[{"text": "x", "start": 1, "end": 2.5}]'), ("b", "json", '{"utterances": [{"transcript": "y", "startTime": "3", "endTime": 4, "speaker": "S1"}, {"text": " "}]}'), ("c", "json", '{"foo": "bar"}'), ("d", "docx", "z")
    )
    assert cues == [("a", 0, 1.0, 2.5, None, "x"), ("b", 0, 3.0, 4.0, "S1", "y")]
    assert sorted(bad) == [("c", "no recognised segment list"), ("d", "unsupported format")]


def test_plain(spark):
    turns = "Jane: hello there\nBob: hi\nJane: bye\n"
    bold = "Notes first.\n\n**Speaker 1:** one **Speaker 2:** two\n**Speaker 1:** three **Speaker 2:** four"
    prose = "One paragraph.\n\nJane: only once"
    cues, _ = parse(spark, ("a", "txt", turns), ("b", "md", bold), ("c", "txt", prose), ("d", "txt", ""))
    assert [c[4:] for c in cues if c[0] == "a"] == [("Jane", "Jane: hello there"), ("Bob", "Bob: hi"), ("Jane", "Jane: bye")]
    assert [c[4:] for c in cues if c[0] == "b"] == [(None, "Notes first."), ("Speaker 1", "Speaker 1: one"), ("Speaker 2", "Speaker 2: two"), ("Speaker 1", "Speaker 1: three"), ("Speaker 2", "Speaker 2: four")]
    assert [c[4:] for c in cues if c[0] == "c"] == [(None, "One paragraph."), (None, "Jane: only once")]


def test_files_and_manifest(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.TXT").write_text("hello")
    (tmp_path / "b.pdf").write_text("no")
    files = tr.read_transcripts(spark, f"file://{tmp_path}")
    manifest = spark.createDataFrame([], "path string, platform string, published_at date, creator string")
    row = tr.with_manifest(files, manifest, "2026-01-01").collect()
    assert [(r.suffix, r.content, r.platform, r.creator) for r in row] == [("txt", "hello", "other", "Unknown")]


def test_quarantine(spark):
    d = spark.createDataFrame([("a", 0.5, 900, "en"), ("b", 0.9, 10, "en"), ("c", 0.9, 900, "fr"), ("d", 0.9, 900, "en")], "source_id string, asr_confidence double, n_words int, lang string")
    assert [r.quarantine_reason for r in tr.quarantine(d).orderBy("source_id").collect()] == ["low_asr_confidence", "too_short", "wrong_language", None]
