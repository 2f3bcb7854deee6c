"""Segmentation against a plain restatement, and the cleaning, kind and salience rules."""

import random

import pytest
from pyspark.sql import functions as F

from assay.operators import chunks as ch

SCHEMA = "source_id string, cue_no int, t_start double, t_end double, speaker string, text string"


def plain(cues, target=280, most=600):
    """Chunks of one source's cues as lists of cue numbers."""
    out, buf = [], []
    for c in cues:
        if buf:
            words = sum(len(x[5].split()) for x in buf)
            prev = buf[-1]
            gap = c[2] - prev[3] if c[2] is not None and prev[3] is not None else 0.0
            turn = c[4] is not None and prev[4] is not None and c[4] != prev[4] and words >= 200
            if turn or gap >= 25 or (gap >= 2.5 and words >= 25) or words >= min(target, most):
                out.append(buf)
                buf = []
        buf.append(c)
    out.append(buf)
    return [" ".join(x[5] for x in b).strip() for b in out if " ".join(x[5] for x in b).strip()]


@pytest.mark.parametrize("parts", [1, 7])
def test_segment_matches_plain_rule(spark, parts):
    rng = random.Random(3)
    rows, expected = [], {}
    for s in range(12):
        t, cues = 0.0, []
        for k in range(rng.randrange(1, 60)):
            t += rng.choice([0.1, 1.0, 3.0, 30.0])
            timed = s % 3 != 0
            text = " ".join(rng.choice(["so", "the", "glue"]) for _ in range(rng.choice([0, 3, 20, 60, 150])))
            cues.append((f"s{s}", k, t if timed else None, t + 1 if timed else None, rng.choice(["a", "b", None]), text))
            t += 1
        expected[f"s{s}"] = plain(cues)
        rows += cues
    rng.shuffle(rows)
    got = ch.segment(spark.createDataFrame(rows, SCHEMA).repartition(parts)).orderBy("source_id", "sequence").collect()
    found = {}
    for r in got:
        assert r.sequence == len(found.setdefault(r.source_id, []))
        assert r.char_start == sum(len(x) + 1 for x in found[r.source_id]) and r.char_end == r.char_start + len(r.raw_text)
        found[r.source_id].append(r.raw_text)
    assert found == {k: v for k, v in expected.items() if v}


def test_segment_of_nothing(spark):
    assert ch.segment(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("raw,clean", [("um so uh the the glue  cures", "So the glue cures"), ("i think maybe it it it works", "I think maybe it works"), ("", ""), ("erm, well", "Well")])
def test_clean_text(spark, raw, clean):
    assert spark.createDataFrame([(raw,)], "t string").select(ch.clean_text(F.col("t"))).first()[0] == clean


def test_kinds_and_salience(spark):
    texts = {
        "Use code LASH and sign up today, link in bio": ("promo", 0.05),
        "Welcome back to the show": ("intro", 0.05),
        "humidity matters because the adhesive cures above 60 % for your client": ("explanation", 0.651),
        "yeah right": ("explanation", 0.0),
    }
    d = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("k", ch.segment_type(F.col("t")))
    got = {r.t: (r.k, r.s) for r in d.withColumn("s", ch.salience(F.col("t"), F.col("k"))).collect()}
    for t, (kind, s) in texts.items():
        assert got[t][0] == kind and got[t][1] == pytest.approx(s, abs=0.1), (t, got[t])


def test_carry_lifts_only_near_and_open_neighbours(spark):
    strong = "humidity and adhesive and retention: the bond should never fail because of 60 % " + "word " * 20
    weak = "and that is how she was doing after it " + "word " * 20
    rows = [("a", 0, 0.0, 10.0, None, strong), ("a", 1, 16.0, 20.0, None, weak), ("b", 0, 0.0, 10.0, None, strong), ("b", 1, 3000.0, 3010.0, None, weak)]
    got = {(r.source_id, r.sequence): r.salience for r in ch.segment(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["a", 1] >= 0.30 > got["b", 1]
