"""Url rules, mixing, the registered queries and the pipeline."""

import collections
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from assay.llm import mixing, queries, urlrules
from tests.llm.test_near_duplicates import components, shingle_set
from tests.llm.test_tokens_media import check_sequences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, con, name):
    d = queries.QUERIES[name](spark, SF)
    r = con.sql(queries.ORACLE_SQL[name])
    at = [r.columns.index(c) for c in d.columns]
    round_ = lambda row: tuple(float(f"{x:.9g}") if isinstance(x, float) else x for x in row)
    assert sorted(map(str, map(round_, d.collect()))) == sorted(str(round_(tuple(x[k] for k in at))) for x in r.fetchall())


#: Queries that answer for some rows of their table, or for phrases; their own tests count what they return.
OTHER_ROWS = {"op11_approximate_neighbours", "op13_phrase_collocations"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES.keys() - OTHER_ROWS))
def test_every_row_is_answered(spark, name):
    table = {"op3_url_filters": "pages", "op4_embedding_near_dedup": "embeddings"}.get(name, "documents")
    n, rows = spark.read.parquet(f"{SF}/{table}.parquet").count(), queries.QUERIES[name](spark, SF).count()
    assert rows >= n if name.startswith("op2") else rows == n


# ---- urls


def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h) or h == "") and path.startswith(p)]
    if not fits:
        return host, path, None, default
    top = max(f[:2] for f in fits)
    mine = [f for f in fits if f[:2] == top]
    return host, path, mine[0][2], "block" if any(f[3] == "block" for f in mine) else mine[0][3]


@pytest.mark.parametrize("per", [3, 100_000])
def test_url_rules_against_brute_force(spark, per):
    rng = random.Random(per)
    hosts = ["net", "a.net", "b.a.net", "xnet", "example.com", "EXAMPLE.com", "org", "é.org", "a.net:80", "", "u@a.net"]
    paths = ["", "/", "/en/", "/en/x", "/enx", "/de/1?x=/en/", "/a//b#/en/", "?q", "#f"]
    urls = [f"{s}://{h}{p}" for s in ("http", "HTTPS") for h in hosts for p in paths] + [None, "", "no scheme", "http:/x", "a://b://c/d", "x\n://net/\n"]
    urls += ["http://a.net/en/hot"] * 200 + [None] * 50
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("a.net", "/", "block"), ("b.a.net", "/en", "allow"), ("b.a.net", "/en", "block"), ("org", "", "block"), ("", "/a", "block"), ("com", "/d", "allow"), (None, "/", "block")]
    rows = list(enumerate(rng.sample(urls, len(urls)))) + [(None, "http://net/")] * 60 + [(None, None)] * 60
    d = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, rule string").repartition(3)
    got = urlrules.judge_urls(d, spark.createDataFrame(rules, "host string, path string, verdict string"), rows_per_bucket=per).collect()
    known = [r for r in rules if None not in r]
    assert collections.Counter((r.id, r.host, r.path, r.rule, r.verdict) for r in got) == collections.Counter((k, *judge(u, known)) for k, u in rows)


def test_url_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in urlrules.judge_urls(pages, none).collect()] == [(None, "allow")]
    assert urlrules.judge_urls(pages.limit(0), none).count() == 0


# ---- mixing


def test_targets_fill_up_to_the_limits(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 500), ("d", 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights: a 5, b 2, c 1, d 5, null 2; budget 1.5 * 1610
    assert got["a"] == 200 and got["c"] == 20 and got["d"] == 0
    assert got["b"] == pytest.approx(2415 - 200 - 20 - 1000) and got[None] == 1000
    assert sum(got.values()) == pytest.approx(2415)


def test_mix_repeats_what_the_plan_says(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(["a", "b", "c", None]), k) for k in range(400)] + [(7, None, "a", 1), (7, None, "a", 1), (None, "x y", "b", 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(5)
    plan = mixing.fair_queue(d).collect()
    assert len(plan) == len(rows) and all(r.taken == r["size"] * r.copies and r.copies in (0, 1, 2) for r in plan)
    taken, target = collections.Counter(), {}
    for r in plan:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 20 for s, t in target.items())
    copies, planned = collections.Counter(r.doc_id for r in mixing.mix(d).collect()), collections.Counter()
    for r in plan:
        planned[r.id] += r.copies
    assert copies == +planned
    assert mixing.mix(d).columns == d.columns
    again = {(r.id, r.virtual_finish) for r in mixing.fair_queue(d.repartition(2)).collect()}
    assert again == {(r.id, r.virtual_finish) for r in plan}
    assert mixing.fair_queue(d.limit(0)).count() == 0 and mixing.mix(d.limit(0)).count() == 0


def test_mix_of_rows_without_ids_and_of_repeats(spark):
    """Equal rows lie across the cuts of both sources, and clashing names do no harm."""
    rows = [(None, "ten words " * 5, "a", k) for k in range(100)] + [(None, f"other {k} words", "a", k) for k in range(100)] + [(5, "same row here", "b", 1)] * 400 + [(k, "w " * 30, "c", k) for k in range(30)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, part int").repartition(7).withColumnsRenamed({"part": "hash"}).selectExpr("*", "1 AS row", "2 AS times")
    plan = mixing.fair_queue(d).collect()
    got, planned = collections.Counter(r.source for r in mixing.mix(d).collect()), collections.Counter()
    words, target = collections.Counter(), {}
    for r in plan:
        planned[r.source] += r.copies
        words[r.source] += r.taken
        target[r.source] = r.target
    assert got == planned and len(plan) == len(rows)
    assert all(abs(words[s] - t) <= 30 for s, t in target.items()) and abs(sum(words.values()) - 1.5 * sum(r["size"] for r in plan)) <= 30
    assert mixing.mix(d).columns == d.columns


def test_the_order_of_virtual_times_is_cut_at_the_budget(spark):
    """Whoever is in comes before whoever is out, over all sources, and one document more would pass the budget."""
    rng = random.Random(9)
    rows = [(k, "w " * rng.choice([1, 3, 50, 700]), rng.choice("abc")) for k in range(900)]
    plan = mixing.fair_queue(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    entries = sorted(((r.upto + t * r.source_size - r.size / 2) / r.target, t < r.copies, r.size) for r in (_Queued(r) for r in plan) for t in range(2))
    words = 0
    for time, held, size in entries:
        words += size
        assert held == (words - size / 2 <= 1.5 * sum(r["size"] for r in plan))


class _Queued:
    def __init__(self, r):
        self.upto, self.size, self.source_size, self.target, self.copies = round(r.virtual_finish * r.target), r["size"], r.source_size, r.target, r.copies


def test_one_row_that_most_rows_repeat_spreads(spark):
    d = spark.createDataFrame([(None, None, None)] * 3000 + [(k, "a b", "s") for k in range(50)], "doc_id long, text string, source string").repartition(8)
    assert mixing.fair_queue(d).count() == 3050 and mixing.mix(d).count() == sum(r.copies for r in mixing.fair_queue(d).collect())


def test_mixing_runs_no_python(spark):
    plan = queries.QUERIES["op10_source_mixing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- pipeline


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    seen = corpus_pipeline.identify_language(spark, docs, SF)
    assert seen.columns == docs.columns and {r.doc_id for r in seen.collect()} == {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}

    kept = corpus_pipeline.drop_near_duplicates(spark, seen, SF)
    sets = {i: shingle_set(r.text, 5) for i, r in rows.items()}
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = components(ids, linked)
    stay = {i for i in ids if low[i] == i}
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(stay)

    clean = {r.doc_id: r for r in corpus_pipeline.mask_secrets(spark, kept, SF).collect()}
    assert set(clean) == stay and all(r.n_chars == len(r.text) for r in clean.values())
    secret = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}|AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}""", re.ASCII)
    for i, r in clean.items():
        assert not secret.search(r.text)
    # what the network adds to the rules is rare: clean texts stay as they are
    assert sum(r.text != rows[i].text and not secret.search(rows[i].text) for i, r in clean.items()) <= 0.01 * len(clean)

    out = corpus_pipeline.run(spark, SF).collect()
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out], 4096)
    sizes, per = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in clean.items()}, collections.Counter()
    for i, n in sizes.items():
        per[rows[i].source] += n
    copies = collections.Counter(r.doc_id for r in out if r.piece == 0)
    taken = sum(sizes[i] * c for i, c in copies.items())
    assert max(copies.values()) <= 2 and set(copies) <= stay
    assert abs(taken - 1.5 * sum(sizes.values())) <= sum(max(sizes[i] for i in sizes if rows[i].source == s) / 2 + 1 for s in per)
    from tests.llm.test_tokens_media import reference

    for r in out[:60]:
        ids_ = np.array([*reference([clean[r.doc_id].text])[0], 1], "<u4")
        assert zlib.crc32(ids_[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert hashlib is not None and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "secret_scan", "source_mixing", "packing"]


def test_every_stage_takes_odd_tables(spark, tmp_path):
    """Empty tables, nulls in every column, repeated rows, a text of megabytes, extra columns with names that the stages use."""
    words = [f"word{k} of the text" for k in range(60_000)]
    rows = [(1, None, None, None, None), (None, None, None, None, None), (2, "", "en", "s", 0), (3, " ".join(words), "en", "s", 5), (4, "the plain words of a text", "en", None, 3), (None, "the plain words of a text", "en", None, 3)] * 2
    names = ["id", "row", "hash", "copies", "count", "times", "source_size", "label", "part", "n_top", "key", "x.y"]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(3).selectExpr("*", *[f"'v' AS `{n}`" for n in names])
    for table in (d, d.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            got = out.collect()
            assert name == "packing" or out.columns == table.columns
            if table is not d:
                assert not got
            elif name == "language_id":
                assert sorted((r.doc_id or 0) for r in got) == [0, 0, 3, 3, 4, 4]
            elif name == "near_dedup":
                assert sorted((r.doc_id or 0) for r in got) == [0, 0, 0, 0, 1, 2, 3, 4]
            elif name == "secret_scan":
                assert len(got) == 12 and {r.text for r in got} == {r[1] for r in rows}
            elif name == "source_mixing":
                assert max(collections.Counter(r.doc_id for r in got).values()) <= 4 * 2
            else:
                assert len({(r.doc_id, r.piece) for r in got}) >= 5
                check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 4096)
    empty = str(tmp_path)
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_one_id_with_two_texts_is_settled_by_value(spark):
    rows = [(1, f"text number {k} has its own words {k * 7} {k * 11}", k) for k in range(20)] + [(2, "alone here", 0)]
    once = [sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(p), SF).collect())) for p in (1, 7)]
    assert once[0] == once[1] and len(once[0]) == 2


def test_pipeline_keeps_rows_without_ids_and_drops_repeats(spark):
    t = "one two three four five six seven eight nine ten eleven twelve"
    d = spark.createDataFrame([(1, t), (1, t), (2, t), (None, t), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.drop_near_duplicates(spark, d, SF).collect())
    assert got == [(0, t), (1, t), (3, "")]
