"""Approximate neighbours, periodic runs and collocations against brute force, and their odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import neighbours, phrases, queries, runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- approximate nearest neighbours


def brute(rows, asked, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            usable.setdefault(i, []).append(np.array(v, float))
    out = {}
    for q in usable:
        if asked(q):
            best = {}
            for a in usable[q]:
                for i, bs in usable.items():
                    for b in bs:
                        if i != q and len(a) == len(b):
                            x, y = a / np.abs(a).max(), b / np.abs(b).max()
                            best[i] = max(best.get(i, -2), float((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum())))
            out[q] = sorted(best.items(), key=lambda p: (-round(p[1], 12), p[0]))[:k]
    return out


def vectors_of(seed, n, d=8, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, d)) * 2
    return [(int(k), (centres[rng.integers(groups)] + rng.standard_normal(d)).tolist()) for k in range(n)]


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_one_part_is_exact_with_odd_rows(spark):
    rows = vectors_of(1, 120)
    rows += [(200, rows[5][1]), (201, rows[5][1]), (202, rows[5][1]), (201, rows[5][1]), (5, rows[7][1])]  # copies, a repeated row, a repeated id
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] + [0.0] * 6), (304, [float("nan")] * 8), (305, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    rows += [(400, [1e-200] * 8), (401, [2e-200] * 8), (402, [1e200] * 8), (403, [3.0, 4.0]), (404, [3.0, 5.0]), (405, [1.0] * 3), (406, [5e-324] + [0.0] * 7)]
    d = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, part string, asks int").repartition(5)
    got, want = answers(neighbours.nearest_neighbours(d, F.col("vec_id") % 5 == 0)), brute(rows, lambda q: q % 5 == 0, 5)
    want = {q: w for q, w in want.items() if w}
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


@pytest.mark.parametrize("groups", [1, 12])
def test_learned_parts_find_most_neighbours(spark, groups):
    rows = vectors_of(2, 3000, 16, groups)
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    rows = [(r.vec_id, r.embedding) for r in d.collect()]
    index = neighbours.build_index(d, part_rows=200, sample=1500, checked=100)
    assert index.routers[16].parts == 16 and index.recall[16] >= 0.95 and index.rows.count() == 3000
    assert index.probes[16] < 16
    got = answers(neighbours.search_index(index, index.rows.where("id % 20 = 0")))
    x = np.array([v for _, v in sorted(rows)], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    true = {q: set(np.argsort(-s[q])[:5].tolist()) for q in range(0, 3000, 20)}
    assert got.keys() == true.keys() and all(len(g) == 5 for g in got.values())
    assert sum(len({i for i, _ in got[q]} & true[q]) for q in true) / (5 * len(true)) >= 0.9


def test_half_of_all_rows_equal(spark):
    rows = vectors_of(3, 600) + [(k, [1.0] * 8) for k in range(600, 1200)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(neighbours.nearest_neighbours(d, F.col("vec_id") % 50 == 0, part_rows=100, sample=600))
    assert [i for i, _ in got[650]] == [600, 601, 602, 603, 604] and [i for i, _ in got[600]] == [601, 602, 603, 604, 605]


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(0)
    x = np.repeat(np.eye(4), 50, axis=0) + 0.05 * rng.standard_normal((200, 4))
    x = x[rng.permutation(200)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = neighbours.graph(x, np.arange(200), 8)
    part = neighbours.balanced_parts(near, 4)
    assert np.bincount(part).tolist() == [50] * 4
    assert (part[near] == part[:, None]).mean() > 0.9
    assert sorted(np.bincount(neighbours.balanced_parts(near[:, :1] * 0, 8)).tolist()) == [25] * 8


def test_no_vectors_and_no_queries(spark):
    d = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest_neighbours(d, F.lit(True)).count() == 0
    d = spark.createDataFrame(vectors_of(4, 10), "vec_id long, embedding array<double>")
    assert neighbours.nearest_neighbours(d, F.col("vec_id") < 0).count() == 0
    assert len(answers(neighbours.nearest_neighbours(d.limit(3), F.lit(True)))[0]) == 2


# --- periodic runs


def brute_runs(w, least=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repetitive(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(rng.choice([1, 3, 6])):
        some = [rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 3, 5, 17, 40, 90]))]
        whole = some * rng.choice([1, 2, 4, 5, 9]) + some[: rng.randrange(len(some))]
        if rng.random() < 0.3:
            whole = whole * 4 + whole[:3]
        if rng.random() < 0.3:
            whole[rng.randrange(len(whole))] = "z"
        out += whole + [rng.choice(["x", "y", "the", "a"]) for _ in range(rng.choice([0, 1, 7]))]
    return out


@pytest.mark.parametrize("seed", range(40))
def test_runs_against_brute_force(seed):
    words = [repetitive(seed * 100 + k) for k in range(6)]
    texts = [rng_join(w, seed).encode() for w in words]
    found, n, kept = runs.find_runs(texts)
    for k, w in enumerate(words):
        assert found[k] == brute_runs(w) and n[k] == len(w)
        assert kept[k].decode() == brute_collapsed(w, brute_runs(w))


def rng_join(words, seed):
    return random.Random(seed).choice([" ", "\n", "  \t", "\r\n"]).join(words)


@pytest.mark.parametrize("least,times", [(6, 4), (3, 3), (10, 5)])
def test_other_thresholds(least, times):
    for seed in range(60):
        w = repetitive(seed)
        assert runs.find_runs([" ".join(w).encode()], least, times)[0][0] == brute_runs(w, least, times)


def test_long_runs_take_little_work():
    rng = random.Random(0)
    once = [str(rng.random()) for _ in range(50_000)]
    same, long, nested = ["a"] * 300_000, once * 4 + once[:7], (["a"] * 100 + ["b"]) * 2000
    found, _, kept = runs.find_runs([" ".join(x).encode() for x in (same, long, nested)])
    assert found[0] == [(0, 300_000, 1)] and found[1] == [(0, 200_007, 50_000)] and kept[1].decode().split() == once
    assert (0, 202_000, 101) in found[2] and len(found[2]) == 2001


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "A a A a A a A a"), (5, "é  é  é  é  é  é "), (6, "a " * 5), (7, "x" * 200_000)]
    d = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, runs int")
    got = {(r.id, r.n_words): r for r in runs.periodic_runs(d).collect()}
    assert runs.periodic_runs(d).count() == len(rows)
    assert got[1, 0].collapsed == "" and got[2, 0].runs == [] and got[3, 0].runs == []
    assert [tuple(x) for x in got[4, 6].runs] == [(0, 6, 1)] and got[4, 6].collapsed == "a"
    assert [tuple(x) for x in got[None, 8].runs] == [(0, 8, 2)] and got[None, 8].collapsed == "A a"
    assert got[5, 6].collapsed == "é " and got[6, 5].runs == [] and got[7, 1].collapsed == "x" * 200_000
    assert runs.periodic_runs(d.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(d, times=2)


def test_op12_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w, h = WORD.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            a, n = h // 10 % len(w), len(w)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        g = got[r.doc_id]
        assert g.n_runs == len(found) and (g.start, g.length, g.period) == (best or (None,) * 3)
        assert g.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert g.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert g.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, found).encode()).hexdigest()


# --- phrase collocations


def brute_counts(rows, least):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f.setdefault(lang, Counter()).update(" ".join(w[i : i + m]) for i in range(len(w) - m + 1))
    return {lang: {p: a for p, a in c.items() if a >= least} for lang, c in f.items()}, n


def brute_collocations(rows, least, absorb, top):
    f, n = brute_counts(rows, least)
    out = []
    for lang, counts in f.items():
        best = []
        for p, a in counts.items():
            w = p.split(" ")
            if len(w) == 1 or any(len(x.split(" ")) > len(w) and f" {p} " in f" {x} " and 100 * b >= absorb * a for x, b in counts.items()):
                continue
            cuts = [(counts[" ".join(w[:k])], counts[" ".join(w[k:])], k) for k in range(1, len(w))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for x, y, k in cuts)
            best.append((-score, -a, p.encode(), p, left, right))
        out += [(lang, r + 1, p, -a, x, y, n[lang], -s) for r, (s, a, _, p, x, y) in enumerate(sorted(best)[:top])]
    return sorted(out)


def chatter(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)] + ["É", "É x", "don't", "ß", "\x1f"]
    fixed = ["Alpha beta Gamma", "in the middle of", "one two", "é è"]
    out = []
    for _ in range(n):
        w = [rng.choice(fixed) if rng.random() < 0.25 else rng.choice(vocab[: rng.choice([4, 12, 35])]) for _ in range(rng.choice([0, 3, 40]))]
        out.append((rng.choice(["en", "en", "fr", None]), "".join(x + rng.choice([" ", "  ", "\t ", ", ", ".\n", "!"] if rng.random() < 0.3 else [" "]) for x in w)))
    return out + [("en", None), ("xx", ""), ("xx", "."), ("en", "same words " * 400)]


@pytest.mark.parametrize("sample", [1, 3, 1000])
@pytest.mark.parametrize("least,absorb,top", [(5, 80, 2000), (12, 60, 7)])
def test_collocations_against_brute_force(spark, sample, least, absorb, top):
    rows = chatter(least)
    d = spark.createDataFrame([(t, lang, 1) for lang, t in rows], "text string, lang string, a int").repartition(3)
    got = phrases.collocations(d, least=least, absorb=absorb, top=top, sample=sample)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, least, absorb, top)


@pytest.mark.parametrize("sample", [2, 40])
def test_counts_are_exact_whatever_the_sample(spark, sample, monkeypatch):
    monkeypatch.setattr(phrases, "_MOST_BITS", 1 << 16)
    rows = chatter(9)
    d = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    found, words = phrases.frequent_phrases(d, least=4, sample=sample)
    f, n = brute_counts(rows, 4)
    assert {(r.lang, r.phrase): r.a for r in found.collect()} == {(lang, p): a for lang, c in f.items() for p, a in c.items()}
    assert {r.lang: r.n for r in words.collect() if r.n} == {lang: k for lang, k in n.items() if k}


def test_collocations_of_nothing(spark):
    d = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(d).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, "en"), ("", None)], "text string, lang string")).count() == 0
