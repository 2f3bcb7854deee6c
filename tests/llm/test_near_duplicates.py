"""Near-duplicate operators against brute force, and their edge cases."""

import itertools
import random
import re

import numpy as np
import pytest

from assay.llm import minhash, textkit, vectors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def components(ids, linked):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def texts(seed=0):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["É", "ß", "ﬁ"]
    out = []
    for _ in range(14):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 60, 300]))]
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 12])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(rng.choice([" ", "\n", "\t ", "  "]).join(copy))
    return out + [None, "", " \n", "One", "one", "one two", "ONE\x0btwo", "x" * 50_000, "x" * 50_000, "a b c", "a b c"]


@pytest.mark.parametrize("width,parts", [(2, 1), (2, 5), (5, 3)])
def test_minhash_against_brute_force(spark, width, parts):
    rows = [(k, t, None) for k, t in enumerate(texts())]
    random.Random(1).shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(parts)
    got = {r.id: r for r in minhash.near_duplicates(d, width=width).collect()}
    sets = {k: shingle_set(t, width) for k, t, _ in rows}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = components(sets, linked)
    assert len(got) == len(rows)
    for k in sets:
        assert (got[k].n_shingles, got[k].component_id, got[k].kept) == (len(sets[k]), low[k], low[k] == k)


def test_family_that_a_first_pass_leaves_in_parts(spark):
    """A chain of texts, each close to the next alone: all links count, whoever leads a bucket."""
    words = [f"v{k}" for k in range(400)]
    rows = [(100 - k, " ".join(words[k * 12 : k * 12 + 150])) for k in range(12)]
    sets = {i: shingle_set(t, 2) for i, t in rows}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(linked) == 11
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in minhash.near_duplicates(d, width=2).collect()}
    assert got == components(sets, linked)


def test_tiles_agree_with_whole_families(spark, monkeypatch):
    monkeypatch.setattr(minhash, "_TILE", 3)
    test_minhash_against_brute_force(spark, 2, 2)


@pytest.mark.parametrize("tile", [256, 7])
def test_near_copies_that_longer_documents_with_smaller_ids_embed(spark, monkeypatch, tile):
    """Every common bucket is led by a document far longer than the two copies in it."""
    monkeypatch.setattr(minhash, "_TILE", tile)
    rng = random.Random(3)
    word = lambda: f"u{rng.randrange(10**6)}"
    a = [word() for _ in range(150)]
    b = list(a)
    for k in (20, 45, 70, 95, 120, 140, 10):
        b[k] = word()
    rows = [(k, " ".join((a if k % 2 else b) + [word() for _ in range(60)])) for k in range(200)] + [(1000, " ".join(a)), (1001, " ".join(b))]
    sets = {i: shingle_set(t, 2) for i, t in rows}
    linked = [(x, y) for x, y in itertools.combinations(sets, 2) if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
    assert linked == [(1000, 1001)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in minhash.near_duplicates(d, width=2).collect()}
    assert got == components(sets, linked)


@pytest.mark.parametrize("hot", [2, 10**6])
def test_one_bucket_with_most_rows(spark, monkeypatch, hot):
    """Distinct copies of one text, all in one bucket of nearly every table, beside others; by either way of finding leads."""
    monkeypatch.setattr(minhash, "_HOT", hot)
    rng = random.Random(8)
    base = [f"h{k}" for k in range(300)]
    rows = [(k, " ".join([*base[:k], f"own{k}", *base[k:]]) if k < 300 else " ".join(rng.choice(base) for _ in range(40))) for k in range(400)]
    got = {r.id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), width=2).collect()}
    assert {got[k] for k in range(300)} == {0} and all(got[k] == k for k in range(300, 400))


def test_minhash_edges(spark):
    empty = minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0
    t = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    d = spark.createDataFrame([(None, t), (1, t), (1, t), (2, t), (None, None)], "doc_id long, text string")
    got = sorted(map(str, minhash.near_duplicates(d, width=2).select("id", "component_id", "kept").collect()))
    assert len(got) == 5 and sum("kept=True" in g for g in got) == 4 and sum("id=2, component_id=1, kept=False" in g for g in got) == 1


def test_shingle_hashes_tell_sets_apart():
    a, b, c = textkit.shingles(["one two three", "ONE  two\nthree", "one two"], 2)
    assert (a == b).all() and len(a) == 2 and len(c) == 1 and c[0] in a
    assert len(textkit.shingles(["one two"], 5)[0]) == 1


def brute_vectors(rows, least=0.93):
    usable = {}
    for n, (k, v, label) in enumerate(rows):
        x = None if v is None or any(e is None for e in v) else np.array(v, float)
        if x is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            usable[n] = x / np.sqrt((x * x).sum())
    linked = [(a, b) for a, b in itertools.combinations(usable, 2) if rows[a][2] == rows[b][2] and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= least]
    return usable, linked


@pytest.mark.parametrize("tile", [4, 1024])
def test_vectors_against_brute_force(spark, tile):
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for label in (0, 0, 1, None):
        centre = rng.normal(size=16)
        for _ in range(25):
            rows.append((n, (centre + rng.normal(size=16) * rng.choice([0.1, 0.3, 1.0])).astype(np.float32).tolist(), label))
            n += 1
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 0), (n + 2, [2 * x for x in rows[0][1]], 0), (n + 3, rows[0][1], 1)]
    rows += [(n + 4, None, 0), (n + 5, [0.0] * 16, 0), (n + 6, [float("nan")] * 16, 0), (n + 7, [float("inf")] * 16, 0), (n + 8, [1.0, None], 0), (n + 9, [], 0), (n + 10, rows[0][1][:8], 0)]
    d = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links string").repartition(3)
    got = {r.id: r for r in vectors.near_duplicate_vectors(d, tile=tile).collect()}
    _, linked = brute_vectors(rows)
    low = components(range(len(rows)), linked)
    degree = {k: 0 for k in range(len(rows))}
    for a, b in linked:
        degree[a] += 1
        degree[b] += 1
    assert len(got) == len(rows)
    for k in range(len(rows)):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (degree[k], low[k], low[k] == k), k


def test_vectors_in_many_stripes_and_lengths(spark):
    """One label with most rows over several stripes, in doubles, and more lengths than get axes."""
    rng = np.random.default_rng(5)
    rows, centres = [], rng.normal(size=(6, 8))
    for k in range(260):
        rows.append((k, (centres[k % 6] + rng.normal(size=8) * rng.choice([0.05, 0.2, 0.6])).tolist(), "hot"))
    for k in range(260, 320):
        rows.append((k, rng.normal(size=k % 12 + 1).round(0).tolist(), "few"))
    got = {r.id: r for r in vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(5), tile=4).collect()}
    _, linked = brute_vectors(rows)
    low = components(range(len(rows)), linked)
    degree = np.bincount(np.array(linked).ravel(), minlength=len(rows))
    assert all((got[k].n_links, got[k].component_id) == (degree[k], low[k]) for k in range(len(rows)))


def test_vectors_edges(spark):
    assert vectors.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    d = spark.createDataFrame([(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted((r.id or -1, r.n_links, r.component_id or -1) for r in vectors.near_duplicate_vectors(d).collect())
    assert got == [(-1, 0, -1), (3, 1, 3), (3, 1, 3)]


@pytest.mark.parametrize("tile", [2, 1024])
def test_vectors_of_any_magnitude(spark, tile):
    """Components whose squares vanish or overflow, and subnormal ones, link by their cosine like any other."""
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=2).tolist(), "a") for k in range(20)]
    rows += [(20, [1e-200, 2e-200], "b"), (21, [1e200, 2e200], "b"), (22, [2e200, 4e200], "b"), (23, [1.7e308, 1.7e308], "b"), (24, [3e-310, 6e-310], "b"), (25, [-1e200, -2e200], "b"), (26, [5e-324, 0.0], "b"), (27, [1.0, 0.0], "b")]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    got = {r.id: r for r in vectors.near_duplicate_vectors(d, tile=tile).collect()}
    plain = [(k, (np.array(v) / np.abs(v).max()).tolist(), label) for k, v, label in rows]
    _, linked = brute_vectors(plain)
    low = components(range(len(rows)), linked)
    degree = np.bincount(np.array(linked).ravel(), minlength=len(rows))
    assert low[24] == 20 and low[22] == 20 and low[27] == 26
    assert all((got[k].n_links, got[k].component_id) == (degree[k], low[k]) for k in range(len(rows)))


def test_vectors_at_the_threshold_are_judged_alike(spark):
    """Pairs whose cosine is the threshold itself, but for rounding, link in a tile as across stripes."""
    rows = [(k, [1.0, 0.0], "x") for k in range(3)] + [(k, [0.93 * (k + 1), float(np.sqrt(1 - 0.93**2)) * (k + 1)], "x") for k in range(3, 40)]
    one, many = (
        sorted((r.id, r.n_links, r.component_id) for r in vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"), tile=tile).collect()) for tile in (1024, 2)
    )
    assert one == many
