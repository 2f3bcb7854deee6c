"""Shapes that scale: no Python where none is allowed, no unbounded broadcast, deterministic results under repartitioning."""

import pytest

from assay.llm import langid, minhash, mixing, packing, secrets, textkit
from assay.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("job", ["minhash", "mix", "spans", "language"])
def test_results_do_not_depend_on_partitions(spark, docs, job):
    def run(d):
        if job == "minhash":
            return minhash.near_duplicates(d, width=2).select("id", "component_id", "n_shingles")
        if job == "mix":
            return mixing.fair_queue(d).select("id", "taken", "virtual_finish")
        if job == "spans":
            return secrets.scan(d, secrets.fit(d)).select("id", "spans")
        return langid.identify(d, langid.fit(d)).select("id", "lang_pred")

    a, b = (sorted(map(tuple, run(docs.repartition(n)).collect())) for n in (1, 9))
    assert a == b


def test_repeated_rows_keep_their_rows(spark, docs):
    twice = docs.limit(30).unionByName(docs.limit(30))
    assert packing.pack_documents(twice, vocabulary(), keep_ids=False).where("piece = 0").count() == 60
    assert minhash.near_duplicates(twice).count() == 60


def test_slices_cover_everything():
    for lengths in ([], [5], [10**7], [1] * 100, [400_000] * 7, [0, 0, 3_000_000, 0]):
        got = [k for lo, hi in textkit.slices(lengths) for k in range(lo, hi)]
        assert got == list(range(len(lengths)))
