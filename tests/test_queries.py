"""Every registered query of the library against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from assay.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    d = registry.QUERIES[name](spark, SF)
    cols = sorted(d.columns)
    rows = sorted((tuple(map(norm, r)) for r in d.select(*cols).collect()), key=repr)
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    r = con.sql(registry.ORACLE_SQL[name])
    at = [r.columns.index(c) for c in cols]
    assert cols == sorted(r.columns)
    assert rows == sorted((tuple(norm(x[k]) for k in at) for x in r.fetchall()), key=repr)


def test_every_sql_has_its_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
