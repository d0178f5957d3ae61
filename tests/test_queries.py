import math
import os

import duckdb
import numpy as np
import pytest

from textloom.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


def rows(df):
    def plain(v):
        if isinstance(v, (list, tuple, np.ndarray)):
            return tuple(map(plain, v))
        v = v.item() if hasattr(v, "item") else v
        return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    if name in registry.ORACLE:
        want = db.execute(registry.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_sql_belongs_to_queries():
    assert set(registry.ORACLE) <= set(registry.QUERIES) and registry.FLAGSHIP in registry.QUERIES
