"""Every query with an oracle gives the oracle's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from strandline.plans import catalog

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return "null" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    assert got
    if name in catalog.ORACLE:
        result = duck.execute(catalog.ORACLE[name])
        names = [x[0] for x in result.description]
        assert sorted(names) == cols
        assert got == sorted(tuple(shown(r[names.index(c)]) for c in cols) for r in result.fetchall())
