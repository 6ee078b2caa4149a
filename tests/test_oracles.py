"""Every query of the engine against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from colophon.plans import registry
from colophon.sources.tables import TABLES

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        p = f"{small}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio"):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_same_rows_as_sql(spark, con, small, name):
    df = registry.queries()[name](spark, small)
    cols = sorted(df.columns)
    got = sorted([plain(v) for v in r] for r in df.select(*[f"`{c}`" for c in cols]).collect())
    assert name in SQL, "every query of the engine has SQL"
    found = con.execute(SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted([plain(r[i]) for i in at] for r in found.fetchall())
