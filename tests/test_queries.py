"""Every registered query of the grid engine against its SQL over the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from cellstrata import queries, queries_laws, queries_store  # noqa: F401 (register their queries)

TABLES = Path("/root/testdata/sf0.001")


def plain(value):
    """A value in a form that both engines share; floats to nine digits."""
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int | float) or hasattr(value, "is_finite"):
        return "nan" if math.isnan(value) else f"{float(value):.9g}"
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, dict):
        value = list(value.values())
    return [plain(v) for v in value] if isinstance(value, list | tuple) else str(value)


@pytest.fixture(scope="module")
def views():
    if not TABLES.is_dir():
        pytest.skip("no tables")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in TABLES.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, views, name):
    found = queries.QUERIES[name](spark, str(TABLES))
    wanted = views.execute(queries.ORACLE_SQL[name])
    columns = sorted(d[0] for d in wanted.description)
    assert sorted(found.columns) == columns
    places = [[d[0] for d in wanted.description].index(c) for c in columns]
    rows = sorted(str([plain(v) for v in r]) for r in found.select(*columns).collect())
    assert rows == sorted(str([plain(r[k]) for k in places]) for r in wanted.fetchall())
