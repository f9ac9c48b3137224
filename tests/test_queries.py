"""Every registered query against its SQL twin."""

import math
from decimal import Decimal

import pytest

from tidemark.catalogue import ORACLES, QUERIES

SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return str(v.normalize())
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = [tuple(map(_plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert rows, "a registered query must return rows"
    if name not in ORACLES:
        return
    result = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in result.description}
    order = [d[0] for d in result.description]
    assert sorted(order) == columns
    assert {c: SPARK_TO_SQL[t] for c, t in df.dtypes} == described
    wanted = [tuple(_plain(r[order.index(c)]) for c in columns) for r in result.fetchall()]
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)


def test_every_query_has_a_sql_twin():
    assert set(QUERIES) == set(ORACLES)
