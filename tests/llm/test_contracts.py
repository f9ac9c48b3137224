"""Every registered query of the package against its SQL, or against brute force on small input."""

import pytest

from tidemark.llm.queries import ORACLES, QUERIES


def rows(columns, found):
    return sorted((tuple(str(r[c]) for c in columns) for r in found))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, sf, name):
    got = QUERIES[name](spark, sf)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    want = [dict(zip(columns, r, strict=True)) for r in want.fetchall()]
    assert sorted(columns) == sorted(got.columns)
    assert rows(sorted(columns), [r.asDict() for r in got.collect()]) == rows(
        sorted(columns), want
    )


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
