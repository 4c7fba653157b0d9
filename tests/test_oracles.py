"""Every query with SQL gives the rows that DuckDB gives."""

import math

import pytest

from threadmill.plans import registry


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return x


def same_rows(df, con, sql):
    names = sorted(df.columns)
    found = con.execute(sql)
    given = [c[0] for c in found.description]
    assert sorted(given) == names
    at = [given.index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)
    got = sorted((tuple(plain(x) for x in r) for r in df.select(*names).collect()), key=str)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, sf, duck, name):
    same_rows(registry.QUERIES[name](spark, sf), duck, registry.ORACLES[name])
