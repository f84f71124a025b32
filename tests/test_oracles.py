"""Every registered query against its SQL twin on the smallest tables."""

import math

import pytest

from outpulse.catalog import load_products

from conftest import SF

PRODUCTS = load_products()


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 6) + 0.0
    return str(value)


@pytest.mark.parametrize("name", list(PRODUCTS))
def test_matches_sql(spark, duck, name):
    p = PRODUCTS[name]
    df = p.frame(spark, SF)
    cols = sorted(df.columns)
    ours = sorted((tuple(canonical(r[c]) for c in cols) for r in df.collect()), key=repr)
    if p.sql is None:
        return
    cur = duck.execute(p.oracle())
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    theirs = sorted((tuple(canonical(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_shapes_are_registered_once():
    assert len(PRODUCTS) >= 100
    assert all(p.shape for p in PRODUCTS.values())
