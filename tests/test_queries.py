import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from tidewell.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else round(float(v), 6) + 0.0
    return v


@pytest.fixture(scope="module")
def duck(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_small}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, sf_small, name):
    df = registry.queries()[name](spark, sf_small)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    r = duck.execute(registry.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(plain(x[i]) for i in at)) for x in r.fetchall())


def test_contiguous_times_of_odd_clips(spark, tmp_path):
    """Clips without duration, day or number; sums that end in a half and are the same in any order."""
    day = "timestamp '2001-04-23'"
    clips = [(1, 1500, day), (2, None, day), (3, 1000, day), (None, 4125, day), (5, 875, day), (6, 2500, "null"), (7, 500, "null"), (8, None, "timestamp '2001-04-24'"), (9, 500, "timestamp '2001-04-24'")]
    values = ", ".join(f"({clip or 'null'}::bigint, {price or 'null'}::double, {at}::timestamp)" for clip, price, at in clips)
    c = duckdb.connect()
    c.execute(f"create table orders as select * from (values {values}) t(o_orderkey, o_totalprice, o_orderdate)")
    c.execute(f"copy orders to '{tmp_path}/orders.parquet' (format parquet)")
    df = registry.queries()["contiguous_times"](spark, str(tmp_path))
    got = sorted((repr(tuple(r)) for r in df.select("clip", "start_s").collect()))
    want = sorted(repr(r) for r in c.execute(f"select clip, start_s from ({registry.oracle_sql()['contiguous_times']})").fetchall())
    assert len(want) == len(clips)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf_small, name):
    assert registry.queries()[name](spark, sf_small).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
