"""Every registered log query against its DuckDB SQL."""

import datetime

import duckdb
import pytest

from streamchain import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: int(v) if isinstance(v, bool) else v.isoformat() if isinstance(v, datetime.datetime) else v
    return sorted(tuple(columns[i] + "=" + str(plain(r[i])) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_every_query_has_sql_but_the_reorder_fold():
    assert set(QUERIES) - set(SQL) == {"chain_reorder"}


def test_times_just_before_an_hour(spark, tmp_path):
    """DuckDB's epoch_ms rounds, so the last half of a millisecond counts for the next hour."""
    con = duckdb.connect()
    times = ["2024-01-01 00:59:59.9994", "2024-01-01 00:59:59.9995", "2024-01-01 00:59:59.999999", "2024-01-01 01:00:00", "1969-12-31 22:59:59.9995", "1969-12-31 22:59:59.9996", "1969-12-31 22:59:59.9994"]
    con.sql("create table events as select * from (values " + ", ".join(f"({i}, timestamp '{t}', 1, 'view', 1.0, '{{\"k\": 1}}')" for i, t in enumerate(times)) + ") t(event_id, ts, user_id, event_type, value, props)")
    con.sql(f"copy (select * replace (event_id::bigint as event_id, user_id::bigint as user_id, value::double as value) from events) to '{tmp_path}/events.parquet'")
    df, want = QUERIES["throughput"](spark, str(tmp_path)), con.sql(SQL["throughput"])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())
