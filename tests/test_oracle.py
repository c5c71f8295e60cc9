"""Every registered query with an oracle, against DuckDB."""

import math
import os
from collections import Counter

import duckdb
import pytest

from pitchlake.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return repr(float(v)) if isinstance(v, float) else str(v)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    found = duck.sql(registry.ORACLE[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert bag(df.columns, df.collect()) == bag(found.columns, found.fetchall())


@pytest.mark.parametrize(("name", "keys"), [
    ("standings", ("season", "-win_pct", "-run_diff")), ("daily_leaders", ("-strikeouts", "-total_pitches")), ("season_batting", ("-batting_avg",)),
    ("season_batting_all", ("season", "-batting_avg")), ("pitcher_arsenal", ("-count",)), ("coverage_first_missing", ("game_pk",)),
])
def test_order(spark, name, keys):
    rows = [tuple(-r[k[1:]] if k[0] == "-" else r[k] for k in keys) for r in registry.QUERIES[name](spark, SF.replace("0.001", "0.01")).collect()]
    assert rows and rows == sorted(rows)


def test_entry_imports_and_registers(spark):
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
