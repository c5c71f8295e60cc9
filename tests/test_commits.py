"""Changes of tables when the driver is lost, and what an upsert reads."""

import os
from datetime import date

import pytest
from pyspark.sql import types as T

from pitchlake.sources import commits, tables

SCHEMA = T.StructType().add("id", T.LongType()).add("version", T.IntegerType()).add("day", T.DateType())
D1, D2, D3 = (date(2024, 4, d) for d in (1, 2, 3))


class Lost(Exception):
    pass


@pytest.fixture
def lost_at(monkeypatch):
    """Have the driver lost before its k-th change of the file system; 0: never."""
    whole = {name: getattr(commits.Files, name) for name in ("delete", "move", "write")}

    def lose(k):
        done = [0]

        def wrap(f):
            def call(*args):
                done[0] += 1
                if done[0] == k:
                    raise Lost
                return f(*args)

            return call

        for name, f in whole.items():
            monkeypatch.setattr(commits.Files, name, wrap(f) if k else f)

    return lose


def stored(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path, SCHEMA).collect())


def put(spark, path, *rows, **more):
    return tables.upsert(spark, path, spark.createDataFrame(rows, SCHEMA), ["id"], "day", ["version"], **more)


def test_every_step_of_a_change_can_be_the_last(spark, tmp_path, lost_at):
    before, after = [(1, 1, D1), (2, 1, D2), (3, 1, D3)], [(1, 1, D1), (2, 2, D2), (4, 1, D1)]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    path, seen, k = str(tmp_path / "t"), set(), 0
    while True:
        k += 1
        lost_at(0)
        tables.replace_partitions(frame(before), path, "day", ["id"], [D1, D2, D3], "id")
        lost_at(k)
        try:
            tables.replace_partitions(frame(after), path, "day", ["id"], [D3], "id")
        except Lost:
            lost_at(0)
            now = stored(spark, path)
            assert now in (sorted(before), sorted(after))
            seen.add(now == sorted(after))
            if k % 5 == 0:  # the next writer puts things in order first
                commits.recover(spark, path)
                assert stored(spark, path) == now
                put(spark, path, (9, 1, D3))
                assert stored(spark, path) == sorted([x for x in now if x[0] != 9] + [(9, 1, D3)])
            tables.replace_partitions(frame(after), path, "day", ["id"], [D3], "id")
            assert stored(spark, path) == sorted(after)
            continue
        lost_at(0)
        break
    assert k > 10 and seen == {True, False} and stored(spark, path) == sorted(after)
    assert os.listdir(tmp_path) == ["t"] and sorted(n for n in os.listdir(path) if n[0] != ".") == ["_keys", "day=2024-04-01", "day=2024-04-02"]


@pytest.mark.parametrize("k", [1, 3, 6, 9, 12])
def test_a_lost_upsert_is_run_again(spark, tmp_path, lost_at, k):
    path = str(tmp_path / "t")
    put(spark, path, (1, 1, D1), (2, 1, D1), (3, 1, D2), (6, 1, None))
    lost_at(k)
    with pytest.raises(Lost):
        put(spark, path, (2, 2, D2), (4, 1, D1), (6, 2, D2))
    lost_at(0)
    old, new = [(1, 1, D1), (2, 1, D1), (3, 1, D2), (6, 1, None)], [(1, 1, D1), (2, 2, D2), (3, 1, D2), (4, 1, D1), (6, 2, D2)]
    got = tables.read_table(spark, path, SCHEMA).collect()
    assert {tuple(r) for r in got} in (set(old), set(new)) and len(got) == len({r["id"] for r in got})
    put(spark, path, (2, 2, D2), (4, 1, D1), (6, 2, D2))
    assert {tuple(r) for r in tables.read_table(spark, path, SCHEMA).collect()} == set(new)


def test_an_upsert_asks_the_index_where_its_keys_may_be(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(3000).selectExpr("id * 7919 % 3000 AS id", "1 AS version", "date_add(DATE'2024-01-01', CAST(id % 60 AS INT)) AS day")
    tables.upsert(spark, path, rows, ["id"], "day", ["version"])
    assert len(os.listdir(f"{path}/_keys")) >= 60
    where = {r["id"]: r["day"] for r in rows.collect()}
    asked = spark.createDataFrame([(11, 2, D1), (12, 2, D1), (5000, 2, D1), (None, 2, D1)], SCHEMA)
    found = commits.may_hold(spark, path, asked, "id", "day")
    assert {where[11], where[12]} <= found and len(found) < 8
    scanned = []
    plain = tables._among
    monkeypatch.setattr(tables, "_among", lambda by, values: scanned.append(set(values)) or plain(by, values))
    assert put(spark, path, (11, 2, D1), (5000, 2, D1)) == {"inserted": 1, "updated": 1}
    assert all(len(s) < 8 for s in scanned)
    got = {r["id"]: (r["version"], r["day"]) for r in tables.read_table(spark, path, SCHEMA).where("id in (11, 12, 5000)").collect()}
    assert got == {11: (2, D1), 12: (1, where[12]), 5000: (2, D1)}
    assert tables.read_table(spark, path, SCHEMA).count() == 3001


def test_partitions_without_an_index_are_always_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 1, D1), (2, 1, None)], SCHEMA).write.partitionBy("day").parquet(path)
    asked = spark.createDataFrame([(7, 1, D3)], SCHEMA)
    assert commits.may_hold(spark, path, asked, "id", "day") == {D1, None}
    assert put(spark, path, (1, 2, D3), (2, 2, D3)) == {"inserted": 0, "updated": 2}
    assert stored(spark, path) == [(1, 2, D3), (2, 2, D3)]
    monkeypatch.setattr(commits, "LOOKED_UP", 0)
    assert commits.may_hold(spark, path, asked, "id", "day") is None
    assert put(spark, path, (1, 3, D2)) == {"inserted": 0, "updated": 1} and stored(spark, path) == [(1, 3, D2), (2, 2, D3)]
    put(spark, path, (2, 3, D3), moves=False)
    assert os.listdir(f"{path}/_keys") == ["day=2024-04-02"]


def test_monthly_compaction(spark, tmp_path):
    df = spark.createDataFrame([(g, g, date(2024, 3, 1 + g % 4)) for g in range(40)], "game_pk long, n int, game_date date")
    for part in df.randomSplit([1.0, 1.0, 1.0], 1):
        part.write.mode("append").partitionBy("game_date").parquet(str(tmp_path / "pitches"))
    assert tables.compact_last_month(spark, str(tmp_path), {"pitches": df.schema}, date(2024, 4, 15)) == {"pitches": 40}
    assert tables.compact_last_month(spark, str(tmp_path), {"pitches": df.schema}, date(2024, 5, 15)) == {"pitches": 0}
    assert tables.read_table(spark, str(tmp_path / "pitches"), df.schema).count() == 40
