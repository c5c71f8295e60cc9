"""Generated feeds: parsing, tables and the live stream."""

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.sources import feeds, tables
from pitchlake.streaming import live


def event(k, pitch=True, **more):
    e = {"isPitch": pitch, "startTime": f"2024-04-01T18:00:{k:02d}.000Z", "details": {"call": {"code": "S", "description": "Swing"}, "isStrike": True}}
    if pitch:
        e |= {"count": {"balls": 0, "strikes": k % 3, "outs": 1}, "pitchData": {"startSpeed": 90.0 + k, "coordinates": {"pX": 0.1, "pZ": 2.0}}}
    return e | more


def play(i, n, complete=True, score=1):
    p = {"about": {"atBatIndex": i, "inning": 1, "isTopInning": i % 2 == 0, "isComplete": complete, "startTime": "2024-04-01T18:00:00Z", "endTime": "2024-04-01T18:05:00Z"},
         "matchup": {"pitcher": {"id": 10, "fullName": "P"}, "batter": {"id": 20 + i, "fullName": "B"}}, "result": {},
         "playEvents": [event(0, pitch=False), *(event(k) for k in range(n))]}
    if complete:
        p["result"] = {"event": "Single", "eventType": "single", "rbi": 1, "awayScore": score, "homeScore": 0}
    return p


def feed(pk, plays, status="Live"):
    return {"gamePk": pk, "gameData": {"status": {"abstractGameState": status}, "venue": {"id": 5, "name": ""}, "weather": {"condition": "Roof Closed", "temp": ""}},
            "liveData": {"linescore": {"teams": {"home": {"runs": 0}, "away": {"runs": 1}}}, "plays": {"allPlays": plays}}}


def frame(spark, *documents):
    return feeds.parse(spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in documents], "value string"))


def test_parse(spark):
    df = frame(spark, feed(1, [play(0, 3), play(1, 2, complete=False)]), "{broken", feed(2, []))
    good, bad = feeds.split_corrupt(df)
    assert bad.count() == 1 and good.count() == 2
    p = feeds.pitches(good).orderBy("at_bat_index", "pitch_number").collect()
    assert [(r["at_bat_index"], r["pitch_number"]) for r in p] == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)]
    assert p[0]["event_id"] == "1_0_1" and p[0]["half_inning"] == "top" and p[3]["half_inning"] == "bottom"
    assert p[0]["away_score"] == 1 and p[3]["away_score"] == 0 and p[0]["pitch_type"] is None and not p[0]["is_in_play"]
    ab = feeds.at_bats(good).orderBy("at_bat_index").collect()
    assert [(r["pitch_count"], r["outs_after"], r["event"], r["event_type"]) for r in ab] == [(3, 1, "Single", "single"), (2, 1, "Unknown", "unknown")]
    state = {r["game_pk"]: r for r in feeds.game_state(good).collect()}
    assert state[1]["first_pitch_time_utc"].second == 0 and state[2]["first_pitch_time_utc"] is None


def test_schedule_and_game_rows(spark):
    s = {"dates": [{"games": [{"gamePk": 1, "gameType": "R", "season": "2024", "gameDate": "2024-04-01T18:00:00Z", "status": {"abstractGameState": "Final", "detailedState": "Final"},
         "teams": {"away": {"team": {"id": 1, "name": "A"}, "score": 4}, "home": {"team": {"id": 2, "name": "H"}, "score": 3}}, "venue": {"name": "Park"}}]}]}
    df = feeds.schedule_games(feeds.parse(spark.createDataFrame([(json.dumps(s),), ('{"dates": []}',)], "value string"), schema=schemas.SCHEDULE))
    good, _ = feeds.split_corrupt(frame(spark, feed(1, [])))
    row = feeds.game_rows(df, feeds.game_state(good)).first()
    assert (row["away_score"], row["home_score"], row["venue_name"], row["home_team_won"]) == (1, 3, "Park", True)
    assert row["game_date"] == date(2024, 4, 1)


def test_feed_conditions(spark):
    from pitchlake.operators.weather import feed_conditions

    row = feed_conditions(frame(spark, feed(1, []))).first()
    assert row["mlb_temp_f"] is None and row["roof_closed"]


SCHEMA = "game_pk long, home_score int, version int, season int"


def test_upsert_keeps_other_rows_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "games")
    first = spark.createDataFrame([(1, 1, 1, 2023), (2, 2, 1, 2024), (3, 3, 1, 2024)], SCHEMA)
    assert tables.upsert(spark, path, first, ["game_pk"], "season", ["version"]) == {"inserted": 3, "updated": 0}
    change = spark.createDataFrame([(2, 9, 2, 2024), (4, 4, 1, 2025), (4, 5, 2, 2025)], SCHEMA)
    for expected in ({"inserted": 1, "updated": 1}, {"inserted": 0, "updated": 2}):
        assert tables.upsert(spark, path, change, ["game_pk"], "season", ["version"]) == expected
        got = {(r["game_pk"], r["home_score"]) for r in tables.read_table(spark, path, first.schema).collect()}
        assert got == {(1, 1), (2, 9), (3, 3), (4, 5)}
    moved = spark.createDataFrame([(1, 7, 3, 2025)], SCHEMA)
    tables.upsert(spark, path, moved, ["game_pk"], "season", ["version"])
    rows = tables.read_table(spark, path, first.schema).where("game_pk = 1").collect()
    assert [(r["home_score"], r["season"]) for r in rows] == [(7, 2025)]
    assert [d for d in os.listdir(tmp_path) if "staging" in d] == []


def test_upsert_into_the_null_partition_keeps_its_rows(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id long, version int, day date"
    rows = lambda *r: spark.createDataFrame(r, schema)
    stored = lambda: {(r["id"], r["version"], r["day"]) for r in tables.read_table(spark, path, rows((1, 1, None)).schema).collect()}
    put = lambda *r, **more: tables.upsert(spark, path, rows(*r), ["id"], "day", ["version"], **more)
    d = date(2024, 4, 1)
    assert put((1, 1, d), (2, 1, None), (3, 1, d)) == {"inserted": 3, "updated": 0}
    assert put((4, 1, None)) == {"inserted": 1, "updated": 0}
    assert stored() == {(1, 1, d), (2, 1, None), (3, 1, d), (4, 1, None)}
    assert put((2, 2, d), (4, 2, d)) == {"inserted": 0, "updated": 2}
    assert stored() == {(1, 1, d), (2, 2, d), (3, 1, d), (4, 2, d)} and not [x for x in os.listdir(path) if "HIVE" in x]
    assert put((5, 1, None), (1, 2, d), moves=False) == {"inserted": 1, "updated": 1}
    assert stored() == {(1, 2, d), (2, 2, d), (3, 1, d), (4, 2, d), (5, 1, None)}
    assert put() == {"inserted": 0, "updated": 0} and len(stored()) == 5


def test_old_versions_lose_and_equal_ones_give_way(spark, tmp_path):
    path = str(tmp_path / "t")
    for version, score, want in ((2, 5, 5), (1, 9, 5), (2, 7, 7)):
        tables.upsert(spark, path, spark.createDataFrame([(1, score, version, 2024)], SCHEMA), ["game_pk"], "season", ["version"])
        assert tables.read_table(spark, path, schemas.struct(SCHEMA)).first()["home_score"] == want


def test_files_are_sorted(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(2000).selectExpr("hash(id) AS k", "CAST(id % 3 AS INT) AS part").repartition(5)
    tables.replace_partitions(df, str(tmp_path / "t"), "part", ["k"])
    files = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.endswith(".parquet")]
    read = [pq.ParquetFile(f).read()["k"].to_pylist() for f in files]
    assert sum(map(len, read)) == 2000 and all(x == sorted(x) for x in read)


def test_missing_table_is_empty_and_typed(spark, tmp_path):
    df = tables.read_table(spark, str(tmp_path / "none"), schemas.struct(SCHEMA))
    assert df.count() == 0 and df.columns == ["game_pk", "home_score", "version", "season"]


def test_compaction_keeps_rows(spark, tmp_path):
    path, schema = str(tmp_path / "pitches"), "game_pk long, pitch_number int, game_date date"
    df = spark.createDataFrame([(g, n, date(2024, 4, 1 + g % 3)) for g in range(9) for n in range(4)], schema)
    for k in range(3):
        df.where(F.col("game_pk") % 3 == k).repartition(4).write.mode("append").partitionBy("game_date").parquet(path)
    before = sum(len(f) for _, _, f in os.walk(path))
    assert tables.compact_month(spark, path, df.schema, 2024, 4, ["game_pk", "pitch_number"]) == 36
    assert tables.read_table(spark, path, df.schema).count() == 36
    assert sum(len(f) for _, _, f in os.walk(path)) < before
    one = tables.read_table(spark, path, df.schema, game_pk=4, game_date="2024-04-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    some = tables.read_table(spark, path, df.schema, dates=("2024-04-01", "2024-04-02"))
    assert sorted(map(tuple, some.collect())) == sorted(tuple(r) for r in df.collect() if r["game_date"].day <= 2)
    assert one.count() == 4 and "PartitionFilters: [isnotnull(game_date" in plan and "PushedFilters: [IsNotNull(game_pk)" in plan


def test_patches(spark):
    games = spark.createDataFrame([(1, 0, 0, "Live", None), (2, 1, 1, "Live", None)], "game_pk long, away_score int, home_score int, status string, home_team_won boolean")
    new = spark.createDataFrame([(1, None, 4, "Final"), (9, 1, 1, "Final")], "game_pk long, away_score int, home_score int, status string")
    got = {r["game_pk"]: tuple(r)[1:] for r in tables.patch_scores(games, new).collect()}
    assert got == {1: (0, 4, "Final", True), 2: (1, 1, "Live", None)}


def test_export(spark, tmp_path):
    games = spark.createDataFrame([(1, date(2024, 4, 1), 2024)], "game_pk long, game_date date, season int")
    facts = spark.createDataFrame([(1, 0, 2), (1, 0, 1)], "game_pk long, at_bat_index int, pitch_number int")
    assert tables.export_games(spark, games, {"pitches": facts}, str(tmp_path)) == {"games": 1, "pitches": 2}


def test_exports_of_ranges_weeks_and_days(spark, tmp_path):
    days = {1: date(2024, 4, 1), 2: date(2024, 4, 8), 3: date(2024, 4, 9), 4: date(2024, 4, 8)}
    games = spark.createDataFrame([(g, d, 2024, "Live" if g == 4 else "Final") for g, d in days.items()], "game_pk long, game_date date, season int, status string")
    good, _ = feeds.split_corrupt(frame(spark, *(feed(g, [play(0, 3), play(1, 2)]) for g in days)))
    thrown, at_bats, out = feeds.pitches(good), feeds.at_bats(good), str(tmp_path)
    facts = {"pitches": thrown, "at_bats": at_bats}
    assert tables.export_range(spark, games, facts, out, date(2024, 4, 1), date(2024, 4, 8)) == {"games": 3, "pitches": 15, "at_bats": 6}
    assert {str(r[0]) for r in spark.read.parquet(f"{out}/at_bats").select("game_date").distinct().collect()} == {"2024-04-01", "2024-04-08"}
    for _ in range(2):
        assert tables.export_enriched(spark, thrown, games, out, date(2024, 4, 8)) == 10
    assert "leverage_bucket" in spark.read.parquet(f"{out}/enriched/pitches_2024-04-01_2024-04-08").columns
    assert tables.export_enriched(spark, thrown, games, out, date(2023, 1, 1)) == 0
    for _ in range(2):
        assert tables.update_daily_player_stats(spark, at_bats, games, out, date(2024, 4, 8)) == 2
    assert tables.update_daily_player_stats(spark, at_bats, games, out, date(2024, 4, 9)) == 2
    stats = spark.read.parquet(f"{out}/player_stats_daily")
    assert stats.count() == 4 and {(r["hits"], r["games"]) for r in stats.collect()} == {(1, 1)}


def test_metadata_and_conditions(spark):
    games = spark.createDataFrame([(1, "Final", None, None), (2, "Final", 7, None), (3, "Live", None, None)], "game_pk long, status string, venue_id long, first_pitch_time_utc timestamp_ntz")
    good, _ = feeds.split_corrupt(frame(spark, *(feed(g, [play(0, 1)]) for g in (1, 2, 3, 4))))
    got = {r["game_pk"]: r for r in tables.patch_metadata(games, feeds.game_state(good)).collect()}
    assert {g: r["venue_id"] for g, r in got.items()} == {1: 5, 2: 5, 3: None} and got[1]["first_pitch_time_utc"] and got[3]["first_pitch_time_utc"] is None
    weather = spark.createDataFrame([(1, True, None, "x"), (2, False, None, "x"), (3, True, False, "x")], "game_pk long, is_indoor boolean, roof_closed boolean, condition string")
    new = spark.createDataFrame([(2, True, None), (1, None, "Dome")], "game_pk long, roof_closed boolean, condition string")
    got = {r["game_pk"]: (r["roof_closed"], r["condition"]) for r in tables.patch_conditions(weather, new).collect()}
    assert got == {1: (True, "Dome"), 2: (True, "x"), 3: (False, "x")}


def test_venues_teams_and_first_pitch(spark):
    read = lambda schema, *docs: feeds.parse(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"), schema=schema)
    place = {"city": "C", "state": "State", "country": "X", "defaultCoordinates": {"latitude": 1.5, "longitude": -2.5}, "elevation": 30, "azimuthAngle": 45}
    venues = feeds.venue_rows(read(schemas.VENUE, {"id": 1, "name": "V", "location": place | {"stateAbbrev": "ST"}, "fieldInfo": {"roofType": "Open", "capacity": 9}}, {"id": 2, "location": place}))
    got = {r["venue_id"]: r for r in venues.collect()}
    assert (got[1]["state"], got[2]["state"], got[1]["azimuth_angle"], got[1]["roof_type"], got[2]["capacity"]) == ("ST", "State", 45.0, "Open", None)
    teams = feeds.team_rows(read(schemas.TEAM, {"id": 3, "name": "T", "league": {"name": "L"}}, {"id": 4, "venue": {"name": "V"}}))
    got = {r["team_id"]: tuple(r)[1:] for r in teams.collect()}
    assert got == {3: ("T", "", "L", "", None), 4: ("", "", "", "", "V")}
    first = play(0, 1)
    del first["playEvents"][0]["startTime"]
    later = feed(2, [])
    later["gameData"]["datetime"] = {"dateTime": "2024-05-01T20:10:00+02:00"}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        good, _ = feeds.split_corrupt(frame(spark, feed(1, [first]), later))
        got = {r["game_pk"]: str(r["first_pitch_time_utc"]) for r in feeds.game_state(good).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {1: "2024-04-01 18:00:00", 2: "2024-05-01 18:10:00"}


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(k, document):
        path = folder / f"{k}.json"
        path.write_text(document if isinstance(document, str) else json.dumps(document))
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))

    land.folder = str(folder)
    return land


def test_live_ingest_corrects_and_resumes(spark, tmp_path, landed):
    out, topics = str(tmp_path / "out"), str(tmp_path / "topics")
    run = lambda: live.run_live(spark, landed.folder, out, str(tmp_path / "cp"), live.file_topics(topics)).awaitTermination()
    landed(1, feed(1, [play(0, 2, complete=False)]))
    landed(2, "{broken")
    run()
    read = lambda t: spark.read.parquet(f"{out}/{t}")
    assert read("pitches").count() == 2 and {r["away_score"] for r in read("pitches").collect()} == {0}
    assert read("quarantine").count() == 1
    landed(3, feed(1, [play(0, 3)], status="Final"))
    landed(4, feed(1, [play(0, 3)], status="Final"))
    run()
    assert read("pitches").count() == 3 and {r["away_score"] for r in read("pitches").collect()} == {1}
    assert read("at_bats").count() == 1 and read("game_state").first()["status"] == "Final"
    assert spark.read.json(f"{topics}/pitches").count() == 5 and spark.read.json(f"{topics}/at_bats").count() == 1
    state = json.loads(spark.read.json(f"{topics}/game_state").first()["value"])
    assert (state["previous_state"], state["new_state"]) == ("Live", "Final")
    assert live.all_done(read("game_state"))
    landed(5, feed(1, [play(0, 3), play(1, 1, complete=False)], status="Final"))
    run()
    assert read("pitches").count() == 4 and spark.read.json(f"{topics}/pitches").count() == 6
    assert spark.read.json(f"{topics}/at_bats").count() == 1 and spark.read.json(f"{topics}/game_state").count() == 1


def test_a_batch_touches_its_own_games_only(spark, tmp_path, landed):
    out = str(tmp_path / "out")
    run = lambda: live.run_live(spark, landed.folder, out, str(tmp_path / "cp")).awaitTermination()
    landed(1, feed(1, [play(0, 2)]))
    run()
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{out}/pitches") for f in fs if f.endswith(".parquet")}
    landed(2, feed(10_000, [play(0, 2)]))
    run()
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{out}/pitches") for f in fs if f.endswith(".parquet")}
    assert len(after) == 2 and before.items() <= after.items()


def test_games_follow_their_scores(spark, tmp_path, landed):
    out, games = str(tmp_path / "out"), spark.createDataFrame([(1, 2024, date(2024, 4, 1), 0, 0, "Live", None), (2, 2024, date(2024, 4, 1), 3, 3, "Live", None)],
        "game_pk long, season int, game_date date, away_score int, home_score int, status string, home_team_won boolean")
    tables.upsert(spark, f"{out}/games", games, ["game_pk"], "season", ["game_pk"])
    landed(1, feed(1, [play(0, 2)], status="Final"))
    landed(2, feed(9, [], status="Final"))
    live.run_live(spark, landed.folder, out, str(tmp_path / "cp"), games=games.schema).awaitTermination()
    got = {r["game_pk"]: (r["away_score"], r["home_score"], r["status"], r["home_team_won"]) for r in spark.read.parquet(f"{out}/games").collect()}
    assert got == {1: (1, 0, "Final", False), 2: (3, 3, "Live", None)}


def test_a_failed_publisher_stops_nothing(spark, tmp_path, landed):
    def broken(name, rows):
        raise ConnectionError(name)

    landed(1, feed(1, [play(0, 2)]))
    live.run_live(spark, landed.folder, str(tmp_path / "out"), str(tmp_path / "cp"), broken).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/pitches")).count() == 2


def test_a_consumer_goes_on_where_it_was(spark, tmp_path, landed):
    out, topics, got = str(tmp_path / "out"), str(tmp_path / "topics"), []

    def consume():
        stream = live.read_topic(spark, topics, "pitches").writeStream.option("checkpointLocation", str(tmp_path / "seen"))
        stream.foreachBatch(lambda rows, _: got.append(sorted(r["key"] for r in rows.collect()))).trigger(availableNow=True).start().awaitTermination()

    for k, n in ((1, 2), (2, 3)):
        landed(k, feed(1, [play(0, n)]))
        live.run_live(spark, landed.folder, out, str(tmp_path / "cp"), live.file_topics(topics)).awaitTermination()
        consume()
    assert got == [["1_0_1", "1_0_2"], ["1_0_3"]]


def test_new_pitches_once(spark, tmp_path, landed):
    for k in (1, 2):
        landed(k, feed(1, [play(0, 2, complete=False)]))
    landed(3, feed(1, [play(0, 2)]))
    stream = live.new_pitches(live.snapshots(spark, landed.folder))
    q = stream.writeStream.format("memory").queryName("pitch_news").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("pitch_news").count() == 4


def test_state_changes(spark, tmp_path, landed):
    for k, status in enumerate(["Preview", "Live", "Live", "Final"]):
        landed(k, feed(1, [], status=status))
    stream = feeds.game_state(live.snapshots(spark, landed.folder)).select("game_pk", "status", "snapshot_ts")
    q = live.state_changes(stream, stay_ms=None).writeStream.format("memory").queryName("changes").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r["old_state"], r["new_state"]) for r in spark.table("changes").collect()] == [("Preview", "Live"), ("Live", "Final")]


def test_a_bad_play_is_set_aside_alone(spark, tmp_path, landed):
    mixed = feed(1, [play(0, 2), play(1, 3), play(2, 1)], status="Live")
    mixed["liveData"]["plays"]["allPlays"][1]["playEvents"][1]["pitchData"]["startSpeed"] = "fast"
    nameless = play(3, 1)
    del nameless["about"]["atBatIndex"]
    mixed["liveData"]["plays"]["allPlays"].append(nameless)
    out = str(tmp_path / "out")
    landed(1, mixed)
    landed(2, feed(2, [play(0, 1)]))
    landed(3, "{broken")
    landed(4, {"no": "game"})
    live.run_live(spark, landed.folder, out, str(tmp_path / "cp")).awaitTermination()
    got = sorted((r["game_pk"], r["at_bat_index"]) for r in spark.read.parquet(f"{out}/pitches").collect())
    assert got == [(1, 0), (1, 0), (1, 2), (2, 0)]
    bad = [(r["game_pk"], r["_corrupt_record"]) for r in spark.read.parquet(f"{out}/quarantine").collect()]
    assert sorted((g or 0, '"fast"' in t, "isTopInning" in t) for g, t in bad) == [(0, False, False), (0, False, False), (1, False, True), (1, True, True)]
    assert sorted(json.loads(t)["about"].get("atBatIndex", -1) for g, t in bad if g) == [-1, 1]


def test_plays_are_read_as_whole_documents_are(spark):
    documents = [(json.dumps(d),) for d in (feed(1, [play(0, 3), play(1, 2, complete=False)]), feed(2, []), {"gamePk": 3}, {"gamePk": 4, "liveData": {"plays": {"allPlays": [play(0, 1)]}}})]
    raw = spark.createDataFrame(documents, "value string")
    one, other = (feeds.split_corrupt(f(raw))[0] for f in (feeds.parse, feeds.parse_plays))
    for f in (feeds.pitches, feeds.at_bats, feeds.game_state):
        assert sorted(map(str, f(one).collect())) == sorted(map(str, f(other).collect()))


@pytest.mark.parametrize("table", ["at_bats", "game_state"])
def test_a_failed_store_is_told_of_when_it_is_run_again(spark, tmp_path, landed, monkeypatch, table):
    out, topics, broken = str(tmp_path / "out"), str(tmp_path / "topics"), [True]
    plain = live.upsert

    def failing(spark, path, *args, **more):
        if broken[0] and path.endswith(table):
            raise OSError("store is away")
        return plain(spark, path, *args, **more)

    monkeypatch.setattr(live, "upsert", failing)
    run = lambda: live.run_live(spark, landed.folder, out, str(tmp_path / "cp"), live.file_topics(topics))
    landed(1, feed(1, [play(0, 2)]))
    with pytest.raises(Exception, match="store is away"):
        run().awaitTermination()
    assert spark.read.parquet(f"{out}/pitches").count() == 2 and not os.path.exists(f"{topics}/pitches")
    broken[0] = False
    run().awaitTermination()
    keys = lambda t: [r["key"] for r in spark.read.json(f"{topics}/{t}").collect()]
    assert sorted(keys("pitches")) == ["1_0_1", "1_0_2"] and keys("at_bats") == ["1_0"]
    assert spark.read.parquet(f"{out}/at_bats").count() == 1 and os.listdir(f"{out}/outbox") == []


def test_refused_messages_are_sent_later_and_in_order(spark, tmp_path, landed):
    out, got, away = str(tmp_path / "out"), [], {"pitches"}

    def publish(name, rows):
        if name in away:
            raise ConnectionError(name)
        got.append((name, rows.count()))

    run = lambda: live.run_live(spark, landed.folder, out, str(tmp_path / "cp"), publish).awaitTermination()
    landed(1, feed(1, [play(0, 2)]))
    run()
    landed(2, feed(1, [play(0, 2), play(1, 3)]))
    run()
    assert got == [("at_bats", 1), ("at_bats", 1)] and len(os.listdir(f"{out}/outbox")) == 2
    away.clear()
    run()  # nothing new has landed
    assert got[2:] == [("pitches", 2), ("pitches", 3)] and os.listdir(f"{out}/outbox") == []


def test_progress_keeps_the_open_play_only(spark, tmp_path, landed):
    seen = []

    def run():
        stream = live.progress(live.snapshots(spark, landed.folder), stay_ms=None).writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        q = stream.foreachBatch(lambda rows, _: seen.extend((r["game_pk"], r["at_bat_index"], r["pitch_number"], r["is_complete"]) for r in rows.collect())).trigger(availableNow=True).start()
        q.awaitTermination()
        return sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"])

    landed(1, feed(1, [play(0, 2, complete=False)]))
    landed(2, feed(2, [play(0, 1)]))
    run()
    assert sorted(seen) == [(1, 0, 1, False), (1, 0, 2, False), (2, 0, 0, True), (2, 0, 1, True)]
    seen.clear()
    landed(3, feed(1, [play(0, 3, complete=False)]))
    landed(4, feed(2, [play(0, 1)]))
    run()
    assert seen == [(1, 0, 3, False)]
    seen.clear()
    landed(5, feed(1, [play(0, 4), play(1, 1, complete=False)]))
    size = run()
    assert sorted(seen) == [(1, 0, 0, True), (1, 0, 1, True), (1, 0, 2, True), (1, 0, 3, True), (1, 0, 4, True), (1, 1, 1, False)]
    assert size <= 6  # two games' last plays and one open pitch, with what RocksDB keeps for their expiry


def test_literal_weather_payload(spark):
    from pitchlake.operators import weather

    hourly = {
        "time": ["2024-04-01T17:00", "2024-04-01T18:00"], "temperature_2m": [60.1, 61.5], "apparent_temperature": [58.0, 59.25], "relative_humidity_2m": [40, 41],
        "precipitation": [0.0, 0.02], "wind_speed_10m": [8.1, 9.4], "wind_gusts_10m": [15.0, 17.2], "wind_direction_10m": [180, 190], "cloud_cover": [20, 25],
        "pressure_msl": [1013.2, 1012.9], "weather_code": [1, 61],
    }
    without = {k: v for k, v in hourly.items() if k not in ("wind_gusts_10m", "weather_code")} | {"cloud_cover": [20]}
    raw = spark.createDataFrame([(json.dumps({"venue_id": 5, "hourly": hourly}),), (json.dumps({"venue_id": 6, "hourly": without}),), ('{"venue_id": 7}',)], "value string")
    hours = weather.hourly_rows(feeds.parse(raw, schema=schemas.HOURLY))
    assert hours.count() == 4
    games = spark.createDataFrame([(1, 5, "2024-04-01 18:40:00"), (2, 6, "2024-04-01 18:05:00"), (3, 5, "2024-04-01 20:00:00"), (4, 8, "2024-04-01 18:00:00"), (5, 9, None)], "game_pk long, venue_id long, t string")
    games = games.select("game_pk", "venue_id", F.to_timestamp_ntz("t").alias("first_pitch_time_utc"))
    venues = spark.createDataFrame([(5, "Open"), (6, "Retractable"), (8, " Dome ")], "venue_id long, roof_type string")
    got = {r["game_pk"]: r.asDict() for r in weather.weather_rows(games, venues, hours).collect()}
    names = ("temperature_f", "feels_like_f", "relative_humidity_pct", "precipitation_in", "wind_speed_mph", "wind_gust_mph", "wind_direction_deg", "cloud_cover_pct", "pressure_hpa", "weather_code")
    assert [got[1][n] for n in names] == [61.5, 59.25, 41, 0.02, 9.4, 17.2, 190, 25, 1012.9, 61]
    assert [got[2][n] for n in names] == [61.5, 59.25, 41, 0.02, 9.4, None, 190, None, 1012.9, None]
    assert all(got[g][n] is None for g in (3, 4, 5) for n in names) and got[4]["is_indoor"] and not got[1]["is_indoor"]
    assert {r["source"] for r in got.values()} == {"open-meteo"} and str(got[1]["observation_time_utc"]) == "2024-04-01 18:00:00"
    inferred = spark.read.json(spark.sparkContext.parallelize([json.dumps({"venue_id": 6, "hourly": {k: v for k, v in without.items() if k != "cloud_cover"}})]))
    assert weather.hourly_rows(inferred).where("feels_like_f = 59.25 and cloud_cover_pct is null and weather_code is null").count() == 1


def test_state_of_a_game_expires(spark, tmp_path, landed):
    import time

    stream = feeds.game_state(live.snapshots(spark, landed.folder)).select("game_pk", "status", "snapshot_ts")
    landed(1, feed(1, [], status="Preview"))
    q = live.state_changes(stream, stay_ms=1000).writeStream.format("memory").queryName("short").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    try:
        end = time.time() + 60
        while time.time() < end and not (q.lastProgress and q.lastProgress["batchId"] >= 3):
            time.sleep(0.5)
        landed(2, feed(1, [], status="Live"))
        wanted = lambda p: p["numInputRows"] > 0
        while time.time() < end and sum(map(wanted, q.recentProgress)) < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    assert sum(map(wanted, q.recentProgress)) == 2 and spark.table("short").count() == 0  # seen first, again
