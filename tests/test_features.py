"""Cells of small frames: pitch features, aggregates, plans."""

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import aggregates, analytics, features, quality, weather

COLUMNS = (
    "game_pk long, at_bat_index int, pitch_number int, pitch_type string, start_speed double, plate_x double, plate_z double, inning int, half_inning string,"
    "balls int, strikes int, home_score int, away_score int, runner_on_first boolean, runner_on_second boolean, runner_on_third boolean,"
    "is_in_play boolean, is_strike boolean, is_ball boolean, call_code string, zone int"
)


@pytest.fixture(scope="module")
def pitches(spark):
    """Rows at the edges of the rules: two at-bats of a close late game, one of a
    game that is far apart and shares its numbers."""
    late = (7, "bottom")
    rows = [
        (70, 4, 1, "SI", 91.5, -0.83, 3.5, *late, 0, 0, 3, 5, True, False, True, False, True, False, "C", 3),
        (70, 4, 2, "CH", 82.25, 1.33, 1.0, *late, 0, 1, 3, 5, True, False, True, False, False, True, "B", 14),
        (70, 4, 3, "CH", 83.0, -1.34, 2.0, *late, 1, 1, 3, 5, True, False, False, True, False, False, "X", 13),
        (70, 5, 1, None, None, 0.28, 2.17, *late, 0, 0, 4, 5, False, False, False, False, True, False, "S", None),
        (80, 4, 1, "FS", 88.0, None, 2.5, 2, "top", 3, 2, 0, 9, False, True, False, False, False, True, "B", 9),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def at(df, game, ab, number):
    return df.where((F.col("game_pk") == game) & (F.col("at_bat_index") == ab) & (F.col("pitch_number") == number)).first()


def test_pitch_features(pitches):
    df = features.enrich_pitches(pitches).cache()
    assert df.count() == 5 and len(set(df.columns) - set(pitches.columns)) == 19
    edge, chase, waste = (at(df, 70, 4, n) for n in (1, 2, 3))
    assert edge["is_in_zone"] and edge["zone_region"] == "edge" and edge["vertical_location"] == "high" and edge["horizontal_location"] == "inside"
    assert edge["prev_pitch_type"] is None and edge["pitch_number_in_ab"] == 1 and edge["is_first_pitch"]
    assert (edge["score_diff"], edge["is_close_game"], edge["base_state"], edge["runners_on_base"], edge["leverage_bucket"]) == (-2, True, 5, 2, "high")
    assert not chase["is_in_zone"] and chase["zone_region"] == "chase" and chase["is_pitcher_count"] and chase["count_label"] == "0-1"
    assert (chase["prev_pitch_type"], chase["prev_speed"], chase["speed_diff"]) == ("SI", 91.5, -9.25)
    assert waste["zone_region"] == "waste" and waste["speed_diff"] == 0.75 and not waste["is_scoring_position"] and waste["leverage_bucket"] == "medium"
    heart, far = at(df, 70, 5, 1), at(df, 80, 4, 1)
    assert heart["zone_region"] == "heart" and heart["vertical_location"] == "low" and heart["prev_speed"] is None and heart["speed_diff"] is None
    assert far["prev_pitch_type"] is None and far["zone_region"] is None and far["is_full_count"] and far["is_hitter_count"]
    assert not far["is_close_game"] and far["base_state"] == 2 and far["leverage_bucket"] == "medium" and far["is_scoring_position"]


def test_zone_edges_and_nulls(spark):
    rows = [(0.83, 1.5), (-0.28, 2.17), (0.28, 2.83), (1.33, 4.0), (1.34, 4.0), (None, 2.5), (5.0, None), (None, None)]
    df = features.zone_features(spark.createDataFrame(rows, "plate_x double, plate_z double"))
    got = [(r["zone_region"], r["is_in_zone"]) for r in df.collect()]
    assert got[:5] == [("edge", True), ("heart", True), ("heart", True), ("chase", False), ("waste", False)]
    assert got[5:] == [(None, None), (None, False), (None, None)]


def test_enrich_shuffles_once(pitches):
    plan = features.enrich_pitches(pitches.repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_daily_leaders_with_limit_is_top_k(spark, pitches):
    p = pitches.withColumns({"pitcher_id": F.lit(1), "pitcher_name": F.lit("P")})
    ab = spark.createDataFrame([(1, 80, "strikeout")], "pitcher_id int, game_pk long, event_type string")
    df = analytics.daily_leaders(p, ab, limit=3)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert [(r["game_pk"], r["strikeouts"]) for r in df.collect()] == [(80, 1), (70, 0)]


def test_pace_of_one_game_keeps_games_apart(spark):
    from datetime import datetime

    rows = [(g, 1, "top", 0, n, datetime(2024, 4, 1, 18, 0, 10 * n + g)) for g in (1, 2) for n in (1, 2, 3)]
    df = spark.createDataFrame(rows, "game_pk long, inning int, half_inning string, at_bat_index int, pitch_number int, timestamp timestamp_ntz")
    one = analytics.game_pace(df.where("game_pk = 2")).collect()
    assert [(r["game_pk"], r["pitch_count"], r["avg_time_between_pitches"]) for r in one] == [(2, 3, 10.0)]
    assert analytics.game_pace(df).count() == 2


def test_played_and_coverage(spark):
    rows = [(1, "Final", None), (2, "Final", "Suspended"), (3, "Live", ""), (4, "Final", "Final"), (5, "Final", None), (6, "Preview", "Postponed")]
    schedule = spark.createDataFrame(rows, "game_pk long, status string, detailed_state string")
    assert {r[0] for r in quality.played(schedule).collect()} == {1, 4, 5}
    stored = spark.createDataFrame([(1, "Final"), (4, "Live"), (9, "Live")], "game_pk long, status string")
    thrown = spark.createDataFrame([(4,), (4,)], "game_pk long")
    got = {r["measure"]: r["games"] for r in quality.coverage_report(schedule, stored, thrown).collect()}
    assert got == {
        "scheduled": 6, "scheduled_played": 3, "scheduled_suspended": 1, "scheduled_live": 1, "scheduled_postponed": 1,
        "stored": 3, "missing": 1, "without_pitches": 1, "stale": 1,
    }
    missing = quality.missing_games(quality.played(schedule), stored)
    assert [r[0] for r in quality.first_ids(missing.union(missing)).collect()] == [5]
    assert quality.coverage_report(schedule.limit(0), stored.limit(0), thrown).count() == 0


def test_dates():
    from datetime import date

    from pitchlake.functions import dates

    assert dates.week_before(date(2024, 3, 5)) == (date(2024, 2, 27), date(2024, 3, 5))
    assert dates.previous_month(date(2024, 1, 31)) == (2023, 12) and dates.previous_month(date(2024, 3, 31)) == (2024, 2)
    assert dates.season_start(date(2024, 9, 1)) == date(2024, 3, 1)


def test_batting_counts_and_zero_denominators(spark):
    rows = [(1, 300, "B", "top", "walk", 0, False), (1, 300, "B", "top", None, 0, False), (1, 301, "C", "top", "single", 1, True), (1, 302, "D", "bottom", "double", 2, True)]
    ab = spark.createDataFrame(rows, "game_pk long, batter_id int, batter_name string, half_inning string, event_type string, rbi int, is_scoring_play boolean")
    got = {r["batter_id"]: r for r in aggregates.batter_game(ab).collect()}
    assert got[300]["plate_appearances"] == 2 and got[300]["at_bats_count"] == 0 and got[300]["batting_avg"] is None
    assert got[301]["batting_avg"] == 1.0 and got[302]["rbi"] == 2
    assert aggregates.team_game(ab).count() == 2


def test_rolling_counts_rows(spark):
    rows = [(7, f"2024-04-{d:02d}", 1, 4, 1, 0, 4) for d in (1, 2, 9)]
    df = spark.createDataFrame(rows, "player_id int, stat_date string, hits int, at_bats_count int, strikeouts int, walks int, plate_appearances int")
    got = aggregates.rolling_player(df, 2).orderBy("stat_date").collect()
    assert [r["rolling_avg"] for r in got] == [0.25] * 3 and got[0]["rolling_ops_approx"] == 0.5


def test_matchup_is_one_row_without_input(spark):
    p = spark.createDataFrame([], "pitcher_id int, batter_id int, pitch_type string")
    ab = spark.createDataFrame([], "pitcher_id int, batter_id int, event_type string")
    row = analytics.matchup(p, ab, 1, 2).collect()
    assert len(row) == 1 and row[0]["total_pitches"] == 0 and row[0]["hits"] is None and row[0]["pitch_types_seen"] is None


def test_game_summary_keeps_games_without_events(spark):
    g = spark.createDataFrame([(1, "2024-04-01", "NYY", "SF", 1, 2), (2, "2024-04-01", "A", "B", 3, 3)], "game_pk long, game_date string, away_team_name string, home_team_name string, away_score int, home_score int")
    p = spark.createDataFrame([(1,)] * 10, "game_pk long")
    ab = spark.createDataFrame([(1, "single"), (1, "strikeout")], "game_pk long, event_type string")
    got = {r["game_pk"]: r for r in aggregates.game_summary(g, p, ab).collect()}
    assert got[1]["winner"] == "SF" and got[1]["total_pitches"] == 10 and got[1]["total_hits"] == 1
    assert got[2]["winner"] is None and got[2]["total_pitches"] is None


def test_quality_rules(spark):
    rows = [("FF", 39.0, 0.0, 2.0, 2000.0), ("FF", 95.0, 3.5, 2.0, 5000.0), (None, None, None, 7.0, None)]
    df = spark.createDataFrame(rows, "pitch_type string, start_speed double, plate_x double, plate_z double, spin_rate double")
    got = {r["rule"]: (r["violations"], r["status"]) for r in quality.quality_report(df).collect()}
    assert got["speed_range"] == (1, "fail") and got["location_range"] == (1, "fail") and got["spin_range"] == (1, "fail")
    assert got["null_plate_z"] == (0, "pass") and got["null_pitch_type"] == (1, "fail")
    assert quality.quality_report(df.limit(0)).count() == 0


def test_weather(spark):
    df = spark.createDataFrame(
        [(None, False, None, 10.0, 0.0, None, 0.0), (60.0, False, True, 10.0, 90.0, 0.1, 0.0)],
        "temperature_f double, is_indoor boolean, roof_closed boolean, wind_speed_mph double, wind_direction_deg double, precipitation_in double, azimuth_angle double",
    )
    for step in (weather.add_indoor_flag, weather.add_wind_components, weather.add_temperature_features, weather.neutralize_indoor):
        df = step(df)
    out, roof = df.collect()
    assert out["temp_band"] is None and not out["is_wet"] and out["wind_out_to_cf_mph"] == -10.0 and out["effective_precipitation_in"] == 0.0
    assert roof["is_indoor_or_closed"] and roof["effective_temperature_f"] == 72.0 and roof["is_wet"] and roof["temp_band"] == "cool"


def test_hourly_lookup(spark):
    from datetime import datetime

    names = list(weather.READINGS)
    fields = "time array<string>, " + ", ".join(f"{n} array<double>" for n in names)
    hourly = spark.createDataFrame([(1, (["2024-04-01T18:00", "2024-04-01T19:00"], *[[50.0, 60.0]] * len(names)))], f"venue_id int, hourly struct<{fields.replace(' array', ':array')}>")
    hours = weather.hourly_rows(hourly)
    games = spark.createDataFrame([(9, 1, datetime(2024, 4, 1, 19, 40)), (8, 1, datetime(2024, 4, 2, 1, 0))], "game_pk long, venue_id int, first_pitch_time_utc timestamp_ntz")
    venues = spark.createDataFrame([(1, "Open")], "venue_id int, roof_type string")
    got = {r["game_pk"]: r["temperature_f"] for r in weather.weather_rows(games, venues, hours).collect()}
    assert got == {9: 60.0, 8: None}


def leaves(plan):
    """Scans of an executed plan, those inside finished stages too."""
    name = plan.getClass().getSimpleName()
    if name in ("AdaptiveSparkPlanExec", "ReusedExchangeExec") or name.endswith("QueryStageExec"):
        return leaves(plan.executedPlan() if name == "AdaptiveSparkPlanExec" else plan.child() if name == "ReusedExchangeExec" else plan.plan())
    found = plan.collectLeaves()
    found = [found.apply(i) for i in range(found.size())]
    return [y for x in found for y in ([x] if x.equals(plan) else leaves(x))]


def test_dates_of_games_prune_the_folders_of_facts(spark, tmp_path):
    from pitchlake.operators.quality import final_game_facts
    from pitchlake.sources import tables

    facts = spark.range(400).selectExpr("id DIV 10 AS game_pk", "CAST(id % 10 AS INT) AS pitch_number", "date_add(DATE'2024-04-01', CAST(id DIV 20 AS INT)) AS game_date")
    tables.replace_partitions(facts, str(tmp_path / "pitches"), "game_date", ["game_pk"])
    games = facts.select("game_pk", "game_date").distinct().selectExpr("*", "IF(game_pk % 13 = 0, 'Final', 'Live') AS status")
    games.write.parquet(str(tmp_path / "games"))
    games, stored = spark.read.parquet(str(tmp_path / "games")), tables.read_table(spark, str(tmp_path / "pitches"), facts.schema)
    for args, days in (((), 4), (("2024-04-01", "2024-04-08"), 2)):
        got = final_game_facts(stored, games, *args)
        assert got.count() == 10 * days and "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
        got.collect()
        scans = [x for x in leaves(got._jdf.queryExecution().executedPlan()) if "dynamicpruning" in x.toString()]
        assert [x.metrics().apply("numFiles").value() for x in scans] == [days]
    undated = final_game_facts(stored.drop("game_date"), games)
    assert undated.count() == 40


def test_leaders_of_each_day_are_ranked_before_the_shuffle(spark):
    from pitchlake.operators.analytics import daily_leaders

    p = spark.range(3000).selectExpr("id % 100 AS game_pk", "id % 7 AS pitcher_id", "concat('P', id % 7) AS pitcher_name", "90.0 + id % 9 AS start_speed", "date_add(DATE'2024-04-01', CAST(id % 100 % 5 AS INT)) AS game_date")
    ab = p.selectExpr("game_pk", "pitcher_id", "game_date", "IF(hash(game_pk, pitcher_id, start_speed) % 3 = 0, 'strikeout', 'walk') AS event_type")
    top = daily_leaders(p, ab, limit=2, by=("game_date",))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    whole = [tuple(r) for r in daily_leaders(p, ab, by=("game_date",)).collect()]
    want = [r for i, r in enumerate(whole) if sum(x[0] == r[0] for x in whole[:i]) < 2]
    assert [tuple(r) for r in top.collect()] == want and len(want) == 10
    day = daily_leaders(p, ab, limit=2, game_date="2024-04-03").collect()
    assert [tuple(r) for r in day] == [r[1:] for r in want if str(r[0]) == "2024-04-03"]
