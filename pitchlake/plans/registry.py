"""Registered queries over the test tables, each with its oracle in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchlake.functions.numeric import rounded
from pitchlake.operators import aggregates, analytics, features, quality, weather
from pitchlake.sources import scratch, tables
from pitchlake.sources.adapters import view, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
HIT = "event_type IN ('single', 'double', 'triple', 'home_run')"
AB = "event_type NOT IN ('walk', 'hit_by_pitch', 'sac_fly', 'sac_bunt', 'sac_fly_double_play', 'sac_bunt_double_play')"
WHIFF = "(is_strike AND NOT is_in_play AND call_code = 'S')"
KEY = ("game_pk", "at_bat_index", "pitch_number")


def register(oracle: str, *names: str):
    """Register a function of the named views under its own name; ``oracle`` is
    SQL over the same views."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(view(spark, sf_dir, n) for n in names))
        ORACLE[f.__name__] = with_views(oracle, *[n for n in names if n.startswith("v_")]) if any(n.startswith("v_") for n in names) else oracle
        return f

    return add


def r(x: str, digits: int) -> str:
    return f"ROUND(({x}) * {10.0**digits}) / {10.0**digits}"


def avg(x: str, digits: int) -> str:
    return r(r(x, 9), digits)


def n(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


#: Pitches of the final games of a week.
WEEK = """FROM (SELECT * FROM v_pitches WHERE game_pk IN (SELECT game_pk FROM v_games WHERE status = 'Final'
  AND game_date BETWEEN DATE '1995-06-08' AND DATE '1995-06-15')) p"""
SEQUENCE = """LAG(pitch_type) OVER w AS prev_pitch_type, LAG(start_speed) OVER w AS prev_speed,
  start_speed - LAG(start_speed) OVER w AS speed_diff, CAST(ROW_NUMBER() OVER w AS INT) AS pitch_number_in_ab"""
ZONE = """ABS(plate_x) <= 0.83 AND plate_z BETWEEN 1.5 AND 3.5 AS is_in_zone,
  CASE WHEN plate_x IS NULL OR plate_z IS NULL THEN NULL WHEN ABS(plate_x) <= 0.28 AND plate_z BETWEEN 2.17 AND 2.83 THEN 'heart'
    WHEN ABS(plate_x) <= 0.83 AND plate_z BETWEEN 1.5 AND 3.5 THEN 'edge'
    WHEN ABS(plate_x) <= CAST(0.83 AS DOUBLE) + 0.5 AND plate_z BETWEEN 1.0 AND 4.0 THEN 'chase' ELSE 'waste' END AS zone_region,
  CASE WHEN ABS(plate_x) <= 0.28 THEN 'middle' WHEN plate_x < -0.28 THEN 'inside' WHEN plate_x IS NOT NULL THEN 'outside' END AS horizontal_location,
  CASE WHEN plate_z >= 2.83 THEN 'high' WHEN plate_z <= 2.17 THEN 'low' WHEN plate_z IS NOT NULL THEN 'middle' END AS vertical_location"""
RUNNERS = "CAST(runner_on_first AS INT) + CAST(runner_on_second AS INT) + CAST(runner_on_third AS INT)"
CONTEXT = f"""home_score - away_score AS score_diff, ABS(home_score - away_score) <= 2 AS is_close_game,
  CAST(runner_on_first AS INT) + 2 * CAST(runner_on_second AS INT) + 4 * CAST(runner_on_third AS INT) AS base_state, {RUNNERS} AS runners_on_base,
  runner_on_second OR runner_on_third AS is_scoring_position,
  CASE WHEN ABS(home_score - away_score) <= 2 AND inning >= 7 AND (runner_on_second OR runner_on_third) THEN 'high'
    WHEN ABS(home_score - away_score) <= 2 OR {RUNNERS} > 0 THEN 'medium' ELSE 'low' END AS leverage_bucket"""
COUNT = """pitch_number = 1 AS is_first_pitch, balls = 3 AND strikes = 2 AS is_full_count, balls > strikes AS is_hitter_count,
  strikes > balls AS is_pitcher_count, CAST(balls AS VARCHAR) || '-' || CAST(strikes AS VARCHAR) AS count_label"""
BY_AT_BAT = "FROM v_pitches WINDOW w AS (PARTITION BY game_pk, at_bat_index ORDER BY pitch_number)"
KEYS = "game_pk, at_bat_index, pitch_number"


@register(f"SELECT {KEYS}, {SEQUENCE} {BY_AT_BAT}", "v_pitches")
def pitch_sequence(p):
    return features.pitch_sequence(p).select(*KEY, "prev_pitch_type", "prev_speed", "speed_diff", "pitch_number_in_ab")


@register(f"SELECT {KEYS}, {ZONE} FROM v_pitches", "v_pitches")
def zone_features(p):
    return features.zone_features(p).select(*KEY, "is_in_zone", "zone_region", "horizontal_location", "vertical_location")


@register(f"SELECT {KEYS}, {CONTEXT} FROM v_pitches", "v_pitches")
def game_context(p):
    return features.game_context(p).select(
        *KEY, "score_diff", "is_close_game", "base_state", "runners_on_base", "is_scoring_position", "leverage_bucket"
    )


@register(f"SELECT {KEYS}, {COUNT} FROM v_pitches", "v_pitches")
def count_features(p):
    return features.count_features(p).select(*KEY, "is_first_pitch", "is_full_count", "is_hitter_count", "is_pitcher_count", "count_label")


@register(f"SELECT *, {SEQUENCE}, {ZONE}, {CONTEXT}, {COUNT} {BY_AT_BAT}", "v_pitches")
def enrich_pitches(p):
    return features.enrich_pitches(p)


@register(
    f"""SELECT game_pk, pitcher_id, pitcher_name, COUNT(*) AS total_pitches, {n("is_strike")} AS strikes, {n("is_ball")} AS balls, {n(WHIFF)} AS whiffs,
  CAST({n("is_strike")} AS DOUBLE) / COUNT(*) * 100.0 AS strike_pct, {avg("AVG(start_speed) FILTER (WHERE pitch_type IN ('FF', 'SI'))", 6)} AS avg_fastball_speed,
  MAX(start_speed) AS max_speed, CAST(COUNT(DISTINCT inning * 2 + CASE half_inning WHEN 'top' THEN 0 ELSE 1 END) AS DOUBLE) AS innings_pitched_approx,
  {", ".join(f"{n(f"pitch_type = '{t}'")} AS {t.lower()}_count" for t in ("FF", "SI", "SL", "CU", "CH", "FC", "FS"))},
  {n("pitch_type NOT IN ('FF', 'SI', 'SL', 'CU', 'CH', 'FC', 'FS')")} AS other_type_count FROM v_pitches GROUP BY 1, 2, 3""",
    "v_pitches",
)
def pitcher_game(p):
    return aggregates.pitcher_game(p)


BATTING = f"""COUNT(*) AS plate_appearances, {n(AB)} AS at_bats_count, {n(HIT)} AS hits, {n("event_type = 'double'")} AS doubles,
  {n("event_type = 'triple'")} AS triples, {n("event_type = 'home_run'")} AS home_runs, CAST(SUM(rbi) AS BIGINT) AS rbi,
  {n("event_type = 'strikeout'")} AS strikeouts, {n("event_type = 'walk'")} AS walks"""


@register(
    f"""SELECT game_pk, batter_id, batter_name, {BATTING}, CASE WHEN {n(AB)} > 0 THEN CAST({n(HIT)} AS DOUBLE) / {n(AB)} END AS batting_avg
FROM v_at_bats GROUP BY 1, 2, 3""",
    "v_at_bats",
)
def batter_game(ab):
    return aggregates.batter_game(ab)


@register(
    f"""SELECT game_pk, half_inning, {n(HIT)} AS total_hits, CAST(SUM(rbi) AS BIGINT) AS total_rbi, {n("is_scoring_play")} AS total_scoring_plays,
  {n("event_type = 'strikeout'")} AS total_strikeouts, {n("event_type = 'walk'")} AS total_walks, {n("event_type = 'home_run'")} AS total_home_runs,
  CAST(SUM(rbi) AS BIGINT) AS total_runs FROM v_at_bats GROUP BY 1, 2""",
    "v_at_bats",
)
def team_game(ab):
    return aggregates.team_game(ab)


def _dated(facts: DataFrame, games: DataFrame) -> DataFrame:
    return facts.join(games.select("game_pk", "game_date"), "game_pk")


DAILY = f"SELECT batter_id AS player_id, game_date AS stat_date, COUNT(DISTINCT game_pk) AS games, {BATTING} FROM v_at_bats JOIN v_games USING (game_pk) GROUP BY 1, 2"


@register(DAILY, "v_at_bats", "v_games")
def batter_day(ab, g):
    return aggregates.batter_day(_dated(ab, g))


@register(
    f"SELECT pitcher_id AS player_id, game_date AS stat_date, COUNT(*) AS pitches_thrown, {n('is_strike')} AS strikes FROM v_pitches JOIN v_games USING (game_pk) GROUP BY 1, 2",
    "v_pitches", "v_games",
)
def pitcher_day(p, g):
    return aggregates.pitcher_day(_dated(p, g))


@register(
    f"""WITH d AS ({DAILY}), s AS (SELECT *, CAST(SUM(hits) OVER w AS DOUBLE) AS h, CAST(SUM(at_bats_count) OVER w AS DOUBLE) AS ab,
  CAST(SUM(strikeouts) OVER w AS DOUBLE) AS k, CAST(SUM(walks) OVER w AS DOUBLE) AS bb, CAST(SUM(plate_appearances) OVER w AS DOUBLE) AS pa
  FROM d WINDOW w AS (PARTITION BY player_id ORDER BY stat_date ROWS 14 PRECEDING))
SELECT player_id, stat_date, CASE WHEN ab > 0 THEN h / ab END AS rolling_avg, CASE WHEN pa > 0 THEN k / pa END AS rolling_k_rate,
  CASE WHEN pa > 0 THEN bb / pa END AS rolling_bb_rate, CASE WHEN ab + bb > 0 THEN (h + bb) / (ab + bb) END + CASE WHEN ab > 0 THEN h / ab END AS rolling_ops_approx FROM s""",
    "v_at_bats", "v_games",
)
def rolling_player(ab, g):
    rolled = aggregates.rolling_player(aggregates.batter_day(_dated(ab, g)))
    return rolled.select("player_id", "stat_date", "rolling_avg", "rolling_k_rate", "rolling_bb_rate", "rolling_ops_approx")


@register(
    """WITH d AS (SELECT user_id AS player_id, CAST(ts AS DATE) AS stat_date, COUNT(*) AS plate_appearances, COUNT(*) FILTER (WHERE value > 50) AS hits FROM events GROUP BY 1, 2)
SELECT player_id, stat_date, CAST(SUM(hits) OVER w AS DOUBLE) / SUM(plate_appearances) OVER w AS rolling_avg FROM d
WINDOW w AS (PARTITION BY player_id ORDER BY stat_date ROWS 14 PRECEDING)""",
    "events",
)
def rolling_events_user_day(e):
    daily = e.groupBy(F.col("user_id").alias("player_id"), F.col("ts").cast("date").alias("stat_date")).agg(
        F.count(F.lit(1)).alias("plate_appearances"), F.count_if(F.col("value") > 50).alias("hits")
    )
    daily = daily.withColumns({"at_bats_count": F.col("plate_appearances"), "strikeouts": F.lit(0), "walks": F.lit(0)})
    return aggregates.rolling_player(daily).select("player_id", "stat_date", "rolling_avg")


@register(
    f"""WITH p AS (SELECT game_pk, COUNT(*) AS total_pitches FROM v_pitches GROUP BY 1),
a AS (SELECT game_pk, COUNT(*) AS total_at_bats, {n(HIT)} AS total_hits, {n("event_type = 'home_run'")} AS total_home_runs, {n("event_type = 'strikeout'")} AS total_strikeouts FROM v_at_bats GROUP BY 1)
SELECT game_pk, game_date, away_team_name AS away_team, home_team_name AS home_team, away_score, home_score, total_pitches, total_at_bats, total_hits, total_home_runs,
  total_strikeouts, CASE WHEN home_score > away_score THEN home_team_name WHEN away_score > home_score THEN away_team_name END AS winner, total_pitches AS game_duration_pitches
FROM v_games LEFT JOIN p USING (game_pk) LEFT JOIN a USING (game_pk)""",
    "v_games", "v_pitches", "v_at_bats",
)
def game_summary(g, p, ab):
    return aggregates.game_summary(g, p, ab)


MIX = f"""pitch_type, COUNT(*) AS count, {avg("AVG(start_speed)", 1)} AS avg_speed, {avg("AVG(spin_rate)", 0)} AS avg_spin_rate,
  {avg("AVG(plate_x)", 3)} + 0.0 AS avg_plate_x, {avg("AVG(plate_z)", 3)} + 0.0 AS avg_plate_z, {r(f"CAST({n(WHIFF)} AS DOUBLE) / COUNT(*)", 3)} AS whiff_rate,
  {r(f"CAST({n('zone BETWEEN 1 AND 9')} AS DOUBLE) / COUNT(*)", 3)} AS zone_rate"""


@register(f"SELECT {MIX}, {r('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 1)} AS pct FROM v_pitches WHERE pitcher_id = 1003 GROUP BY pitch_type", "v_pitches")
def pitcher_arsenal(p):
    return analytics.pitcher_arsenal(p, 1003)


@register(
    f"SELECT pitcher_id, {MIX}, {r('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY pitcher_id)', 1)} AS pct FROM v_pitches GROUP BY pitcher_id, pitch_type",
    "v_pitches",
)
def arsenal_all(p):
    return analytics.arsenal_all(p)


@register(
    f"""SELECT pitcher_id, {MIX}, {r('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY pitcher_id)', 1)} AS pct FROM v_pitches JOIN v_games USING (game_pk)
WHERE game_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' GROUP BY pitcher_id, pitch_type""",
    "v_pitches", "v_games",
)
def arsenal_range(p, g):
    return analytics.arsenal_all(_dated(p, g), "1995-01-01", "1996-12-31")


FACED = f"""COUNT(*) AS total_at_bats, {n(HIT)} AS hits, {n("event_type = 'strikeout'")} AS strikeouts, {n("event_type = 'walk'")} AS walks,
  {n("event_type = 'home_run'")} AS home_runs, {r(f"CAST({n(HIT)} AS DOUBLE) / GREATEST(COUNT(*), 1)", 3)} AS batting_avg"""
SEEN = "COUNT(*) AS total_pitches, STRING_AGG(DISTINCT pitch_type, ', ' ORDER BY pitch_type) AS pitch_types_seen"
PAIR = "WHERE pitcher_id = 1003 AND batter_id = 2021"


@register(f"SELECT * FROM (SELECT {SEEN} FROM v_pitches {PAIR}) p CROSS JOIN (SELECT {FACED} FROM v_at_bats {PAIR}) a", "v_pitches", "v_at_bats")
def matchup(p, ab):
    return analytics.matchup(p, ab, 1003, 2021)


@register(
    f"""SELECT pitcher_id, batter_id, COALESCE(total_pitches, 0) AS total_pitches, pitch_types_seen, COALESCE(total_at_bats, 0) AS total_at_bats, hits, strikeouts, walks,
  home_runs, batting_avg FROM (SELECT pitcher_id, batter_id, {SEEN} FROM v_pitches GROUP BY 1, 2) p
FULL JOIN (SELECT pitcher_id, batter_id, {FACED} FROM v_at_bats GROUP BY 1, 2) a USING (pitcher_id, batter_id)""",
    "v_pitches", "v_at_bats",
)
def matchup_all(p, ab):
    return analytics.matchup_all(p, ab)


def _standings(keys: str, where: str = "") -> str:
    return f"""WITH f AS (SELECT * FROM v_games WHERE status = 'Final' {where}),
h AS (SELECT season, home_team_name AS team_name, {n("home_team_won")} AS wins, {n("NOT home_team_won")} AS losses, SUM(home_score) AS rs, SUM(away_score) AS ra FROM f GROUP BY 1, 2),
a AS (SELECT season, away_team_name AS team_name, {n("NOT home_team_won")} AS wins, {n("home_team_won")} AS losses, SUM(away_score) AS rs, SUM(home_score) AS ra FROM f GROUP BY 1, 2),
c AS (SELECT season, team_name, COALESCE(h.wins, 0) + COALESCE(a.wins, 0) AS wins, COALESCE(h.losses, 0) + COALESCE(a.losses, 0) AS losses,
  CAST(COALESCE(h.rs, 0) + COALESCE(a.rs, 0) AS BIGINT) AS runs_scored, CAST(COALESCE(h.ra, 0) + COALESCE(a.ra, 0) AS BIGINT) AS runs_allowed FROM h FULL JOIN a USING (season, team_name))
SELECT {keys}, wins, losses, runs_scored, runs_allowed, {r("CAST(wins AS DOUBLE) / GREATEST(wins + losses, 1)", 3)} AS win_pct, runs_scored - runs_allowed AS run_diff FROM c"""


@register(_standings("season, team_name"), "v_games")
def standings(g):
    return analytics.standings(g)


@register(_standings("team_name", "AND season = 1995"), "v_games")
def standings_season(g):
    return analytics.standings(g, 1995)


@register(
    f"""WITH o AS (SELECT user_id, CAST(ts AS DATE) AS d, ts, LAG(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS b FROM events)
SELECT user_id AS game_pk, d AS inning, 'top' AS half_inning, COUNT(*) AS pitch_count, {avg("AVG((EPOCH_US(ts) - EPOCH_US(b)) / 1e6)", 1)} AS avg_time_between_pitches,
  COUNT(*) AS total_pitches_in_inning FROM o GROUP BY 1, 2""",
    "events",
)
def game_pace_events(e):
    shaped = e.select(
        F.col("user_id").alias("game_pk"), F.col("ts").cast("date").alias("inning"), F.lit("top").alias("half_inning"),
        F.col("ts").alias("timestamp"), F.col("ts").alias("at_bat_index"), F.col("event_id").alias("pitch_number"),
    )
    return analytics.game_pace(shaped)


LEADERS = f"""SELECT pitcher_name, p.pitcher_id, p.game_pk, total_pitches, COALESCE(strikeouts, 0) AS strikeouts, avg_speed, max_speed FROM
(SELECT pitcher_name, pitcher_id, game_pk, COUNT(*) AS total_pitches, {avg("AVG(start_speed)", 1)} AS avg_speed, {r("MAX(start_speed)", 1)} AS max_speed FROM v_pitches GROUP BY 1, 2, 3) p
LEFT JOIN (SELECT pitcher_id, game_pk, {n("event_type = 'strikeout'")} AS strikeouts FROM v_at_bats GROUP BY 1, 2) a USING (pitcher_id, game_pk)"""


@register(LEADERS, "v_pitches", "v_at_bats")
def daily_leaders(p, ab):
    return analytics.daily_leaders(p, ab)


@register(LEADERS + " ORDER BY strikeouts DESC, total_pitches DESC, p.pitcher_id, p.game_pk LIMIT 25", "v_pitches", "v_at_bats")
def daily_leaders_top(p, ab):
    return analytics.daily_leaders(p, ab, limit=25)


def _leaders_by_day(where: str = "") -> str:
    return f"""WITH d AS (SELECT game_pk, game_date FROM v_games {where}),
p AS (SELECT game_date, pitcher_name, pitcher_id, game_pk, COUNT(*) AS total_pitches, {avg("AVG(start_speed)", 1)} AS avg_speed, {r("MAX(start_speed)", 1)} AS max_speed
  FROM v_pitches JOIN d USING (game_pk) GROUP BY 1, 2, 3, 4),
a AS (SELECT pitcher_id, game_pk, {n("event_type = 'strikeout'")} AS strikeouts FROM v_at_bats GROUP BY 1, 2),
l AS (SELECT game_date, pitcher_name, p.pitcher_id, p.game_pk, total_pitches, COALESCE(strikeouts, 0) AS strikeouts, avg_speed, max_speed FROM p LEFT JOIN a USING (pitcher_id, game_pk))"""


@register(_leaders_by_day("WHERE game_date = DATE '1995-06-08'") + " SELECT * EXCLUDE (game_date) FROM l", "v_pitches", "v_at_bats", "v_games")
def daily_leaders_date(p, ab, g):
    return analytics.daily_leaders(_dated(p, g), _dated(ab, g), game_date=date(1995, 6, 8))


@register(
    _leaders_by_day() + """ SELECT * FROM l
QUALIFY ROW_NUMBER() OVER (PARTITION BY game_date ORDER BY strikeouts DESC, total_pitches DESC, pitcher_id, game_pk) <= 3""",
    "v_pitches", "v_at_bats", "v_games",
)
def daily_leaders_by_day(p, ab, g):
    return analytics.daily_leaders(_dated(p, g), _dated(ab, g), limit=3, by=("game_date",))


@register(
    f"""SELECT batter_name, batter_id, COUNT(DISTINCT game_pk) AS games, COUNT(*) AS at_bats, {n(HIT)} AS hits, {n("event_type = 'home_run'")} AS home_runs,
  CAST(SUM(rbi) AS BIGINT) AS rbi, {r(f"CAST({n(HIT)} AS DOUBLE) / COUNT(*)", 3)} AS batting_avg,
  {r("CAST(SUM(CASE event_type WHEN 'single' THEN 1 WHEN 'double' THEN 2 WHEN 'triple' THEN 3 WHEN 'home_run' THEN 4 ELSE 0 END) AS DOUBLE) / COUNT(*)", 3)} AS slug_pct_approx
FROM v_at_bats JOIN v_games USING (game_pk) WHERE season = 1995 GROUP BY 1, 2 HAVING COUNT(*) >= 50""",
    "v_at_bats", "v_games",
)
def season_batting(ab, g):
    return analytics.season_batting(ab.join(g.where("season = 1995").select("game_pk"), "game_pk", "left_semi"))


@register(
    f"""SELECT season, batter_name, batter_id, COUNT(DISTINCT game_pk) AS games, COUNT(*) AS at_bats, {n(HIT)} AS hits, {n("event_type = 'home_run'")} AS home_runs,
  CAST(SUM(rbi) AS BIGINT) AS rbi, {r(f"CAST({n(HIT)} AS DOUBLE) / COUNT(*)", 3)} AS batting_avg,
  {r("CAST(SUM(CASE event_type WHEN 'single' THEN 1 WHEN 'double' THEN 2 WHEN 'triple' THEN 3 WHEN 'home_run' THEN 4 ELSE 0 END) AS DOUBLE) / COUNT(*)", 3)} AS slug_pct_approx
FROM v_at_bats JOIN v_games USING (game_pk) GROUP BY 1, 2, 3 HAVING COUNT(*) >= 50""",
    "v_at_bats", "v_games",
)
def season_batting_all(ab, g):
    return analytics.season_batting(ab.join(g.select("game_pk", "season"), "game_pk"), by=("season",))


@register(
    f"""SELECT batter_name, batter_id, COUNT(DISTINCT game_pk) AS games, COUNT(*) AS at_bats, {n(HIT)} AS hits, {n("event_type = 'home_run'")} AS home_runs,
  CAST(SUM(rbi) AS BIGINT) AS rbi, {r(f"CAST({n(HIT)} AS DOUBLE) / COUNT(*)", 3)} AS batting_avg,
  {r("CAST(SUM(CASE event_type WHEN 'single' THEN 1 WHEN 'double' THEN 2 WHEN 'triple' THEN 3 WHEN 'home_run' THEN 4 ELSE 0 END) AS DOUBLE) / COUNT(*)", 3)} AS slug_pct_approx
FROM v_at_bats JOIN v_games USING (game_pk) WHERE game_date BETWEEN DATE '1995-03-01' AND DATE '1995-08-15' GROUP BY 1, 2 HAVING COUNT(*) >= 20""",
    "v_at_bats", "v_games",
)
def season_batting_until(ab, g):
    return analytics.season_batting_until(_dated(ab, g), date(1995, 8, 15), min_at_bats=20)


@register(DAILY.replace("USING (game_pk)", "USING (game_pk) WHERE status = 'Final'"), "v_at_bats", "v_games")
def daily_player_stats(ab, g):
    return tables.daily_player_stats(ab, g)


@register(
    f"SELECT *, {SEQUENCE}, {ZONE}, {CONTEXT}, {COUNT} {BY_AT_BAT.replace('FROM v_pitches', WEEK, 1)}", "v_pitches", "v_games",
)
def enriched_week(p, g):
    return tables.enriched_week(p, g, date(1995, 6, 15))


TURN = "(wind_direction_deg - azimuth_angle) * 3.141592653589793 / 180.0"
OUT, CROSS = (f"{r(x, 6)} + 0.0" for x in (f"-wind_speed_mph * COS({TURN})", f"wind_speed_mph * SIN({TURN})"))


@register(
    f"""WITH b AS (SELECT *, is_indoor OR COALESCE(roof_closed, FALSE) AS closed FROM v_weather JOIN (SELECT game_pk, game_date FROM v_games) g USING (game_pk)
  LEFT JOIN (SELECT venue_id, azimuth_angle, elevation_ft FROM v_venues) v USING (venue_id))
SELECT game_pk, venue_id, game_date, closed AS is_indoor_or_closed, {OUT} AS wind_out_to_cf_mph, {CROSS} AS wind_cross_mph,
  CASE WHEN temperature_f < 50 THEN 'cold' WHEN temperature_f < 65 THEN 'cool' WHEN temperature_f < 80 THEN 'mild' WHEN temperature_f < 90 THEN 'warm' WHEN temperature_f IS NOT NULL THEN 'hot' END AS temp_band,
  COALESCE(precipitation_in, 0.0) > 0.05 AS is_wet, CASE WHEN closed THEN 72.0 ELSE temperature_f END AS effective_temperature_f, CASE WHEN closed THEN 0.0 ELSE wind_speed_mph END AS effective_wind_speed_mph,
  CASE WHEN closed THEN 0.0 ELSE {OUT} END AS effective_wind_out_to_cf_mph, CASE WHEN closed THEN 0.0 ELSE {CROSS} END AS effective_wind_cross_mph,
  CASE WHEN closed THEN 0.0 ELSE COALESCE(precipitation_in, 0.0) END AS effective_precipitation_in, elevation_ft FROM b""",
    "v_weather", "v_games", "v_venues",
)
def weather_features(w, g, v):
    df = weather.weather_features(w, g, v)
    df = df.withColumns({c: rounded(F.col(c), 6) + 0.0 for c in df.columns if c.endswith(("_cf_mph", "_cross_mph"))})  # sine and cosine differ in the last bit
    made = ["is_indoor_or_closed", "wind_out_to_cf_mph", "wind_cross_mph", "temp_band", "is_wet", "elevation_ft"]
    return df.select("game_pk", "venue_id", "game_date", *made, *[c for c in df.columns if c.startswith("effective_")])


@register(
    f"""WITH b AS (SELECT *, is_indoor OR COALESCE(roof_closed, FALSE) AS closed FROM v_weather JOIN (SELECT game_pk, game_date FROM v_games) g USING (game_pk)
  LEFT JOIN (SELECT venue_id, azimuth_angle, elevation_ft FROM v_venues) v USING (venue_id))
SELECT game_pk, closed AS is_indoor_or_closed, CASE WHEN closed THEN 72.0 ELSE temperature_f END AS effective_temperature_f, CASE WHEN closed THEN 0.0 ELSE wind_speed_mph END AS effective_wind_speed_mph,
  CASE WHEN closed THEN 0.0 ELSE {OUT} END AS effective_wind_out_to_cf_mph, CASE WHEN closed THEN 0.0 ELSE {CROSS} END AS effective_wind_cross_mph,
  CASE WHEN closed THEN 0.0 ELSE COALESCE(precipitation_in, 0.0) END AS effective_precipitation_in, elevation_ft, relative_humidity_pct FROM b""",
    "v_weather", "v_games", "v_venues",
)
def weather_model_columns(w, g, v):
    df = weather.model_columns(weather.weather_features(w, g, v))
    return df.withColumns({c: rounded(F.col(c), 6) + 0.0 for c in df.columns if c.endswith(("_cf_mph", "_cross_mph"))})


@register(
    """SELECT CASE WHEN azimuth_angle IS NULL THEN 'no_venue' WHEN first_pitch IS NULL THEN 'no_first_pitch' WHEN TRIM(COALESCE(roof_type, '')) IN ('Dome', 'Indoor', 'Closed') THEN 'indoor' ELSE 'fetch' END AS route,
  COUNT(*) AS games FROM (SELECT *, CASE WHEN game_pk % 3 <> 0 THEN game_date END AS first_pitch FROM v_games) g LEFT JOIN v_venues USING (venue_id) GROUP BY 1""",
    "v_games", "v_venues",
)
def weather_routing(g, v):
    return weather.weather_routing(g.withColumn("first_pitch", F.when(F.col("game_pk") % 3 != 0, F.col("game_date"))), v)


PITCHED = "SELECT event_id AS game_pk, user_id % 12 AS venue_id, ts AS first_pitch_time_utc FROM events WHERE event_id % 2 = 0"


@register(
    f"""WITH h AS (SELECT user_id % 12 AS venue_id, DATE_TRUNC('hour', ts) AS hour, {avg("AVG(value)", 3)} AS t, COUNT(*) AS n FROM events GROUP BY 1, 2),
g AS ({PITCHED}), j AS (SELECT game_pk, g.venue_id, DATE_TRUNC('hour', first_pitch_time_utc) AS hour, TRIM(COALESCE(roof_type, '')) IN ('Dome', 'Indoor', 'Closed') AS is_indoor FROM g LEFT JOIN v_venues v ON v.venue_id = g.venue_id)
SELECT game_pk, j.venue_id, CAST(j.hour AS VARCHAR) AS observed, is_indoor, CASE WHEN NOT is_indoor THEN t END AS temperature_f, CASE WHEN NOT is_indoor THEN t - 2 END AS feels_like_f,
  CASE WHEN NOT is_indoor THEN CAST(n AS DOUBLE) END AS wind_gust_mph, CASE WHEN NOT is_indoor THEN CAST(n AS INT) END AS weather_code, CAST(NULL AS DOUBLE) AS pressure_hpa, 'open-meteo' AS source
FROM j LEFT JOIN h ON h.venue_id = j.venue_id AND h.hour = j.hour""",
    "events", "v_venues",
)
def weather_rows(e, v):
    by = (F.col("user_id") % 12).alias("venue_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    hour = e.groupBy(*by).agg(rounded(rounded(F.avg("value"), 9), 3).alias("t"), F.count(F.lit(1)).alias("n"))
    row = F.struct(F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("t").alias("temperature_2m"), (F.col("t") - 2).alias("apparent_temperature"), F.col("n").alias("wind_gusts_10m"), F.col("n").alias("weather_code"))
    lists = hour.groupBy("venue_id").agg(F.collect_list(row).alias("r"))
    payloads = lists.select("venue_id", F.struct(*(F.col(f"r.{c}").alias(c) for c in ("time", "temperature_2m", "apparent_temperature", "wind_gusts_10m", "weather_code"))).alias("hourly"))
    games = e.where("event_id % 2 = 0").select(F.col("event_id").alias("game_pk"), by[0], F.col("ts").alias("first_pitch_time_utc"))
    made = weather.weather_rows(games, v, weather.hourly_rows(payloads))
    return made.select("game_pk", "venue_id", F.col("observation_time_utc").cast("string").alias("observed"), "is_indoor", "temperature_f", "feels_like_f", "wind_gust_mph", "weather_code", "pressure_hpa", "source")


RULES = {
    "speed_range": "start_speed < 40 OR start_speed > 110",
    "location_range": "ABS(plate_x) > 3 OR (plate_x IS NOT NULL AND (plate_z < -1 OR plate_z > 6))",
    "spin_range": "spin_rate < 0 OR spin_rate > 4000",
} | {f"null_{c}": f"{c} IS NULL" for c in quality.NULL_COLUMNS}


@register(
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{name}' AS rule, {n(rule)} AS violations, COUNT(*) AS total FROM v_pitches" for name, rule in RULES.items())
    + f""") SELECT rule, violations, total, {r("CAST(violations AS DOUBLE) / total * 100.0", 2)} AS pct,
  CASE WHEN (STARTS_WITH(rule, 'null_') AND CAST(violations AS DOUBLE) / total > 0.1) OR (NOT STARTS_WITH(rule, 'null_') AND violations > 0) THEN 'fail' ELSE 'pass' END AS status FROM c""",
    "v_pitches",
)
def quality_report(p):
    return quality.quality_report(p)


@register("SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1", "lineitem")
def duplicate_keys(li):
    return quality.duplicate_keys(li, "l_orderkey", "l_linenumber")


#: A store that misses games, holds stale ones and lacks the pitches of others.
SCHEDULE_VIEW = "SELECT game_pk, game_date, status, CASE WHEN game_pk % 41 = 0 THEN 'Postponed' WHEN game_pk % 43 = 0 THEN 'Suspended' END AS detailed_state FROM v_games"
STORED_VIEW = "SELECT game_pk, CASE WHEN game_pk % 11 = 0 THEN 'Live' ELSE status END AS status FROM v_games WHERE game_pk % 7 <> 0"
PLAYED = "status = 'Final' AND COALESCE(detailed_state, '') NOT IN ('Postponed', 'Cancelled', 'Suspended')"


def _schedule(g):
    schedule = g.select("game_pk", "game_date", "status", F.when(F.col("game_pk") % 41 == 0, "Postponed").when(F.col("game_pk") % 43 == 0, "Suspended").alias("detailed_state"))
    stored = g.where("game_pk % 7 <> 0").select("game_pk", F.when(F.col("game_pk") % 11 == 0, "Live").otherwise(F.col("status")).alias("status"))
    return schedule, stored


@register(
    f"""WITH s AS ({SCHEDULE_VIEW}), d AS ({STORED_VIEW}), f AS (SELECT * FROM s WHERE {PLAYED}), p AS (SELECT DISTINCT game_pk FROM v_pitches WHERE game_pk % 5 <> 0),
x AS (SELECT 'scheduled' AS measure FROM s UNION ALL SELECT 'scheduled_played' FROM f
  UNION ALL SELECT 'scheduled_' || LOWER(CASE WHEN detailed_state IN ('Postponed', 'Cancelled', 'Suspended') THEN detailed_state ELSE status END) FROM s WHERE NOT ({PLAYED})
  UNION ALL SELECT 'stored' FROM d UNION ALL SELECT 'missing' FROM f WHERE game_pk NOT IN (SELECT game_pk FROM d)
  UNION ALL SELECT 'without_pitches' FROM f JOIN d USING (game_pk) WHERE game_pk NOT IN (SELECT game_pk FROM p)
  UNION ALL SELECT 'stale' FROM f JOIN d USING (game_pk) WHERE d.status <> 'Final')
SELECT measure, COUNT(*) AS games FROM x GROUP BY 1""",
    "v_games", "v_pitches",
)
def coverage_report(g, p):
    return quality.coverage_report(*_schedule(g), p.where("game_pk % 5 <> 0"))


@register(f"WITH s AS ({SCHEDULE_VIEW}), d AS ({STORED_VIEW}) SELECT game_pk FROM s WHERE {PLAYED} AND game_pk NOT IN (SELECT game_pk FROM d) ORDER BY 1 LIMIT 20", "v_games")
def coverage_first_missing(g):
    schedule, stored = _schedule(g)
    return quality.first_ids(quality.missing_games(quality.played(schedule), stored))


@register("SELECT game_pk FROM v_games WHERE game_pk NOT IN (SELECT game_pk FROM v_pitches WHERE game_pk % 5 <> 0)", "v_games", "v_pitches")
def without_pitches(g, p):
    return quality.without_pitches(g, p.where("game_pk % 5 <> 0"))


@register(f"WITH s AS ({SCHEDULE_VIEW}) SELECT CAST(EXTRACT(YEAR FROM game_date) AS INT) AS season, COUNT(*) AS games FROM s WHERE {PLAYED} GROUP BY 1", "v_games")
def played(g):
    return quality.played(_schedule(g)[0]).groupBy(F.year("game_date").alias("season")).agg(F.count(F.lit(1)).alias("games"))


@register(
    """SELECT * FROM (SELECT game_pk, pitches, at_bats, CASE WHEN pitches = 0 THEN 'no_pitches' WHEN pitches < 4 THEN 'few_pitches' WHEN at_bats = 0 THEN 'no_at_bats' END AS issue
FROM (SELECT game_pk, COALESCE(p.n, 0) AS pitches, COALESCE(a.n, 0) AS at_bats FROM v_games LEFT JOIN (SELECT game_pk, COUNT(*) AS n FROM v_pitches GROUP BY 1) p USING (game_pk)
  LEFT JOIN (SELECT game_pk, COUNT(*) AS n FROM v_at_bats GROUP BY 1) a USING (game_pk) WHERE status = 'Final') x) y WHERE issue IS NOT NULL""",
    "v_games", "v_pitches", "v_at_bats",
)
def completeness(g, p, ab):
    return quality.completeness(g, p, ab, few=4)


@register("SELECT game_pk FROM v_games WHERE game_pk NOT IN (SELECT game_pk FROM v_pitches)", "v_games", "v_pitches")
def coverage_missing(g, p):
    return quality.missing_games(g, p)


@register("SELECT g.game_pk, w.status FROM v_games g JOIN (SELECT game_pk, CASE WHEN is_indoor THEN 'Live' ELSE 'Final' END AS status FROM v_weather) w USING (game_pk) WHERE g.status = 'Final' AND w.status <> 'Final'", "v_games", "v_weather")
def coverage_stale(g, w):
    stored = w.select("game_pk", F.when(F.col("is_indoor"), "Live").otherwise("Final").alias("status"))
    return quality.stale_games(g, stored)


@register("SELECT season, status, COUNT(*) AS games FROM v_games GROUP BY 1, 2", "v_games")
def schedule_counts(g):
    return quality.schedule_counts(g, "season", "status")


@register(
    f"SELECT {KEYS}, event_id FROM v_pitches WHERE game_pk IN (SELECT game_pk FROM v_games WHERE status = 'Final' AND game_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31')",
    "v_pitches", "v_games",
)
def final_game_facts(p, g):
    return quality.final_game_facts(p, g, "1995-01-01", "1995-12-31").select(*KEY, "event_id")


@register(f"SELECT {KEYS}, event_id FROM v_pitches WHERE game_pk IN (SELECT game_pk FROM v_games WHERE status = 'Final')", "v_pitches", "v_games")
def final_game_facts_all(p, g):
    return quality.final_game_facts(p, g).select(*KEY, "event_id")


@register(
    f"SELECT {KEYS}, event_id FROM v_pitches WHERE game_pk IN (SELECT game_pk FROM v_games WHERE status = 'Final' AND season = 1995 AND home_score > 7)", "v_pitches", "v_games"
)
def final_facts_of_folders(p, g):
    """Facts are stored by date first; then the dates of the chosen games prune the folders."""
    folder = scratch.scratch_folder(p.sparkSession, "facts")
    tables.replace_partitions(_dated(p, g).select(*KEY, "event_id", "game_date"), folder, "game_date", KEY)
    facts = p.sparkSession.read.parquet(folder)
    return scratch.settled(quality.final_game_facts(facts, g.where("season = 1995 AND home_score > 7")).select(*KEY, "event_id"), folder)


@register("SELECT game_pk FROM v_weather WHERE game_pk NOT IN (SELECT game_pk FROM v_games WHERE status = 'Final')", "v_weather", "v_games")
def not_loaded(w, g):
    return quality.missing_games(w, g.where("status = 'Final'"))


@register("SELECT DISTINCT venue_id FROM v_games WHERE venue_id IS NOT NULL", "v_games")
def venue_ids(g):
    return quality.venue_ids(g)


@register(
    """SELECT user_id, event_id, old_state, event_type AS new_state FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_state FROM events) x
WHERE old_state IS NOT NULL AND old_state <> event_type""",
    "events",
)
def state_transitions(e):
    old = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select("user_id", "event_id", old.alias("old_state"), F.col("event_type").alias("new_state")).where("old_state <> new_state")


@register(
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1",
    "events",
)
def upsert_latest(e):
    return tables.latest(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")
