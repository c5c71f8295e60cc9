"""Views that give the star schema of the test tables the shape of games, pitches,
at-bats, venues and weather.  The same SQL runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_games": """
SELECT o_orderkey AS game_pk, CAST(o_orderdate AS DATE) AS game_date, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS season,
  CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Live' ELSE 'Preview' END AS status,
  CAST(o_custkey % 25 AS INT) AS away_team_id, a.n_name AS away_team_name,
  CAST((o_custkey + 1 + o_orderkey % 24) % 25 AS INT) AS home_team_id, h.n_name AS home_team_name,
  CAST(FLOOR(o_totalprice) AS BIGINT) % 10 AS away_score, CAST(FLOOR(o_totalprice / 10) AS BIGINT) % 10 AS home_score,
  CASE WHEN o_orderstatus = 'F' THEN (CAST(FLOOR(o_totalprice / 10) AS BIGINT) % 10) > (CAST(FLOOR(o_totalprice) AS BIGINT) % 10) END AS home_team_won,
  o_custkey % 12 AS venue_id
FROM orders JOIN nation a ON a.n_nationkey = o_custkey % 25 JOIN nation h ON h.n_nationkey = (o_custkey + 1 + o_orderkey % 24) % 25""",
    "v_pitches": """
WITH s AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey, l_partkey, l_linenumber, l_shipdate, l_extendedprice) AS seq FROM lineitem),
t AS (SELECT *, CAST(FLOOR((seq - 1) / 3.0) AS INT) AS at_bat_index, CAST((seq - 1) % 3 + 1 AS INT) AS pitch_number FROM s)
SELECT l_orderkey AS game_pk, at_bat_index, pitch_number,
  CONCAT(CAST(l_orderkey AS VARCHAR(20)), '_', CAST(at_bat_index AS VARCHAR(20)), '_', CAST(pitch_number AS VARCHAR(20))) AS event_id,
  CAST(1 + (l_orderkey + at_bat_index) % 9 AS INT) AS inning, CASE WHEN at_bat_index % 2 = 0 THEN 'top' ELSE 'bottom' END AS half_inning,
  1000 + l_orderkey % 20 AS pitcher_id, CONCAT('P', CAST(1000 + l_orderkey % 20 AS VARCHAR(20))) AS pitcher_name,
  2000 + (l_orderkey * 7 + at_bat_index) % 40 AS batter_id,
  CASE l_linenumber WHEN 1 THEN 'FF' WHEN 2 THEN 'SI' WHEN 3 THEN 'SL' WHEN 4 THEN 'CU' WHEN 5 THEN 'CH' WHEN 6 THEN 'KC' END AS pitch_type,
  CASE WHEN l_partkey % 17 <> 0 THEN 70 + l_quantity * 0.6 END AS start_speed,
  CASE WHEN l_partkey % 13 <> 0 THEN (l_discount * 100 - 5) / 3 END AS plate_x,
  CASE WHEN l_partkey % 11 <> 0 THEN l_tax * 60 + 0.0 END AS plate_z,
  CASE WHEN l_partkey % 19 <> 0 THEN 1800 + l_quantity * 20 END AS spin_rate, CAST(l_partkey % 15 AS INT) AS zone,
  CASE l_returnflag WHEN 'R' THEN 'S' WHEN 'A' THEN 'B' ELSE 'X' END AS call_code,
  (l_returnflag = 'N') AS is_in_play, (l_returnflag = 'R') AS is_strike, (l_returnflag = 'A') AS is_ball,
  CAST(seq % 4 AS INT) AS balls, CAST(l_linenumber % 3 AS INT) AS strikes,
  (l_partkey % 2 = 0) AS runner_on_first, (l_suppkey % 3 = 0) AS runner_on_second, (l_partkey % 5 = 0) AS runner_on_third,
  CAST(seq % 5 AS INT) AS away_score, CAST(l_linenumber % 5 AS INT) AS home_score, l_partkey, l_suppkey
FROM t""",
    "v_at_bats": """
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY game_pk, at_bat_index ORDER BY pitch_number DESC) AS rn,
  COUNT(*) OVER (PARTITION BY game_pk, at_bat_index) AS pitch_count FROM v_pitches)
SELECT game_pk, at_bat_index, inning, half_inning, pitcher_id, batter_id, CONCAT('P', CAST(batter_id AS VARCHAR(20))) AS batter_name, pitch_count,
  CASE l_partkey % 8 WHEN 0 THEN 'single' WHEN 1 THEN 'double' WHEN 2 THEN 'triple' WHEN 3 THEN 'home_run'
    WHEN 4 THEN 'strikeout' WHEN 5 THEN 'walk' WHEN 6 THEN 'field_out' ELSE 'sac_fly' END AS event_type,
  CASE WHEN l_partkey % 8 < 4 THEN l_suppkey % 4 ELSE 0 END AS rbi, (l_partkey % 8 < 4 AND l_suppkey % 4 > 0) AS is_scoring_play
FROM r WHERE rn = 1""",
    "v_venues": """
SELECT s_suppkey AS venue_id, s_name AS name, CAST(s_suppkey * 37 % 360 AS DOUBLE) AS azimuth_angle, s_acctbal AS elevation_ft,
  CASE s_suppkey % 4 WHEN 0 THEN 'Dome' WHEN 1 THEN 'Retractable' ELSE 'Open' END AS roof_type
FROM supplier WHERE s_suppkey < 10""",
    "v_weather": """
SELECT o_orderkey AS game_pk, o_custkey % 12 AS venue_id, (o_custkey % 4 = 0) AS is_indoor,
  CASE WHEN o_orderkey % 7 = 0 THEN TRUE WHEN o_orderkey % 7 = 1 THEN FALSE END AS roof_closed,
  CASE WHEN o_orderkey % 9 <> 0 THEN 30 + o_totalprice / 8000 END AS temperature_f,
  CAST(o_custkey % 25 AS DOUBLE) AS wind_speed_mph, CAST(o_orderkey * 13 % 360 AS DOUBLE) AS wind_direction_deg,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 10 AS DOUBLE) / 50 END AS precipitation_in,
  CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_custkey * 7 % 100 AS DOUBLE) END AS relative_humidity_pct
FROM orders""",
}
TABLES = ("orders", "lineitem", "nation", "supplier", "events")
NEEDS = {"v_at_bats": ("v_pitches",)}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views (or ``events``) over the tables of a folder."""
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    if name in TABLES:
        return spark.table(name)
    for other in NEEDS.get(name, ()):
        view(spark, sf_dir, other).createOrReplaceTempView(other)
    return spark.sql(VIEWS[name])


def with_views(sql: str, *names: str) -> str:
    """SQL with the views it needs as common table expressions."""
    wanted = dict.fromkeys(x for name in names for x in (*NEEDS.get(name, ()), name))
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in wanted)
    sql = sql.strip()
    return f"WITH {views},\n{sql[4:].lstrip()}" if sql[:5].upper() == "WITH " else f"WITH {views}\n{sql}"
