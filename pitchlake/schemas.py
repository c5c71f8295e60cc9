"""Schemas of feeds and tables."""

from __future__ import annotations

from pyspark.sql import types as T

GAME_DATA = """STRUCT<status: STRUCT<abstractGameState: STRING>, venue: STRUCT<id: BIGINT, name: STRING>, datetime: STRUCT<dateTime: STRING>,
  weather: STRUCT<condition: STRING, temp: STRING, wind: STRING>>"""
LINESCORE = "STRUCT<teams: STRUCT<home: STRUCT<runs: INT>, away: STRUCT<runs: INT>>>"
PLAY = """STRUCT<
    about: STRUCT<atBatIndex: INT, inning: INT, isTopInning: BOOLEAN, isComplete: BOOLEAN, isScoringPlay: BOOLEAN, startTime: STRING, endTime: STRING>,
    matchup: STRUCT<pitcher: STRUCT<id: BIGINT, fullName: STRING>, batter: STRUCT<id: BIGINT, fullName: STRING>>,
    result: STRUCT<event: STRING, eventType: STRING, description: STRING, rbi: INT, awayScore: INT, homeScore: INT>,
    playEvents: ARRAY<STRUCT<
      isPitch: BOOLEAN, startTime: STRING, endTime: STRING,
      details: STRUCT<call: STRUCT<code: STRING, description: STRING>, type: STRUCT<code: STRING>, isInPlay: BOOLEAN, isStrike: BOOLEAN, isBall: BOOLEAN>,
      count: STRUCT<balls: INT, strikes: INT, outs: INT>,
      pitchData: STRUCT<startSpeed: DOUBLE, endSpeed: DOUBLE, zone: INT,
        breaks: STRUCT<spinRate: DOUBLE, spinDirection: DOUBLE, breakAngle: DOUBLE, breakLength: DOUBLE>,
        coordinates: STRUCT<pfxX: DOUBLE, pfxZ: DOUBLE, pX: DOUBLE, pZ: DOUBLE>>,
      hitData: STRUCT<launchSpeed: DOUBLE, launchAngle: DOUBLE, totalDistance: DOUBLE, trajectory: STRING>>>>"""
#: A game feed as it lands, one JSON document for each snapshot.
FEED = f"""gamePk BIGINT, gameData {GAME_DATA}, liveData STRUCT<linescore: {LINESCORE}, plays: STRUCT<allPlays: ARRAY<{PLAY}>>>, _corrupt_record STRING"""
SCHEDULE = """
dates ARRAY<STRUCT<games: ARRAY<STRUCT<gamePk: BIGINT, gameType: STRING, season: STRING, gameDate: STRING,
  status: STRUCT<abstractGameState: STRING, detailedState: STRING>,
  teams: STRUCT<away: STRUCT<team: STRUCT<id: INT, name: STRING>, score: INT>, home: STRUCT<team: STRUCT<id: INT, name: STRING>, score: INT>>,
  venue: STRUCT<name: STRING>>>>>
"""
VENUE = """
id INT, name STRING, location STRUCT<city: STRING, state: STRING, stateAbbrev: STRING, country: STRING, defaultCoordinates: STRUCT<latitude: DOUBLE, longitude: DOUBLE>,
  elevation: DOUBLE, azimuthAngle: DOUBLE>, fieldInfo STRUCT<roofType: STRING, turfType: STRING, capacity: INT>
"""
TEAM = "id INT, name STRING, abbreviation STRING, league STRUCT<name: STRING>, division STRUCT<name: STRING>, venue STRUCT<name: STRING>"
#: Hourly weather of a place: parallel arrays; one that was not asked for is missing.
HOURLY = """venue_id BIGINT, hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, apparent_temperature: ARRAY<DOUBLE>, relative_humidity_2m: ARRAY<DOUBLE>,
  precipitation: ARRAY<DOUBLE>, wind_speed_10m: ARRAY<DOUBLE>, wind_gusts_10m: ARRAY<DOUBLE>, wind_direction_10m: ARRAY<DOUBLE>, cloud_cover: ARRAY<DOUBLE>,
  pressure_msl: ARRAY<DOUBLE>, weather_code: ARRAY<INT>>, _corrupt_record STRING"""
KEY = ("game_pk", "at_bat_index", "pitch_number")


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
