"""Weather features of games."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Roofs that count as indoor, the columns a model reads, readings.
INDOOR_ROOFS = ("Dome", "Indoor", "Closed")
MODEL_COLUMNS = (
    "game_pk", "is_indoor_or_closed", "effective_temperature_f", "effective_wind_speed_mph", "effective_wind_out_to_cf_mph",
    "effective_wind_cross_mph", "effective_precipitation_in", "elevation_ft", "relative_humidity_pct",
)
READINGS = {
    "temperature_2m": "temperature_f", "apparent_temperature": "feels_like_f", "relative_humidity_2m": "relative_humidity_pct",
    "precipitation": "precipitation_in", "wind_speed_10m": "wind_speed_mph", "wind_gusts_10m": "wind_gust_mph", "wind_direction_10m": "wind_direction_deg",
    "cloud_cover": "cloud_cover_pct", "pressure_msl": "pressure_hpa", "weather_code": "weather_code",
}
SOURCE = "open-meteo"


def is_indoor(roof: Column) -> Column:
    return F.trim(F.coalesce(roof, F.lit(""))).isin(*INDOOR_ROOFS)


def add_indoor_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_indoor_or_closed", F.col("is_indoor") | F.coalesce("roof_closed", F.lit(False)))


def add_wind_components(df: DataFrame) -> DataFrame:
    """Wind along and across the line to centre field.  The direction is where the
    wind comes from, so a positive cross component blows toward left field."""
    turn = (F.col("wind_direction_deg") - F.col("azimuth_angle")) * F.lit(math.pi) / 180.0
    return df.withColumns({"wind_out_to_cf_mph": -F.col("wind_speed_mph") * F.cos(turn), "wind_cross_mph": F.col("wind_speed_mph") * F.sin(turn)})


def add_temperature_features(df: DataFrame) -> DataFrame:
    """A null temperature has a null band."""
    t = F.col("temperature_f")
    band = F.when(t < 50, "cold").when(t < 65, "cool").when(t < 80, "mild").when(t < 90, "warm").when(t.isNotNull(), "hot")
    return df.withColumns({"temp_band": band, "is_wet": F.coalesce("precipitation_in", F.lit(0.0)) > 0.05})


def neutralize_indoor(df: DataFrame) -> DataFrame:
    """Columns as the players feel them: fixed values under a roof."""
    neutral = {"temperature_f": 72.0, "wind_speed_mph": 0.0, "wind_out_to_cf_mph": 0.0, "wind_cross_mph": 0.0, "precipitation_in": 0.0}
    raw = {c: F.coalesce(c, F.lit(0.0)) if c == "precipitation_in" else F.col(c) for c in neutral}
    return df.withColumns({f"effective_{c}": F.when(F.col("is_indoor_or_closed"), v).otherwise(raw[c]) for c, v in neutral.items()})


def weather_frame(weather: DataFrame, games: DataFrame, venues: DataFrame) -> DataFrame:
    """Weather of games with the date of the game and the lie of its venue."""
    dated = weather.join(games.select("game_pk", "game_date"), "game_pk")
    return dated.join(venues.select("venue_id", "azimuth_angle", "elevation_ft"), "venue_id", "left")


def weather_features(weather: DataFrame, games: DataFrame, venues: DataFrame) -> DataFrame:
    steps = (add_indoor_flag, add_wind_components, add_temperature_features, neutralize_indoor)
    df = weather_frame(weather, games, venues)
    for step in steps:
        df = df.transform(step)
    return df


def model_columns(features: DataFrame) -> DataFrame:
    """The columns that models are fitted on; one that is not there is an error."""
    return features.select(*MODEL_COLUMNS)


def hourly_rows(payloads: DataFrame) -> DataFrame:
    """venue_id and ``hourly`` (a struct of arrays keyed by time) to one row an hour.
    A reading that a payload lacks, as a field, an array or an hour of it, is null."""
    there = payloads.schema["hourly"].dataType.names
    array = lambda c: F.coalesce(F.col(f"hourly.{c}"), F.array()) if c in there else F.array(F.lit(None).cast("double"))
    zipped = F.arrays_zip(F.col("hourly.time").alias("time"), *(array(c).alias(c) for c in READINGS))
    rows = payloads.select("venue_id", F.explode(zipped).alias("h")).where("h.time is not null")
    value = lambda c: F.col(f"h.{c}").cast("int" if c == "weather_code" else "double")
    return rows.select("venue_id", F.to_timestamp_ntz("h.time").alias("hour"), *(value(c).alias(name) for c, name in READINGS.items()))


def weather_rows(games: DataFrame, venues: DataFrame, hours: DataFrame, source: str = SOURCE) -> DataFrame:
    """Each game's reading at the hour of its first pitch; indoor games, and games
    without a reading, have keys only."""
    hour = F.date_trunc("hour", "first_pitch_time_utc").cast("timestamp_ntz")
    placed = games.join(venues.select("venue_id", "roof_type"), "venue_id", "left").withColumns({"hour": hour, "is_indoor": is_indoor(F.col("roof_type"))})
    joined = placed.join(hours, ["venue_id", "hour"], "left")
    readings = [F.when(~F.col("is_indoor"), F.col(c)).alias(c) for c in READINGS.values()]
    return joined.select("game_pk", "venue_id", F.col("hour").alias("observation_time_utc"), "is_indoor", *readings, F.lit(source).alias("source"))


def feed_conditions(feeds: DataFrame) -> DataFrame:
    """Condition, temperature, wind and roof from a feed's own weather block."""
    w = F.col("gameData.weather")
    lower = F.lower(w["condition"])
    closed = F.when(lower.contains("roof closed") | lower.contains("dome"), True)
    return feeds.select(
        F.col("gamePk").alias("game_pk"), w["condition"].alias("mlb_condition"), w["temp"].try_cast("double").alias("mlb_temp_f"),
        w["wind"].alias("mlb_wind_text"), closed.alias("roof_closed"),
    )


def weather_routing(games: DataFrame, venues: DataFrame) -> DataFrame:
    """How many games can be looked up, and why the others can't.  ``venues`` have
    azimuth_angle standing for known coordinates; games may carry a first pitch."""
    known = games.join(venues.select("venue_id", "roof_type", F.col("azimuth_angle").alias("place")), "venue_id", "left")
    route = (
        F.when(F.col("place").isNull(), "no_venue").when(F.col("first_pitch").isNull(), "no_first_pitch").when(is_indoor(F.col("roof_type")), "indoor").otherwise("fetch")
    )
    return known.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("games"))
