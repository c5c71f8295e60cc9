"""Pitch-level features.  Each function takes and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Limits of the strike zone in feet.
X_INNER, X_OUTER, Z_LOW, Z_HIGH, Z_MID_LOW, Z_MID_HIGH, CHASE = 0.28, 0.83, 1.5, 3.5, 2.17, 2.83, 0.5


def pitch_sequence(pitches: DataFrame) -> DataFrame:
    """Previous pitch type and speed, speed difference and running number, within
    the at-bat: one shuffle on its key and one window."""
    order = W.partitionBy("game_pk", "at_bat_index").orderBy("pitch_number")
    return pitches.withColumns({
        "prev_pitch_type": F.lag("pitch_type").over(order),
        "prev_speed": F.lag("start_speed").over(order),
        "pitch_number_in_ab": F.row_number().over(order).cast("int"),
    }).withColumn("speed_diff", F.col("start_speed") - F.col("prev_speed"))


def zone_features(pitches: DataFrame) -> DataFrame:
    """Where the pitch crossed the plate; null coordinates give null regions."""
    x, z = F.abs("plate_x"), F.col("plate_z")
    inside = (x <= X_OUTER) & z.between(Z_LOW, Z_HIGH)
    missing = F.col("plate_x").isNull() | F.col("plate_z").isNull()
    region = (
        F.when(missing, F.lit(None).cast("string"))
        .when((x <= X_INNER) & z.between(Z_MID_LOW, Z_MID_HIGH), "heart")
        .when(inside, "edge")
        .when((x <= X_OUTER + CHASE) & z.between(Z_LOW - CHASE, Z_HIGH + CHASE), "chase")
        .otherwise("waste")
    )
    across = F.when(x <= X_INNER, "middle").when(F.col("plate_x") < -X_INNER, "inside").when(F.col("plate_x").isNotNull(), "outside")
    height = F.when(z >= Z_MID_HIGH, "high").when(z <= Z_MID_LOW, "low").when(z.isNotNull(), "middle")
    return pitches.withColumns({"is_in_zone": inside, "zone_region": region, "horizontal_location": across, "vertical_location": height})


def game_context(pitches: DataFrame) -> DataFrame:
    """Score, runners and leverage when the pitch was thrown."""
    first, second, third = (F.col(f"runner_on_{b}").cast("int") for b in ("first", "second", "third"))
    diff = F.col("home_score") - F.col("away_score")
    close, runners = F.abs(diff) <= 2, first + second + third
    scoring = F.col("runner_on_second") | F.col("runner_on_third")
    leverage = F.when(close & (F.col("inning") >= 7) & scoring, "high").when(close | (runners > 0), "medium").otherwise("low")
    return pitches.withColumns({
        "score_diff": diff, "is_close_game": close, "base_state": first + 2 * second + 4 * third,
        "runners_on_base": runners, "is_scoring_position": scoring, "leverage_bucket": leverage,
    })


def count_features(pitches: DataFrame) -> DataFrame:
    balls, strikes = F.col("balls"), F.col("strikes")
    return pitches.withColumns({
        "is_first_pitch": F.col("pitch_number") == 1,
        "is_full_count": (balls == 3) & (strikes == 2),
        "is_hitter_count": balls > strikes,
        "is_pitcher_count": strikes > balls,
        "count_label": F.concat(balls.cast("string"), F.lit("-"), strikes.cast("string")),
    })


def enrich_pitches(pitches: DataFrame) -> DataFrame:
    """All pitch features, in one pass and one shuffle."""
    return pitches.transform(pitch_sequence).transform(zone_features).transform(game_context).transform(count_features)
