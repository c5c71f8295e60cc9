"""Per-game, per-day and rolling aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitchlake.functions.baseball import COUNTED_TYPES, FASTBALLS, is_at_bat, is_event, is_hit, is_whiff
from pitchlake.functions.numeric import plain_max, ratio, rounded_avg, total

ROWS = "*"


def pitcher_game(pitches: DataFrame) -> DataFrame:
    kind = F.col("pitch_type")
    per_type = [F.count_if(kind == t).alias(f"{t.lower()}_count") for t in COUNTED_TYPES]
    return pitches.groupBy("game_pk", "pitcher_id", "pitcher_name").agg(
        F.count(ROWS).alias("total_pitches"),
        F.count_if("is_strike").alias("strikes"),
        F.count_if("is_ball").alias("balls"),
        F.count_if(is_whiff()).alias("whiffs"),
        (F.count_if("is_strike").cast("double") / F.count(ROWS) * 100.0).alias("strike_pct"),
        rounded_avg(F.when(kind.isin(*FASTBALLS), F.col("start_speed")), 6).alias("avg_fastball_speed"),
        plain_max(F.col("start_speed")).alias("max_speed"),
        F.count_distinct(F.struct("inning", "half_inning")).cast("double").alias("innings_pitched_approx"),
        *per_type,
        F.count_if(~kind.isin(*COUNTED_TYPES)).alias("other_type_count"),
    )


def _batting() -> list[Column]:
    return [
        F.count(ROWS).alias("plate_appearances"),
        F.count_if(is_at_bat()).alias("at_bats_count"),
        F.count_if(is_hit()).alias("hits"),
        F.count_if(is_event("double")).alias("doubles"),
        F.count_if(is_event("triple")).alias("triples"),
        F.count_if(is_event("home_run")).alias("home_runs"),
        total(F.col("rbi")).alias("rbi"),
        F.count_if(is_event("strikeout")).alias("strikeouts"),
        F.count_if(is_event("walk")).alias("walks"),
    ]


def batter_game(at_bats: DataFrame) -> DataFrame:
    df = at_bats.groupBy("game_pk", "batter_id", "batter_name").agg(*_batting())
    return df.withColumn("batting_avg", ratio(F.col("hits"), F.col("at_bats_count")))


def team_game(at_bats: DataFrame) -> DataFrame:
    return at_bats.groupBy("game_pk", "half_inning").agg(
        F.count_if(is_hit()).alias("total_hits"),
        total(F.col("rbi")).alias("total_rbi"),
        F.count_if("is_scoring_play").alias("total_scoring_plays"),
        F.count_if(is_event("strikeout")).alias("total_strikeouts"),
        F.count_if(is_event("walk")).alias("total_walks"),
        F.count_if(is_event("home_run")).alias("total_home_runs"),
        total(F.col("rbi")).alias("total_runs"),
    )


def batter_day(at_bats: DataFrame) -> DataFrame:
    """at_bats carry game_date."""
    by = at_bats.groupBy(F.col("batter_id").alias("player_id"), F.col("game_date").alias("stat_date"))
    return by.agg(F.count_distinct("game_pk").alias("games"), *_batting())


def pitcher_day(pitches: DataFrame) -> DataFrame:
    """pitches carry game_date."""
    by = pitches.groupBy(F.col("pitcher_id").alias("player_id"), F.col("game_date").alias("stat_date"))
    return by.agg(F.count(ROWS).alias("pitches_thrown"), F.count_if("is_strike").alias("strikes"))


def rolling_player(daily: DataFrame, window: int = 15) -> DataFrame:
    """Rates over a player's last ``window`` rows (not days), by date."""
    span = W.partitionBy("player_id").orderBy("stat_date").rowsBetween(1 - window, 0)
    hits, ab, k, bb, pa = (F.sum(c).over(span) for c in ("hits", "at_bats_count", "strikeouts", "walks", "plate_appearances"))
    return daily.withColumns({
        "rolling_avg": ratio(hits, ab),
        "rolling_k_rate": ratio(k, pa),
        "rolling_bb_rate": ratio(bb, pa),
        "rolling_ops_approx": ratio(hits + bb, ab + bb) + ratio(hits, ab),
    })


def game_summary(games: DataFrame, pitches: DataFrame, at_bats: DataFrame) -> DataFrame:
    """One row for each game; totals are null where a game has no events, the
    winner is null on a tie."""
    thrown = pitches.groupBy("game_pk").agg(F.count(ROWS).alias("total_pitches"))
    batted = at_bats.groupBy("game_pk").agg(
        F.count(ROWS).alias("total_at_bats"),
        F.count_if(is_hit()).alias("total_hits"),
        F.count_if(is_event("home_run")).alias("total_home_runs"),
        F.count_if(is_event("strikeout")).alias("total_strikeouts"),
    )
    home, away = F.col("home_score"), F.col("away_score")
    named = games.select("game_pk", "game_date", F.col("away_team_name").alias("away_team"), F.col("home_team_name").alias("home_team"), "away_score", "home_score")
    return named.join(thrown, "game_pk", "left").join(batted, "game_pk", "left").withColumns({
        "winner": F.when(home > away, F.col("home_team")).when(away > home, F.col("away_team")),
        "game_duration_pitches": F.col("total_pitches"),
    })
