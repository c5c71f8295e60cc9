"""Analytical questions, for one entity and in bulk for all of them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitchlake.functions.baseball import bases, is_at_bat, is_event, is_hit, is_whiff
from pitchlake.functions.dates import season_start
from pitchlake.functions.numeric import ratio, rounded, rounded_avg

ROWS = "*"


def arsenal_all(pitches: DataFrame, start=None, end=None) -> DataFrame:
    """Pitch mix of every pitcher; an inclusive range of game_date may bound it."""
    if start is not None:
        pitches = pitches.where(F.col("game_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    n = F.count(ROWS)
    mix = pitches.groupBy("pitcher_id", "pitch_type").agg(
        n.alias("count"),
        rounded_avg(F.col("start_speed"), 1).alias("avg_speed"),
        rounded_avg(F.col("spin_rate"), 0).alias("avg_spin_rate"),
        (rounded_avg(F.col("plate_x"), 3) + 0.0).alias("avg_plate_x"),
        (rounded_avg(F.col("plate_z"), 3) + 0.0).alias("avg_plate_z"),
        rounded(F.count_if(is_whiff()).cast("double") / n, 3).alias("whiff_rate"),
        rounded(F.count_if(F.col("zone").between(1, 9)).cast("double") / n, 3).alias("zone_rate"),
    )
    whole = F.sum("count").over(W.partitionBy("pitcher_id"))
    return mix.withColumn("pct", rounded(F.col("count") * 100.0 / whole, 1))


def pitcher_arsenal(pitches: DataFrame, pitcher_id: int, start=None, end=None) -> DataFrame:
    """One pitcher's mix, most used first; the filter reaches the scan."""
    one = arsenal_all(pitches.where(F.col("pitcher_id") == pitcher_id), start, end)
    return one.drop("pitcher_id").orderBy(F.desc("count"), "pitch_type")


def _matchup_parts(pitches: DataFrame, at_bats: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    seen = F.array_join(F.array_sort(F.collect_set("pitch_type")), ", ")
    thrown = pitches.groupBy(*keys).agg(F.count(ROWS).alias("total_pitches"), F.nullif(seen, F.lit("")).alias("pitch_types_seen"))
    at = F.count(ROWS)
    when = lambda c: F.sum(F.when(c, 1).otherwise(0))
    batted = at_bats.groupBy(*keys).agg(
        at.alias("total_at_bats"),
        when(is_hit()).alias("hits"),
        when(is_event("strikeout")).alias("strikeouts"),
        when(is_event("walk")).alias("walks"),
        when(is_event("home_run")).alias("home_runs"),
        rounded(when(is_hit()).cast("double") / F.greatest(at, F.lit(1)), 3).alias("batting_avg"),
    )
    return thrown, batted


def matchup(pitches: DataFrame, at_bats: DataFrame, pitcher_id: int, batter_id: int) -> DataFrame:
    """Head to head; always one row."""
    pair = (F.col("pitcher_id") == pitcher_id) & (F.col("batter_id") == batter_id)
    thrown, batted = _matchup_parts(pitches.where(pair), at_bats.where(pair))
    return thrown.crossJoin(batted)  # two one-row aggregates


def matchup_all(pitches: DataFrame, at_bats: DataFrame) -> DataFrame:
    """All pairs; a pair may have pitches and no finished at-bat."""
    thrown, batted = _matchup_parts(pitches, at_bats, "pitcher_id", "batter_id")
    df = thrown.join(batted, ["pitcher_id", "batter_id"], "full")
    return df.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_pitches", "total_at_bats")})


def standings(games: DataFrame, season: int | None = None) -> DataFrame:
    """Final games: each counts once for either side, then one grouping."""
    games = games.where("status = 'Final'")
    keys = ["season", "team_name"]
    if season is not None:
        games, keys = games.where(F.col("season") == season), ["team_name"]

    def side(me: str, them: str, won: Column) -> DataFrame:
        return games.select(
            "season", F.col(f"{me}_team_name").alias("team_name"), won.alias("won"), F.col(f"{me}_score").alias("runs"), F.col(f"{them}_score").alias("against")
        )

    both = side("home", "away", F.col("home_team_won")).unionByName(side("away", "home", ~F.col("home_team_won")))
    n = both.groupBy(*keys).agg(
        F.count_if("won").alias("wins"), F.count_if(~F.col("won")).alias("losses"), F.sum("runs").alias("runs_scored"), F.sum("against").alias("runs_allowed")
    )
    return n.withColumns({
        "win_pct": rounded(F.col("wins").cast("double") / F.greatest(F.col("wins") + F.col("losses"), F.lit(1)), 3),
        "run_diff": F.col("runs_scored") - F.col("runs_allowed"),
    }).orderBy(*keys[:-1], F.desc("win_pct"), F.desc("run_diff"), "team_name")


def game_pace(pitches: DataFrame, game_pk: int | None = None) -> DataFrame:
    """Seconds between pitches for each half-inning; ``timestamp`` is needed."""
    keys = ["game_pk", "inning", "half_inning"]
    if game_pk is not None:
        pitches = pitches.where(F.col("game_pk") == game_pk)
    before = F.lag("timestamp").over(W.partitionBy(*keys).orderBy("at_bat_index", "pitch_number"))
    gap = F.timestamp_diff("MICROSECOND", F.col("before"), F.col("timestamp")) / 1e6
    return (
        pitches.withColumn("before", before)
        .groupBy(*keys)
        .agg(F.count(ROWS).alias("pitch_count"), rounded_avg(gap, 1).alias("avg_time_between_pitches"), F.count(ROWS).alias("total_pitches_in_inning"))
    )


def daily_leaders(pitches: DataFrame, at_bats: DataFrame, limit: int | None = None, game_date=None, by: tuple[str, ...] = ()) -> DataFrame:
    """Pitchers by strikeouts, then pitches: of the given rows, of one date
    (``game_date``), or of each value of ``by``, as ("game_date",), which both tables hold.
    A limit is kept in each group by a ranked window, whose rank Spark applies in every task
    before it shuffles."""
    if game_date is not None:
        pitches, at_bats = (df.where(F.col("game_date") == F.lit(game_date).cast("date")) for df in (pitches, at_bats))
    thrown = pitches.groupBy(*by, "pitcher_name", "pitcher_id", "game_pk").agg(
        F.count(ROWS).alias("total_pitches"), rounded_avg(F.col("start_speed"), 1).alias("avg_speed"), rounded(F.max("start_speed"), 1).alias("max_speed")
    )
    outs = at_bats.groupBy(*by, "pitcher_id", "game_pk").agg(F.count_if(is_event("strikeout")).alias("strikeouts"))
    df = thrown.join(outs, [*by, "pitcher_id", "game_pk"], "left").withColumn("strikeouts", F.coalesce("strikeouts", F.lit(0)))
    order = [F.desc("strikeouts"), F.desc("total_pitches"), F.asc("pitcher_id"), F.asc("game_pk")]
    if limit and by:
        df = df.withColumn("_rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= limit).drop("_rank")
        return df.orderBy(*by, *order)
    df = df.orderBy(*by, *order)
    return df.limit(limit) if limit else df


def season_batting(at_bats: DataFrame, min_at_bats: int = 50, strict_ab: bool = False, limit: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Batters by average, within each value of ``by``; ``at_bats`` counts all rows
    unless strict_ab."""
    n = F.count_if(is_at_bat()) if strict_ab else F.count(ROWS)
    df = at_bats.groupBy(*by, "batter_name", "batter_id").agg(
        F.count_distinct("game_pk").alias("games"),
        n.alias("at_bats"),
        F.count_if(is_hit()).alias("hits"),
        F.count_if(is_event("home_run")).alias("home_runs"),
        F.sum("rbi").cast("long").alias("rbi"),
        rounded(ratio(F.count_if(is_hit()), F.greatest(n, F.lit(1))), 3).alias("batting_avg"),
        rounded(ratio(F.sum(bases()), F.greatest(n, F.lit(1))), 3).alias("slug_pct_approx"),
    )
    df = df.where(F.col("at_bats") >= min_at_bats).orderBy(*by, F.desc("batting_avg"), "batter_id")
    return df.limit(limit) if limit else df


def season_batting_until(at_bats: DataFrame, day: date, **more) -> DataFrame:
    """``season_batting`` from the start of a day's season to the day; ``at_bats`` carry game_date."""
    return season_batting(at_bats.where(F.col("game_date").between(F.lit(season_start(day)), F.lit(day))), **more)
