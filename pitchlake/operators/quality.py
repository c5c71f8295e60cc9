"""Data-quality rules and coverage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.numeric import rounded

ROWS = "*"
#: Detailed states of games that were not played to the end.
NOT_PLAYED = ("Postponed", "Cancelled", "Suspended")
NULL_COLUMNS, NULL_LIMIT, FEW_PITCHES = ("pitch_type", "start_speed", "plate_x", "plate_z"), 0.1, 200


def quality_report(pitches: DataFrame) -> DataFrame:
    """One row for each rule: rule, violations, total, pct, status.  All rules are
    counted in one pass; an empty table gives no rows."""
    speed, x, z, spin = (F.col(c) for c in ("start_speed", "plate_x", "plate_z", "spin_rate"))
    rules = {
        "speed_range": (speed < 40) | (speed > 110),
        "location_range": (F.abs(x) > 3) | (z < -1) | (z > 6),
        "spin_range": (spin < 0) | (spin > 4000),
    }
    rules["location_range"] = x.isNotNull() & rules["location_range"]
    nulls = {f"null_{c}": F.col(c).isNull() for c in NULL_COLUMNS}
    counts = pitches.agg(F.count(ROWS).alias("total"), *(F.count_if(r).alias(n) for n, r in (rules | nulls).items()))
    pairs = ", ".join(f"'{n}', {n}" for n in rules | nulls)
    long = counts.where("total > 0").selectExpr("total", f"stack({len(rules | nulls)}, {pairs}) AS (rule, violations)")
    share = F.col("violations").cast("double") / F.col("total")
    bad = F.when(F.col("rule").startswith("null_"), share > NULL_LIMIT).otherwise(F.col("violations") > 0)
    return long.select("rule", "violations", "total", rounded(share * 100.0, 2).alias("pct"), F.when(bad, "fail").otherwise("pass").alias("status"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(ROWS).alias("rows")).where("rows > 1")


def row_counts(df: DataFrame, key: str = "game_pk", name: str = "rows") -> DataFrame:
    return df.groupBy(key).agg(F.count(ROWS).alias(name))


def completeness(games: DataFrame, pitches: DataFrame, at_bats: DataFrame, few: int = FEW_PITCHES) -> DataFrame:
    """Final games whose events are missing or too few."""
    final = games.where("status = 'Final'").select("game_pk")
    df = final.join(row_counts(pitches, name="pitches"), "game_pk", "left").join(row_counts(at_bats, name="at_bats"), "game_pk", "left").na.fill(0)
    issue = F.when(F.col("pitches") == 0, "no_pitches").when(F.col("pitches") < few, "few_pitches").when(F.col("at_bats") == 0, "no_at_bats")
    return df.withColumn("issue", issue).where("issue is not null")


def missing_games(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected games that are not stored (also: games not loaded yet)."""
    return expected.select("game_pk").distinct().join(stored.select("game_pk"), "game_pk", "left_anti")


def stale_games(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Games that the schedule has as final and the store has not."""
    final = expected.where("status = 'Final'").select("game_pk")
    return stored.where("status <> 'Final'").select("game_pk", "status").join(final, "game_pk", "left_semi")


def without_pitches(stored: DataFrame, pitches: DataFrame) -> DataFrame:
    return stored.select("game_pk").join(pitches.select("game_pk"), "game_pk", "left_anti")


def coverage_report(schedule: DataFrame, stored: DataFrame, pitches: DataFrame) -> DataFrame:
    """measure, games: how the store covers a schedule.  Scheduled games by what
    became of them, stored ones, and played ones that are missing, without pitches
    or not final in the store; one pass over each table."""
    detailed = F.coalesce("detailed_state", F.lit(""))
    off = detailed.isin(*NOT_PLAYED)
    became = F.when(off, detailed).when(F.col("status") == "Final", F.lit("played")).otherwise(F.col("status"))
    expected = schedule.groupBy("game_pk").agg(F.min(became).alias("became"), F.max(became == "played").alias("is_played"))
    kept = stored.groupBy("game_pk").agg(F.min("status").alias("stored"), F.lit(True).alias("is_stored"))
    rows = expected.join(kept, "game_pk", "full").join(row_counts(pitches, name="pitches"), "game_pk", "left")
    there, final = F.col("is_stored").isNotNull(), F.coalesce("is_played", F.lit(False))
    measures = F.array(
        F.when(F.col("became").isNotNull(), F.lit("scheduled")), F.when(F.col("became").isNotNull(), F.concat(F.lit("scheduled_"), F.lower("became"))),
        F.when(there, F.lit("stored")), F.when(final & ~there, F.lit("missing")),
        F.when(final & there & F.col("pitches").isNull(), F.lit("without_pitches")), F.when(final & there & (F.col("stored") != "Final"), F.lit("stale")),
    )
    return rows.select(F.explode(F.array_compact(measures)).alias("measure")).groupBy("measure").agg(F.count(ROWS).alias("games"))


def first_ids(df: DataFrame, key: str = "game_pk", most: int = 20) -> DataFrame:
    """The least ids, for a report."""
    return df.select(key).distinct().orderBy(key).limit(most)


def venue_ids(games: DataFrame) -> DataFrame:
    """Venues that games refer to."""
    return games.select("venue_id").where("venue_id IS NOT NULL").distinct()


def schedule_counts(schedule: DataFrame, *keys: str) -> DataFrame:
    return schedule.groupBy(*keys).agg(F.count(ROWS).alias("games"))


def played(schedule: DataFrame) -> DataFrame:
    return schedule.where((F.col("status") == "Final") & ~F.coalesce("detailed_state", F.lit("")).isin(*NOT_PLAYED))


def final_game_facts(facts: DataFrame, games: DataFrame, start=None, end=None) -> DataFrame:
    """Facts of final games, of a range of dates if one is given.  Facts that carry the
    date of their game, as stored ones do by folder, are matched on it too: a range bounds
    the folders when planning, and the dates found in ``games`` when running."""
    wanted = games.where("status = 'Final'")
    within = lambda df: df.where(F.col("game_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    dated = "game_date" in facts.columns
    if start is not None:
        wanted, facts = within(wanted), within(facts) if dated else facts
    keys = ["game_date", "game_pk"] if dated else ["game_pk"]
    return facts.join(wanted.select(*keys), keys, "left_semi")
