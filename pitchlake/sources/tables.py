"""Partitioned tables on Parquet: typed reads, keyed upserts, compaction.

A write replaces whole partitions, as one change (see ``commits``): readers see all
of it or none, and a job that dies at any point leaves a table that is read as it
was before or after, and that the next write to it puts in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from pitchlake.functions.dates import previous_month, week_before
from pitchlake.operators.aggregates import batter_day
from pitchlake.operators.features import enrich_pitches
from pitchlake.operators.quality import final_game_facts
from pitchlake.sources import commits


def read_table(spark: SparkSession, path: str, schema: T.StructType, game_pk: int | None = None, game_date=None, dates: tuple | None = None) -> DataFrame:
    """Rows of a table, of one game, of one date or a range of them (only their
    folders are listed and read) or all; a table that is not there is an empty
    frame of the same type, any other failure is raised."""
    files, path = commits.Files(spark, path), path.rstrip("/")
    try:
        change = commits.pending(files, path)
        df = spark.read.schema(schema).parquet(path) if change is None else commits.read_through(spark, path, schema, files, change)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if game_date is not None:
        df = df.where(F.col("game_date") == F.lit(game_date).cast("date"))
    if dates is not None:
        df = df.where(F.col("game_date").between(*(F.lit(d).cast("date") for d in dates)))
    return df if game_pk is None else df.where(F.col("game_pk") == game_pk)


def latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The last row of each key.  The rank is limited to 1 before the shuffle too,
    so older versions that meet in one task are not moved."""
    by = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(v) for v in version))
    return df.withColumn("_rank", F.row_number().over(by)).where("_rank = 1").drop("_rank")


def _among(by: str, values: Sequence) -> Column:
    """Whether a partition is one of ``values``, null among them or not; Spark
    prunes the scan by it."""
    found = F.col(by).isin([v for v in values if v is not None])
    return found | F.col(by).isNull() if None in values else found


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """A frame that counts its rows while it is written, and where to read the number."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def number(seen: Observation) -> int:
    """The rows that were counted.  Of a frame that turns out to be empty while it runs
    Spark may drop the counting node; the observation then has no row, which can't be converted."""
    try:
        return seen.get["rows"]
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):
            raise
        return 0


def replace_partitions(
    df: DataFrame, path: str, by: str, order: Sequence[str], touched: Sequence = (), key: str | None = None, same_keys: bool = False, staging: str | None = None
) -> None:
    """Write the rows of whole partitions in place of what those hold; those of
    ``touched`` that have no row are removed.  Large partitions are dealt over
    several tasks (and files), small ones share a task; files are sorted.  key: a
    column to index partitions by; same_keys: the old index still holds."""
    spark, path = df.sparkSession, path.rstrip("/")
    own = staging is None
    if own:
        commits.recover(spark, path)
        staging = commits.new_staging(path)
    whole, staging = staging, f"{staging}/new"
    df.hint("rebalance", F.col(by)).sortWithinPartitions(by, *order).write.partitionBy(by).parquet(staging)
    if key is not None:
        commits.write_index(spark, staging, df.schema, key, by)
    gone = [commits.partition_name(by, v) for v in touched]
    commits.commit(spark, path, staging, gone, "new" if key else "keep" if same_keys else "drop")
    if own:
        commits.Files(spark, path).delete(whole)


def upsert(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], by: str, version: Sequence[str], order: Sequence[str] = (), moves: bool = True
) -> dict[str, int]:
    """Last write wins by key.  Only partitions (null is one) that hold an old or a
    new row of a changed key are read whole and rewritten; a row whose partition
    changed leaves the old one.  To find it, the key columns of those partitions are
    read whose index may hold an arriving value of the first key.  moves=False says
    that a key never changes its partition: then only the partitions of ``rows`` are
    read for old rows.  The arriving rows are written once and read from there, so a lost
    executor does not have them worked out again.  Counts of inserted and
    updated keys are returned."""
    commits.recover(spark, path)
    staging = commits.new_staging(path)
    new, kept = counted(latest(rows, keys, version))
    new.write.parquet(f"{staging}/arriving")
    new = spark.read.schema(rows.schema).parquet(f"{staging}/arriving")
    stored = read_table(spark, path, rows.schema)
    arriving = {r[0] for r in new.select(by).distinct().collect()}  # partition values, not rows
    may_hold = commits.may_hold(spark, path, new, keys[0], by) if moves else set()
    scanned = stored if may_hold is None else stored.where(_among(by, arriving | may_hold))
    old = scanned.select(by, *keys).join(new.select(*keys), list(keys), "left_semi")
    updated, places, in_null = old.agg(F.count_distinct(F.struct(*keys)), F.collect_set(by), F.max(F.col(by).isNull())).first()
    touched = arriving | set(places) | ({None} if in_null else set())
    rest = stored.where(_among(by, touched)).withColumn("_new", F.lit(0))
    merged = latest(rest.unionByName(new.withColumn("_new", F.lit(1))), keys, [*version, "_new"]).drop("_new")
    if touched:
        replace_partitions(merged, path, by, [c for c in (order or keys) if c != by], touched, keys[0] if moves else None, staging=staging)
    commits.Files(spark, path).delete(staging)
    return {"inserted": number(kept) - updated, "updated": updated}


def patch(stored: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Non-null new values replace old ones; keys that are not stored are ignored."""
    named = changes.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    df = stored.join(named, key, "left")
    return df.select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in stored.columns))


def needs_metadata(games: DataFrame, only_missing: bool = True) -> DataFrame:
    """Final games, by default those without a venue or a first pitch."""
    final = games.where("status = 'Final'")
    return final.where("venue_id IS NULL OR first_pitch_time_utc IS NULL") if only_missing else final


def patch_metadata(games: DataFrame, states: DataFrame, only_missing: bool = True) -> DataFrame:
    """Venue and first pitch from the feeds, where those have them, for the games
    that need them; all other rows stay."""
    wanted = states.join(needs_metadata(games, only_missing).select("game_pk"), "game_pk", "left_semi")
    return patch(games, wanted, "game_pk", ["venue_id", "first_pitch_time_utc"])


def patch_scores(games: DataFrame, changes: DataFrame) -> DataFrame:
    """Scores and status; the winner follows only when the game is final."""
    df = patch(games, changes, "game_pk", ["away_score", "home_score", "status"])
    return df.withColumn("home_team_won", F.when(F.col("status") == "Final", F.col("home_score") > F.col("away_score")).otherwise(F.col("home_team_won")))


def patch_conditions(weather: DataFrame, changes: DataFrame) -> DataFrame:
    """Conditions from the feed; a roof that is still unknown is closed indoors."""
    df = patch(weather, changes, "game_pk", [c for c in changes.columns if c != "game_pk"])
    roof: Column = F.coalesce("roof_closed", F.when(F.col("is_indoor"), F.lit(True)))
    return df.withColumn("roof_closed", roof)


def export_games(spark: SparkSession, games: DataFrame, facts: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """All tables of a set of games in one job each: games by season, facts by the
    date of their game.  Returns the row counts, taken while the rows are written."""
    told, seen = counted(games)
    upsert(spark, f"{folder}/games", told, ["game_pk"], "season", ["game_date"])
    counts = {"games": number(seen)}
    for name, df in facts.items():
        dated, seen = counted(df.drop("game_date").join(games.select("game_pk", "game_date"), "game_pk"))
        keys = [c for c in ("game_pk", "at_bat_index", "pitch_number") if c in dated.columns]
        upsert(spark, f"{folder}/{name}", dated, keys, "game_date", keys, keys)
        counts[name] = number(seen)
    return counts


def export_range(spark: SparkSession, games: DataFrame, facts: dict[str, DataFrame], folder: str, start: date, end: date) -> dict[str, int]:
    """``export_games`` for the games of a range of dates, both ends included."""
    return export_games(spark, games.where(F.col("game_date").between(F.lit(start), F.lit(end))), facts, folder)


def enriched_week(pitches: DataFrame, games: DataFrame, day: date) -> DataFrame:
    """Enriched pitches of the final games from a week before ``day`` to it."""
    return enrich_pitches(final_game_facts(pitches, games, *week_before(day)))


def export_enriched(spark: SparkSession, pitches: DataFrame, games: DataFrame, folder: str, day: date) -> int:
    """The enriched week as ``enriched/pitches_<start>_<end>``, put in place of the
    last one as a whole; a week without pitches writes nothing.  Returns the number of pitches."""
    path, (start, end) = f"{folder}/enriched", week_before(day)
    commits.recover(spark, path)
    staging = commits.new_staging(path)
    df, seen = counted(enriched_week(pitches, games, day))
    df.write.parquet(f"{staging}/pitches_{start}_{end}")
    if n := number(seen):
        commits.commit(spark, path, staging, [], "keep")
    else:
        commits.Files(spark, path).delete(staging)
    return n


def daily_player_stats(at_bats: DataFrame, games: DataFrame, day: date | None = None) -> DataFrame:
    """Batting of each player and date in final games, of one date or of all."""
    final = games.where("status = 'Final'")
    if day is not None:
        final = final.where(F.col("game_date") == F.lit(day))
    return batter_day(at_bats.drop("game_date").join(final.select("game_pk", "game_date"), "game_pk"))


def update_daily_player_stats(spark: SparkSession, at_bats: DataFrame, games: DataFrame, folder: str, day: date) -> int:
    """Upserts a day's stats by (player_id, stat_date); returns the number of rows."""
    stats = daily_player_stats(at_bats, games, day)
    return sum(upsert(spark, f"{folder}/player_stats_daily", stats, ["player_id", "stat_date"], "stat_date", ["games"], ["player_id"], moves=False).values())


def compact_month(spark: SparkSession, path: str, schema: T.StructType, year: int, month: int, order: Sequence[str]) -> int:
    """Rewrite a month's dates in place, each as few files as its size needs.
    Returns the number of rows, which does not change."""
    commits.recover(spark, path)
    df, seen = counted(read_table(spark, path, schema).where((F.year("game_date") == year) & (F.month("game_date") == month)))
    replace_partitions(df, path, "game_date", list(order), same_keys=True)
    return number(seen)


def compact_last_month(spark: SparkSession, folder: str, schemas: dict[str, T.StructType], day: date, order: Sequence[str] = ("game_pk",)) -> dict[str, int]:
    """The monthly job: each table's month before ``day``; rows by table."""
    year, month = previous_month(day)
    return {name: compact_month(spark, f"{folder}/{name}", schema, year, month, order) for name, schema in schemas.items()}
