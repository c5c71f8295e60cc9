"""Nested JSON to flat rows: feeds, schedules, venues and teams.

Everything is built-in functions over frames of many documents, one pass each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.schemas import FEED, GAME_DATA, LINESCORE, PLAY


def parse(raw: DataFrame, column: str = "value", schema: str = FEED) -> DataFrame:
    """JSON text to columns; other columns of ``raw`` are kept.  A broken document
    has its text in ``_corrupt_record``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = raw.withColumn("_feed", F.from_json(column, schema, options))
    return parsed.select(*(c for c in raw.columns if c != column), "_feed.*")


def parse_plays(raw: DataFrame, column: str = "value") -> DataFrame:
    """The columns of ``parse`` and ``_bad_plays``: a document is split into its plays as
    variants and each is read by itself, so a play that does not fit its schema, or names no
    at-bat, is set aside as text and the other plays of the game are kept.
    ``_corrupt_record`` is left for text that is no JSON at all."""
    strict = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    kind = f"{PLAY[:-1]}, _corrupt_record: STRING>"
    whole = raw.withColumn("_v", F.try_parse_json(column))
    part = lambda path, kind: F.try_variant_get("_v", path, kind)
    texts = F.transform(part("$.liveData.plays.allPlays", "array<variant>"), lambda p: F.to_json(p))
    whole = whole.withColumn("_plays", F.transform(F.coalesce(texts, F.array().cast("array<string>")), lambda t: F.struct(F.from_json(t, kind, strict).alias("play"), t.alias("text"))))
    fits = lambda t: t["play"]["_corrupt_record"].isNull() & t["play"]["about"]["atBatIndex"].isNotNull()
    good = F.transform(F.filter("_plays", fits), lambda t: t["play"].dropFields("_corrupt_record"))
    bad = F.transform(F.filter("_plays", lambda t: ~fits(t)), lambda t: t["text"])
    return whole.select(
        *(c for c in raw.columns if c != column), part("$.gamePk", "bigint").alias("gamePk"), part("$.gameData", GAME_DATA).alias("gameData"),
        F.struct(part("$.liveData.linescore", LINESCORE).alias("linescore"), F.struct(good.alias("allPlays")).alias("plays")).alias("liveData"),
        F.when(F.col("_v").isNull(), F.col(column)).alias("_corrupt_record"), bad.alias("_bad_plays"),
    )


def quarantined(feeds: DataFrame) -> DataFrame:
    """What could not be read, with the other columns of the feed: whole documents and
    single plays, as text in ``_corrupt_record``; game_pk where it is known."""
    kept = [c for c in feeds.columns if c not in ("gameData", "liveData", "gamePk", "_corrupt_record", "_bad_plays")]
    document = F.when(F.col("_corrupt_record").isNotNull() | F.col("gamePk").isNull(), F.array(F.coalesce("_corrupt_record", F.to_json(F.struct("gameData", "liveData")))))
    return feeds.select(F.col("gamePk").alias("game_pk"), *kept, F.explode(F.coalesce(document, F.col("_bad_plays"))).alias("_corrupt_record"))


def split_corrupt(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good feeds and quarantined ones; one bad game does not stop the others."""
    bad = F.col("_corrupt_record").isNotNull() | F.col("gamePk").isNull()
    return feeds.where(~bad).drop("_corrupt_record", "_bad_plays"), feeds.where(bad)


def moment(*choices: Column) -> Column:
    """The first ISO time that is there, as a time without zone in UTC, whatever
    the session's zone; a time without zone is taken as UTC."""
    text = F.coalesce(*choices)
    zoned = F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.to_utc_timestamp(F.try_to_timestamp(zoned), F.current_timezone()).cast("timestamp_ntz")


def _plays(feeds: DataFrame) -> DataFrame:
    kept = [c for c in feeds.columns if c not in ("gameData", "liveData", "gamePk", "_corrupt_record")]
    return feeds.select(F.col("gamePk").alias("game_pk"), *kept, F.explode("liveData.plays.allPlays").alias("play")), kept


def pitches(feeds: DataFrame) -> DataFrame:
    """One row for each pitch; events that are no pitches are skipped, the rest
    are numbered from 1 within the at-bat."""
    plays, kept = _plays(feeds)
    thrown = F.filter("play.playEvents", lambda e: F.coalesce(e["isPitch"], F.lit(False)))
    rows = plays.select("game_pk", *kept, "play", F.posexplode(thrown).alias("pos", "e"))
    about, result = F.col("play.about"), F.col("play.result")
    data, details, count = F.col("e.pitchData"), F.col("e.details"), F.col("e.count")
    in_play = F.coalesce(details["isInPlay"], F.lit(False))
    no, zero = F.lit(False), F.lit(0)
    hit = lambda c: F.when(in_play, F.col(f"e.hitData.{c}"))
    number = (F.col("pos") + 1).cast("int")
    return rows.select(
        "game_pk", *kept, about["atBatIndex"].alias("at_bat_index"), number.alias("pitch_number"),
        F.concat_ws("_", "game_pk", about["atBatIndex"], number).alias("event_id"),
        moment(F.col("e.startTime"), F.col("e.endTime"), about["startTime"]).alias("timestamp"),
        about["inning"].alias("inning"), F.when(about["isTopInning"], "top").otherwise("bottom").alias("half_inning"),
        F.col("play.matchup.pitcher.id").alias("pitcher_id"), F.col("play.matchup.pitcher.fullName").alias("pitcher_name"),
        F.col("play.matchup.batter.id").alias("batter_id"), F.col("play.matchup.batter.fullName").alias("batter_name"),
        details["type"]["code"].alias("pitch_type"), data["startSpeed"].alias("start_speed"), data["endSpeed"].alias("end_speed"),
        data["breaks"]["spinRate"].alias("spin_rate"), data["breaks"]["spinDirection"].alias("spin_direction"),
        data["breaks"]["breakAngle"].alias("break_angle"), data["breaks"]["breakLength"].alias("break_length"),
        data["coordinates"]["pfxX"].alias("pfx_x"), data["coordinates"]["pfxZ"].alias("pfx_z"),
        data["coordinates"]["pX"].alias("plate_x"), data["coordinates"]["pZ"].alias("plate_z"), data["zone"].alias("zone"),
        F.coalesce(details["call"]["code"], F.lit("")).alias("call_code"), F.coalesce(details["call"]["description"], F.lit("")).alias("call_description"),
        in_play.alias("is_in_play"), F.coalesce(details["isStrike"], no).alias("is_strike"), F.coalesce(details["isBall"], no).alias("is_ball"),
        hit("launchSpeed").alias("launch_speed"), hit("launchAngle").alias("launch_angle"), hit("totalDistance").alias("total_distance"), hit("trajectory").alias("trajectory"),
        *(F.coalesce(count[c], zero).alias(c) for c in ("balls", "strikes", "outs")),
        *(no.alias(f"runner_on_{b}") for b in ("first", "second", "third")),
        F.coalesce(result["awayScore"], zero).alias("away_score"), F.coalesce(result["homeScore"], zero).alias("home_score"),
        F.coalesce(about["isComplete"], no).alias("is_complete"),
    )


def at_bats(feeds: DataFrame, only_complete: bool = False) -> DataFrame:
    """One row for each play: pitches, outs after it and its result."""
    plays, kept = _plays(feeds)
    about, result, events = F.col("play.about"), F.col("play.result"), F.col("play.playEvents")
    if only_complete:
        plays = plays.where(F.coalesce(about["isComplete"], F.lit(False)))
    counted = F.filter(events, lambda e: e["count"].isNotNull())
    outs = F.coalesce(F.try_element_at(counted, F.lit(-1))["count"]["outs"], F.lit(0))
    text = {"event": ("event", "Unknown"), "eventType": ("event_type", "unknown"), "description": ("description", "")}
    return plays.select(
        "game_pk", *kept, about["atBatIndex"].alias("at_bat_index"), moment(about["endTime"], about["startTime"]).alias("timestamp"),
        about["inning"].alias("inning"), F.when(about["isTopInning"], "top").otherwise("bottom").alias("half_inning"),
        F.col("play.matchup.pitcher.id").alias("pitcher_id"), F.col("play.matchup.pitcher.fullName").alias("pitcher_name"),
        F.col("play.matchup.batter.id").alias("batter_id"), F.col("play.matchup.batter.fullName").alias("batter_name"),
        *(F.coalesce(result[c], F.lit(d)).alias(n) for c, (n, d) in text.items()),
        F.coalesce(result["rbi"], F.lit(0)).alias("rbi"), F.coalesce(result["awayScore"], F.lit(0)).alias("away_score"),
        F.coalesce(result["homeScore"], F.lit(0)).alias("home_score"), F.coalesce(about["isScoringPlay"], F.lit(False)).alias("is_scoring_play"),
        outs.alias("outs_after"), F.size(F.filter(events, lambda e: F.coalesce(e["isPitch"], F.lit(False)))).alias("pitch_count"),
        F.coalesce(about["isComplete"], F.lit(False)).alias("is_complete"),
    )


def schedule_games(schedules: DataFrame) -> DataFrame:
    rows = schedules.select(F.explode("dates").alias("d")).select(F.explode("d.games").alias("g"))
    side = lambda s: [
        F.col(f"g.teams.{s}.team.id").alias(f"{s}_team_id"), F.col(f"g.teams.{s}.team.name").alias(f"{s}_team_name"), F.col(f"g.teams.{s}.score").alias(f"{s}_score"),
    ]
    return rows.select(
        F.col("g.gamePk").alias("game_pk"), F.substring("g.gameDate", 1, 10).cast("date").alias("game_date"), F.col("g.gameType").alias("game_type"),
        F.col("g.season").cast("int").alias("season"), F.col("g.status.abstractGameState").alias("status"), F.col("g.status.detailedState").alias("detailed_state"),
        *side("away"), *side("home"), F.col("g.venue.name").alias("venue_name"),
    )


def game_state(feeds: DataFrame) -> DataFrame:
    """Status, score, venue and first pitch as a snapshot has them."""
    kept = [c for c in feeds.columns if c not in ("gameData", "liveData", "gamePk", "_corrupt_record")]
    first = F.get("liveData.plays.allPlays", F.lit(0))
    start = moment(F.get(first["playEvents"], F.lit(0))["startTime"], first["about"]["startTime"], F.col("gameData.datetime.dateTime"))
    runs = lambda s: F.col(f"liveData.linescore.teams.{s}.runs").alias(f"{s}_score")
    return feeds.select(
        F.col("gamePk").alias("game_pk"), *kept, F.col("gameData.status.abstractGameState").alias("status"), runs("away"), runs("home"),
        F.col("gameData.venue.id").alias("venue_id"), F.col("gameData.venue.name").alias("feed_venue"), start.alias("first_pitch_time_utc"),
    )


def game_rows(schedule: DataFrame, states: DataFrame) -> DataFrame:
    """Games from schedule and feed: the feed's score unless it is 0, then the
    schedule's; the feed's venue unless it is empty."""
    feed = states.select("game_pk", F.col("away_score").alias("fa"), F.col("home_score").alias("fh"), "feed_venue", "venue_id", "first_pitch_time_utc")
    score = lambda f, s: F.coalesce(F.nullif(F.col(f), F.lit(0)), F.col(s), F.lit(0))
    df = schedule.join(feed, "game_pk", "left").withColumns({
        "away_score": score("fa", "away_score"), "home_score": score("fh", "home_score"),
        "venue_name": F.coalesce(F.nullif("feed_venue", F.lit("")), "venue_name"),
    })
    won = F.when(F.col("status") == "Final", F.col("home_score") > F.col("away_score"))
    return df.withColumn("home_team_won", won).drop("fa", "fh", "feed_venue")


def venue_rows(payloads: DataFrame) -> DataFrame:
    place, field = F.col("location"), F.col("fieldInfo")
    return payloads.select(
        F.col("id").alias("venue_id"), "name", place["city"].alias("city"), F.coalesce(place["stateAbbrev"], place["state"]).alias("state"),
        place["country"].alias("country"), place["defaultCoordinates"]["latitude"].alias("latitude"), place["defaultCoordinates"]["longitude"].alias("longitude"),
        place["elevation"].alias("elevation_ft"), place["azimuthAngle"].alias("azimuth_angle"), field["roofType"].alias("roof_type"),
        field["turfType"].alias("turf_type"), field["capacity"].alias("capacity"),
    )


def team_rows(payloads: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(c, F.lit(""))
    return payloads.select(
        F.col("id").alias("team_id"), text(F.col("name")).alias("name"), text(F.col("abbreviation")).alias("abbreviation"),
        text(F.col("league.name")).alias("league"), text(F.col("division.name")).alias("division"), F.col("venue.name").alias("venue_name"),
    )
