"""Live feed snapshots with Structured Streaming.

A folder of JSON snapshots is the source.  What a micro-batch changes, against what is
stored, is written to an outbox under the batch's number before any table is touched; tables
and messages are made from there.  A batch that fails is run again by the engine and goes on
from its outbox, so a message whose table was stored already is still published: each
message at least once, with its key.  What a publisher refuses stays in the outbox for
the next batch, in order.  A pitch is stored and published again when its at-bat
completes, which corrects the score it was first seen with.

``progress`` and ``state_changes`` are append-only twins with keyed state in RocksDB: of each
game the last finished play, the pitches of the open one and the status, for a day.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pitchlake.schemas import KEY
from pitchlake.sources import feeds
from pitchlake.sources.commits import Files
from pitchlake.sources.tables import latest, patch_scores, read_table, upsert

DONE = ("Final", "Postponed", "Suspended")
STAY, STAY_MS = "1 day", 24 * 3600 * 1000
#: Tables are partitioned by so many neighbouring game ids: a key never changes its
#: partition, and a batch rewrites the blocks of its own games only.
BLOCK = 500
SEEN = ("snapshot_ts",)
TOPICS = ("pitches", "at_bats", "game_state")
KEYS = {"pitches": KEY, "at_bats": KEY[:2], "states": KEY[:1]}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of parsed snapshots with their time of arrival; broken ones have
    ``_corrupt_record``, broken plays are in ``_bad_plays``."""
    raw = spark.readStream.format("text").option("wholetext", "true").load(folder)
    return feeds.parse_plays(raw.select("value", F.col("_metadata.file_modification_time").alias("snapshot_ts")))


def changed(spark: SparkSession, path: str, rows: DataFrame, keys) -> DataFrame:
    """The rows whose key is not stored, or with other content than now; the time
    of the snapshot is no content.  Only the blocks of ``rows`` are read."""
    blocks = [r[0] for r in rows.select("block").distinct().collect()]
    content = F.xxhash64(*(c for c in rows.columns if c not in SEEN))
    stored = read_table(spark, path, rows.schema).where(F.col("block").isin(blocks))
    was = stored.select(*keys, content.alias("_was"))
    return rows.join(was, list(keys), "left").where(F.col("_was").isNull() | (F.col("_was") != content)).drop("_was")


def transitions(spark: SparkSession, path: str, states: DataFrame) -> DataFrame:
    """Games whose status is another than the stored one; first sightings are none."""
    stored = read_table(spark, path, states.schema).select("game_pk", F.col("status").alias("previous_state"))
    moved = states.join(stored, "game_pk").where("status IS NOT NULL AND previous_state <> status")
    return moved.select("game_pk", "previous_state", F.col("status").alias("new_state"), "away_score", "home_score", "snapshot_ts")


class Outbox:
    """Folders ``<folder>/<number of the batch>/<name>`` of rows, with marks for what is
    done.  run: tells the batches of one checkpoint from those of another."""

    def __init__(self, spark: SparkSession, folder: str, run: str = ""):
        self.spark, self.folder, self.run, self.files = spark, folder, run, Files(spark, folder)

    def place(self, epoch: int) -> str:
        return f"{self.folder}/{epoch:012d}{'-' * bool(self.run)}{self.run}"

    def is_ready(self, epoch: int) -> bool:
        return self.files.exists(f"{self.place(epoch)}/_ready")

    def fill(self, epoch: int, frames: dict[str, DataFrame]) -> None:
        for name, rows in frames.items():
            rows.write.mode("overwrite").parquet(f"{self.place(epoch)}/{name}")
        self.files.write(f"{self.place(epoch)}/_ready", "")

    def rows(self, epoch: int, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.place(epoch)}/{name}")

    def stored(self, epoch: int) -> None:
        self.files.write(f"{self.place(epoch)}/_stored", "")

    def flush(self, publish: Callable[[str, DataFrame], None] | None) -> None:
        """Publish what is stored and not published, oldest first; a topic waits for its
        older messages.  What is all published is removed."""
        failed: set[str] = set()
        for name in self.files.folders(self.folder):
            place = f"{self.folder}/{name}"
            if not self.files.exists(f"{place}/_stored"):
                continue
            for topic in TOPICS if publish else ():
                if topic in failed or self.files.exists(f"{place}/_sent_{topic}"):
                    continue
                rows = self.spark.read.parquet(f"{place}/{topic}")
                try:
                    if not rows.isEmpty():
                        publish(topic, rows)
                    self.files.write(f"{place}/_sent_{topic}", "")
                except Exception:
                    failed.add(topic)
                    logging.getLogger(__name__).exception("%s of batch %s not published; it will be tried again", topic, name)
            if publish is None or all(self.files.exists(f"{place}/_sent_{t}") for t in TOPICS):
                self.files.delete(place)


def store_batch(
    folder: str, publish: Callable[[str, DataFrame], None] | None = None, games: T.StructType | None = None, checkpoint: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A micro-batch into tables ``pitches`` and ``at_bats``, the latest state of
    each game, and a quarantine; then to a publisher, if there is one: new pitches
    and at-bats and changes of state.  games: schema of the table ``games`` (by
    season), whose scores and status then follow too.  checkpoint: of the stream, whose id
    keeps its outbox apart from another stream's."""

    def run_id(spark: SparkSession) -> str:
        files = Files(spark, folder)
        if checkpoint is None or not files.exists(f"{checkpoint}/metadata"):
            return ""
        return json.loads(files.read(f"{checkpoint}/metadata"))["id"]

    def news(spark: SparkSession, batch: DataFrame) -> dict[str, DataFrame]:
        good, _ = feeds.split_corrupt(batch)
        rows = {
            "pitches": (feeds.pitches(good), ["is_complete", "snapshot_ts"]), "at_bats": (feeds.at_bats(good, only_complete=True), ["snapshot_ts"]),
            "states": (feeds.game_state(good), ["snapshot_ts"]),
        }
        found = {}
        for name, (df, version) in rows.items():
            df = latest(df, KEYS[name], version).withColumn("block", F.floor(F.col("game_pk") / BLOCK).cast("long"))
            found[name] = changed(spark, f"{folder}/{'game_state' if name == 'states' else name}", df, KEYS[name])
        return found | {"quarantine": feeds.quarantined(batch)}

    def store(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        box = Outbox(spark, f"{folder}/outbox", run_id(spark))
        box.flush(publish)
        if not box.is_ready(epoch):
            batch = batch.persist()
            found = news(spark, batch)
            found["game_state"] = transitions(spark, f"{folder}/game_state", found["states"])
            box.fill(epoch, found)
            batch.unpersist()
        if not (bad := box.rows(epoch, "quarantine")).isEmpty():
            bad.write.mode("overwrite").parquet(f"{folder}/quarantine/batch={box.place(epoch).rpartition('/')[2]}")
        for name, version in (("pitches", ["is_complete", "snapshot_ts"]), ("at_bats", ["snapshot_ts"]), ("states", ["snapshot_ts"])):
            if not (rows := box.rows(epoch, name)).isEmpty():
                table = "game_state" if name == "states" else name
                upsert(spark, f"{folder}/{table}", rows, KEYS[name], "block", version, version, moves=False)
        if games is not None:
            state, kept = box.rows(epoch, "states"), read_table(spark, f"{folder}/games", games)
            rows = patch_scores(kept.join(state.select("game_pk"), "game_pk", "left_semi"), state)
            upsert(spark, f"{folder}/games", rows, ["game_pk"], "season", ["game_pk"], ["game_date"], moves=False)
        box.stored(epoch)
        box.flush(publish)

    return store


def run_live(spark: SparkSession, source: str, folder: str, checkpoint: str, publish=None, games=None, **trigger) -> StreamingQuery:
    """Start the ingest; by default it takes all that is there and stops.  Messages
    that an earlier run left in the outbox go first."""
    Outbox(spark, f"{folder}/outbox").flush(publish)
    writer = snapshots(spark, source).writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(store_batch(folder, publish, games, checkpoint)).trigger(**(trigger or {"availableNow": True})).start()


def to_messages(rows: DataFrame, *keys: str) -> DataFrame:
    """key and value of a topic's messages."""
    return rows.select(F.concat_ws("_", *keys).alias("key"), F.to_json(F.struct("*")).alias("value"))


def file_topics(folder: str) -> Callable[[str, DataFrame], None]:
    """A publisher that appends messages to one folder for each topic."""
    keys = {"pitches": ("event_id",), "at_bats": KEY[:2], "game_state": KEY[:1]}

    def publish(name: str, rows: DataFrame) -> None:
        to_messages(rows.drop("block"), *keys[name]).write.mode("append").json(f"{folder}/{name}")

    return publish


def read_topic(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of a topic's messages (key, value); its checkpoint is the consumer's
    committed place."""
    return spark.readStream.schema("key string, value string").json(f"{folder}/{name}")


def new_pitches(stream: DataFrame) -> DataFrame:
    """Each pitch once while it is live and once when its at-bat is complete; the
    state is bounded by a day of event time."""
    rows = feeds.pitches(stream.where("_corrupt_record IS NULL").drop("_corrupt_record", "_bad_plays"))
    timed = rows.withColumn("event_time", F.col("timestamp").cast("timestamp"))
    return timed.withWatermark("event_time", STAY).dropDuplicatesWithinWatermark(["event_id", "is_complete"])


class _Progress(StatefulProcessor):
    """Of a game: the last finished play, and the pitches seen of plays after it."""

    def __init__(self, stay: tuple[int, ...]):
        self.stay = stay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.finished = handle.getValueState("finished", "at_bat_index int", *self.stay)
        self.seen = handle.getMapState("seen", "at_bat_index int, pitch_number int", "at int", *self.stay)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        finished = self.finished.get()[0] if self.finished.exists() else -1
        known, last = {tuple(k) for k in self.seen.keys()}, finished
        for r in sorted(rows, key=lambda r: (r["at_bat_index"], r["pitch_number"], not r["is_complete"])):
            place = (r["at_bat_index"], r["pitch_number"])
            if r["at_bat_index"] <= finished or place in known and not r["is_complete"] or (*place, True) in known:
                continue
            known |= {place, (*place, True)} if r["is_complete"] else {place}
            if r["is_complete"]:
                last = max(last, r["at_bat_index"])
            else:
                self.seen.updateValue(place, (1,))
            yield Row(game_pk=key[0], at_bat_index=place[0], pitch_number=place[1], is_complete=r["is_complete"], value=r["value"])
        if last > finished:
            self.finished.update((last,))
            for place in [k for k in known if len(k) == 2 and k[0] <= last]:
                self.seen.removeKey(place)

    def close(self) -> None:
        pass


class _Status(StatefulProcessor):
    """The status of a game that is not over."""

    def __init__(self, stay: tuple[int, ...]):
        self.stay = stay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status = handle.getValueState("status", "status string", *self.stay)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.status.get()[0] if self.status.exists() else None
        for status in (r["status"] for r in sorted(rows, key=lambda r: r["snapshot_ts"])):
            if old is not None and status != old:
                yield Row(game_pk=key[0], old_state=old, new_state=status)
            old = status
        if old in DONE:
            self.status.clear()
        else:
            self.status.update((old,))

    def close(self) -> None:
        pass


def _with_state(stream: DataFrame, kind: type[StatefulProcessor], schema: str, stay_ms: int | None) -> DataFrame:
    """With a time to live the engine goes on running empty batches to expire state, so a
    query that takes what is there and stops is given none."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    processor, mode = (kind(()), "None") if stay_ms is None else (kind((stay_ms,)), "ProcessingTime")
    return stream.groupBy("game_pk").transformWithState(statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode=mode)


def progress(stream: DataFrame, stay_ms: int | None = STAY_MS) -> DataFrame:
    """game_pk, at_bat_index, pitch_number, is_complete, value: each pitch when it is first
    seen and when its at-bat completes, and each finished at-bat as pitch 0, as JSON.
    Snapshots repeat the whole game; of a game only its last finished play and the pitches of
    later ones are kept, for ``stay_ms`` after the last change.  Plays up to the last finished one
    are not looked at again: corrections to them reach the tables by ``store_batch``."""
    good = stream.where("_corrupt_record IS NULL AND gamePk IS NOT NULL").drop("_corrupt_record", "_bad_plays")
    pick = lambda df, number: df.select("game_pk", "at_bat_index", number, "is_complete", F.to_json(F.struct("*")).alias("value"))
    rows = pick(feeds.pitches(good), F.col("pitch_number")).unionByName(pick(feeds.at_bats(good, only_complete=True), F.lit(0).alias("pitch_number")))
    return _with_state(rows, _Progress, "game_pk long, at_bat_index int, pitch_number int, is_complete boolean, value string", stay_ms)


def state_changes(stream: DataFrame, stay_ms: int | None = STAY_MS) -> DataFrame:
    """game_pk, old_state, new_state for each change; the first sighting of a game
    is none.  A game that is over (``DONE``) is forgotten, so the state is as large as
    the games that are not; one that is taken up again counts as seen first.  ``stream``: game_pk, status, snapshot_ts."""
    known = stream.select("game_pk", "status", "snapshot_ts").where("status IS NOT NULL")
    return _with_state(known, _Status, "game_pk long, old_state string, new_state string", stay_ms)


def all_done(states: DataFrame) -> bool:
    """Whether every game is over; a driver may then stop its queries."""
    return states.where(~F.col("status").isin(*DONE)).isEmpty()
