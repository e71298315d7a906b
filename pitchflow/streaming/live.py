"""New events out of repeated polls that always return a fixture's whole event list.

The rule: an event passes when its minute is known, not 0, and beyond the last minute emitted for
its fixture by an earlier poll. All events of one poll are compared with the same last minute; the
last one emitted, in list order, sets the next. A round may arrive in any number of micro-batches: the
cursor keeps what each fixture had before its newest round, and a later part of that round is compared with it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchflow.operators.joins import spread_join
from pitchflow.session import child_names, delete_path, path_exists


def new_events(snapshot: DataFrame, cursor: DataFrame, key: str, minute: str, pos: str) -> DataFrame:
    """Events of one poll beyond the cursor (key, last_seen).

    The cursor has one row per fixture; a fixture with very many events is spread over tasks.
    """
    known = snapshot.filter(F.col(minute).isNotNull() & (F.col(minute) != 0))
    joined = spread_join(known, cursor, [key], "left", [pos])
    fresh = joined.filter(F.col(minute) > F.coalesce(F.col("last_seen"), F.lit(0)))
    return fresh.select(*snapshot.columns)


def next_cursor(emitted: DataFrame, cursor: DataFrame, key: str, minute: str, pos: str) -> DataFrame:
    """The cursor after a poll: the minute of each fixture's last emitted event, else as before."""
    moved = emitted.groupBy(key).agg(F.max_by(minute, pos).cast("bigint").alias("last_seen"))
    return cursor.join(moved.select(key), key, "left_anti").unionByName(moved)


def _known_before(cursor: DataFrame, value: object, key: str) -> DataFrame:
    """What a part of round `value` is compared with: a fixture's last minute before that round."""
    same = F.col("poll") == F.lit(value)
    return cursor.select(key, F.when(same, F.col("before")).otherwise(F.col("last_seen")).alias("last_seen"))


def _cursor_after(emitted: DataFrame, cursor: DataFrame, value: object, key: str, minute: str, pos: str) -> DataFrame:
    """The cursor (key, poll, before, pos, last_seen) after a part of round `value`: of the events that the round has
    emitted so far, the last in list order counts, whichever part it came in."""
    last = F.max(F.struct(F.col(pos).alias("pos"), F.col(minute).cast("bigint").alias("last_seen")))
    moved = emitted.groupBy(key).agg(last.alias("last")).alias("m")
    old, new = cursor.alias("c"), F.col("m.last")
    kept = new.isNull()
    same = F.coalesce(F.col("c.poll") == F.lit(value), F.lit(False))
    earlier = kept | (same & (F.col("c.pos") > new["pos"]))
    this = F.greatest(F.col("c.poll"), F.lit(value).cast(cursor.schema["poll"].dataType))
    return old.join(moved, key, "full").select(
        key,
        F.when(kept, F.col("c.poll")).otherwise(this).alias("poll"),
        F.when(kept | same, F.col("c.before")).otherwise(F.col("c.last_seen")).alias("before"),
        F.when(earlier, F.col("c.pos")).otherwise(new["pos"]).alias("pos"),
        F.when(earlier, F.col("c.last_seen")).otherwise(new["last_seen"]).alias("last_seen"),
    )


def emit_new_events(
    stream: DataFrame,
    out_path: str,
    cursor_path: str,
    checkpoint: str,
    key: str,
    minute: str,
    pos: str,
    poll: str,
    trigger: Mapping | None = None,
    keep_versions: int = 100,
) -> StreamingQuery:
    """Write the new events of every poll round in a stream of exploded polls.

    One round asks for all fixtures, so a round is a large distributed batch and only rounds follow
    one another; bound the stream (`maxFilesPerTrigger`) where a backlog may hold very many rounds. The state per
    fixture is a small table with a version per round: a batch that runs
    again starts from the version before it and overwrites its own output. Keyed state functions
    would send every event of a busy fixture through one task; here only its last minute is keyed.
    """
    types = {name: stream.schema[name].dataType.simpleString() for name in (key, poll, pos)}
    schema = f"{key} {types[key]}, poll {types[poll]}, before bigint, pos {types[pos]}, last_seen bigint"

    def one_round(batch: DataFrame, value: int, version: str, out: str) -> None:
        spark = batch.sparkSession
        cursor = _cursor_before(spark, cursor_path, version, schema)
        known = _known_before(cursor, value, key)
        fresh = new_events(batch.filter(F.col(poll) == F.lit(value)), known, key, minute, pos)
        fresh.write.mode("overwrite").parquet(out)
        emitted = spark.read.schema(batch.schema).parquet(out)
        after = _cursor_after(emitted, cursor, value, key, minute, pos)
        after.write.mode("overwrite").parquet(f"{cursor_path}/{version}")

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # read once for its rounds and once per round
        batch.persist()
        try:
            rounds = [r[0] for r in batch.select(poll).distinct().orderBy(poll).collect()]
            for i, value in enumerate(rounds):
                out = f"{out_path}/batch_id={batch_id:010d}/round={i:06d}"
                one_round(batch, value, f"version={batch_id:010d}_{i:06d}", out)
        finally:
            batch.unpersist()
        # a batch that runs again needs the last version before it, never one of long ago
        older = [n for n in child_names(spark, cursor_path) if n < f"version={batch_id:010d}"]
        for name in older[:-keep_versions]:
            delete_path(spark, f"{cursor_path}/{name}")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _cursor_before(spark: SparkSession, path: str, version: str, schema: str) -> DataFrame:
    for name in reversed(child_names(spark, path)):
        if name.startswith("version=") and name < version and path_exists(spark, f"{path}/{name}/_SUCCESS"):
            return spark.read.schema(schema).parquet(f"{path}/{name}")
    return spark.createDataFrame([], schema)


def live_messages(events: DataFrame, at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Log messages of new events (fixture_id, event): key, value = {ingested_at_utc, fixture_id, event}, and columns to keep."""
    now = F.current_timestamp() if at is None else at
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    body = F.struct(stamp.alias("ingested_at_utc"), "fixture_id", "event")
    return events.select(F.col("fixture_id").cast("string").alias("key"), F.to_json(body).alias("value"), *keep)
