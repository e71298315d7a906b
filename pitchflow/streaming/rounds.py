"""Poll rounds whose parts come in any order: held until they are complete, emitted by the minute rule, then published.

A round is closed when one that is more than `lateness` later has come, or at the end of the log. Until then its rows are kept
as parts, one folder per micro-batch, so the order in which they came does not matter. All rounds that a batch closes are
one distributed job: a round only needs, per fixture and minute, the last place in the list, and a fixture's rounds are then
gone through in order by one fold over those few numbers.

A batch ends by writing its manifest. Until it is there, nobody reads what the batch wrote and a rerun replaces it; once it is
there, a rerun does nothing. So the manifests are an append-only source of finished rounds, from which they are published.
"""

from __future__ import annotations

import json
import queue
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pitchflow.operators.joins import spread_join
from pitchflow.session import child_names, delete_path, path_exists
from pitchflow.sources.log import append_log

MANIFEST = "name string, batch_id bigint, upto bigint, newest bigint, events string, cursor string"
FAILURE = "batch_id bigint, attempt int, error string, files array<string>"


def rounds_emitted(rows: DataFrame, cursor: DataFrame, key: str, minute: str, pos: str, poll: str) -> tuple[DataFrame, DataFrame]:
    """The new events of complete rounds in `rows`, whatever their number, and the cursor (key, last_seen) after them.

    An event passes when its minute is known, not 0, and beyond the minute of the last event, in list order, that an
    earlier round emitted for its fixture. A fixture's events meet in tasks only as one row per round and minute.
    """
    known = rows.filter(F.col(minute).isNotNull() & (F.col(minute) != 0))
    last = known.groupBy(key, poll, minute).agg(F.max(pos).alias("_pos"))
    ends = F.collect_list(F.struct("_pos", F.col(minute).cast("bigint").alias("minute")))
    each = last.groupBy(key, F.col(poll).cast("bigint").alias("_poll")).agg(F.sort_array(ends, asc=False).alias("_ends"))
    each = each.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_poll", "_ends"))).alias("_rounds"))
    each = each.filter(F.col(key).isNotNull()).join(cursor, key, "left")

    start = F.struct(
        F.coalesce(F.col("last_seen"), F.lit(0)).cast("bigint").alias("last"),
        F.array().cast("array<struct<poll: bigint, before: bigint>>").alias("passed"),
    )

    def after(state: Column, one: Column) -> Column:
        emitted = F.get(F.filter(one["_ends"], lambda e: e["minute"] > state["last"]), F.lit(0))
        here = F.struct(one["_poll"].alias("poll"), state["last"].alias("before"))
        return F.struct(F.coalesce(emitted["minute"], state["last"]).alias("last"), F.concat(state["passed"], F.array(here)).alias("passed"))

    folded = each.select(key, F.aggregate("_rounds", start, after).alias("_state"))
    before = folded.select(key, F.explode("_state.passed").alias("_p")).select(key, F.col("_p.poll").alias("_poll"), F.col("_p.before").alias("_before"))
    joined = spread_join(known.withColumn("_poll", F.col(poll).cast("bigint")), before, [key, "_poll"], "left", [pos])
    emitted = joined.filter(F.col(minute) > F.coalesce(F.col("_before"), F.lit(0))).select(*rows.columns)
    moved = folded.select(key, F.col("_state.last").alias("moved")).filter("moved <> 0")
    merged = cursor.join(moved, key, "full").select(key, F.coalesce("moved", "last_seen").cast("bigint").alias("last_seen"))
    return emitted, merged


@dataclass(frozen=True)
class PollRounds:
    """Rounds of polls below `root`: parts, late rows, emitted events, cursors, manifests and failures.

    `poll` is a whole number that grows with the rounds, and `lateness` is in its unit. Rows of a round that is closed already, and
    rows without a round, are kept below `late`. A batch that fails is tried `attempts` times, as a failure may pass;
    then it is listed below `failed` and left out, and the rounds after it go on.
    """

    root: str
    key: str
    minute: str
    pos: str
    poll: str
    lateness: int = 0
    attempts: int = 3
    keep_cursors: int = 10

    def run(self, stream: DataFrame, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
        """Take in a stream of exploded polls. The folder belongs to one checkpoint."""

        def land(batch: DataFrame, batch_id: int) -> None:
            try:
                self._land(batch, batch_id)
            except Exception as error:
                if self._failed(batch.sparkSession, checkpoint, batch_id, error) < self.attempts:
                    raise

        writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def finish(self, spark: SparkSession) -> None:
        """Close the rounds that are still open: the log has ended."""
        last = self._last(spark, "~")
        if last is not None and last["newest"] is not None and last["upto"] != last["newest"]:
            self._close(spark, f"{last['batch_id']:010d}-1", last["batch_id"], last, last["newest"], last["newest"])

    def failures(self, spark: SparkSession) -> DataFrame:
        """(batch_id, attempt, error, files): the batches that were left out, with the files they read, where files are the source."""
        if not path_exists(spark, f"{self.root}/failed"):
            return spark.createDataFrame([], FAILURE)
        tried = spark.read.schema(FAILURE).option("recursiveFileLookup", "true").json(f"{self.root}/failed")
        return tried.filter(F.col("attempt") >= self.attempts)

    def closed(self, spark: SparkSession) -> DataFrame:
        """A stream of the manifests."""
        return spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", "100").json(f"{self.root}/closed/*")

    def _last(self, spark: SparkSession, before: str):
        """The manifest before the one of that name."""
        for name in reversed([n for n in child_names(spark, f"{self.root}/closed") if n < before]):
            if path_exists(spark, f"{self.root}/closed/{name}/_SUCCESS"):
                return spark.read.schema(MANIFEST).json(f"{self.root}/closed/{name}").first()
        return None

    def _land(self, batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{batch_id:010d}-0"
        if path_exists(spark, f"{self.root}/closed/{name}/_SUCCESS"):
            return
        last = self._last(spark, name)
        # the batch is read once, here; what cannot be read fails before anything else is written
        part = f"{self.root}/parts/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(part)
        rows = spark.read.schema(batch.schema).parquet(part)
        upto, newest = (last["upto"], last["newest"]) if last else (None, None)
        poll = F.col(self.poll)
        late = rows.filter(poll.isNull() if upto is None else poll.isNull() | (poll <= upto))
        if not late.isEmpty():
            late.write.mode("overwrite").parquet(f"{self.root}/late/batch_id={batch_id}")
        high = rows.agg(F.max(poll).cast("bigint")).first()[0]
        newest = max((x for x in (newest, high) if x is not None), default=None)
        done = None if newest is None else newest - self.lateness - 1
        upto_now = max((x for x in (upto, done) if x is not None), default=None)
        self._close(spark, name, batch_id, last, upto_now, newest)

    def _close(self, spark: SparkSession, name: str, batch_id: int, last, upto: int | None, newest: int | None) -> None:
        """Emit the open rounds up to `upto` and write the manifest."""
        parts = f"{self.root}/parts"
        from_ = last["upto"] if last else None
        cursor_path, events = last["cursor"] if last else None, None
        if upto is not None and upto != from_ and child_names(spark, parts):
            stored = spark.read.parquet(parts)
            opened = stored.filter(F.col(self.poll) <= upto)
            opened = (opened if from_ is None else opened.filter(F.col(self.poll) > from_)).drop("batch_id")
            empty = f"`{self.key}` {stored.schema[self.key].dataType.simpleString()}, last_seen bigint"
            cursor = spark.read.parquet(f"{self.root}/{cursor_path}") if cursor_path else spark.createDataFrame([], empty)
            emitted, cursor = rounds_emitted(opened, cursor, self.key, self.minute, self.pos, self.poll)
            events, cursor_path = f"out/{name}", f"cursor/{name}"
            emitted.write.mode("overwrite").parquet(f"{self.root}/{events}")
            cursor.write.mode("overwrite").parquet(f"{self.root}/{cursor_path}")
        row = (name, batch_id, upto, newest, events, cursor_path)
        spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.root}/closed/{name}")
        self._tidy(spark, upto, cursor_path)

    def _tidy(self, spark: SparkSession, upto: int | None, cursor: str | None) -> None:
        """Remove parts without open rounds, and cursors that no rerun can need."""
        if upto is not None and child_names(spark, f"{self.root}/parts"):
            stored = spark.read.parquet(f"{self.root}/parts")
            for r in stored.groupBy("batch_id").agg(F.max(self.poll).alias("high")).collect():
                if r["high"] is None or r["high"] <= upto:
                    delete_path(spark, f"{self.root}/parts/batch_id={r['batch_id']}")
        if cursor:
            older = [n for n in child_names(spark, f"{self.root}/cursor") if f"cursor/{n}" < cursor]
            for n in older[: -self.keep_cursors]:
                delete_path(spark, f"{self.root}/cursor/{n}")

    def _failed(self, spark: SparkSession, checkpoint: str, batch_id: int, error: Exception) -> int:
        """Note a failure and return how many the batch has had; what it wrote is removed."""
        path = f"{self.root}/failed/batch_id={batch_id}"
        attempt = len(child_names(spark, path)) + 1
        delete_path(spark, f"{self.root}/parts/batch_id={batch_id}")
        row = (batch_id, attempt, str(error)[:2000], files_of_batch(spark, checkpoint, batch_id))
        spark.createDataFrame([row], FAILURE).coalesce(1).write.mode("overwrite").json(f"{path}/attempt={attempt}")
        return attempt


def files_of_batch(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """The files a micro-batch reads, from the log that a file source keeps with its checkpoint; none for other sources."""
    folder = f"{checkpoint}/sources/0"
    logs = [n for n in child_names(spark, folder) if n.split(".")[0].isdigit() and int(n.split(".")[0]) >= batch_id]
    if not logs:
        return []
    lines = [r["value"] for r in spark.read.text(f"{folder}/{min(logs, key=lambda n: int(n.split('.')[0]))}").collect()]
    entries = [json.loads(x) for x in lines if x.startswith("{")]
    return sorted(e["path"] for e in entries if e.get("batchId") == batch_id and "path" in e)


def publish_rounds(
    rounds: PollRounds,
    spark: SparkSession,
    messages: Callable[[DataFrame], DataFrame],
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    path: str | None = None,
    order: Sequence[str] = (),
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Append the events of closed rounds to the log, as `messages` makes them (key, value and the columns of `order`).

    A batch is some manifests. To a log of files it writes a folder of its own with offsets that depend on the manifests
    and on `order` alone, so publishing again, by a rerun or another checkpoint, gives the same messages the same offsets.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        for r in batch.filter("events is not null").orderBy("name").collect():
            events = spark.read.parquet(f"{rounds.root}/{r['events']}")
            append_log(messages(events), fmt, options, path, r["name"], order)

    writer = rounds.closed(spark).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


class _Ends(StreamingQueryListener):
    """Passes on how queries end, and that they make progress."""

    def __init__(self) -> None:
        self.seen: queue.Queue = queue.Queue()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.seen.put((str(event.progress.runId), True, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.seen.put((str(event.runId), False, event.exception))


def keep_running(spark: SparkSession, start: Callable[[], StreamingQuery], restarts: int = 10) -> int:
    """Start a query and start it again whenever it ends by an error; returns how often that was, once it ends by itself.

    After `restarts` errors without progress between them the last one is raised.
    """
    ends = _Ends()
    spark.streams.addListener(ends)
    total = errors = 0
    try:
        running = start()
        while True:
            run_id, progress, error = ends.seen.get()
            if run_id != str(running.runId):
                continue
            if progress:
                errors = 0
            elif error is None:
                return total
            else:
                total, errors = total + 1, errors + 1
                if errors > restarts:
                    raise RuntimeError(f"{errors} errors without progress, the last: {error}")
                running = start()
    finally:
        spark.streams.removeListener(ends)


def unseen_events(stream: DataFrame, event_keys: Sequence[str], at: Column, within: str, minute: str | None = None) -> DataFrame:
    """The lossless rule: every event of a stream of polls once, known by `event_keys` and not by its minute.

    Events that join a minute already emitted pass, and so do corrections that change a key. `at` is the time of the
    poll; a copy is recognised for `within` (e.g. `3 days`, at least as long as a fixture is polled) after the first one, after which
    its key is forgotten: the state is bounded by the events of that time. `minute` leaves out events where it is NULL or 0.
    """
    known = stream if minute is None else stream.filter(F.col(minute).isNotNull() & (F.col(minute) != 0))
    timed = known.withColumn("_at", at.cast("timestamp")).withWatermark("_at", within)
    return timed.dropDuplicatesWithinWatermark(list(event_keys)).drop("_at")
