"""Structured Streaming over logs and polls written from the events table; every query drains and ends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchflow import functions as P
from pitchflow import plans
from pitchflow import sources as S
from pitchflow import streaming
from pitchflow.bindings import derived
from pitchflow.bindings.models import FACT
from pitchflow.bindings.registry import ORACLES, query
from pitchflow.session import scratch_path

LOADED_AT = "TIMESTAMP '2025-02-01 00:00:00'"

LANDED = f"""
    SELECT {LOADED_AT} AS ingested_at, 'fixture.live.events' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
           event_id AS "offset", CAST(user_id AS VARCHAR) AS message_key,
           make_timestamp(epoch_us(ts) // 1000 * 1000) AS kafka_timestamp,
           CASE WHEN event_type <> 'view' THEN user_id END AS fixture_id,
           CASE WHEN event_type = 'view' THEN '<' || props END AS raw
    FROM events
"""


def _loaded_at():
    return F.lit("2025-02-01 00:00:00").cast("timestamp")


def _landed(spark, path):
    value = F.col("message_value")
    return spark.read.parquet(path).select(
        "ingested_at",
        "topic",
        "partition",
        "offset",
        "message_key",
        "kafka_timestamp",
        P.number(value, "$.fixture_id").alias("fixture_id"),
        P.jget(value, "$._raw", "string").alias("raw"),
    )


@query("stream_to_raw", LANDED)
def stream_to_raw(t):
    """A log of JSON files into the RAW table."""
    root = scratch_path(t.spark, "stream")
    derived.live_log(t.events).write.json(f"{root}/log")
    stream = S.read_log(t.spark, "json", {}, f"{root}/log")
    streaming.stream_to_raw(stream, f"{root}/raw", f"{root}/checkpoint", loaded_at=_loaded_at()).awaitTermination()
    return _landed(t.spark, f"{root}/raw")


@query("stream_replay_idempotent", LANDED)
def stream_replay_idempotent(t):
    """The whole log delivered a second time, after a restart: nothing is stored twice."""
    root = scratch_path(t.spark, "replay")
    for _ in range(2):
        derived.live_log(t.events).write.mode("append").json(f"{root}/log")
        stream = S.read_log(t.spark, "json", {}, f"{root}/log")
        streaming.stream_to_raw(stream, f"{root}/raw", f"{root}/checkpoint", loaded_at=_loaded_at()).awaitTermination()
    return _landed(t.spark, f"{root}/raw")


@query("stream_new_checkpoint", LANDED)
def stream_new_checkpoint(t):
    """The log read again through a second checkpoint into the same table, in batches of one file: nothing repeats, nothing goes."""
    root = scratch_path(t.spark, "again")
    derived.live_log(t.events).repartition(3).write.json(f"{root}/log")
    for checkpoint, options in (("first", {}), ("second", {"maxFilesPerTrigger": "1"})):
        stream = S.read_log(t.spark, "json", options, f"{root}/log")
        streaming.stream_to_fact(stream, f"{root}/raw", f"{root}/fact", f"{root}/{checkpoint}", loaded_at=_loaded_at()).awaitTermination()
    fact = t.spark.read.parquet(f"{root}/fact").groupBy("topic", "partition", "offset").count().filter("count = 1").drop("count")
    return _landed(t.spark, f"{root}/raw").join(fact, ["topic", "partition", "offset"], "left_semi")


@query(
    "stream_event_fact",
    f"""
    SELECT event_id, topic, "partition", "offset", message_key, fixture_id, event_elapsed_min, event_type, event_detail,
           player_id, player_name, assist_id FROM ({FACT})
    UNION ALL
    SELECT 'fixture.live.events:' || user_id % 4 || ':' || event_id, 'fixture.live.events', user_id % 4, event_id,
           CAST(user_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_type = 'view'
    """,
)
def stream_event_fact(t):
    """Log to RAW to the live fact in the same micro-batches; a wrapped message has no event fields."""
    root = scratch_path(t.spark, "fact")
    derived.live_log(t.events).write.json(f"{root}/log")
    stream = S.read_log(t.spark, "json", {}, f"{root}/log")
    streaming.stream_to_fact(
        stream, f"{root}/raw", f"{root}/fact", f"{root}/checkpoint", loaded_at=_loaded_at()
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/fact").select(
        "event_id",
        "topic",
        "partition",
        "offset",
        "message_key",
        "fixture_id",
        "event_elapsed_min",
        "event_type",
        "event_detail",
        "player_id",
        "player_name",
        "assist_id",
    )


@query(
    "live_group",
    f"""
    SELECT event_id, event_type, event_time, player_name FROM ({FACT})
    """,
)
def live_group(t):
    """The live models built twice over the same log: the stored fact takes each offset once."""
    root = scratch_path(t.spark, "live")
    sources = {"kafka_fixture_live_events": derived.kafka_fixture_live_events(t.events)}
    plans.run_group(t.spark, "live", sources, root)
    built = plans.run_group(t.spark, "live", sources, root)
    return built["fct_fixture_live_event"].select("event_id", "event_type", "event_time", "player_name")


HISTORY = [name for name in plans.GROUPS["history"] if name in ORACLES]


@query(
    "history_group",
    " UNION ALL ".join(f"SELECT '{name}' AS model, count(*) AS n FROM ({ORACLES[name]})" for name in HISTORY),
)
def history_group(t):
    """All history models built in order, tables written and read back: rows per model."""
    root = scratch_path(t.spark, "history")
    built = plans.run_group(t.spark, "history", derived.sources(t), root)
    counts = [built[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("model"), "n") for name in HISTORY]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("table_versions", "SELECT o_orderkey, o_totalprice + 1 AS price FROM orders")
def table_versions(t):
    """A table rebuilt twice: readers see the newest version."""
    path = scratch_path(t.spark, "versions")
    for add in (0, 1):
        plans.write_table(t.orders.select("o_orderkey", (F.col("o_totalprice") + add).alias("price")), path)
    return plans.current_table(t.spark, path)


# The events of a week are one poll round, a user is a fixture and `k` the minute of an event.
POLLS = (
    "user_id AS fixture_id",
    "event_id AS pos",
    "cast(get_json_object(props, '$.k') AS bigint) AS minute",
    "cast((dayofmonth(ts) - 1) div 7 AS bigint) AS poll",
    "event_type",
)

EMITTED = """
    WITH RECURSIVE e AS (
      SELECT user_id AS fixture_id, event_id AS pos, CAST(json_extract_string(props, '$.k') AS BIGINT) AS minute,
             CAST((day(ts) - 1) // 7 AS BIGINT) AS poll, event_type FROM events),
    state AS (
      SELECT fixture_id, CAST(-1 AS BIGINT) AS poll, CAST(0 AS BIGINT) AS last_seen FROM (SELECT DISTINCT fixture_id FROM e)
      UNION ALL
      SELECT s.fixture_id, s.poll + 1,
             coalesce((SELECT arg_max(e.minute, e.pos) FROM e
                       WHERE e.fixture_id = s.fixture_id AND e.poll = s.poll + 1 AND e.minute > s.last_seen), s.last_seen)
      FROM state s WHERE s.poll < 4)
    SELECT e.fixture_id, e.poll, e.pos, e.minute, e.event_type
    FROM e JOIN state s ON e.fixture_id = s.fixture_id AND s.poll = e.poll - 1 WHERE e.minute > s.last_seen
"""


@query("stream_new_events", EMITTED)
def stream_new_events(t):
    """Five poll rounds through the stream: what each adds beyond the last minute of its fixture."""
    root = scratch_path(t.spark, "polls")
    polls = t.events.selectExpr(*POLLS)
    polls.write.parquet(f"{root}/polls")
    stream = t.spark.readStream.schema(polls.schema).parquet(f"{root}/polls")
    streaming.emit_new_events(
        stream, f"{root}/out", f"{root}/cursor", f"{root}/checkpoint", "fixture_id", "minute", "pos", "poll"
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/out").select("fixture_id", "poll", "pos", "minute", "event_type")


@query("stream_new_events_split", EMITTED)
def stream_new_events_split(t):
    """The same rounds, each in several files that arrive one micro-batch after another."""
    root = scratch_path(t.spark, "polls")
    polls = t.events.selectExpr(*POLLS)
    polls.write.parquet(f"{root}/all")
    stored = t.spark.read.schema(polls.schema).parquet(f"{root}/all")
    parts = stored.withColumn("half", F.pmod(F.xxhash64("pos"), F.lit(2)))
    # two files per round, in the order of the rounds but not of the list inside one
    for poll, half in [(p, h) for p in range(5) for h in range(2)]:
        here = parts.filter((F.col("poll") == poll) & (F.col("half") == half))
        here.drop("half").coalesce(1).write.mode("append").parquet(f"{root}/polls")
    stream = t.spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/polls")
    streaming.emit_new_events(
        stream, f"{root}/out", f"{root}/cursor", f"{root}/checkpoint", "fixture_id", "minute", "pos", "poll"
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/out").select("fixture_id", "poll", "pos", "minute", "event_type")


@query(
    "poll_round",
    """
    WITH e AS (SELECT user_id AS fixture_id, event_id AS pos, CAST(json_extract_string(props, '$.k') AS BIGINT) AS minute,
                      ts >= TIMESTAMP '2024-01-15' AS fresh FROM events),
    c AS (SELECT fixture_id, arg_max(minute, pos) AS last_seen FROM e WHERE NOT fresh AND minute <> 0 GROUP BY 1),
    n AS (SELECT e.* FROM e LEFT JOIN c USING (fixture_id) WHERE fresh AND minute > coalesce(last_seen, 0)),
    m AS (SELECT fixture_id, arg_max(minute, pos) AS last_seen, count(*) AS n_new FROM n GROUP BY 1)
    SELECT c.fixture_id, coalesce(m.last_seen, c.last_seen) AS last_seen, coalesce(n_new, 0) AS n_new
    FROM c LEFT JOIN m USING (fixture_id)
    UNION ALL SELECT fixture_id, last_seen, n_new FROM m WHERE fixture_id NOT IN (SELECT fixture_id FROM c)
    """,
)
def poll_round(t):
    """One round as plain DataFrames: new events against a cursor, and the cursor after them."""
    polls = t.events.selectExpr(*POLLS, "ts >= TIMESTAMP_NTZ'2024-01-15 00:00:00' AS fresh")
    none = t.spark.createDataFrame([], "fixture_id bigint, last_seen bigint")
    before = streaming.new_events(polls.filter("not fresh"), none, "fixture_id", "minute", "pos")
    cursor = streaming.next_cursor(before, none, "fixture_id", "minute", "pos")
    emitted = streaming.new_events(polls.filter("fresh"), cursor, "fixture_id", "minute", "pos")
    after = streaming.next_cursor(emitted, cursor, "fixture_id", "minute", "pos")
    counts = emitted.groupBy("fixture_id").agg(F.count(F.lit(1)).alias("n_new"))
    joined = after.join(counts, "fixture_id", "left")
    return joined.select("fixture_id", "last_seen", F.coalesce("n_new", F.lit(0)).alias("n_new"))


@query(
    "stream_publish",
    "SELECT CAST(user_id AS VARCHAR) AS key, user_id AS fixture_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,"
    " '2025-02-01T00:00:00.000000+00:00' AS ingested_at_utc FROM events",
)
def stream_publish(t):
    """New events published as keyed JSON messages to a log of files."""
    root = scratch_path(t.spark, "publish")
    rows = t.events.select(F.col("user_id").alias("fixture_id"), F.try_parse_json("props").alias("event"))
    rows.write.parquet(f"{root}/events")
    stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/events")
    messages = streaming.live_messages(stream, _loaded_at())
    S.write_log(messages, "json", {}, f"{root}/checkpoint", f"{root}/log").awaitTermination()
    log = P.parsed(t.spark.read.schema("key string, value string").json(f"{root}/log"), "value")
    p = F.col("p")
    return log.select(
        "key",
        P.number(p, "$.fixture_id").alias("fixture_id"),
        P.number(p, "$.event.k").alias("k"),
        P.jget(p, "$.ingested_at_utc", "string").alias("ingested_at_utc"),
    )


# Halves of the rounds, in the order in which they come: none more than one round late.
MIXED = [(0, 0), (1, 1), (0, 1), (2, 0), (1, 0), (3, 1), (2, 1), (4, 0), (3, 0), (4, 1)]


def _poll_rounds(root: str, **settings) -> streaming.PollRounds:
    return streaming.PollRounds(f"{root}/rounds", "fixture_id", "minute", "pos", "poll", **settings)


def _write_halves(t, root: str) -> None:
    """The rounds in halves, one file each, in mixed order."""
    derived.spread(t.events).selectExpr(*POLLS).write.parquet(f"{root}/all")
    stored = t.spark.read.parquet(f"{root}/all").withColumn("half", F.pmod(F.xxhash64("pos"), F.lit(2)))
    for poll, half in MIXED:
        here = stored.filter((F.col("poll") == poll) & (F.col("half") == half))
        # one file, but not one task that reads all rounds for it
        here.drop("half").repartition(1).write.mode("append").parquet(f"{root}/polls")


def _polls(t, path: str):
    schema = t.events.selectExpr(*POLLS).schema
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def _emitted(t, root: str):
    out = t.spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/rounds/out")
    return out.select("fixture_id", "poll", "pos", "minute", "event_type")


@query("stream_late_rounds", EMITTED)
def stream_late_rounds(t):
    """Halves of rounds in mixed order, up to one round late: the same events as from whole rounds in order."""
    root = scratch_path(t.spark, "late")
    _write_halves(t, root)
    rounds = _poll_rounds(root, lateness=1)
    rounds.run(_polls(t, f"{root}/polls"), f"{root}/checkpoint").awaitTermination()
    rounds.finish(t.spark)
    return _emitted(t, root)


@query(
    "stream_polls_to_fact",
    f"""
    SELECT fixture_id, CAST(minute AS BIGINT) AS event_elapsed_min, event_type, 'fixture.live.events' AS topic,
           CAST(1 AS BIGINT) AS times FROM ({EMITTED})
    """,
)
def stream_polls_to_fact(t):
    """Polls to closed rounds, to the log, to the live fact; publishing runs three times, twice under a new checkpoint."""
    root = scratch_path(t.spark, "published")
    _write_halves(t, root)
    rounds = _poll_rounds(root, lateness=1)
    rounds.run(_polls(t, f"{root}/polls"), f"{root}/checkpoint").awaitTermination()
    rounds.finish(t.spark)

    def messages(events):
        event = F.struct(F.struct(F.col("minute").alias("elapsed")).alias("time"), F.col("event_type").alias("type"))
        return streaming.live_messages(events.withColumn("event", event), _loaded_at(), ["poll", "pos"])

    options = {"topic": "fixture.live.events", "partitions": "3"}
    for checkpoint in ("publish", "publish", "publish_again"):
        streaming.publish_rounds(
            rounds, t.spark, messages, "json", options, f"{root}/{checkpoint}", f"{root}/log", ["poll", "pos"]
        ).awaitTermination()
        log = S.read_log(t.spark, "json", {"recursiveFileLookup": "true"}, f"{root}/log")
        streaming.stream_to_fact(log, f"{root}/raw", f"{root}/fact", f"{root}/land", loaded_at=_loaded_at()).awaitTermination()
    fact = t.spark.read.parquet(f"{root}/fact")
    times = F.count(F.lit(1)).over(Window.partitionBy("topic", "partition", "offset")).alias("times")
    return fact.select("fixture_id", "event_elapsed_min", "event_type", "topic", times)


@query("stream_bad_round", EMITTED.replace("AS BIGINT) AS poll, event_type FROM events)", "AS BIGINT) AS poll, event_type FROM events WHERE day(ts) NOT BETWEEN 15 AND 21)"))
def stream_bad_round(t):
    """One round of five that cannot be read: the stream is started again, leaves it out, lists it and goes on."""
    root = scratch_path(t.spark, "bad")
    polls = t.events.selectExpr(*POLLS)
    polls.write.parquet(f"{root}/all")
    stored = t.spark.read.schema(polls.schema).parquet(f"{root}/all")
    for poll in range(5):
        lines = stored.filter(F.col("poll") == poll).select(F.to_json(F.struct("*")).alias("value"))
        cut = F.expr("left(value, length(value) - 2)") if poll == 2 else F.col("value")
        lines.select(cut.alias("value")).coalesce(1).write.mode("append").text(f"{root}/polls")
    stream = t.spark.readStream.schema(polls.schema).option("mode", "FAILFAST").option("maxFilesPerTrigger", "1").json(f"{root}/polls")
    rounds = _poll_rounds(root, attempts=2)
    restarts = streaming.keep_running(t.spark, lambda: rounds.run(stream, f"{root}/checkpoint"))
    rounds.finish(t.spark)
    left_out = rounds.failures(t.spark).select("batch_id", F.size("files").alias("n")).collect()
    if restarts != 1 or [tuple(r) for r in left_out] != [(2, 1)]:
        raise AssertionError(f"restarts {restarts}, left out {left_out}")
    return _emitted(t, root)


@query(
    "stream_unseen_events",
    """
    SELECT user_id AS fixture_id, event_id AS pos, CAST(json_extract_string(props, '$.k') AS BIGINT) AS minute, event_type,
           CAST((day(ts) - 1) // 7 AS BIGINT) AS poll
    FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) <> 0
    """,
)
def stream_unseen_events(t):
    """The lossless rule: each poll repeats all events so far, and each event comes out once, with the first poll that had it."""
    root = scratch_path(t.spark, "unseen")
    polls = t.events.selectExpr(*POLLS)
    polls.write.parquet(f"{root}/all")
    stored = t.spark.read.schema(polls.schema).parquet(f"{root}/all")
    for poll in range(5):
        so_far = stored.filter(F.col("poll") <= poll).withColumn("poll", F.lit(poll).cast("bigint"))
        so_far.coalesce(1).write.mode("append").parquet(f"{root}/polls")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("poll") * 20)
    fresh = streaming.unseen_events(_polls(t, f"{root}/polls"), ["fixture_id", "pos", "minute", "event_type"], at, "3 days", "minute")
    writer = fresh.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    writer.start(f"{root}/out").awaitTermination()
    return t.spark.read.schema(polls.schema).parquet(f"{root}/out").select("fixture_id", "pos", "minute", "event_type", "poll")
