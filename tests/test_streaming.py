"""Streams with restarts and replays, and poll rounds against brute force."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchflow import plans, streaming
from pitchflow import sources as S
from pitchflow.sources import log
from pitchflow.streaming import landing


def at():
    return F.lit("2025-08-16 10:00:00").cast("timestamp")


def write_log(path, name, rows):
    path.mkdir(parents=True, exist_ok=True)
    keys = ("topic", "partition", "offset", "key", "value", "timestamp")
    (path / name).write_text("\n".join(json.dumps(dict(zip(keys, r, strict=True))) for r in rows))


def land(spark, tmp_path):
    stream = S.read_log(spark, "json", {"maxFilesPerTrigger": "1"}, str(tmp_path / "log"))
    streaming.stream_to_raw(stream, str(tmp_path / "raw"), str(tmp_path / "ckpt"), loaded_at=at()).awaitTermination()
    return spark.read.parquet(str(tmp_path / "raw"))


def test_landing_restart_and_replay(spark, tmp_path):
    log = tmp_path / "log"
    first = [("t", 0, i, "100", json.dumps({"fixture_id": 100, "n": i}), 1700000000123) for i in range(5)]
    write_log(log, "a.json", first + first[:2])
    assert land(spark, tmp_path).count() == 5
    assert land(spark, tmp_path).count() == 5  # nothing new after a restart
    assert (tmp_path / "raw" / "offset_range=0" / "batch_id=0").is_dir()
    write_log(log, "b.json", first)  # the same messages delivered again
    write_log(log, "c.json", [("t", 1, 0, None, "<oops", None), ("t", 1, 1, "100", "", None), ("t", 0, 9, "100", None, None)])
    got = land(spark, tmp_path)
    assert got.count() == 8
    odd = {(r.partition, r.offset): r for r in got.withColumn("message_value", F.to_json("message_value")).filter("partition = 1 or offset = 9").collect()}
    assert odd[(1, 0)].message_value == '{"_raw":"<oops"}' and odd[(1, 0)].message_key is None
    assert odd[(1, 1)].message_value is None and odd[(0, 9)].message_value is None
    one = got.filter("partition = 0 and offset = 3").first()
    assert one.kafka_timestamp == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert one.ingested_at == dt.datetime(2025, 8, 16, 10)


def test_a_batch_that_runs_again_overwrites_itself(spark, tmp_path):
    log = tmp_path / "log"
    write_log(log, "a.json", [("t", 0, i, "1", "{}", 1) for i in range(4)])
    assert land(spark, tmp_path).count() == 4
    # the commit marker is gone, as after a crash between the write and the commit
    for marker in (tmp_path / "ckpt" / "commits").iterdir():
        marker.unlink()
    assert land(spark, tmp_path).count() == 4


def test_log_to_fact(spark, tmp_path):
    from test_models import message

    write_log(tmp_path / "log", "a.json", [("t", 0, i, "100", message(), 1700000000123) for i in range(3)])
    stream = S.read_log(spark, "json", {}, str(tmp_path / "log"))
    paths = [str(tmp_path / p) for p in ("raw", "fact", "ckpt")]
    streaming.stream_to_fact(stream, *paths, loaded_at=at()).awaitTermination()
    write_log(tmp_path / "log", "b.json", [("t", 0, i, "100", message(kind="Goal"), 1700000000123) for i in range(2, 6)])
    streaming.stream_to_fact(stream, *paths, loaded_at=at()).awaitTermination()
    fact = spark.read.parquet(paths[1])
    assert sorted(r.event_id for r in fact.collect()) == [f"t:0:{i}" for i in range(6)]
    assert plans.fct_fixture_live_goal(fact).count() == 3


def brute_force(polls):
    """The rule, event by event: polls = {poll: [(fixture, pos, minute)]}."""
    last, out = {}, []
    for poll in sorted(polls):
        start = dict(last)
        for fixture, pos, minute in sorted(polls[poll], key=lambda e: e[1]):
            if minute and minute > start.get(fixture, 0):
                out.append((fixture, poll, pos, minute))
                last[fixture] = minute
    return sorted(out)


def write_poll(spark, path, poll, events):
    df = spark.createDataFrame([(f, poll, p, m) for f, p, m in events], SCHEMA)
    df.write.mode("append").json(str(path))


SCHEMA = "fixture_id long, poll long, pos long, minute long"


def run_polls(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "polls"))
    streaming.emit_new_events(
        stream, str(tmp_path / "out"), str(tmp_path / "cursor"), str(tmp_path / "ckpt"), "fixture_id", "minute", "pos", "poll"
    ).awaitTermination()
    out = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(tmp_path / "out"))
    return sorted(tuple(r) for r in out.collect())


def test_poll_rules(spark, tmp_path):
    polls = {
        1: [(1, 0, 10), (1, 1, 10), (1, 2, 0), (1, 3, None), (2, 0, 5)],
        2: [(1, 0, 10), (1, 1, 10), (1, 2, 12), (2, 0, 5)],
        3: [(1, 0, 12), (1, 1, 50), (1, 2, 40)],
        4: [(1, 0, 45), (1, 1, 60)],
    }
    write_poll(spark, tmp_path / "polls", 1, polls[1])
    write_poll(spark, tmp_path / "polls", 2, polls[2])
    assert run_polls(spark, tmp_path) == brute_force({k: polls[k] for k in (1, 2)})
    assert run_polls(spark, tmp_path) == brute_force({k: polls[k] for k in (1, 2)})  # a restart emits nothing
    write_poll(spark, tmp_path / "polls", 3, polls[3])
    write_poll(spark, tmp_path / "polls", 4, polls[4])
    # the last emitted of poll 3 is 40, not 50, so 45 passes in poll 4
    assert run_polls(spark, tmp_path) == brute_force(polls)
    assert (1, 4, 0, 45) in brute_force(polls)


def test_polls_random_with_a_hot_fixture(spark, tmp_path):
    rng = random.Random(3)
    polls = {p: [(0 if i % 3 == 0 else rng.randrange(1, 8), i, rng.choice([None, 0, *range(1, 95)])) for i in range(120)] for p in range(1, 4)}
    for p, events in polls.items():
        write_poll(spark, tmp_path / "polls", p, events)
    assert run_polls(spark, tmp_path) == brute_force(polls)


def test_a_round_split_over_batches(spark, tmp_path):
    """Parts of a round arrive one micro-batch after another, in any order of the list; none is lost or repeated."""
    rng = random.Random(8)
    polls = {p: [(rng.randrange(3), i, rng.choice([None, 0, *range(1, 95)])) for i in range(40)] for p in range(1, 4)}
    polls[0] = [(9, 0, 50), (9, 1, 10)]
    for p in sorted(polls):
        parts = list(polls[p])
        rng.shuffle(parts)
        for part in ([parts[:1], parts[1:]] if p == 0 else [parts[:13], parts[13:30], parts[30:]]):
            write_poll(spark, tmp_path / "polls", p, part)
            run_polls(spark, tmp_path)
    assert run_polls(spark, tmp_path) == brute_force(polls)
    assert (9, 0, 1, 10) in brute_force(polls)


def test_old_cursors_go(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("out", "cursor", "ckpt")]
    for p in range(1, 5):
        write_poll(spark, tmp_path / "polls", p, [(1, 0, p)])
        stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "polls"))
        streaming.emit_new_events(stream, *paths, "fixture_id", "minute", "pos", "poll", keep_versions=1).awaitTermination()
    assert len(list((tmp_path / "cursor").iterdir())) == 2
    assert spark.read.option("recursiveFileLookup", "true").parquet(paths[0]).count() == 4


def test_poll_batch_that_runs_again(spark, tmp_path):
    polls = {1: [(1, 0, 10)], 2: [(1, 0, 10), (1, 1, 20)]}
    for p in polls:
        write_poll(spark, tmp_path / "polls", p, polls[p])
    first = run_polls(spark, tmp_path)
    for marker in (tmp_path / "ckpt" / "commits").iterdir():
        marker.unlink()
    assert run_polls(spark, tmp_path) == first == brute_force(polls)


def test_messages_and_log_sink(spark, tmp_path):
    df = spark.createDataFrame([(100, '{"time":{"elapsed":5}}')], "fixture_id long, event string").withColumn("event", F.parse_json("event"))
    got = streaming.live_messages(df, at()).first()
    assert got.key == "100"
    assert json.loads(got.value) == {"ingested_at_utc": "2025-08-16T10:00:00.000000+00:00", "fixture_id": 100, "event": {"time": {"elapsed": 5}}}
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    S.write_log(streaming.live_messages(stream, at()), "json", {}, str(tmp_path / "ck"), str(tmp_path / "log")).awaitTermination()
    assert spark.read.json(str(tmp_path / "log")).count() == 1


def test_incremental_reads_only_near_folders(spark, tmp_path):
    path = str(tmp_path / "fact")
    wide = spark.range(0, 5 << 20, 1 << 18).withColumnRenamed("id", "offset").withColumn("v", F.lit(0))
    plans.merge_incremental(wide, path, ["offset"], "offset")
    near = plans.materialize.stored_near(wide.filter(F.col("offset") < 1 << 20), path, "offset")
    assert len(near.inputFiles()) == 1 and near.count() == 4
    again = wide.withColumn("v", F.lit(1)).unionByName(spark.createDataFrame([(77, 1), (77, 1), (9 << 20, 1)], "offset long, v int"))
    plans.merge_incremental(again, path, ["offset"], "offset")
    got = plans.read_incremental(spark, path, wide.schema, "offset")
    assert got.columns == ["offset", "v"] and got.count() == 22 and got.filter("v = 1").count() == 2


def test_live_path_from_polls_to_views(spark, tmp_path):
    """Polled responses -> new events -> messages -> log -> RAW -> fact -> goal view."""
    from pitchflow.functions import number

    def event(minute, kind, player):
        return {"time": {"elapsed": minute}, "type": kind, "detail": "d", "team": {"id": 1, "name": "R"}, "player": {"id": player, "name": f"p{player}"}, "assist": {}}

    first = [event(5, "Goal", 7)]
    second = [*first, event(30, "Card", 8), event(60, "Goal", 9)]
    polls = [(100, 1, first), (200, 1, []), (100, 2, second), (200, 2, [event(10, "subst", 3)])]
    (tmp_path / "polls").mkdir()
    lines = [json.dumps({"fixture_id": f, "poll": p, "body": json.dumps({"response": r})}) for f, p, r in polls]
    (tmp_path / "polls" / "a.json").write_text("\n".join(lines))

    stream = spark.readStream.schema("fixture_id long, poll long, body string").json(str(tmp_path / "polls"))
    items = S.read_envelope(stream, "fixture_events", carry=("poll",))
    events = items.select("fixture_id", "poll", "pos", number(F.col("payload"), "$.time.elapsed").alias("minute"), F.col("payload").alias("event"))
    out = str(tmp_path / "new")
    streaming.emit_new_events(
        events, out, str(tmp_path / "cursor"), str(tmp_path / "c1"), "fixture_id", "minute", "pos", "poll"
    ).awaitTermination()
    fresh = spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(out)
    assert sorted((r.fixture_id, r.poll, r.minute) for r in fresh.drop("event").collect()) == [(100, 1, 5), (100, 2, 30), (100, 2, 60), (200, 2, 10)]

    log = streaming.live_messages(fresh, at()).withColumn("offset", F.row_number().over(Window.orderBy("key", "value")).cast("long"))
    log.selectExpr("'live' AS topic", "0 AS partition", "offset", "key", "value", "cast(NULL AS long) AS timestamp").write.json(str(tmp_path / "log"))
    source = S.read_log(spark, "json", {}, str(tmp_path / "log"))
    fact_path = str(tmp_path / "fact")
    streaming.stream_to_fact(source, str(tmp_path / "raw"), fact_path, str(tmp_path / "c2"), loaded_at=at()).awaitTermination()
    fact = spark.read.parquet(fact_path)
    assert fact.count() == 4
    assert sorted((r.fixture_id, r.scorer_id, r.event_elapsed_min) for r in plans.fct_fixture_live_goal(fact).collect()) == [(100, 7, 5), (100, 9, 60)]
    assert {r.event_time for r in fact.collect()} == {dt.datetime(2025, 8, 16, 10)}
    sub = plans.fct_fixture_live_substitution(fact).first()
    assert (sub.fixture_id, sub.player_out_id, sub.player_in_id) == (200, 3, None)


def test_new_checkpoint_and_second_topic(spark, tmp_path):
    """Another log into the same table, the same log through another checkpoint, and a second topic: 30 rows, each once."""
    from pyspark.sql import functions as F

    def log(name, topic, first, n):
        rows = spark.range(first, first + n).select(
            F.lit(topic).alias("topic"),
            F.lit(0).alias("partition"),
            F.col("id").alias("offset"),
            F.lit("k").alias("key"),
            F.lit('{"fixture_id": 1}').alias("value"),
            F.lit(1_700_000_000_000).alias("timestamp"),
        )
        rows.repartition(2).write.json(str(tmp_path / name))
        return str(tmp_path / name)

    logs = [log("a", "x", 0, 10), log("b", "x", 10, 10), log("c", "y", 0, 10)]
    for k, path in enumerate([*logs, logs[0]]):
        stream = S.read_log(spark, "json", {"maxFilesPerTrigger": "1"}, path)
        out = (str(tmp_path / "raw2"), str(tmp_path / "fact2"), str(tmp_path / f"checkpoint{k}"))
        streaming.stream_to_fact(stream, *out, loaded_at=at()).awaitTermination()
    for table in ("raw2", "fact2"):
        found = spark.read.parquet(str(tmp_path / table)).groupBy("topic", "offset").count().collect()
        assert len(found) == 30 and all(r["count"] == 1 for r in found)


def poll_rounds(tmp_path, **settings):
    return streaming.PollRounds(str(tmp_path / "rounds"), "fixture_id", "minute", "pos", "poll", **settings)


def take_in(spark, tmp_path, rounds, options=None):
    stream = spark.readStream.schema(SCHEMA).options(**{"maxFilesPerTrigger": "1"} | (options or {})).json(str(tmp_path / "polls"))
    rounds.run(stream, str(tmp_path / "ckpt")).awaitTermination()


def rounds_out(spark, tmp_path):
    if not (tmp_path / "rounds" / "out").exists():
        return []
    out = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(tmp_path / "rounds" / "out"))
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] is None, r))


def test_parts_of_rounds_in_any_order_within_the_lateness(spark, tmp_path):
    rng = random.Random(21)
    polls = {p: [(rng.randrange(3), i, rng.choice([None, 0, *range(1, 60)])) for i in range(30)] for p in range(6)}
    polls[3] += [(7, 100 + i, m) for i, m in enumerate([5, 50, 20])]
    polls[4] += [(7, 100 + i, m) for i, m in enumerate([30, 21, 20])]
    parts = [(p, half) for p in sorted(polls) for half in (polls[p][::2], polls[p][1::2])]
    parts.sort(key=lambda x: x[0] + rng.random() * 2)  # no part comes behind one that is more than two rounds later
    rounds = poll_rounds(tmp_path, lateness=2)
    for k, (p, events) in enumerate(parts):
        write_poll(spark, tmp_path / "polls", p, events)
        if k % 4 == 0:
            take_in(spark, tmp_path, rounds)
    take_in(spark, tmp_path, rounds)
    closed = {r[1] for r in rounds_out(spark, tmp_path)}
    assert closed <= {0, 1, 2} and closed
    rounds.finish(spark)
    rounds.finish(spark)  # nothing is left to close
    assert rounds_out(spark, tmp_path) == brute_force(polls)
    assert not (tmp_path / "rounds" / "late").exists()
    assert not list((tmp_path / "rounds" / "parts").iterdir())
    assert rounds.failures(spark).count() == 0


def test_a_part_that_is_too_late_is_kept_aside(spark, tmp_path):
    rounds = poll_rounds(tmp_path)
    for poll in (1, 2, 3):
        write_poll(spark, tmp_path / "polls", poll, [(1, poll, 10 * poll)])
    write_poll(spark, tmp_path / "polls", 1, [(1, 9, 12)])
    write_poll(spark, tmp_path / "polls", None, [(1, 9, 13)])
    take_in(spark, tmp_path, rounds)
    rounds.finish(spark)
    assert rounds_out(spark, tmp_path) == [(1, 1, 1, 10), (1, 2, 2, 20), (1, 3, 3, 30)]
    late = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(tmp_path / "rounds" / "late"))
    assert {tuple(r) for r in late.collect()} == {(1, 1, 9, 12), (1, None, 9, 13)}


def test_a_batch_of_rounds_that_runs_again(spark, tmp_path):
    """Without its commit a batch runs again: after its manifest it does nothing, before it it is replaced."""

    class Stopped(streaming.PollRounds):
        def _tidy(self, *args):
            """Stopped before the manifest, a batch removes nothing."""

    rounds = Stopped(str(tmp_path / "rounds"), "fixture_id", "minute", "pos", "poll")
    polls = {1: [(1, 0, 10), (2, 0, 5)], 2: [(1, 0, 10), (1, 1, 12)], 3: [(1, 0, 40), (None, 1, 3)]}
    for poll, events in polls.items():
        df = spark.createDataFrame([(f, poll, p, m) for f, p, m in events], SCHEMA)
        df.coalesce(1).write.mode("append").json(str(tmp_path / "polls"))
        take_in(spark, tmp_path, rounds)
    before = rounds_out(spark, tmp_path)
    commits = tmp_path / "ckpt" / "commits"

    def uncommit():
        for f in list(commits.glob("2")) + list(commits.glob(".2.crc")):
            f.unlink()

    uncommit()
    take_in(spark, tmp_path, rounds)
    assert rounds_out(spark, tmp_path) == before
    uncommit()
    for f in (tmp_path / "rounds" / "closed" / "0000000002-0").iterdir():
        f.unlink()
    take_in(spark, tmp_path, rounds)
    assert rounds_out(spark, tmp_path) == before
    rounds.finish(spark)
    assert rounds_out(spark, tmp_path) == [(1, 1, 0, 10), (1, 2, 1, 12), (1, 3, 0, 40), (2, 1, 0, 5), (None, 3, 1, 3)]


def test_a_failure_that_passes_is_tried_again(spark, tmp_path):
    """The second attempt of a batch succeeds: nothing is left out, and the query was started once more."""
    for poll in (1, 2, 3):
        write_poll(spark, tmp_path / "polls", poll, [(1, 0, 10 * poll)])
    rounds = poll_rounds(tmp_path, attempts=3)
    flag = tmp_path / "broken"
    flag.touch()

    class Broken(streaming.PollRounds):
        def _land(self, batch, batch_id):
            if batch_id == 1 and flag.exists():
                flag.unlink()
                raise OSError("storage is away")
            super()._land(batch, batch_id)

    broken = Broken(rounds.root, "fixture_id", "minute", "pos", "poll", attempts=3)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").json(str(tmp_path / "polls"))
    assert streaming.keep_running(spark, lambda: broken.run(stream, str(tmp_path / "ckpt"))) == 1
    broken.finish(spark)
    assert [r[1] for r in rounds_out(spark, tmp_path)] == [1, 2, 3]
    assert broken.failures(spark).count() == 0


def test_errors_without_progress_end_the_loop(spark, tmp_path):
    write_poll(spark, tmp_path / "polls", 1, [(1, 0, 10)])

    def start():
        def fail(batch, batch_id):
            raise OSError("always")

        stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "polls"))
        return stream.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()

    with pytest.raises(RuntimeError, match="3 errors"):
        streaming.keep_running(spark, start, restarts=2)


def test_same_minute_events_of_a_later_poll_come_out_once(spark, tmp_path):
    first = [(1, 0, 10), (2, 0, 5)]
    second = [(1, 0, 10), (1, 1, 10), (2, 0, 5)]  # a second event in minute 10
    for poll, events in ((1_700_000_000, first), (1_700_000_020, second), (1_700_000_040, second + [(2, 1, 0)])):
        write_poll(spark, tmp_path / "polls", poll, events)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").json(str(tmp_path / "polls"))
    fresh = streaming.unseen_events(stream, ["fixture_id", "pos", "minute"], F.timestamp_seconds("poll"), "3 days", "minute")
    writer = fresh.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt"))
    writer.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = sorted((r.fixture_id, r.pos, r.poll - 1_700_000_000) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 0, 0), (1, 1, 20), (2, 0, 0)]


def test_appended_messages_are_numbered_by_ranges_of_a_partition(spark, tmp_path):
    rows = [(None if i % 11 == 0 else i % 40, f"k{i % 5}", f"v{i % 60}") for i in range(500)]
    messages = spark.createDataFrame(rows, "pos int, key string, value string")
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        placed = log._places(messages.withColumn("partition", F.lit(0)), ["pos", "key", "value"], f"{tmp_path}/placed").collect()
    finally:
        spark.conf.unset(conf)
    # one partition of the log, and no task that sorts all of it
    assert len({r["_range"] for r in placed}) > 1
    first = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(((r["pos"], r["key"], r["value"], r["_place"]) for r in placed), key=lambda r: r[3])] == first
    assert sorted(r["_place"] for r in placed) == list(range(500))
    for _ in range(2):
        S.append_log(messages, "json", {"partitions": "2"}, f"{tmp_path}/log", "0000000007-0", ["pos"])
        got = spark.read.schema(S.LOG_SCHEMA).json(f"{tmp_path}/log/0000000007-0").collect()
        for partition in (0, 1):
            here = sorted((r for r in got if r["partition"] == partition), key=lambda r: r["offset"])
            keys = {r["key"] for r in here}
            assert [r["offset"] - (70 << 32) for r in here] == list(range(len(here)))
            assert [(r["key"], r["value"]) for r in here] == [r[1:] for r in first if r[1] in keys]
        assert len(got) == 500


def test_landed_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_ROWS", 10, raising=False)
    events = spark.range(0, 45, 1, 1).selectExpr("'t' AS topic", "0 AS partition", "id AS offset", "'k' AS key", "'{\"fixture_id\": 1}' AS value", "1L AS timestamp")
    events.coalesce(1).write.json(f"{tmp_path}/log")
    stream = S.read_log(spark, "json", {}, f"{tmp_path}/log")
    streaming.stream_to_fact(stream, f"{tmp_path}/raw", f"{tmp_path}/fact", f"{tmp_path}/checkpoint", loaded_at=at()).awaitTermination()
    for table in ("raw", "fact"):
        files = spark.read.parquet(f"{tmp_path}/{table}").groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in files) == 45 and max(r["count"] for r in files) <= 10
