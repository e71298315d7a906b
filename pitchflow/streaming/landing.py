"""Log stream to RAW table and on to the live fact, each message once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchflow.functions import decode_message, epoch_ms_to_ntz, to_ntz_seconds
from pitchflow.operators.incremental import unseen
from pitchflow.plans.marts import fct_fixture_live_event
from pitchflow.plans.materialize import in_ranges, stored_near
from pitchflow.plans.models import EVENT_KEYS
from pitchflow.plans.staging import stg_kafka_fixture_live_events

DRAIN = {"availableNow": True}
#: Rows of a file: its payloads are read by one task.
FILE_ROWS = 1 << 16


def log_to_raw_rows(messages: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Log messages as rows of the live-event RAW table; a value that is not JSON is wrapped."""
    now = F.current_timestamp() if loaded_at is None else loaded_at
    return messages.select(
        to_ntz_seconds(now).alias("ingested_at"),
        "topic",
        "partition",
        "offset",
        F.col("key").alias("message_key"),
        epoch_ms_to_ntz(F.col("timestamp")).alias("kafka_timestamp"),
        decode_message(F.col("value")).alias("message_value"),
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream, kept with its checkpoint: batches count from 0 again under another one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _of_batch(stream_id: str, batch_id: int) -> Column:
    return (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)


def _land(rows: DataFrame, near: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Write rows that the table does not hold from any other batch to folders of this batch.

    A folder belongs to one batch of one stream, and running the batch again replaces exactly its folders: neither
    a crash, nor a second delivery, nor a new checkpoint, nor another topic's stream repeats or removes a row.
    `near` has the offsets of the batch.
    """
    stored = stored_near(near, path, "offset")
    if stored is not None:
        rows = unseen(rows, stored.filter(~_of_batch(stream_id, batch_id)), EVENT_KEYS)
    marked = in_ranges(rows, "offset").withColumns({"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("bigint")})
    writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_ROWS)
    writer.partitionBy("offset_range", "batch_id", "stream_id").parquet(path)


def stream_to_raw(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping = DRAIN,
    loaded_at: Column | None = None,
    fact_path: str | None = None,
) -> StreamingQuery:
    """Land a log stream in the RAW table at `path`, and with `fact_path` extend the live fact too.

    A message is stored once, whatever the stream, checkpoint or topic it comes by; two streams into one table must
    not run at the same time. Offsets are committed to `checkpoint` after the batch is written. `trigger` is
    `{"availableNow": True}` to drain the log and stop, or e.g. `{"processingTime": "1 second"}`;
    the rows per batch are bounded at the source (`maxOffsetsPerTrigger`, `maxFilesPerTrigger`).
    """

    known: list[str] = []

    def land(batch: DataFrame, batch_id: int) -> None:
        known.extend([] if known else [_stream_id(batch.sparkSession, checkpoint)])
        # read several times below: for its bounds and its rows
        batch.persist()
        try:
            _land(log_to_raw_rows(batch.dropDuplicates(list(EVENT_KEYS)), loaded_at), batch, path, known[0], batch_id)
            landed = stored_near(batch, path, "offset") if fact_path else None
            if landed is not None:
                landed = landed.filter(_of_batch(known[0], batch_id))
                _land(fct_fixture_live_event(stg_kafka_fixture_live_events(landed)), batch, fact_path, known[0], batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def stream_to_fact(
    stream: DataFrame,
    raw_path: str,
    fact_path: str,
    checkpoint: str,
    trigger: Mapping = DRAIN,
    loaded_at: Column | None = None,
) -> StreamingQuery:
    """Land a log stream and extend the live-event fact in the same micro-batches."""
    return stream_to_raw(stream, raw_path, checkpoint, trigger, loaded_at, fact_path)
