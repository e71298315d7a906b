"""The event log: a Kafka topic, or files of the same shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchflow.session import delete_path, scratch_path

# Columns of a log message in files; a Kafka source has the same ones with bytes and a timestamp.
LOG_SCHEMA = "topic string, partition int, offset bigint, key string, value string, timestamp bigint"


def read_log(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """A stream of log messages with key and value as text and `timestamp` in epoch milliseconds.

    `fmt` is `kafka` (read from the earliest offset on the first run, then from the checkpoint) or
    a file format such as `json` or `parquet` holding LOG_SCHEMA.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        stream = reader.options(**{"startingOffsets": "earliest", **options}).load()
        return stream.selectExpr(
            "topic",
            "partition",
            "offset",
            "decode(key, 'UTF-8') AS key",
            "decode(value, 'UTF-8') AS value",
            "unix_millis(timestamp) AS timestamp",
        )
    return reader.schema(LOG_SCHEMA).options(**options).load(path)


def write_log(
    messages: DataFrame, fmt: str, options: Mapping[str, str], checkpoint: str, path: str | None = None
) -> StreamingQuery:
    """Publish (key, value) messages of a stream and stop when the input is drained.

    `messages` needs `key` and `value`; other columns are kept only by file formats.
    """
    out = messages.selectExpr("key", "value") if fmt == "kafka" else messages
    writer = out.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append").trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


# Offsets that one append may use in a partition of a log of files.
APPEND_BITS = 32


def append_log(
    messages: DataFrame, fmt: str, options: Mapping[str, str], path: str | None, name: str, order: Sequence[str]
) -> None:
    """Append a table of messages (key, value) to the log: a topic, or a folder `name` below `path`.

    In files the messages of a key share a partition (`partitions`, 4 if not in the options, of the topic `topic`) and stand there by
    `order`; `name` begins with the append's number, which gives its offsets. Appending `name` again replaces it by the
    same messages at the same offsets, while a topic receives them once more.
    """
    if fmt == "kafka":
        messages.selectExpr("key", "value").write.format(fmt).options(**options).save()
        return
    spark = messages.sparkSession
    number = int("".join(filter(str.isdigit, name)))
    partition = F.pmod(F.xxhash64("key"), F.lit(int(options.get("partitions", "4")))).cast("int")
    placed = _places(messages.withColumn("partition", partition), [*order, "key", "value"], scratch := scratch_path(spark, "append"))
    rows = placed.withColumn("offset", F.lit(number << APPEND_BITS) + F.col("_place"))
    stamp = F.unix_millis(F.current_timestamp()).alias("timestamp")
    rows = rows.select(F.lit(options.get("topic", "log")).alias("topic"), "partition", "offset", "key", "value", stamp)
    rows.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
    delete_path(spark, scratch)


def _places(rows: DataFrame, order: Sequence[str], scratch: str) -> DataFrame:
    """`rows` with their place from 0 within `partition` by `order`, as `_place`.

    A log has few partitions, so a window over them would sort the whole log in as few tasks. The rows are dealt into ranges of
    (partition, order) instead, as many as the shuffle has, and written to `scratch` in that order with a running number; a row's place is its
    number's distance from the first one of its partition and range, and what the partition has in earlier ranges.
    """
    spark = rows.sparkSession
    by = ["partition", *order]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = dealt.withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    dealt.write.parquet(scratch)
    dealt = spark.read.schema(dealt.schema).parquet(scratch)
    ranges = dealt.groupBy("partition", "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("partition").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    ranges = ranges.select("partition", "_range", shift.alias("_shift"))
    joined = dealt.join(ranges, ["partition", "_range"])
    return joined.withColumn("_place", F.col("_row") + F.col("_shift"))
