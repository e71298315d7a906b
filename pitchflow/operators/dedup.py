"""One row, or the first n rows, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest n Spark limits per key on the map side (spark.sql.optimizer.windowGroupLimitThreshold).
MAP_SIDE_LIMIT = 1000


def first_n_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    n: int = 1,
    rank: str | None = None,
    salts: int = 64,
) -> DataFrame:
    """The first `n` rows per key under `order_by`, optionally with their rank as column `rank`.

    `order_by` should end in a tie-breaker that is unique within a key, or the choice is arbitrary.
    Up to n = 1000 Spark keeps only n rows per key in every map task before the shuffle, so a key
    holding a third of all rows ships a few rows per task. Beyond that the cut is made here in two
    steps: first within (key, salt), which splits a hot key over `salts` tasks, then within key.
    """
    name = rank or "_rank"
    if n >= MAP_SIDE_LIMIT:
        # by task, not by content: even copies of one row are split
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        salted = Window.partitionBy(*keys, "_salt").orderBy(*order_by)
        df = df.withColumn("_salt", salt).withColumn("_rank_in_salt", F.row_number().over(salted))
        df = df.filter(F.col("_rank_in_salt") <= n).drop("_rank_in_salt", "_salt")
    window = Window.partitionBy(*keys).orderBy(*order_by)
    out = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    ties: Sequence[Column] = (),
    n: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """The newest `n` rows per key; a NULL in `order_by` counts as newest."""
    return first_n_by(df, keys, [F.col(order_by).desc_nulls_first(), *ties], n, rank)


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys: nothing but the keys is shuffled, and copies collapse before it."""
    return df.select(*keys).distinct()


def group_max(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Largest value of `column` per key, under its own name."""
    return df.groupBy(*keys).agg(F.max(column).alias(column))

