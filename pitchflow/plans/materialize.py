"""Tables on a shared file system: full rebuilds by version, and an append-only incremental fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitchflow.operators.incremental import unseen
from pitchflow.session import child_names, delete_path, path_exists


def write_table(df: DataFrame, path: str) -> str:
    """Rebuild a table: write the next version next to the old ones and return its path.

    Readers use the newest version that has its success marker, so a rebuild that fails half-way
    changes nothing and a running reader keeps its files.
    """
    spark = df.sparkSession
    numbers = [int(n.split("=")[1]) for n in child_names(spark, path) if n.startswith("version=")]
    target = f"{path}/version={max(numbers, default=0) + 1:08d}"
    df.write.mode("errorifexists").parquet(target)
    return target


def drop_old_versions(spark: SparkSession, path: str, keep: int = 3) -> None:
    """Remove all but the newest `keep` complete versions, and what failed before the oldest of them."""
    names = [n for n in child_names(spark, path) if n.startswith("version=")]
    complete = [n for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS")]
    for name in names:
        if len(complete) > keep and name < complete[-keep]:
            delete_path(spark, f"{path}/{name}")


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a table written by `write_table`."""
    for name in reversed([n for n in child_names(spark, path) if n.startswith("version=")]):
        if path_exists(spark, f"{path}/{name}/_SUCCESS"):
            return spark.read.parquet(f"{path}/{name}")
    raise FileNotFoundError(f"no complete version below {path}")


# Offsets are stored in folders of 2^20 of them, so that a batch finds its neighbours without a listing.
RANGE_BITS = 20


def range_of(column: str) -> Column:
    """The folder number of a growing whole-number column."""
    return F.shiftright(F.col(column).cast("bigint"), RANGE_BITS)


def stored_near(src: DataFrame, path: str, column: str) -> DataFrame | None:
    """The stored rows between the smallest and the largest value of `column` in `src`; None when there are none.

    The two bounds are read from that column alone. They choose the folders and, within them, the row groups.
    """
    spark = src.sparkSession
    if not path_exists(spark, path):
        return None
    low, high = src.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    first, last = int(low) >> RANGE_BITS, int(high) >> RANGE_BITS
    named = ((n, n.removeprefix(f"{column}_range=")) for n in child_names(spark, path))
    folders = [f"{path}/{n}" for n, number in named if number.lstrip("-").isdigit() and first <= int(number) <= last]
    if not folders:
        return None
    return spark.read.option("basePath", path).parquet(*folders).filter(F.col(column).between(low, high))


def in_ranges(df: DataFrame, column: str) -> DataFrame:
    """`df` with its range column, gathered by it so that a folder gets few files; big ranges are split."""
    name = f"{column}_range"
    return df.withColumn(name, range_of(column)).hint("rebalance", name)


def read_incremental(spark: SparkSession, path: str, schema: StructType, prune: str | None = None) -> DataFrame:
    """A table written by `merge_incremental`, possibly still without rows."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*[c for c in df.columns if c != f"{prune}_range"])


def merge_incremental(src: DataFrame, path: str, keys: Sequence[str], prune: str | None = None) -> None:
    """Append the rows of `src` whose key the table does not hold; the first run loads everything.

    Copies inside `src` count once. Since known keys are left out, merging by key is appending: the
    table is never rewritten. `prune` names a growing key column such as a log offset: the table is
    then kept in folders by ranges of it, and only those an increment touches are compared.
    """
    spark = src.sparkSession
    fresh = src.dropDuplicates(list(keys))
    if prune:
        stored = stored_near(src, path, prune)
        if stored is not None:
            fresh = unseen(fresh, stored, keys)
        in_ranges(fresh, prune).write.mode("append").partitionBy(f"{prune}_range").parquet(path)
        return
    if path_exists(spark, path):
        fresh = unseen(fresh, spark.read.schema(src.schema).parquet(path), keys)
    fresh.write.mode("append").parquet(path)
