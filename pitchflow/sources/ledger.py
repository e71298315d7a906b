"""A load that can stop anywhere: data first, then the ledger of the work that is done, by attempt."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.operators.work import work_items
from pitchflow.session import child_names, delete_path, path_exists, scratch_path


@dataclass(frozen=True)
class LedgerLoad:
    """Rows of work items below `root`, and the ledger of the items that are loaded.

    An attempt loads some work items. It writes their rows to a folder of its own and then, as its commit, ledger rows with its id: rows
    of an attempt without ledger are not there for readers, and its items are still pending. An item without rows is done as
    well. Where two loads commit one item, the attempt that comes first in the ledger has it and the other's rows of it are not read, so
    neither a stop between the two writes nor a second load loses or repeats a row. `keys` name a work item, in the ledger and in the rows.
    """

    root: str
    keys: tuple[str, ...]

    def done(self, spark: SparkSession) -> DataFrame | None:
        """(keys, attempt, committed_at) of the items that are loaded, one row each; None before the first commit."""
        folders = [f"{self.root}/ledger/{n}" for n in self._committed(spark)]
        if not folders:
            return None
        rows = spark.read.parquet(*folders)
        return rows.groupBy(*self.keys).agg(F.min(F.struct("committed_at", "attempt")).alias("_w")).select(*self.keys, "_w.attempt", "_w.committed_at")

    def pending(self, entities: DataFrame, expand: dict[str, Sequence] | None = None) -> DataFrame:
        """Work items not done yet; a NULL in the name of one is a name like any other."""
        work, done = work_items(entities, expand), self.done(entities.sparkSession)
        if done is None:
            return work
        same = [F.col(f"w.{k}").eqNullSafe(F.col(f"d.{k}")) for k in self.keys]
        return work.alias("w").join(done.alias("d"), same, "left_anti")

    def write(self, rows: DataFrame, attempt: str) -> None:
        """The first half of an attempt: its rows."""
        rows.write.mode("overwrite").parquet(f"{self.root}/data/attempt={attempt}")

    def commit(self, work: DataFrame, attempt: str) -> None:
        """The second half: its work items, with the time of the commit."""
        items = work.select(*self.keys).distinct()
        marked = items.withColumns({"attempt": F.lit(attempt), "committed_at": F.current_timestamp()})
        marked.write.mode("overwrite").parquet(f"{self.root}/ledger/attempt={attempt}")

    def run(self, work: DataFrame, fetch: Callable[[DataFrame], DataFrame], slices: int = 1) -> None:
        """Load work items in so many attempts; `fetch` gives the rows of some items, with the keys of the item in each."""
        spark = work.sparkSession
        path = scratch_path(spark, "work")
        # the items are fixed before the first of them is loaded
        work.select(*self.keys).distinct().write.parquet(path)
        fixed = spark.read.schema(work.select(*self.keys).schema).parquet(path)
        for k in range(slices):
            part = fixed.filter(F.pmod(F.xxhash64(*self.keys), F.lit(slices)) == k)
            attempt = uuid.uuid4().hex
            self.write(fetch(part), attempt)
            self.commit(part, attempt)
        delete_path(spark, path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of committed work, each item's from one attempt."""
        names = self._committed(spark)
        if not names:
            raise FileNotFoundError(f"nothing is committed below {self.root}")
        folders = [f"{self.root}/data/{n}" for n in names]
        rows = spark.read.option("basePath", f"{self.root}/data").option("mergeSchema", "true").parquet(*folders)
        rows = rows.withColumn("attempt", F.col("attempt").cast("string"))
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"d.{k}")) for k in (*self.keys, "attempt")]
        return rows.alias("r").join(self.done(spark).alias("d"), same, "left_semi").drop("attempt")

    def clear_stopped(self, spark: SparkSession) -> list[str]:
        """Remove the rows of attempts that never committed, while no load is running; returns their ids."""
        kept = set(self._committed(spark))
        stopped = [n for n in child_names(spark, f"{self.root}/data") if n not in kept]
        for n in stopped:
            delete_path(spark, f"{self.root}/data/{n}")
        return [n.removeprefix("attempt=") for n in stopped]

    def _committed(self, spark: SparkSession) -> list[str]:
        found = child_names(spark, f"{self.root}/ledger")
        return [n for n in found if path_exists(spark, f"{self.root}/ledger/{n}/_SUCCESS")]
