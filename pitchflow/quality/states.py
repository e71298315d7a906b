"""Check reports of a growing table from states per load: an append reads its own rows and the key ranges it touches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.quality.checks import Check, _entry
from pitchflow.session import child_names, delete_path, path_exists

_SCHEMA = "place int, range int, value long, number long"


@dataclass(frozen=True)
class CheckStates:
    """States of a model's checks below `root`; `report` equals `run_checks` over all loads together.

    Failures of row checks add up. For a uniqueness check a load's key groups (keys, number of rows) are merged with those known in
    the hash ranges it touches, and only these ranges are read and written again, in a folder of the load; the newest load that touched
    a range has its groups and the number of its repeated keys. A load is committed by its summary, written last: one that
    stopped before is not there, may be added again, and a committed one is never counted twice. Loads are added one at
    a time. `ranges` must stay as it is for a state; a range should fit a few tasks. Keys are types that can be grouped; none is called
    key_range or n_records.
    """

    root: str
    checks: tuple[Check, ...]
    model: str
    ranges: int = 256

    def add(self, rows: DataFrame, load: str) -> None:
        """Take in the rows of a load, named once and for all."""
        spark = rows.sparkSession
        done = self._committed(spark)
        if load in done:
            return
        fails = [F.coalesce(F.count_if(c.fails()), F.lit(0)) for c in self.checks if not c.unique]
        places = [k for k, c in enumerate(self.checks) if not c.unique]
        entries = [F.struct(F.lit(k).alias("place"), F.lit(-1).alias("range"), n.alias("value")) for k, n in zip(places, fails, strict=True)]
        summary = [rows.agg(F.array(*entries).alias("all")).select(F.inline("all"))] if entries else []
        for place, check in enumerate(self.checks):
            if check.unique:
                merged = self._merge(rows, place, check, load)
                if merged is not None:
                    repeated = merged.groupBy("key_range").agg(F.count_if(F.col("n_records") > 1).alias("value"))
                    summary.append(repeated.select(F.lit(place).alias("place"), F.col("key_range").cast("int").alias("range"), "value"))
        if not summary:
            summary = [spark.createDataFrame([], "place int, range int, value long")]
        numbered = reduce(DataFrame.unionByName, summary).withColumn("number", F.lit(len(done)).cast("long"))
        numbered.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/summary/load={load}")

    def report(self, spark: SparkSession) -> DataFrame:
        """Report as `run_checks` makes it, from the summaries alone."""
        newest = self._summaries(spark).groupBy("place", "range", F.when(F.col("range") < 0, F.col("number")).alias("each"))
        newest = newest.agg(F.max_by("value", "number").alias("value"))
        entries = F.array(*(F.struct(F.lit(k).alias("place"), _entry(self.model, c, F.lit(0)).alias("entry")) for k, c in enumerate(self.checks)))
        declared = spark.range(1).select(F.inline(entries))
        total = newest.groupBy("place").agg(F.sum("value").alias("n"))
        failures = F.coalesce("n", F.lit(0)).alias("failures")
        out = declared.join(total, "place", "left").select("entry.model", "entry.test", "entry.column", "entry.severity", failures)
        return out.withColumn("passed", F.col("failures") == 0)

    def _merge(self, rows: DataFrame, place: int, check: Check, load: str) -> DataFrame | None:
        """Write the groups of the ranges that the load touches; None where it has no key."""
        spark, keys = rows.sparkSession, list(check.unique)
        target = f"{self.root}/groups/check={place}/load={load}"
        counted = rows if check.where is None else rows.filter(check.where)
        fresh = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
        fresh = fresh.withColumn("key_range", F.pmod(F.xxhash64(*keys), F.lit(self.ranges)).cast("int"))
        fresh.hint("rebalance", "key_range").write.mode("overwrite").partitionBy("key_range").parquet(f"{target}/new")
        touched = {int(n.removeprefix("key_range=")) for n in child_names(spark, f"{target}/new") if n.startswith("key_range=")}
        if not touched:
            return None
        known = self._newest(spark, place, touched)
        schema = fresh.schema
        groups = spark.read.schema(schema).parquet(f"{target}/new")
        for folder, here in known.items():
            paths = [f"{folder}/key_range={r}" for r in sorted(here)]
            groups = groups.unionByName(spark.read.schema(schema).option("basePath", folder).parquet(*paths))
        merged = groups.groupBy("key_range", *keys).agg(F.sum("n_records").alias("n_records"))
        merged.hint("rebalance", "key_range").write.mode("overwrite").partitionBy("key_range").parquet(f"{target}/all")
        delete_path(spark, f"{target}/new")
        return spark.read.schema(merged.schema).parquet(f"{target}/all")

    def _newest(self, spark: SparkSession, place: int, touched: set[int]) -> dict[str, set[int]]:
        """The folders that hold the newest groups of the touched ranges; there are at most `ranges` of them."""
        rows = self._summaries(spark).filter((F.col("place") == place) & (F.col("range") >= 0))
        out: dict[str, set[int]] = {}
        for r in rows.groupBy("range").agg(F.max_by("load", "number").alias("load")).collect():
            if r["range"] in touched:
                out.setdefault(f"{self.root}/groups/check={place}/load={r['load']}/all", set()).add(r["range"])
        return out

    def drop_old(self, spark: SparkSession) -> None:
        """Remove the groups that a newer load has taken over, while no load is added."""
        for place in (k for k, c in enumerate(self.checks) if c.unique):
            newest = self._newest(spark, place, set(range(self.ranges)))
            for load in self._committed(spark):
                folder = f"{self.root}/groups/check={place}/load={load}/all"
                kept = {f"key_range={r}" for r in newest.get(folder, ())}
                for name in child_names(spark, folder):
                    if name.startswith("key_range=") and name not in kept:
                        delete_path(spark, f"{folder}/{name}")

    def _summaries(self, spark: SparkSession) -> DataFrame:
        folders = [f"{self.root}/summary/load={n}" for n in self._committed(spark)]
        if not folders:
            return spark.createDataFrame([], f"{_SCHEMA}, load string")
        return spark.read.schema(f"{_SCHEMA}, load string").option("basePath", f"{self.root}/summary").parquet(*folders)

    def _committed(self, spark: SparkSession) -> list[str]:
        found = child_names(spark, f"{self.root}/summary")
        return [n.removeprefix("load=") for n in found if path_exists(spark, f"{self.root}/summary/{n}/_SUCCESS")]


def check_states(root: str, checks: Sequence[Check], model: str, ranges: int = 256) -> CheckStates:
    """States of these checks below `root`."""
    return CheckStates(root, tuple(checks), model, ranges)
