"""RAW tables: append-only, a few typed keys and one VARIANT payload per row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.functions import to_ntz_seconds
from pitchflow.session import path_exists


@dataclass(frozen=True)
class SourceSpec:
    """A declared RAW table: its key columns, payload column and load-time column."""

    keys: tuple[tuple[str, str], ...]
    payload: str = "payload"
    loaded_at: str = "ingested_at"
    declared: bool = True

    @property
    def schema(self) -> str:
        """Columns of the table as DDL."""
        columns = [(self.loaded_at, "timestamp_ntz"), *self.keys, (self.payload, "variant")]
        return ", ".join(f"`{name}` {kind}" for name, kind in columns)


_SEASON = (("league_id", "bigint"), ("season", "int"))
_TEAM = (*_SEASON, ("team_id", "bigint"))
_FIXTURE = (*_SEASON, ("fixture_id", "bigint"))

# The RAW tables and their key columns.
SOURCES: dict[str, SourceSpec] = {
    "raw_league": SourceSpec(_SEASON),
    "raw_teams_info": SourceSpec(_TEAM),
    "raw_teams_statistics": SourceSpec(_SEASON),
    "raw_teams_squads": SourceSpec(_TEAM),
    "raw_teams_transfer": SourceSpec(_TEAM),
    "raw_player_trophies": SourceSpec(_TEAM),
    "raw_players_statistics": SourceSpec(_TEAM),
    "raw_fixture_statistics": SourceSpec((*_FIXTURE, ("team_id", "bigint"), ("side", "string"))),
    "raw_fixture_event": SourceSpec(_FIXTURE),
    "raw_fixture_info": SourceSpec((*_FIXTURE, ("home_team_id", "bigint"), ("away_team_id", "bigint"))),
    "raw_fixture_line_up": SourceSpec((*_FIXTURE, ("team_id", "bigint"))),
    "raw_fixture_predictions": SourceSpec(_FIXTURE),
    "raw_fixture_players_statistic": SourceSpec((*_FIXTURE, ("team_id", "bigint"))),
    "raw_fixture_odds": SourceSpec(_FIXTURE, declared=False),
    "football_manager_raw": SourceSpec((("source_file", "string"),)),
    "kafka_fixture_live_events": SourceSpec(
        (
            ("topic", "string"),
            ("partition", "int"),
            ("offset", "bigint"),
            ("message_key", "string"),
            ("kafka_timestamp", "timestamp_ntz"),
        ),
        payload="message_value",
    ),
}


def resolve_source(name: str) -> str:
    """Table name of a source; names are case-insensitive."""
    key = name.lower()
    if key not in SOURCES:
        raise KeyError(f"unknown source {name!r}")
    return key


def raw_rows(df: DataFrame, name: str) -> DataFrame:
    """The columns of RAW table `name` from extracted rows, cast to their declared types.

    `extracted_at` is the load time where there is no column of that name yet.
    """
    spec = SOURCES[resolve_source(name)]
    loaded = spec.loaded_at if spec.loaded_at in df.columns else "extracted_at"
    keys = [F.col(column).cast(kind).alias(column) for column, kind in spec.keys]
    return df.select(F.col(loaded).alias(spec.loaded_at), *keys, spec.payload)


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The RAW table `name` below `root`, with its declared schema."""
    key = resolve_source(name)
    return spark.read.schema(SOURCES[key].schema).parquet(f"{root}/{key}")


def append_raw(
    df: DataFrame, path: str, payload: str = "payload", loaded_at: Column | None = None, marks: str | None = None
) -> None:
    """Append rows to a RAW table: `payload` as strict JSON, `ingested_at` as whole UTC seconds.

    Text payloads must parse, or the append fails and leaves the table as it was. `ingested_at`
    comes from the rows or, where they lack it, from `loaded_at` (default: now). No rows, no files'
    worth of work. With `marks`, the newest load time and the number of rows, counted while they are written, are committed there
    as one row, after the rows: `marked_freshness` reads these alone.
    """
    out = df
    if "ingested_at" not in df.columns:
        out = out.withColumn("ingested_at", F.current_timestamp() if loaded_at is None else loaded_at)
    out = out.withColumn("ingested_at", to_ntz_seconds(F.col("ingested_at")))
    if not isinstance(df.schema[payload].dataType, T.VariantType):
        out = out.withColumn(payload, F.parse_json(payload))
    if marks is None:
        out.write.mode("append").parquet(path)
        return
    seen = Observation()
    out.observe(seen, F.max("ingested_at").alias("loaded_at"), F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    found = seen.get
    row = (found.get("loaded_at"), found.get("n") or 0)
    df.sparkSession.createDataFrame([row], MARK).coalesce(1).write.mode("append").parquet(marks)


#: What an append commits besides its rows.
MARK = "loaded_at timestamp_ntz, n bigint"


def marked_freshness(spark: SparkSession, marks: Mapping[str, str], as_of: Column) -> DataFrame:
    """As `source_freshness`, from the marks that the appends of each source committed: one row is read per append.

    An append that stopped before its mark counts from the next one on. A source without a mark has NULL.
    """
    none = spark.createDataFrame([], MARK)
    tables = {name: spark.read.schema(MARK).parquet(path) if path_exists(spark, path) else none for name, path in marks.items()}
    return source_freshness({name: (df, "loaded_at") for name, df in tables.items()}, as_of)


def export_json(df: DataFrame, prefix: str, stamp: str) -> str:
    """JSON lines under `<prefix>_<stamp>`; returns that path. `stamp` is a UTC time such as 20250816_142300."""
    path = f"{prefix}_{stamp}"
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def source_freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of: Column) -> DataFrame:
    """Per source its newest load time and its lag in whole seconds: source, loaded_at, lag_seconds.

    Each table is reduced by a partial maximum; Parquet needs to read one column only.
    """

    def one(name: str, df: DataFrame, column: str) -> DataFrame:
        newest = F.max(F.col(column).cast("timestamp_ntz"))
        return df.agg(newest.alias("loaded_at")).select(F.lit(name).alias("source"), "loaded_at")

    rows = reduce(DataFrame.unionByName, [one(name, df, column) for name, (df, column) in tables.items()])
    at = as_of.cast("timestamp")
    lag = F.unix_seconds(at) - F.unix_seconds(F.col("loaded_at").cast("timestamp"))
    return rows.withColumn("lag_seconds", lag)
