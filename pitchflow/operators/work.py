"""What is left to fetch, and which entities are live."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status codes of a match in play.
LIVE_CODES = ("1H", "2H", "HT", "ET", "BT", "P", "INT")
LIVE_ZONE = "Asia/Bangkok"


def work_items(entities: DataFrame, expand: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Every entity x every value of each `expand` list."""
    work = entities.distinct()
    for name, values in (expand or {}).items():
        work = work.withColumn(name, F.explode(F.lit(list(values))))
    return work


def pending_work(entities: DataFrame, ledger: DataFrame, expand: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Work items not in the ledger: every entity x every value of each `expand` list, minus done.

    The lists are configuration (seasons, endpoints), so they expand each entity row in place; no
    join of two tables makes the key space. Any kind of interrupted load resumes from here.
    """
    work = work_items(entities, expand)
    return work.join(ledger.select(*work.columns).distinct(), work.columns, "left_anti")


def active_entities(
    df: DataFrame, id_col: str, ts: str, now: Column, days: int = 3, where: Column | None = None
) -> DataFrame:
    """Distinct ids with a time in the last `days` days up to `now`, both ends included.

    Only the id comes out, so distinct does what a latest-row rank would, with a map-side combine.
    """
    since = now - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = df.filter(F.col(ts).between(since, now))
    if where is not None:
        recent = recent.filter(where)
    return recent.select(id_col).distinct()


def live_today(
    df: DataFrame,
    ts: str,
    status: str,
    day: dt.date,
    codes: Sequence[str] = LIVE_CODES,
    zone: str = LIVE_ZONE,
) -> DataFrame:
    """Rows in play on the local date `day`, tagged `feed_type = 'live'`.

    The local day becomes two constants, so the time filter reaches the scan.
    """
    start = dt.datetime.combine(day, dt.time())

    def utc(local: dt.datetime) -> Column:
        return F.to_utc_timestamp(F.lit(local.isoformat(sep=" ")).cast("timestamp_ntz"), zone)

    bounds = [utc(start), utc(start + dt.timedelta(days=1))]
    bounds = [b.cast(df.schema[ts].dataType) for b in bounds]
    in_day = (F.col(ts) >= bounds[0]) & (F.col(ts) < bounds[1])
    return df.filter(in_day & F.col(status).isin(*codes)).withColumn("feed_type", F.lit("live"))
