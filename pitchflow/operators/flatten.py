"""Unnest semi-structured arrays and objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(
    df: DataFrame,
    items: Column,
    value: str = "value",
    ordinal: str | None = None,
    key: str | None = None,
) -> DataFrame:
    """One row per element of the VARIANT `items`: array elements or object values.

    Rows whose `items` is NULL, JSON null, empty or a scalar are dropped; an element that is JSON
    null keeps its row. `ordinal` names the 0-based position, `key` the object key.
    """
    probe = df.withColumn("_items", items)
    spark = df.sparkSession
    out = probe.lateralJoin(spark.tvf.variant_explode(F.col("_items").outer()))
    kept = [F.col(c) for c in df.columns if c not in (value, ordinal, key)]
    added = [out["value"].alias(value)]
    if ordinal:
        added.append(out["pos"].cast("bigint").alias(ordinal))
    if key:
        added.append(out["key"].alias(key))
    return out.select(*kept, *added)
