"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.functions import name_key
from pitchflow.operators.dedup import first_n_by


def spread_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, spread_by: Sequence[str], salts: int = 64
) -> DataFrame:
    """Join a possibly skewed `left` to a `right` with at most one row per key.

    Rows of a key that holds a large share are split at run time, by the adaptive skew join. What that cannot know
    is that rows whose key is NULL match nothing: an outer or anti join would send all of those to one task,
    so they get a salt from the hash of `spread_by`. Nothing is read while the plan is built, and no size decides.
    """
    for c in on:
        kind = left.schema[c].dataType
        if right.schema[c].dataType != kind:
            right = right.withColumn(c, F.col(c).try_cast(kind))
    if how in ("inner", "left_semi"):
        return left.join(right, list(on), how)
    some_null = F.lit(False)
    for c in on:
        some_null = some_null | F.col(c).isNull()
    # a salt of 0 marks the keys that can match
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    salted = left.withColumn("_salt", F.when(some_null, salt).otherwise(F.lit(0)))
    return salted.join(right.withColumn("_salt", F.lit(0)), [*on, "_salt"], how).drop("_salt")


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    order_by: Sequence[Column],
    spread_by: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join each left row to the one right row of its id that comes last under `order_by`.

    Pass the orderings so that the wanted row sorts first (newest first).
    """
    return spread_join(left, first_n_by(right, [on], order_by), [on], how, spread_by)


def match_latest(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    spread_by: Sequence[str],
    order_by: Sequence[Column],
    key: str = "name_key",
    min_key_length: int = 0,
) -> DataFrame:
    """Left rows with the best right row of the same normalised name; unmatched rows are dropped.

    The best match of a left row depends only on its name key, so the right side is cut to one row
    per key first. The many-to-many join a popular name would fan out into never exists, and the
    rows are the same.
    """
    lhs = left.filter(F.col(left_name).isNotNull()).withColumn(key, name_key(F.col(left_name)))
    rhs = right.filter(F.col(right_name).isNotNull()).withColumn(key, name_key(F.col(right_name)))
    if min_key_length:
        lhs = lhs.filter(F.length(key) >= min_key_length)
        rhs = rhs.filter(F.length(key) >= min_key_length)
    return spread_join(lhs, first_n_by(rhs, [key], order_by), [key], "inner", spread_by)


def unmatched(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    spread_by: Sequence[str],
    key: str = "name_key",
) -> DataFrame:
    """Left rows whose normalised name occurs nowhere on the right; a NULL name matches nothing."""
    lhs = left.withColumn(key, name_key(F.col(left_name)))
    rhs = right.select(name_key(F.col(right_name)).alias(key)).distinct()
    return spread_join(lhs, rhs, [key], "left_anti", spread_by)
