"""Rows to columns, always with a fixed list of output columns so that one shuffle is enough."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_max(
    df: DataFrame,
    keys: Sequence[str],
    type_col: str,
    value_col: str,
    mapping: Mapping[str, tuple[str, Callable[[Column], Column]]],
) -> DataFrame:
    """Per key, the largest converted value of every label in `mapping`: label -> (column, convert)."""
    picks = [
        F.max(F.when(F.col(type_col) == label, convert(F.col(value_col)))).alias(out)
        for label, (out, convert) in mapping.items()
    ]
    return df.groupBy(*keys).agg(*picks)


def rank_pivot(
    df: DataFrame,
    keys: Sequence[str],
    rank_col: str,
    fields: Mapping[str, Column],
    n: int,
    carry: Sequence[Column] = (),
    name: str = "{rank}_{field}",
) -> DataFrame:
    """Per key, the `fields` of the rows ranked 1..n side by side, plus the `carry` aggregates."""
    picks = [
        F.max(F.when(F.col(rank_col) == i, value)).alias(name.format(rank=i, field=field))
        for i in range(1, n + 1)
        for field, value in fields.items()
    ]
    return df.groupBy(*keys).agg(*carry, *picks)
