"""Stacking of differently shaped inputs, and two id columns to two rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_padded(*dfs: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows of all inputs in the given schema; a column an input lacks is a typed NULL."""

    def fit(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )

    return reduce(DataFrame.unionByName, [fit(df) for df in dfs])


def unpivot_sides(
    df: DataFrame,
    home: Sequence[str],
    away: Sequence[str],
    names: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Two rows per row, `side` = home and away, with the paired columns under `names`.

    The first of `names` is the id; a row without it is dropped. One scan of the input, where a
    union of two projections would read it twice.
    """

    def one(side: str, columns: Sequence[str]):
        pairs = [F.col(c).alias(n) for c, n in zip(columns, names, strict=True)]
        return F.struct(F.lit(side).alias("side"), *pairs)

    out = df.select(*keep, F.inline(F.array(one("home", home), one("away", away))))
    return out.filter(F.col(names[0]).isNotNull())
