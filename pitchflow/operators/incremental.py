"""Only new rows in, and keyed replacement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.operators.dedup import first_n_by
from pitchflow.operators.joins import spread_join


def unseen(
    src: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    prune: str | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of `src` whose key is not in `target` yet.

    A key with a NULL is in no target: it stays, whatever the target holds (`not_in` follows SQL there). `prune` names a growing key column such as a log offset: the target is
    then read only between its smallest and largest new value, so a small batch against a huge
    target touches the few row groups that can overlap it. The two bounds are read eagerly.
    `spread_by` is for keys that are not ids of rows and may repeat without bound in `src`.
    """
    known = target.select(*keys)
    if prune:
        low, high = src.agg(F.min(prune), F.max(prune)).first()
        if low is None:
            return src.limit(0)
        known = known.filter(F.col(prune).between(F.lit(low), F.lit(high)))
    if spread_by:
        return spread_join(src, known.distinct(), keys, "left_anti", spread_by)
    return src.join(known, list(keys), "left_anti")


def not_in(src: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `src` whose keys are NOT IN those of `target`, by SQL's rule for NULLs.

    A comparison with NULL is unknown, so a row stays only if each target row differs from it in some key that neither lacks. That is
    one anti join per pattern of NULL keys on either side, each on the keys that both have: 3 to the power of the keys in all. Filters for
    a pattern read the row groups whose statistics allow it, and branches without rows end when they run; without NULLs what is left is
    one anti join, where the planned NOT IN is a nested loop. Only whether there is a target row at all is a join without keys.
    """
    out = []
    for lacking in _subsets(keys):
        given = [k for k in keys if k not in lacking]
        rows = src.filter(_pattern(given, lacking))
        for missing in _subsets(given):
            compared = [k for k in given if k not in missing]
            known = target.filter(_pattern(compared, missing))
            if compared:
                rows = rows.join(known.select(*compared).distinct(), compared, "left_anti")
            else:
                rows = rows.join(F.broadcast(known.select(F.lit(1).alias("_any")).limit(1)), F.lit(True), "left_anti")
        out.append(rows.select(*src.columns))
    return reduce(DataFrame.unionAll, out)


def _subsets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    return [c for n in range(len(keys) + 1) for c in combinations(keys, n)]


def _pattern(given: Sequence[str], lacking: Sequence[str]) -> Column:
    here = [F.col(k).isNotNull() for k in given] + [F.col(k).isNull() for k in lacking]
    return reduce(Column.__and__, here, F.lit(True))


def upsert(target: DataFrame, src: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """`target` with the rows of `src` replaced or added by key; the first of equal keys wins in `src`.

    The target needs no window: rows whose key is replaced leave through an anti join, which Spark
    turns into a broadcast when the change set is small, and the rest pass through untouched.
    """
    new = first_n_by(src, keys, order_by)
    kept = target.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new)
