"""Checks on a table: each names its failing rows, and all of a table run in one scan.

A row check fails where its condition is false; a condition that is NULL passes, as in SQL
`where not (condition)`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.operators.joins import spread_join


@dataclass(frozen=True)
class Check:
    """One declared check. `ok` is the row condition; a uniqueness check has `unique` instead."""

    kind: str
    column: str
    ok: Callable[[], Column] | None = None
    unique: tuple[str, ...] = ()
    severity: str = "error"
    where: str | None = None

    def fails(self) -> Column:
        """True where a row breaks the check."""
        bad = F.coalesce(~self.ok(), F.lit(False))
        return bad if self.where is None else bad & F.coalesce(F.expr(self.where), F.lit(False))


def not_null(column: str, severity: str = "error", where: str | None = None) -> Check:
    """The column is never NULL (a JSON null is a value)."""
    return Check("not_null", column, lambda: F.col(column).isNotNull(), (), severity, where)


def unique_combination(columns: Sequence[str], severity: str = "error", where: str | None = None) -> Check:
    """No two rows share the columns; NULLs are equal to each other."""
    return Check("unique_combination", ",".join(columns), None, tuple(columns), severity, where)


def accepted_range(
    column: str,
    min_value=None,
    max_value=None,
    inclusive: bool = True,
    severity: str = "error",
    where: str | None = None,
) -> Check:
    """The column lies between the bounds; an open side has no bound."""

    def ok() -> Column:
        c = F.col(column)
        tests = [F.lit(True)]
        if min_value is not None:
            tests.append(c >= min_value if inclusive else c > min_value)
        if max_value is not None:
            tests.append(c <= max_value if inclusive else c < max_value)
        return reduce(lambda a, b: a & b, tests)

    return Check("accepted_range", column, ok, (), severity, where)


def expression_is_true(
    expression: str | Callable[[], Column], name: str | None = None, severity: str = "error", where: str | None = None
) -> Check:
    """A SQL condition, or a function returning one, holds for every row."""
    if callable(expression):
        return Check("expression_is_true", name or "", expression, (), severity, where)
    return Check("expression_is_true", name or expression, lambda: F.expr(expression), (), severity, where)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows (for uniqueness: the repeated combinations with their `n_records`) that break a check."""
    if not check.unique:
        return df.filter(check.fails())
    rows = df if check.where is None else df.filter(check.where)
    counts = rows.groupBy(*check.unique).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def relationships(
    child: DataFrame, parent: DataFrame, child_col: str, parent_col: str, spread_by: Sequence[str]
) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_col).alias(child_col)).distinct()
    rows = child.filter(F.col(child_col).isNotNull())
    return spread_join(rows, keys, [child_col], "left_anti", spread_by)


def run_checks(df: DataFrame, checks: Sequence[Check], model: str) -> DataFrame:
    """Report: model, test, column, severity, failures, passed.

    One scan serves all row checks and the first uniqueness check: failures are counted per
    combination of its columns, where the rows are grouped anyway, and then summed. Counts are
    combined before the shuffle. A further uniqueness check adds a grouped count of its own. A
    `warn` check passes the build but reports its failures.
    """
    rows = [c for c in checks if not c.unique]
    repeats = [c for c in checks if c.unique]
    fails = [F.count_if(c.fails()).alias(f"c{i}") for i, c in enumerate(rows)]
    if repeats:
        first = repeats[0]
        counted = F.lit(True) if first.where is None else F.expr(first.where)
        grouped = df.groupBy(*first.unique).agg(F.count_if(counted).alias("n"), *fails)
        sums = [F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(rows))]
        counts = grouped.agg(F.count_if(F.col("n") > 1).alias("n"), *sums)
        entries = [_entry(model, c, F.col(f"c{i}")) for i, c in enumerate(rows)]
        entries.append(_entry(model, first, F.col("n")))
    else:
        counts = df.agg(*fails)
        entries = [_entry(model, c, F.col(f"c{i}")) for i, c in enumerate(rows)]
    parts = [counts.select(F.inline(F.array(*entries)))]
    for c in repeats[1:]:
        total = failing_rows(df, c).agg(F.count(F.lit(1)).alias("n"))
        parts.append(total.select(F.inline(F.array(_entry(model, c, F.col("n"))))))
    return reduce(DataFrame.unionByName, parts)


def _entry(model: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(check.kind).alias("test"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        (failures == 0).alias("passed"),
    )
