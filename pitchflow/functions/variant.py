"""Semi-structured access: parse once, then read typed paths out of a VARIANT column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_variant(c: Column, dtype: T.DataType) -> Column:
    """VARIANT as is; text through `try_parse_json` (unparsable text becomes NULL)."""
    if isinstance(dtype, T.VariantType):
        return c
    return F.try_parse_json(c.cast("string"))


def parsed(df: DataFrame, column: str, alias: str = "p", keep_null: bool = False) -> DataFrame:
    """Add `alias`, the parsed form of `column`, and drop the rows that do not parse.

    A filter on `try_parse_json(x)` above a projection of it is collapsed by the optimizer into
    two parses per row. The explode of a 0/1-element array keeps one parse: the generator's output
    is an attribute that later expressions can only reference.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.VariantType):
        out = df.withColumn(alias, F.col(column))
        return out if keep_null else out.filter(F.col(alias).isNotNull())
    one = F.array(as_variant(F.col(column), dtype))
    if not keep_null:
        one = F.filter(one, lambda v: v.isNotNull())
    return df.select("*", F.explode(one).alias(alias))


def field_path(*steps: str | int) -> str:
    """JSON path from keys and indexes; every key is quoted, so any character is allowed."""
    out = "$"
    for step in steps:
        out += f"[{step}]" if isinstance(step, int) else "['" + step.replace("'", "\\'") + "']"
    return out


def jget(p: Column, path: str, dtype: str) -> Column:
    """Typed path access; a value of the wrong type is an error, a missing path is NULL."""
    return F.variant_get(p, path, dtype)


def try_jget(p: Column, path: str, dtype: str) -> Column:
    """Typed path access; a value of the wrong type is NULL."""
    return F.try_variant_get(p, path, dtype)


def number(p: Column, path: str) -> Column:
    """Whole number: rounds half up (1.7 is 2), where a direct bigint read would truncate."""
    return F.variant_get(p, path, "decimal(38,0)").cast("bigint")


def safe_path(p: Column, path: Sequence[str | int], dtype: str, default=None) -> Column:
    """Nested read with a default for a missing step, a wrong container type or null."""
    value = F.try_variant_get(p, field_path(*path), dtype)
    return value if default is None else F.coalesce(value, F.lit(default).cast(dtype))


def wrap_bad_json(value: Column) -> Column:
    """Text that is not JSON becomes `{"_raw": text}`; NULL and empty text become NULL."""
    text = F.nullif(value, F.lit(""))
    broken = text.isNotNull() & F.try_parse_json(text).isNull()
    return F.when(broken, F.to_json(F.struct(text.alias("_raw")))).otherwise(text)


def decode_message(value: Column) -> Column:
    """`wrap_bad_json` straight to VARIANT, parsing each message once."""
    text = F.nullif(value, F.lit(""))
    wrapped = F.when(text.isNotNull(), F.to_variant_object(F.struct(text.alias("_raw"))))
    return F.coalesce(F.try_parse_json(text), wrapped)


def is_object(v: Column) -> Column:
    """Whether a VARIANT holds an object; NULL for SQL NULL."""
    return F.when(v.isNotNull(), F.try_variant_get(v, "$", "map<string,variant>").isNotNull())


def elements(p: Column, path: str = "$") -> Column:
    """The array at `path` as `array<variant>`; NULL for anything that is not an array."""
    return F.try_variant_get(p, path, "array<variant>")


def array_size(p: Column, path: str = "$") -> Column:
    """Length of the array at `path`; NULL for anything that is not an array."""
    return F.array_size(elements(p, path)).cast("bigint")
