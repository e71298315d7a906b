"""Ordered sets, batches and nested payloads per key, in pieces of bounded size.

A key may hold any number of rows, so no operator here builds one array per key. A key's rows are
numbered or hashed into parts of at most about `max_items`, and an ordinary key simply has the
one part 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchflow.functions import join_ids
from pitchflow.operators.dedup import first_n_by
from pitchflow.session import scratch_path


def rank_within(df: DataFrame, keys: Sequence[str], id_col: str, rank: str = "rank") -> DataFrame:
    """The distinct (keys, id) pairs with the 1-based rank of the id within its keys.

    Ids are of any type that can be ordered. A window over the keys alone would sort a hot key in one task, so
    the pairs are dealt into ranges of (keys, id), as many as the shuffle has partitions: rows are ranked
    inside (keys, range) and shifted by the sizes of the key's earlier ranges. The ranges are sampled, so the
    pairs are written once with their range and read for both.
    """
    spark = df.sparkSession
    pairs = df.select(*keys, id_col).distinct().repartitionByRange(*keys, id_col)
    pairs = pairs.withColumn("_range", F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    pairs.write.parquet(path)
    pairs = spark.read.schema(pairs.schema).parquet(path)
    sizes = pairs.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_range").orderBy(id_col)
    local = pairs.withColumn("_local", F.row_number().over(inside))
    joined = _same_keys(local, shifts, [*keys, "_range"])
    return joined.select(*keys, id_col, (F.col("_local") + F.col("_shift")).cast("bigint").alias(rank))


def batch_keys(
    df: DataFrame,
    id_col: str,
    partition_by: Sequence[str],
    n: int = 20,
    sep: str = "-",
    limit: int | None = None,
) -> DataFrame:
    """Ids in ascending batches of `n` per parent key: keys, batch_no (from 1), n_ids, ids as text."""
    ranked = rank_within(df.filter(F.col(id_col).isNotNull()), partition_by, id_col, "_rank")
    if limit is not None:
        ranked = ranked.filter(F.col("_rank") <= limit)
    batch = F.expr(f"(_rank - 1) div {int(n)} + 1")
    return (
        ranked.withColumn("batch_no", batch)
        .groupBy(*partition_by, "batch_no")
        .agg(
            F.count(F.lit(1)).alias("n_ids"),
            join_ids(F.sort_array(F.collect_list(id_col)), sep).alias("ids"),
        )
    )


def sorted_set(
    df: DataFrame, keys: Sequence[str], id_col: str, out: str = "ids", max_items: int = 10_000
) -> DataFrame:
    """The ascending distinct ids of each key, as arrays of up to `max_items`: keys, part (from 0), out."""
    ranked = rank_within(df.filter(F.col(id_col).isNotNull()), keys, id_col, "_rank")
    return (
        ranked.withColumn("part", F.expr(f"(_rank - 1) div {int(max_items)}"))
        .groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(id_col)).alias(out))
    )


def split_groups(df: DataFrame, keys: Sequence[str], max_items: int, salts: int = 64) -> DataFrame:
    """Add `copy` and `part`: content-hashed parts of about `max_items` rows for keys with more.

    Equal rows are first folded into a count, then unfolded into chunks of at most `max_items`
    (column `copies`), so not even a run of identical rows can fill a part without bound. Only the
    over-full keys - at most rows / max_items of them - are joined back, spread over `salts`.
    """
    columns = df.columns
    folded = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    full = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_total"))
        .filter(F.col("_total") > max_items)
        .select(*keys, F.ceil(F.col("_total") / F.lit(max_items)).cast("bigint").alias("_parts"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    chunks = folded.withColumn("copy", F.explode(F.expr(f"sequence(0L, (_n - 1) div {int(max_items)})")))
    spread = F.xxhash64(*columns, "copy")
    left = chunks.withColumn("_h", spread).withColumn("_salt", F.pmod("_h", F.lit(salts)).cast("int"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in [*keys, "_salt"]]
    joined = left.alias("l").join(full.alias("f"), same, "left")
    copies = F.least(F.col("l._n") - F.col("l.copy") * max_items, F.lit(max_items))
    # the salt is the hash modulo `salts`; dividing it out keeps part and salt independent
    part = F.pmod(F.expr(f"l._h div {int(salts)}"), F.coalesce(F.col("f._parts"), F.lit(1)))
    return joined.select(
        *[F.col(f"l.{c}").alias(c) for c in columns],
        copies.cast("int").alias("copies"),
        part.cast("bigint").alias("part"),
    )


def collect_nested(
    df: DataFrame,
    keys: Sequence[str],
    item: Sequence[str],
    out: str = "items",
    max_items: int = 10_000,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Every row of a key inside sorted arrays of structs: keys, part (from 0), n_items, out."""
    parts = split_groups(df.select(*keys, *item), keys, max_items)
    repeated = F.array_repeat(F.struct(*item), F.col("copies"))
    return (
        parts.withColumn("_items", repeated)
        .groupBy(*keys, "part")
        .agg(
            F.sum("copies").cast("bigint").alias("n_items"),
            F.sort_array(F.flatten(F.collect_list("_items"))).alias(out),
            *extra,
        )
    )


def compose_payload(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    payload_col: str,
    error_col: str | None = None,
    max_items: int = 10_000,
    max_errors: int = 20,
) -> DataFrame:
    """One JSON document per key: its keys, the sorted distinct ids, the responses, the first errors.

    Rows are (keys, id, payload text, error text); a row without payload adds only its id and a row
    with an error adds it to `errors`. Output: keys, part, n_items, payload (text). A key with more
    than `max_items` rows continues in further parts with the same keys: its first `max_errors` errors stand in
    the first of them, and its one list of ids goes on through them, `max_items` in each from part 0 on, so that an
    id stands in one part only (a part may have ids or responses alone).
    """
    grouped = collect_nested(df, keys, [id_col, payload_col], "_all", max_items)
    over_full = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_items)
    pairs = df.filter(F.col(id_col).isNotNull()).select(*keys, id_col).distinct()
    listed = sorted_set(_same_keys(pairs, over_full, keys), keys, id_col, "_listed", max_items)
    grouped = _same_keys(grouped, over_full, keys, "left").alias("g")
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"i.{c}")) for c in [*keys, "part"]]
    # a row of either side alone has no part on the other
    here = F.col("g.part").isNotNull()
    grouped = grouped.join(listed.alias("i"), same, "full").select(
        *[F.when(here, F.col(f"g.{c}")).otherwise(F.col(f"i.{c}")).alias(c) for c in [*keys, "part"]],
        F.coalesce("g.n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("g._all", F.array()).alias("_all"),
        (F.col("g._rows").isNotNull() | ~here).alias("_over_full"),
        F.coalesce("i._listed", F.array()).alias("_listed"),
    )
    own = F.sort_array(F.array_distinct(F.filter(F.col("_all")[id_col], lambda x: x.isNotNull())))
    ids = F.when(F.col("_over_full"), F.col("_listed")).otherwise(own)
    response = F.transform(
        F.filter(F.col("_all")[payload_col], lambda x: x.isNotNull()), lambda x: F.try_parse_json(x)
    )
    fields = [*[F.col(k) for k in keys], ids.alias("ids"), response.alias("response")]
    if error_col:
        some = df.filter(F.col(error_col).isNotNull()).select(*keys, id_col, payload_col, error_col)
        order = [F.col(c).asc() for c in (id_col, payload_col, error_col)]
        ranked = first_n_by(some, keys, order, max_errors, "_rank").groupBy(*keys)
        first = ranked.agg(F.sort_array(F.collect_list(F.struct("_rank", error_col))).alias("_errors"))
        first = first.select(*keys, F.col("_errors")[error_col].alias("_errors"))
        # the head part of each key: a key whose rows all hash beyond part 0 still has one
        head = grouped.groupBy(*keys).agg(F.min("part").alias("part"))
        first = _same_keys(first, head, keys)
        grouped = _same_keys(grouped, first, [*keys, "part"], "left")
        fields.append(F.coalesce("_errors", F.array().cast("array<string>")).alias("errors"))
    return grouped.select(*keys, "part", "n_items", F.to_json(F.struct(*fields)).alias("payload"))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which some may be NULL; the keys are those of the left side."""
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]
    more = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), same, how).select(*[F.col(f"l.{c}") for c in left.columns], *more)
