"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

A source's demand for words over training time t (0 to 1) follows its weight schedule: the integral of
the schedule up to t, scaled to reach the source's target at 1. Its documents are laid one after the other in an
order fixed by their hashes, and a document's training position is the time at which the demand reaches its middle:
the integral inverted. Demand beyond a source's size starts a second round of the same documents.

Positions within a source need running totals, which no single task could make for a source with a third of all
rows. The hash's leading bits cut a source into 1024 parts of 1024 parts each: totals are run over the parts of
a source, over the parts of a part, and over the rows of one smallest part, none of which grows beyond a millionth
of a source's rows (or 1024). Equal rows are numbered first, in 1024 salted parts of a key, and their numbers hashed, so
that they are dealt like other rows. Only ids, sources and sizes are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitchflow.llm.common import WORD, staged

#: Weights of the sources in code point order, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
#: Of each weight, the schedule: (time, relative weight) with straight lines between. Heavily weighted sources
#: come early, lightly weighted ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 0.75), (1.0, 2.25)))
#: Words of the mix in words of all documents, and the most rounds of a source.
SHARE, ROUNDS = 1.5, 2

_PART_BITS = 10
_SALTS = 1024


def _before(value: str, by: list[str], order: list[str]) -> Column:
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """(source, source_size, place, target) of the sources of (source, size).

    The share of all sizes is dealt by weight; a target stops at `rounds` times its source's size and the excess is
    dealt again by weight until none is above. That is one level, target = min(rounds * size, level * weight): with
    sources in order of rounds * size / weight the first k are full, and k is the first for which the level, from
    what they leave, does not fill the next. One row per source is in the window.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    places = each.withColumn("place", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    limits = places.withColumn("weight", weight).withColumn("most", (F.col("source_size") * rounds).cast("double"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "place")
    upto = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = limits.withColumn("full_most", F.sum("most").over(upto)).withColumn("full_weight", F.sum("weight").over(upto))
    whole = upto.withColumn("total", F.sum("source_size").over(everything) * share).withColumn(
        "weights", F.sum("weight").over(everything)
    )
    # the level if the sources before this one are full; the first that holds decides
    level = (F.col("total") - F.col("full_most") + F.col("most")) / (F.col("weights") - F.col("full_weight") + F.col("weight"))
    holds = F.when(level * F.col("weight") <= F.col("most"), level)
    in_order = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = whole.withColumn("level", F.first(holds, ignorenulls=True).over(in_order))
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return levels.select("source", "source_size", "place", target.alias("target"))


def _inverse(reached: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of a schedule reaches a part (0 to 1) of the whole integral."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:], strict=False)]
    if min(w for _, w in schedule) < 0 or sum(areas) <= 0:
        raise ValueError("a schedule needs weights of 0 or more, and some above 0")
    out, passed = None, sum(areas)
    for (a, b), area in reversed(list(zip(zip(schedule, schedule[1:], strict=False), areas, strict=True))):
        passed -= area
        (t, w), slope = a, (b[1] - a[1]) / (b[0] - a[0])
        rest = F.greatest(F.lit(0.0), reached * sum(areas) - passed)
        # w x + slope x^2 / 2 = rest, in the form that holds for a slope of 0 as well
        root = F.lit(w) + F.sqrt(F.greatest(F.lit(0.0), F.lit(w * w) + rest * (2 * slope)))
        time = F.least(F.lit(b[0]), F.lit(t) + F.when(root > 0, rest * 2 / root).otherwise(F.lit(0.0)))
        out = time if out is None else F.when(reached * sum(areas) <= passed + area, time).otherwise(out)
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, source, text_hash, and a written `tag` that no two share) with `number`, counting equal rows from 0.

    Rows are dealt by key and salt of the tag; the salts of a key, at most `_SALTS`, follow one another.
    """
    key = (F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.coalesce("source", F.lit("")), F.col("source").isNull())
    rows = rows.withColumns({"same": F.xxhash64(*key, F.coalesce("text_hash", F.lit(0))), "salt": F.pmod(F.xxhash64("tag"), F.lit(_SALTS))})
    inner = F.row_number().over(Window.partitionBy("same", "salt").orderBy("tag")) - 1
    starts = rows.groupBy("same", "salt").agg(F.count("*").alias("n")).withColumn("ahead", _before("n", ["same"], ["salt"]))
    starts = starts.filter("ahead > 0").select("same", "salt", "ahead")
    numbered = rows.withColumn("inner", inner).join(starts, ["same", "salt"], "left")
    return numbered.withColumn("number", F.col("inner") + F.coalesce("ahead", F.lit(0))).drop("same", "salt", "inner", "ahead")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = SHARE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, text_hash, size (words; NULL text 0), source_size, target (its
    source's), taken (words the mix takes, repeats counted, at most `rounds` times size), and takes, an array of
    (round, position, words) by round: the training position (0 to 1) of each take and the leading words it has.

    A source's takes add up to its target, rounded to a whole word: the document in which the demand ends is taken
    up to there. Sources without words have target 0; a document without words has no takes. A NULL source is a
    source of its own. Equal rows are documents of their own, each with a place of its own. An empty table gives no row.
    Other columns are left out.
    """
    return _mixed(docs.withColumn("tag", F.monotonically_increasing_id()), weights, schedules, share, rounds).drop("tag")


def _mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = SHARE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """As `mix`, with the column `tag`, which no two rows share."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), size.alias("size"), F.xxhash64("text").alias("text_hash"), "tag")
    rows = _numbered(staged(rows, "tagged_sizes"))
    mixed = F.when(F.col("number") == 0, F.xxhash64("doc_id", "text_hash", F.lit("order")))
    mixed = mixed.otherwise(F.xxhash64("doc_id", "text_hash", F.lit("order"), "number"))
    high = F.shiftrightunsigned(mixed, 64 - _PART_BITS)
    low = F.shiftrightunsigned(mixed, 64 - 2 * _PART_BITS).bitwiseAND((1 << _PART_BITS) - 1)
    rows = staged(rows.withColumns({"mixed": mixed, "high": high, "low": low}), "sizes")
    targets = source_targets(rows, weights, share, rounds)

    fine = rows.groupBy("source", "high", "low").agg(F.sum("size").alias("part"))
    broad = fine.groupBy("source", "high").agg(F.sum("part").alias("part"))
    broad = broad.select("source", "high", _before("part", ["source"], ["high"]).alias("start"))
    broad = broad.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    fine = fine.withColumn("inner", _before("part", ["source", "high"], ["low"])).alias("f")
    same = F.col("f.source").eqNullSafe(F.col("b.source")) & (F.col("f.high") == F.col("b.high"))
    fine = fine.join(broad.alias("b"), same).select(
        "f.source", "f.high", "f.low", (F.col("start") + F.col("inner")).alias("start"), "source_size", "place", "target"
    )
    order = ["mixed", "doc_id", "text_hash", "size"]
    laid = rows.withColumn("inner", _before("size", ["source", "high", "low"], order)).alias("r")
    same = F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.high") == F.col("p.high")) & (F.col("r.low") == F.col("p.low"))
    laid = laid.join(fine.alias("p"), same).select(
        "r.doc_id", "r.source", "r.text_hash", "r.size", "r.tag", "source_size", "target", "place",
        (F.col("start") + F.col("inner")).alias("start"), F.round("target").cast("long").alias("demand"),
    )

    takes = []
    for k in range(rounds):
        begin = F.col("start") + F.col("source_size") * k
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.col("demand") - begin))
        reached = (begin + words / 2) / F.col("demand")
        time = None
        for n, schedule in enumerate(schedules):
            found = _inverse(reached, schedule)
            time = found if time is None else F.when(F.col("place") % len(schedules) == n, found).otherwise(time)
        takes.append(F.when(words > 0, F.struct(F.lit(k).alias("round"), time.alias("position"), words.alias("words"))))
    laid = laid.withColumn("takes", F.filter(F.array(*takes), lambda t: t.isNotNull()))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda total, t: total + t["words"])
    return laid.select("doc_id", "source", "text_hash", "size", "source_size", "target", taken.alias("taken"), "takes", "tag")


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per take, range-sorted by position: doc_id, source, text_hash, size, round, position, words."""
    each = mixed.select("doc_id", "source", "text_hash", "size", F.inline("takes"))
    return each.orderBy("position", "doc_id", "text_hash", "round")


def mixed_documents(docs: DataFrame, written: bool = False, **how) -> DataFrame:
    """The documents of `docs` (all columns) in training order, each as often as the mix takes it.

    Whole documents are kept: a document that the mix takes in part is kept where at least half of it is
    taken. Documents without words train nothing and are left out. A row meets its own takes by its place in the table's files;
    `written` says that `docs` are the rows of one Parquet table as they were read, otherwise they are written first.
    """
    table = docs if written else staged(docs, "documents")
    tag = F.struct("_metadata.file_path", "_metadata.row_index").alias("tag")
    takes = _mixed(table.select("doc_id", "source", "text", tag), **how)
    kept = F.filter("takes", lambda t: t["words"] * 2 >= F.col("size"))["position"]
    takes = takes.select("tag", kept.alias("positions")).filter(F.size("positions") > 0)
    rows = table.select(F.struct(*docs.columns).alias("row"), tag)
    joined = rows.join(takes, "tag").select("row", F.explode("positions").alias("position"))
    return joined.orderBy("position").select("row.*")
