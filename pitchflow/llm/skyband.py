"""Source divergence audit: how far the terms of each source of a language lie from the language and from its other sources.

Each language keeps the terms of at least `MIN_DOCS` of its documents. A source's smoothed frequency of a term is
p = 1 + floor(10^9 * (count + 2) / (N + 2 V)), of N occurrences and V terms; the distance of two frequencies is
f = floor((p - q)^2 / (p + q)). All arithmetic is exact: decimals of 38 digits up to p, and f fits in 64 bits.

The first terms of a group by f are found by dominance. Within a group, f grows with the group's count and shrinks with the
language's, where p > q, and equal values are ranked by term. So a term with k others of count as high, language count as low
and earlier UTF-8 cannot be among the first k: each partition retains its k-skyband, the terms with fewer than k such others,
and the merged skybands are ranked exactly.

Pairs of sources need all terms. What both lack has one value, so tasks hold the counts of some hundred sources for a share
of the terms and sum what differs from it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitchflow.llm.common import small_batches, staged, text_steps, texts_of

#: Documents of its language that a term must be in, and ranks of the terms that are returned.
MIN_DOCS, TOP_TERMS = 10, 10
#: Terms that a task counts before it hands the counts on.
HELD_TERMS = 300_000
#: Points of a task's skybands before it hands them on, and points compared with a skyband at once.
HELD_POINTS, STEP_POINTS = 200_000, 256
#: Sources of a language that a task compares with so many others.
TILE = 128
#: Counts in one group of terms and sources, and terms held as a matrix at once.
GROUP_COUNTS, STEP_TERMS = 200_000, 2_000

# A term is made of ASCII letters and of all characters beyond ASCII; only A-Z are lower-cased.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, in order."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by language, source and term, of some documents at a time."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            keys = list(n)
            columns = (
                pa.array([lang] * len(keys), pa.string()), pa.array([source] * len(keys), pa.string()),
                pa.array([k.decode("utf-8", "surrogatepass") for k in keys], pa.string()),
                pa.array([n[k] for k in keys], pa.int64()), pa.array([docs[k] for k in keys], pa.int64()),
            )
            yield pa.RecordBatch.from_arrays(list(columns), names=["lang", "source", "term", "n", "docs"])

    for batch in text_steps(batches):
        for lang, source, text in zip(texts_of(batch, "lang"), texts_of(batch, "source"), texts_of(batch), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            found = terms_of(text)
            n.update(found)
            docs.update(set(found))
            size += len(n)
            if size > HELD_TERMS:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n) of the kept terms of each language, for the groups that have them.

    One shuffle by language and term serves the sums per source, the language's sums and the choice of terms.
    """
    each = small_batches(docs).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    each = each.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    each = each.withColumn("lang_n", F.sum("n").over(term)).withColumn("docs", F.sum("docs").over(term))
    return staged(each.filter(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "lang_n"), "term_counts")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """p, in 10^9; NULL without terms. A count has up to 19 digits, so the products have up to 28."""
    exact = F.lit(10**9).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)"))
    whole = total.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)") * terms.cast("decimal(20,0)")
    return F.when(terms > 0, F.lit(1) + F.call_function("div", exact, whole))


def _distance(p: Column, q: Column) -> Column:
    """f of two shares of up to 10^9 + 1: the square fits in 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def skyband(points: np.ndarray, terms: list[bytes], k: int) -> np.ndarray:
    """Places of the points (count, language count) that fewer than k others dominate: with a count as high, a language count
    as low, and an earlier term. Terms are distinct.

    A dominated point has k dominators in the skyband itself, so each point is only held against the skyband so far,
    in an order in which dominators come first.
    """
    by_term = np.empty(len(terms), np.int64)
    by_term[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    order = np.lexsort((by_term, points[:, 1], -points[:, 0]))
    lang, rank = points[order, 1], by_term[order]
    kept = np.zeros(0, np.int64)
    for at in range(0, len(order), STEP_POINTS):
        step = np.arange(at, min(at + STEP_POINTS, len(order)))
        above = ((lang[kept] <= lang[step, None]) & (rank[kept] < rank[step, None])).sum(1)
        step, above = step[above < k], above[above < k]
        # within a step, those that are out by the points before them can only add dominators of what is out as well
        earlier = (lang[step] <= lang[step, None]) & (rank[step] < rank[step, None]) & (step < step[:, None])
        kept = np.concatenate([kept, step[above + earlier.sum(1) < k]])
    return order[kept]


def _skybands(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[tuple[bytes, int, int]]] = {}
        size = limit = 0

        def cut() -> int:
            for key, points in held.items():
                places = skyband(np.array([x[1:] for x in points], np.int64), [x[0] for x in points], k)
                held[key] = [points[p] for p in places]
            return sum(map(len, held.values()))

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), points in held.items():
                columns = (
                    [lang] * len(points), [source] * len(points), [t.decode("utf-8", "surrogatepass") for t, _, _ in points],
                    [n for _, n, _ in points], [m for _, _, m in points],
                )
                kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "lang_n"])

        limit = HELD_POINTS
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lang", "source", "term", "n", "lang_n")]
            for lang, source, term, n, lang_n in zip(*columns, strict=True):
                held.setdefault((lang, source), []).append((term.encode("utf-8", "surrogatepass"), n, lang_n))
            size += batch.num_rows
            if size > limit:
                size = cut()
                if size > limit // 2:  # the skybands themselves are many: hand them on
                    yield from out()
                    held, size = {}, 0
        cut()
        yield from out()

    return rows


def top_terms(counts: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): of each group the first terms with p > q, by f."""
    few = counts.mapInArrow(_skybands(top), "lang string, source string, term string, n long, lang_n long")
    both = few.join(groups.select("lang", "source", "group_total", "lang_total", "n_terms"), ["lang", "source"])
    p, q = _share(F.col("n"), F.col("group_total"), F.col("n_terms")), _share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms"))
    both = both.withColumn("p", p).withColumn("q", q).filter("p > q").withColumn("value", _distance(F.col("p"), F.col("q")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return both.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _pair_sums(tile: int):
    """For the sources of two tiles (right: place, base), the sums over some terms (left: term, at, p) of how much f differs
    from that of two sources without the term; for each pair with a smaller and a larger place."""

    def sums_of(left: pa.Table, right: pa.Table) -> pa.Table:
        base_of = dict(zip(right.column("place").to_pylist(), right.column("base").to_pylist(), strict=True))
        i, j, lang = right.column("i")[0].as_py(), right.column("j")[0].as_py(), right.column("lang")[0].as_py()
        mine, others = (np.array(sorted(x for x in base_of if x // tile == t), np.int64) for t in (i, j))
        base = {t: np.array([base_of[int(x)] or 0 for x in places], np.int64) for t, places in ((i, mine), (j, others))}
        sums = np.zeros((len(mine), len(others)), np.int64)

        def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            return (p - q) ** 2 // (p + q)

        if left.num_rows:
            place = left.column("at").to_numpy()
            share = left.column("p").to_numpy()
            _, number = np.unique(left.column("term").to_numpy(zero_copy_only=False), return_inverse=True)
            order = np.argsort(number, kind="stable")
            number, place, share = number[order], place[order], share[order]
            alone = f(base[i][:, None], base[j][None, :])
            for first in range(0, int(number[-1]) + 1, STEP_TERMS):
                a, b = np.searchsorted(number, [first, first + STEP_TERMS])
                rows = number[a:b] - first
                held = []
                for t, places in ((i, mine), (j, others)):
                    p = np.repeat(base[t][:, None], int(rows[-1]) + 1, 1)
                    inside = place[a:b] // tile == t
                    p[np.searchsorted(places, place[a:b][inside]), rows[inside]] = share[a:b][inside]
                    held.append(p)
                for k in range(len(mine)):
                    sums[k] += f(held[0][k], held[1]).sum(1) - alone[k] * held[1].shape[1]
        k, m = np.nonzero(mine[:, None] < others[None, :])
        columns = (pa.array([lang] * len(k), pa.string()), pa.array(mine[k]), pa.array(others[m]), pa.array(sums[k, m]))
        return pa.Table.from_arrays(list(columns), names=["lang", "a", "b", "part_sum"])

    return sums_of


def source_pairs(counts: DataFrame, groups: DataFrame, tile: int = TILE, group_counts: int = GROUP_COUNTS) -> DataFrame:
    """(lang, source, item, value): f of each two sources of a language, summed over all kept terms.

    Each task has the sources of two tiles and a share of the terms by hash. Groups of tasks differ in terms, so a source
    with very many terms is dealt like any other. There is one row per pair, as wanted; none is made from rows of terms.
    """
    places = Window.partitionBy("lang").orderBy("source")
    own = groups.withColumn("place", F.row_number().over(places).cast("long") - 1)
    own = own.withColumn("base", _share(F.lit(0).cast("long"), F.col("group_total"), F.col("n_terms")))
    tiles = own.groupBy("lang").agg(
        F.expr(f"div(max(place), {tile}) + 1").alias("tiles"), F.greatest(F.expr(f"div(sum(kept_rows), {group_counts}) + 1"), F.lit(1)).alias("shares")
    )
    own = staged(own.join(tiles, "lang").select("lang", "source", "place", "base", "group_total", "n_terms", "tiles", "shares"), "places")

    own_tile = F.expr(f"div(place, {tile})").alias("tile")
    met = F.explode(F.expr("sequence(0, tiles - 1)"))
    ends = [F.least("tile", "met").alias("i"), F.greatest("tile", "met").alias("j")]
    known = own.select("lang", "source", "place", "group_total", "n_terms", "tiles", "shares")
    p = _share(F.col("n"), F.col("group_total"), F.col("n_terms")).alias("p")
    cells = counts.join(known, ["lang", "source"]).select("lang", "term", "place", p, own_tile, "tiles", F.expr("pmod(xxhash64(term), shares)").alias("share"))
    cells = cells.select("*", met.alias("met")).select("lang", *ends, "share", "term", F.col("place").alias("at"), "p")
    sources = own.select("lang", "place", "base", own_tile, "tiles", "shares").select("*", met.alias("met"))
    sources = sources.select("lang", *ends, F.explode(F.expr("sequence(0, shares - 1)")).alias("share"), "place", "base")
    keys = ("lang", "i", "j", "share")
    sums = cells.groupBy(*keys).cogroup(sources.groupBy(*keys)).applyInArrow(_pair_sums(tile), "lang string, a long, b long, part_sum long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("part_sum").alias("part_sum"))

    ends_of = own.select("lang", "source", "place", "base", "n_terms")
    a = ends_of.select("lang", F.col("place").alias("a"), F.col("source").alias("source_a"), F.col("base").alias("base_a"), "n_terms")
    b = ends_of.select("lang", F.col("place").alias("b"), F.col("source").alias("source_b"), F.col("base").alias("base_b"))
    alone = F.coalesce(_distance(F.col("base_a"), F.col("base_b")) * F.col("n_terms"), F.lit(0))
    pairs = sums.join(a, ["lang", "a"]).join(b, ["lang", "b"]).withColumn("value", F.col("part_sum") + alone)
    ways = [F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("source_a", "source_b"), ("source_b", "source_a"))]
    return pairs.select("lang", "value", F.explode(F.array(*ways)).alias("way")).select("lang", "way.source", "way.item", "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` has each other source of the language as item, with the f of all
    kept terms summed, part `term` the first `top` terms above the language's share. Ranks go from 1 by falling value, then
    by UTF-8 of the item.

    NULL texts, languages and sources count as empty ones. A group without kept terms still has its pairs (0 where the
    language has no kept term); a language with one source has no pairs. Equal rows count as often as they are there; without
    documents there is no row. Other columns are left out.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    docs = docs.select(*names, "text")
    counts = term_counts(docs, min_docs)
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.count("*").alias("kept_rows"))
    terms = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("n_terms"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(terms, "lang", "left")
    groups = groups.fillna(0, ["group_total", "kept_rows", "n_terms"])
    groups = staged(groups.withColumn("lang_total", F.sum("group_total").over(Window.partitionBy("lang"))), "groups")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = source_pairs(counts, groups).withColumn("rank", rank)
    parts = [(pairs, "pair"), (top_terms(counts, groups, top), "term")]
    rows = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for df, part in parts]
    return rows[0].union(rows[1])
