"""Line dedup by pairwise alignment: what a later document has in common with an earlier one goes.

Overlaps are found through hashes of lines: a line with at least `min_words` words, or the fewest lines from there on, or
up to there, that together have them, so that ordinary short lines are no evidence. Each such run names the first
document that has it. A rare run, in at most `RARE` documents, makes a pair of every later one with the first, and
each pair is aligned by patience diff: a document's lines go to few others, however many share a licence or a copied text
with it. A common run needs no alignment: where a later document has it, its lines are a block of their own. Runs
taken from both sides cover every block to its last line, so nothing is lost by either way.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import small_batches, staged, text_steps, texts_of

#: Words that a common block has at least.
MIN_WORDS = 10
#: Documents that hold a run for which they are aligned; those with a commoner run lose it without.
RARE = 16


def line_runs(text: str, min_words: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Of the lines that have a word: place in the text, hash, number of words, and the hashes of their `windows`."""
    places, hashes, words = [], [], []
    for place, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        if parts := line.split():
            places.append(place)
            hashes.append(xxhash.xxh3_64_intdigest(b" ".join(parts)) - (1 << 63))
            words.append(len(parts))
    return places, hashes, words, [_run_hash(hashes, begin, end) for begin, end in windows(words, min_words)]


def _run_hash(hashes: list[int], begin: int, end: int) -> int:
    if end - begin == 1:
        return hashes[begin]
    return xxhash.xxh3_64_intdigest(b"".join(h.to_bytes(8, "little", signed=True) for h in hashes[begin:end])) - (1 << 63)


def _runs(words: list[int], min_words: int) -> Iterator[tuple[int, int]]:
    """From each line on, the fewest lines that have the words together."""
    end = held = 0
    for begin, own in enumerate(words):
        while end < len(words) and held < min_words:
            held += words[end]
            end += 1
        if held < min_words:
            break
        yield begin, end
        held -= own


def windows(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """The shortest runs of `min_words` words or more from each line on, and up to each line."""
    n = len(words)
    back = ((n - end, n - begin) for begin, end in _runs(words[::-1], min_words))
    return sorted({*_runs(words, min_words), *back})


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience diff: pairs (place in a, place in b) of equal lines, increasing in both.

    Common ends first, then the longest increasing chain of lines that are unique on both sides, and the same
    between its members. Where no line is unique, equal lines are matched from the left.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {x: k for k, x in enumerate(a[i:i_end], i) if in_a[x] == 1 and in_b[x] == 1}
        chain = _increasing([(place[x], k) for k, x in enumerate(b[j:j_end], j) if x in place])
        if chain:
            for at, to in chain:
                todo.append((i, at, j, to))
                out.append((at, to))
                i, j = at + 1, to + 1
            todo.append((i, i_end, j, j_end))
        else:
            out += _from_left(a, b, i, i_end, j, j_end)
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain with increasing first members."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for k, (at, _) in enumerate(pairs):
        pile = bisect_left(tops, at)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(at)
            last.append(k)
        else:
            tops[pile], last[pile] = at, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _from_left(a: list[int], b: list[int], i: int, i_end: int, j: int, j_end: int) -> list[tuple[int, int]]:
    places: dict[int, list[int]] = {}
    for k in range(i, i_end):
        places.setdefault(a[k], []).append(k)
    out = []
    for k in range(j, j_end):
        found = places.get(b[k], [])
        if (n := bisect_left(found, i)) < len(found):
            out.append((found[n], k))
            i = found[n] + 1
    return out


def common_blocks(earlier: list[int], later: list[int], words: list[int], min_words: int) -> list[int]:
    """Places in `later` (hashes of lines with their words) of the aligned blocks with `min_words` words or more.

    Where the alignment leaves lines of `earlier`, one pass by its runs finds the blocks that are moved, repeated, or
    cross what it prefers, so that all of every common block goes.
    """
    gone: list[int] = []
    block: list[int] = []
    last = -1
    for i, j in patience(earlier, later):
        if block and (i != last + 1 or j != block[-1] + 1):
            if sum(words[k] for k in block) >= min_words:
                gone += block
            block = []
        block.append(j)
        last = i
    if sum(words[k] for k in block) >= min_words:
        gone += block
    aligned, known = set(gone), set(earlier)
    if any(x in known and k not in aligned for k, x in enumerate(later)):
        aligned.update(common_runs(later, words, min_words, _runs_among(earlier, dict(zip(later, words, strict=True)), min_words)))
    return sorted(aligned)


def common_runs(lines: list[int], words: list[int], min_words: int, common: set[int]) -> list[int]:
    """Places of the lines in a run whose hash is among `common`."""
    out: list[int] = []
    for begin, end in windows(words, min_words):
        if _run_hash(lines, begin, end) in common:
            out += range(max(begin, out[-1] + 1 if out else 0), end)
    return out


def _neighbours(places: list[int]) -> Iterator[list[int]]:
    """Places in stretches without a gap."""
    stretch: list[int] = []
    for place in places:
        if stretch and place != stretch[-1] + 1:
            yield stretch
            stretch = []
        stretch.append(place)
    if stretch:
        yield stretch


def _runs_among(lines: list[int], size: dict[int, int], min_words: int) -> set[int]:
    """Hashes of the runs made of lines with a known number of words."""
    out: set[int] = set()
    for stretch in _neighbours([k for k, x in enumerate(lines) if x in size]):
        here = lines[stretch[0] : stretch[-1] + 1]
        out.update(_run_hash(here, begin, end) for begin, end in windows([size[x] for x in here], min_words))
    return out


def _line_rows(min_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            places, hashes, words, runs = zip(*(line_runs(t, min_words) for t in texts_of(batch)), strict=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_hash": batch.column("text_hash"),
                    "places": pa.array(places, pa.list_(pa.int32())),
                    "lines": pa.array(hashes, pa.list_(pa.int64())),
                    "words": pa.array(words, pa.list_(pa.int32())),
                    "runs": pa.array([list(dict.fromkeys(r)) for r in runs], pa.list_(pa.int64())),
                }
            )

    return rows


def _block_rows(min_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            columns = (batch.column(k).to_pylist() for k in ("earlier", "lines", "words", "places"))
            gone = [[p[k] for k in common_blocks(e, x, w, min_words)] for e, x, w, p in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {k: batch.column(k) for k in ("doc_id", "text_hash", "first")} | {"gone": pa.array(gone, pa.list_(pa.int32()))}
            )

    return rows


def _run_rows(min_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            columns = (batch.column(k).to_pylist() for k in ("common", "lines", "words", "places"))
            gone = [[p[k] for k in common_runs(x, w, min_words, set(c))] for c, x, w, p in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {k: batch.column(k) for k in ("doc_id", "text_hash", "firsts")} | {"gone": pa.array(gone, pa.list_(pa.int32()))}
            )

    return rows


def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the lines at the given places; NULL where none is given."""
    out = []
    for text, places in zip(texts, gone, strict=True):
        if text is None or places is None:
            out.append(None)
        else:
            left_out = set(places)
            out.append("\n".join(x for k, x in enumerate(text.split("\n")) if k not in left_out))
    return pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of `docs` (all columns, in their order) with `text` cut, then n_deleted (lines cut), and overlaps
    (sorted doc_ids of the earlier documents it had blocks with).

    A block is a run of lines, blank ones aside, that an earlier document (by doc_id) has too, with `min_words` words
    or more; every copy of it in the later document goes. NULL and empty texts stay as they are, as do rows with a NULL doc_id. Equal rows are cut alike;
    rows under one doc_id are never cut for one another. A text whose lines all go becomes empty or blank.
    Columns called n_deleted or overlaps in the input are replaced.
    """
    docs = small_batches(docs)
    keep = [c for c in docs.columns if c not in ("n_deleted", "overlaps")]
    others = [c for c in keep if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    kinds = "doc_id long, text_hash long, places array<int>, lines array<long>, words array<int>, runs array<long>"
    some = rows.filter("doc_id is not null and text is not null").select("doc_id", "text_hash", "text")
    lines = staged(some.mapInArrow(_line_rows(min_words), kinds), "lines")

    each = lines.select("doc_id", F.explode("runs").alias("run"))
    firsts = each.groupBy("run").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    shared = each.join(firsts.filter("first < last").select("run", "first", "n"), "run").filter("doc_id <> first")
    rare = F.col("n") <= RARE
    shared = shared.groupBy("doc_id").agg(
        F.collect_set(F.when(rare, F.col("first"))).alias("pairs"),
        F.collect_set(F.when(~rare, F.col("run"))).alias("common"),
        F.collect_set(F.when(~rare, F.col("first"))).alias("firsts"),
    )
    shared = staged(shared, "shared")

    later = lines.select("doc_id", "text_hash", "places", "lines", "words")
    earlier = lines.select(F.col("doc_id").alias("first"), F.col("lines").alias("earlier")).dropDuplicates()
    aligned = shared.select("doc_id", F.explode("pairs").alias("first")).join(later, "doc_id").join(earlier, "first")
    aligned = aligned.mapInArrow(_block_rows(min_words), "doc_id long, text_hash long, first long, gone array<int>")
    aligned = aligned.select("doc_id", "text_hash", F.array("first").alias("firsts"), "gone")
    common = shared.filter(F.size("common") > 0).select("doc_id", "common", "firsts").join(later, "doc_id")
    common = common.mapInArrow(_run_rows(min_words), "doc_id long, text_hash long, firsts array<long>, gone array<int>")
    cuts = aligned.union(common).filter(F.size("gone") > 0).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("firsts")))).alias("overlaps"),
    )
    cuts = staged(cuts, "cuts")
    out = rows.join(cuts, ["doc_id", "text_hash"], "left")
    # called nondeterministic so that a filter on the text is not pushed below it, which would run it twice, in two workers a task
    without = F.pandas_udf(_without, "string").asNondeterministic()
    cut = without(F.when(F.col("gone").isNotNull(), F.col("text")), F.col("gone"))
    out = out.withColumn("cut", F.coalesce(cut, F.col("text")))
    return out.select(
        *(F.col("cut").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in keep),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce("overlaps", F.array().cast("array<long>")).alias("overlaps"),
    )
