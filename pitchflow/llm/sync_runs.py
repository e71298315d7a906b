"""Runs of repeated word sequences by string synchronising sets, and texts without the repeats.

A run is a longest stretch of words with smallest period q that is at least `POWER` periods (and `MIN_WORDS` words) long. For each
scale t = 4, 8, 16, ... a position is selected if, among the t + 1 windows of t words from it on, the first or the last has the
smallest hash. Whether it is selected depends on the 2 t words behind it only, and of any t positions in a row one is selected.
So a run of period q in t .. 2 t - 1 has a selected position within its first t words, and its next copy with equal 2 t words is
exactly one period further: neighbouring copies propose all periods of a scale, and equal words prove them.

Windows of a period of a quarter of t or less take no part in the choice, or whole regions would be selected. They lie in the
runs of smaller scales, found before, and in those of periods below 4, which are detected by comparing words directly.

Words are numbered exactly. Hashes of 64 bits only select and propose; what they propose is proved on the words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import small_batches, text_steps, texts_of

#: Least periods and least words of a run.
POWER, MIN_WORDS = 4, 6
#: The first scale; smaller periods are compared directly.
FIRST_SCALE = 4
#: Words of short texts handled together.
STEP_WORDS = 500_000

_MIX, _FOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x = (x ^ (x >> np.uint64(31))) * _FOLD
    return x ^ (x >> np.uint64(29))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    return x if have == width else np.minimum(x[: len(x) - (width - have)], x[width - have :])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def _direct(ids: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the stretches with a small period, smallest or not, of `POWER` periods or more."""
    if len(ids) <= period:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = _stretches(ids[:-period] == ids[period:])
    end = end + period
    long = end - begin >= POWER * period
    return begin[long], end[long]


def _extended(ids: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The whole stretch around `at` in which words `period` apart are equal."""
    end, step = at, 64
    while end < len(ids) - period:
        unequal = np.flatnonzero(ids[end : min(end + step, len(ids) - period)] != ids[end + period : end + period + step])
        if len(unequal):
            end += int(unequal[0])
            break
        end, step = min(end + step, len(ids) - period), 2 * step
    begin, step = at, 64
    while begin > 0:
        first = max(begin - step, 0)
        unequal = np.flatnonzero(ids[first:begin] != ids[first + period : begin + period])
        if len(unequal):
            begin = first + int(unequal[-1]) + 1
            break
        begin, step = first, 2 * step
    return begin, end + period


def _proposed(hashes: np.ndarray, windows: np.ndarray, skipped: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected positions at scale t whose next copy is t to 2 t - 1 words further, and that distance.

    `hashes` are those of the windows of 2 t words, `windows` of t words, and `skipped` the windows that take no part.
    """
    none = np.uint64(2**64 - 1)
    drawn = np.where(skipped, none, windows)
    least = _least(drawn, t + 1)
    n = len(hashes)  # positions with 2 t words behind them
    first, last = drawn[:n], drawn[t : t + n]
    places = np.flatnonzero(((first == least[:n]) | (last == least[:n])) & (least[:n] != none))
    keys = hashes[places]
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    same = np.flatnonzero(keys[:-1] == keys[1:])
    at, distance = places[same], places[same + 1] - places[same]
    right = (distance >= t) & (distance < 2 * t)
    return at[right], distance[right]


def find_runs(ids: np.ndarray, longest: int | None = None) -> np.ndarray:
    """(begin, end, period) of all runs of at least `POWER` periods in a sequence of numbers, by begin, then period; none is
    longer than `longest`."""
    longest = len(ids) if longest is None else longest
    found = [np.zeros((0, 3), np.int64)]
    known: set[tuple[int, int]] = set()
    for period in range(1, FIRST_SCALE):
        rows = [(b, e, period) for b, e in zip(*(x.tolist() for x in _direct(ids, period)), strict=True) if (b, e) not in known]
        known.update((b, e) for b, e, _ in rows)
        found.append(np.array(rows, np.int64).reshape(-1, 3))
    windows = _mixed(ids.astype(np.uint64) + np.uint64(1))
    t = 1
    while longest >= POWER * t:
        if t >= FIRST_SCALE:
            hashes = _mixed(windows[: len(windows) - t] * _FOLD + windows[t:])
            rows = _runs_of_scale(ids, hashes, windows, np.concatenate(found), t, known)
            found.append(np.array(rows, np.int64).reshape(-1, 3))
            windows = hashes
        else:
            windows = _mixed(windows[: len(windows) - t] * _FOLD + windows[t:])
        t *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _runs_of_scale(
    ids: np.ndarray, hashes: np.ndarray, windows: np.ndarray, runs: np.ndarray, t: int, known: set[tuple[int, int]]
) -> list[tuple[int, int, int]]:
    """Runs of the periods t .. 2 t - 1, given those of smaller periods."""
    small = runs[(runs[:, 2] * 4 <= t) & (runs[:, 1] - runs[:, 0] >= t)]
    edges = np.zeros(len(windows) + 1, np.int64)
    np.add.at(edges, small[:, 0], 1)
    np.add.at(edges, small[:, 1] - t + 1, -1)
    at, period = _proposed(hashes, windows, np.cumsum(edges[:-1]) > 0, t)
    # from the first selected position of a run at least 3 periods less t words equal those one period further
    length = (POWER - 1) * period - t + 1
    inside = at + length + period <= len(ids)
    at, period, length = at[inside], period[inside], length[inside]
    parts = (length - 2 * t, np.minimum(length - 2 * t, 2 * t))
    same = np.logical_and(*(hashes[at + part] == hashes[at + part + period] for part in parts))
    at, period, length = at[same], period[same], length[same]
    # one position for each stretch: what follows within an equal stretch belongs to it
    order = np.lexsort((at, period))
    at, period, length = at[order], period[order], length[order]
    apart = np.ones(len(at), bool)
    apart[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + length[:-1])
    rows = []
    for place, q in zip(at[apart].tolist(), period[apart].tolist(), strict=True):
        begin, end = _extended(ids, place, q)
        if end - begin >= POWER * q and (begin, end) not in known:
            known.add((begin, end))
            rows.append((begin, end, q))
    return rows


def runs_of_texts(sequences: list[np.ndarray]) -> list[np.ndarray]:
    """(begin, end, period) of the runs of `MIN_WORDS` words or more of each sequence of word numbers (below 2^40).

    Short sequences are joined, with a number of its own behind each, so that no run crosses.
    """
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(sequences)
    # of about one length together: all of a step go to the same scales
    order = sorted((k for k in range(len(sequences)) if len(sequences[k]) >= MIN_WORDS), key=lambda k: len(sequences[k]))
    at = 0
    while at < len(order):
        end, size = at, 0
        while end < len(order) and (end == at or size + len(sequences[order[end]]) <= STEP_WORDS):
            if len(sequences[order[end]]) > 2 * len(sequences[order[at]]):
                break
            size += len(sequences[order[end]]) + 1
            end += 1
        step = [sequences[k] for k in order[at:end]]
        lengths = np.array([len(s) + 1 for s in step], np.int64)
        starts = np.cumsum(lengths) - lengths
        joined = np.concatenate([x for n, s in enumerate(step) for x in (s, np.array([2**40 + n], np.int64))])
        runs = find_runs(joined, int(lengths.max()) - 1)
        runs = runs[runs[:, 1] - runs[:, 0] >= MIN_WORDS]
        owner = np.searchsorted(starts, runs[:, 0], "right") - 1
        cuts = np.searchsorted(owner, np.arange(len(step) + 1))
        for n, k in enumerate(order[at:end]):
            own = runs[cuts[n] : cuts[n + 1]].copy()
            own[:, :2] -= starts[n]
            out[k] = own
        at = end
    return out


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods; of equal ones the first, then the one of the smaller period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


Arrange = Callable[[int | None, int], np.ndarray | None]
KINDS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, best struct<start: long, length: long, period: long>, collapsed string"
_RUN = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])


def collapse_runs(docs: DataFrame, arrange: Arrange | None = None) -> DataFrame:
    """(doc_id, runs, best, collapsed) of each row: the text's runs by start and period, in words from 0, the one of most
    periods (NULL without a run), and the text's words without those behind the first period of any run, joined by blanks.

    `arrange` gives, for a doc_id and its number of words, the places of the words to read instead of all in order.
    NULL texts and texts without words have no run and an empty collapsed text. Equal rows get equal results; other columns
    are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            doc_ids = batch.column("doc_id").to_pylist()
            words = [t.encode("utf-8", "surrogatepass").split() for t in texts_of(batch)]
            number: dict[bytes, int] = defaultdict(count().__next__)
            sequences = []
            for k, doc_id in enumerate(doc_ids):
                own = np.array(list(map(number.__getitem__, words[k])), np.int64)
                places = arrange(doc_id, len(own)) if arrange else None
                if places is not None:
                    own, words[k] = own[places], [words[k][p] for p in places.tolist()]
                sequences.append(own)
            runs, collapsed = [], []
            for own, found in zip(words, runs_of_texts(sequences), strict=True):
                if len(found):
                    change = np.zeros(len(own) + 1, np.int64)
                    np.add.at(change, found[:, 0] + found[:, 2], 1)
                    np.add.at(change, found[:, 1], -1)
                    own = [own[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
                collapsed.append(b" ".join(own).decode("utf-8", "surrogatepass"))
                runs.append([(b, e - b, q) for b, e, q in found.tolist()])
            named = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs]
            best = [None if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in map(_best, runs)]
            columns = [pa.array(doc_ids, pa.int64()), pa.array(named, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "best", "collapsed"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, KINDS)
