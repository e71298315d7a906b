"""Exact token counts of every prefix of a text, by dynamic programming over a sentencepiece BPE model.

A sequence of pieces is the encoding of its text if and only if each two neighbours are the encoding of theirs: the first merge
across a border would happen for the two pieces alone, too. So the last piece of a prefix is the one piece that ends there and
goes together with the last piece of the prefix before it, and the prefix has one token more than that. A piece has a blank
sign at its begin only, so a text falls into chunks (blanks and what follows) that no merge crosses: the new chunks of a step
are worked out together, one character of all at a time, and the counts of a text are its chunks' counts above the sum of those
before.

The table of a text, one signed byte per character (by how much the count changes), answers how many tokens any prefix has and
which is the longest within a budget, without encoding again.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count, islice
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import small_batches, text_steps, texts_of

#: Characters of texts whose chunks are worked out together; a longer text is cut where a chunk begins.
STEP_CHARS = 2_000_000
#: Chunks in a block of the programme. Chunks of more than `LONG_CHUNK` characters are worked out alone.
BLOCK_CHUNKS, LONG_CHUNK = 16_384, 96
#: Chunks and pairs of pieces a worker remembers, and new pairs it holds before it sorts them in (speed only, never the counts).
CACHE_CHUNKS, CACHE_PAIRS, NEW_PAIRS = 400_000, 2_000_000, 20_000
BLANK = "▁"

_SIGN = "\x1f"
_CHUNK = re.compile(f"{BLANK}+[^{BLANK}\n]*\n?|[^{BLANK}\n]+\n?|\n")
_CUT = re.compile(f"(?<=\n)|(?<![ {BLANK}])(?=[ {BLANK}])")
_PROBES = ("a  b", " x ", "\t \u3000", "\ufb01 e\u0301 \u00b2", "\u0130\u1e9e", "A\r\n", f"a{BLANK}b", "\x00\x1f")
_BASE, _MIX, _BITS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), 20


def _hashes(chars: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Of strings one character longer than those of `before`."""
    return chars + np.uint64(1) if before is None else before * _BASE + chars + np.uint64(1)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _MIX) >> np.uint64(64 - _BITS)


class PrefixCounter:
    """Token counts of prefixes by a sentencepiece BPE model with an unchanging normalizer and byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if any(model.normalize(t) != BLANK + t.replace(" ", BLANK) for t in _PROBES):
            raise ValueError(f"{path} changes characters, so that prefixes of a text are not prefixes of what it encodes")
        special = (model.is_control, model.is_unknown, model.is_byte)
        pieces = [k for k in range(model.get_piece_size()) if not any(f(k) for f in special)]
        self.score = {model.id_to_piece(k): model.get_score(k) for k in pieces}
        alone = set(chain.from_iterable(self.score)) <= set(self.score) and "\n" not in self.score
        if not alone or any(model.is_unused(k) for k in pieces) or any(BLANK in p.lstrip(BLANK) for p in self.score):
            raise ValueError(f"{path} has unused pieces, pieces over several words or lines, or characters only within pieces")
        self.longest = max(map(len, self.score))
        # pieces that are their own encoding (no other is the last of a prefix), and how each comes about
        steps = {p: self._steps(p) for p in self.score}
        self.pieces = [p for p, (_, lefts, _) in steps.items() if lefts[-1] == p]
        self.steps = [steps[p] for p in self.pieces]
        self.number = {p: n for n, p in enumerate(self.pieces)}
        hashes = np.zeros(len(self.pieces), np.uint64)
        for n, piece in enumerate(self.pieces):
            found = None
            for c in np.array([ord(c) for c in piece], np.uint64):
                found = _hashes(c[None], found)
            hashes[n] = found[0]
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order.astype(np.int32)
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError(f"two pieces of {path} have one hash")
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[_slot(hashes)] = True
        self.forget()
        self._fresh()

    def forget(self) -> None:
        """Forget which pairs of pieces go together."""
        self.pairs, self.goes, self.fresh = np.zeros(0, np.int64), np.zeros(0, bool), {}

    def _steps(self, text: str) -> tuple[list[float], list[str], list[str]]:
        """How a short text is encoded: the best pair of neighbours becomes one, the leftmost of equal ones, while there is one.
        The score of each step (then minus infinity), and the first and the last part before each step and at the end."""
        parts = list(text)
        done, lefts, rights = [], [parts[0]], [parts[-1]]
        while True:
            scores = [self.score.get(a + b, -inf) for a, b in zip(parts, parts[1:], strict=False)]
            best = max(scores, default=-inf)
            done.append(best)
            if best == -inf:
                return done, lefts, rights
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            lefts.append(parts[0])
            rights.append(parts[-1])

    def pair_goes(self, before: int, piece: int) -> bool:
        """Whether two pieces, by number, are the encoding of their text: both come about as they do alone, the better step
        first, unless a pair across the border is better at some time."""
        (mine, _, rights), (theirs, lefts, _) = self.steps[before], self.steps[piece]
        i = j = 0
        while True:
            across = self.score.get(rights[i] + lefts[j], -inf)
            if across > mine[i] and across >= theirs[j]:
                return False
            if mine[i] == theirs[j] == -inf:
                return True
            if mine[i] >= theirs[j]:
                i += 1
            else:
                j += 1

    def _known(self, keys: np.ndarray) -> np.ndarray:
        """Whether pairs of pieces go together, by (number before * pieces + number)."""
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        found = self.pairs[at] == keys if len(self.pairs) else np.zeros(len(keys), bool)
        out = np.zeros(len(keys), bool)
        out[found] = self.goes[at[found]]
        if not found.all():
            new, inverse = np.unique(keys[~found], return_inverse=True)
            for key in new.tolist():
                if key not in self.fresh:
                    self.fresh[key] = self.pair_goes(*divmod(key, len(self.pieces)))
            out[~found] = np.array([self.fresh[k] for k in new.tolist()], bool)[inverse]
        return out

    def _keep_pairs(self) -> None:
        """Sort in what was new; forget all if it is too much."""
        if len(self.pairs) + len(self.fresh) > CACHE_PAIRS:
            self.forget()
        elif len(self.fresh) > NEW_PAIRS or not len(self.pairs):
            keys = np.concatenate([self.pairs, np.fromiter(self.fresh, np.int64, len(self.fresh))])
            goes = np.concatenate([self.goes, np.fromiter(self.fresh.values(), bool, len(self.fresh))])
            order = np.argsort(keys)
            self.pairs, self.goes, self.fresh = keys[order], goes[order], {}

    def _ending(self, chars: np.ndarray) -> Iterator[np.ndarray]:
        """For lengths 1, 2, ...: the piece of that length that ends with each character, -1 if none does."""
        found = None
        for length in range(1, min(self.longest, chars.shape[1]) + 1):
            found = _hashes(chars[:, length - 1 :], None if found is None else found[:, :-1])
            out = np.full(chars.shape, -1, np.int32)
            flat = found.ravel()
            places = np.flatnonzero(self.maybe[_slot(flat)])
            wanted = flat[places]
            at = np.searchsorted(self.hashes, wanted)
            at[at == len(self.hashes)] = 0
            right = self.hashes[at] == wanted
            rows, columns = np.divmod(places[right], found.shape[1])
            out[rows, columns + length - 1] = self.numbers[at[right]]
            yield out

    def _block(self, chunks: list[str]) -> np.ndarray:
        """Counts (chunk, characters) of the prefixes of some chunks, from no character to the width of the longest."""
        width = max(map(len, chunks))
        chars = np.array(chunks, f"<U{width}").view(np.uint32).reshape(len(chunks), width).astype(np.uint64)
        ending = list(self._ending(chars))
        last = np.full((len(chunks), width + 1), -1, np.int64)
        counts = np.zeros((len(chunks), width + 1), np.int32)
        for end in range(1, width + 1):
            open_ = np.ones(len(chunks), bool)
            for length in range(min(end, len(ending)), 0, -1):
                rows = np.flatnonzero(open_ & (ending[length - 1][:, end - 1] >= 0))
                if not len(rows):
                    continue
                piece, before = ending[length - 1][rows, end - 1].astype(np.int64), last[rows, end - length]
                goes = before < 0
                asked = ~goes
                goes[asked] = self._known(before[asked] * len(self.pieces) + piece[asked])
                rows, piece = rows[goes], piece[goes]
                last[rows, end], counts[rows, end], open_[rows] = piece, counts[rows, end - length] + 1, False
            # a character that is no piece is as many tokens as bytes and is joined with nothing: what follows begins anew
            odd = chars[open_, end - 1]
            counts[open_, end] = counts[open_, end - 1] + 1 + (odd >= 0x80) + (odd >= 0x800) + (odd >= 0x10000)
        return counts

    def _chunk_counts(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of the prefixes of all chunks, from one character on; where each chunk's begin, and how many there are."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(lengths, kind="stable")
        ranked = lengths[order]
        found = [np.zeros(0, np.int32)]
        at = int(np.searchsorted(ranked, 1))
        while at < len(order):
            longest = max(int(ranked[at]) * 5 // 4 + 1, 8)
            end = int(np.searchsorted(ranked, longest, "right")) if longest <= LONG_CHUNK else at + 1
            end = min(end, at + BLOCK_CHUNKS)
            counts = self._block([chunks[k] for k in order[at:end].tolist()])[:, 1:]
            found.append(counts[np.arange(counts.shape[1]) < ranked[at:end, None]])
            self._keep_pairs()
            at = end
        starts = np.zeros(len(chunks), np.int64)
        starts[order] = np.cumsum(ranked) - ranked
        return np.concatenate(found), starts, lengths

    def _numbers(self, step: list[tuple[int, list[str]]]) -> np.ndarray:
        """Numbers of the chunks, in order; what is new is worked out."""
        if len(self.place) > CACHE_CHUNKS:
            self._fresh()
        place, known = self.place, len(self.place)
        every = chain.from_iterable(chunks for _, chunks in step)
        numbers = np.array(list(map(place.__getitem__, every)), np.int64)
        if len(place) > known:
            flat, starts, lengths = self._chunk_counts(list(islice(place, known, None)))
            totals = np.where(lengths > 0, flat[np.minimum(starts + lengths, len(flat)) - 1], 0) if len(flat) else lengths
            self.start = np.concatenate([self.start, starts + len(self.flat)])
            self.length = np.concatenate([self.length, lengths])
            self.total = np.concatenate([self.total, totals])
            self.flat = np.concatenate([self.flat, flat])
        return numbers

    def _fresh(self) -> None:
        self.place: dict[str, int] = defaultdict(count().__next__)
        self.flat = np.zeros(0, np.int32)
        self.start = self.length = self.total = np.zeros(0, np.int64)

    def _chunks(self, text: str, first: bool) -> list[str]:
        """Part of a text as the model encodes it (the first one with a blank before it), cut before blanks and behind breaks."""
        if "  " in text or (first and text[0] == " ") or BLANK in text or _SIGN in text:
            return _CHUNK.findall((BLANK if first else "") + text.replace(" ", BLANK))
        cut = text.replace("\n", "\n" + _SIGN).replace(" ", _SIGN + BLANK)
        return (BLANK + cut if first else cut).split(_SIGN)

    def _steps_of(self, texts: list[str]) -> Iterator[list[tuple[int, list[str]]]]:
        """(text, chunks) for parts of the texts, about `STEP_CHARS` characters at once."""
        step, size = [], 0
        for k, text in enumerate(texts):
            at = 0
            while at < len(text):
                cut = _CUT.search(text, at + STEP_CHARS) if len(text) - at > STEP_CHARS else None
                end = cut.end() if cut else len(text)
                if step and size + end - at > STEP_CHARS:
                    yield step
                    step, size = [], 0
                step.append((k, self._chunks(text[at:end], at == 0)))
                size += end - at
                at = end
        if step:
            yield step

    def prefix_counts(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text, the tokens of its prefixes of 0, 1, ... characters."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for step in self._steps_of(texts):
            numbers = self._numbers(step)
            at = 0
            for k, chunks in step:
                own = numbers[at : at + len(chunks)]
                at += len(chunks)
                lengths, totals = self.length[own], self.total[own]
                places = np.repeat(self.start[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
                above = int(parts[k][-1][-1]) if parts[k] else 0
                parts[k].append(self.flat[places] + np.repeat(above + np.cumsum(totals) - totals, lengths))
        for found in parts:
            if found:
                found[0][0] = 0  # the blank before the text: nothing is encoded as nothing
        return [np.concatenate(found) if found else np.zeros(1, np.int64) for found in parts]


@lru_cache(maxsize=1)
def counter(path: str) -> PrefixCounter:
    """This worker's counter of a model file, kept between tasks."""
    return PrefixCounter(path)


def _changes(counts: np.ndarray) -> bytes:
    return np.diff(counts).astype(np.int8).tobytes()


def counts_of(changes: bytes) -> np.ndarray:
    """Tokens of each prefix of a text, from its stored table."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)])


def within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens. A longer prefix can have fewer tokens: all are looked at."""
    fitting = np.flatnonzero(counts <= budget)
    return int(fitting[-1]) if len(fitting) else 0


def with_prefix_counts(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, fit_chars, changes) of each row: bytes of the text in UTF-8, its tokens, the characters of the
    longest prefix of at most `budget` tokens, and the table of its prefixes, which answers for any other budget.

    NULL and empty texts have no bytes and no tokens. Equal rows get equal results; other columns are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in text_steps(batches):
            texts = texts_of(batch)
            found = model.prefix_counts(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    "n_tokens": pa.array([int(c[-1]) for c in found], pa.int64()),
                    "fit_chars": pa.array([within(c, budget) for c in found], pa.int64()),
                    "changes": pa.array([_changes(c) for c in found], pa.binary()),
                }
            )

    narrow = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long, fit_chars long, changes binary")


def fit_budget(counted: DataFrame, budget: int) -> DataFrame:
    """The rows of `with_prefix_counts` with fit_chars for another budget, from the stored tables alone."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            fits = [within(counts_of(c), budget) for c in batch.column("changes").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("fit_chars"), "fit_chars", pa.array(fits, pa.int64()))

    return counted.mapInArrow(rows, counted.schema)
