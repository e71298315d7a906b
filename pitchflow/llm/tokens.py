"""Token ids of whole texts, by a public tokenizer of the `tokenizers` library.

Both tokenizers split a text at white space before they merge bytes, so a text's ids are those of its
chunks in order. Each worker encodes a chunk once and keeps its ids in a bounded table; the ids of a
batch are then gathered with numpy. Arrow columns are cut and looked up by Arrow's kernels (`encode_column`).
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache, partial
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks in a generation of a worker's table, and punctuation runs it keeps (speed only, never the ids).
CACHE_CHUNKS = 300_000
CACHE_TAILS = 10_000
#: Characters encoded in one step, unless a single text has more.
STEP_CHARS = 2_000_000
#: Pieces of Arrow columns whose ids a worker keeps, and the bytes of a piece that is kept (speed only, never the ids).
KEPT_PIECES = 1_000_000
KEPT_BYTES = 100

# Python counts these as white space, the tokenizers do not: texts with one are encoded whole.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\[-`{-~]*)\Z").match
# Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
# A single space between two other characters starts a new chunk whatever stands around it.
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")

# White space of the tokenizers' expressions besides spaces and line breaks; the classes of Python and Arrow are others.
_OTHER_WHITE = r"\t\x0b-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Stands between the pieces of a text for a moment; a text that has it is encoded the other way.
_MARK = "\x1e"


class _Table(dict):
    """Slot of each chunk, and the ids of all slots in one flat array.

    Two generations: when the younger is full it becomes the older, and what is met again moves up.
    """

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit
        self.older: dict[str, int] = {}
        self._fresh()

    def _fresh(self) -> None:
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.used = self.slots_used = 0
        self.unseen: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = slot = self.slots_used + len(self.unseen)
        self.unseen.append(chunk)
        return slot

    def slots(self, chunks: list[str]) -> np.ndarray:
        if len(self) > self.limit:
            self._turn()
        slots = np.array(list(map(self.__getitem__, chunks)), np.int64)
        if self.unseen:
            self._add([self._known(c) for c in self.unseen] if self.older else [self.encode(c) for c in self.unseen])
        return slots

    def _known(self, chunk: str) -> list[int]:
        slot = self.older.get(chunk)
        if slot is None:
            return self.encode(chunk)
        at = self.older_start[slot]
        return self.older_ids[at : at + self.older_length[slot]].tolist()

    def _add(self, lists: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum()))
        first, last = self.slots_used, self.slots_used + len(lists)
        self.start, self.length = _room(self.start, last), _room(self.length, last)
        self.ids = _room(self.ids, self.used + len(flat))
        self.ids[self.used : self.used + len(flat)] = flat
        self.length[first:last] = lengths
        self.start[first:last] = self.used + np.cumsum(lengths) - lengths
        self.used += len(flat)
        self.slots_used = last
        self.unseen = []

    def trim(self) -> None:
        """Forget the older generation."""
        self.older = {}
        self.older_ids = self.older_start = self.older_length = np.zeros(0, np.int64)

    def _turn(self) -> None:
        self.older = dict(self)
        self.older_ids, self.older_start, self.older_length = self.ids, self.start, self.length
        self.clear()
        self._fresh()


def _room(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array)), array.dtype)])


class _Pieces:
    """Ids of the pieces met before, as far as the limits allow; those met least are forgotten first."""

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit
        self.keys = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_list(pa.uint32()))
        self.met = np.zeros(0, np.int64)  # how often; halved when pieces are forgotten

    def lists(self, pieces: pa.Array) -> pa.Array:
        """The list of ids of each piece."""
        found = pieces.dictionary_encode()
        slots = pc.index_in(found.dictionary, value_set=self.keys)
        unseen = found.dictionary.filter(slots.is_null())
        keys = pa.concat_arrays([self.keys, unseen])
        ids = pa.concat_arrays([self.ids, pa.array([self.encode(piece) for piece in unseen.to_pylist()], self.ids.type)])
        met = np.concatenate([self.met, np.zeros(len(unseen), np.int64)])
        slots = np.array(slots.fill_null(-1))
        slots[slots < 0] = np.arange(len(self.keys), len(keys))
        met[slots] += np.bincount(found.indices, minlength=len(slots))
        self.keys, self.ids, self.met = self._kept(keys, ids, met)
        return ids.take(pa.array(slots).take(found.indices))

    def _kept(self, keys: pa.Array, ids: pa.Array, met: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
        kept = np.array(pc.less_equal(pc.binary_length(keys), KEPT_BYTES))
        if len(keys) > self.limit:
            kept[np.argpartition(met, -(self.limit // 2))[: -(self.limit // 2)]] = False
            met = met // 2
        return (keys, ids, met) if kept.all() else (keys.filter(kept), ids.filter(kept), met[kept])


class Encoder:
    """Whole texts to ids, equal to encoding each text by itself without special tokens."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per Spark task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a special token's name in a text is ordinary text
        # with a byte-level pre-tokenizer, the space before a word belongs to it
        self.keeps_space = self._whole("a b") != self._whole("a  b")
        self.merge = self.tokenizer.model.tokenize
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.simple = self._simple_is_right()
        self.tails: dict[str, list[int]] = {}
        self.head = _Table(self._whole, cache_chunks)
        self.tail = _Table(partial(self._chunk, " " if self.keeps_space else ""), cache_chunks)
        self.pieces = _Pieces(self._piece, KEPT_PIECES)
        self.cut_by_space = self.keeps_space and self.simple and self._cuts_are_right()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _chunk(self, before: str, chunk: str) -> list[int]:
        """Ids of one chunk. A Latin word with ASCII punctuation behind it is two units of the pre-tokenizer, as is
        a lone line break between such; units go to the tokenizer's merges directly. Anything else is encoded whole."""
        if self.simple and len(chunk) <= 200:
            if chunk.isalpha() and chunk.isascii():
                word = chunk if self.keeps_space else chunk.lower()
                return [t.id for t in self.merge("\u0120" + word if before else word)]
            merged: list[int] = []
            for line, part in enumerate(chunk.split("\n") if self.keeps_space else (chunk,)):
                found = _SIMPLE(part)
                if found is None:
                    return self._whole(before + chunk)
                if line:
                    merged += self._tail("\n")
                merged += self._unit("" if line else before, *found.groups())
            return merged
        return self._whole(before + chunk)

    def _unit(self, before: str, word: str, after: str) -> list[int]:
        if not self.keeps_space:
            if not (word.isascii() or is_normalized("NFC", word)):
                return self._whole(word + after)
            word = word.lower()
        if word.isascii():
            word = "\u0120" + word if before else word
        else:
            word = (before + word).encode().decode("latin-1").translate(_BYTE_CHARS)
        merged = [t.id for t in self.merge(word)]
        return merged + self._tail(after) if after else merged

    def _tail(self, after: str) -> list[int]:
        tail = self.tails.get(after)
        if tail is None:
            if len(self.tails) > CACHE_TAILS:
                self.tails.clear()
            tail = self.tails[after] = self._whole(after)
        return tail

    def _simple_is_right(self) -> bool:
        """Whether a tokenizer file has the pre-tokenizer that the short way assumes."""
        self.simple, self.tails = True, {}
        before = " " if self.keeps_space else ""
        return all(self._chunk(before, c) == self._whole(before + c) for c in ("Straße", "École.", "the", "Ñandú!!", "WORD$$$", "a", "z)."))

    def _piece(self, piece: str) -> list[int]:
        """Ids of a piece: white space, if any, and what stands behind it."""
        if piece[:1] == " ":
            return self._chunk(" ", piece[1:])
        if piece[:1] == "\n" and _SIMPLE(piece[1:]):
            return self._tail("\n") + self._chunk("", piece[1:])
        return self._whole(piece)

    def _cuts_are_right(self) -> bool:
        """Whether the tokenizer cuts a text before white space, whatever stands around."""
        texts = ("The end.\nÉcole  is\n\nout,\t 12 x\r\nit's \u00a0 \u2003z\n \n\ny!! ", "a\nb")
        return all([i for p in _cut(pa.array([t], pa.large_string())).values.to_pylist() for i in self._piece(p)] == self._whole(t) for t in texts)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of all texts, one after the other, and how many each text has; a null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        marked = pc.match_substring(texts, _MARK)
        if not self.cut_by_space or pc.any(marked).as_py():
            lists = self.encode(texts.to_pylist())
            return np.concatenate([np.zeros(0, np.uint32), *lists]), np.fromiter(map(len, lists), np.int64, len(lists))
        pieces = _cut(texts)
        with _uncollected():
            lists = self.pieces.lists(pieces.values)
        ends = lists.offsets.to_numpy()[pieces.offsets.to_numpy()]
        return lists.values.to_numpy(), np.diff(ends)

    def _chunks(self, text: str) -> list[str]:
        """Chunks of a text; if spaces are kept, all but the first had a space before them."""
        if _SEPARATORS.search(text):
            return [text]
        words = text.split()
        if not self.keeps_space:
            return words
        if len(words) == text.count(" ") + text.count("\n") + 1:  # only lone separators
            return text.split(" ")
        return _LONE_SPACE.split(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids (uint32) per text."""
        with _uncollected():
            return self._in_steps(texts)

    def trim(self) -> None:
        """Give back half of the memory between tasks: another operator's task may follow in this worker."""
        self.head.trim()
        self.tail.trim()

    def _in_steps(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        step, size = [], 0
        for text in texts:
            if step and size + len(text) > STEP_CHARS:
                out += self._encode(step)
                step, size = [], 0
            step.append(text)
            size += len(text)
        return out + (self._encode(step) if step else [])

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        chunks = [self._chunks(t) for t in texts]
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        behind = chain.from_iterable(x[1:] for x in chunks) if self.keeps_space else chain.from_iterable(chunks)
        ids, lengths = _gather(self.tail, self.tail.slots(list(behind)))
        if not self.keeps_space:
            ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
            return np.split(ids, ends[:-1]) if len(texts) else []
        first = [x[0] if x else "" for x in chunks]
        head_ids, head_lengths = _gather(self.head, self.head.slots(first))
        heads = np.split(head_ids, np.cumsum(head_lengths)[:-1])
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(np.maximum(counts - 1, 0))]
        return [np.concatenate(pair) for pair in zip(heads, np.split(ids, ends[:-1]), strict=True)]


@contextmanager
def _uncollected() -> Iterator[None]:
    """The many short lists of a step are freed at its end, there is nothing for the collector to find."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collecting:
            gc.enable()


def _cut(texts: pa.Array) -> pa.Array:
    """The pieces of each text, in order: cut before each run of white space. No text may have the mark."""
    cut = pc.replace_substring(pc.replace_substring(texts, " ", f"{_MARK} "), "\n", f"{_MARK}\n")
    runs = pc.match_substring_regex(texts, rf"[ \n][ \n]|[{_OTHER_WHITE}]")
    if pc.any(runs).as_py():
        cut = pc.replace_with_mask(cut, runs, pc.replace_substring_regex(texts.filter(runs), rf"([ \n{_OTHER_WHITE}]+)", rf"{_MARK}\1"))
    return pc.split_pattern(cut, _MARK)


def _gather(table: _Table, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = table.length[slots]
    before = np.cumsum(lengths) - lengths
    return table.ids[np.repeat(table.start[slots] - before, lengths) + np.arange(int(lengths.sum()))], lengths


@lru_cache(maxsize=2)
def encoder(path: str, cache_chunks: int = CACHE_CHUNKS) -> Encoder:
    """This worker's encoder of a tokenizer file, kept between tasks. A smaller table takes less memory and more time."""
    return Encoder(path, cache_chunks)
