"""Quality rules by distribution divergence: a document's character classes and common words against its language's.

The reference of a language is made of all its documents, if they are long enough together: the shares of character
classes, and the shares of the words that make up `COMMON_SHARE` or more of its words, with one place for all other
words. A document whose Jensen-Shannon distance to its reference is too large is dropped, if it is long enough to tell.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import small_batches, staged, text_steps, texts_of

#: Share of a language's words from which a word is common: at most 1000 words are.
COMMON_SHARE = 1 / 1000
#: Words of all languages that a task counts before it hands the counts on.
HELD_WORDS = 300_000
#: Least code points for the character classes and least words for the common words.
MIN_CHARS, MIN_WORDS = 200, 50
#: Code points of a language from which it has a reference, and words from which that has common words.
REFERENCE_CHARS, REFERENCE_WORDS = 100 * MIN_CHARS, 100 * MIN_WORDS
#: Largest distances kept (0 to 1, base 2). Samples are noisy: the word limit is higher for short documents.
CHAR_LIMIT, WORD_LIMIT, WORD_NOISE = 0.3, 0.26, 1.7

#: Characters counted as symbols, least words, and the percentage of repeated words.
SYMBOLS = "#*$%&|<>"
BASE_MIN_WORDS, BASE_REPEATED = 50, 50

CLASSES = ("lower", "upper", "digit", "blank", "line", "stop", "symbol", "other mark", "beyond ASCII")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other mark"))
    for name, chars in (
        ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("blank", b" \t\r\x0b\x0c"),
        ("line", b"\n"), ("stop", b".,;:!?'\"-()"), ("symbol", SYMBOLS.encode()), ("beyond ASCII", range(0xC0, 256)),
    ):
        table[list(chars)] = CLASSES.index(name)
    table[0x80:0xC0] = -1  # further bytes of a character
    return table


_TABLE = _class_table()
_SYMBOLS = re.compile(f"[{re.escape(SYMBOLS)}]".encode())


def class_counts(data: bytes) -> np.ndarray:
    """Code points of UTF-8 text by class."""
    per_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    return np.array([per_byte[_TABLE == k].sum() for k in range(len(CLASSES))], np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(words) < 4:
        return 0
    place: dict[bytes, int] = {}
    ids = np.array([place.setdefault(w, len(place)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(place) + ids[1:], return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * len(place) + ids[2:], return_inverse=True, return_counts=True)
    windows = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(windows) + shift] |= windows
    return int(covered.sum())


def base_counts(data: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    lines = [x for x in data.split(b"\n") if x.split()]
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "surrogatepass"))
    return len(words), chars, len(_SYMBOLS.findall(data)), len(lines) - len(set(lines)), repeated_words(words)


def js_distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence (base 2) of counts and a distribution."""
    p = counts / counts.sum()
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(reference > 0, reference * np.log2(reference / m), 0)
    return float(np.sqrt(max(parts.sum() / 2, 0)))


@dataclass
class Reference:
    """A language's shares of classes, the places of its common words, their shares (last: all other words), and the
    number of its words."""

    classes: np.ndarray
    places: dict[bytes, int]
    words: np.ndarray
    n_words: int

    def word_distance(self, words: list[bytes]) -> float | None:
        """Distance of the common words, if there are enough on both sides."""
        if len(words) < MIN_WORDS or self.n_words < REFERENCE_WORDS:
            return None
        found = Counter(map(self.places.get, words))
        counts = np.zeros(len(self.words))
        for place, n in found.items():
            counts[-1 if place is None else place] += n
        return js_distance(counts, self.words)


def nearest(refs: list[Reference], data: bytes, words: list[bytes]) -> tuple[float | None, float | None, bool]:
    """Distances of the classes and of the common words to the reference that is nearest by both, in parts of their limits,
    and whether one is above its limit: it is, for that reference, only if it is for all."""
    if not refs:
        return None, None, False
    classes = class_counts(data)
    limit = WORD_LIMIT + WORD_NOISE / np.sqrt(max(len(words), 1))
    best: tuple = (np.inf, None, None)
    for near, k in sorted((js_distance(classes, r.classes), k) for k, r in enumerate(refs)):
        if near / CHAR_LIMIT >= best[0]:
            break  # so are all that follow
        far = refs[k].word_distance(words)
        best = min(best, (max(near / CHAR_LIMIT, (far or 0) / limit), near, far), key=lambda x: x[0])
    return best[1], best[2], bool(best[0] > 1)


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def references(docs: DataFrame) -> dict[str, Reference]:
    """References of the languages (column lang, NULL left out) that have `REFERENCE_CHARS`, whatever their share.

    Common words are exact: tasks count all words, in tables of `HELD_WORDS` words that Spark adds up by language and word.
    Only per-language totals and common words come to the driver.
    """
    docs = small_batches(docs).filter("lang is not null and text is not null").select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}
        held = 0

        def rows() -> pa.RecordBatch:
            each = [(k, None, 0, c.tolist()) for k, c in classes.items()]
            each += [(k, w, n, None) for k, c in words.items() for w, n in c.items()]
            columns = zip(*each, strict=True)
            kinds = (pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "word", "n", "classes"])

        for batch in text_steps(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
                data = _bytes(text)
                classes[lang] = classes.get(lang, 0) + class_counts(data)
                counter = words.setdefault(lang, Counter())
                held -= len(counter)
                counter.update(data.lower().split())
                held += len(counter)
                if held > HELD_WORDS:
                    yield rows()
                    classes, words, held = {}, {}, 0
        if classes:
            yield rows()

    each = docs.mapInArrow(counted, "lang string, word binary, n long, classes array<long>")
    per_class = [F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(len(CLASSES))]
    counts = staged(each.groupBy("lang", "word").agg(F.sum("n").alias("n"), *per_class), "word_counts")
    whole = sum((F.sum(f"c{k}") for k in range(len(CLASSES))), F.lit(0))
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"), whole.alias("chars"), *(F.sum(f"c{k}").alias(f"c{k}") for k in range(len(CLASSES))))
    sums = staged(sums.filter(F.col("chars") >= REFERENCE_CHARS), "language_sums")
    large = {r["lang"]: r for r in sums.collect()}
    found = counts.filter("word is not null").select("lang", "word", "n").join(F.broadcast(sums.select("lang", "total")), "lang")
    common: dict[str, list[tuple[int, bytes]]] = {}
    for r in found.filter(F.col("n") >= F.col("total") * COMMON_SHARE).collect():
        common.setdefault(r["lang"], []).append((r["n"], bytes(r["word"])))
    out = {}
    for lang, r in large.items():
        classes = np.array([r[f"c{k}"] for k in range(len(CLASSES))], float)
        words = sorted(common.get(lang, []), key=lambda x: (-x[0], x[1]))
        shares = np.array([n for n, _ in words] + [r["total"] - sum(n for n, _ in words)], float)
        out[lang] = Reference(classes / classes.sum(), {w: k for k, (_, w) in enumerate(words)}, shares / max(shares.sum(), 1), r["total"])
    return out


KINDS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "char_distance double, word_distance double, base_failed boolean, kept boolean"
)


def judge(docs: DataFrame, refs: dict[str, Reference]) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the distances (NULL where the text
    or its reference is too short), base_failed, kept.

    A document of a language without reference is judged by the base rules only. One with NULL language is held against
    all references, and goes if all reject it; its distances are those to the nearest by both. NULL
    text counts as empty and fails the base rules. Equal rows get equal results. Other columns are left out.
    """
    every = [refs[k] for k in sorted(refs)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            out = []
            columns = (batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), texts_of(batch))
            for doc_id, lang, text in zip(*columns, strict=True):
                data = _bytes(text)
                base = base_counts(data, data.split())
                failed = base[0] < BASE_MIN_WORDS or 100 * base[4] > BASE_REPEATED * base[0]
                words = data.lower().split()
                own = every if lang is None else [refs[lang]] if lang in refs else []
                near, far, off = nearest(own, data, words) if words and len(text) >= MIN_CHARS else (None, None, False)
                out.append((doc_id, *base, near, far, failed, not failed and not off))
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)], names=_NAMES)

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(rows, KINDS)


_NAMES = [x.split()[0] for x in KINDS.split(", ")]
_ARROW = [{"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]] for x in KINDS.split(", ")]
