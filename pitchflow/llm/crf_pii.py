"""Personal data by fixed patterns and, beyond them, by a linear-chain conditional random field over word shapes.

The patterns find what is written in the usual way. The field tags words (B and I per kind, O) and adds what is
written otherwise: a phone number without a plus, an address with (at) in it. It is trained from a small labelled table
and decodes, by Viterbi in numpy batches, the surroundings of every word with a digit or a sign of an address; all other
words are O by definition, so that a text of plain words costs one search.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import small_batches, text_steps, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Words on either side of a telling one that are decoded with it.
AROUND = 3
#: Words, padding included, in one batch of the decoder.
BATCH_WORDS = 100_000
#: Words from which a window is decoded in pieces of so many, each going on from the scores of the one before.
PIECE_WORDS = 20_000

Span = tuple[str, int, int]

# The patterns of the base kinds. No match of `ip` begins within digits, as digits are taken whole.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_BYTE = re.compile(r"[0-9]{1,3}\Z").match


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    twice = [d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2])]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def _emails(text: str) -> list[Span]:
    """As the pattern `[A-Za-z0-9._%+-]+@` and a domain, searched from each @ so that it takes linear time."""
    out, behind, at = [], 0, text.find("@")
    while at >= 0:
        first = at
        while first > behind and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            out.append(("email", first, domain.end()))
        behind = domain.end() if domain else at + 1
        at = text.find("@", behind)
    return out


def base_spans(text: str) -> list[Span]:
    """Matches of the patterns that pass their checks, by kind and place; a failing match is not tried otherwise."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        ips = ((m, m.group().split(".")) for m in _IP.finditer(text))
        out += [("ip", m.start(), m.end()) for m, parts in ips if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in parts)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(digits := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def joined(spans: list[Span]) -> str:
    """kind:start:end by kind, then start, with commas between."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


# ---- words and their features

_WORD = re.compile(r"\S+")
_TELLING = re.compile(r"[0-9@]|[(\[{]\s?(?:at|dot)\s?[)\]}]|\bdot\b")
_OPEN, _CLOSE = "\"'<[{", ".,;:!?>]}\"'"
_SHAPE = ((re.compile(r"[a-zà-ÿ]+"), "a"), (re.compile(r"[A-ZÀ-Þ]+"), "A"))


def _places(text: str) -> Iterator[tuple[int, int, int]]:
    """Window (a number) and place of each word in the surroundings of telling words, in order."""
    window = -1
    behind = 0  # words that begin before are in a window already
    found = _TELLING.search(text)
    while found:
        first = found.start()
        for _ in range(AROUND + 1):
            while first > behind and not text[first - 1].isspace():
                first -= 1
            begin = first
            while first > behind and text[first - 1].isspace():
                first -= 1
            if first <= behind:
                break
        at, left, last = begin, None, None
        joins = window >= 0 and not text[behind:begin].strip()
        for m in _WORD.finditer(text, at):
            if m.end() > found.start() and _TELLING.search(text, m.start(), m.end()):
                left = AROUND
            elif left is not None:
                left -= 1
            if left is not None and left < 0:
                break
            if last is None and not joins:
                window += 1
            last = m.end()
            yield window, m.start(), last
        behind = found.end() if last is None else last
        found = _TELLING.search(text, behind)


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Places of the words in the surroundings of telling words; surroundings that touch are one window."""
    return [[(a, b) for _, a, b in group] for _, group in groupby(_places(text), itemgetter(0))]


def core(text: str, begin: int, end: int) -> tuple[int, int]:
    """A word's place without quotes and stops around it."""
    while begin < end and text[begin] in _OPEN:
        begin += 1
    while begin < end and text[end - 1] in _CLOSE:
        end -= 1
    while begin < end and text[end - 1] == ")" and "(" not in text[begin:end]:
        end -= 1
    return begin, end


def _shape(word: str) -> str:
    for pattern, sign in _SHAPE:
        word = pattern.sub(sign, word)
    return re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 9)}", word)[:24]


def features(words: list[str]) -> list[list[str]]:
    """Of each word, its own shape and marks and those of its neighbours."""
    shapes = [_shape(w[:60]) for w in words]
    lowered = [w.lower().strip("()[]{}:.,")[:12] for w in words]
    out = []
    for k, word in enumerate(words):
        digits = _NOT_DIGIT.sub("", word)
        own = ["all", f"shape={shapes[k]}", f"digits={min(len(digits), 20)}", f"word={lowered[k] if not digits else ''}"]
        own += [f"has{c}" for c in "@+-.():/=_\"#$%" if c in word]
        own.append(f"first={shapes[k][:2]}")
        if digits and any(c.isalpha() for c in word):
            own.append("mixed")
        if 13 <= len(digits) <= 19:
            own.append(f"luhn={luhn(digits)}")
        if word.count(".") == 3:
            own.append(f"parts={all(_BYTE(p) and int(p) < 256 for p in word.split('.'))}")
        for name, other in (("-1", k - 1), ("+1", k + 1), ("-2", k - 2)):
            inside = 0 <= other < len(words)
            own.append(f"{name}shape={shapes[other] if inside else ''}")
            if name != "-2":
                own.append(f"{name}word={lowered[other] if inside else ''}")
        own.append(f"{shapes[k - 1] if k else ''}|{shapes[k]}")
        out.append(own)
    return out


# ---- the field

_BLOCKED = np.zeros((len(LABELS), len(LABELS)))
for _i, _a in enumerate(LABELS):
    for _j, _b in enumerate(LABELS):
        if _b[0] == "I" and _a[2:] != _b[2:]:
            _BLOCKED[_i, _j] = -1e4
_START = np.array([-1e4 if x[0] == "I" else 0.0 for x in LABELS])


def _summed(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def viterbi(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Best labels of a batch of sequences (batch, words, labels), padded behind their lengths."""
    batch, steps, _ = emissions.shape
    score = emissions[:, 0] + _START
    back = np.zeros((steps, batch, len(LABELS)), np.int8)
    for t in range(1, steps):
        each = score[:, :, None] + transitions
        back[t] = each.argmax(1)
        score = np.where((t < lengths)[:, None], each.max(1) + emissions[:, t], score)
    out = np.zeros((batch, steps), np.int8)
    label = score.argmax(1)
    for t in range(steps - 1, -1, -1):
        inside = t < lengths
        out[inside, t] = label[inside]
        label = np.where(inside, back[t][np.arange(batch), label] if t else label, label)
    return out


class Field:
    """Weights of features and of label changes."""

    def __init__(self, places: dict[str, int], weights: np.ndarray, transitions: np.ndarray):
        self.places, self.weights, self.transitions = places, weights, transitions

    def emissions(self, sequences: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Padded scores of the labels, and the lengths; unknown features count for nothing."""
        lengths = np.array([len(s) for s in sequences])
        out = np.zeros((len(sequences), lengths.max(), len(LABELS)))
        for k, sequence in enumerate(sequences):
            known = [[self.places[f] for f in word if f in self.places] for word in sequence]
            ends = np.cumsum([len(w) for w in known])
            flat = self.weights[[p for w in known for p in w]].cumsum(0)
            flat = np.concatenate([np.zeros((1, len(LABELS))), flat])
            out[k, : len(known)] = np.diff(flat[np.concatenate([[0], ends])], axis=0)
        return out, lengths

    def tags(self, sequences: list[list[list[str]]]) -> list[np.ndarray]:
        """Labels of each sequence; sequences of like length are decoded together."""
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(sequences)
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(sequences[order[end]]) * (end + 1 - at) <= BATCH_WORDS:
                end += 1
            part = order[at:end]
            emissions, lengths = self.emissions([sequences[k] for k in part])
            for k, labels, n in zip(part, viterbi(emissions, lengths, self.transitions), lengths, strict=True):
                out[k] = labels[:n]
            at = end
        return out


def train(table: list[tuple[str, list[Span]]], rounds: int = 120) -> Field:
    """Fit the field to labelled texts by full-batch gradient steps on the penalised log-likelihood."""
    sequences, labels = [], []
    for text, spans in table:
        places = [m.span() for m in _WORD.finditer(text)]
        sequences.append(features([text[slice(*core(text, a, b))] for a, b in places]))
        tags = []
        for a, b in (core(text, *p) for p in places):
            inside = next((s for s in spans if a < s[2] and s[1] < b), None)
            tags.append(0 if inside is None else LABELS.index(f"{'B' if a <= inside[1] else 'I'}-{inside[0]}"))
        labels.append(tags)
    names = {f: k for k, f in enumerate(dict.fromkeys(f for s in sequences for w in s for f in w))}
    field = Field(names, np.zeros((len(names), len(LABELS))), _BLOCKED.copy())
    lengths = np.array([len(s) for s in sequences])
    batch, steps = len(sequences), lengths.max()
    rows = np.array([(k, t, names[f]) for k, s in enumerate(sequences) for t, w in enumerate(s) for f in w])
    truth = np.zeros((batch, steps, len(LABELS)))
    for k, tags in enumerate(labels):
        truth[k, range(len(tags)), tags] = 1
    inside = np.arange(steps)[None] < lengths[:, None]
    pairs = (truth[:, :-1, :, None] * truth[:, 1:, None, :]).sum((0, 1))
    moments = [np.zeros((2, *x.shape)) for x in (field.weights, field.transitions)]
    for step in range(1, rounds + 1):
        emissions = np.zeros((batch, steps, len(LABELS)))
        np.add.at(emissions, (rows[:, 0], rows[:, 1]), field.weights[rows[:, 2]])
        ahead, behind = np.zeros_like(emissions), np.zeros_like(emissions)
        ahead[:, 0] = emissions[:, 0] + _START
        for t in range(1, steps):
            new = _summed(ahead[:, t - 1, :, None] + field.transitions, 1) + emissions[:, t]
            ahead[:, t] = np.where(inside[:, t, None], new, ahead[:, t - 1])
        total = _summed(ahead[:, -1], 1)
        expected = np.zeros_like(field.transitions)
        for t in range(steps - 2, -1, -1):
            following = emissions[:, t + 1] + behind[:, t + 1]
            new = _summed(field.transitions[None] + following[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], new, 0)
            each = np.exp(ahead[:, t, :, None] + field.transitions + following[:, None, :] - total[:, None, None])
            expected += (each * inside[:, t + 1, None, None]).sum(0)
        chance = np.exp(ahead + behind - total[:, None, None]) * inside[:, :, None]
        slope = np.zeros_like(field.weights)
        np.add.at(slope, rows[:, 2], (truth - chance)[rows[:, 0], rows[:, 1]])
        for x, g, m in zip((field.weights, field.transitions), (slope - 0.1 * field.weights, pairs - expected), moments, strict=True):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            x += 0.1 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
        field.transitions[_BLOCKED < 0] = -1e4
    return field


def labelled_table(seed: int = 10) -> list[tuple[str, list[Span]]]:
    """The small labelled table: each sentence frame with each way of writing a kind, and with what is none of them."""
    rng = np.random.default_rng(seed)

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def card() -> str:
        first = "4" + digits(14)
        return next(first + str(d) for d in range(10) if luhn(first + str(d)))

    def octets() -> list[str]:
        return [str(x) for x in rng.integers(1, 256, 4)]

    def grouped(text: str, between: str) -> str:
        return between.join(text[k : k + 4] for k in range(0, len(text), 4))

    names, hosts = ("jane.roe", "office", "max7", "a.lopez"), ("mail.com", "example.org", "uni.edu")
    pick = lambda of: of[rng.integers(len(of))]
    ways = {
        "email": [
            lambda: f"{pick(names)}@{pick(hosts)}", lambda: f"{pick(names)}.{digits(2)}@mail{digits(1)}.example.com",
            lambda: f"{pick(names)}(at){pick(hosts)}", lambda: f"{pick(names)}[at]{pick(hosts)}", lambda: f"{pick(names)} (at) {pick(hosts)}",
            lambda: f"{pick(names)} [at] {pick(hosts)}", lambda: f"{pick(names)} @ {pick(hosts)}",
            lambda: f"{pick(names)} at {pick(hosts).replace('.', ' dot ')}", lambda: f"{pick(names)} [at] {pick(hosts).replace('.', ' [dot] ')}",
        ],
        "ip": [lambda: ".".join(octets()), lambda: "[.]".join(octets()), lambda: "(.)".join(octets())],
        "card": [card, lambda: grouped(card(), " "), lambda: grouped(card(), "-"), lambda: grouped(card(), ".")],
        "phone": [
            lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: f"+{digits(2)} {digits(3)} {digits(7)}", lambda: f"({digits(3)}) 555-{digits(4)}",
            lambda: f"{digits(3)}-555-{digits(4)}", lambda: f"{digits(3)}.555.{digits(4)}", lambda: f"00{digits(2)} {digits(3)} {digits(7)}",
        ],
    }
    none = [
        lambda: f'token = "{rng.bytes(20).hex()}"', lambda: f"key={rng.bytes(8).hex()}", lambda: f"version {digits(1)}.{digits(1)}.", lambda: "version 3.",
        lambda: f"in 19{digits(2)}", lambda: f"{digits(2)}%", lambda: f"${digits(3)}.{digits(2)}", lambda: f"20{digits(2)}-1{digits(1)}-2{digits(1)}", lambda: f"{digits(2)}:{digits(2)}",
        lambda: "CC BY-NC 4.0.", lambda: f"no. {digits(5)}", lambda: f"{digits(6)} of {digits(5)}", lambda: f"{digits(3)}.{digits(2)}", lambda: f"{digits(16)[:-1]}", lambda: f"300.{digits(3)}.1.1.2",
        lambda: f"{digits(4)}-{digits(2)}", lambda: f"x{digits(3)}", lambda: f"{digits(1)}, {digits(1)}, {digits(2)}", lambda: "the dot on it", lambda: "at home", lambda: f"{digits(20)}",
        lambda: f"{digits(3)} {digits(3)} {digits(4)}", lambda: f"{digits(3)}-{digits(3)}", lambda: f"{digits(8)}", lambda: f"{digits(12)}", lambda: f"&&& {digits(3)}###",
    ]
    frames = ("write to {} please.", "Ed, the {} and of this", "de la, que {}, y los", "mit der {} ist ein", "le des {}. Et ou", "| tabel | {} | onea", "call {}", "THE!! {}!! AND!!", "{}")
    table: list[tuple[str, list[Span]]] = []
    for frame in frames:
        for kind, made in ways.items():
            for way in made:
                value = way()
                begin = frame.index("{}")
                table.append((frame.format(value), [(kind, begin, begin + len(value))]))
        table += [(frame.format(way()), []) for way in none]
    return table


@lru_cache(maxsize=1)
def default_field() -> Field:
    """The field of the labelled table above."""
    return train(labelled_table())


def _holds(kind: str, value: str) -> bool:
    """What an added span of a kind must have at least."""
    digits = _NOT_DIGIT.sub("", value)
    if kind == "email":
        return bool(re.search(r"@|[(\[{]\s?at\s?[)\]}]|\bat\b", value)) and bool(re.search(r"\w\s?(\.|[(\[{]?\s?\bdot\b\s?[)\]}]?)\s?\w", value))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", value)
        return len(parts) == 4 and all(int(p) <= 255 for p in parts if len(p) < 10) and max(map(len, parts)) <= 3
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not re.search(r"[A-Za-z@$%#&]", value)


def decoded(text: str, cores: Iterable[tuple[int, int]], field: Field) -> Iterator[tuple[tuple[int, int], int]]:
    """Each word of one sequence with its label, as `viterbi` of the whole sequence has it. Features and scores are held for
    a piece, and the ways back for the words whose label still depends on what follows."""
    words, score = iter(cores), None
    held: list[tuple[int, int]] = []
    back = np.zeros((0, len(LABELS)), np.int8)

    def settled(last: int, label: int) -> Iterator[tuple[tuple[int, int], int]]:
        labels = [label]
        for t in range(last, 0, -1):
            labels.append(int(back[t, labels[-1]]))
        return zip(held[: last + 1], reversed(labels), strict=True)

    before: list[tuple[int, int]] = []
    piece = list(islice(words, PIECE_WORDS))
    while piece:
        following = list(islice(words, PIECE_WORDS))
        each = features([text[a:b] for a, b in (*before, *piece, *following[:1])])[len(before) :][: len(piece)]
        emissions = field.emissions([each])[0][0]
        new = np.zeros((len(piece), len(LABELS)), np.int8)
        for t, emission in enumerate(emissions):
            if score is None:
                score = emission + _START
            else:
                ways = score[:, None] + field.transitions
                new[t], score = ways.argmax(0), ways.max(0) + emission
        held += piece
        back = np.concatenate([back, new])
        # the last word whose label is the same whatever the last label is
        at, labels = len(held) - 1, np.arange(len(LABELS))
        while at > 0 and labels.min() < labels.max():
            labels = back[at, labels]
            at -= 1
        if labels.min() == labels.max():
            yield from settled(at, int(labels[0]))
            held, back = held[at + 1 :], back[at + 1 :]
        before, piece = (before + piece)[-2:], following
    if held:
        yield from settled(len(held) - 1, int(score.argmax()))


class _Taken:
    """The places that spans take."""

    def __init__(self, spans: list[Span]):
        places = sorted((a, b) for _, a, b in spans)
        self.begins = [a for a, _ in places]
        self.ends = list(accumulate((b for _, b in places), max))

    def free(self, begin: int, behind: int) -> bool:
        k = bisect_left(self.begins, behind)
        return k == 0 or self.ends[k - 1] <= begin


def _labelled_spans(text: str, labelled: Iterable[tuple[tuple[int, int], int]], taken: _Taken) -> list[Span]:
    """The free spans of a B and the I of its kind behind it that have what their kind needs."""
    out: list[Span] = []
    kind, begin, behind = "", 0, 0
    for (a, b), label in chain(labelled, [((0, 0), 0)]):
        name = LABELS[label]
        if kind and name == f"I-{kind}":
            behind = b
            continue
        if kind and begin < behind and taken.free(begin, behind) and _holds(kind, text[begin:behind]):
            out.append((kind, begin, behind))
        kind, begin, behind = (name[2:], a, b) if name[0] == "B" else ("", 0, 0)
    return out


def added_spans(texts: list[str], base: list[list[Span]], field: Field) -> list[list[Span]]:
    """Spans that the field finds besides the base ones, none overlapping any of them."""
    out: list[list[Span]] = [[] for _ in texts]
    taken = [_Taken(b) for b in base]
    batch: list[tuple[int, list[tuple[int, int]]]] = []

    def decode() -> None:
        tags = field.tags([features([texts[k][a:b] for a, b in c]) for k, c in batch]) if batch else []
        for (k, c), labels in zip(batch, tags, strict=True):
            out[k] += _labelled_spans(texts[k], zip(c, labels.tolist(), strict=True), taken[k])
        batch.clear()

    size = 0
    for k, text in enumerate(texts):
        for _, group in groupby(_places(text), itemgetter(0)):
            cores = (core(text, a, b) for _, a, b in group)
            first = list(islice(cores, PIECE_WORDS))
            if len(first) < PIECE_WORDS:
                batch.append((k, first))
                size += len(first)
            if size >= BATCH_WORDS or len(first) == PIECE_WORDS:
                decode()
                size = 0
            if len(first) == PIECE_WORDS:
                out[k] += _labelled_spans(text, decoded(text, chain(first, cores), field), taken[k])
    decode()
    return out


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string, "
    "found array<struct<kind:string,start:int,end:int,added:boolean>>"
)


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Per row: doc_id, the numbers of base spans by kind, n_added, base_sha256, spans (all, joined), and found, the
    spans as an array. Places are code points, the end exclusive.

    NULL text counts as empty and has no spans. Equal texts get equal results. Other columns are left out.
    """
    field = field or default_field()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            texts = texts_of(batch)
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, field)
            columns: dict[str, pa.Array] = {"doc_id": batch.column("doc_id")}
            for kind in KINDS:
                columns[f"n_{kind}"] = pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64())
            columns["n_added"] = pa.array(map(len, more), pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string())
            columns["spans"] = pa.array([joined(b + m) for b, m in zip(base, more, strict=True)], pa.string())
            found = [
                [{"kind": k, "start": a, "end": e, "added": new} for part, new in ((b, False), (m, True)) for k, a, e in part]
                for b, m in zip(base, more, strict=True)
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))
            yield pa.RecordBatch.from_pydict(columns | {"found": pa.array(found, kind)})

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SCHEMA)
