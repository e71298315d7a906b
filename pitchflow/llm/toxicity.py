"""Toxicity by maximum-scoring segments of token log-odds.

Each token has the log-odds of standing in a toxic document, with a Dirichlet prior that is that of the word's beginning:
a word backs off to its first seven letters, these to six and so on down to four, these to all tokens. Training counts a
token once per document. Scoring counts it wherever it stands, but a positive one at most once in `NEAR` words: repeating
it there says nothing new. One linear scan finds every
maximal segment of a document (Ruzzo and Tompa); a segment's score becomes an E-value of the extreme-value law that
the best segments of clean documents of that length follow, and a document's evidence is that of its
significant segments together, put on a scale of 0 to 1 by the labelled documents.
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

#: Labelled documents of either class that are fitted on, about: the bound of the sample.
SAMPLE = 6000
#: Weight of the prior in tokens, and the toxic sample documents a token must be in to have a score of its own.
PRIOR, MIN_DOCS = 10.0, 3
#: Score of every token without one of its own, so that segments end.
DRIFT = -0.2
#: Words from a counted positive token in which the same one has the drift's score: more than most scores outlast.
NEAR = 25
#: A segment is significant if fewer than this many as good are expected in a clean document of its length.
SIGNIFICANT = 0.05
TOXIC_FROM = 0.7

_WORDS = re.compile(r"[^\W\d_]+").findall


def parts_of(word: str) -> list[str]:
    """A word and what it backs off to, the most particular first; beginnings are marked with a hyphen."""
    return [word, *(word[:n] + "-" for n in (7, 6, 5, 4) if len(word) > n)]


class TokenScores(dict):
    """Score of every word met, from the scored tokens: the most particular of a word's parts that has one."""

    LIMIT = 200_000

    def __init__(self, scored: dict[str, float]):
        super().__init__()
        self.scored = scored

    def __missing__(self, word: str) -> float:
        found = next((self.scored[p] for p in parts_of(word) if p in self.scored), DRIFT)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = found
        return found


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, behind the last, score) in order, in linear time."""
    held: list[tuple[int, int, float, float]] = []  # first, end, total before, total behind
    total = 0.0
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        first, low = at, before
        while True:
            # the nearest candidate that began lower
            k = len(held) - 1
            while k >= 0 and held[k][2] >= low:
                k -= 1
            if k < 0 or held[k][3] >= total:
                held.append((first, at + 1, low, total))
                break
            first, low = held[k][0], held[k][2]
            del held[k:]
    return [(first, end, high - low) for first, end, low, high in held]


def counted_scores(words: list[str], scores: TokenScores) -> list[float]:
    """Scores of a document's words, with repeats near a counted one damped to the drift."""
    each = list(map(scores.__getitem__, words))
    last: dict[str, int] = {}
    for k, score in enumerate(each):
        if score > 0:
            if k - last.get(words[k], -NEAR) < NEAR:
                each[k] = DRIFT
            else:
                last[words[k]] = k
    return each


def segments_of(each: list[float]) -> list[tuple[int, int, float]]:
    """Maximal segments of a document's counted scores; documents without a positive token have none."""
    positive = [k for k, score in enumerate(each) if score > 0]
    if not positive:
        return []
    # runs of negative scores are one item: the scan is over the positive tokens
    totals = np.concatenate([[0.0], np.cumsum(each)])
    marks = [x for k in positive for x in (k, k + 1)]
    items = [totals[b] - totals[a] for a, b in zip(marks, marks[1:], strict=False)]
    return [(marks[a], marks[b], s) for a, b, s in maximal_segments(items)]


@dataclass
class ToxicityModel:
    """Scored tokens, the extreme-value law's rate and scale, and the logistic scale of the evidence."""

    scored: dict[str, float]
    rate: float
    scale: float
    slope: float
    offset: float

    def evidence(self, n_words: int, segments: list[tuple[int, int, float]]) -> float:
        """Minus the log of the E-values of the significant segments, together; else of the best one (0 at least)."""
        size = np.log(self.scale * max(n_words, 1))
        each = [self.rate * s - size for _, _, s in segments]
        strong = [x for x in each if x > -np.log(SIGNIFICANT)]
        return float(sum(strong) if strong else max([0.0, *each]))

    def score(self, evidence: float) -> float:
        """Between 0 and 1, rising with the evidence."""
        return float(1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -30, 30))))


def _draw(labelled: DataFrame, sample: int) -> DataFrame:
    """About `sample` documents of either class, by the smallest hashes of their ids."""
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rate = F.when(F.col("toxic") == 1, min(1.0, sample / max(sizes.get(1, 0), 1))).otherwise(min(1.0, sample / max(sizes.get(0, 0), 1)))
    return labelled.filter(drawn < rate)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on a bounded sample of the documents that `labels` (doc_id, toxic 0 or 1) marks; NULL labels and texts are left
    out. Without a toxic or without a clean document every text scores the share of toxic labels."""
    labels = labels.filter("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = _draw(labels.dropDuplicates(["doc_id"]), sample)
    texts = small_batches(docs).filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(F.broadcast(chosen), "doc_id")  # ids only, bounded by the sample
    texts = staged(texts, "toxic_sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = [Counter(), Counter()]
        within: Counter = Counter()
        n = [0, 0]
        for batch in text_steps(batches):
            for text, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist(), strict=True):
                words = set(_WORDS(text.lower()))
                n[toxic] += len(words)
                tokens[toxic].update(part for word in words for part in parts_of(word))
                within.update({part for word in words for part in parts_of(word)} if toxic else ())
        rows = [("", n[1], n[0], 0)] + [(t, tokens[1][t], tokens[0][t], within[t]) for t in tokens[0].keys() | tokens[1].keys()]
        columns = zip(*rows, strict=True)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["token", "toxic", "clean", "docs"])

    each = texts.mapInArrow(counted, "token string, toxic long, clean long, docs long").groupBy("token").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("docs").alias("docs")
    )
    # tokens in too few toxic documents are never scored, and only such tokens can score above the drift
    counts = {r["token"]: (r["toxic"], r["clean"]) for r in each.filter(f"token = '' or docs >= {MIN_DOCS}").collect()}
    toxic, clean = counts.pop("", (0, 0))
    share = (toxic or 0) / max((toxic or 0) + (clean or 0), 1)
    if not toxic or not clean:
        return ToxicityModel({}, 1.0, 1.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    scored = token_scores(counts, share)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = TokenScores(scored)
        for batch in text_steps(batches):
            each = [counted_scores(_WORDS(t.lower()), scores) for t in texts_of(batch)]
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column("toxic").cast(pa.int32()),
                    "n": pa.array(map(len, each), pa.int64()),
                    "positive": pa.array([sum(x > 0 for x in e) for e in each], pa.int64()),
                    "segments": pa.array([[s for _, _, s in segments_of(e)] for e in each], pa.list_(pa.float64())),
                }
            )

    rows = texts.mapInArrow(found, "toxic int, n long, positive long, segments array<double>").collect()
    return _calibrated(scored, rows)


def token_scores(counts: dict[str, tuple[int, int]], share: float) -> dict[str, float]:
    """Log-odds above those of all tokens, of the tokens whose counts (toxic, clean) set them apart from what they
    back off to."""
    belief: dict[str, float] = {}
    out: dict[str, float] = {}
    base = np.log(share / (1 - share))
    for token in sorted(counts, key=lambda t: (not t.endswith("-"), len(t), t)):
        word = token.rstrip("-")
        parents = [p for p in parts_of(word) if p != token and (not token.endswith("-") or len(p) < len(token))]
        prior = next((belief[p] for p in parents if p in belief), share)
        toxic, clean = counts[token]
        belief[token] = q = (toxic + PRIOR * prior) / (toxic + clean + PRIOR)
        spread = 1 / (toxic + PRIOR * prior) + 1 / (clean + PRIOR * (1 - prior))
        score = np.log(q / (1 - q)) - base
        if abs(score) > 2 * np.sqrt(spread):
            out[token] = float(score) if score > 0.5 else min(float(score), DRIFT)
    return out


def _calibrated(scored: dict[str, float], rows: list) -> ToxicityModel:
    """The law of clean documents' best segments, then the logistic scale of the evidence."""
    clean = [r for r in rows if r["toxic"] == 0]
    words = sum(r["n"] for r in clean)
    # a positive token's share among clean words, one more than seen so that the law is proper
    positive = (sum(r["positive"] for r in clean) + 1) / (words + 1)
    gain = float(np.median([s for s in scored.values() if s > 0] or [1.0]))
    low, high = 1e-3, 20.0
    for _ in range(60):  # sum of shares * exp(rate * score) = 1
        rate = (low + high) / 2
        if positive * np.exp(rate * gain) + (1 - positive) * np.exp(rate * DRIFT) > 1:
            high = rate
        else:
            low = rate
    best = [(r["n"], max([0.0, *r["segments"]])) for r in clean]
    scale = (len(best) + 1) / (sum(n * np.exp(-rate * s) for n, s in best) + 1)
    model = ToxicityModel(scored, rate, float(scale), 1.0, 0.0)
    x = np.array([model.evidence(r["n"], [(0, 0, s) for s in r["segments"]]) for r in rows])
    y = np.array([r["toxic"] for r in rows], float)
    # logistic regression by Newton's method, with one clean and one toxic pseudo-document at either end
    x, y = np.append(x, [0, 0, x.max(), x.max()]), np.append(y, [0, 1, 0, 1])
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(2)
    z = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        w -= np.clip(np.linalg.solve(hessian, z.T @ (weight * (p - y)) + 1e-3 * w), -2, 2)
    model.slope, model.offset = float(max(w[0], 1e-6)), float(w[1])
    return model


KINDS = "doc_id long, score double, n_segments long, passages array<struct<first:int,end:int,score:double>>"


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row: doc_id, score (0 to 1), n_segments, and the significant passages (first word, behind the last, score).

    Only the whole text is looked at; words are runs of letters. NULL and empty texts have no words and the score
    of no evidence. Equal texts get equal results. Other columns are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = TokenScores(model.scored)
        for batch in text_steps(batches):
            out = []
            for text in texts_of(batch):
                words = _WORDS(text.lower())
                segments = segments_of(counted_scores(words, scores))
                limit = np.log(model.scale * max(len(words), 1)) - np.log(SIGNIFICANT)
                strong = [{"first": a, "end": b, "score": float(s)} for a, b, s in segments if model.rate * s > limit]
                out.append((model.score(model.evidence(len(words), segments)), len(strong), strong))
            found, n, passages = zip(*out, strict=True)
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array(found, pa.float64()),
                    "n_segments": pa.array(n, pa.int64()),
                    "passages": pa.array(passages, kind),
                }
            )

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, KINDS)
