"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1; for each bit a linear classifier over hashed character trigrams is fitted to
tell the languages on either side. A text's language is the codeword with the least weighted loss, a bit
counting as much as its classifier was right about that language; a near tie is flagged as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitchflow.llm.common import small_batches, text_steps, texts_of

#: Dimensions of the hashed trigram counts.
DIMENSIONS = 4096
#: Documents fitted on, over all languages, by the smallest hash of their ids: the bound of the sample.
SAMPLE = 1000
#: More languages than this are an error, not a silent cut.
MAX_LANGUAGES = 500
#: Below this score the two nearest codewords are too close to tell.
AMBIGUOUS = 0.6
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
# letters of ASCII in lower case and all bytes of other characters; the rest is a blank
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_PART = 1 << 19


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed byte trigrams of the lower-cased letters, one row per text; runs of blanks count once."""
    data = [re.sub(rb"  +", b" ", b" " + t.lower().encode("utf-8", "surrogatepass").translate(_TABLE) + b" ") for t in texts]
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    flat = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(d) for d in data])
    for at in range(0, len(flat), _PART):
        part = flat[at : at + _PART + 2].astype(np.uint32)
        if len(part) < 3:
            break
        hashed = (part[:-2] * _A + part[1:-1] * _B + part[2:] * _C) >> np.uint32(20)
        owner = np.searchsorted(ends, np.arange(at, at + len(hashed)), "right")
        first, last = owner[0], owner[-1]
        inside = np.arange(at, at + len(hashed)) + 2 < ends[owner]
        slots = (owner[inside] - first) * DIMENSIONS + hashed[inside]
        counts = np.bincount(slots, minlength=(last - first + 1) * DIMENSIONS)
        out[first : last + 1] += counts.reshape(-1, DIMENSIONS)
    return out


def codewords(n: int) -> np.ndarray:
    """n codewords: every split of the languages up to 7 of them, else the best of 50 random codes."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 7:
        splits = np.arange(1, 2 ** (n - 1))
        return np.array([[1 if at == 0 else 1 - 2 * int(s >> (at - 1) & 1) for s in splits] for at in range(n)], np.int8)
    rng, bits = np.random.default_rng(8), int(np.ceil(10 * np.log2(n)))
    best, most = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        apart = (bits - code.astype(int) @ code.T.astype(int)) // 2 + bits * np.eye(n, dtype=int)
        if apart.min() > most:
            best, most = code, apart.min()
    return best


@dataclass
class LanguageModel:
    """languages, their codewords, a linear classifier per bit, the bits' weights per language."""

    languages: list[str]
    code: np.ndarray
    scale: np.ndarray
    center: np.ndarray
    classifiers: np.ndarray
    weights: np.ndarray
    sharpness: float

    def decide(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        """Language (`und` without a letter), score (0 to 1) and whether the nearest two are too close to tell."""
        lettered = [bool(_LETTER.search(t)) for t in texts]
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts)
        losses = self._losses(trigram_counts(texts))
        share = np.exp(-self.sharpness * (losses - losses.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        scores = [float(s[k]) if ok else 0.0 for s, k, ok in zip(share, best, lettered, strict=True)]
        names = [self.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered, strict=True)]
        return names, scores, [ok and s < AMBIGUOUS for s, ok in zip(scores, lettered, strict=True)]

    def _margins(self, counts: np.ndarray) -> np.ndarray:
        frequency = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        return (frequency * self.scale - self.center) @ self.classifiers

    def _losses(self, counts: np.ndarray) -> np.ndarray:
        loss = np.exp(-np.clip(self._margins(counts)[:, None, :] * self.code[None], -3, 3))
        return (loss * self.weights[None]).sum(2)


def fit(languages: list[str], counts: np.ndarray, labels: np.ndarray) -> LanguageModel:
    """Regularised least squares per bit of the code, languages weighing alike; labels index languages."""
    code = codewords(len(languages))
    n = np.maximum(np.bincount(labels, minlength=len(languages)), 1)
    frequency = counts / np.maximum(counts.sum(1, keepdims=True), 1).astype(np.float32)
    balance = (1 / n[labels]).astype(np.float32)
    mean = (frequency * balance[:, None]).sum(0) / balance.sum()
    scale = 1 / np.sqrt(mean + 1 / DIMENSIONS / 10)
    x = frequency * scale - mean * scale
    y = code[labels].astype(float)
    kernel = x @ x.T
    ridge = 1e-3 * np.trace(kernel) / len(labels) * balance.mean() / balance
    dual = np.linalg.solve(kernel + np.diag(ridge), y)
    model = LanguageModel(languages, code, scale.astype(np.float32), (mean * scale).astype(np.float32), (x.T @ dual).astype(np.float32), np.ones(code.shape), 1.0)
    right = (np.sign(model._margins(counts)) == code[labels]).astype(float)
    accuracy = np.array([right[labels == k].mean(0) if (labels == k).any() else np.ones(code.shape[1]) for k in range(len(languages))])
    model.weights = np.maximum(accuracy, 1e-3) / np.maximum(accuracy, 1e-3).sum(1, keepdims=True)
    # one number for how much a difference of losses says, by the likelihood of the sample
    losses = model._losses(counts)
    grid = np.array([0.5, 1, 2, 4, 8, 16])
    found = [(np.log(np.exp(-g * (losses - losses.min(1, keepdims=True))).sum(1)) + g * (losses[np.arange(len(labels)), labels] - losses.min(1))).mean() for g in grid]
    model.sharpness = float(grid[int(np.argmin(found))])
    return model


def train(labelled: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Fit on a bounded sample of (doc_id, text, lang): of each language as many whole documents as `sample` allows for
    all, one at least, those with the smallest hashes. Of more than `MAX_LANGUAGES` values of lang, those with the most documents
    are learned. Rows with a NULL lang or no text are left out; without any the model knows no language."""
    some = small_batches(labelled).filter("lang is not null and length(text) > 0").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    sizes = some.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return LanguageModel([], np.ones((0, 1)), *[np.zeros(1)] * 4, 1.0)
    sizes.sort(key=lambda r: r["lang"])
    languages, wanted = [r["lang"] for r in sizes], -(-sample // len(sizes))
    # a first cut by the hash leaves each language some more than wanted, and a small one whole; the smallest hashes of those count
    rates = F.create_map(*(x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, (3 * wanted + 20) / r["count"])))))
    place = F.create_map(*(x for k, lang in enumerate(languages) for x in (F.lit(lang), F.lit(k))))
    mark = F.xxhash64("doc_id", F.lit("sample"))
    drawn = F.pmod(mark, F.lit(1 << 20)) / F.lit(float(1 << 20)) < rates[F.col("lang")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id", F.xxhash64("text")))
    chosen = some.filter(drawn).withColumn("mark", F.pmod(mark, F.lit(1 << 20))).withColumn("rank", rank)
    chosen = chosen.filter(F.col("rank") <= wanted).select("text", place[F.col("lang")].alias("label"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_steps(batches):
            counts = trigram_counts(texts_of(batch))
            yield pa.RecordBatch.from_pydict(
                {
                    "label": batch.column("label").cast(pa.int32()),
                    "counts": pa.array([c.astype("<u4").tobytes() for c in counts], pa.binary()),
                }
            )

    found = chosen.mapInArrow(rows, "label int, counts binary").collect()
    if not found:
        return LanguageModel([], np.ones((0, 1)), *[np.zeros(1)] * 4, 1.0)
    found.sort(key=lambda r: (r["label"], bytes(r["counts"])))
    seen = sorted({r["label"] for r in found})
    labels = np.array([seen.index(r["label"]) for r in found])
    counts = np.stack([np.frombuffer(r["counts"], "<u4") for r in found]).astype(np.float32)
    return fit([languages[k] for k in seen], counts, labels)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of `docs` with lang_pred, score and ambiguous behind all their columns (of which those names are replaced).

    NULL and empty texts and texts without a letter are `und` with score 0. Only the text is looked at; it is read
    whole, whatever its length. Equal texts get equal results.
    """
    docs = small_batches(docs)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def decided(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        out: list[tuple] = []
        step: list[str] = []
        held = 0
        for text in [*texts, None]:
            step.append(text or "")
            held += len(step[-1])
            if held > 500_000 or len(step) >= 256:
                out += zip(*model.decide(step), strict=True)
                step, held = [], 0
        out += zip(*model.decide(step), strict=True) if step else []
        return pd.DataFrame(out[: len(texts)], columns=["lang_pred", "score", "ambiguous"])

    found: Column = decided("text")
    return docs.select(*keep, found.alias("found")).select(*keep, "found.lang_pred", "found.score", "found.ambiguous")
