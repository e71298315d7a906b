"""The queries of this subpackage: each applies its operator to its whole table, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.llm import crf_pii, divergence, ecoc, line_dedup, minhash, mixing, packed_ids, prefix_tokens, pstable, skyband, ss_packing, sync_runs, toxicity
from pitchflow.llm.common import remainder
from pitchflow.session import configure, scratch_path

BYTE_TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
BYTE_END, WORD_END = 0, 2
#: Tokens that a document may have.
TOKEN_LIMIT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(by: int, fold: int):
    """Whether a document is in the fold that nothing is learned from; a NULL id is not."""
    return F.coalesce(remainder(F.col("doc_id"), by) == fold, F.lit(False))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the blocks that an earlier one has."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, and the training positions of the takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    position = F.transform("takes", lambda t: t["position"])
    columns = ("doc_id", "size", "source_size", "target", "taken")
    return mixed.select(*columns, position.alias("positions")).orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def op3_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from files of bit-packed ids."""
    path = scratch_path(spark, "packed_ids")
    packed_ids.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_TOKENIZER), BYTE_END)
    return packed_ids.with_starts(packed_ids.read_ids(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict by distance to the language's reference."""
    docs = table(spark, sf_dir, "documents")
    return divergence.judge(docs, divergence.references(docs))


def op5_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op6_multiprobe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th."""
    return pstable.nearest(table(spark, sf_dir, "embeddings"), top=20, every=20)


def op7_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs.filter(~held_out(3, 1)), labels.filter(~held_out(3, 1)))
    scored = toxicity.score(docs, model).withColumn("held_out", held_out(3, 1))
    predicted = (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted, "n_segments")


def op8_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document."""
    docs = table(spark, sf_dir, "documents")
    model = ecoc.train(docs.filter(~held_out(4, 2)).select("doc_id", "text", "lang"))
    found = ecoc.identify(docs.select("doc_id", "text"), model).withColumn("held_out", held_out(4, 2))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    pieces = ss_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), WORD_END)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document."""
    return crf_pii.find(table(spark, sf_dir, "documents")).drop("found")


def with_periods(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words that a document's text is read as: every tenth one repeats a stretch to its end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each document and digests of them and of the text without the repeats."""
    found = sync_runs.collapse_runs(table(spark, sf_dir, "documents"), with_periods)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("div(1000 * best.length, best.period)").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, and how much of it the limit takes."""
    counted = prefix_tokens.with_prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_TOKENIZER), TOKEN_LIMIT)
    over = (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return counted.select("doc_id", "n_bytes", "n_tokens", over, "fit_chars")


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that each has too many of."""
    return skyband.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(configure(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_curriculum_mixing, op3_packed_ids, op4_divergence_rules, op5_tensored_minhash, op6_multiprobe_search,
        op7_toxic_segments, op8_ecoc_language, op9_sum_of_squares_packing, op10_crf_personal_data,
        op11_periodic_runs, op12_prefix_token_counts, op13_divergence_audit, pipeline,
    )
}

# Near duplicates as a plain join of shingles and a recursive walk: exact, and quadratic in the documents of a
# shingle, which the small tables allow. The audit from every (group, kept term) with its count. The other operators'
# results are not SQL-expressible.
ORACLES: dict[str, str] = {
    "op5_tensored_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) = 1 THEN [[w[1]]]
         ELSE list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * m >= 80 * (p.n + q.n - m)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
""",
    "op13_divergence_audit": r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), terms AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
occurring AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT o.lang, o.source, k.term, k.lang_n, coalesce(c.n, 0) AS n,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY o.lang, o.source) AS total,
         count(*) OVER (PARTITION BY o.lang, o.source) AS v
  FROM occurring o JOIN kept k ON k.lang = o.lang
  LEFT JOIN counts c ON c.lang = o.lang AND c.source = o.source AND c.term = k.term
), langs AS (SELECT lang, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v)::HUGEINT AS q
  FROM cells JOIN langs USING (lang)
), summed AS (
  SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), every AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
  FROM occurring x JOIN occurring y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN summed s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
}
