"""From raw documents to packed training sequences, in five stages over all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitchflow.llm import ecoc, line_dedup, minhash, mixing, ss_packing
from pitchflow.llm.common import staged
from pitchflow.llm.queries import WORD_END, WORD_TOKENIZER, held_out

#: Fixed shingle size and similarity of near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Chunks in an encoder's table, and bytes of text in a step: the workers that pack have run the other stages too, and keep their memory.
CACHE_CHUNKS, PACK_STEP_BYTES = 50_000, 1_000_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are NULL, without letters or ambiguous go."""
    model = ecoc.train(docs.filter(~held_out(4, 2)).select("doc_id", "text", "lang"))
    found = ecoc.identify(docs.select(F.struct(*docs.columns).alias("row"), "text"), model)
    return found.filter((F.col("lang_pred") != ecoc.UNDETERMINED) & ~F.col("ambiguous")).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks an earlier one has; those of which no word is left go."""
    cut = line_dedup.dedup_lines(docs)
    left = (F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cut.filter(left).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; of equal rows one."""
    found = minhash.near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    kept = found.filter("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.filter("doc_id is not null").select("doc_id", F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("hash"))
    again = F.row_number().over(Window.partitionBy("doc_id", "hash").orderBy("hash"))
    rows = rows.join(kept, "doc_id", "left_semi").withColumn("again", again).filter("again = 1").select("row.*")
    return rows.union(docs.filter("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's target takes them."""
    return mixing.mixed_documents(docs, written=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 ids."""
    pieces = ss_packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), WORD_END, cache_chunks=CACHE_CHUNKS, step_bytes=PACK_STEP_BYTES)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("line dedup", lines), ("near duplicates", near_duplicates), ("mixing", mix), ("packing", pack)]

#: Learned models, alignment and hashed order are not SQL-expressible; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
