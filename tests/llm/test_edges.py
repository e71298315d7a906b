"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitchflow.llm import queries

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, key string, row string, start long"
LONG = "\n".join(f"word{k} lies beside word{k % 977} in line {k}" for k in range(40_000))
PROSE = "the quick brown fox jumps over the lazy dog and then sleeps beneath an old oak tree near some quiet river bank\n"
ROWS = [
    (1, PROSE * 2, "en", "a"),
    (1, PROSE * 2, "en", "a"),
    (2, PROSE + "another ending of some words", "en", "b"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (5, LONG, "en", "a"),
    (6, LONG + " more", "de", "a"),
    (7, "  \n\t ", "de", "é"),
    (None, PROSE, "en", "a"),
    (None, None, None, None),
    (8, "12345 !!! 4111 1111 1111 1111 \x1c \x85 日本 語", "fr", "c"),
    (9, "word", "fr", ""),
    (10, "no\x00null " + "x" * 100_000, None, "c"),
    (8, "other text under the same id with a few words of its own", "fr", "c"),
    (11, "see 1.2.3.\u00b2 there, 1.2.3.\u2460 and \u0661\u0662.\u0663.\u0664.\u0665 or \u0967.2.3.4 +\uff11 \uff12\uff13 10.20.30.40", "en", "d"),
]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Folders of tables: odd rows, and no rows at all."""
    out = {}
    for name, rows in (("odd", ROWS), ("empty", [])):
        path = str(tmp_path_factory.mktemp(name))
        full = [(*r, len(r[1] or ""), 0.5, 3, "k", "r", 9) for r in rows]
        spark.createDataFrame(full, DOCUMENTS).coalesce(2).write.parquet(f"{path}/documents.parquet")
        labels = [(1, 1, 0), (2, 1, 1), (5, None, None), (None, 1, 1), (2, 1, 1)] if rows else []
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        vectors = [
            (0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [1.0, 0.0]), (40, [0.0, 0.0]), (5, [None, 1.0]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, None), (None, [1.0, 1.0]), (9, []), (60, [1.0, 2.0, 3.0]),
        ] if rows else []
        spark.createDataFrame([(*v, 1, 2, "x") for v in vectors], "vec_id long, embedding array<float>, label int, rank int, bucket string").write.parquet(
            f"{path}/embeddings.parquet"
        )
        out[name] = path
    return out


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, folders, name):
    assert queries.QUERIES[name](spark, folders["empty"]).count() == 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op6_multiprobe_search", "op9_sum_of_squares_packing", "op13_divergence_audit", "pipeline"}))
def test_one_row_per_row(spark, folders, name):
    found = queries.QUERIES[name](spark, folders["odd"])
    assert sorted((r["doc_id"] for r in found.collect()), key=str) == sorted((r[0] for r in ROWS), key=str)


def test_search_leaves_unusable_vectors_out(spark, folders):
    found = [tuple(r) for r in queries.op6_multiprobe_search(spark, folders["odd"]).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 4, 1.0), (0, 2, 20, 1.0), (0, 3, 3, 0.5), (20, 1, 0, 1.0), (20, 2, 4, 1.0), (20, 3, 3, 0.5)]


def test_packing_has_every_row(spark, folders):
    found = queries.op9_sum_of_squares_packing(spark, folders["odd"])
    each = {r["doc_id"]: (r["n"], r["total"]) for r in found.groupBy("doc_id").agg(F.sum("length").alias("n"), F.min("doc_tokens").alias("total")).collect()}
    assert set(each) == {r[0] for r in ROWS}
    assert each[3] == (1, 1) and each[4] == (1, 1) and each[7] == (1, 1)
    assert each[5][0] == each[5][1]


def test_defined_results(spark, folders):
    lines = {(r["doc_id"], r["text"]) for r in queries.op1_line_dedup(spark, folders["odd"]).collect()}
    assert {(3, None), (4, ""), (2, "another ending of some words"), (1, PROSE * 2), (None, PROSE), (None, None)} <= lines
    near = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in queries.op5_tensored_minhash(spark, folders["odd"]).collect()}
    assert {(3, 0, 3, True), (4, 0, 4, True), (7, 0, 7, True), (9, 1, 9, True)} <= near
    assert {(d, c, k) for d, _, c, k in near if d in (5, 6)} == {(5, 5, True), (6, 5, False)}
    assert {k for d, _, _, k in near if d is None} == {True}
    language = {(r["doc_id"], r["lang_pred"]) for r in queries.op8_ecoc_language(spark, folders["odd"]).collect()}
    assert {(3, "und"), (4, "und"), (7, "und"), (None, "und")} <= language
    mixed = {r["doc_id"]: r for r in queries.op2_curriculum_mixing(spark, folders["odd"]).collect()}
    assert mixed[3]["size"] == 0 and mixed[3]["taken"] == 0 and mixed[9]["size"] == 1
    personal = {r["doc_id"]: r for r in queries.op10_crf_personal_data(spark, folders["odd"]).collect()}
    assert personal[3]["spans"] == "" and personal[3]["n_card"] == 0
    assert (personal[11]["n_ip"], personal[11]["n_phone"]) == (1, 0)
    rules = {r["doc_id"]: r for r in queries.op4_divergence_rules(spark, folders["odd"]).collect()}
    assert rules[3]["base_failed"] and not rules[3]["kept"] and rules[5]["n_words"] == 280_000


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, folders, name, stage):
    for folder in folders.values():
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns
        rows = found.select("doc_id", "text", "source", "score", "row", "key").collect()
        assert all(r["row"] == "r" and r["key"] == "k" and r["score"] == 0.5 for r in rows)
        if folder == folders["empty"]:
            assert not rows


def test_near_duplicate_stage_keeps_one_of_equal_rows(spark, folders):
    docs = spark.read.parquet(f"{folders['odd']}/documents.parquet")
    kept = sorted(str(r["doc_id"]) for r in corpus_pipeline.near_duplicates(spark, docs, folders["odd"]).collect())
    assert kept == sorted(["1", "2", "3", "4", "5", "7", "None", "None", "8", "8", "9", "10", "11"])
