"""The operators against brute force, exact round trips and held-out accuracy."""

import itertools
import random
import re
import subprocess
import sys
import time
import zlib
from fractions import Fraction
from hashlib import sha256
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pitchflow.llm import crf_pii, divergence, ecoc, line_dedup, minhash, mixing, packed_ids, prefix_tokens, pstable, queries, skyband, ss_packing, sync_runs, tokens, toxicity
from pitchflow.llm.common import gathered
from pitchflow.llm.components import connected_components
from pitchflow.llm.tokens import encoder

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text, lang, source from read_parquet('{SMALL}/documents.parquet') order by 1").fetchall()


def plain_ids(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


# ---- 1 line dedup


def blocks_by_force(docs, min_words):
    """Every block (blank lines aside) with the words that an earlier document has too, by comparing all places."""
    def lines(text):
        return [(k, " ".join(x.encode().split() and x.split()), len(x.split())) for k, x in enumerate(text.split("\n")) if x.split()]

    out = {}
    for at, (doc_id, text) in enumerate(docs):
        mine, gone = lines(text), set()
        for _, other in docs[:at]:
            theirs = lines(other)
            for i, j in itertools.product(range(len(mine)), range(len(theirs))):
                n = 0
                while i + n < len(mine) and j + n < len(theirs) and mine[i + n][1] == theirs[j + n][1]:
                    n += 1
                if sum(w for _, _, w in mine[i : i + n]) >= min_words:
                    gone |= {k for k, _, _ in mine[i : i + n]}
        out[doc_id] = gone
    return out


@pytest.mark.parametrize("rare", [0, 3, 16])
def test_line_dedup_against_all_pairs(spark, monkeypatch, rare):
    """The same blocks go, whether their runs make pairs or are cut as common ones."""
    monkeypatch.setattr(line_dedup, "RARE", rare)
    rng = random.Random(1)
    pool = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(50)) for _ in range(rng.randint(4, 14))) for _ in range(40)]
    docs = []
    for doc_id in range(60):
        own = [f"own line {doc_id} number {k} with several words" for k in range(rng.randint(0, 4))]
        starts = [rng.randrange(37) for _ in range(rng.randint(0, 3))]
        shared = [x for s in starts for x in pool[s : s + rng.randint(1, 3)]]
        text = own + shared
        rng.shuffle(text) if rng.random() < 0.3 else None
        docs.append((doc_id, "\n".join(text)))
    found = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), 10)
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    force = blocks_by_force(docs, 10)
    for doc_id, text in docs:
        assert got[doc_id] == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in force[doc_id])


def test_common_blocks_by_force():
    rng = random.Random(4)
    for _ in range(2000):
        size = [rng.choice((1, 2, 3, 5, 12)) for _ in range(8)]
        earlier, later = ([rng.randrange(8) for _ in range(rng.randrange(12))] for _ in "ab")
        words, gone = [size[x] for x in later], set()
        for i, j in itertools.product(range(len(later)), range(len(earlier))):
            n = 0
            while i + n < len(later) and j + n < len(earlier) and later[i + n] == earlier[j + n]:
                n += 1
            if sum(words[i : i + n]) >= 10:
                gone |= set(range(i, i + n))
        assert line_dedup.common_blocks(earlier, later, words, 10) == sorted(gone)


def test_repeated_lines_take_linear_time():
    """A long line 200,000 times, alone and between own lines."""
    begin = time.perf_counter()
    n = 200_000
    assert line_dedup.common_blocks([7], [7] * n, [12] * n, 10) == list(range(n))
    later = [x for k in range(n) for x in (7, 100 + k)]
    assert line_dedup.common_blocks([7, 8, 7], later, [12] * (2 * n), 10) == list(range(0, 2 * n, 2))
    assert line_dedup.common_blocks([7] * n, later, [12] * (2 * n), 10) == list(range(0, 2 * n, 2))
    assert time.perf_counter() - begin < 30


def test_patience_is_increasing_and_equal():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(15))] for _ in "ab")
        matched = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in matched)
        assert all(x < y and u < v for (x, u), (y, v) in itertools.pairwise(matched))


def test_first_copy_stays_and_moved_blocks_go(spark):
    line = [f"{w} one two three four five six seven eight nine ten" for w in ("a", "b", "c", "d")]
    docs = [(1, "\n".join(line)), (2, "\n".join([line[3], "own", line[0], line[0]])), (3, "own\n\nshort")]
    got = {r["doc_id"]: (r["text"], r["overlaps"]) for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: ("\n".join(line), []), 2: ("own", [1]), 3: ("own\n\nshort", [])}


# ---- 2 mixing


def targets_by_turns(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def test_mixing_targets(spark):
    rng = random.Random(3)
    for _ in range(6):
        sizes = {s: rng.randrange(1, 10 ** rng.randint(1, 5)) for s in [*"ABCDEFGé"[: rng.randint(1, 8)], None]}
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
        want = targets_by_turns(sizes)
        assert got == {s: pytest.approx(t, rel=1e-9) for s, t in want.items()}


def test_mixing_takes(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == [d[0] for d in documents]
    size = {d[0]: len(WORDS.findall(d[1])) for d in documents}
    by_source = {}
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        assert all(0 <= t["position"] <= 1 and 0 < t["words"] <= r["size"] for t in r["takes"])
        by_source.setdefault(r["source"], []).append(r)
    for source in by_source.values():
        assert sum(r["taken"] for r in source) == round(source[0]["target"])
    assert rows and sorted(mixing.mix(docs.repartition(3)).collect(), key=str) == sorted(rows, key=str)


def test_mixing_schedules(spark):
    """Half of a source's words stand before the time at which its schedule has half its area."""
    docs = spark.createDataFrame([(k, "w " * 10, "abc"[k % 3]) for k in range(3000)], "doc_id long, text string, source string")
    takes = mixing.in_training_order(mixing.mix(docs)).collect()
    assert [t["position"] for t in takes] == sorted(t["position"] for t in takes)
    for n, source in enumerate("abc"):
        got = sorted(t["position"] for t in takes if t["source"] == source)
        knots = np.array(mixing.SCHEDULES[n])
        time = np.linspace(0, 1, 20_001)
        area = np.cumsum(np.interp(time, *knots.T))
        want = np.interp((np.arange(len(got)) + 0.5) / len(got), area / area[-1], time)
        assert np.abs(np.array(got) - want).max() < 2e-3


def test_equal_rows_are_dealt_like_others(spark):
    # 6000 equal rows without an id, in several tasks, among 200 others
    equal = spark.range(0, 6000, 1, 5).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit("one two three").alias("text"))
    others = spark.range(200).select("id", F.lit("a"), F.concat(F.lit("text "), F.col("id").cast("string")))
    docs = equal.union(others)
    rows = mixing.mix(docs).collect()
    assert len(rows) == 6200 and sum(r["taken"] for r in rows) == round(rows[0]["target"])
    # others lie among the equal rows, not on both sides of a block of them
    order = sorted(rows, key=lambda r: r["takes"][0]["position"])
    places = [k for k, r in enumerate(order) if r["doc_id"] is not None]
    assert max(np.diff([0, *places, 6200])) < 600
    numbered = mixing._numbered(docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("tag")))
    assert sorted(r["number"] for r in numbered.filter("doc_id is null").collect()) == list(range(6000))
    mixed = mixing.mixed_documents(docs)
    want = sum(t["words"] * 2 >= r["size"] for r in rows for t in r["takes"])
    assert mixed.count() == want and mixed.columns == ["doc_id", "source", "text"]
    # no array of a key's positions
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan


def test_mixed_documents_are_the_takes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.union(docs.filter("doc_id < 5"))
    takes = [(r["doc_id"]) for r in mixing.in_training_order(mixing.mix(docs)).collect() if r["words"] * 2 >= r["size"]]
    assert sorted(r["doc_id"] for r in mixing.mixed_documents(docs).collect()) == sorted(takes)


# ---- 3 and 9 ids


ODD = ["", " ", "  a  b", "a   b \n c\n\n d ", "\ta\t b", "<|endoftext|> hi<|endoftext|>", "it's I'll  we've", "\x1ca \x1cb", "é ́x", "ΣΑΣ ΣΣ", "日本 語です", "İstanbul ŉ"]


@pytest.mark.parametrize("name", [queries.BYTE_TOKENIZER, queries.WORD_TOKENIZER])
def test_encoder_equals_the_library(name, documents):
    mine = encoder(public_tokenizers.path(name))
    theirs = Tokenizer.from_file(public_tokenizers.path(name))
    theirs.encode_special_tokens = True
    rng = random.Random(4)
    signs = ["a", "B", "'s", " ", "  ", "\n", "\t", "1", "é", "É", "ŉ", "İ", "$", "!!", "_", "\x85", "\x1d", ".", "日", "́", " the", "Word"]
    texts = ODD + ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)] + [d[1] for d in documents]
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert ids.tolist() == plain_ids(theirs, text), repr(text[:100])


@pytest.mark.parametrize("name", [queries.BYTE_TOKENIZER, queries.WORD_TOKENIZER])
def test_encoded_columns_equal_the_library(name, documents, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 400)  # pieces are forgotten and met again
    monkeypatch.setattr(tokens, "KEPT_BYTES", 12)
    mine = tokens.Encoder(public_tokenizers.path(name))
    theirs = Tokenizer.from_file(public_tokenizers.path(name))
    theirs.encode_special_tokens = True
    rng = random.Random(6)
    white = [*map(chr, (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]
    other = ["\x00", "\x1c", "\x1d", "\x1f", "\u180e", "\u200b", "\ufeff", "a", "The", "'s", "é", "End.", "$$", "7", "日本", "<|endoftext|>"]
    signs = [" ", " ", " ", "\n", "\n", *rng.sample(white, 9), *other]
    odd = ["".join(rng.choices(rng.choice([white, signs, [" ", *other], [" ", "\n", *other]]), k=rng.randrange(30))) for _ in range(4000)]
    columns = [odd[at : at + 500] for at in range(0, len(odd), 500)]
    for column in (*columns, [d[1] for d in documents], [None, *ODD], ["\x1e a", "b\x1e c"], [None], [], *columns):
        ids, lengths = mine.encode_column(pa.array(column, pa.string()))
        want = [plain_ids(theirs, t or "") for t in column]
        assert lengths.tolist() == [*map(len, want)]
        assert ids.tolist() == [*itertools.chain.from_iterable(want)]
    assert len(mine.pieces.keys) <= 400


def test_encoded_columns_merge_a_word_once():
    mine, merged = tokens.Encoder(public_tokenizers.path(queries.BYTE_TOKENIZER)), []
    plain = mine.merge
    mine.merge = lambda word: merged.append(word) or plain(word)
    words = [f"{a}{b}ndre" for a in "bcdfghklmn" for b in "aeiou"]
    texts = ["".join(f"{a}.\n{b} " for b in words) + a for a in words]
    for _ in range(2):
        mine.encode_column(pa.array(texts))
    assert len(merged) <= 5 * len(words)  # first, behind a space, behind a line break, with a stop or without; not per pair


def test_gathered_batches_keep_all_rows():
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(["x" * n] * k, pa.string())}) for n, k in ((10, 3), (5, 0), (900, 1), (10, 30), (10, 2))]
    got = [*gathered(iter(batches), 500)]
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches(batches).combine_chunks())
    assert [b.num_rows for b in got] == [3, 1, 32]
    assert [*gathered(iter(()), 500)] == []


def test_packed_blocks_round_trip():
    rng = np.random.default_rng(5)
    for width in (1, 5, 15, 16, 17, 24, 31, 32):
        pieces = [(k or None, 0, rng.integers(0, 2**width, n, dtype=np.uint64).astype(np.uint32), True) for k, n in enumerate((0, 1, 700, 64, 3))]
        content = packed_ids.write_segment(pieces, width, 64) + b"\n"
        (segment,) = packed_ids.segments(content)
        ids = np.concatenate([p[2] for p in pieces])
        assert segment.ids(0, len(ids)).tolist() == ids.tolist()
        assert segment.ids(130, 77).tolist() == ids[130:207].tolist()
        assert segment.pieces["flags"].tolist() == [3, 2, 2, 2, 2]
        assert len(segment.payload.to_bytes(8, "little")) == 8 and segment.end - segment.payload == sum(-(-min(64, len(ids) - a) * width // 8) for a in range(0, len(ids), 64))


def test_packed_ids_against_the_library(spark, documents, monkeypatch):
    monkeypatch.setattr(packed_ids, "SEGMENT_IDS", 1000)  # documents go over segments
    theirs = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_TOKENIZER))
    start, want = 0, []
    for doc_id, text, *_ in documents:
        ids = np.array([*plain_ids(theirs, text), queries.BYTE_END], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in queries.op3_packed_ids(spark, SMALL).orderBy("doc_id").collect()]
    assert got == want


def test_packing_against_the_library(spark, documents):
    theirs = Tokenizer.from_file(public_tokenizers.path(queries.WORD_TOKENIZER))
    ids = {d: np.array([*plain_ids(theirs, t), queries.WORD_END], "<u4") for d, t, *_ in documents}
    rows = queries.op9_sum_of_squares_packing(spark, SMALL).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
    for doc_id, parts in by_doc.items():
        ends = [0, *itertools.accumulate(r["length"] for r in sorted(parts, key=lambda r: r["start"]))]
        assert [r["start"] for r in sorted(parts, key=lambda r: r["start"])] == ends[:-1] and ends[-1] == len(ids[doc_id])
    for parts in by_sequence.values():
        ends = [0, *itertools.accumulate(r["length"] for r in sorted(parts, key=lambda r: r["offset"]))]
        assert [r["offset"] for r in sorted(parts, key=lambda r: r["offset"])] == ends[:-1]
        assert ends[-1] <= 4096 and ends[-1] & (ends[-1] - 1) == 0
    assert set(by_doc) == set(ids)


def test_level_is_the_least_sum_of_squares():
    rng = random.Random(6)
    packer = ss_packing.Packer(24, max_open=50)
    for k in range(500):
        size = rng.randrange(1, 24)
        levels = packer.levels.copy()

        def squares(level, levels=levels, size=size):
            after = levels.copy()
            if level:
                after[level] -= 1
            if level + size < 24:
                after[level + size] += 1
            return (after**2).sum()

        options = [0, *(h for h in range(1, 24) if levels[h] and h + size <= 24)]
        assert squares(packer.level_for(size)) == min(map(squares, options))
        packer.add(k, np.arange(size, dtype=np.uint32))
    packer.finish()
    pieces = [p for s in packer.closed for p in s]
    assert sum(len(p[2]) for p in pieces) == sum({p[0]: p[3] for p in pieces}.values())


def test_sequences_go_out_in_bounded_batches():
    packer = ss_packing.Packer()
    for k in range(2000):
        packer.add(k, np.full(2100, k, np.uint32))  # no two fit a window: all stay open
    assert packer.n_open == 2000
    packer.finish()
    pieces = {(p[0], p[1], len(p[2])) for s in packer.closed for p in s}
    sequences = len(packer.closed)
    batches = list(ss_packing._batches(packer.closed, 7))
    assert max(b.nbytes for b in batches) < 2 * ss_packing.OUT_SEQUENCES * 4 * ss_packing.WINDOW
    rows = [r for b in batches for r in b.to_pylist()]
    assert {(r["doc_id"], r["start"], r["length"]) for r in rows} == pieces and len(rows) == len(pieces)
    assert sorted({r["sequence_id"] for r in rows}) == list(range(7, 7 + sequences)) and not packer.closed


def test_steps_of_packing_change_no_row(spark):
    texts = [(k, " ".join(["word", "other", str(k)] * (k % 50))) for k in range(300)] + [(None, None), (7, "again")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path(queries.WORD_TOKENIZER)
    found = [ss_packing.pack(docs, path, 2, step_bytes=n).collect() for n in (1, 4_000_000)]
    assert found[0] == found[1] and len(found[0]) >= 302


# ---- 4 quality rules


def test_base_counts_by_force():
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choices(["a", "bé", "c#", "|", " ", " ", "\n", "\t", "\x85", "日"], k=rng.randrange(60)))
        words = WORDS.findall(text)
        triples = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        covered = {k + s for k, t in enumerate(triples) if triples.count(t) > 1 for s in range(3)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:k] for k, x in enumerate(lines)), len(covered))
        data = text.encode()
        assert divergence.base_counts(data, data.split()) == want
        assert divergence.class_counts(data).sum() == len(text)


def test_common_words_are_exact(spark, documents):
    refs = divergence.references(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5))
    for lang in {d[2] for d in documents}:
        words = [w for d in documents if d[2] == lang for w in d[1].encode().lower().split()]
        counts = {w: words.count(w) for w in set(words)}
        assert set(refs[lang].places) == {w for w, n in counts.items() if n >= len(words) * divergence.COMMON_SHARE}
        assert all(refs[lang].words[k] == pytest.approx(counts[w] / len(words)) for w, k in refs[lang].places.items())


def test_rules_keep_good_and_drop_bad(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = queries.op4_divergence_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("not base_failed")
    rows = judged.select("quality", "kept").collect()
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1]) > 0.99
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) < 0.1


def test_common_words_of_the_later_half(spark):
    # 20 texts of 200,100 different words in one task; the last ten have one word 430 times each
    ids = F.sequence(F.col("id") * 200_100, F.col("id") * 200_100 + 200_099)
    late = F.when(F.col("id") >= 10, F.repeat(F.lit(" late"), 430)).otherwise("")
    texts = F.concat(F.array_join(F.transform(ids, lambda x: x.cast("string")), " "), late)
    refs = divergence.references(spark.range(0, 20, 1, 1).select(F.lit("xx").alias("lang"), texts.alias("text")))
    assert set(refs["xx"].places) == {b"late"} and refs["xx"].words[0] == pytest.approx(4300 / refs["xx"].n_words)


def test_rare_languages_have_references_of_their_own(spark):
    rng = random.Random(4)

    def words(letters):
        return ["".join(rng.choices(letters, k=rng.randint(3, 7))) for _ in range(40)]

    def text(vocabulary, capitals=0.0):
        return "".join(c.upper() if rng.random() < capitals else c for c in " ".join(rng.choices(vocabulary, k=200)))

    hot, caps, rare, tiny = words("abcdefghij"), words("klmnopq"), words("789+=/"), words("012<>&")
    filler = " ".join(rng.choices(hot, k=80_000))
    many = spark.range(90).select((F.col("id") + 10_000).alias("doc_id"), F.lit("hot").alias("lang"), F.lit(filler).alias("text"))
    rows = [(k, "caps", text(caps, 0.24)) for k in range(1000, 1300)] + [(k, "rare", text(rare)) for k in range(30)]
    rows += [(100, "tiny", text(tiny)), (101, "rare", text(hot)), (102, None, text(hot, 0.145)), (103, None, text(tiny))]
    few = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    refs = divergence.references(many.union(few))
    assert set(refs) == {"hot", "caps", "rare"}
    judged = {r["doc_id"]: r for r in divergence.judge(few, refs).collect()}
    assert all(judged[k]["kept"] for k in range(30)) and not judged[101]["kept"]
    assert judged[100]["kept"] and judged[100]["char_distance"] is None
    # by classes the nearest is caps, by both it is hot
    classes = divergence.class_counts(rows[-2][2].encode())
    assert divergence.js_distance(classes, refs["caps"].classes) < divergence.js_distance(classes, refs["hot"].classes)
    assert judged[102]["kept"] and not judged[103]["kept"]


# ---- 5 near duplicates


def sets_by_force(text, size):
    words = WORDS.findall(text.translate({k: k + 32 for k in range(65, 91)}))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def components_by_force(sets, percent):
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d in sets}


def copies(rng, n):
    """Documents in groups of near copies, some of which are linked only over others."""
    out, vocabulary = [], [f"w{k}" for k in range(400)]
    for _ in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.choice([1, 1, 2, 8])):
            out.append(" ".join(text))
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
    rng.shuffle(out)
    return [*out, "", "Common", "common  ", "a b"]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_all_pairs(spark, size):
    texts = copies(random.Random(size), 120)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sets = {k: sets_by_force(t, size) for k, t in enumerate(texts)}
    want = components_by_force(sets, 80)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, size).collect()}
    assert got == {k: (len(sets[k]), want[k], want[k] == k) for k in sets}


def test_large_group_around_no_hub(spark):
    """Copies that drift: neighbours are linked, the ends are far from each other and from any hub."""
    rng = random.Random(9)
    text, texts = [f"w{k}" for k in range(200)], []
    for _ in range(120):
        texts.append(" ".join(text))
        for _ in range(3):
            text[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
    docs = spark.createDataFrame([(1000 - k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    want = components_by_force({1000 - k: sets_by_force(t, 2) for k, t in enumerate(texts)}, 80)
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()} == want


def test_components(spark):
    rng = random.Random(10)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 480)] + [(500, 500), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


# ---- 6 neighbours


def test_search_recall(spark):
    found = queries.op6_multiprobe_search(spark, "/root/testdata/sf0.01").collect()
    rows = duckdb.sql("select vec_id, embedding from read_parquet('/root/testdata/sf0.01/embeddings.parquet')").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    hits = []
    for query in ids[ids % 20 == 0]:
        score = (x * x[ids == query]).sum(1)
        best = [k for k in np.lexsort((ids, -score)) if ids[k] != query][:20]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        assert [g[0] for g in got] == list(range(1, 21))
        assert [g[1:] for g in got] == sorted((g[1:] for g in got), key=lambda g: (-g[1], g[0]))
        assert all(score[ids == g[1]][0] == pytest.approx(g[2], abs=1e-12) for g in got)
        hits.append(len(set(ids[best]) & {g[1] for g in got}) / 20)
    assert np.mean(hits) >= 0.9


def test_search_with_many_equal_vectors(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 8))
    x[100:300] = x[100]
    rows = [(int(k), [float(v) for v in vector]) for k, vector in enumerate(x)]
    found = pstable.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 20).collect()
    for query in (100, 120, 300):
        got = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == query]
        assert len(got) == 20
        if query < 300:
            assert got == [k for k in range(100, 300) if k != query][:20]


def test_search_in_waves_and_by_length(spark, monkeypatch):
    """Small shards, so that later waves meet bounds; two lengths, one of them with fewer rows than answers."""
    monkeypatch.setattr(pstable, "SHARD_ROWS", 32)
    monkeypatch.setattr(pstable, "QUERY_ROWS", 7)
    rng = np.random.default_rng(12)
    x = rng.integers(-2, 3, size=(700, 6)).astype(float)  # many ties
    x[:, 0] = 1
    rows = [(k, [float(v) for v in vector]) for k, vector in enumerate(x)] + [(1000 + k, [1.0, float(k)]) for k in range(0, 60, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = pstable.nearest(frame, 20, 20).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by_query) == {k for k, _ in rows if k % 20 == 0}
    hits = []
    for query, got in by_query.items():
        own = dict(rows)[query]
        all_scores = {k: float(np.dot(own, v)) for k, v in rows if k != query and len(v) == len(own)}
        best = sorted(all_scores, key=lambda k: (-all_scores[k], k))[:20]
        assert len(got) == len(best) and all(all_scores[k] == s for k, s in got)
        if len(own) == 2:
            assert [k for k, _ in got] == best
        hits.append(len(set(best) & {k for k, _ in got}) / len(best))
    assert np.mean(hits) >= 0.5  # a shard of 32 rows has the fewest cells


def test_waves_lose_nothing(spark):
    """All rows compared, in shards and waves: the answers of brute force, ties to the smaller id."""
    rng = np.random.default_rng(13)
    x = rng.integers(-1, 2, size=(300, 5)).astype(float)
    data = [v.astype("<f8").tobytes() for v in x]
    index = spark.createDataFrame([(5, k % 11, k, bytearray(v)) for k, v in enumerate(data)], "dims int, shard int, vec_id long, vector binary")
    asked = spark.createDataFrame(
        [(5, k, bytearray(data[k]), 11, 30, 3.0) for k in range(0, 300, 10)],
        "dims int, query_id long, vector binary, shards int, shard_rows long, norm double",
    )
    found = {}
    for r in pstable._searched(asked, index, 4, whole=True).collect():
        found.setdefault(r["query_id"], set()).add((r["vec_id"], r["score"]))
    for query in range(0, 300, 10):
        score = x @ x[query]
        best = [k for k in np.lexsort((np.arange(300), -score)) if k != query][:4]
        assert found[query] == {(k, score[k]) for k in best}


def test_probe_order_is_by_expected_cost():
    order = pstable.probe_order(6, 200)
    assert order[0] == () and len(set(order)) == len(order) == 200
    assert all(len({min(p, 11 - p) for p in places}) == len(places) for places in order)


# ---- 7 toxicity


def test_maximal_segments_by_force():
    """A maximal segment is one that no larger one contains and whose every proper part scores less from either end."""
    rng = random.Random(12)

    def by_force(x):
        def total(i, j):
            return sum(x[i:j])

        out, todo = [], [(0, len(x))]
        while todo:
            i, j = todo.pop()
            best = max(((total(a, b), -(b - a), -a, a, b) for a in range(i, j) for b in range(a + 1, j + 1)), default=(0,))
            if best[0] > 0:
                out.append((best[3], best[4], best[0]))
                todo += [(i, best[3]), (best[4], j)]
        return sorted(out)

    for _ in range(300):
        x = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() / 7 for _ in range(rng.randrange(14))]
        got = toxicity.maximal_segments(x)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in by_force(x)]
        assert all(s == pytest.approx(sum(x[a:b])) for a, b, s in got)


def test_every_toxic_passage_is_found(spark):
    toxic = ["".join(x) + "zzz" for x in itertools.product("abc", "def", "gh")][:14]
    model = toxicity.ToxicityModel({w: 3.0 for w in toxic}, 1.0, 0.05, 1.0, -3.0)
    quiet = ["plain"] * 400
    scattered = [w for x in toxic for w in (x, *quiet[:60])]
    texts = {0: scattered, 1: scattered + toxic, 2: toxic + quiet + toxic, 3: toxic[:1] * 400, 4: (toxic + quiet[:20]) * 3}
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    places = {k: [(p["first"], p["end"]) for p in r["passages"]] for k, r in got.items()}
    n = len(scattered)
    assert places[0] == [] and places[1] == [(n, n + 14)] and places[2] == [(0, 14), (414, 428)]
    # one word again and again says nothing new; copies with little between them are one passage, to the end of the last
    assert places[3] == [] and places[4] == [(0, 82)]
    assert got[1]["score"] > 0.9 > 0.1 > got[0]["score"] and got[2]["n_segments"] == 2


def test_toxicity_held_out(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet").filter("toxic is not null")
    rows = queries.op7_toxic_segments(spark, path).join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean([r["predicted"] for r in toxic]) > 0.85 and np.mean([r["predicted"] for r in clean]) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


# ---- 8 language


def test_language_held_out(spark):
    path = "/root/testdata/sf0.01"
    found = queries.op8_ecoc_language(spark, path).join(spark.read.parquet(f"{path}/documents.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 8, 20, 60):
        code = ecoc.codewords(n).astype(int)
        apart = (code.shape[1] - code @ code.T) // 2 + 1000 * np.eye(n, dtype=int)
        assert apart.min() >= max(1, code.shape[1] // 5)


def test_trigrams_by_force(monkeypatch):
    monkeypatch.setattr(ecoc, "_PART", 64)  # texts go over parts
    texts = ["", "Ab, cd!", "é ü " * 30, "x", "The quick  brown\nfox 12 jumps" * 5]
    for text, got in zip(texts, ecoc.trigram_counts(texts), strict=True):
        data = re.sub(rb"  +", b" ", b" " + text.lower().encode().translate(ecoc._TABLE) + b" ")
        want = np.zeros(ecoc.DIMENSIONS)
        for k in range(len(data) - 2):
            a, b, c = (int(x) for x in data[k : k + 3])
            want[(a * int(ecoc._A) + b * int(ecoc._B) + c * int(ecoc._C)) % 2**32 >> 20] += 1
        assert (got == want).all()


# ---- 10 personal data


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_by_force(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and crf_pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if ok[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_by_force():
    rng = random.Random(13)
    signs = ["a", "b.", "@", "@c.d", "1", "25", "4111111111111111", "4111 1111 1111 1111", "-", " ", ".", "+", "+1 (", ")", "_", "255", "256", "1.2.3.4", "é", "\n"]
    for _ in range(6000):
        text = "".join(rng.choices(signs, k=rng.randrange(25)))
        assert sorted(crf_pii.base_spans(text)) == sorted(spans_by_force(text)), repr(text)


def test_field_on_other_values():
    field = crf_pii.default_field()
    table = crf_pii.labelled_table(99)
    texts = [t for t, _ in table]
    base = [crf_pii.base_spans(t) for t in texts]
    got = [sorted(b + m) for b, m in zip(base, crf_pii.added_spans(texts, base, field), strict=True)]
    assert np.mean([g == sorted(s) for g, (_, s) in zip(got, table, strict=True)]) > 0.97


def test_viterbi_by_force():
    rng = np.random.default_rng(14)
    n = len(crf_pii.LABELS)
    transitions = rng.normal(size=(n, n)) + crf_pii._BLOCKED
    lengths = np.array([1, 2, 3, 3])
    emissions = rng.normal(size=(4, 3, n))
    for k, found in enumerate(crf_pii.viterbi(emissions, lengths, transitions)):
        def worth(labels, k=k):
            total = crf_pii._START[labels[0]] + emissions[k, 0, labels[0]]
            return total + sum(transitions[a, b] + emissions[k, t, b] for t, (a, b) in enumerate(itertools.pairwise(labels), 1))

        assert tuple(found[: lengths[k]]) == max(itertools.product(range(n), repeat=int(lengths[k])), key=worth)


def test_long_windows_are_decoded_in_pieces(monkeypatch):
    field = crf_pii.default_field()
    rng = random.Random(10)
    values = [t for t, spans in crf_pii.labelled_table(5) if spans]
    text = " ".join(rng.choice(values) if rng.random() < 0.2 else str(rng.randrange(10**6)) for _ in range(4000))
    words = [w for window in crf_pii.windows(text) for w in window]
    cores = [crf_pii.core(text, *w) for w in words]
    whole = field.tags([crf_pii.features([text[a:b] for a, b in cores])])[0].tolist()
    base = crf_pii.base_spans(text)
    want = crf_pii.added_spans([text], [base], field)
    assert want[0]
    for piece in (1, 2, 7, 500):
        monkeypatch.setattr(crf_pii, "PIECE_WORDS", piece)
        assert list(crf_pii.decoded(text, cores, field)) == list(zip(cores, whole, strict=True))
        assert crf_pii.added_spans([text], [base], field) == want


def test_memory_of_a_long_table_of_numbers():
    # a million numbers, in a process of its own: features of all words at once were gigabytes
    code = """
import random, resource
from pitchflow.llm import crf_pii
field, rng = crf_pii.default_field(), random.Random(3)
text = " ".join(str(rng.randrange(1000)) for _ in range(1_000_000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
crf_pii.added_spans([text], [crf_pii.base_spans(text)], field)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=Path(crf_pii.__file__).parents[2])
    assert int(ran.stdout) < 300, ran.stderr


def test_windows_hold_every_telling_word():
    rng = random.Random(15)
    for _ in range(500):
        text = "".join(rng.choices(["word", "1", " ", "  ", "\n", "a@b", "(at)", "dot"], k=rng.randrange(60)))
        places = [p for w in crf_pii.windows(text) for p in w]
        assert places == sorted(set(places)) and all(not re.search(r"\s", text[a:b]) for a, b in places)
        words = [m.span() for m in re.finditer(r"\S+", text)]
        telling = [k for k, (a, b) in enumerate(words) if crf_pii._TELLING.search(text[a:b])]
        near = {words[k] for t in telling for k in range(max(0, t - 3), min(len(words), t + 4))}
        assert near <= set(places) <= set(words)


# ---- pipeline


def test_pipeline_stages_by_force(spark, documents):
    path = SMALL
    docs = spark.read.parquet(f"{path}/documents.parquet").cache()
    spoken = corpus_pipeline.language(spark, docs, path)
    assert {r["doc_id"] for r in spoken.collect()} == {d for d, t, *_ in documents if re.search(r"[^\W\d_]", t)}
    near = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, path).collect()}
    want = components_by_force({d: sets_by_force(t, 5) for d, t, *_ in documents}, 80)
    assert near == {d for d, root in want.items() if d == root}
    lines = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, path).collect()}
    seen = set()
    for doc_id, text, *_ in documents:
        long_lines = {x.strip() for x in text.split("\n") if len(x.split()) >= 10}
        assert not [x for x in lines.get(doc_id, "").split("\n") if x.strip() in seen & long_lines]
        seen |= long_lines
    assert corpus_pipeline.run(spark, path).agg(F.sum("length")).first()[0] > 0


def test_lines_are_cut_once(spark):
    long_line = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"{long_line}\nfirst"), (2, f"{long_line}\nsecond"), (3, long_line), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.lines(spark, docs, "")
    # each time it runs in a task is a Python worker that the executor keeps for the stages behind
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, out.collect())) == [(1, f"{long_line}\nfirst"), (2, "second"), (4, None), (5, "")]


# ---- 12 prefix token counts

PIECES = ["a", "b", "the", " ", "  ", "\n", "▁", "é", "日", "²", "\x1f", "\x00", "<s>", " t", "ing", "  \n", "0", "..", "𝒳", "ß", "\t", "е", " с"]


@pytest.fixture(scope="module")
def piece_model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_TOKENIZER))


def test_every_prefix_has_its_exact_count(documents, piece_model, monkeypatch):
    counts = prefix_tokens.PrefixCounter(public_tokenizers.path(queries.PIECE_TOKENIZER))
    rng = random.Random(3)
    texts = [t[:600] for _, t, _, _ in documents[::25]] + ["x" * 300, "é" * 120, " " * 40, "", "\n"]
    texts += ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    for step in (2_000_000, 7):  # 7: texts are cut where a chunk begins
        monkeypatch.setattr(prefix_tokens, "STEP_CHARS", step)
        for text, found in zip(texts, counts.prefix_counts(texts), strict=True):
            assert found.tolist() == [len(piece_model.encode(text[:k])) for k in range(len(text) + 1)], text


def test_pairs_of_pieces_go_together_as_the_library_has_it(piece_model):
    counts = prefix_tokens.PrefixCounter(public_tokenizers.path(queries.PIECE_TOKENIZER))
    rng = random.Random(4)
    starts = [k for k, p in enumerate(counts.pieces) if p.startswith("▁") and p.strip("▁")]
    for _ in range(4000):
        a, b = rng.choice(starts), rng.randrange(len(counts.pieces))
        text = (counts.pieces[a] + counts.pieces[b])[1:]
        want = piece_model.encode(text.replace("▁", " "), out_type=str) == [counts.pieces[a], counts.pieces[b]]
        assert counts.pair_goes(a, b) == want, text


def test_token_counts_and_budgets(spark, documents, piece_model):
    found = {r["doc_id"]: r for r in queries.op12_prefix_token_counts(spark, SMALL).collect()}
    for doc_id, text, _, _ in documents:
        n = len(piece_model.encode(text))
        assert tuple(found[doc_id])[:4] == (doc_id, len(text.encode()), n, n > 4096)
        assert found[doc_id]["fit_chars"] == (len(text) if n <= 4096 else found[doc_id]["fit_chars"])
    docs = spark.createDataFrame([(d, t[:700]) for d, t, _, _ in documents[:8]], "doc_id long, text string")
    counted = prefix_tokens.with_prefix_counts(docs, public_tokenizers.path(queries.PIECE_TOKENIZER), 10)
    texts = {d: t[:700] for d, t, _, _ in documents}
    for budget, rows in ((10, counted), (57, prefix_tokens.fit_budget(counted, 57)), (0, prefix_tokens.fit_budget(counted, 0))):
        for r in rows.collect():
            text = texts[r["doc_id"]]
            fitting = [k for k in range(len(text) + 1) if len(piece_model.encode(text[:k])) <= budget]
            assert r["fit_chars"] == fitting[-1], (budget, r["doc_id"])


# ---- 13 divergence audit


def test_skyband_holds_what_fewer_than_k_dominate():
    rng = random.Random(5)
    for k, high in ((1, 4), (3, 8), (10, 60)):
        terms = rng.sample([f"{a}{b}".encode() for a in "abcdéz" for b in range(200)], 700)
        points = np.array([(n := rng.randint(1, high), n + rng.randint(0, high)) for _ in terms])
        want = {
            x for x in range(len(terms))
            if sum(points[y, 0] >= points[x, 0] and points[y, 1] <= points[x, 1] and terms[y] < terms[x] for y in range(len(terms))) < k
        }
        assert set(skyband.skyband(points, terms, k).tolist()) == want


def audit_by_force(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall("[A-Za-z\u0080-\U0010ffff]+", text or "")) for _, text, lang, source in rows]
    out = set()
    for lang in {x[0] for x in docs}:
        mine = [(s, [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in ws]) for x, s, ws in docs if x == lang]
        held = [t for t in {w for _, ws in mine for w in ws} if sum(t in ws for _, ws in mine) >= min_docs]
        n = {s: {t: sum(ws.count(t) for x, ws in mine if x == s) for t in held} for s in {x for x, _ in mine}}
        whole = {t: sum(n[s][t] for s in n) for t in held}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(held)) for t in held} for s, c in n.items()}
        q = {t: 1 + 10**9 * (whole[t] + 2) // (sum(whole.values()) + 2 * len(held)) for t in held}
        for s in n:
            f = lambda a, b: (a - b) ** 2 // (a + b)
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in held), o.encode()) for o in n if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in held if n[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)}
    return out


def test_audit_against_force(spark, documents):
    rng = random.Random(6)
    rows = [(d, "".join(c if rng.random() > 0.1 else "É" for c in t[:300]), lang, s) for d, t, lang, s in documents]
    rows += [(1, "Zzz zzz ÀZz", None, None), (1, None, "de", "only"), (None, "", "xx", "a"), (None, "a a", "xx", "b"), (7, "no", "yy", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS n", "2 AS place", "3 AS term")
    want = audit_by_force([r[:4] for r in rows], 4, 3)
    found = [tuple(r) for r in skyband.audit(docs, 4, 3).collect()]
    assert set(found) == want and len(found) == len(want)
    # sources in tiles of three, terms in many shares
    counts = skyband.term_counts(docs.selectExpr("coalesce(lang, '') AS lang", "coalesce(source, '') AS source", "text"), 4)
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.count("*").alias("kept_rows"))
    terms = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("n_terms"))
    groups = sums.join(terms, "lang")
    pairs = {tuple(r) for r in skyband.source_pairs(counts, groups, 3, 40).collect()}
    known = {(r["lang"], r["source"]) for r in groups.collect()}
    assert pairs == {(lang, s, item, v) for lang, s, part, item, v, _ in want if part == "pair" and (lang, s) in known and (lang, item) in known}


# ---- 11 periodic runs


def runs_by_force(words):
    """Every maximal stretch of a period, smallest periods first."""
    out = {}
    for q in range(1, len(words) // 4 + 1):
        same = [words[k] == words[k + q] for k in range(len(words) - q)]
        at = 0
        for equal, group in itertools.groupby(same):
            end = at + len(list(group))
            if equal and end + q - at >= max(6, 4 * q):
                out.setdefault((at, end + q), q)
            at = end
    return sorted((b, e, q) for (b, e), q in out.items())


def repeating(rng, n, letters):
    words = []
    while len(words) < n:
        kind = rng.random()
        if kind < 0.4 or not words:
            words += [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        elif kind < 0.8:
            stretch = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 13, 16, 17, 31, 33, 40]))]
            words += (stretch * rng.randint(1, 9))[rng.randrange(3) :]
        else:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randint(1, 60)] * rng.randint(1, 6)
    return words[:n]


def test_runs_against_all_periods():
    rng = random.Random(7)
    for _ in range(150):
        sequences = [repeating(rng, rng.randint(0, 400), rng.choice([1, 2, 3, 10, 100])) for _ in range(rng.randint(1, 6))]
        found = sync_runs.runs_of_texts([np.array(s, np.int64) for s in sequences])
        for words, runs in zip(sequences, found, strict=True):
            assert [(b, e, q) for b, e, q in map(tuple, runs.tolist())] == [r for r in runs_by_force(words) if r[1] - r[0] >= 6]


@pytest.mark.parametrize("words", [[0] * 300_000, list(range(100_000)) * 4, ([0] * 50 + [1]) * 5_000, [0] * 99_999 + [1] + [0] * 99_999])
def test_long_texts_of_runs(words):
    runs = sync_runs.find_runs(np.array(words, np.int64))
    assert (len(words) == 255_000 and len(runs) == 5_001) or len(runs) in (1, 2)
    for begin, end, q in runs[:50].tolist():
        assert words[begin : end - q] == words[begin + q : end] and end - begin >= 4 * q


def test_run_query_against_force(spark, documents, tmp_path):
    rng = random.Random(8)
    rows = [(d, t[:1500]) for d, t, _, _ in documents]
    rows += [(1000 + k, " ".join("abcdefgh"[w] for w in repeating(rng, 200, 8)).replace(" ", rng.choice(["\n", "  ", "\x0b"]))) for k in range(120)]
    rows += [(5000, None), (5001, ""), (5002, "a a a a a"), (5003, "a a a a a a"), (None, "b " * 40), (5003, "a a a a a a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = []
    planted = 0
    for doc_id, text in rows:
        words = WORDS.findall(text or "")
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            planted += 1
            g, whole = h // 10, list(words)
            a = g % len(whole)
            p = 1 + (len(whole) - a) // (3 + g % 8)
            words = [whole[i] if i < a else whole[a + (i - a) % p] for i in range(len(whole))]
        runs = [r for r in runs_by_force(words) if r[1] - r[0] >= 6]
        best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        numbers = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        listed = "".join(f"{b},{e - b},{q}\n" for b, e, q in runs)
        kept = " ".join(w for k, w in enumerate(words) if not any(b + q <= k < e for b, e, q in runs))
        want.append((doc_id, len(runs), *numbers, sha256(listed.encode()).hexdigest(), sha256(kept.encode()).hexdigest()))
    assert planted > 20 and sorted(found, key=str) == sorted(want, key=str)


# ---- 5, links far from a hub


@pytest.mark.parametrize("block", [400_000, 3_000])
def test_chains_far_from_their_hub_lose_no_link(spark, monkeypatch, block):
    """Variants of one text and chains of edits that lead away from it: every link between two texts joins their components."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    rng = random.Random(31)
    fresh = (f"w{k}" for k in itertools.count())
    base = [next(fresh) for _ in range(200)]

    def edited(words, n=17):
        at = rng.randrange(len(words) - n)
        return words[:at] + [next(fresh) for _ in range(n)] + words[at + n :]

    texts = [base] + [edited(base, rng.randint(3, 30)) for _ in range(250)]
    for _ in range(25):
        step = base
        for _ in range(5):
            step = edited(step)
            texts.append(step)
    sets = [{tuple(x) for x in itertools.pairwise(t)} for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2, 80).collect()}
    assert found == {k: find(k) for k in range(len(texts))}
    assert len(set(found.values())) > 1


# ---- 8, many languages


@pytest.mark.parametrize("languages,known", [(300, 300), (520, 500)])
def test_every_language_is_learned(spark, languages, known):
    rows = [(k * 100 + i, f"word{k} other{k} text of {k} and {i}", f"l{k:03d}") for k in range(languages) for i in range(40 if languages == 300 else 2)]
    rows += [(10**6 + k, f"word{k} once more", f"l{k:03d}") for k in range(known)] + [(None, "no id", "l000"), (7, None, "l000"), (8, "x", None)]
    model = ecoc.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == [f"l{k:03d}" for k in range(known)]


def test_the_nearest_codeword_by_weighted_losses(spark, documents):
    """Decoding by force: of each text the language with the least weighted loss over all bits."""
    labelled = spark.createDataFrame([(d, t, lang) for d, t, lang, _ in documents], "doc_id long, text string, lang string")
    model = ecoc.train(labelled)
    texts = [t for _, t, _, _ in documents[:40] if re.search(r"[^\W\d_]", t)]
    for text, lang in zip(texts, model.decide(texts)[0], strict=True):
        margins = model._margins(ecoc.trigram_counts([text]).astype(np.float32))[0]
        losses = [sum(w * np.exp(-min(max(m * bit, -3), 3)) for m, bit, w in zip(margins, row, weights, strict=True)) for row, weights in zip(model.code, model.weights, strict=True)]
        assert lang == model.languages[int(np.argmin(losses))]
