"""Token ids in files, each id in the fewest bits that hold the vocabulary.

A file is a run of segments, each followed by one newline byte. All numbers are little-endian:

    header    magic "PFI1", width (uint32), documents (uint32), ids per block (uint32), ids (uint64)
    documents per piece of a document: doc_id (int64), ids of the document before the piece (int64),
              ids in the piece (int64), flags (uint8): 1 the doc_id is NULL, 2 the document ends here
    offsets   per block, and one for the end: its byte in the payload (uint64)
    payload   the blocks; in a block id k holds the bits from k * width on, lowest bit first

Blocks have as many ids as the header says but for the last of a segment, so id n of a segment lies in
block n // ids per block; a block is unpacked by itself, without what stands before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pitchflow.llm.common import gathered, small_batches, staged, text_steps
from pitchflow.llm.tokens import encoder

MAGIC = b"PFI1"
HEADER = struct.Struct("<4sIIIQ")
PIECE = np.dtype([("doc_id", "<i8"), ("at", "<i8"), ("n", "<i8"), ("flags", "u1")])
NULL_ID, ENDS = 1, 2
BLOCK_IDS = 4096
#: Ids in a segment; a longer document goes on in the next one.
SEGMENT_IDS = 1 << 20
#: Characters of text for a file, from which the number of files follows.
FILE_CHARS = 32_000_000
#: Bytes of text encoded in one step, unless one text has more.
ENCODED_BYTES = 12_000_000


def bits_for(vocab_size: int) -> int:
    """Fewest bits that hold every id below `vocab_size`."""
    return max(1, (vocab_size - 1).bit_length())


def pack_block(ids: np.ndarray, width: int) -> bytes:
    """Ids (below 2 ** width) as a bit string, lowest bit first, filled up to a whole byte."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids[:, None].astype(np.uint32) >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_block(data: bytes, n: int, width: int) -> np.ndarray:
    """The first n ids of a packed block."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(1, dtype=np.uint32)


def write_segment(pieces: list[tuple[int | None, int, np.ndarray, bool]], width: int, block_ids: int = BLOCK_IDS) -> bytes:
    """Pieces (doc_id, ids of the document before, ids, whether the document ends) as one segment."""
    table = np.zeros(len(pieces), PIECE)
    for row, (doc_id, at, ids, ends) in zip(table, pieces, strict=True):
        row["doc_id"], row["at"], row["n"] = doc_id or 0, at, len(ids)
        row["flags"] = NULL_ID * (doc_id is None) | ENDS * ends
    ids = np.concatenate([p[2] for p in pieces]) if pieces else np.zeros(0, np.uint32)
    blocks = [pack_block(ids[at : at + block_ids], width) for at in range(0, len(ids), block_ids)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return b"".join([HEADER.pack(MAGIC, width, len(pieces), block_ids, len(ids)), table.tobytes(), offsets.tobytes(), *blocks])


class Segment:
    """A segment that begins at a byte of a file's content; ids are unpacked when asked for."""

    def __init__(self, content: memoryview, begin: int = 0):
        magic, self.width, n_pieces, self.block_ids, self.n_ids = HEADER.unpack_from(content, begin)
        if magic != MAGIC:
            raise ValueError("not a segment of packed ids")
        at = begin + HEADER.size
        self.pieces = np.frombuffer(content, PIECE, n_pieces, at)
        at += self.pieces.nbytes
        self.offsets = np.frombuffer(content, "<u8", -(-self.n_ids // self.block_ids) + 1, at)
        self.payload = at + self.offsets.nbytes
        self.content = content
        self.end = self.payload + int(self.offsets[-1])

    def ids(self, first: int, n: int) -> np.ndarray:
        """Ids first .. first + n of the segment; only their blocks are unpacked."""
        if not n:
            return np.zeros(0, np.uint32)
        parts = []
        low, high = first // self.block_ids, (first + n - 1) // self.block_ids
        for block in range(low, high + 1):
            data = self.content[self.payload + int(self.offsets[block]) : self.payload + int(self.offsets[block + 1])]
            parts.append(unpack_block(data, min(self.block_ids, self.n_ids - block * self.block_ids), self.width))
        at = first - low * self.block_ids
        return np.concatenate(parts)[at : at + n]


def segments(content: bytes) -> Iterator[Segment]:
    """The segments of a file."""
    view, at = memoryview(content), 0
    while at < len(view):
        yield (segment := Segment(view, at))
        at = segment.end + 1  # the newline


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every whole text and write its ids, with `end_id` behind them, to files in ascending doc_id order.

    The files' names are in that order too. NULL text is empty; NULL ids come last; equal ids are ordered
    by their texts' hashes, and equal rows are written as often as they come. Other columns are left out.

    The range partitions follow (doc_id, hash of the text), so a repeated id is split unless its texts are
    equal as well; their number follows the text's length, so a file stays small at every scale. The
    files are written by Spark's text sink, which writes a value's bytes as they are and commits them by
    task: a lost executor leaves no half file.
    """
    spark = docs.sparkSession
    rows = small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // FILE_CHARS))

    def to_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(tokenizer)
        width = bits_for(max(to_ids.vocab_size, end_id + 1))
        pieces, held = [], 0
        for batch in gathered(text_steps(batches), ENCODED_BYTES):
            flat, lengths = to_ids.encode_column(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), np.split(flat, np.cumsum(lengths)[:-1]), strict=True):
                ids, at = np.append(ids, np.uint32(end_id)), 0
                while at < len(ids):
                    part = ids[at : at + SEGMENT_IDS - held]
                    pieces.append((doc_id, at, part, at + len(part) == len(ids)))
                    at, held = at + len(part), held + len(part)
                    if held == SEGMENT_IDS:
                        yield pa.RecordBatch.from_pydict({"value": pa.array([write_segment(pieces, width)], pa.binary())})
                        pieces, held = [], 0
        if pieces:
            yield pa.RecordBatch.from_pydict({"value": pa.array([write_segment(pieces, width)], pa.binary())})
        to_ids.trim()

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    dealt.mapInArrow(to_segments, "value binary").select(F.col("value").cast("string")).write.text(path, lineSep="\n")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: file, place (in the file), doc_id, before (ids of the file before it),
    n_tokens, ids_crc32 (of the ids as little-endian uint32). A folder without documents gives no row."""

    def of_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows: dict[str, list] = {k: [] for k in ("doc_id", "before", "n_tokens", "ids_crc32")}
                before = n = crc = 0
                for segment in segments(content.as_buffer()):
                    ids, at = segment.ids(0, segment.n_ids).astype("<u4"), 0
                    for piece in segment.pieces:
                        part = ids[at : at + int(piece["n"])]
                        crc, n, at = zlib.crc32(part, crc), n + len(part), at + len(part)
                        if piece["flags"] & ENDS:
                            rows["doc_id"].append(None if piece["flags"] & NULL_ID else int(piece["doc_id"]))
                            for key, value in (("before", before), ("n_tokens", n), ("ids_crc32", crc)):
                                rows[key].append(value)
                            before, n, crc = before + n, 0, 0
                count = len(rows["doc_id"])
                yield pa.RecordBatch.from_pydict(
                    {"file": pa.array([name.as_py()] * count, pa.string()), "place": pa.array(range(count), pa.int64())}
                    | {k: pa.array(v, pa.int64()) for k, v in rows.items()}
                )

    kind = T.StructType(
        [T.StructField("file", T.StringType())]
        + [T.StructField(k, T.LongType()) for k in ("place", "doc_id", "before", "n_tokens", "ids_crc32")]
    )
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    return files.mapInArrow(of_file, kind)


def with_starts(read: DataFrame) -> DataFrame:
    """Documents of `read_ids` with `start`, the ids of all documents before them. A file has one row in the window."""
    read = staged(read, "ids_read")
    files = read.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("file", before.alias("file_start"))
    return read.join(files, "file").withColumn("start", F.col("file_start") + F.col("before"))
