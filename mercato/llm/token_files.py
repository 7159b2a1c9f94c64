"""Operator 5, token-ID output: fixed-width bit packing with block offsets.

Ids are stored in the fewest bits that hold the vocabulary (16 for 50,257
ids).  A *segment* is one binary value::

    magic "FWP1" | width u8 | 3 zero bytes | ids in a block u32 | blocks u32 | ids u64
    block offsets u64 x (blocks + 1), from the end of this header
    blocks: ids packed from the lowest bit up, each block ends on a byte

so any run of ids is unpacked with numpy from the blocks that hold it and from
nothing else.  A file set is a folder of Parquet files written by Spark's
commit protocol (retries and lost executors leave no half file, on any store
Spark can write): one row per segment with ``file``, ``segment``, its first id's
place in the file, its documents' ids, first places and lengths, and the
packed segment.  Documents follow each other in ascending id within and across files.

One range shuffle on the document id orders the texts; each task encodes and
packs its range as a stream, so memory holds one batch and one segment.  First
places over the whole set are the running sum of one count per file.

Edge cases: a null or empty text is its end id alone; null ids come first;
rows with equal ids are ordered by a hash of their text and all kept; a text of
any length lies whole in one segment; an empty table makes an empty file set;
other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.operators.joins import broadcast_if_small
from mercato.sources.sinks import scratch_path

from .common import bound_batches, pieces

MAGIC = b"FWP1"
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
END_ID = 0
MOST_FILES_BROADCAST = 100_000
_HEAD = struct.Struct("<4sB3xIIQ")

_SCHEMA = ("file long, segment long, start long, n_ids long, doc_ids array<long>, doc_starts array<long>, "
           "doc_counts array<long>, packed binary")


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold ids below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[:n * width].reshape(n, width)
    whole = np.zeros((n, 32), np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").reshape(n)


def pack_segment(ids: np.ndarray, width: int, block_ids: int = BLOCK_IDS) -> bytes:
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    blocks = [pack_bits(ids[i:i + block_ids], width) for i in range(0, len(ids), block_ids)]
    offsets = np.zeros(len(blocks) + 1, "<u8")
    np.cumsum([len(b) for b in blocks], out=offsets[1:])
    return b"".join([_HEAD.pack(MAGIC, width, block_ids, len(blocks), len(ids)), offsets.tobytes(), *blocks])


def read_segment(packed: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a segment; only the blocks that hold them are unpacked."""
    magic, width, block_ids, blocks, n = _HEAD.unpack_from(packed)
    if magic != MAGIC:
        raise ValueError("not a packed segment")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    offsets = np.frombuffer(packed, "<u8", blocks + 1, _HEAD.size)
    base = _HEAD.size + 8 * (blocks + 1)
    first, last = start // block_ids, (stop - 1) // block_ids
    out = [unpack_bits(packed[base + int(offsets[b]):base + int(offsets[b + 1])], min(block_ids, n - b * block_ids),
                       width) for b in range(first, last + 1)]
    return np.concatenate(out)[start - first * block_ids:stop - first * block_ids]


def _encoder(path: str):
    from .byte_bpe import WordEncoder

    return WordEncoder(path)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> str:
    """Encode every whole text and write the file set to ``path``."""
    bound_batches(docs)
    ordered = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").drop("tie"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        width = width_of(encoder.vocabulary())
        file, place, segment = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        names: list = []
        counts: list[np.ndarray] = []
        held = 0

        def flush():
            flat, n = np.concatenate(ids), np.concatenate(counts)
            starts = place + np.cumsum(n) - n
            row = [[file], [segment], [place], [len(flat)], [names], [starts], [n], [pack_segment(flat, width)]]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 3 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                                              ["file", "segment", "start", "n_ids", "doc_ids", "doc_starts",
                                               "doc_counts", "packed"])

        for batch in pieces(batches, "text", 4 << 20):  # the more text, the rarer new words
            texts = [t or "" for t in batch.column(1).to_pylist()]
            flat, n = encoder.encode(texts)
            ends = np.cumsum(n)
            flat = np.insert(flat, ends, end_id)  # after each document's ids
            ids.append(flat)
            counts.append(n + 1)
            names += batch.column(0).to_pylist()
            held += len(flat)
            if held >= segment_ids:
                yield flush()
                place, segment, held = place + held, segment + 1, 0
                ids, names, counts = [], [], []
        if held:
            yield flush()

    ordered.mapInArrow(write, _SCHEMA).write.parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, segment_file``: every document of a file set, from its packed ids."""
    segments = spark.read.schema(_SCHEMA).parquet(path)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    bases = segments.groupBy("file").agg(F.sum("n_ids").alias("n")).select(
        F.col("file").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = broadcast_if_small(bases, MOST_FILES_BROADCAST)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = read_segment(row["packed"])
                starts = np.array(row["doc_starts"], np.int64)
                counts = np.array(row["doc_counts"], np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(starts - row["start"], counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["base"]), pa.array(counts),
                     pa.array(crc, pa.int64()), pa.array([row["file"]] * len(crc), pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "segment_file"])

    small = segments.join(bases, segments["file"] == bases["of"]).drop("of")
    return small.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, segment_file long")


def read_ids(spark: SparkSession, path: str, file: int, start: int, n: int) -> np.ndarray:
    """Random access: ``n`` ids from place ``start`` of one file; other segments are not read."""
    rows = (spark.read.schema(_SCHEMA).parquet(path)
            .filter((F.col("file") == file) & (F.col("start") < start + n)
                    & (F.col("start") + F.col("n_ids") > start)).select("start", "packed").orderBy("start"))
    found = [read_segment(r["packed"], max(0, start - r["start"]), start + n - r["start"])
             for r in rows.toLocalIterator()]
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, tokenizer, scratch_path(spark, "token-files")))
