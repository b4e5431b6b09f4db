"""Token-id files of patched frame-of-reference blocks.

A file is a run of segments, each followed by the marker ``SYNC``; all but the last hold blocks,
the last holds the index. A block has up to BLOCK ids: the block minimum is subtracted, the
differences are packed at the width that a chosen percentile of them needs, and larger ones go to an
exception list (position, difference). The index lists the byte place of every block, and id and
length of every document, so one document can be read without the rest.

The files are written by Spark's text writer (whose line separator is the marker, so its commit
protocol covers lost tasks on any file system Spark can write) and read back as binary files.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session
from . import common, tokens

# Fixed values of the file format.
SYNC = "\nPFOR-SYNC\n"
BLOCK = 2048
SEGMENT_BLOCKS = 128
_HEAD = struct.Struct("<IIBHH")       # ids in the block, minimum, width, exceptions, reserved
_TAIL = struct.Struct("<QQqQ")        # blocks, documents, file number, bytes of the index body
_NO_ID = -(1 << 63)                   # stands for a null document id


def pack_block(ids: np.ndarray, percentile: float) -> bytes:
    low = int(ids.min())
    diff = (ids - low).astype(np.uint32)
    at = np.partition(diff, k := min(len(diff) - 1, int(percentile * len(diff))))[k]
    width = int(at).bit_length()
    out = np.flatnonzero(diff >> width) if width < 32 else np.zeros(0, int)
    kept = diff.copy()
    kept[out] = 0
    bits = (kept[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    body = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return (_HEAD.pack(len(ids), low, width, len(out), 0) + body
            + out.astype("<u2").tobytes() + diff[out].astype("<u4").tobytes())


def unpack_block(data: bytes, at: int) -> np.ndarray:
    n, low, width, n_out, _ = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = (n * width + 7) // 8
    diff = np.zeros(n, dtype=np.uint32)
    if width:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width,
                             bitorder="little").reshape(n, width)
        padded = np.zeros((n, 32), dtype=np.uint8)
        padded[:, :width] = bits
        diff = np.packbits(padded, axis=1, bitorder="little").view("<u4").ravel().copy()
    at += size
    diff[np.frombuffer(data, "<u2", n_out, at)] = np.frombuffer(data, "<u4", n_out, at + 2 * n_out)
    return (diff + np.uint32(low)).astype("<u4")


def file_segments(documents, number: int, percentile: float):
    """Segments of one file from ``(doc_id, ids)`` pairs; one block of ids is held at a time,
    besides the index."""
    starts: list[int] = []
    doc_ids: list[int] = []
    lengths: list[int] = []
    pending: list[np.ndarray] = []
    waiting = place = 0
    segment: list[bytes] = []
    gap = len(SYNC)

    def blocks(last: bool):
        nonlocal pending, waiting
        flat = np.concatenate(pending) if pending else np.zeros(0, "<u4")
        end = len(flat) if last else len(flat) - len(flat) % BLOCK
        for i in range(0, end, BLOCK):
            yield pack_block(flat[i:min(i + BLOCK, end)], percentile)
        pending, waiting = [flat[end:]], len(flat) - end

    def grown(last: bool):
        nonlocal place, segment
        for block in blocks(last):
            starts.append(place)
            place += len(block)
            segment.append(block)
            if len(segment) == SEGMENT_BLOCKS:
                yield b"".join(segment)
                segment, place = [], place + gap

    for doc_id, ids in documents:
        doc_ids.append(_NO_ID if doc_id is None else doc_id)
        lengths.append(len(ids))
        pending.append(ids)
        waiting += len(ids)
        if waiting >= 16 * BLOCK:
            yield from grown(False)
    yield from grown(True)
    if segment:
        yield b"".join(segment)
    if doc_ids:
        body = b"".join(np.asarray(x, dtype=t).tobytes() for x, t in
                        ((starts, "<u8"), (doc_ids, "<i8"), (lengths, "<u8")))
        yield body + _TAIL.pack(len(starts), len(doc_ids), number, len(body))


def read_index(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(block places, document ids, lengths, file number) of a file."""
    end = len(data) - len(SYNC)
    if data[end:] != SYNC.encode():
        raise ValueError("token file without its end marker")
    n_blocks, n_docs, number, size = _TAIL.unpack_from(data, end - _TAIL.size)
    at = end - _TAIL.size - size
    starts = np.frombuffer(data, "<u8", n_blocks, at)
    ids = np.frombuffer(data, "<i8", n_docs, at + 8 * n_blocks)
    lengths = np.frombuffer(data, "<u8", n_docs, at + 8 * (n_blocks + n_docs))
    return starts, ids, lengths, number


def file_documents(data: bytes):
    """``(doc_id, start in the file, ids)`` of every document of a file, block by block."""
    starts, doc_ids, lengths, _ = read_index(data)
    block, have, start = 0, np.zeros(0, "<u4"), 0
    for doc_id, length in zip(doc_ids.tolist(), lengths.tolist(), strict=True):
        parts, need = [], length
        while need > len(have):
            parts.append(have)
            need -= len(have)
            have = unpack_block(data, int(starts[block]))
            block += 1
        parts.append(have[:need])
        have = have[need:]
        yield None if doc_id == _NO_ID else doc_id, start, np.concatenate(parts)
        start += length


@dataclass(frozen=True)
class Output:
    tokenizer: str | None = None      # path of the tokenizer file, by default the public one
    end_id: int = 0
    percentile: float = 0.98


def write(docs: DataFrame, path: str, output: Output | None = None) -> None:
    """Write all ``docs(doc_id, text)`` in ascending id order (null ids first, rows with equal ids
    by their text) as token files below ``path``; an empty table writes no file. Texts, not ids,
    are shuffled, by sampled id ranges with the text hash as second key, so repeated ids spread."""
    output = output or Output()
    file = output.tokenizer or tokens.default_path()

    def encode(frames):
        coder = tokens.encoder(file)
        end = np.asarray([output.end_id], dtype="<u4")

        def documents():
            for frame in frames:
                for doc_id, ids in zip(frame["doc_id"], coder.batch(frame["text"]), strict=True):
                    yield (int(doc_id) if isinstance(doc_id, str) else None,
                           np.concatenate([ids, end]))

        number = TaskContext.get().partitionId()
        for segment in file_segments(documents(), number, output.percentile):
            yield pd.DataFrame({"segment": [segment]})

    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
               .select(common.id_text(F.col("doc_id")).alias("doc_id"), "text"))
    segments = ordered.mapInPandas(encode, "segment binary")
    (segments.select(F.col("segment").cast("string").alias("value"))
     .write.option("lineSep", SYNC).text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files below ``path``: doc_id, file, file_start, n_tokens, ids_crc32."""
    def decode(frames):
        for frame in frames:
            for data in frame["content"]:
                if not len(data):
                    continue
                data = bytes(data)
                number = read_index(data)[3]
                rows = [(number, s, len(ids), common.crc32_u4(ids))
                        for _, s, ids in file_documents(data)]
                out = pd.DataFrame(rows, columns=["file", "file_start", "n_tokens", "ids_crc32"])
                own = read_index(data)[1]
                out.insert(0, "doc_id", pd.arrays.IntegerArray(own.astype(np.int64), own == _NO_ID))
                yield out

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(decode, "doc_id long, file long, file_start long, n_tokens long, "
                                     "ids_crc32 long")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``read`` with ``start``: the ids of all documents before, over all files in order."""
    rows = common.written(read(spark, path), "token-docs")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = common.written(rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "token-files")
    return (rows.join(common.bounded(files), "file")
            .select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens",
                    "ids_crc32"))


def round_trip(docs: DataFrame, output: Output | None = None) -> DataFrame:
    """Write the files into the shared scratch area and return what they hold."""
    spark = docs.sparkSession
    path = session.new_scratch(spark, "token-files")
    write(docs, path, output)
    return documents(spark, path)
