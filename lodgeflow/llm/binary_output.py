"""Token ids in patched frame-of-reference blocks.

Documents are sorted by ``doc_id`` over the whole table (range partitions) and
their ids written as segments of whole documents.  A segment's ids are cut
into blocks of 1024.  Of each block the minimum is subtracted; the rest is
packed at the width that holds a given share of the block, and the outliers
are stored in an exception list.  Layout of a segment, little endian:

    4s magic | u4 ids | u4 blocks | u4 exceptions
    u4 minimum, u1 width, u4 payload start, u4 first exception, per block
    payload: packed values, low bit first
    u2 place in block, u4 value minus minimum, per exception

Segments are rows of a Parquet table, so any store that Spark writes to can
hold them, and a task that is run again replaces only its own file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import tokens
from lodgeflow.llm.shared import map_arrow, part_offsets, ragged, slices, texts

BLOCK = 1024
MAGIC = b"PFR1"
#: Ids after which a segment ends (with the document it is in).
SEGMENT_IDS = 64 * BLOCK


def encode_segment(ids: np.ndarray, share: float = 0.95) -> bytes:
    """Patched frame-of-reference bytes of unsigned 32-bit ids.  ``share`` of
    a block's values fit its width; the others are exceptions."""
    n, count = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return struct.pack("<4sIII", MAGIC, 0, 0, 0)
    full = np.empty(count * BLOCK, dtype=np.uint32)
    full[:n], full[n:] = ids, ids[-1]
    full = full.reshape(count, BLOCK)
    base = full.min(axis=1)
    delta = full - base[:, None]
    kth = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    limit = np.partition(delta, kth, axis=1)[:, kth]
    width = np.frexp(limit.astype(np.float64))[1].astype(np.uint8)  # bits of the percentile
    outlier = (delta >> width[:, None].astype(np.uint32) > 0) & (width[:, None] < 32)
    rows, places = np.nonzero(outlier)
    values = delta[rows, places]
    packed: list[bytes] = [b""] * count
    for w in np.unique(width):
        if w:
            which = np.flatnonzero(width == w)
            some = np.where(outlier[which], 0, delta[which]).astype("<u4")
            bits = np.unpackbits(some.view(np.uint8).reshape(len(which), BLOCK, 4), axis=2, bitorder="little")
            data = np.packbits(bits[:, :, :w].reshape(len(which), -1), axis=1, bitorder="little")
            for k, row in zip(which.tolist(), data):
                packed[k] = row.tobytes()
    starts = ragged([len(x) for x in packed])[:-1].astype("<u4")
    first = np.searchsorted(rows, np.arange(count)).astype("<u4")
    return b"".join([struct.pack("<4sIII", MAGIC, n, count, len(rows)), base.astype("<u4").tobytes(),
                     width.tobytes(), starts.tobytes(), first.tobytes(), *packed,
                     places.astype("<u2").tobytes(), values.astype("<u4").tobytes()])


def decode_segment(data: bytes) -> np.ndarray:
    """The ids of ``encode_segment``."""
    magic, n, count, exceptions = struct.unpack_from("<4sIII", data)
    if magic != MAGIC:
        raise ValueError("not a patched frame-of-reference segment")
    at = 16
    base = np.frombuffer(data, "<u4", count, at)
    width = np.frombuffer(data, np.uint8, count, at + 4 * count)
    starts = np.frombuffer(data, "<u4", count, at + 5 * count)
    first = np.frombuffer(data, "<u4", count, at + 9 * count)
    payload, tail = at + 13 * count, len(data) - 6 * exceptions
    places = np.frombuffer(data, "<u2", exceptions, tail)
    values = np.frombuffer(data, "<u4", exceptions, tail + 2 * exceptions)
    delta = np.zeros((count, BLOCK), dtype=np.uint32)
    raw = np.frombuffer(data, np.uint8)
    for w in np.unique(width):
        if w:
            which = np.flatnonzero(width == w)
            size = int(w) * BLOCK // 8
            some = raw[payload + starts[which].astype(np.int64)[:, None] + np.arange(size)]
            bits = np.zeros((len(which), BLOCK, 32), dtype=np.uint8)
            bits[:, :, :w] = np.unpackbits(some, axis=1, bitorder="little").reshape(len(which), BLOCK, w)
            delta[which] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    rows = np.repeat(np.arange(count), np.diff(np.append(first, exceptions).astype(np.int64)))
    delta[rows, places] = values
    return (delta + base[:, None]).reshape(-1)[:n]


_KIND = "part int, local_start long, n_ids long, doc_ids array<{0}>, lengths array<long>, data binary"


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, share: float = 0.95) -> None:
    """Tokenize all documents in ascending ``doc_id`` (null first; equal ids in
    the order of their texts' hash) and write the ids, each document followed
    by ``end_id``.  Null and empty texts hold only the end id; repeated rows
    are written as often as they occur; an empty table writes no segment."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, encode = TaskContext.get().partitionId(), 0, tokens.encoder(vocabulary).encode
        doc_ids, blobs, size, id_type = [], [], 0, None

        def segment() -> pa.RecordBatch:
            data = encode_segment(np.frombuffer(b"".join(blobs), dtype="<u4"), share)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([doc_ids], pa.list_(id_type)), pa.array([[len(x) // 4 for x in blobs]], pa.list_(pa.int64())),
                 pa.array([data], pa.binary())],
                ["part", "local_start", "n_ids", "doc_ids", "lengths", "data"])

        for batch in batches:
            id_type = batch.column("doc_id").type
            values, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in slices(values):
                for key, blob in zip(keys[a:b], encode(values[a:b])):
                    doc_ids.append(key)
                    blobs.append(blob + end)
                    size += len(blob) // 4 + 1
                    if size >= SEGMENT_IDS:
                        yield segment()
                        at, size, doc_ids, blobs = at + size, 0, [], []
        if doc_ids:
            yield segment()

    tie = F.xxhash64("text")
    in_order = texts(docs).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    segments = map_arrow(in_order, run, _KIND.format(kind))
    segments.write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_ids, ids) of all documents in the files: ``start``
    counts the ids of all documents before, ``ids`` are little-endian unsigned
    32-bit."""
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lengths = batch.column("lengths")[k].values.to_numpy()
                cuts = ragged(lengths)
                data = decode_segment(batch.column("data")[k].as_py()).astype("<u4").tobytes()
                starts = cuts[:-1] + batch.column("local_start")[k].as_py()
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("part")[k].as_py()] * n, pa.int32()), batch.column("doc_ids")[k].values,
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array([data[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                    ["part", "doc_id", "local_start", "n_ids", "ids"])

    rows = map_arrow(segments, run, f"part int, doc_id {kind}, local_start long, n_ids long, ids binary")
    offsets = part_offsets(segments.groupBy("part").agg(F.sum("n_ids").alias("total")))
    # one row per written partition: small whatever the files hold
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("local_start") + F.col("before")).alias("start"), "n_ids", "ids")
