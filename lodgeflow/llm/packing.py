"""Packing by concatenation and cutting.

Pass one tokenizes every document where it is read and keeps, per input
partition, a running token sum; the ids are written once.  Pass two turns the
partitions' totals (one row each) into global offsets.  All documents then
stand in one gapless line that is cut into fixed windows; a document that
crosses a window boundary gets one record per window.  Only the very last
sequence is padded.  No row is shuffled: a hot source, copies and very long
documents cost what their tokens cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm import tokens
from lodgeflow.llm.shared import map_arrow, part_offsets, slices, texts, written


def tokenized(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(part, doc_id, local_start, n_ids, ids): ids with the end id of every
    document, and its place among those of its input partition."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, encode = TaskContext.get().partitionId(), 0, tokens.encoder(vocabulary).encode
        for batch in batches:
            values = batch.column("text").to_pylist()
            for a, b in slices(values):
                blobs = [x + end for x in encode(values[a:b])]
                counts = [len(x) // 4 for x in blobs]
                starts = []
                for n in counts:
                    starts.append(at)
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(blobs), pa.int32()), batch.column("doc_id").slice(a, b - a),
                     pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())],
                    ["part", "doc_id", "local_start", "n_ids", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts(docs), run, f"part int, doc_id {kind}, local_start long, n_ids long, ids binary")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, length: int = 1024) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id,
    offset, ids`` (little-endian unsigned 32-bit).

    Documents stand in the order in which they are read.  A null or empty text
    holds only the end id; repeated rows are packed as often as they occur; a
    null ``doc_id`` is carried; an empty table gives no piece; other columns
    are ignored."""
    ids = written(tokenized(docs, vocabulary, end_id), "tokens")
    offsets = part_offsets(ids.groupBy("part").agg(F.sum("n_ids").alias("total")))
    # one row per input partition: small whatever the table holds
    placed = ids.join(F.broadcast(offsets), "part").withColumn("begin", F.col("local_start") + F.col("before"))
    first, last = F.expr(f"begin div {length}"), F.expr(f"(begin + n_ids - 1) div {length}")
    cut = placed.select("doc_id", "n_ids", "begin", "ids", F.explode(F.sequence(first, last)).alias("sequence_id"))
    start = F.greatest(F.lit(0), F.col("sequence_id") * length - F.col("begin")).cast("long")
    stop = F.least(F.col("n_ids"), (F.col("sequence_id") + 1) * length - F.col("begin"))
    return cut.withColumns({"start": start, "length": (stop - start).cast("long")}).select(
        "doc_id", "start", "length", F.col("n_ids").alias("doc_tokens"), "sequence_id",
        (F.col("begin") + F.col("start") - F.col("sequence_id") * length).alias("offset"),
        F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"))


def pack_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
