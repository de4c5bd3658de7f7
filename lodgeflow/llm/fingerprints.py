"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes marks chunk boundaries wherever it meets a
condition, so an edit moves boundaries only near itself.  A boundary of a block
size is one of every smaller size too, so chunks are hashed from the chunks
within them, starting with bytes.  Each different chunk gives one symbol, where
it first occurs; a fingerprint holds the symbols of the whole text at the first
block size at which they are at most 64, at the one before and at larger ones, in any
case at the sizes that suit the text's length (where a repetitive text may have
more), so that texts with more or fewer repetitions have sizes in common.  Two
fingerprints are compared at the block sizes that they have in common, by the
edit distance of their symbols (insertions and deletions).

To compare a document with the next one by ``doc_id``, texts are dealt over
partitions by ranges of ids and sorted there.  A partition's first and last
documents are written beside its results, and each last one then meets the first
of the next partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.bytewords import factors, mix
from lodgeflow.llm.shared import map_arrow, texts, written

SYMBOLS = 64
SIZES = 3
_FINE = 8
_WINDOW = 7
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"


def _joined(parts: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A hash of all parts from each edge to the next one."""
    lengths = np.diff(edges)
    places = np.arange(len(parts)) - np.repeat(edges[:-1], lengths)
    values = (parts.astype(np.uint64) + np.uint64(1)) * factors(int(lengths.max()))[places]
    return mix(np.add.reduceat(values, edges[:-1]) + lengths.astype(np.uint64))


def _symbols(hashes: np.ndarray) -> str:
    """Two letters for each different chunk, in the order of their first places."""
    return "".join([_ALPHABET[h >> 6 & 63] + _ALPHABET[h & 63] for h in dict.fromkeys(hashes.tolist())])


def fingerprint(text: str) -> str:
    """``block:symbols`` of a whole text, with the symbols at twice the block,
    four times and so on after it, three sizes at least and up to twice the size
    at which a text of this length usually has 64 chunks; the empty text gives
    ``0:::``."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = len(data)
    if not n:
        return "0" + ":" * SIZES
    wide = np.concatenate([np.zeros(_WINDOW - 1, dtype=np.uint64), data.astype(np.uint64) + np.uint64(1)])
    rolling = np.zeros(n, dtype=np.uint64)
    for k in range(_WINDOW):
        rolling = rolling * np.uint64(0x100000001B3) + wide[k:k + n]
    rolling = mix(rolling) >> np.uint64(16)
    usual = 2
    while usual * SYMBOLS < n:
        usual *= 2
    chunks, ends, kept, before = data, rolling, [], None
    block = 1 if usual <= _FINE else _FINE // 2
    while len(kept) < SIZES or block < 2 * usual:
        block *= 2
        if block <= _FINE:  # from bytes; larger ones from the chunks before
            chunks, ends = data, rolling
        cuts = np.flatnonzero(ends & np.uint64(block - 1) == block - 1) + 1
        if len(cuts) and cuts[-1] == len(chunks):
            cuts = cuts[:-1]
        edges = np.concatenate([[0], cuts, [len(chunks)]])
        chunks, ends = _joined(chunks, edges), ends[edges[1:] - 1]
        if not kept:
            few = len(chunks) <= SYMBOLS or len(set(chunks.tolist())) <= SYMBOLS
            if few and before is not None:
                kept.append(_symbols(before))
        if kept or few or block >= usual:
            kept.append(_symbols(chunks))
        before = chunks
    return ":".join([str(block >> len(kept) - 1), *kept])


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, all of ``a`` at a time in the
    bits of a number."""
    where: dict[str, int] = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x = [a[k:k + 2] for k in range(0, len(a), 2)]
    y = [b[k:k + 2] for k in range(0, len(b), 2)]
    return 2.0 * _common(x, y) / max(1, len(x) + len(y))


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, 0 where no block size is in common; else the
    share of symbols that an edit script keeps, the best over the common block
    sizes."""
    if a == b:
        return 1.0
    (m, *x), (n, *y) = a.split(":"), b.split(":")
    m, n = int(m), int(n)
    if not m or not n:
        return 0.0
    x = {m << k: s for k, s in enumerate(x)}
    y = {n << k: s for k, s in enumerate(y)}
    both = x.keys() & y.keys()
    return max((_alike(x[k], y[k]) for k in both), default=0.0)


def edited(text: str, following: str) -> str:
    """The text with the end (a quarter of its code points) replaced by the
    beginning of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _result(one: tuple, following: tuple) -> dict:
    """The columns of ``compared`` from (doc_id, text, fingerprint) of a document and the next."""
    doc_id, text, mark = one
    other = edited(text, following[1])
    mark_edited = fingerprint(other)
    return {"doc_id": doc_id, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), "fingerprint": mark,
            "edited_fingerprint": mark_edited, "near_edited": likeness(mark, mark_edited),
            "near_next": likeness(mark, following[2])}


_COLUMNS = {"n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
            "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}
_SCHEMA = ("doc_id {0}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def compared(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``; the document after the last
    is the first, and a single document is its own next one.  ``buckets``: ranges
    of ids, as many as shuffle partitions if not given.

    Null texts count as empty (fingerprint ``0:::``, likeness 1 to another empty
    one); a null ``doc_id`` comes first; rows of the same ``doc_id`` stand in
    the order of their texts' hash, and equal rows give equal fingerprints; an
    empty table gives an empty result; other columns are ignored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = ["doc_id", F.xxhash64("text")]
    dealt = texts(docs).repartitionByRange(*([buckets] if buckets else []), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, id_type = TaskContext.get().partitionId(), None, None

        def rows(found: list[dict]) -> pa.RecordBatch:
            types = {"doc_id": id_type, **_COLUMNS, "text": pa.string(), "place": pa.string(), "part": pa.int32()}
            return pa.RecordBatch.from_arrays(
                [pa.array([r.get(c) for r in found], t) for c, t in types.items()], list(types))

        def border(place: str) -> dict:
            return {"doc_id": held[0], "text": held[1], "fingerprint": held[2], "place": place, "part": part}

        for batch in batches:
            id_type, found = batch.column("doc_id").type, []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                one = (doc_id, text, fingerprint(text))
                if held is not None:
                    found.append(_result(held, one))
                    held = one
                else:
                    held = one
                    found.append(border("first"))
            yield rows(found)
        if held is not None:
            yield rows([border("last")])

    table = written(map_arrow(dealt, run, _SCHEMA.format(kind) + ", text string, place string, part int"), "fingerprints")
    first = table.where("place = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"),
                                                  F.col("fingerprint").alias("next_mark"))
    # one number for each partition that holds rows, whatever their texts
    parts = table.where("place = 'first'").select("part")
    ring = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                           F.min("part").over(Window.partitionBy())).alias("next"))
    pairs = table.where("place = 'last'").select("doc_id", "text", "fingerprint", "part").join(ring, "part").join(
        first, "next").select("doc_id", "text", "fingerprint", "next_text", "next_mark")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_result((r["doc_id"], r["text"], r["fingerprint"]), (None, r["next_text"], r["next_mark"]))
                     for r in batch.to_pylist()]
            types = {"doc_id": batch.column("doc_id").type, **_COLUMNS}
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], t) for c, t in types.items()], list(types))

    names = ["doc_id", *_COLUMNS]
    return table.where("place is null").select(*names).unionByName(map_arrow(pairs, meet, _SCHEMA.format(kind)))
