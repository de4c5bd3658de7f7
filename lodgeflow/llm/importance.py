"""Importance resampling towards a target distribution.

Features are runs of words, hashed into buckets.  The counts of a bucket in
the documents and in the target texts give its gain; the gains are one array
and a document's weight is the floored mean of the array's entries for its
features.  The weight plus a noise by doc_id is the score.

The best scores are drawn by parallel sorting by regular sampling: each task
sorts its documents (a run) and writes them; regular samples of all runs give
splitters; every run's segments go to the segment's task, which merges them;
prefix counts over the segments turn places into exact ranks.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.bytewords import LOWER
from lodgeflow.llm.shared import map_arrow, part_offsets, written

_LOWER = LOWER.tobytes()
#: In lower-cased UTF-8; bytes from 0x80 on belong to words.
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes of a text that are looked at together.
BLOCK = 1 << 20
#: Regular samples that a run gives.
SAMPLES = 64
#: Low bits of monotonically_increasing_id: a row's place in its partition.
_PLACES = 33


def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """The text's words, block by block; blocks end between words."""
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + BLOCK)
        stop = gap.end() if gap else len(text)
        yield _WORD.findall(text[start:stop])
        start = stop


def features(text: bytes, buckets: int, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end in them) block by block."""
    held: list[bytes] = []  # words before the block that a run of it may begin with
    for new in _blocks(text.translate(_LOWER)):
        words, parts, sums = held + new, [], None
        for k in range(1, longest + 1):
            # the crc of a run goes on from that of the run without its last word
            sums = list(map(crc32, words)) if k == 1 else list(
                map(crc32, words[k - 1:], map(crc32, repeat(b" "), sums)))
            parts.append(np.array(sums[max(0, len(held) - k + 1):], dtype=np.int64))
        yield len(new), np.concatenate(parts) % buckets
        held = words[max(0, len(words) - longest + 1):] if longest > 1 else []


def bucket_counts(rows: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features of all texts by bucket; each task sends its own array's sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, size = np.zeros(buckets, dtype=np.int64), [], 0
        for batch in batches:
            for value in batch.column("text"):
                for _, found in features(value.as_py(), buckets, longest):
                    waiting.append(found)
                    size += len(found)
                    if size > 500_000:
                        total += np.bincount(np.concatenate(waiting), minlength=buckets)
                        waiting, size = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    found = map_arrow(rows.where("text is not null").select(F.col("text").cast("binary").alias("text")), run,
                      "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # as many rows as buckets
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of shares) of each bucket."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n))))
                     for a, b in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    kind, buckets = docs.schema["doc_id"].dataType.simpleString(), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), dtype=np.int64)
            for i, value in enumerate(batch.column("text")):
                words = n = total = 0
                for new, found in features(value.as_py(), buckets, longest):
                    words, n, total = words + new, n + len(found), total + int(gain[found].sum())
                out[:, i] = words, n, total // n if n else 0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return map_arrow(rows, run, f"doc_id {kind}, n_words long, n_features long, weight long")


def _splitters(runs: DataFrame, segments: int) -> list[tuple]:
    """Keys (-score, doc_id) that begin the segments after the first, from
    ``SAMPLES`` regular samples of each run, each weighing the rows it stands
    for.  The samples are as many as the runs times that, whatever their rows."""
    sizes = runs.groupBy("run").agg(F.count("*").alias("rows"))
    step = F.greatest(F.lit(1), F.floor(F.col("rows") / SAMPLES))
    samples = runs.join(F.broadcast(sizes), "run").withColumn("step", step).where("place % step = step div 2")
    line = Window.orderBy(F.desc("score"), "doc_id")
    upto = samples.withColumn("upto", F.sum("step").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    total = upto.withColumn("all", F.sum("step").over(Window.partitionBy()))
    cut = F.floor(F.col("upto") * segments / F.col("all"))
    cuts = total.where(cut > F.floor((F.col("upto") - F.col("step")) * segments / F.col("all")))
    return sorted((-r["score"], r["doc_id"]) for r in cuts.select("score", "doc_id").distinct().collect())


def _dealt(runs: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Each row with the segment that it belongs to."""
    kind = runs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("score").to_pylist(), batch.column("doc_id").to_pylist())
            segment = [bisect_left(splitters, (-score, doc)) for score, doc in keys]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(segment, pa.int64())],
                                             [*names, "segment"])

    return map_arrow(runs.select(*names), run,
                     f"doc_id {kind}, n_features long, weight long, score long, segment long")


def resampled(docs: DataFrame, target: DataFrame, buckets: int = 10_000, longest: int = 2, percent: int = 25,
              least_words: int = 20, seed: int = 7) -> DataFrame:
    """Every row's ``doc_id, n_features, weight, score, rank``.

    Of the N documents with at least ``least_words`` words the
    ``floor(percent * N / 100)`` best scores are drawn, ties to the smaller
    doc_id; others have a null rank.  Null and empty texts have no features and
    weight 0; a row without doc_id is counted in the corpus, but has no score,
    is none of the N and is not drawn; repeated rows are documents each (rows
    that are alike in all take either rank); an empty table gives an empty
    result, an empty target the same counts everywhere; other columns are
    ignored."""
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296)))
    scored = weighed(docs, gain, longest).withColumn("score", (F.col("weight") + noise).cast("long")).withColumn(
        "able", F.col("score").isNotNull() & (F.col("n_words") >= least_words))
    order = [F.desc("score"), "doc_id", "n_features"]
    # what can be drawn stands first in each run, so that its places are 0, 1, 2, ...
    rows = scored.sortWithinPartitions(F.desc("able"), *order).withColumn("at", F.monotonically_increasing_id())
    rows = written(rows.select("doc_id", "n_features", "weight", "score", "able",
                               F.shiftright("at", _PLACES).alias("run"),
                               F.col("at").bitwiseAND(F.lit((1 << _PLACES) - 1)).alias("place")), "resample-runs")
    runs = rows.where("able")
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(_dealt(runs, _splitters(runs, segments)), "resample-segments")
    counts = dealt.groupBy("segment").agg(F.count("*").alias("total"))
    before = part_offsets(counts, "segment")  # a row per segment
    drawn = runs.count() * percent // 100
    merged = dealt.withColumn("place", F.row_number().over(Window.partitionBy("segment").orderBy(*order)))
    rank = (F.col("before") + F.col("place")).cast("long")
    ranked = merged.join(F.broadcast(before), "segment").select(
        "doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))
    return ranked.unionByName(rows.where("not able").select(
        "doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
