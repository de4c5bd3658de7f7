"""Near duplicates of embeddings by an epsilon grid order join.

Unit vectors are within epsilon of each other exactly when their cosine is
high.  A grid of epsilon-wide cells is laid over the leading principal
dimensions and vectors are sorted by cell, dimension by dimension.  The sorted
sequence is cut into blocks, and intervals of the sequence are joined
recursively: a pair of intervals whose boxes (in principal dimensions) are
more than epsilon apart is dropped, the others are split further down to pairs
of blocks.  In a pair of blocks, cosines are taken in double precision.

Equal vectors collapse first.  A pair of blocks returns, per vector, how many
vectors it links with and one vector of its component in the two blocks, so a
group of near copies gives rows by its size and not by its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.components import connected
from lodgeflow.llm.shared import map_arrow, part_offsets, written

BLOCK = 4096
#: Rows of a block that are compared at a time.
TILE = 512
#: Principal dimensions of the grid order, and of the boxes.
GRID, BOX = 4, 16
#: Children of an interval.
FAN = 16
#: Vectors (about) from which the principal dimensions are found; they decide
#: how much is skipped, not what is found.
SAMPLE = 10_000


def _classes(vectors: DataFrame) -> DataFrame:
    """(node, copies, embedding): usable vectors, equal ones once."""
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(
        "embedding", lambda x: x != 0)
    return vectors.where(F.coalesce(usable, F.lit(False)) & F.col("vec_id").isNotNull()).groupBy("embedding").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"))


def _unit(rows: np.ndarray) -> np.ndarray:
    # by the largest component first, so that no square over- or underflows
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _principal(classes: DataFrame, size: int) -> np.ndarray:
    """Leading directions of about ``SAMPLE`` vectors."""
    n = classes.count()
    place = F.pmod(F.xxhash64("node", F.lit("principal")), F.lit(1_000_000)) / 1_000_000
    rows = classes.where(place < min(1.0, SAMPLE / max(1, n))).orderBy("node").select("embedding").collect()
    if not rows:
        return np.eye(size)[:, :BOX]
    x = _unit(np.array([r[0] for r in rows], dtype=float))
    x = x - x.mean(axis=0)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :BOX]


def _sequence(classes: DataFrame, size: int, epsilon: float) -> DataFrame:
    """(at, node, copies, embedding, place): vectors numbered in grid order,
    ``place`` being their principal coordinates.  Written once."""
    axes = _principal(classes, size)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = np.array(batch.column("embedding").to_pylist(), dtype=float).reshape(batch.num_rows, size)
                place = _unit(rows) @ axes
                cells = np.floor(place[:, :GRID] / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(place), pa.list_(pa.float64())), pa.array(list(cells), pa.list_(pa.int32()))],
                    [*batch.schema.names, "place", "cell"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(np.arange(at, at + n), pa.int64()), *batch.columns],
                ["part", "local", *batch.schema.names])
            at += n

    kind = classes.schema["embedding"].dataType.simpleString()
    id_kind = classes.schema["node"].dataType.simpleString()
    base = f"node {id_kind}, copies long, embedding {kind}, place array<double>"
    placed = map_arrow(classes.select("node", "copies", "embedding"), project, f"{base}, cell array<int>")
    placed = written(placed, "ego-places")  # a range sort reads its input twice
    order = [F.col("cell")[k] for k in range(min(GRID, size))] + [F.col("node")]
    sorted_ = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("cell")
    rows = written(map_arrow(sorted_, number, f"part int, local long, {base}"), "ego-sequence")
    offsets = part_offsets(rows.groupBy("part").agg(F.count("*").alias("total")))
    # one row per written partition
    return rows.join(F.broadcast(offsets), "part").select(
        (F.col("local") + F.col("before")).alias("at"), "node", "copies", "embedding", "place")


def _block_pairs(boxes: DataFrame, last: int, width: int, epsilon: float) -> DataFrame:
    """(i, j), i <= j: blocks that may hold linked vectors, from the widest
    intervals down.  ``boxes`` has a row per block."""
    spark = boxes.sparkSession
    lows, highs = [f"lo{k}" for k in range(width)], [f"hi{k}" for k in range(width)]
    level = 0
    while last // FAN ** level >= FAN:
        level += 1
    top = last // FAN ** level + 1  # at most FAN intervals
    pairs = spark.range(top).select(F.col("id").alias("i"), F.explode(F.sequence("id", F.lit(top - 1))).alias("j"))
    while True:
        box = boxes.groupBy(F.expr(f"block div {FAN ** level}").alias("block")).agg(
            *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs])
        one = box.select(F.col("block").alias("i"), F.struct(*lows, *highs).alias("x"))
        two = box.select(F.col("block").alias("j"), F.struct(*lows, *highs).alias("y"))
        gaps = [F.greatest(F.lit(0.0), F.col(f"x.lo{k}") - F.col(f"y.hi{k}"), F.col(f"y.lo{k}") - F.col(f"x.hi{k}"))
                for k in range(width)]
        pairs = pairs.join(one, "i").join(two, "j").where(
            sum((g * g for g in gaps), F.lit(0.0)) <= epsilon ** 2 + 1e-9).select("i", "j")
        if not level:
            return pairs
        level -= 1
        child = lambda c: F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1)).alias(c)
        pairs = pairs.select(child("i"), "j").select("i", child("j")).where("i <= j")


def _tiles(x: np.ndarray, y: np.ndarray, same: bool, px: np.ndarray, py: np.ndarray, cosine: float,
           epsilon: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that link, tile by tile (each pair once)."""
    fx, fy = x.astype(np.float32), y.astype(np.float32)
    for a in range(0, len(x), TILE):
        for b in range(a if same else 0, len(y), TILE):
            p, q = px[a:a + TILE], py[b:b + TILE]
            gap = np.maximum(0, np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)))
            if gap @ gap > epsilon ** 2 + 1e-9:
                continue
            i, j = np.nonzero(fx[a:a + TILE] @ fy[b:b + TILE].T >= cosine - 1e-4)  # single precision only proposes
            i, j = i + a, j + b
            if same:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 65536):
                u, v = i[s:s + 65536], j[s:s + 65536]
                keep = np.einsum("ij,ij->i", x[u], y[v]) >= cosine
                if keep.any():
                    yield u[keep], v[keep]


def _joined(pairs: DataFrame, blocks: DataFrame, size: int, cosine: float, epsilon: float) -> DataFrame:
    """(node, links, root) of every vector that links in some pair of blocks;
    written once."""

    def table(members) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        get = members.field
        n = len(members)
        return (get("node").to_numpy(), get("copies").to_numpy(),
                _unit(np.array(get("embedding").to_pylist(), dtype=float).reshape(n, size)),
                np.array(get("place").to_pylist(), dtype=float).reshape(n, -1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column("i")[k].as_py() == batch.column("j")[k].as_py()
                nodes, copies, x, px = table(batch.column("x")[k].values)
                n = len(nodes)
                other, more, y, py = (nodes, copies, x, px) if same else table(batch.column("y")[k].values)
                if not same:
                    nodes, copies = np.concatenate([nodes, other]), np.concatenate([copies, more])
                links = np.zeros(len(nodes), dtype=np.int64)
                root = np.arange(len(nodes))
                for i, j in _tiles(x, y, same, px, py, cosine, epsilon):
                    j = j if same else j + n
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    while True:  # the smaller root of both ends, until nothing changes
                        least = np.minimum(root[i], root[j])
                        if (root[i] == least).all() and (root[j] == least).all():
                            break
                        np.minimum.at(root, root[i], least)
                        np.minimum.at(root, root[j], least)
                        while (root[root] != root).any():
                            root = root[root]
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[at], pa.int64()), pa.array(links[at], pa.int64()),
                                                  pa.array(nodes[root[at]], pa.int64())], ["node", "links", "root"])

    one = blocks.select(F.col("block").alias("i"), F.col("members").alias("x"))
    two = blocks.select(F.col("block").alias("j"), F.col("members").alias("y"))
    full = pairs.join(one, "i").join(two, "j").select("i", "j", "x", F.when(F.col("i") != F.col("j"), F.col("y")).alias("y"))
    return written(map_arrow(full, run, "node long, links long, root long"), "ego-links")


def linked(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``: vectors link at a cosine
    of at least ``cosine`` (above 0); ``n_links`` counts all other rows linked
    directly, equal vectors included.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different lengths or rows without
    ``vec_id`` (whose component id is null); repeated rows each count; an empty
    table gives an empty result; other columns are ignored."""
    vectors = vectors.select("vec_id", "embedding")
    classes = written(_classes(vectors), "ego-classes")
    epsilon = float(np.sqrt(2 - 2 * cosine))
    found = []
    # a table of embeddings has one length, or a few
    for r in classes.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).collect():
        size, width = r["size"], min(BOX, r["size"])
        rows = _sequence(classes.where(F.size("embedding") == size), size, epsilon).withColumn(
            "block", F.expr(f"at div {BLOCK}"))
        boxes = written(rows.groupBy("block").agg(
            *[F.min(F.col("place")[k]).alias(f"lo{k}") for k in range(width)],
            *[F.max(F.col("place")[k]).alias(f"hi{k}") for k in range(width)]), "ego-boxes")
        # BLOCK rows at most in each
        blocks = written(rows.groupBy("block").agg(
            F.collect_list(F.struct("node", "copies", "embedding", "place")).alias("members")), "ego-blocks")
        pairs = written(_block_pairs(boxes, (r["n"] - 1) // BLOCK, width, epsilon), "ego-pairs")
        found.append(_joined(pairs, blocks, size, cosine, epsilon))
    named = classes.select("embedding", "node", "copies")
    if not found:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                              F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    labels = connected(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = named.join(counts, "node", "left").join(labels, "node", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("label", "node").alias("component_id"))
    usable = vectors.where("vec_id is not null and embedding is not null")
    rest = vectors.where("vec_id is null or embedding is null").withColumns(
        {"n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id")})
    out = usable.join(named, "embedding", "left").withColumns(
        {"n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "component_id": F.coalesce("component_id", "vec_id")})
    return out.select("vec_id", "n_links", "component_id").unionByName(
        rest.select("vec_id", "n_links", "component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
