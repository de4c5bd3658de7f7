"""N-gram Jaccard self-join with PartEnum signatures.

A document is its set of distinct word shingles.  Equal sets collapse to one
class first.  Sets are put into bands of size; in a band two similar sets
differ in at most k elements.  The feature domain is dealt into more first
parts than k allows to differ by two or more, and each first part into second
parts of which every set of all but one is enumerated: a signature is the part
of a set that falls in there.  So similar sets share a signature for certain.
Small sets leave such parts empty, and an empty part would put all of them into
one bucket; where few elements may differ there is one level of more parts than
that, and every choice of three of them is a signature.  Where none may differ,
similar sets are equal and need no signature.

Sets that share a signature are first compared with one of them only, in a
few rounds with another one each, which links a group of near copies by some
pairs per member.  Then the members that are not connected yet are compared
among each other.  Before a pair's shingles are looked at, a sketch of parities
(1024 counters modulo 2) must leave a link possible: it bounds the number of
differing elements from below, so nothing is lost.  On large sets all those
counters are full and bound nothing; these have a second sketch that grows with
them.  Every pair that is left is decided by its exact count of common shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StructType, TimestampType

from lodgeflow.llm.bytewords import LOWER, mix, run_hashes, text_bytes
from lodgeflow.llm.components import connected
from lodgeflow.llm.shared import freed, map_arrow, slices, texts, written

_U = np.uint64
#: Second parts; one of them is left out in turn.
PARTS = 3
#: Differing elements up to which one level of parts is enough, and how many of
#: its parts a signature takes (at most 35 choices).
FEW, TAKEN = 4, 3
#: Ratio of a size band's ends.
BAND = 1.5
#: Counters of a set's sketch (held in 64-bit words).
SKETCH = 1024
#: Rounds in which buckets are compared with one member.
ROUNDS = 2
#: Rows of a few numbers (50 MB) up to which a list of documents is broadcast.
BROADCAST_ROWS = 1_000_000
#: Texts that are compared with one text in a task.
GROUP = 500
#: Classes whose signatures a task remembers to have given out already.
SEEN = 200_000

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0, 9, 10, 11, 12, 13, 32]] = True


def shingles(values: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of all texts in a row, ascending in each
    text, and where each text's begin (plus the end).  A-Z are lower-cased;
    words lie between white space; a text of fewer words than ``width`` has its
    whole sequence as one shingle, a text without words none."""
    data, begins = text_bytes(values)
    data = LOWER[data]
    white = _WHITE[data]
    inner = np.flatnonzero(data == 0)
    if len(inner) > len(values):  # a zero byte inside a text belongs to a word
        white[np.setdiff1d(inner, begins[1:] - 1)] = False
    edge = np.diff(np.concatenate([[1], white.astype(np.int8), [1]]))
    starts = np.flatnonzero(edge == -1)
    word = run_hashes(data, starts, np.flatnonzero(edge == 1) - starts)
    owner = np.searchsorted(begins, starts, "right") - 1
    n = np.bincount(owner, minlength=len(values))
    first = np.cumsum(n) - n
    at = np.flatnonzero(np.arange(len(word)) + width <= (first + n)[owner]) if len(word) else np.zeros(0, dtype=int)
    hashes = np.full(len(at), _U(width))
    for k in range(width):
        hashes = mix(hashes * _U(0x9E3779B97F4A7C15) + word[at + k])
    owners = owner[at]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for j, d in enumerate(short.tolist()):
            h = np.array([n[d]], dtype=np.uint64)
            for k in range(int(n[d])):
                h = mix(h * _U(0x9E3779B97F4A7C15) + word[first[d] + k])
            whole[j] = h[0]
        hashes, owners = np.concatenate([hashes, whole]), np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[keep], owners[keep]
    return hashes, np.searchsorted(owners, np.arange(len(values) + 1))


def _sums(values: np.ndarray, bins: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 by bin (exact: halves are summed as floats)."""
    low = np.bincount(bins, weights=(values & _U(0xFFFFFFFF)).astype(float), minlength=n)
    high = np.bincount(bins, weights=(values >> _U(32)).astype(float), minlength=n)
    with np.errstate(over="ignore"):
        return (high.astype(np.uint64) << _U(32)) + low.astype(np.uint64)


def bands(num: int, den: int, largest: int) -> list[tuple[int, int]]:
    """(least size, most differing elements) of each band up to a size."""
    out, low = [], 1
    while low <= largest:
        high = max(low + 1, int(low * BAND))
        out.append((low, 2 * (high - 1) * (den - num) // (den + num)))
        low = high
    return [*out, (low, 0)]


def signatures(values: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of one non-empty set of hashes, for every band in which it
    may meet a similar one."""
    n = len(values)
    wider = bands(num, den, den * n // num)  # those of all sets that may be similar, and one more
    at = len(bands(num, den, n)) - 2  # the band that holds n
    out = []
    spread = mix(values + _U(0x5851F42D4C957F2D))
    content = mix(values ^ _U(0x2545F4914F6CDD1D))
    for b in range(at, len(wider) - 1):
        differ = wider[b][1]
        if not differ:
            continue
        if differ <= FEW:  # at least TAKEN of the parts agree wholly
            parts = differ + TAKEN
            cell = (spread % _U(parts)).astype(np.int64)
            total = _sums(content, cell, parts)
            chosen = np.array(list(combinations(range(parts), TAKEN)))
            place = np.arange(len(chosen), dtype=np.uint64) + _U((b << 40) + (1 << 39))
            out.append(mix(total[chosen].sum(axis=1, dtype=np.uint64) + mix(place + _U(1))))
            continue
        # parts of which at least one holds at most one differing element
        parts = differ // 2 + 1
        parts += parts // 12 + (parts > 1)  # one and some more
        first = (spread >> _U(20)) % _U(parts)
        cell = (first * _U(PARTS) + (spread & _U(0xFFFFF)) % _U(PARTS)).astype(np.int64)
        size = np.bincount(cell, minlength=parts * PARTS).reshape(parts, PARTS)
        total = _sums(content, cell, parts * PARTS).reshape(parts, PARTS)
        left = size.sum(axis=1, keepdims=True) - size
        part = total.sum(axis=1, keepdims=True, dtype=np.uint64) - total
        place = np.arange(parts * PARTS, dtype=np.uint64).reshape(parts, PARTS) + _U(b << 40)
        sign = mix(part + mix(place + _U(1)))
        # a signature of few elements, or of none, says little and fills large
        # buckets.  Below the band's upper end fewer elements may differ, so that
        # more first parts agree; fewer than that can do without their weakest.
        # Two similar sets rank a signature alike, and of the parts in which
        # they agree one at least ranks above the limits of both
        most = min(wider[b + 1][0] - 1, den * n // num)  # the largest set it may meet here
        sure = len(size) - (n + most) * (den - num) // (den + num) // 2
        rank = np.empty(left.size, dtype=np.int64)
        rank[np.lexsort((sign.ravel(), left.ravel()))] = np.arange(left.size)
        weakest = rank.reshape(left.shape).min(axis=1)
        out.append(sign.ravel()[rank >= np.partition(weakest, sure - 1)[sure - 1]])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def sketch(values: np.ndarray) -> np.ndarray:
    """How many elements fall to each counter, modulo 2, in 64-bit words."""
    at = (mix(values + _U(0x6C62272E07BB0142)) % _U(SKETCH)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=SKETCH).astype(np.uint8) & 1, bitorder="little").view("<i8")


def wide_sketch(values: np.ndarray) -> np.ndarray | None:
    """The same with at least as many counters as elements (a power of two,
    so that a sketch folds to half its size), where ``SKETCH`` are too few."""
    if len(values) <= SKETCH:
        return None
    n = 1 << (len(values) - 1).bit_length()
    at = (mix(values + _U(0x6C62272E07BB0142)) % _U(n)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=n).astype(np.uint8) & 1, bitorder="little").view("<i8")


def _node(values: np.ndarray) -> int:
    """The name of a set's class."""
    return int(mix(mix(values).sum(keepdims=True, dtype=np.uint64) + _U(len(values)))[0].astype(np.int64))


def _classes(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, node, sketch, wide), written once: ``node`` names the set's
    class (null for an empty set)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("text").to_pylist()
            for a, b in slices(values):
                hashes, cuts = shingles(values[a:b], width)
                sets = [hashes[s:e] for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(cuts), pa.int64()),
                     pa.array([_node(x) if len(x) else None for x in sets], pa.int64()),
                     pa.array([sketch(x) if len(x) else None for x in sets], pa.list_(pa.int64())),
                     pa.array([wide_sketch(x) for x in sets], pa.list_(pa.int64()))],
                    ["doc_id", "n", "node", "sketch", "wide"])

    schema = f"doc_id {kind}, n long, node long, sketch array<long>, wide array<long>"
    return written(map_arrow(texts(docs), run, schema), "ngram-classes")


def _signed(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(node, sign) of every class; a task gives out a class it remembers once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            values = batch.column("text").to_pylist()
            for a, b in slices(values):
                hashes, cuts = shingles(values[a:b], width)
                nodes, signs = [], []
                for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    node = _node(hashes[s:e]) if s < e else None
                    if node is None or node in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    nodes.append(node)
                    signs.append(signatures(hashes[s:e], num, den).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(signs, pa.list_(pa.int64()))],
                                                 ["node", "signs"])

    rows = texts(docs).where("doc_id is not null").select("text")
    return map_arrow(rows, run, "node long, signs array<long>").select("node", F.explode("signs").alias("sign"))


def _differ(one: str, two: str) -> Column:
    """At least so many elements differ, by the sketches."""
    # one column each: the optimizer's work on a condition doubles with every column that it renames
    x, y = F.col(f"{one}.sketch"), F.col(f"{two}.sketch")
    return sum((F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(SKETCH // 64)), F.lit(0))


def _possible(one: str, two: str, num: int, den: int) -> Column:
    """Whether sizes and sketches leave a link possible."""
    n, m = F.col(f"{one}.n"), F.col(f"{two}.n")
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & (_differ(one, two) * (den + num) <= (n + m) * (den - num))


def _still_possible(pairs: DataFrame, wides: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs of which the wide sketches, where both have one, leave a link
    possible.  The larger of two sketches is folded to the other's size."""
    x, y = F.col("x.wide"), F.col("y.wide")

    def folded(long: Column, short: Column) -> Column:
        half = F.size(short)
        return F.when(F.size(long) == 2 * half, F.zip_with(
            F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(long)

    both = F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differ = F.aggregate(both, F.lit(0), lambda total, n: total + n)
    near = (F.least(F.size(x), F.size(y)) * 2 < F.greatest(F.size(x), F.size(y))) | (
        differ * (den + num) <= (F.col("x.n") + F.col("y.n")) * (den - num))
    return (pairs.join(wides.select(F.struct("n", "wide").alias("x"), F.col("node").alias("a")), "a", "left")
            .join(wides.select(F.struct("n", "wide").alias("y"), F.col("node").alias("b")), "b", "left")
            .where(x.isNull() | y.isNull() | near).select("a", "b"))


def _fixed(kind) -> bool:
    """Whether all values of the type have the same few bytes."""
    return all(_fixed(f.dataType) for f in kind.fields) if isinstance(kind, StructType) else isinstance(
        kind, (NumericType, DateType, TimestampType))


def _linked_of(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes that link, by their common shingles; written
    once.  The texts of ``b`` meet that of ``a`` in one task; where an ``a`` has
    many, they are dealt into groups with a copy of it in each."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("part"))
    asked = dealt.select("a", "part", F.col("b").alias("node"), F.lit(1).alias("place")).unionByName(
        dealt.select("a", "part", F.col("a").alias("node"), F.lit(0).alias("place")).distinct())
    wanted = classes.where("doc_id is not null").join(asked.select("node").distinct(), "node", "left_semi").groupBy(
        "node").agg(F.min("doc_id").alias("doc_id"))
    asked = written(asked.join(wanted, "node"), "ngram-asked")
    # few documents come this far as a rule: then the list goes to the texts, else both are dealt by id
    sent = F.broadcast(asked) if _fixed(asked.schema) and asked.count() <= BROADCAST_ROWS else asked
    rows = (texts(docs).join(sent, "doc_id").select("a", "part", "place", "node", "text")
            .repartition("a", "part").sortWithinPartitions("a", "part", "place", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, one = None, None
        for batch in batches:
            values, found = batch.column("text").to_pylist(), ([], [])
            a, part, place, node = (batch.column(c).to_pylist() for c in ("a", "part", "place", "node"))
            for start, stop in slices(values):
                hashes, cuts = shingles(values[start:stop], width)
                for k, s, e in zip(range(start, stop), cuts[:-1].tolist(), cuts[1:].tolist()):
                    own = hashes[s:e]
                    if s == e or _node(own) != node[k]:
                        continue  # another text of the same doc_id
                    if not place[k]:
                        held, one = (a[k], part[k]), own
                    elif held == (a[k], part[k]):
                        common = len(np.intersect1d(one, own, assume_unique=True))
                        if den * common >= num * (len(one) + len(own) - common):
                            found[0].append(a[k])
                            found[1].append(node[k])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    links = written(map_arrow(rows, run, "a long, b long").distinct(), "ngram-links")
    freed(asked)
    return links


def linked(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id``: documents link when
    ``den * |common| >= num * |union|``; the component id is the smallest
    doc_id reachable by links.

    Null, empty and wordless texts have an empty set and link with nothing;
    repeated rows share a class; different texts of one doc_id are different
    documents of that id; a row without doc_id links with nothing and has no component id; an empty
    table gives an empty result; other columns are ignored."""
    classes = _classes(docs, width)
    line = Window.partitionBy("sign").orderBy("node")
    # equal rows (a class met by several tasks) first go, then buckets of one class
    once = _signed(docs, width, num, den).withColumn("before", F.lag("node").over(line)).where(
        "before is null or before <> node").select("sign", "node")
    met = written(once.withColumns({"before": F.lag("node").over(line), "after": F.lead("node").over(line)})
                  .where("before is not null or after is not null").select("sign", "node"), "ngram-met")
    # near copies share many buckets: of buckets with the same members one is enough
    alike = met.groupBy("sign").agg(F.count("*").alias("size"), F.min("node").alias("low"), F.max("node").alias("high"),
                                    F.bit_xor(F.xxhash64("node")).alias("all"))
    alike = alike.groupBy("size", "low", "high", "all").agg(F.min("sign").alias("sign"))
    all_met, met = met, written(met.join(alike.select("sign"), "sign", "left_semi"), "ngram-buckets")
    freed(all_met)
    words = [f"s{k}" for k in range(SKETCH // 64)]  # numbers, so that rows are told apart by hash and not by sorting
    facts = written(classes.where("doc_id is not null and node is not null").select(
        "node", "n", *[F.col("sketch")[k].alias(w) for k, w in enumerate(words)]).dropDuplicates(["node"]).select(
        "node", "n", F.array(*words).alias("sketch")), "ngram-facts")
    wides = written(classes.where("doc_id is not null and wide is not null").select("node", "n", "wide")
                    .dropDuplicates(["node"]), "ngram-wide")
    links, labels, done = None, None, None

    def still_open() -> DataFrame:
        """(sign, node, label) of the buckets that hold more than one component."""
        now = met.withColumn("label", F.col("node")) if labels is None else met.join(labels, "node", "left").select(
            "sign", "node", F.coalesce("label", "node").alias("label"))
        several = now.groupBy("sign").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return now.join(several.select("sign"), "sign", "left_semi")

    for k in range(ROUNDS + 1):
        members = still_open()
        if k < ROUNDS:
            # the same few members are taken in many buckets, so that pairs repeat
            chosen = members.groupBy("sign").agg(F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("order"), "node",
                                                                "label")).alias("one"))
            pairs = members.join(chosen, "sign").where("one.label <> label").select(
                F.col("one.node").alias("a"), F.col("node").alias("b")).distinct()
            one = facts.select(F.struct("n", "sketch").alias("x"), F.col("node").alias("a"))
            two = facts.select(F.struct("n", "sketch").alias("y"), F.col("node").alias("b"))
            # of those that a member is held against in a round, the nearest by sketch
            pairs = (pairs.join(one, "a").join(two, "b").where(_possible("x", "y", num, den))
                     .groupBy("b").agg(F.min(F.struct(_differ("x", "y").alias("differ"), "a")).alias("best"))
                     .select("best.a", "b"))
        else:
            full = members.join(facts, "node")
            pairs = full.alias("x").join(full.alias("y"), F.expr(
                "x.sign = y.sign and x.node < y.node and x.label <> y.label") & _possible("x", "y", num, den)).select(
                F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
        if done is not None:  # what was compared before
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = written(_still_possible(pairs, wides, num, den), "ngram-pairs")
        turned = pairs.unionByName(pairs.select(F.col("a").alias("b"), F.col("b").alias("a")))
        done = turned if done is None else done.unionByName(turned)
        new = _linked_of(pairs, docs, classes, width, num, den)
        links = new if labels is None else new.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = connected(links)
    named = classes.select("doc_id", "n", "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    first = named.where("label is not null and doc_id is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return named.join(first, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))
