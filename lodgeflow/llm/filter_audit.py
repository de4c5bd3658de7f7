"""How document filters interact, by decision diagrams.

One pass over the texts gives each document a mask of the filters that it
fails; Spark counts masks per part (a source).  From a part's counts a decision
diagram is built: a level for each filter, an edge for passing and one for
failing it, each node weighted with the documents below it, equal nodes shared.
The orders of the filters follow each other by swaps of two adjacent levels;
under each order the path on which everything passes has one node per step,
whose failing edge is what the step removes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.shared import map_arrow, ship_code, written

#: Filters by letter; a document fails the i-th if bit i of its mask is set.
FILTERS = "ABCDE"
LEAST_WORDS = 200
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"
#: Of UTF-8, the bytes that begin no code point.
_INNER = bytes(range(0x80, 0xC0))
#: Bytes of a text whose words are held at a time.
BLOCK = 1 << 20


def _vocabulary(text: bytes) -> tuple[int, int]:
    """Words and distinct words, between ASCII white space (`bytes.split`
    splits at exactly ``[\\x20\\x09-\\x0D]``)."""
    n, distinct, start = 0, set(), 0
    while start < len(text):
        gap = _SPACE.search(text, start + BLOCK)  # cut where a word ends
        stop = gap.end() if gap else len(text)
        words = text[start:stop].split()
        n += len(words)
        distinct.update(words)
        start = stop
    return n, len(distinct)


def text_mask(text: bytes) -> int:
    """Failures of the filters that look at the text alone (A to D)."""
    words, distinct = _vocabulary(text)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _INNER))
    fails = (words < LEAST_WORDS, 100 * distinct < 50 * words, 100 * upper > 2 * points,
             len(text.translate(None, _MARKS)) < len(text))
    return sum(1 << i for i, x in enumerate(fails) if x)


def _facts(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) of every row, written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column("text"):
                text = value.as_py()
                masks.append(text_mask(text))
                digests.append(hashlib.sha256(text).digest()[:16])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()),
                 pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return written(map_arrow(rows, run, f"doc_id {kind}, part string, mask int, digest binary"), "audit-facts")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): at most 32 rows a part."""
    facts = _facts(docs)
    # copies of one text meet as one row per task; a document is its text's first by (digest, doc_id), which no
    # group of copies makes hot
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (facts.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .groupBy("part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))
            .agg(F.count("*").alias("docs"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))


class Weight(NamedTuple):
    docs: int
    good: int
    toxic: int


NOTHING = Weight(0, 0, 0)


class Node(NamedTuple):
    weight: Weight
    passed: Node | Weight | None
    failed: Node | Weight | None


def weight(x: Node | Weight | None) -> Weight:
    return NOTHING if x is None else x.weight if isinstance(x, Node) else x


class Diagram:
    """A count-weighted decision diagram; ``order`` names its levels from the top."""

    def __init__(self, counts: dict[int, Weight], filters: str = FILTERS):
        self.order = filters
        self.shared: dict[Node, Node] = {}
        layer: list[Node | Weight | None] = [counts.get(mask) for mask in range(1 << len(filters))]
        for _ in filters:  # from the last level up: the highest bit tells the two halves apart
            half = len(layer) // 2
            layer = [self.node(layer[i], layer[i + half]) for i in range(half)]
        # the highest bit was merged first, so it is the lowest level
        self.root = layer[0]

    def node(self, passed, failed) -> Node | None:
        if passed is None and failed is None:
            return None
        both = Weight(*map(sum, zip(weight(passed), weight(failed))))
        made = Node(both, passed, failed)
        return self.shared.setdefault(made, made)

    def swap(self, level: int) -> None:
        """Exchange the levels ``level`` and ``level + 1``."""
        self.root = self._swapped(self.root, level)
        o = self.order
        self.order = o[:level] + o[level + 1] + o[level] + o[level + 2:]

    def _swapped(self, x: Node | None, level: int) -> Node | None:
        if x is None:
            return None
        if level:
            return self.node(self._swapped(x.passed, level - 1), self._swapped(x.failed, level - 1))
        (pp, pf), (fp, ff) = ((y.passed, y.failed) if y else (None, None) for y in (x.passed, x.failed))
        return self.node(self.node(pp, fp), self.node(pf, ff))

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """(filter, kept, removed) along the path on which everything passes."""
        x = self.root
        for letter in self.order:
            passed, failed = (x.passed, x.failed) if x else (None, None)
            yield letter, weight(passed), weight(failed)
            x = passed


def adjacent_swaps(n: int) -> list[int]:
    """Levels to swap with the next one, so that all orders of n are passed
    through: the last element runs through the others' orders to and fro."""
    if n < 2:
        return []
    out, inner = [], adjacent_swaps(n - 1)
    down = list(range(n - 2, -1, -1))
    for k in range(len(inner) + 1):
        out += down if k % 2 == 0 else down[::-1]
        if k < len(inner):
            out.append(inner[k] + (k % 2 == 0))  # the runner stands at the front then
    return out


def audit_rows(counts: dict[int, Weight], filters: str = FILTERS) -> list[dict]:
    """The rows of one part, without its name."""
    diagram = Diagram(counts, filters)
    orders = []
    for level in [None, *adjacent_swaps(len(filters))]:
        if level is not None:
            diagram.swap(level)
        orders.append((diagram.order, list(diagram.steps())))
    # a filter that comes first removes all that fail it, one that comes last those that fail nothing else
    fails = {steps[0][0]: steps[0][2].docs for _, steps in orders}
    alone = {steps[-1][0]: steps[-1][2].docs for _, steps in orders}
    shapley = dict.fromkeys(filters, 0)
    for _, steps in orders:
        for letter, _, removed in steps:
            shapley[letter] += removed.docs
    return [{"filter_order": order, "step": k, "kept": kept.docs, "removed": removed.docs,
             "redundant": fails[letter] - removed.docs, "unique_fails": alone[letter], "good_lost": removed.good,
             "toxic_lost": removed.toxic, "shapley": shapley[letter]}
            for order, steps in sorted(orders) for k, (letter, kept, removed) in enumerate(steps, 1)]


_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
           "good_lost long, toxic_lost long, shapley long")
_ARROW = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                    *((c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
                                                "shapley"))])


def _audit_part(table: pa.Table) -> pa.Table:
    """The rows of one part from its (at most 32) counts."""
    rows = table.to_pylist()
    counts = {r["mask"]: Weight(r["docs"], r["good"], r["toxic"]) for r in rows}
    return pa.Table.from_pylist([{"part": rows[0]["part"]} | r for r in audit_rows(counts)], schema=_ARROW)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step.

    A null or empty text has no words and so fails A; a null source is the part
    ``""``; of equal texts all but the smallest doc_id's fail E, rows of the
    same doc_id alike, and a row without doc_id neither fails E nor makes
    another fail; labels of a doc_id are combined by "any", a null label or
    none counts nothing; repeated rows count each; an empty table gives an
    empty result; other columns are ignored."""
    ship_code(docs.sparkSession)
    return mask_counts(docs, labels).groupBy("part").applyInArrow(_audit_part, _SCHEMA)
