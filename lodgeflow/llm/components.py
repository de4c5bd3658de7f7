"""Connected components of a table of links, by rounds of joins.

Alternating large-star and small-star steps: every round hangs nodes on
smaller neighbours until each component is a star around its smallest node.
Nothing is collected; each round's links are checkpointed, so a lost executor
costs at most one round and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.session import checkpoint_root


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (``large``) or smaller neighbours, and itself
    then, on the smallest node next to it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    # links are kept with a > b: a small-star looks from a at its smaller neighbours
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = both.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """``links`` has columns ``a`` and ``b`` (numbers); the result has a row
    (node, label) for every node of a link between different nodes, the label
    being the smallest node of its component."""
    checkpoint_root(links.sparkSession)  # Spark's checkpoint folder is set
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = links.checkpoint()
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if seen == state or not state[0]:
            break
        seen = state
        links = _star(_star(links, large=True), large=False).checkpoint()
    return (links.select(F.col("a").alias("node"), F.col("b").alias("label"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct())
