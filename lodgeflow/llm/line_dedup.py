"""Lines that many documents share, dropped by keep bitmaps; DataFrame functions only.

The keys of all long lines are hashed to 128 bits and range-partitioned by
hash and document, so that a line which a third of all documents hold spans
many ranges.  Each range is sorted by hash, document (largest first) and
position and streamed once: the first document met is the one that keeps the
line.  A hash that lies on the border of two ranges gets its totals from a
border record, of which there are no more than ranges.  What is returned per
document is a bitmap of the lines to keep, not text; words of 64 lines that are
all kept are left out of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.shared import texts, written

#: `[\x20\x09-\x0D]`, stripped at both ends of a line's key.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of a bitmap stands for 64 lines.
BITS = 6
WORD = 1 << BITS


def _lines(text: Column) -> Column:
    """An empty text is one empty line."""
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """Stripped, A-Z in lower case (``lower`` does no more where all is ASCII)."""
    inner = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(inner) == F.char_length(inner), F.lower(inner)).otherwise(
        F.translate(inner, UPPER, LOWER))


def _documents(docs: DataFrame) -> DataFrame:
    """``text_id`` tells rows of one doc_id apart; equal rows are alike."""
    return texts(docs).select("doc_id", "text", F.xxhash64("text").alias("text_id"))


def _ranges(docs: DataFrame, least_chars: int) -> DataFrame:
    """(part, h1, h2, doc_id, text_id, place) of the lines of at least
    ``least_chars`` characters, in ranges by hash and document; written once."""
    each = _documents(docs).select("doc_id", "text_id", F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    long = each.where(F.char_length(F.btrim("line", F.lit(WHITE))) >= least_chars)
    key = _key(F.col("line"))
    hashed = written(long.select(F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"),
                                 "doc_id", "text_id", "place"), "line-hashes")
    order = ["h1", "h2", F.desc_nulls_last("doc_id")]
    dealt = hashed.repartitionByRange(*order).sortWithinPartitions(*order, "text_id", "place")
    return written(dealt.withColumn("part", F.spark_partition_id()), "line-ranges")


def _borders(ranges: DataFrame) -> DataFrame:
    """(h1, h2, all_docs, all_last) of the hashes that several ranges hold."""
    ends = ranges.groupBy("part").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    ends = ends.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("h1"))
    split = ends.groupBy("h1").agg(F.count("*").alias("parts")).where("parts > 1").select("h1")
    # no more rows than ranges, so it may go to all tasks
    return ranges.join(F.broadcast(split), "h1", "left_semi").groupBy("h1", "h2").agg(
        F.count_distinct(F.struct("doc_id")).alias("all_docs"), F.max("doc_id").alias("all_last"))


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """Per document that loses lines ``doc_id, text_id, keep, n_dropped``:
    ``keep`` is an array of (word, bits) by word, bit ``i`` of word ``w`` set if
    line ``64 * w + i`` stays; words that are left out stay as a whole.

    A key of at least ``least_chars`` characters that at least ``least_docs``
    documents (by ``doc_id``) hold loses all its lines except in the largest
    doc_id.  Null and empty texts have one empty line and lose nothing unless
    ``least_chars`` is 0; rows without doc_id count as one document, before all
    others; repeated rows of one doc_id are one document and lose the same
    lines (all are kept where it is the largest); an empty table gives an empty
    result; other columns are ignored."""
    ranges = _ranges(docs, least_chars)
    here = Window.partitionBy("part", "h1", "h2")
    stream = here.orderBy(F.desc_nulls_last("doc_id"), "text_id", "place")
    before = F.lag(F.struct("doc_id")).over(stream)
    met = ranges.withColumn("first", F.first("doc_id").over(stream)).withColumn(
        "fresh", F.coalesce(~before.eqNullSafe(F.struct("doc_id")), F.lit(True)).cast("int"))
    met = met.withColumn("docs", F.sum("fresh").over(here))
    met = met.join(F.broadcast(_borders(ranges)), ["h1", "h2"], "left")
    last = F.when(F.col("all_docs").isNotNull(), F.col("all_last")).otherwise(F.col("first"))
    dropped = met.where((F.coalesce("all_docs", "docs") >= least_docs) & ~F.col("doc_id").eqNullSafe(last))
    words = (dropped.repartition("doc_id", "text_id")
             .groupBy("doc_id", "text_id", F.shiftright("place", BITS).alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, place % {WORD})")).alias("gone")))
    return words.groupBy("doc_id", "text_id").agg(
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
        F.sum(F.bit_count("gone")).alias("n_dropped"))


def _dense(keep: Column) -> Column:
    """The words of a bitmap one by one, those left out filled in, up to its last."""
    at = lambda i: F.get(keep, i)["word"]
    return F.flatten(F.transform(keep, lambda x, i: F.concat(
        F.array_repeat(F.lit(-1).cast("long"), x["word"] - F.when(i == 0, -1).otherwise(at(i - 1)) - 1),
        F.array(x["bits"]))))


def kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_lines, n_dropped, kept``: the text's lines that
    its bitmap keeps, joined by ``\\n``; a text that loses nothing as it is."""
    maps = bitmaps.select(F.col("doc_id").alias("id"), F.col("text_id").alias("text"), _dense(F.col("keep")).alias(
        "dense"), "n_dropped")
    rows = _documents(docs).alias("d").join(
        maps.alias("b"), F.expr("d.doc_id <=> b.id and d.text_id = b.text"), "left")
    lines = _lines(F.col("d.text"))

    def stays(_: Column, i: Column) -> Column:
        return F.coalesce(F.getbit(F.get("dense", F.shiftright(i, BITS)), i % WORD) == 1, F.lit(True))

    return rows.select(
        F.col("d.doc_id").alias("doc_id"), F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dense").isNull(), F.col("d.text")).otherwise(
            F.array_join(F.filter(lines, stays), "\n")).alias("kept"))


def deduplicated(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """``kept_text`` of the documents by their own bitmaps."""
    return kept_text(docs, keep_bitmaps(docs, least_chars, least_docs))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
