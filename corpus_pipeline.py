"""A corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists the stages in order.  Each takes ``(spark, docs, sf_dir)``,
works on all that the stage before kept, and returns a DataFrame that ``run``
writes as Parquet and reads again.  All but the last return the columns of
``documents``.

A document is a row with its own doc_id and text: where several rows share a
doc_id, each is judged by its own text.  In every stage an empty table gives an
empty table, a null text counts as an empty one and stays null, a null in lang,
source or n_chars is carried, and columns that ``documents`` lacks are dropped,
whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import mixing, ngram_join, packing, quality_rules, secret_scan
from lodgeflow.llm.shared import read, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _told_apart(docs: DataFrame) -> DataFrame:
    """``documents`` with ``text_id``, which tells rows of one doc_id apart."""
    return docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_id"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject.  Rows without doc_id are
    judged as well, repeated rows alike; without labels every score is one half
    and all stay."""
    return quality_rules.kept(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group that five-word
    shingles link at a Jaccard similarity of 0.8 or more.

    Rows that are alike in doc_id and text are one document, of which one row
    stays.  Of several texts of one doc_id those go that link with a smaller
    doc_id or with another of its texts that stays.  Documents without words or
    without doc_id link with nothing and stay."""
    rows, own = _told_apart(docs), ["doc_id", "text_id"]
    keyed = rows.select(F.when(F.col("doc_id").isNotNull(), F.struct(*own)).alias("doc_id"), "text")
    found = ngram_join.linked(keyed, width=5, num=80, den=100)
    gone = found.where("component_id < doc_id").select("doc_id.*").distinct()
    left = rows.join(gone, own, "left_anti")
    # few rows are repeated as a rule, and only their texts are grouped
    repeated = rows.where("doc_id is not null").groupBy(*own).count().where("count > 1").select(*own)
    return left.join(repeated, own, "left_anti").select(*COLUMNS).unionByName(
        left.join(repeated, own, "left_semi").dropDuplicates(own).select(*COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars stays as it was, as a
    fact about the source.  Repeated rows stay and are marked alike."""
    return secret_scan.redacted(docs.select(*COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by their rates: toxic ones are aimed at no share at all.  The
    target size lies a little above what the clean documents hold, so that
    their rates are at least 1; a rate is rounded to a whole number of copies, so
    what is likelier clean stays, and no document is repeated.  Each
    row goes or stays by its own text, also where a doc_id is missing or has
    several; without labels all stay."""
    rows, labels = _told_apart(docs), read(spark, sf_dir, "labels")
    domain = F.when(labels["toxic"] == 1, "toxic").otherwise("clean")
    rates = mixing.mixed(rows, labels.select("doc_id", domain.alias("domain")), {"clean": 1.0, "toxic": 0.0},
                         headroom=1.02, carry=["text_id"])
    gone = rates.where("rate < 0.5").select(F.col("doc_id").alias("id"), F.col("text_id").alias("own")).distinct()
    return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_id") == F.col("own")),
                     "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens; a null or empty text is its end id
    alone, repeated rows and rows without doc_id are packed one by one."""
    return packing.pack_digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", pack),
]

#: The classifiers and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
