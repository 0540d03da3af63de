"""A corpus pipeline of four stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet
in the shared checkpoint folder and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.

1. ``language_id`` drops documents whose language cannot be told: no text or no letter, or
   the best language does not claim the text. It claims a text when the mean share of its
   landmark texts that hold the text's 3-grams is at least 0.4 times (``kernel_langid.CLAIM``)
   the median of its own fitting sample at that length. With any number of languages, texts
   in another script and gibberish fall short of this, and so do most texts in languages
   that were not learned; ones close to a learned language may pass.
2. ``near_duplicates`` keeps of each group of documents linked by five-word shingles with a
   Jaccard similarity of 0.8 or more the one with the smallest ``doc_id``. A ``doc_id`` may be
   null or repeated: both stages judge rows, not ids.
3. ``personal_data`` masks personal data in the texts.
4. ``packing`` packs the texts into sequences of several permitted lengths: one row per
   sequence with the documents in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import best_fit, kernel_langid, ngram_jaccard, pii
from tillcast.llm.common import read_table
from tillcast.session import materialize

# The rows' own key beside the columns of ``documents``.
KEY = "pipeline_row"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row keeps its own verdict, whatever its ``doc_id``. Rows are learned from by id
    and text, so those of a null or repeated id count too and equal rows count once."""
    own = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "lang", "text")
    return kernel_langid.claimed(docs, kernel_langid.fit(own))


def row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` as one column ``doc``, so that no name of it can clash, beside a key of its own for
    each row (``KEY``): the ``doc_id`` where all are distinct and none is null, else a number,
    written down with the rows so that it stays."""
    unsound = docs.groupBy("doc_id").count().filter("doc_id IS NULL OR `count` > 1")
    if unsound.isEmpty():
        return docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias(KEY))
    return materialize(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias(KEY)), "pipeline-rows")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are linked by their texts alone: rows of one ``doc_id`` with different texts are
    different documents. A null ``doc_id`` counts as the largest; of rows with the same
    smallest ``doc_id`` in a group one stays. Rows with an empty set link with nothing and stay."""
    rows = row_keys(docs)
    groups = (ngram_jaccard.link_components(rows.select(F.col(KEY).alias("doc_id"), F.col("doc.text").alias("text")),
                                            k=5, num=4, den=5)
              .selectExpr(f"doc_id AS {KEY}", "component_id"))
    groups = materialize(groups.join(rows.select(KEY, F.col("doc.doc_id").alias("doc_id")), KEY), "pipeline-groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", KEY)).alias("first")
    stays = (groups.groupBy("component_id").agg(first, F.count("*").alias("n")).filter("n > 1")
             .select("component_id", F.col(f"first.{KEY}").alias("stays")))
    dropped = materialize(groups.join(stays, "component_id").filter(f"{KEY} <> stays").select(KEY), "pipeline-dropped")
    return ngram_jaccard.without(rows, dropped, KEY).select("doc.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit.sequences(best_fit.best_fit(docs))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("packing", packing)]

# Trained language and span models and a greedy packing: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
