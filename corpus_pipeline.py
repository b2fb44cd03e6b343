"""From raw documents to token files: quality, near duplicates, benchmark passages, mixture, token ids.

Each stage takes what its predecessor kept, as a table. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import decontaminate, mixing, ngram_join, quality, tokens
from lamina.llm.queries import TOKENIZER
from lamina.llm.shared import Tables, arrow_rows, discard, materialize, table
from lamina.operators.match import numbered


#: Words of a shingle and similarity in percent from which documents are near copies here; op3's own are those of its contract.
WORDS, PERCENT = 5, 80
#: Ids of near copies that are broadcast, at most (16 MB).
MOST_SENT = 1 << 21
#: Whole rows that are sent to a Python worker at once.
TEXTS = 1000


def _whole(docs: DataFrame, *names: str) -> DataFrame:
    """Each row as one column, so that no name clashes with an operator's, and the columns it needs."""
    return docs.select(F.struct("*").alias("_row"), *names)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality verdict rejects go; null texts have no words, so they do. Repeated rows share their fate; other columns are kept as they are."""
    return quality.score_quality(_whole(docs, "text"), keep=["_row"]).filter("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id, one without doc_id only if none has one.

    Rows of equal doc_id, or without one, are documents of their own, and go only as near copies do: they are numbered in a written
    table then. Texts without words, null ones among them, are near to nothing. Empty tables stay empty; other columns are kept as they are.
    """
    odd = docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return _without_copies(docs, docs, "doc_id").select(docs.columns)
    with Tables() as tables:
        order = numbered(_whole(docs, "doc_id", "text").withColumn("_h", F.xxhash64("text")), F.col("doc_id").isNull(), "doc_id", "_h")
        rows = tables.keep(materialize(order.select("_row", "text", "rn")))
    return _without_copies(rows, rows.select(F.col("rn").alias("doc_id"), "text"), "rn").select("_row.*")


def _without_copies(rows: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not that of a near copy of an earlier one."""
    with Tables() as tables:
        found = tables.keep(materialize(ngram_join.join(docs, words=WORDS, percent=PERCENT)))
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(key))
    # up to a counted number of ids they go to the texts; beyond it the join shuffles both
    if gone.count() <= MOST_SENT:
        gone = F.broadcast(gone)
    return rows.join(gone, key, "left_anti")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; repeated and null doc_ids are rows like others. Null texts have no words and stay.

    Rows go through Python workers whole, so few at once; that holds for jobs started here only, hence the table.
    """
    with Tables() as tables, arrow_rows(spark, TEXTS):
        found = decontaminate.find(_whole(docs, "doc_id", "text"), table(spark, sf_dir, "benchmark"), keep="_row")
        return tables.keep(materialize(found.filter("NOT contaminated").select("_row.*")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it, as many rows; one that it does not take, or that has no words, goes. Null is a source too."""
    mixed = mixing.mix(_whole(docs, "doc_id", "text", "source"), F.array("source"), keep=["_row"])
    times = F.expr("CASE WHEN size > 0 THEN cast(taken div size AS int) ELSE 0 END")
    return mixed.select("_row", F.explode(F.array_repeat(F.lit(1), times))).select("_row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns a row for each document read back from them; null texts are empty. Ties of doc_id are in no stated order."""
    return tokens.round_trip(docs, TOKENIZER, with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram join", near_duplicates),
    ("decontamination", benchmark_passages),
    ("mixing", mixture),
    ("token ids", token_ids),
]

#: Seeded selection and tokenisation are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        if k < len(STAGES) - 1:
            with Tables() as tables:  # what a stage has worked with goes once its result is written
                kept = stage(spark, docs, sf_dir)
                kept = tables.keep(kept if "working_path" in kept.__dict__ else materialize(kept))
            if k:
                discard(spark, docs.working_path)
            docs = kept
        else:
            docs = stage(spark, docs, sf_dir)
    return docs
