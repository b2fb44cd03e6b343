"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import decontaminate, divergence, encoding, langid, mixing, multiset, ngram_join, quality, suffix_dedup, tokens, toxicity, urlfilter, warc
from lamina.llm.shared import remainder, table

#: A public vocabulary; its path is a parameter of the operator.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, sf_dir, "documents"), with_text=False)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids, "contaminated")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", urlfilter.fetched(F.col("page_id")))
    out = urlfilter.judge(captures, urlfilter.stated_entries(pages))
    return out.select("page_id", F.col("fetched").cast("string").alias("fetched_on"), *urlfilter.RESULTS)


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, docs.filter(remainder(F.col("doc_id"), 3) != 1))
    return out.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", predicted)


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tokens.round_trip(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), F.array("source"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset.edited(table(spark, sf_dir, "documents"))


def op13_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode(*(table(spark, sf_dir, n) for n in ("sale_lines", "sales", "items", "vendors", "clients")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_decontaminate, op3_ngram_join, op4_url_filters, op5_langid, op6_toxicity, op7_tokens, op8_warc, op9_mixing, op10_quality, op11_divergence, op12_multiset, op13_encoding)}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": decontaminate.oracle_sql(), "op3_ngram_join": ngram_join.oracle_sql(), "op4_url_filters": urlfilter.oracle_sql(), "op8_warc": warc.oracle_sql(), "op10_quality": quality.oracle_sql(), "op11_divergence": divergence.oracle_sql(), "op13_encoding": encoding.oracle_sql()}
