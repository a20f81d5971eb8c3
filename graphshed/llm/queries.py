"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphshed.llm import decontaminate, merkle, packing, pii, resample, secrets, setjoin, toxicity, urls, warc
from graphshed.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.sample(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(), capacity=1024, end_id=2, added_tokens=True)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.join(table(spark, sf_dir, "documents", "doc_id", "text"), words=3, percent=90)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents", "doc_id", "text")))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


#: The list rules.
URL_RULES = urls.rules(("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.report(table(spark, sf_dir, "documents", "doc_id", "text")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_importance_resampling, op2_best_fit_packing, op3_ngram_jaccard_join, op4_pii, op5_benchmark_decontamination, op6_url_filters, op7_secret_scans, op8_warc, op9_toxicity, op10_document_fingerprints)}
