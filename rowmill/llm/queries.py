"""The registered queries of the operators, on whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import (
    alignment, decontaminate, language, licences, minhash, mixing, packing, pii, ranked_search, secrets, toxicity, url_trust, vectors,
)
from rowmill.plans.storage import shared_folder

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_trust.judge(table(spark, sf, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    columns = "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    return packing.pack(docs).select(*columns)


@query
def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op4_near_documents(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_documents(table(spark, sf, "documents"))


@query
def op5_licences(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return licences.report(licences.find_licences(docs))


@query
def op6_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf, "embeddings"))


@query
def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.find_hits(docs, table(spark, sf, "benchmark")))


@query
def op8_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.report(pii.find(docs, pii.fit(docs)))


@query
def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ledger = f"{shared_folder(spark)}/rowmill/ledger-{uuid.uuid4().hex}"
    # A first scan with the base rules; the second runs what the ledger lacks.
    secrets.scan_new(docs, ledger, rules=secrets.BASE_RULES)
    return secrets.report(secrets.scan_versions(docs, ledger))


# The chain's order: texts of low quality first, then toxic ones.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


@query
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, table(spark, sf, "labels"), CATEGORIES)
    found = toxicity.predict(docs, chain)
    return found.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


@query
def op11_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op12_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    found = alignment.linked(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ranked_search.search(docs, table(spark, sf, "benchmark"))
