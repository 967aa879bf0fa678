"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all that the one before
kept. `run` writes each result as parquet in the shared folder and reads it back as the next one's docs.
All stages but the last return the columns of documents, whatever they are called: those that a stage does
not work on travel beside the operator's own results, so names that clash are not overwritten.

Every stage takes an empty table, NULLs in any column, texts of any length and rows that repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import decontaminate, language, minhash, packing, pii
from rowmill.plans.storage import materialise

# Near copies share at least this much of their shingles of five words.
SHINGLE, PERCENT = 5, 80


def boxed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a struct of all other columns."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(True).alias("_there")).alias("_rest"))


def unboxed(found: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of docs again, in their order, but for those that changed."""
    own = {c: F.col(c) if c in ("doc_id", "text") else F.col("_rest").getField(c) for c in docs.columns}
    return found.select(*[(own | changed)[c].alias(c) for c in docs.columns])


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified.

    Texts that are NULL, empty or without letters go, and so do those whose nearest two languages are
    too close to tell apart. Rows that repeat are judged alike; a NULL doc_id or lang changes nothing but
    what is learned from.
    """
    found = language.identify(boxed(docs), language.fit(docs))
    return unboxed(found.where((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")), docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the first by doc_id (NULL last), then by content.

    Documents are told apart by id and text, so different texts under one id are judged each on their own,
    and of rows with the same id and text one stays. Texts without words are copies of nothing; all stay.
    """
    keys = "_key_1", "_key_2"
    named = boxed(docs).select(
        "*", F.xxhash64("doc_id", "text").alias(keys[0]), F.xxhash64(F.lit(1), "text", "doc_id").alias(keys[1])
    )
    groups = minhash.near_groups(named, shingle=SHINGLE, percent=PERCENT, carried=keys)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *keys)).alias("first")
    kept = materialise(groups.where("component IS NOT NULL").groupBy("component").agg(first).select("first.*"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Repeated rows first, so that the join sees each once.
    worded = named.where(has_words).dropDuplicates(list(keys)).join(kept.select(*keys), list(keys), "left_semi")
    return unboxed(worded.drop(*keys).unionByName(named.where(~has_words).drop(*keys)), docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; without text or items nothing is held."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return unboxed(decontaminate.decontaminate(boxed(docs), items), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks; n_chars follows the text.

    A NULL text stays NULL, and so does its n_chars.
    """
    found = pii.find(boxed(docs), pii.fit(docs), redact=True)
    changed = {}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return unboxed(found, docs, **changed)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of tokens.

    A NULL or empty text is one ending token; rows that repeat are packed each; no rows, no sequences.
    """
    columns = "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    return packing.pack(docs).select(*columns)


STAGES = [
    ("language identification", in_a_language),
    ("near-duplicate removal", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("personal data", without_personal_data),
    ("best-fit packing", packed),
]

# Language identification and personal data are trained models, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
