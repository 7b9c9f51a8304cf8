"""From documents to packed training sequences.

Language ID drops documents of no language, SimHash near-duplicates leave one of
each group, documents with benchmark passages go, personal data is replaced, and
what is left is packed. Every stage is a function of (spark, docs, sf_dir); all but the
last return the columns of ``documents``. No stage looks at columns beyond doc_id, text and
lang, and each passes the others on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.llm import decontaminate, language, packing, pii, simhash
from carepulse.llm.batches import keep

CAPACITY, END = 2048, 0
#: What the weakest machine that a language has won must say of it; 0.5 says nothing.
LEAST_SCORE = 0.51
TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned: null texts, texts without any letter and those that the
    machines can't tell (a score below LEAST_SCORE) go. A document without ``lang`` gets the one found."""
    known = docs.where(F.col("lang").isNotNull()).select(F.col("doc_id").alias("id"), F.col("lang").alias("label"))
    return language.accepted(docs, language.train(known, docs), least_score=LEAST_SCORE, fill="lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of fingerprints linked at two bits or fewer."""
    return simhash.deduplicate(docs, words=3, bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: pieces of documents with their ids, places and sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), CAPACITY, END)


STAGES = [
    ("language ID", language_id),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", packed),
]

#: No stage can be written in SQL (models, token ids); tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
