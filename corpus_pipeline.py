"""The corpus pipeline: documents by way of five operators to piece numbers.

``STAGES`` are applied in order, each to what its predecessor kept; all but the
last return the columns of documents. ``run`` writes every stage's result to the
shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stillframe.llm import decontaminate, language_id, sentencepiece_viterbi, simhash, substring
from stillframe.llm.common import Scratch, table

#: Long texts less like every known language than this are rejected, as are texts without letters; short ones need less (``language_id.reject``).
MIN_LANGUAGE_SCORE = 0.2


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.reject(docs, MIN_LANGUAGE_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; documents of which nothing is left go."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # by position, so that no column can clash with the operator's own
    at = dict(zip(docs.columns, names))
    text, n_chars = at["text"], at.get("n_chars")
    kept = substring.remove_repeats(docs.toDF(*names), at["doc_id"], text, layout=True, keep=[c for c in names if c != text])
    kept = kept.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).withColumn(text, F.col(f"{text}_kept"))
    if n_chars:
        kept = kept.withColumn(n_chars, F.when(F.col("n_removed") > 0, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(n_chars)))
    return kept.select(*names).toDF(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.encode(docs, ["doc_id"])


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("sentencepiece", pieces),
]

#: Fingerprints, trained prototypes and Viterbi searches are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs)
    return docs
