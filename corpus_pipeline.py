"""The corpus pipeline: toxicity, language ID, near-duplicates, benchmark decontamination, packing.

Every stage works on all that its predecessor kept, is written as Parquet and read again. All but the last return the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from biblioflow.llm import common, decontam, langid, packing, simhash, toxicity
from biblioflow.llm.queries import language_network, toxicity_model

#: A document whose pooled probability is not this far from chance (0) to certainty (1) is of no language that was learned.
LANGUAGE_MARGIN = 0.2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the labels of held-out rows are not used.

    Null and empty texts have the score of no features, so they stay if that is below it; repeated rows are judged each;
    an empty table, or one without labelled rows, loses nothing; columns of any other name stay as they are.
    """
    return toxicity.reject_toxic(docs, toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: not ``und``, and LANGUAGE_MARGIN or more above chance.

    Null texts and those without a letter go; where no language can be learned all go; repeated rows are judged each;
    an empty table stays empty; columns of any other name (also lang_pred and score) stay as they are.
    """
    return langid.reject_unknown(docs, language_network(docs), margin=LANGUAGE_MARGIN)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8): that of the smallest doc_id.

    Texts without words are copies of one another, null or not; rows are told apart by all their columns, so a null or
    shared doc_id takes no other text along; of rows alike in every column one stays; an empty table stays empty.
    """
    return simhash.deduplicate(docs, words=5, least=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than a twentieth of the words lie in benchmark windows.

    Null and empty texts have no words and stay; each row is judged by its own text, whatever rows share its doc_id; an empty
    table, or an empty benchmark, loses nothing; columns of any other name stay as they are.
    """
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences of 1024 tokens.

    A null or empty text is the end id alone; repeated rows are packed each; an empty table gives no pieces; columns
    besides doc_id and text are left aside.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: Trained models and tokenizers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.table(stage(spark, docs, sf_dir), name)
    return docs
