"""From raw documents to encoded training data, one stored stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import crc_share, documents, stored
from tidewell.llm.exact import without_copies
from tidewell.llm.langid import identify, train
from tidewell.llm.mixing import mixed_documents
from tidewell.llm.pieces import encode_documents, load_vocabulary
from tidewell.llm.queries import VOCABULARY
from tidewell.llm.simhash import without_near_copies


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents go that have no letter or lie far from every language that the labelled ones teach."""
    learned = train(docs.filter(crc_share(F.col("doc_id"), 3) != 1))
    return identify(docs, learned).filter(~F.col("rejected")).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each text stays, the one with the largest doc_id."""
    return without_copies(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest doc_id stays."""
    return without_near_copies(docs, shingle=4, radius=4)


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources come near their target weights; a document is there as often as the mix takes it."""
    return mixed_documents(docs, weights=(5, 2, 1), share=1.0, most=3.0)


def sentencepiece(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids and n_ids of every document; a document that the mix takes twice is encoded twice."""
    vocabulary = load_vocabulary(VOCABULARY, kind="bpe")
    return encode_documents(docs, vocabulary).select("doc_id", "ids", F.size("ids").alias("n_ids"))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("SentencePiece", sentencepiece),
]

# Hashed keys, language models and tokenisation have no SQL form; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the whole documents table; each result is stored as Parquet and read again."""
    docs = documents(spark, folder)
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if position < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
