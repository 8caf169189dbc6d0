"""The registered queries over the whole documents table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.collocations import collocations
from tidewell.llm.common import crc_share, documents
from tidewell.llm.exact import exact_groups
from tidewell.llm.katz import score_documents
from tidewell.llm.langid import identify, train
from tidewell.llm.lines import dedup_lines
from tidewell.llm.mixing import mix_sources
from tidewell.llm.pieces import encode_documents, load_vocabulary
from tidewell.llm.postings import contamination
from tidewell.llm.prefixes import prefix_nodes
from tidewell.llm.quality import quality_verdicts
from tidewell.llm.repeats import remove_repeats
from tidewell.llm.sharding import shard_documents
from tidewell.llm.simhash import near_groups

# A public SentencePiece model; the operators take any path.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return near_groups(documents(spark, folder), shingle=4, radius=4).select(
        "doc_id", hexed.alias("fingerprint"), "component_id")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = documents(spark, folder), crc_share(F.col("doc_id"), 3) == 1
    return identify(docs, train(docs.filter(~held_out)), carry=False).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected", "bits")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(documents(spark, folder), min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(documents(spark, folder), weights=(5, 2, 1), share=1.0, most=3.0).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it (a literal vocabulary mark reads as a space)."""
    vocabulary = load_vocabulary(VOCABULARY, kind="bpe")
    # A hash of the text to come back goes with the id, so that the text itself need not.
    expected = F.xxhash64(F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" ")))
    docs = documents(spark, folder).select(F.struct("doc_id", expected.alias("expected")).alias("doc"), "text")
    decoded = encode_documents(docs, vocabulary, keep="doc", decode=True)
    return decoded.select(
        "doc.doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        (F.xxhash64("decoded") == F.col("doc.expected")).alias("round_trip"))


def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(documents(spark, folder).withColumn("held_out", crc_share(F.col("doc_id"), 5) == 1))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder), keep="largest")


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(documents(spark, folder), limit=32 << 20)


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(documents(spark, folder), window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_nodes(spark.read.parquet(f"{folder}/conversations.parquet"), group=5, shares=9)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(documents(spark, folder), least=100, longest=5, top=2000)


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contamination(documents(spark, folder), items, window=10).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


LLM_QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_source_mix": op4_source_mix,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sharding": op9_sharding,
    "op10_repeats": op10_repeats,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_collocations": op12_collocations,
    "op13_decontamination": op13_decontamination,
}
