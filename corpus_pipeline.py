"""A training-data pipeline over ``documents``: five stages, each written as Parquet and reread.

quality rules -> SimHash near-dedup -> suffix-array dedup -> benchmark decontamination ->
SentencePiece encoding and decoding.  Each stage takes all that its predecessor kept; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, quality, sentencepiece_bpe, simhash, suffix_dedup
from quire.llm.common import shared_path, table
from quire.session import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' label model rejects go."""
    ship_package(spark)
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the least doc_id."""
    ship_package(spark)
    return simhash.keep_one_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes go from the texts; n_chars follows.

    Documents that lose nothing stay as they are, nulls included.
    """
    ship_package(spark)
    cut = suffix_dedup.remove_repeats(docs)
    found = F.col(cut.columns[-1])
    text = F.when(found["n_removed"] == 0, F.col("text")).otherwise(found["kept"])
    cut = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.when(found["n_removed"] == 0, F.col("n_chars")).otherwise(F.char_length("text").cast(kind))
        cut = cut.withColumn("n_chars", size)
    return cut.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a shorter item whole) go."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    ship_package(spark)
    return sentencepiece_bpe.encode_digests(docs, str(public_tokenizers.path("piece_bpe_32k.model")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: The stages' label model, suffix arrays and BPE agenda are beyond SQL; tests hold them
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {"pipeline": (run, ORACLE_SQL)}
