"""From raw documents to packed token sequences: the stages of the corpus pipeline.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import decontaminate, lines, packing, simhash, toxicity
from daybook.llm.common import materialize, table
from daybook.llm.tokens import vocabulary_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that over a fifth of a source's documents hold; n_chars follows."""
    kept = lines.drop_boilerplate(docs, F.col("source"), ratio=0.2, min_pages=5)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths of a benchmark item's shingles go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences whose lengths are powers of two."""
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"), max_length=1024, end_id=0)


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", boilerplate_lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("packing", packed_sequences),
]

#: A trained model, shingle hashes and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
