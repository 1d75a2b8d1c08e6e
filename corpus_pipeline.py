"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``docs`` is that Parquet table. All
but the last return the columns of documents; the last returns a row for each document with its token ids in place of
the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tejado.llm import bpe, line_templates, quality_rules, simhash, source_mix
from tejado.llm.common import few_files, read_table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules, learned from the labels: documents that fail the base or that a rule fires on go."""
    return quality_rules.good_documents(docs, quality_rules.learn(docs, read_table(spark, sf_dir, "labels")))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines of recurring templates go from all documents but the first, and so do documents left empty."""
    kept = few_files(line_templates.without_recurring_lines(docs))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup over 3-word shingles, 2 bits: of each group the document of the smallest id stays."""
    return few_files(simhash.one_of_each(docs, length=3, distance=2))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents as often as the mix takes them."""
    return source_mix.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token ids, their number and digest, and the digest of the text they decode to."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_recurring_lines),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: XXH64 fingerprints, BPE ids and learned rules have no SQL form; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
