"""The registered queries of this package and their DuckDB SQL (None where SQL can't express them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tejado.llm import (bpe, exact_dedup, line_templates, passage_dedup, phrases, quality_rules, simhash, source_mix, suffix_dedup, token_counts,
                        toxicity, url_boost, vector_codes)
from tejado.llm.common import few_files, read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = line_templates.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return few_files(df).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_boost.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few_files(simhash.near_duplicates(documents(spark, sf_dir), length=3, distance=2))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                with_ids=False)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rules = quality_rules.learn(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules)[0].drop("text")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few_files(exact_dedup.exact_duplicates(documents(spark, sf_dir)))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = suffix_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"), span=50)
    return few_files(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return toxicity.scores(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few_files(passage_dedup.passage_classes(documents(spark, sf_dir).select("doc_id", "text"), words=50, similarity=0.8, size=5))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir), longest=3, min_count=10, contained=50, top=2000)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return vector_codes.encode_vectors(vectors, vector="embedding", parts=8, entries=16, rounds=6)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_quality_rules": (op1_quality_rules, None),
    "op2_exact_dedup": (op2_exact_dedup, exact_dedup.SQL),
    "op3_source_mix": (op3_source_mix, source_mix.SQL),
    "op4_line_dedup": (op4_line_dedup, line_templates.SQL),
    "op5_url_filter": (op5_url_filter, None),
    "op6_simhash": (op6_simhash, None),
    "op7_byte_bpe": (op7_byte_bpe, None),
    "op8_substring_dedup": (op8_substring_dedup, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_passage_dedup": (op10_passage_dedup, None),
    "op11_phrases": (op11_phrases, phrases.SQL),
    "op12_vector_codes": (op12_vector_codes, vector_codes.SQL),
    "op13_token_counts": (op13_token_counts, None),
}
