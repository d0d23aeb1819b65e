"""The operators as registered queries, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import divergence, filter_audit, mixing, perspectives, substring_dedup, vector_codes
from mercato.llm.common import read

QUERIES = {}
ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.oracle_sql(),
    "op2_quality_divergence": divergence.oracle_sql(),
    "op6_perspectives": perspectives.oracle_sql(),
    "op7_substring_dedup": substring_dedup.oracle_sql(),
    "op11_filter_audit": filter_audit.oracle_sql(),
    "op12_vector_codes": vector_codes.oracle_sql(),
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.chunk_fingerprint import fingerprint_with_next

    return fingerprint_with_next(read(spark, sf_dir, "documents"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.langid import identify

    return identify(read(spark, sf_dir, "documents"))


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.bpe import encode_documents

    return encode_documents(read(spark, sf_dir, "documents"), word_vocabulary())


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.length("text").cast("long").alias("n_chars"), F.col("_copies").alias("copies"), F.col("_copy").alias("copy"), F.col("_place").alias("place"), "text")


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from mercato.llm.simhash_cover import near_duplicates

    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query
def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(read(spark, sf_dir, "documents"))


@query
def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(read(spark, sf_dir, "conversations"))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.secret_scan import summary

    return summary(read(spark, sf_dir, "documents"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.drop_repeated_substrings(read(spark, sf_dir, "documents"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from mercato.llm.line_dedup import drop_repeated_lines

    done = drop_repeated_lines(read(spark, sf_dir, "documents"), counts=True)
    return done.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), "n_chars", "text")


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.summary(read(spark, sf_dir, "embeddings"))


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from mercato.llm.license_scan import summary

    return summary(read(spark, sf_dir, "documents"))
