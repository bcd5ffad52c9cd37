"""The training-data operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import (
    compression,
    decontaminate,
    feistel,
    fuzzylines,
    hardnegatives,
    hosts,
    langmix,
    licenses,
    minhash,
    packing,
    phrases,
    repeats,
    tokenbin,
)
from .oracle import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

#: Session setting of the secret key of pseudonyms, and the key that stands in for it over the test tables, whose data are invented.
PSEUDONYM_KEY, TEST_KEY = "ordermill.pseudonym.key", "key of the test tables"

#: Rules of the URL query, fixed values.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_hyperminhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.classes(_table(spark, sf, "documents"))


def op2_host_reputation(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every page; a labelled page is bad if its text is toxic or of low quality."""
    pages = _table(spark, sf, "pages")
    labels = _table(spark, sf, "labels")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    labelled = pages.join(
        labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad")), "page_id"
    ).select("url", "bad")
    judged = hosts.judge(pages, labelled, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_language_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = langmix.identify(docs, langmix.fit_labelled(docs))
    return found.select("doc_id", langmix.held_out().alias("held_out"), "lang_pred", "score")


def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document written to token files and read back by the index."""
    folder = tokenbin.write(_table(spark, sf, "documents"), fresh_path(spark, "tokens"))
    read = tokenbin.checksums(spark, folder, tokenbin.keys_of(spark, folder))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_length_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"))


def op6_compression_bands(spark: SparkSession, sf: str) -> DataFrame:
    return compression.judge(_table(spark, sf, "documents"))


def op7_feistel_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    key = spark.conf.get(PSEUDONYM_KEY, TEST_KEY)
    done = feistel.pseudonymise(_table(spark, sf, "documents").select("doc_id", "text"), key)
    return done.select("doc_id", "n_replaced", "kinds", "text")


def op8_simhash_windows(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.drop("sum")


def op9_license_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents")).drop("matches")


def op10_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    done = fuzzylines.dedup(_table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", "text")


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; every seventh vector has a wrong label, the next one."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf, "embeddings").withColumn("label", wrong)
    return hardnegatives.mine(rows, F.col("vec_id") % 50 == 0)


def op12_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    done = repeats.dedup(_table(spark, sf, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    "op1_hyperminhash": op1_hyperminhash,
    "op2_host_reputation": op2_host_reputation,
    "op3_language_mixture": op3_language_mixture,
    "op4_token_files": op4_token_files,
    "op5_length_buckets": op5_length_buckets,
    "op6_compression_bands": op6_compression_bands,
    "op7_feistel_pseudonyms": op7_feistel_pseudonyms,
    "op8_simhash_windows": op8_simhash_windows,
    "op9_license_blocks": op9_license_blocks,
    "op10_fuzzy_lines": op10_fuzzy_lines,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_repeated_passages": op12_repeated_passages,
    "op13_phrases": op13_phrases,
}
