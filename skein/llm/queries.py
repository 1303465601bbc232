"""The registered queries of the operators and of the pipeline, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import (
    ann, bpe, collocations, decontaminate, hard_negatives, html_extract, licenses, ngram_jaccard, oracles, quality, sharding, suffix_dedup,
    token_counts, urlfilter,
)
from skein.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by the rank file, and the bytes they decode to, as digests."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded="decoded")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text by the tokenizer file."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return done.withColumn("over_limit", F.col("n_tokens") > 1024)


#: (host/path prefix, verdict) of the URL query
URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


@_query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the longest fitting rule's, else the model's."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, URL_RULES, urlfilter.train(spark))


@_query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over 16 equal shards by their id, and where they go with one shard more."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard_documents(docs, [1.0] * 16, [1.0] * 17)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@_query
def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@_query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 5-word shingle similarity 0.8 or more."""
    return ngram_jaccard.jaccard_components(read_table(spark, sf_dir, "documents"), words=5, percent=80)


@_query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every whole text without the bytes that repeated 400-byte strings cover."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeats(docs, length=400)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", (F.octet_length("kept") + gone).cast("long").alias("n_bytes"), gone.alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) that overlap in 13 words but for two substitutions."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out third."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    done = quality.classify(docs, read_table(spark, sf_dir, "labels"))
    return done.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by a field trained on laid-out pages."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    done = html_extract.extract_pages(pages, html_extract.train())
    return done.withColumn("n_chars", F.length("text").cast("long"))


#: phrases of the licence query and their labels
LICENSE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


@_query
def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every whole text."""
    return licenses.license_report(read_table(spark, sf_dir, "documents"), LICENSE_PHRASES)


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 most cohesive phrases of 2 to 4 words of each language."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"), support=30, top=2000, percent=80)


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives of each of the five positives of every vector whose id is divisible by 100."""
    rows = read_table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine_negatives(rows, F.col("vec_id") % 100 == 0, k=5, low=80, high=100)


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline over the whole documents."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

ORACLE_SQL |= {"op1_ngram_jaccard": oracles.OP1, "op3_decontaminate": oracles.OP3, "op8_suffix_dedup": oracles.OP8, "op9_ann": oracles.OP9,
               "op12_collocations": oracles.OP12, "op13_hard_negatives": oracles.OP13}
