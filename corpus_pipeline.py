"""From raw documents to training tokens: each stage calls one operator of skein.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents:

1. quality: documents that the classifier rejects go (network and word vectors come from
   ``documents`` and ``labels``, the decision from each document's own text);
2. near_duplicates: of every component of similar documents the one with the smallest
   id stays (documents without words are in no component and stay);
3. repeats: the bytes that repeated strings of REPEAT_BYTES bytes cover go, and a character of which a
   byte goes; a document that loses its whole text goes;
4. decontamination: documents that overlap with a benchmark item go;
5. tokens: the ids of every remaining text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import bpe, decontaminate, ngram_jaccard, quality, suffix_dedup
from skein.session import materialize
from skein.sources.tables import read_table


#: a passage of 50 words has some 300 bytes in these languages; shorter strings repeat in idioms and formulas, too
REPEAT_BYTES = 240


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.classify(docs, read_table(spark, sf_dir, "labels"), out="__score")
    return scored.filter("__score >= 0.5").drop("__score")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.deduplicate(docs, words=5, percent=80)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Untouched rows stay as they are, null and empty texts included."""
    done = suffix_dedup.remove_repeats(docs.withColumn("__text", F.col("text")), "__text", REPEAT_BYTES, as_text=True)
    cut = F.size("removed") > 0
    done = done.filter(~cut | (F.length("kept") > 0))
    return done.withColumn("text", F.when(cut, F.col("kept")).otherwise(F.col("text"))).withColumn(
        "n_chars", F.when(cut, F.length("kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text."""
    done = bpe.encode_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: the classifier, the joins' hashing and the encoder are not expressible in SQL; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
