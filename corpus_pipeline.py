"""From raw documents to a filtered, de-duplicated and encoded corpus."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import bpe, decontaminate, jaccard, quality, toxicity
from farebox.llm.common import free_name, in_fold, prepare, stored, table

WORD_BPE = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay; so does an empty text."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), in_fold("doc_id", 4, 2))
    return docs.where(toxicity.toxicity("text", model, docs) < toxicity.THRESHOLD)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or above the threshold stay."""
    prepare(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), in_fold("doc_id", 5, 0))
    return docs.where(quality.quality("text", model, docs) >= quality.THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    prepare(spark)
    return jaccard.one_of_each(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item stay."""
    prepare(spark)
    return docs.where(~decontaminate.has_leak("text", table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, how many, and the text they decode to, beside doc_id, lang and source."""
    prepare(spark)
    coded = free_name(docs, "coded")
    named = docs.select(
        "doc_id", "lang", "source", bpe.bpe_codec("text", public_tokenizers.path(WORD_BPE)).alias(coded)
    )
    return named.select("doc_id", "lang", "source", f"{coded}.*").withColumn(
        "n_tokens", F.size("ids").cast("bigint")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_leaked),
    ("BPE encoding and decoding", encode),
]

# Models are trained and texts encoded on the way, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
