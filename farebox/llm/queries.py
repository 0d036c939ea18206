"""The queries over the given tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import (
    ann,
    bpe,
    decontaminate,
    divergence,
    html_extract,
    jaccard,
    lm,
    quality,
    simhash,
    token_count,
    toxicity,
    url_filter,
    vector_codes,
)
from farebox.llm.common import in_fold, prepare, table

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = "word_bpe_49k.json"
TOKEN_LIMIT = 2048

# The rules of the URL query.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html_extract.main_text("html", html_extract.fit(pages), pages).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.bpe_digests("text", path).alias("made"))
    return docs.select("doc_id", "made.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 4, 2)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity("text", model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return url_filter.judge_urls(spark, pages, labels, URL_RULES)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"), in_fold("doc_id", 7, 2))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 5, 0)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.quality("text", model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        token_count.token_count("text", public_tokenizers.path(WORD_BPE)).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.code_vectors(table(spark, sf_dir, "embeddings"))
    coded = vector_codes.with_label_errors(coded).drop("label")
    return coded.withColumn("codebooks_sha256", F.lit(vector_codes.fingerprint(books)))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    printed = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", printed, "component_id")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {
    "op1_html_extract": op1_html_extract,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_toxicity": op3_toxicity,
    "op4_url_filter": op4_url_filter,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_lm_score": op6_lm_score,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_count": op9_token_count,
    "op10_ann": op10_ann,
    "op11_vector_codes": op11_vector_codes,
    "op12_simhash": op12_simhash,
    "op13_source_divergence": op13_source_divergence,
}


def queries() -> dict[str, Query]:
    return {name: _prepared(query) for name, query in QUERIES.items()}
