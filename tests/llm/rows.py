"""Documents with everything that can be odd about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Columns that operators also use the names of, for their own ends.
CLASHING = ("row", "key", "n", "label", "score", "component", "ids", "terms", "shingle", "rank", "stays", "place")

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))
ODD_TEXTS = [None, "", "   \n\t ", "one", "a b c d", "a b c d e", "A B C D E", LONG, "é" * 3000, "x" * 5000, "\x00 \x1c ​"]


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    """Rows of (doc_id, text), and perhaps many more columns."""
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    if clashing:
        docs = docs.selectExpr("*", *[f"'mine' AS {name}" for name in CLASHING])
    return docs


def odd_documents(spark: SparkSession) -> DataFrame:
    """Odd texts, the last ids NULL, and the whole twice over, with clashing columns."""
    rows = [(i if i < 9 else None, text) for i, text in enumerate(ODD_TEXTS)]
    return documents(spark, rows * 2, clashing=True)


def no_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, [])


def labels(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")
