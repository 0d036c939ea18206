"""Which sources of a language write unlike its other sources, and in which terms.

Terms are counted by language and source. What a term adds to a divergence depends on two
counts alone, so terms are gathered into cells of equal counts, and the divergence is worked
out once per cell, in whole numbers:

* a source against its language: cells (count in the source, count in the language). Their
  values are ranked, cells of equal value merged, and a running sum of the number of their
  terms says which values reach the ranks that are shown. Only their terms are listed.
* a source against another: terms with the same counts in all sources are one row with a
  multiplicity. Of it come the cells (count in one, count in the other) where both are above
  zero; cells with a zero follow from how many terms each source has of every count.

Edge cases: a NULL text, language or source is an empty one. A group (language, source) whose
texts are all without terms has counts of zero. A language without kept terms has pairs of
value 0 and no terms. A language with one source has no pairs. Copies of a row count as often
as they occur, as occurrences and as documents. Other columns are not read. No documents give
no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import over_batches, stored

# What a term is, least documents of a term, scale of shares, ranks shown.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
SHOWN = 200

IS_TERM = re.compile(TERM)
WHOLE = "decimal(38,0)"
FITS = 9_000_000_000  # counts below it times SCALE fit 64 bits


def share(count: Column, total: Column, terms: Column) -> Column:
    """A smoothed share of a term in parts of ``SCALE``, from one on; exact for any count."""
    wide = F.call_function(
        "div", F.lit(SCALE).cast(WHOLE) * (count.cast("decimal(19,0)") + F.lit(1)), (total + terms).cast(WHOLE)
    )
    narrow = F.call_function("div", F.lit(SCALE) * (count + F.lit(1)), total + terms)
    return F.lit(1) + F.when(count < F.lit(FITS), narrow).otherwise(wide)


def gap(p: Column, q: Column) -> Column:
    """The whole part of (p - q)^2 / q; shares are at most ``SCALE`` + 1, so squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _named(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")]


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row for every distinct term of every document, with how often it has it."""
    terms: list[str] = []
    counts: list[int] = []
    sizes = []
    for text in pc.ascii_lower(batch.column("text")).to_pylist():
        found = Counter(IS_TERM.findall(text))
        terms.extend(found)
        counts.extend(found.values())
        sizes.append(len(found))
    row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    columns = [batch.column("lang").take(row), batch.column("source").take(row)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(terms, pa.string()), pa.array(counts, pa.int64())], ["lang", "source", "term", "n"]
    )


def kept_terms(docs: DataFrame) -> DataFrame:
    """(lang, term, total, counts): terms in enough documents of their language, with their
    occurrences in all and per source, the latter sorted by source."""
    read = docs.select(*_named(docs), F.coalesce("text", F.lit("")).alias("text"))
    found = read.mapInArrow(over_batches(_counted), "lang string, source string, term string, n bigint")
    by_source = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.count("*").alias("documents"))
    return (
        by_source.groupBy("lang", "term")
        .agg(
            F.sum("documents").alias("documents"),
            F.sum("n").alias("total"),
            F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"),
        )
        .where(F.col("documents") >= LEAST_DOCUMENTS)
        .select("lang", "term", "total", "counts")
    )


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, v, lang_n, n): every group, with its language's number of kept terms and of
    their occurrences, and its own number of them."""
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sums = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    return (
        docs.select(*_named(docs))
        .distinct()
        .join(langs, "lang", "left")
        .join(sums, ["lang", "source"], "left")
        .fillna(0, ["v", "lang_n", "n"])
    )


def _against_language(kept: DataFrame, groups: DataFrame, shown: int) -> DataFrame:
    """The terms a source has more of than its language, the first ``shown`` by value."""
    # Nothing of them varies within a cell but the term itself.
    uses = kept.select("lang", "term", "total", F.inline("counts")).withColumnRenamed("n", "count")
    cells = uses.groupBy("lang", "source", "count", "total").agg(F.count("*").alias("terms"))
    p = share(F.col("count"), F.col("n"), F.col("v"))
    q = share(F.col("total"), F.col("lang_n"), F.col("v"))
    valued = (
        cells.join(groups, ["lang", "source"])
        .select("lang", "source", "count", "total", "terms", p.alias("p"), q.alias("q"))
        .where("p > q")
        .withColumn("value", gap(F.col("p"), F.col("q")))
    )
    # Every value has a term at least, so no more values than ranks are wanted.
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = (
        valued.groupBy("lang", "source", "value")
        .agg(F.sum("terms").alias("terms"))
        .withColumn("place", F.row_number().over(group))
        .where(F.col("place") <= shown)
        .withColumn("before", F.sum("terms").over(group) - F.col("terms"))
        .where(F.col("before") < shown)
        .select("lang", "source", "value", "before")
    )
    wanted = valued.select("lang", "source", "count", "total", "value").join(
        values, ["lang", "source", "value"]
    )
    alike = Window.partitionBy("lang", "source", "value", "before").orderBy("item")
    return (
        uses.withColumnRenamed("term", "item")
        .join(wanted, ["lang", "source", "count", "total"])
        .withColumn("among", F.row_number().over(alike))
        .where(F.col("among") <= shown)
        .withColumn("rank", F.col("before") + F.col("among"))
        .where(F.col("rank") <= shown)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int"))
    )


def _between_sources(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source against every other of its language, all terms summed."""
    alike = kept.groupBy("lang", "counts").agg(F.count("*").alias("terms"))
    one = F.inline("counts").alias("source", "own")
    both = (
        alike.select("lang", "counts", "terms", one)
        .select("lang", "terms", "source", "own", F.inline("counts").alias("item", "other"))
        .where("source < item")
        .groupBy("lang", "source", "item", "own", "other")
        .agg(F.sum("terms").alias("terms"))
    )
    # Each cell tells of the one source against the other, and the other way round.
    ways = [("source", "item", "own", "other"), ("item", "source", "other", "own")]
    both = both.select(
        "lang", "terms",
        F.inline(F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(way, ways[0])]) for way in ways])),
    )
    marginal = alike.select("lang", "terms", one).groupBy("lang", "source", "own").agg(F.sum("terms").alias("terms"))

    this = groups.select("lang", "source", "v", F.col("n").alias("own_n"))
    that = groups.select("lang", F.col("source").alias("item"), F.col("n").alias("other_n"))
    pairs = this.join(that, "lang").where("source <> item")

    def value(own: Column, other: Column) -> Column:
        return gap(share(own, F.col("own_n"), F.col("v")), share(other, F.col("other_n"), F.col("v")))

    zero = F.lit(0).cast("bigint")
    own, other, terms = F.col("own"), F.col("other"), F.col("terms").cast("decimal(19,0)")
    # Where both have a term, it was counted as if the other had none, twice, and as if none had it.
    shared = both.join(pairs, ["lang", "source", "item"]).select(
        "lang", "source", "item",
        (terms * (value(own, other) - value(own, zero) - value(zero, other) + value(zero, zero))).alias("value"),
    )
    mine = marginal.join(pairs, ["lang", "source"]).select(
        "lang", "source", "item", (terms * (value(own, zero) - value(zero, zero))).alias("value")
    )
    theirs = (
        marginal.toDF("lang", "item", "other", "terms")
        .join(pairs, ["lang", "item"])
        .select("lang", "source", "item", (terms * (value(zero, other) - value(zero, zero))).alias("value"))
    )
    neither = pairs.select(
        "lang", "source", "item",
        F.when(F.col("v") > 0, F.col("v").cast("decimal(19,0)") * value(zero, zero)).otherwise(0).alias("value"),
    )
    parts = [part.withColumn("value", F.col("value").cast(WHOLE)) for part in (shared, mine, theirs, neither)]
    summed = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    summed = summed.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def source_divergence(docs: DataFrame, shown: int = SHOWN) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources of the
    language, part ``term`` the ``shown`` first terms that the source has more of than its
    language, by falling value and rising item, as bytes of UTF-8."""
    kept = stored(kept_terms(docs), "kept-terms")
    groups = stored(_groups(docs, kept), "term-groups")
    return _between_sources(kept, groups).unionByName(_against_language(kept, groups, shown))


def oracle() -> str:
    """The same as DuckDB SQL, term by term."""
    letters = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
    return f"""
    WITH read AS (
        SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all({letters}, '{TERM}') AS terms FROM documents),
    uses AS (SELECT d, lang, source, unnest(terms) AS term FROM read),
    kept AS (
        SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM uses GROUP BY ALL
        HAVING count(DISTINCT d) >= {LEAST_DOCUMENTS}),
    langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM read),
    counts AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM uses GROUP BY ALL),
    filled AS (
        SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n
        FROM groups g JOIN kept k ON g.lang = k.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    sums AS (SELECT lang, source, sum(n) AS group_n FROM filled GROUP BY ALL),
    shares AS (
        SELECT f.lang, f.source, f.term, f.n,
               1 + CAST({SCALE} AS HUGEINT) * (f.n + 1) // CAST(s.group_n + l.v AS HUGEINT) AS p,
               1 + CAST({SCALE} AS HUGEINT) * (f.total + 1) // CAST(l.lang_n + l.v AS HUGEINT) AS q
        FROM filled f JOIN sums s ON f.lang = s.lang AND f.source = s.source JOIN langs l ON f.lang = l.lang),
    gaps AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(g.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source),
    found AS (
        SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
    ranked AS (
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
        FROM found)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= {SHOWN}"""
