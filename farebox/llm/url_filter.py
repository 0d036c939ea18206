"""URL verdicts: written rules first, then the reputation of the host.

A page shows the document whose number follows the language in its path; where that document
is labelled, the page has an outcome: bad, if its quality is 0 or it is toxic. Outcomes are
summed by host, registered domain (the last two labels) and suffix (the last). Each level's
rate is a beta posterior. Its prior is centred on the level above, without the group's own
outcomes; its strength comes from how far groups differ beyond chance, and is no more than
the outcomes behind it. A host is blocked when the lower bound of
its bad rate is above ``BLOCK_ABOVE``; a host without outcomes has its domain's rate.

A host's labels and a path's beginnings are looked up in the table of rules by equal joins, so
there may be any number of rules. The rest is SQL, which runs on Spark and, as the check, on
DuckDB; there, rules are one long CASE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.common import stored

BLOCK_ABOVE = 0.5
DEVIATIONS = 1.645  # of the one-sided 95 % bound
STRONGEST = 1000.0  # prior strength where groups do not differ

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _by_rule(rules: list[Rule], give: str) -> str:
    """CASE over the rules, longest first; gives an attribute of the first that fits."""
    cases = []
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        below = "." + rule.host
        cases.append(
            f"WHEN (host = {_quoted(rule.host)} OR right(host, {len(below)}) = {_quoted(below)}) "
            f"AND left(path, {len(rule.path)}) = {_quoted(rule.path)} THEN {_quoted(getattr(rule, give))}"
        )
    return f"CASE {' '.join(cases)} END" if cases else "CAST(NULL AS VARCHAR(9))"


def parts_sql(pages: str) -> str:
    """Each page's host and path; both empty without an address."""
    return f"""
    SELECT page_id, host, path,
           CASE WHEN regexp_extract(host, '[^.]+[.][^.]+$', 0) <> ''
                THEN regexp_extract(host, '[^.]+[.][^.]+$', 0) ELSE host END AS domain,
           regexp_extract(host, '[^.]*$', 0) AS suffix,
           CASE WHEN length(regexp_extract(path, '^/[^/]*/([0-9]+)', 1)) BETWEEN 1 AND 18
                THEN CAST(regexp_extract(path, '^/[^/]*/([0-9]+)', 1) AS BIGINT) END AS shown_doc
    FROM (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM (
            SELECT page_id, CASE WHEN instr(url, '://') > 0
                                 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM {pages}
        ) AS cut
    ) AS addressed"""


def hosts_sql(parts: str, labels: str) -> str:
    """Outcomes by host: how many pages have one, and how many are bad."""
    return f"""
    SELECT host, domain, suffix, CAST(count(bad) AS DOUBLE) AS n, coalesce(sum(bad), 0.0) AS bad
    FROM {parts} AS shown LEFT JOIN (
        SELECT doc_id, CAST(max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS bad
        FROM {labels} WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
    ) AS outcome ON shown.shown_doc = outcome.doc_id
    GROUP BY host, domain, suffix"""


def _strength_sql(groups: str) -> str:
    """Prior strength from groups with n, bad and the mean expected of them."""
    return f"""
    SELECT CASE WHEN coalesce(between_groups, 0) <= 0 THEN {STRONGEST}
                ELSE least({STRONGEST}, greatest(1.0, chance / between_groups - 1)) END AS strength
    FROM (
        SELECT avg(mean * (1 - mean)) AS chance,
               (sum(n * (bad / n - mean) * (bad / n - mean)) - (count(*) - 1) * avg(mean * (1 - mean)))
               / nullif(sum(n) - sum(n * n) / sum(n), 0) AS between_groups
        FROM {groups} WHERE n > 0
    ) AS moments"""


def _prior_sql(group: str, above: str, name: str) -> str:
    """CTEs that give each group the mean and support of its prior: the level above without
    the group itself, so that nothing counts twice; and how strongly the prior holds it."""
    return f"""
    {name}_groups AS (
        SELECT g.*, (a.bad - g.bad + a.held * a.mean) / (a.n - g.n + a.held) AS mean, a.n - g.n + a.held AS support
        FROM {group} AS g JOIN {above} AS a ON g.above = a.name),
    {name}_strength AS ({_strength_sql(f"{name}_groups")}),
    {name}_level AS (
        SELECT name, n, bad, mean, least(support, (SELECT strength FROM {name}_strength)) AS held
        FROM {name}_groups)"""


def levels_sql(hosts: str) -> str:
    """The chain of priors from everything to suffix to domain to host, as CTEs."""
    return f"""
    suffixes AS (SELECT suffix AS name, '' AS above, sum(n) AS n, sum(bad) AS bad FROM {hosts} GROUP BY suffix),
    domains AS (
        SELECT domain AS name, suffix AS above, sum(n) AS n, sum(bad) AS bad FROM {hosts} GROUP BY suffix, domain),
    single_hosts AS (SELECT host AS name, domain AS above, n, bad FROM {hosts}),
    everything AS (
        SELECT '' AS name, sum(n) AS n, sum(bad) AS bad, CAST(0.5 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS held
        FROM {hosts}),
    {_prior_sql("suffixes", "everything", "suffix")},
    {_prior_sql("domains", "suffix_level", "domain")},
    {_prior_sql("single_hosts", "domain_level", "host")},
    posterior AS (
        SELECT name AS host, n + held AS total, (bad + held * mean) / (n + held) AS rate FROM host_level),
    reputation AS (
        SELECT host AS judged_host,
               rate - {DEVIATIONS} * sqrt(rate * (1 - rate) / (total + 1)) AS bad_bound FROM posterior)"""


def verdict_sql(matched: str) -> str:
    """Verdicts of pages with the rule that fits and what it says."""
    return f"""
    SELECT page_id, host, path, rule,
           CASE WHEN rule IS NOT NULL THEN ruled WHEN bad_bound > {BLOCK_ABOVE} THEN 'block' ELSE 'allow'
           END AS verdict
    FROM {matched} AS matched LEFT JOIN reputation ON host = judged_host"""


def by_rules(parts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``parts`` with the text of the longest rule that fits and its verdict, NULL without one.

    Every address is looked up once: each of its host's endings with each of its path's
    beginnings that are as long as some rule's path. Of rules of one length the first by text
    counts, and of equal ones the first given.
    """
    spark = parts.sparkSession
    if not rules:
        none = F.lit(None).cast("string")
        return parts.withColumns({"rule": none, "ruled": none})
    rows = [(r.host, r.path, -len(r.text), r.text, n, r.verdict) for n, r in enumerate(rules)]
    schema = "rule_host STRING, rule_path STRING, shorter INT, rule STRING, given INT, ruled STRING"
    table = spark.createDataFrame(rows, schema)
    lengths = F.array(*[F.lit(n) for n in sorted({len(r.path) for r in rules})])
    endings = F.expr("transform(sequence(1, size(split(host, '[.]'))), k -> substring_index(host, '.', -k))")
    beginnings = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    addresses = parts.select("host", "path").distinct().select("host", "path", F.explode(endings).alias("rule_host"))
    addresses = addresses.join(table.select("rule_host").distinct(), "rule_host", "left_semi")
    found = (
        addresses.select("host", "path", "rule_host", F.explode(beginnings).alias("rule_path"))
        .join(table, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(F.min(F.struct("shorter", "rule", "given", "ruled")).alias("best"))
        .select("host", "path", "best.rule", "best.ruled")
    )
    return parts.join(found, ["host", "path"], "left")


def judge_urls(spark: SparkSession, pages: DataFrame, labels: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, repeated rows included.

    A NULL address or one without ``://`` has an empty host and path, which no rule fits;
    it is judged as the empty host. Labels with NULL doc_id are not outcomes; of several
    labels of a document the worst counts. Without any outcome every rate is one half with
    a bound below it, so nothing is blocked but by rule. Only ``page_id`` and ``url`` of
    ``pages`` are read. The join by host is left to Spark, which splits a hot host.
    """
    parts = spark.sql(parts_sql("{pages}"), pages=pages.select("page_id", "url"))
    hosts = stored(
        spark.sql(hosts_sql("{parts}", "{labels}"), parts=parts, labels=labels), "host-outcomes"
    )
    text = f"WITH {levels_sql('{hosts}')} {verdict_sql('{matched}')}"
    return spark.sql(text, hosts=hosts, matched=by_rules(parts, rules))


def oracle(rules: list[Rule]) -> str:
    matched = f"SELECT *, {_by_rule(rules, 'text')} AS rule, {_by_rule(rules, 'verdict')} AS ruled FROM parts"
    return (
        f"WITH parts AS ({parts_sql('pages')}), hosts AS ({hosts_sql('parts', 'labels')}), "
        f"ruled_pages AS ({matched}), {levels_sql('hosts')} {verdict_sql('ruled_pages')}"
    )
