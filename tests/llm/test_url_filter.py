"""URL verdicts: the same SQL in DuckDB, edge addresses, and rates worked out by hand."""

import random

import duckdb
import pytest

from farebox.llm import oracle, queries, url_filter
from oracle_compare import connect, difference


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_duckdb(session, sf):
    folder = f"/root/testdata/{sf}"
    ours = queries.queries()["op4_url_filter"](session, folder).toPandas()
    assert difference(ours, connect(folder).execute(oracle.oracle_sql()["op4_url_filter"]).df()) == ""


ADDRESSES = [
    (1, "http://A.Example.ORG/es/1?x#y", ("a.example.org", "/es/1", "example.org/es/", "block")),
    (2, "https://example.org/en/12", ("example.org", "/en/12", "example.org/en/1", "block")),
    (3, "https://notexample.org/es/", ("notexample.org", "/es/", "org/", "allow")),
    (4, "x://org", ("org", "", None, "allow")),
    (5, "ftp://shop.com/fr/a://b", ("shop.com", "/fr/a://b", "com/fr/", "allow")),
    (6, "http://shop.com?/de/", ("shop.com", "", None, "allow")),
    (7, "no address", ("", "", None, "allow")),
    (8, None, ("", "", None, "allow")),
    (None, "://", ("", "", None, "allow")),
    (9, "", ("", "", None, "allow")),
    (9, "http://ÄB.com/DE/", ("Äb.com", "/DE/", None, "allow")),
]


def test_addresses(session):
    schema = "page_id BIGINT, url STRING"
    pages = session.createDataFrame([(i, u) for i, u, _ in ADDRESSES] * 2, schema)
    pages = pages.selectExpr("*", "'mine' AS host", "'mine' AS rule", "1 AS doc_id")
    none = session.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    found = url_filter.judge_urls(session, pages, none, queries.URL_RULES)
    key = lambda row: tuple((x is None, x or 0) if isinstance(x, int | None) else x for x in row[:1]) + tuple(map(str, row[1:]))
    assert sorted(map(tuple, found.collect()), key=key) == sorted([(i, *want) for i, _, want in ADDRESSES] * 2, key=key)
    assert url_filter.judge_urls(session, pages.where("false"), none, queries.URL_RULES).collect() == []
    assert {row.rule for row in url_filter.judge_urls(session, pages, none, []).collect()} == {None}


def hosts(session, outcomes):
    """Pages of hosts, each with its good and bad documents, and the labels of these."""
    pages, known, doc = [], [], 0
    for host, good, bad in outcomes:
        for outcome in [1] * good + [0] * bad:
            doc += 1
            pages.append((doc, f"http://{host}/xx/{doc}"))
            known.append((doc, outcome, 0))
        pages.append((doc, f"http://{host}/about"))
    pages = session.createDataFrame(pages, "page_id BIGINT, url STRING")
    known += [(None, 0, 1), (1, None, None), *known[:3]]
    return pages, session.createDataFrame(known, "doc_id BIGINT, quality INT, toxic INT")


def test_a_bad_host_is_blocked_and_a_little_known_one_is_not(session):
    many = [(f"h{i}.good.net", 30, 1) for i in range(12)]
    pages, known = hosts(session, [*many, ("bad.net", 2, 60), ("new.bad.net", 0, 0), ("once.net", 0, 1)])
    found = {r.host: r.verdict for r in url_filter.judge_urls(session, pages, known, []).collect()}
    assert found["bad.net"] == "block"
    assert found["once.net"] == "allow"
    assert {found[f"h{i}.good.net"] for i in range(12)} == {"allow"}


def test_rates_shrink_to_the_level_above():
    con = duckdb.connect()
    con.execute("CREATE TABLE hosts AS SELECT * FROM (VALUES ('a.x.net','x.net','net',100.0,10.0), ('b.x.net','x.net','net',1.0,1.0), ('c.x.net','x.net','net',0.0,0.0)) t(host,domain,suffix,n,bad)")
    rows = dict(con.execute(f"WITH {url_filter.levels_sql('hosts')} SELECT host, rate FROM posterior").fetchall())
    assert 0.1 < rows["a.x.net"] < rows["b.x.net"] < 1
    assert rows["a.x.net"] - 0.05 < rows["c.x.net"] < rows["b.x.net"]


def fitting(rules, host, path):
    """The longest rule that fits, comparing all."""
    fits = [
        (-len(r.text), r.text, n)
        for n, r in enumerate(rules)
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return min(fits)[2] if fits else None


def test_a_hundred_thousand_rules(session):
    rng = random.Random(8)
    hosts = [".".join(rng.choices(["a", "b", "shop", "x1", "é"], k=rng.randint(1, 4))) for _ in range(300)]
    paths = ["", "/", *("/" + "/".join(rng.choices(["en", "de", "1", "12", "q"], k=rng.randint(1, 5))) for _ in range(200))]
    rules = [
        url_filter.Rule(rng.choice(["allow", "block"]), f"{i}.{rng.choice(hosts)}" if i >= 2000 else rng.choice(hosts), rng.choice(paths))
        for i in range(100_000)
    ]
    addresses = [(i, f"http://{rng.choice(['', 'www.', f'{rng.randrange(10**5)}.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '/more', '?q'])}") for i in range(60)]
    pages = session.createDataFrame(addresses * 2, "page_id BIGINT, url STRING")
    none = session.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    found = url_filter.judge_urls(session, pages, none, rules).collect()
    assert len(found) == 120 and sum(r.rule is not None for r in found) > 30
    for row in found:
        best = fitting(rules, row.host, row.path)
        assert (row.rule, row.verdict) == ((rules[best].text, rules[best].verdict) if best is not None else (None, "allow"))


def test_a_number_too_long_is_no_document(session):
    pages = session.createDataFrame([(1, "http://a.org/en/1234567890123456789"), (2, "http://a.org/en/123456789012345678")], "page_id BIGINT, url STRING")
    shown = session.sql(url_filter.parts_sql("{pages}"), pages=pages).collect()
    assert {r.page_id: r.shown_doc for r in shown} == {1: None, 2: 123456789012345678}
