"""The source audit against a plain count, and on input with everything that can be odd."""

import re
from collections import Counter, defaultdict
from string import ascii_lowercase, ascii_uppercase

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as driver
from farebox.llm import divergence
from oracle_compare import connect, difference
from rows import documents, no_documents, odd_documents

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING"
LOWERED = str.maketrans(ascii_uppercase, ascii_lowercase)


def plain(rows, shown=divergence.SHOWN):
    """Term by term, in Python's whole numbers."""
    counts, found_in, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(divergence.TERM, (text or "").translate(LOWERED))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        found_in[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in found_in[lang].items() if n >= divergence.LEAST_DOCUMENTS]
        others = sorted(s for g, s in groups if g == lang)

        def shares(used, kept=kept):
            n = sum(used[t] for t in kept)
            return {t: 1 + divergence.SCALE * (used[t] + 1) // (n + len(kept)) for t in kept}

        total = sum((counts[lang, s] for s in others), Counter())
        p, q = shares(counts[lang, source]), shares(total)
        pairs = []
        for other in others:
            r = shares(counts[lang, other])
            if other != source:
                pairs.append((other, sum((p[t] - r[t]) ** 2 // r[t] for t in kept)))
        terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            items = items[:shown] if part == "term" else items
            out |= {(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(items, 1)}
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shown", [1, 3, 200])
def test_equals_a_plain_count(session, shown):
    texts = ["A b c", "a a b", "a é É b-b", "c c c d", "d, d; e", "x1y2 A b", "", None, "a b c d e ß ß"]
    rows = [(texts[i % 9], ["en", "de", None][i % 7 % 3], ["s", "t", "u", None][i % 4]) for i in range(80)]
    docs = session.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    assert found(divergence.source_divergence(docs, shown)) == plain(rows, shown)


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.text("aAbBé\U0001f600 -1", max_size=12),
            st.sampled_from(["en", "fr", None]),
            st.sampled_from(["s", "t", ""]),
        ),
        max_size=25,
    )
)
def test_any_documents(session, rows):
    docs = session.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    assert found(divergence.source_divergence(docs)) == plain(rows)


def test_groups_without_terms_and_languages_without_kept_terms(session):
    rows = [("a b", "en", "s"), ("a b", "en", "s"), ("a b", "en", "t"), (None, "en", "empty"), ("1 2", "xx", "s"), ("", "xx", "t")]
    docs = session.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    result = found(divergence.source_divergence(docs))
    assert result == plain(rows)
    assert {r[3:5] for r in result if r[0] == "xx"} == {("s", 0), ("t", 0)}
    assert len([r for r in result if r[1] == "empty"]) == 2


def test_counts_too_large_for_64_bits_times_the_scale(session):
    large = 3 * 10**10
    counted = session.createDataFrame([(large, large, 7)], "c BIGINT, n BIGINT, v BIGINT")
    share = divergence.share(counted.c, counted.n, counted.v)
    assert counted.select(share).head()[0] == 1 + 10**9 * (large + 1) // (large + 7)


def test_odd_documents(session):
    rows = [(r.text, r.lang, r.source) for r in odd_documents(session).collect()]
    assert found(divergence.source_divergence(odd_documents(session))) == plain(rows)
    assert divergence.source_divergence(no_documents(session)).collect() == []
    alone = divergence.source_divergence(documents(session, [(1, "a"), (2, "a"), (3, "a")], clashing=True))
    assert alone.collect() == []


def test_query_equals_sql(session):
    folder = "/root/testdata/sf0.001"
    ours = driver.queries()["op13_source_divergence"](session, folder).toPandas()
    assert difference(ours, connect(folder).execute(driver.oracle_sql()["op13_source_divergence"]).df()) == ""
