"""Main text of pages whose article is known."""

import random
import re
from html import unescape

import numpy as np
import pytest

from farebox.llm import html_extract as h
from farebox.llm import queries
from farebox.llm.dom import parse


@pytest.fixture(scope="module")
def pages(session):
    return [r.html for r in session.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return h.learn(pages[:100])


def article(html):
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1]
    return " ".join(unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside))).split())


def test_pages_not_learned_from(pages, model):
    found = h.main_texts(pages[100:], model)
    right = [text == article(page) for text, page in zip(found, pages[100:], strict=True)]
    assert sum(right) >= 0.95 * len(right)


def test_other_layouts(pages, model):
    rng = random.Random(42)
    runs = [t for t in parse(pages[100:]).text if len(t) > 40]
    made = [h.laid_out(rng, rng.sample(runs, rng.randint(2, 8)), rng.sample(runs, 20)) for _ in range(150)]
    forest = parse(made)
    truth = [h.MARK in t for t in forest.text]
    forest.text = [t.replace(h.MARK, "") for t in forest.text]
    kept = h.decode(forest, model.logits(forest))
    both = sum(len(t) for t, a, b in zip(forest.text, truth, kept, strict=True) if a and b)
    assert both >= 0.9 * sum(len(t) for t, a in zip(forest.text, truth, strict=True) if a)
    assert both >= 0.9 * sum(len(t) for t, b in zip(forest.text, kept, strict=True) if b)


def test_decoding_never_keeps_below_what_it_rejects_and_is_the_best_choice():
    forest = parse(["<div><p>a</p><ul><li>b</li></ul></div><div>c</div>"])
    n = len(forest.page)
    rng = random.Random(3)
    for _ in range(200):
        gains = [rng.uniform(-2, 2) for _ in range(n)]
        kept = h.decode(forest, np.array(gains))
        assert all(not k or forest.parent[i] < 0 or kept[forest.parent[i]] for i, k in enumerate(kept))
        best = 0.0
        for choice in range(1 << n):
            chosen = [choice >> i & 1 for i in range(n)]
            above = [chosen[forest.parent[i]] if forest.parent[i] >= 0 else 1 for i in range(n)]
            if all(c <= a and (c == a or not t) for c, a, t in zip(chosen, above, h.tied(forest), strict=True)):
                best = max(best, sum(g for g, c in zip(gains, chosen, strict=True) if c))
        assert sum(g for g, k in zip(gains, kept, strict=True) if k) == pytest.approx(best)


@pytest.mark.parametrize(
    ("html", "runs"),
    [
        ("<p>one<p>two<br>three &amp; <b>f</b>our&nbsp;x", ["one", "two three & four x"]),
        ("a<script>if (a<b) '</p>'</script>b<style>p{}</style><!-- c --><!DOCTYPE html>d", ["a", "b", "d"]),
        ("<div title='a>b' class=\"x\">t</div><p", ["t"]),
        ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul></div></p>5", ["1", "2", "3", "4", "5"]),
        ("x<textarea>no</textarea>", ["x"]),
        ("a < b & c &am", ["a < b & c &am"]),
        ("<a href=x>l</a", ["l"]),
        ("", []),
        ("<div>" * 3000 + "deep", ["deep"]),
    ],
)
def test_reading_markup(html, runs):
    assert [t for t in parse([html]).text if t] == runs


def test_odd_pages(session, model):
    rows = [(1, None), (None, ""), (3, "   "), (3, "no markup at all"), (4, "<html><body></body></html>"), (5, "<p>" + "x " * 200_000)]
    pages = session.createDataFrame(rows * 2, "page_id BIGINT, html STRING").selectExpr("*", "'mine' AS text", "1 AS n_chars")
    found = pages.select("page_id", h.main_text("html", model, pages).alias("found")).collect()
    assert len(found) == 12 and all(row.found is not None for row in found)
    assert [row.found for row in found[:3]] == ["", "", ""]
    fitted = h.fit(pages)
    assert len(pages.select(h.main_text("html", fitted, pages)).collect()) == 12
    none = pages.where("false")
    assert none.select(h.main_text("html", h.fit(none), none)).collect() == []


def test_query(session, sf_dir):
    rows = queries.queries()["op1_html_extract"](session, sf_dir).collect()
    assert all(row.n_chars == len(row.text) for row in rows)
    source = {r.page_id: r.html for r in session.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert sum(row.text == article(source[row.page_id]) for row in rows) >= 0.95 * len(rows)


@pytest.mark.parametrize(
    "after_title",
    ["<body><p>Shown.</p>", "<p>Shown.</p>", "<b>Shown.</b>", "Shown.", "</head><body>Shown.", "<script>s</script> <meta x>\n<body>Shown."],
)
def test_a_head_may_lack_its_end(after_title):
    for start in ("<html><head>", "<head><meta charset=utf-8><style>p {}</style>"):
        forest = parse([start + "<title>Hidden</title>" + after_title])
        assert [text for text in forest.text if text] == ["Shown."]


# Pages written by hand, in layouts that no generator made: every block of the text, and nothing else.
STORY = [
    "The river rose two metres in a single night last week.",
    "Nobody in the village had seen anything like it before.",
    "Farmers moved their cattle to the higher fields by torchlight.",
    "By morning the old stone bridge was gone, and the road with it.",
    "The council has promised a temporary crossing within a month.",
    "Until then, children will go to school by boat, which they love.",
]
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li></ul>'
FOOT = '<footer>&copy; 2024 Example Media. <a href="/t">Terms</a></footer>'
IN_P = "".join(f"<p>{s}</p>" for s in STORY)
IN_DIV = "".join(f"<div>{s}</div>" for s in STORY)
BY_HAND = {
    "paragraphs in the body": (IN_P, []),
    "a div each in the body": (IN_DIV, []),
    "a div each in a div": (f"<div>{IN_DIV}</div>", []),
    "paragraphs in two divs": (f"<div><div>{IN_P}</div></div>", []),
    "paragraphs in a section": (f"<section>{IN_P}</section>", []),
    "a link bar and a plain div": (f"<nav>{MENU}</nav><div>{IN_P}</div>{FOOT}", []),
    "an article": (f"<nav>{MENU}</nav><article>{IN_P}</article>{FOOT}", []),
    "an ordered list": (f"<article>{IN_P}<ol><li>Bring boots.</li><li>Bring a torch.</li></ol></article>", ["Bring boots.", "Bring a torch."]),
    "a definition": (f"<article>{IN_P}<dl><dt>Ford</dt><dd>A place where one can cross.</dd></dl></article>", ["Ford", "A place where one can cross."]),
    "a caption": (f"<article>{IN_P}<figure><img src=x><figcaption>The bridge before it fell.</figcaption></figure></article>", ["The bridge before it fell."]),
    "details": (f"<article>{IN_P}<details><summary>More on this</summary><p>The bridge was old.</p></details></article>", ["More on this", "The bridge was old."]),
    "names that say nothing": (f'<div class="x9k2"><div class="q77">{IN_DIV}</div></div><div class="footer">Copyright 2024</div>', []),
    "a heading and comments": (
        f'<div class="menu">{MENU}</div><h1>Flood takes bridge</h1>{IN_P}<div class="comments">'
        '<div class="comment">I saw it too, so sad.</div><div class="comment">Great pictures, thanks.</div></div>',
        ["Flood takes bridge"],
    ),
    "a form": (f'<header><a href="/">Logo</a></header><main>{IN_P}</main><form><label>Your email</label><button>Send</button></form>', []),
    "line breaks": (f"<div id=content>{'<br><br>'.join(STORY)}</div>", []),
    "a table": (f"<table><tr><td>{MENU}</td><td>{IN_P}</td></tr></table>", []),
}


@pytest.mark.parametrize("layout", BY_HAND)
def test_pages_written_by_hand(model, layout):
    body, more = BY_HAND[layout]
    found = h.main_texts([f"<html><head><title>Hidden</title></head><body>{body}</body></html>"], model)[0]
    for text in (*STORY, *more):
        assert text in found
        found = found.replace(text, "", 1)
    assert found.split() == []


def test_alike_blocks_are_kept_together_or_not_at_all():
    forest = parse([f"<div>{IN_P}</div>", IN_DIV])
    rng = np.random.default_rng(1)
    for _ in range(20):
        kept = h.decode(forest, h.agreed(forest, rng.normal(0.2, 1, len(forest.page))))
        for page in (0, 1):
            assert len({k for k, t, p in zip(kept, forest.text, forest.page, strict=True) if t and p == page}) == 1


def test_copies_and_long_pages_are_learned_from(session, pages):
    copies = session.createDataFrame([(i, html) for i, html in enumerate(pages[:3])] * 300, "page_id BIGINT, html STRING")
    long = session.createDataFrame([(1, pages[0].replace("</article>", "<p>More of it, as long as it is.</p>" * 2000 + "</article>"))], "page_id BIGINT, html STRING")
    for table in (copies, long):
        fitted = h.fit(table)
        assert fitted.trees.trees
        found = table.limit(3).select(h.main_text("html", fitted, table).alias("text")).collect()
        assert all(len(row.text) > 40 for row in found)
