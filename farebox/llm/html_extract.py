"""Main text of web pages.

A page is a tree of blocks whose leaves are runs of text. Boosted trees give each node the
probability that its subtree holds article text, from depth and place, the density of text,
links and sentence marks in the subtree, its siblings, and the words of tags, classes and
ids on it and above it. Decoding then takes the most probable choice for the whole tree in
which nothing below a rejected node is kept, so an ancestor and a descendant never
contradict each other.

The trees are learned from a bounded sample of the pages themselves: as they are, where an
article element marks the text, and laid out anew with the same paragraphs in many other
arrangements, where it is known which text is the article's.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm import boosting
from farebox.llm.common import hashed_sample
from farebox.llm.dom import Forest, flags, numbers, parse

MOST_PAGES = 150  # sampled to learn from
LONGEST_PAGE = 60_000  # characters of a page that is learned from, unless all pages are longer
MOST_LONG = 5
LAYOUTS = 8  # arrangements of each
MOST_TOKENS = 400
LEAST_SEEN = 4
MARK = ""  # begins a run of article text in a page laid out anew

# Names that sites give to the parts of a page.
ARTICLE_NAMES = (
    "article content main post entry story body text post-body entry-content article-body main-content "
    "page-content story-text blog-post"
).split()
MENU_NAMES = "nav menu navbar navigation breadcrumb breadcrumbs toc topbar links main-nav site-menu".split()
HEADER_NAMES = "header masthead site-header page-header banner-top branding logo top".split()
FOOTER_NAMES = "footer site-footer page-footer copyright colophon bottom legal".split()
SIDE_NAMES = "sidebar aside side widget related recommended popular more trending rail column-right".split()
NOTICE_NAMES = "notice cookie cookie-notice consent alert warning popup modal overlay message gdpr".split()
ADVERT_NAMES = "ad ads advert advertisement sponsored promo promotion banner sponsor adsbox teaser".split()
FORM_NAMES = "form search subscribe newsletter signup login search-box contact".split()
COMMENT_NAMES = "comments comment replies reply discussion responses comment-list disqus feedback".split()
SOCIAL_NAMES = "share social share-buttons tags meta author-box byline follow".split()
SET_ASIDE = frozenset(
    token
    for names in (
        MENU_NAMES, HEADER_NAMES, FOOTER_NAMES, SIDE_NAMES, NOTICE_NAMES, ADVERT_NAMES, FORM_NAMES, COMMENT_NAMES
    )
    for name in names
    for token in name.split("-")
    if "-" not in name
) | {"<nav", "<header", "<footer", "<aside", "<form", "<button", "<dialog"}


@dataclass
class BlockModel:
    trees: boosting.BoostedTrees
    tokens: dict[str, int]

    def logits(self, forest: Forest) -> np.ndarray:
        return self.trees.logits(features(forest, self.tokens))


def features(forest: Forest, tokens: dict[str, int]) -> np.ndarray:
    return np.concatenate([numbers(forest), flags(forest, tokens)], axis=1, dtype=np.float32)


def tied(forest: Forest) -> list[bool]:
    """For each node whether it is a run of text that is all its block holds: the two are one choice."""
    children = [0] * len(forest.page)
    for parent in forest.parent:
        if parent >= 0:
            children[parent] += 1
    return [p >= 0 and children[p] == 1 and bool(t) for p, t in zip(forest.parent, forest.text, strict=True)]


def decode(forest: Forest, logits: np.ndarray) -> list[bool]:
    """For each node whether it is kept, by the best total over choices without contradiction.

    Keeping a node gains its logit; a node below one that is not kept cannot be kept, and a
    block and the one run it holds are kept together. What a subtree gains at most is known
    once its children are, which come after it in order.
    """
    gain, together = logits.tolist(), tied(forest)
    for node in range(len(gain) - 1, -1, -1):
        parent = forest.parent[node]
        if parent >= 0 and (gain[node] > 0 or together[node]):
            gain[parent] += gain[node]
    kept = [False] * len(gain)
    for node, best in enumerate(gain):
        parent = forest.parent[node]
        kept[node] = kept[parent] if together[node] else best > 0 and (parent < 0 or kept[parent])
    return kept


def agreed(forest: Forest, logits: np.ndarray) -> np.ndarray:
    """Logits in which blocks that look alike under one parent, with few links each, have their
    mean, by length of text: the paragraphs of a text are kept together or not at all."""
    alike: dict[tuple, list[int]] = {}
    inner = {parent for parent, text in zip(forest.parent, forest.text, strict=True) if not text}
    texts = [len(t) for t in forest.text]
    links = list(forest.links)
    for node in range(len(texts) - 1, 0, -1):
        if forest.parent[node] >= 0:
            texts[forest.parent[node]] += texts[node]
            links[forest.parent[node]] += links[node]
    together = tied(forest)
    for node, parent in enumerate(forest.parent):
        if parent >= 0 and node not in inner and 2 * links[node] < texts[node]:
            # The run that is all of a block is like the runs of the blocks beside it.
            block = parent if together[node] else node
            key = (forest.parent[block], together[node], bool(forest.text[node]), *forest.tokens[block])
            alike.setdefault(key, []).append(node)
    made = logits.copy()
    for nodes in alike.values():
        if len(nodes) > 1:
            made[nodes] = np.average(logits[nodes], weights=[texts[node] + 1 for node in nodes])
    return made


def main_texts(pages: list[str], model: BlockModel) -> list[str]:
    forest = parse(pages)
    found: list[list[str]] = [[] for _ in pages]
    if forest.page:
        for node, keep in enumerate(decode(forest, agreed(forest, model.logits(forest)))):
            if keep and forest.text[node]:
                found[forest.page[node]].append(forest.text[node])
    return [" ".join(runs) for runs in found]


# --- learning ---


def _holding(forest: Forest, text_is_main: list[bool]) -> np.ndarray:
    """Whether each node's subtree holds article text."""
    held = np.array(text_is_main, dtype=bool)
    for node in range(len(held) - 1, 0, -1):
        if held[node] and forest.parent[node] >= 0:
            held[forest.parent[node]] = True
    return held


def _by_landmark(forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Labels by article element, and which nodes are on pages that have one."""
    inside, main = [], []
    for node, tokens in enumerate(forest.tokens):
        parent = forest.parent[node]
        within = parent >= 0 and inside[parent]
        inside.append((within or tokens[0] in ("<article", "<main")) and not SET_ASIDE & set(tokens))
        main.append(inside[node] and bool(forest.text[node]))
    marked = set(np.array(forest.page)[np.array(main, dtype=bool)].tolist())
    return _holding(forest, main), np.array([page in marked for page in forest.page])


def _element(rng: random.Random, tags: list[str], names: list[str], inner: str) -> str:
    tag = rng.choice(tags)
    how = rng.random()
    name = rng.choice(names)
    attribute = "" if how < 0.15 and tag != "div" else f' {rng.choice(["class", "class", "id"])}="{name}"'
    return f"<{tag}{attribute}>{inner}</{tag}>"


def _random_name(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(rng.randint(3, 8)))


def laid_out(rng: random.Random, article: list[str], other: list[str]) -> str:
    """A page with ``article`` as its text, marked, and ``other`` in the parts around it."""

    def words(n: int) -> str:
        return escape(" ".join(rng.choice(other).split()[:n]) if other else "more")

    def links() -> str:
        items = [f'<a href="/{i}">{words(rng.randint(1, 4))}</a>' for i in range(rng.randint(3, 9))]
        return f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>" if rng.random() < 0.7 else " | ".join(items)

    def prose() -> str:
        texts = [words(rng.randint(5, 80)) for _ in range(rng.randint(1, 3))]
        return "".join(f"<p>{t}</p>" for t in texts) if rng.random() < 0.5 else " ".join(texts)

    def part(kind: str) -> str:
        if kind == "menu":
            return _element(rng, ["nav", "nav", "div", "ul"], MENU_NAMES, links())
        if kind == "header":
            return _element(rng, ["header", "div"], HEADER_NAMES, rng.choice([links(), words(6), f"<h2>{words(4)}</h2>"]))
        if kind == "footer":
            return _element(rng, ["footer", "div"], FOOTER_NAMES, f"&copy; {words(20)}" + rng.choice(["", links()]))
        if kind == "side":
            return _element(rng, ["aside", "div", "section"], SIDE_NAMES, f"<h3>{words(3)}</h3>" + rng.choice([links(), prose()]))
        if kind == "notice":
            return _element(rng, ["div", "section", "dialog"], NOTICE_NAMES, prose() + rng.choice(["", "<button>OK</button>"]))
        if kind == "advert":
            return _element(rng, ["div", "div", "aside"], ADVERT_NAMES, prose())
        if kind == "form":
            return _element(rng, ["form", "form", "div"], FORM_NAMES, f"<label>{words(3)}</label><input><button>{words(2)}</button>")
        if kind == "social":
            return _element(rng, ["div", "ul"], SOCIAL_NAMES, links())
        comments = "".join(
            _element(rng, ["div", "li", "article"], COMMENT_NAMES, prose()) for _ in range(rng.randint(1, 5))
        )
        return _element(rng, ["section", "div", "ol"], COMMENT_NAMES, comments)

    def block(text: str, habit: str) -> str:
        shape = rng.random()
        if habit != "mixed" and shape < 0.85:
            return {"p": f"<p>{text}</p>", "div": f"<div>{text}</div>", "open": f"<p>{text}", "br": f"{text}<br><br>"}[habit]
        half, tag = len(text) // 2, rng.choice(["ol", "ul"])
        items = [f"<li>{MARK}{words(rng.randint(1, 7))}</li>" for _ in range(rng.randint(2, 5))]
        shapes = [
            f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}</b><br>", f"<h2>{text}</h2>", f"<ul><li>{text}</li></ul>",
            f"<{tag}><li>{text}</li><li>{text}</li></{tag}>", f"<{tag}>{''.join(items)}</{tag}>", f"<blockquote>{text}</blockquote>", f"<div>{text}</div>",
            f"<blockquote><p>{text}</p></blockquote>", f"<section><p>{text}</p></section>",
            f"<table><tr><td>{text}</td><td>{text}</td></tr></table>",
            f"<dl><dt>{MARK}{words(2)}</dt><dd>{text}</dd></dl>", f"<pre><code>{text}</code></pre>",
            f"<figure><img src=x><figcaption>{text}</figcaption></figure>",
            f"<details open><summary>{MARK}{words(3)}</summary><p>{text}</p></details>",
            f"<p>{text[:half]}<a href='/x'>{text[half:]}</a></p>" if "&" not in text else f"<p>{text}</p>",
        ]
        return rng.choice(shapes)

    habit = rng.choice(["p", "p", "p", "div", "div", "div", "br", "open", "mixed", "mixed"])
    blocks = []
    for place, text in enumerate(article):
        if rng.random() < 0.15:  # articles have short paragraphs too
            text = " ".join(text.split()[: rng.randint(1, 9)])
        text = MARK + escape(text)
        blocks.append(f"<h1>{text}</h1>" if place == 0 and rng.random() < 0.6 else block(text, habit))
        if rng.random() < 0.06:
            blocks.append(part(rng.choice(["advert", "social", "side", "form", "notice"])))
    if rng.random() < 0.2:
        blocks.append(part("comments"))
    # The names of many containers say nothing, or there is none: the text stands in the body.
    story, frame = "".join(blocks), rng.random()
    if frame < 0.4:
        story = _element(rng, ["article", "article", "main", "div", "div", "section"], ARTICLE_NAMES, story)
    elif frame < 0.65:
        said = rng.choice(["", "", f' class="{_random_name(rng)}"'])
        tag = rng.choice(["div", "div", "section", "center", "main"])
        story = f"<{tag}{said}>{story}</{tag}>"
    for _ in range(rng.randint(0, 2) if frame < 0.65 else 0):
        names = [*ARTICLE_NAMES, "wrapper", "container", "row", "page", _random_name(rng)]
        story = f"<div>{story}</div>" if rng.random() < 0.4 else _element(rng, ["div", "main", "section"], names, story)
    before = [k for k in ("menu", "header", "notice", "advert", "form") if rng.random() < 0.45]
    after = [k for k in ("side", "comments", "advert", "social", "form", "footer", "footer") if rng.random() < 0.4]
    if rng.random() < 0.2:  # a page may have nothing but its text
        before, after = [], []
    rng.shuffle(before)
    body = "".join(map(part, before)) + story + "".join(map(part, after))
    return f"<html><head><title>{words(5)}</title></head><body>{body}</body></html>"


def learn(pages: list[str], seed: int = 5) -> BlockModel:
    """Trees from sampled pages; without any text to learn from nothing is kept."""
    real = parse(pages)
    truth, marked = _by_landmark(real)
    runs: dict[int, list[str]] = {}
    others: list[str] = []
    for node, text in enumerate(real.text):
        if text:
            (runs.setdefault(real.page[node], []) if truth[node] or not marked[node] else others).append(text)
    rng = random.Random(seed)
    paragraphs = [text for texts in runs.values() for text in texts]
    made = [
        laid_out(rng, texts[: rng.randint(1, 12)], rng.choices(paragraphs, k=20) + rng.choices(others or paragraphs, k=10))
        for texts in runs.values()
        for _ in range(LAYOUTS)
    ]
    fake = parse(made)
    fake_truth = _holding(fake, [MARK in text for text in fake.text])
    fake.text = [text.replace(MARK, "") for text in fake.text]
    seen = Counter(t for forest in (real, fake) for tokens in forest.tokens for t in tokens)
    common = [t for t, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if n >= LEAST_SEEN]
    tokens = {t: i for i, t in enumerate(common[:MOST_TOKENS])}
    if not made:
        return BlockModel(boosting.BoostedTrees(-1.0), tokens)
    data = np.concatenate([features(real, tokens)[marked], features(fake, tokens)])
    return BlockModel(boosting.fit(data, np.concatenate([truth[marked], fake_truth]).astype(float)), tokens)


def fit(pages: DataFrame, key: str = "page_id", html: str = "html") -> BlockModel:
    """Learn from at most ``MOST_PAGES`` pages, or from ``MOST_LONG`` where all are long."""
    length = F.length(html)
    sample = hashed_sample(pages.where(length.between(1, LONGEST_PAGE)).select(html), MOST_PAGES).collect()
    if not sample:
        sample = hashed_sample(pages.where(length > LONGEST_PAGE).select(html), MOST_LONG).collect()
    return learn(sorted(row[0] for row in sample))


def main_text(html: str, model: BlockModel, pages: DataFrame) -> Column:
    """Column of the main text of the page in column ``html`` of ``pages``.

    Character references are decoded, white space within a block is one space, blocks are
    joined in page order by one space. A NULL or empty page, and one without article text,
    gives an empty string.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def extracted(column: pa.Array) -> pa.Array:
        return pa.array(main_texts([page or "" for page in column.to_pylist()], sent.value), pa.string())

    return extracted(F.col(html))
