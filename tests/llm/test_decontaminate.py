"""Tiles against a plain greedy tiling, and leaks verbatim, reordered and absent."""

import random

import numpy as np
import pytest

from farebox.llm import decontaminate as dc
from farebox.llm import queries
from farebox.llm.common import mixed
from rows import documents, no_documents, odd_documents


def greedy(document, item, least):
    """The longest unmarked match anywhere, again and again: words of the item covered."""
    marked = [False] * len(document), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(document)):
                n = 0
                while (
                    i + n < len(document) and j + n < len(item) and document[i + n] == item[j + n]
                    and not marked[0][i + n] and not marked[1][j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sum(marked[1])
        marked[0][i : i + n] = marked[1][j : j + n] = [True] * n


def hashed(words):
    return mixed(np.array([abs(hash(w)) % (1 << 40) for w in words], dtype=np.uint64))


@pytest.mark.parametrize("seed", range(12))
def test_tiles_cover_as_much_as_plain_greedy_tiling(seed):
    rng = random.Random(seed)
    for _ in range(20):
        item = rng.choices("abcdefgh", k=rng.randint(1, 25))
        parts = [item[a : a + rng.randint(2, 9)] for a in (rng.randrange(len(item)) for _ in range(4))]
        document = [w for part in parts for w in [*part, *rng.choices("abcxyz", k=rng.randint(0, 3))]]
        least = min(3, len(item))
        covered = dc.tiled(hashed(document), hashed(item), least)
        assert covered.sum() == greedy(document, item, least)


def benchmark(session, rows):
    return session.createDataFrame(rows, "item_id BIGINT, text STRING").selectExpr("*", "'mine' AS doc_id", "1 AS n_words")


ITEM = " ".join(f"word{i}" for i in range(30))
SHUFFLED = " ".join(f"word{i}" for i in [*range(20, 30), *range(10, 20), *range(10)])
HALF = " ".join(f"word{i}" for i in range(12))


def test_leaks(session):
    tests = benchmark(session, [(1, ITEM), (1, ITEM), (2, "tiny test"), (None, ITEM), (3, None), (4, "..."), (5, "")])
    rows = [
        (1, f"before {ITEM} after"), (2, f"{SHUFFLED}"), (3, HALF + " and other words"), (4, ITEM.upper().replace(" ", ", ")),
        (5, "a tiny test it is"), (6, None), (7, ""), (None, ITEM), (8, "nothing of the kind"), (9, "x " * 50_000 + ITEM),
    ]
    docs = documents(session, rows, clashing=True)
    found = dc.leaked_items(docs, tests).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == sorted(
        [(1, 1), (2, 1), (4, 1), (5, 2), (None, 1), (9, 1)], key=str
    )
    assert all(r.coverage == r.n_covered / r.n_words >= dc.COVERED for r in found)
    clean = docs.where(~dc.has_leak("text", tests))
    assert sorted(r.doc_id for r in clean.collect()) == [3, 6, 7, 8]
    assert dc.leaked_items(docs.union(docs), tests).count() == 2 * len(found)


def test_blocks_of_items(session, monkeypatch):
    rows = [(i, " ".join(f"q{i}w{k}" for k in range(10))) for i in range(40)]
    docs = documents(session, [(i, f"so {text} then") for i, text in rows])
    monkeypatch.setattr(dc, "BLOCK_BYTES", 300)
    found = dc.leaked_items(docs, benchmark(session, rows)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(i, i) for i in range(40)]
    assert docs.where(dc.has_leak("text", benchmark(session, rows))).count() == 40


def test_nothing(session):
    tests = benchmark(session, [(1, ITEM)])
    assert dc.leaked_items(no_documents(session), tests).collect() == []
    assert dc.leaked_items(odd_documents(session), tests).collect() == []
    none = tests.where("false")
    assert dc.leaked_items(odd_documents(session), none).collect() == []
    assert odd_documents(session).where(~dc.has_leak("text", none)).count() == 22


def test_query_finds_what_holds_an_item(session, sf_dir):
    docs = {r.doc_id: r.text for r in session.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in session.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    whole = {(d, i) for d, text in docs.items() for i, item in items.items() if item in (text or "")}
    found = {(r.doc_id, r.item_id) for r in queries.queries()["op8_decontaminate"](session, sf_dir).collect()}
    assert whole <= found and len(found) <= len(whole) + 2
