"""Nearest neighbours against brute force: recall, exact order, and vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm import ann, queries

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def frame(session, rows):
    return session.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS score", "1 AS rank", "2 AS vector")


def brute_force(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    data = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    for query in asked:
        distance = np.sqrt(((data - data[ids == query][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, distance)) if ids[i] != query][:k]
        for rank, i in enumerate(order, 1):
            yield int(query), rank, int(ids[i]), float(distance[i])


def test_recall_and_distances(session):
    folder = "/root/testdata/sf0.1"
    found = queries.queries()["op10_ann"](session, folder).collect()
    table = session.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in table]
    asked = [i for i, _ in rows if i % 100 == 0]
    expected = list(brute_force(rows, asked, 10))
    true = {(q, v): d for q, _, v, d in expected}
    assert len(found) == len(expected)
    hits = [(r.query_id, r.vec_id) for r in found if (r.query_id, r.vec_id) in true]
    assert len(hits) >= 0.9 * len(expected)
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    for r in found:
        assert r.score == pytest.approx(np.linalg.norm(vectors[r.query_id] - vectors[r.vec_id]), abs=1e-12)
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert all(row == sorted(row) for row in by_query.values())


def test_ties_go_to_smaller_ids_and_few_candidates_all_come(session):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(3, 16)).astype(np.float32)
    rows = [(i, base[i % 3].tolist()) for i in range(30)]
    found = ann.nearest_neighbours(frame(session, rows), F.col("vec_id") < 6, 10).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == sorted(
        (q, rank, v) for q, rank, v, _ in brute_force(rows, range(6), 10)
    )
    few = ann.nearest_neighbours(frame(session, rows[:4]), F.col("vec_id") == 0, 10).collect()
    assert sorted((r["rank"], r.vec_id) for r in few) == [(1, 3), (2, 1), (3, 2)] or len(few) == 3


def test_vectors_that_take_no_part(session):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(1, 25)]
    bad = [
        (100, None), (101, [0.0] * 8), (102, [float("nan")] + [1.0] * 7), (103, [float("inf")] + [1.0] * 7),
        (104, [None] + [1.0] * 7), (105, []), (106, [1.0] * 5), (None, [1.0] * 8), (107, [-float("inf")] * 8),
    ]
    found = ann.nearest_neighbours(frame(session, (good + bad) * 2), F.lit(True), 10).collect()
    ids = {i for i, _ in good}
    assert {r.query_id for r in found} == ids and {r.vec_id for r in found} <= ids
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == sorted(
        (q, rank, v) for q, rank, v, _ in brute_force(good, sorted(ids), 10)
    )


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(None, [1.0])]])
def test_next_to_nothing(session, rows):
    found = ann.nearest_neighbours(frame(session, rows), F.lit(True), 10)
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.collect() == []


def test_queries_in_blocks(session, monkeypatch):
    monkeypatch.setattr(ann, "QUERIES_AT_ONCE", 3)
    monkeypatch.setattr(ann, "VECTORS_AT_ONCE", 7)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(40)]
    found = ann.nearest_neighbours(frame(session, rows).repartition(3), F.col("vec_id") < 10, 5).collect()
    assert len(found) == 50


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(4)
    data = rng.normal(size=(500, 32))
    codes = ann.learn(data, 5)
    index = ann.SubstringIndex(np.arange(500), data, codes)
    for i in range(0, 500, 50):
        apart = ann._ONES[index.marks ^ index.marks[i]].sum(axis=1, dtype=int)
        for radius in (0, 5, 20, 47, 64, 128):
            assert set(index.within(index.marks[i], radius)) == set(np.flatnonzero(apart <= radius))
