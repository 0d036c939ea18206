"""Vector codes against comparing everything, trees that keep their promises, and odd vectors."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as driver
from farebox.llm import cover_tree, vector_codes
from oracle_compare import connect, difference

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"


def plain(rows, parts, entries, rounds):
    """Lloyd's rounds in Python's whole numbers; rows in order of their ids."""
    data = [[int(np.floor(256 * x)) for x in v] for _, v, _ in rows]
    size = len(data[0]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for v in data]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            got = [[] for _ in book]
            for v in cut:
                got[nearest(v[p], book)[1]].append(v[p])
            books[p] = [[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(got, book)]
    result = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    return (
        [("".join(f"{j:02x}" for _, j in r), sum(d for d, _ in r)) for r in result],
        [x for book in books for e in book for x in e],
    )


def frame(session, rows):
    return session.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'mine' AS code", "'mine' AS error", "1 AS value", "2 AS forest", "3 AS copies", "4 AS key"
    )


@pytest.mark.parametrize("block", [3, 50, 10_000])
def test_equals_plain_rounds_however_blocks_fall(session, block):
    rng = np.random.default_rng(block)
    rows = [(i, rng.integers(-40, 40, 12).astype(float).tolist(), i % 3 or None) for i in range(200)]
    rows += [(200 + i, rows[i][1], 7) for i in range(40)]
    coded, books = vector_codes.code_vectors(frame(session, rows).repartition(3), parts=3, entries=9, block=block)
    expected, numbers = plain(rows, 3, 9, vector_codes.ROUNDS)
    found = {r.vec_id: (r.code, r.error) for r in coded.collect()}
    assert [found[i] for i in range(len(rows))] == expected
    assert books.reshape(-1).tolist() == numbers
    assert vector_codes.fingerprint(books) == hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
    sums = {}
    for (_, _, label), (_, error) in zip(rows, expected):
        sums[label] = sums.get(label, 0) + error
    for r in vector_codes.with_label_errors(coded).collect():
        assert r.label_error == sums[r.label]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.integers(1, 4), st.integers(1, 3), st.integers(1, 12), st.integers(0, 10**6))
def test_whole_subtrees_go_where_each_point_would(n, parts, width, entries, seed):
    rng = np.random.default_rng(seed)
    spread = int(rng.choice([1, 3, 100, 10**6]))
    vectors = rng.integers(-spread, spread + 1, (n, parts * width))
    books = rng.integers(-spread, spread + 1, (parts, entries, width))
    forest = cover_tree.Forest.unpacked(cover_tree.plant(vectors, parts).packed())
    assigned = cover_tree.assign(forest, books)
    code, error = cover_tree.codes(forest, assigned, books)
    cut = vectors.reshape(n, parts, 1, width)
    apart = ((cut - books[None]) ** 2).sum(axis=3)
    assert (code == apart.argmin(axis=2)).all() and (error == apart.min(axis=2).sum(axis=1)).all()
    total, count = cover_tree.entry_sums(forest, assigned, entries)
    for p in range(parts):
        for e in range(entries):
            mine = cut[code[:, p] == e, p, 0]
            assert count[p * entries + e] == len(mine) and (total[p * entries + e] == mine.sum(axis=0)).all()


def test_trees_cover_and_separate():
    rng = np.random.default_rng(4)
    forest = cover_tree.plant(np.floor(rng.normal(0, 50, (2000, 8))).astype(np.int64), 2)
    for node in np.flatnonzero(forest.first_child >= 0)[::7]:
        first, n = forest.first_child[node], forest.children[node]
        centres = forest.centre[first : first + n]
        assert n > 1 and (centres == forest.centre[node]).all(axis=1).any()
        covering = 4.0 ** np.ceil(np.log2(forest.radius[node]) / 2)
        between = cover_tree.squared(centres[:, None], centres[None])
        assert between.max() <= 2 * 2 * covering
        assert between[~np.eye(n, dtype=bool)].min() > np.floor(covering / 4)
        assert (forest.radius[first : first + n] <= covering / 4).all()
        assert forest.start[first] == forest.start[node] and forest.end[first + n - 1] == forest.end[node]


def test_most_of_a_clustered_block_is_never_compared():
    rng = np.random.default_rng(5)
    heart = rng.integers(-10_000, 10_000, (64, 4))
    points = heart[rng.integers(0, 64, 20_000)] + rng.integers(-20, 20, (20_000, 4))
    forest = cover_tree.plant(points, 1)
    assert cover_tree.assign(forest, heart[None]).compared < 200


def test_vectors_that_take_no_part(session):
    good = [(i, [float(i), 1.0, -2.5, 0.1 * i], i % 2) for i in range(1, 8)]
    nan, inf = float("nan"), float("inf")
    bad = [(0, None, 1), (9, [1.0, None, 2.0, 3.0], 1), (10, [nan, 1.0, 1.0, 1.0], 1), (11, [1.0, inf, 1.0, 1.0], 1)]
    bad += [(12, [], 1), (13, [1.0, 2.0, 3.0], 1), (14, [1.0] * 8, 1)]
    rows = good + [(None, [5.0, 5.0, 5.0, 5.0], None)] + [(15, [0.0] * 4, None)] * 2
    coded, _ = vector_codes.code_vectors(frame(session, rows + bad), parts=4, entries=5)
    expected, _ = plain(good + [rows[-1]] * 2 + [rows[7]], 4, 5, 2)
    found = sorted((r.vec_id or 99, r.code, r.error) for r in vector_codes.with_label_errors(coded).collect())
    assert found == sorted((i, *e) for i, e in zip([1, 2, 3, 4, 5, 6, 7, 15, 15, 99], expected))


def test_no_vectors_and_too_large_ones(session):
    for rows in ([], [(1, None, 1)]):
        coded, books = vector_codes.code_vectors(frame(session, rows))
        assert vector_codes.with_label_errors(coded).collect() == []
        assert vector_codes.fingerprint(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(Exception, match="too large"):
        vector_codes.code_vectors(frame(session, [(1, [1e9] * 16, 1), (2, [0.0] * 16, 1)]))


def test_a_hot_label_and_many_cold_ones(session):
    rows = [(i, [float(i % 50)] * 16, 1 if i % 2 else i) for i in range(3000)]
    coded, _ = vector_codes.code_vectors(frame(session, rows))
    found = vector_codes.with_label_errors(coded).collect()
    sums = {}
    for r in found:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert len(found) == 3000 and all(r.label_error == sums[r.label] for r in found)


def test_query_equals_sql(session):
    folder = "/root/testdata/sf0.01"
    ours = driver.queries()["op11_vector_codes"](session, folder).toPandas()
    assert difference(ours, connect(folder).execute(driver.oracle_sql()["op11_vector_codes"]).df()) == ""
