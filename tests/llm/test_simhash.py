"""Fingerprints and their components against plain ones, and trees that lose no pair."""

import re
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as driver
from farebox.llm import simhash
from rows import ODD_TEXTS, documents, no_documents, odd_documents

LOWERED = str.maketrans(ascii_uppercase, ascii_lowercase)


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The least place that each distinct fingerprint reaches, comparing all."""
    prints = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None]) <= simhash.RADIUS
    least = np.arange(len(prints))
    while True:
        onward = np.array([least[row].min() for row in near]) if len(prints) else least
        if (onward == least).all():
            return least
        least = onward


def flipped(rng, base, n, most):
    """Copies of some fingerprints with up to ``most`` bits turned."""
    made = base[rng.integers(0, len(base), n)].copy()
    for _ in range(most):
        turn = rng.random(n) < 0.7
        made[turn] ^= np.uint64(1) << rng.integers(0, 64, int(turn.sum())).astype(np.uint64)
    return made


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aBÉ \t\n\x1c ​é", max_size=40)), max_size=8))
def test_fingerprints_of_any_texts(texts):
    assert simhash.fingerprints(pa.array(texts, pa.string())).tolist() == [plain_print(t) for t in texts]


def test_fingerprints_of_odd_and_long_texts():
    texts = [*ODD_TEXTS, "a b a b " * 600, " ".join("xyz"[i % 3] for i in range(255 * 4 + 3))]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [plain_print(t) for t in texts]


def test_bits_need_more_than_half():
    hashes = np.array([0b1100, 0b1010, 0b1000, 0b0110], dtype=np.uint64)
    assert simhash.majority_bits(hashes, np.array([0, 4, 0])).tolist() == [0, 0b1000, 0]
    assert simhash.majority_bits(hashes, np.array([2, 1, 1])).tolist() == [0b1000, 0b1000, 0b0110]


@pytest.mark.parametrize("leaf", [2, 64])
@pytest.mark.parametrize("seed", range(4))
def test_the_trees_of_a_shard_lose_no_pair(monkeypatch, leaf, seed):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "SIDE", 50)
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    prints = np.unique(np.concatenate([base, flipped(rng, base[:20], 500, 2 + seed)]))
    groups = simhash.Groups(len(prints))
    for part in range(3):
        groups.join(np.arange(len(prints)), simhash.joined(prints, part))
    assert groups.least(np.arange(len(prints))).tolist() == plain_components(prints).tolist()


def test_two_of_every_linked_pair_meet_in_a_shard():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    pairs = [(base, base.copy()), (base, base ^ np.uint64(1 << 63 | 1 << 40 | 1 << 21 | 1))]
    pairs.append((base, base ^ np.uint64(0b1111)))
    for part_of_pairs in pairs:
        met = np.zeros(4000, dtype=bool)
        for part, (_, _, radius) in enumerate(simhash.PARTS):
            a, b = (simhash._part(side, part) for side in part_of_pairs)
            tree, shards = simhash.upper_tree(a, radius, 40)
            assert shards > 20
            where = [{s: set(rows.tolist()) for s, rows in simhash.dealt(side, radius, tree)} for side in (a, b)]
            for shard, rows in where[0].items():
                met[list(rows & where[1].get(shard, set()))] = True
        assert met.all()


def found_components(session, rows):
    return {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(session, rows)).collect()}


@pytest.mark.parametrize("at_once", [40_000, 60])
def test_components_of_many_shards_and_tiles(session, monkeypatch, at_once):
    monkeypatch.setattr(simhash, "MOST_AT_ONCE", at_once)
    monkeypatch.setattr(simhash, "SHARD", 40)
    monkeypatch.setattr(simhash, "LEAF", 8)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    prints = np.unique(np.concatenate([base, flipped(rng, base[:3], 900, 4), np.zeros(1, np.uint64)]))
    table = session.createDataFrame([(int(b),) for b in prints.view(np.int64)], "bits BIGINT")
    groups = simhash.Groups(len(prints))
    place = {int(b): i for i, b in enumerate(prints.view(np.int64))}
    links = simhash.linked(table).collect()
    assert all(int(r.a ^ r.b & (1 << 64) - 1) for r in links)
    groups.join(np.array([place[r.a] for r in links]), np.array([place[r.b] for r in links]))
    assert groups.least(np.arange(len(prints))).tolist() == plain_components(prints).tolist()


def test_copies_near_copies_and_others(session):
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(500)])
    texts = [" ".join(rng.choice(words, 400)) for _ in range(30)]
    near = [text.rsplit(" ", 1)[0] + f" other{i}" for i, text in enumerate(texts[:10])]
    rows = list(enumerate([*texts, *near, *[texts[0].upper()] * 300, "", None, "  "]))
    expected = [plain_print(t) for _, t in rows]
    distinct = sorted(set(expected))
    groups = plain_components(distinct)
    least = {}
    for (doc, _), value in zip(rows, expected):
        group = groups[distinct.index(value)]
        least[group] = min(doc, least.get(group, doc))
    found = found_components(session, rows)
    assert found == {doc: least[groups[distinct.index(v)]] for (doc, _), v in zip(rows, expected)}
    assert found[339] == 0 and found[341] == found[342] == 340


def test_odd_documents(session):
    result = simhash.near_duplicates(odd_documents(session)).collect()
    assert len(result) == 2 * len(ODD_TEXTS)
    assert {r.bits & (1 << 64) - 1 for r in result} == {plain_print(t) for t in ODD_TEXTS}
    assert simhash.near_duplicates(no_documents(session)).collect() == []
    nameless = simhash.near_duplicates(documents(session, [(None, "a b"), (None, "c d e f g")])).collect()
    assert [r.component_id for r in nameless] == [None, None]


def test_query_equals_brute_force(session):
    folder = "/root/testdata/sf0.001"
    docs = session.read.parquet(f"{folder}/documents.parquet").collect()
    prints = [plain_print(r.text) for r in docs]
    distinct = sorted(set(prints))
    groups = dict(zip(distinct, plain_components(distinct).tolist()))
    least = {}
    for r, value in zip(docs, prints):
        least[groups[value]] = min(r.doc_id, least.get(groups[value], r.doc_id))
    found = driver.queries()["op12_simhash"](session, folder).collect()
    assert sorted(map(tuple, found)) == sorted(
        (r.doc_id, f"{v:016x}", least[groups[v]]) for r, v in zip(docs, prints)
    )
    assert len(least) < len(docs)
