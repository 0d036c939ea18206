"""The join against brute force over all pairs, with planted copies of every kind."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from farebox.llm import components, jaccard, queries
from farebox.llm.common import mixed, row_starts, stored
from rows import documents, no_documents, odd_documents


def shingles(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """n_shingles and the least id of the component, by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known, default=None)
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def planted(seed, families, singles):
    """Families of near copies around the threshold, shared passages, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = []
    for _ in range(families):
        words = rng.choices(vocabulary, k=rng.choice([6, 12, 40, 120, 300]))
        for _ in range(rng.choice([2, 3, 8, 25])):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 20))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy += rng.choices(vocabulary, k=rng.randint(1, len(words) // 4 + 1))
            texts.append(" ".join(copy))
            if rng.random() < 0.3:
                texts.append("  " + texts[-1].upper().replace(" ", "\n") + " ")
    for _ in range(singles):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 80)))
        texts.append(f"{text} {passage}" if rng.random() < 0.5 else text)
    texts += ["", "a b", "a b", "A  B", "a b c d e", None, passage]
    rng.shuffle(texts)
    return [(i * 7, t) for i, t in enumerate(texts)]


def found(docs):
    return sorted(map(tuple, jaccard.jaccard_groups(docs).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(session, seed):
    rows = planted(seed, 25, 60)
    assert found(documents(session, rows, clashing=True)) == brute_force(rows)


def test_equals_brute_force_with_many_small_tiles(session, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 300)
    monkeypatch.setattr(jaccard, "COMMON", 2)
    rows = planted(3, 12, 40)
    assert found(documents(session, rows)) == brute_force(rows)


def test_odd_documents(session):
    docs = odd_documents(session)
    rows = [(row.doc_id, row.text) for row in docs.collect()]
    assert found(docs) == brute_force(rows)
    assert found(no_documents(session)) == []


def test_exactly_at_the_threshold(session):
    base = [f"t{i}" for i in range(13)]  # nine shingles
    rows = [(1, " ".join(base)), (2, " ".join([*base[:12], "other"])), (3, " ".join(base[:12])), (4, " ".join(base[:11]))]
    assert found(documents(session, rows)) == brute_force(rows)  # 8 of 10, 8 of 9, 7 of 8 shared


def test_query_equals_brute_force(session, sf_dir):
    rows = [(r.doc_id, r.text) for r in session.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.queries()["op5_ngram_jaccard"](session, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == brute_force(rows)


def test_one_of_each_group_stays(session):
    rows = planted(5, 15, 30)
    rows += rows[:10] + [(None, rows[3][1]), (None, "only without an id"), (None, "only without an id")]
    docs = documents(session, rows, clashing=True)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    wanted = {least for _, n, least in brute_force(rows) if n}
    with_words = [doc_id for doc_id, text in left if shingles(text)]
    assert sorted(with_words, key=str) == sorted(wanted, key=str)
    assert len([1 for _, t in left if not shingles(t)]) == len([1 for _, t in rows if not shingles(t)])
    assert jaccard.one_of_each(no_documents(session)).collect() == []


def test_bitmaps_never_bound_below_the_overlap():
    rng = np.random.default_rng(2)
    for _ in range(200):
        common = rng.integers(0, 1 << 63, rng.integers(0, 200), dtype=np.uint64)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, rng.integers(1, 100), dtype=np.uint64)])) for _ in "ab"]
        width = min(jaccard._bits(len(s)) for s in sets)
        one, other = jaccard.folded([jaccard.bitmap(s) for s in sets], width)
        bound = jaccard.overlap_bounds(one, len(sets[0]), other[None], np.array([len(sets[1])]))[0]
        assert bound >= len(np.intersect1d(*sets))


def test_sets_of_a_batch():
    texts = [None, "", "a b c", "A  b\tC", "a b c d e f", "x " * 3000]
    hashes, sizes = jaccard.shingle_sets(pa.array(texts))
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    keys = jaccard.set_keys(hashes, sizes)
    assert keys[2] == keys[3] != keys[4]


@pytest.mark.parametrize("rows", [1, 300, 70_000])
def test_shingles_are_in_order_within_each_row(rows):
    rng = random.Random(rows)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 9))) for _ in range(rows)]
    hashes, sizes = jaccard.shingle_sets(pa.array(texts))
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    inside = np.ones(max(len(hashes) - 1, 0), dtype=bool)
    inside[[b - 1 for b in row_starts(sizes)[1:-1] if 0 < b < len(hashes)]] = False
    assert (hashes[1:] > hashes[:-1])[inside].all()


def test_first_shingles_go_with_one_row_of_each_set():
    texts = ["", *(" ".join(f"{n}x{k}" for k in range(n)) for n in (3, 5, 9, 60, 400))]
    at = pa.array(range(2 * len(texts)))
    common = np.sort(mixed(np.arange(50, dtype=np.uint64)))
    hashes, sizes = jaccard.shingle_sets(pa.array(texts))
    common = np.sort(np.concatenate([common, hashes[::3]]))
    made = jaccard._measured(pa.RecordBatch.from_arrays([at, at, pa.array(texts * 2)], ["doc_id", "row", "text"]), common)
    assert made["n"].to_pylist() == 2 * sizes.tolist() and made["first"].to_pylist()[len(texts) :] == [b""] * len(texts)
    posted = jaccard._postings(made.select(["key", "first"]))
    for key, own in zip(jaccard.set_keys(hashes, sizes), np.split(hashes, row_starts(sizes)[1:-1]), strict=True):
        late = np.isin(own, common)
        wanted = np.concatenate([own[~late], own[late]])[: jaccard.prefix_length(np.array([len(own)]))[0]]
        found = posted["shingle"].to_numpy()[posted["key"].to_numpy() == key]
        assert found.view(np.uint64).tolist() == wanted.tolist()


def test_postings_are_made_without_the_texts(session, sf_dir, monkeypatch):
    read = {}

    def noted(df, purpose, **more):
        read[purpose] = df.inputFiles()
        return stored(df, purpose, **more)

    monkeypatch.setattr(jaccard, "stored", noted)
    jaccard.jaccard_groups(session.read.parquet(f"{sf_dir}/documents.parquet"))
    assert any("documents.parquet" in path for path in read["shingle-sets"])
    for purpose in ("shingles-met-twice", "postings"):
        assert read[purpose] and not any("documents.parquet" in path for path in read[purpose])


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(session, shape):
    rng = random.Random(4)
    pairs = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(1000, i) for i in range(50)] + [(5, 5)],
        "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(90)],
        "none": [],
    }[shape]
    parent = {x: x for pair in pairs if pair[0] != pair[1] for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    links = session.createDataFrame(pairs, "a BIGINT, b BIGINT")
    assert {tuple(r) for r in components.components(links).collect()} == {(x, root(x)) for x in parent}
