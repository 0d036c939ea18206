"""Language-model scores: exact counts by brute force, and the filter's promises."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farebox.llm import lm, queries
from farebox.llm.common import in_fold, mixed, stored
from rows import no_documents, odd_documents

SMALL = 1 << 20


def tokens(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute_force(rows, held_out):
    counts = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        yield i, held_out(i), len(own), sum(counts[t] > 0 for t in own), total, base


def same(found, expected):
    def key(row):
        return (str(row[0]), *row[2:4], round(row[5], 6))

    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key)
    for ours, theirs in zip(found, sorted(expected, key=key), strict=True):
        assert ours[:5] == theirs[:5] and ours[5] == pytest.approx(theirs[5], abs=1e-6)


def in_seventh(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("head", [0, 50, 1 << 18])
def test_base_scores_are_exact_whatever_is_broadcast(session, sf_dir, head):
    docs = session.read.parquet(f"{sf_dir}/documents.parquet")
    found = lm.lm_scores(docs, in_fold("doc_id", 7, 2), SMALL, head).collect()
    same(found, brute_force([(r.doc_id, r.text) for r in docs.collect()], in_seventh))


def test_odd_documents(session):
    docs = odd_documents(session)
    found = lm.lm_scores(docs, in_fold("doc_id", 7, 2), SMALL).collect()
    same(found, brute_force([(r.doc_id, r.text) for r in docs.collect()], in_seventh))
    assert all(row.score <= 0 for row in found)
    assert lm.lm_scores(no_documents(session), in_fold("doc_id", 7, 2), SMALL).collect() == []
    nothing = lm.lm_scores(docs, F.lit(True), SMALL).collect()
    assert {(row.base_score, row.score, row.n_known, row.train_tokens) for row in nothing} == {(0.0, 0.0, 0, 0)}


def test_the_model_beats_single_words_on_held_out_text(session):
    found = queries.queries()["op6_lm_score"](session, "/root/testdata/sf0.01").where("held_out")
    score, base = found.agg(F.sum("score"), F.sum("base_score")).head()
    assert score > base


def test_the_filter_forgets_nothing_and_errs_seldom(session):
    rng = np.random.default_rng(5)
    keys = mixed(np.arange(20_000, dtype=np.uint64))
    counts = np.floor(1 / rng.random(20_000)).astype(np.int64)
    rows = session.createDataFrame([(int(k), int(n)) for k, n in zip(keys.view(np.int64), counts, strict=True)], "key BIGINT, n BIGINT")
    model = lm.build_filter(rows, SMALL)
    back = model.counts(keys)
    assert (back >= counts / 2**0.5).all() and np.median(back / counts) == pytest.approx(1, abs=0.2)
    assert (back <= counts * 2**0.5 + 1e-9).mean() > 0.95
    assert (model.counts(mixed(np.arange(30_000, 60_000, dtype=np.uint64))) > 0).mean() < 0.02


def test_counts_take_a_byte_unless_they_are_large():
    counts = np.array([1, 255, 256, 7, 1 << 20, 254, (1 << 32) - 1])
    held = lm.packed_counts(counts)
    assert len(held) == len(counts) + 3 * 4
    assert lm.unpacked_counts(held, len(counts)).tolist() == counts.tolist()
    assert lm.unpacked_counts(lm.packed_counts(counts[:0]), 0).tolist() == []


def test_steps():
    counts = np.arange(1, 5000)
    steps = lm.step_of(counts)
    assert (np.diff(steps) >= 0).all() and steps[0] == 1
    assert (np.abs(np.log2(lm.middle(steps) / counts)) <= 0.51).all()


def test_the_filter_grows_with_its_entries_and_drops_none():
    for n in (1_000, 100_000):
        keys = lm.unpacked(lm.packed(mixed(np.arange(2 * n, dtype=np.uint64))))
        bits = np.frombuffer(lm.filled_segment(keys[:n], np.ones(n)), np.uint8)
        assert 8 * len(bits) == lm.BITS * n
        back = lm.LogFrequencyFilter(bits, 1, segments=1).counts(keys)
        assert (back[:n] >= 1).all() and (back[n:] > 0).mean() < 0.02
    assert lm.segments_for(1000, lm.SEGMENT_TOKENS) == lm.SEGMENTS
    assert lm.segments_for(10**12, lm.SEGMENT_TOKENS) * lm.SEGMENT_TOKENS >= 10**12


def exact_scores(rows, held_out):
    """Scores from quantised counts that no filter has blurred, under the best weight."""
    words, pairs = Counter(), Counter()
    for i, text in rows:
        if not held_out(i):
            own = tokens(text)
            words.update(own)
            pairs.update(zip(["start", *own], own))
    total, distinct = sum(words.values()), len(words)

    def stored(count):
        return float(lm.stands_for(lm.step_of(np.array([float(count)])))[0]) if count else 0.0

    def score(text, weight, left_out=False):
        own = tokens(text)
        mine, ours = Counter(own), Counter(zip(["start", *own], own))
        summed = 0.0
        for before, token in zip(["start", *own], own):
            w, p, c = stored(words[token]), stored(pairs[before, token]), stored(words[before])
            if left_out:
                w, p, c = max(w - mine[token], 0), max(p - ours[before, token], 0), max(c - mine[before], 0)
            summed += math.log10((p + weight * (w + 1) / (total + distinct + 1)) / (max(c, p) + weight))
        return summed

    learned = [text for i, text in rows if not held_out(i)]
    best = max(lm.WEIGHTS, key=lambda weight: sum(score(text, weight, True) for text in learned))
    return {i: score(text, best) for i, text in rows}


@pytest.mark.parametrize("size", [lm.SEGMENT_TOKENS, 64])
def test_scores_are_those_of_all_words_and_pairs_whatever_the_segments(session, sf_dir, size):
    docs = session.read.parquet(f"{sf_dir}/documents.parquet").limit(40).cache()
    expected = exact_scores([(r.doc_id, r.text) for r in docs.collect()], in_seventh)
    found = {r.doc_id: r.score for r in lm.lm_scores(docs, in_fold("doc_id", 7, 2), size, bits=1 << 10).collect()}  # no chance hits
    assert found == pytest.approx(expected, abs=1e-6)


def test_chunks_ask_in_rounds_and_leave_no_shuffle(session, sf_dir, monkeypatch):
    rounds = []

    def noted(df, purpose, drop_shuffles=False, **more):
        table = stored(df, purpose, drop_shuffles, **more)
        if purpose == "row-sums":
            rounds.append((table.count(), drop_shuffles))
        return table

    monkeypatch.setattr(lm, "stored", noted)
    docs = session.read.parquet(f"{sf_dir}/documents.parquet").repartition(8)
    n = docs.count()
    assert lm.lm_scores(docs, in_fold("doc_id", 7, 2), SMALL).count() == n == sum(rows for rows, _ in rounds)
    assert max(rows for rows, _ in rounds) <= n / 2 and all(dropped for _, dropped in rounds)


def test_a_task_writes_its_chunks_to_one_file_and_rounds_read_all_files(session, sf_dir, monkeypatch):
    made = {}

    def noted(df, purpose, *settings, **more):
        table = stored(df, purpose, *settings, **more)
        made.setdefault(purpose, []).append(table)
        return table

    monkeypatch.setattr(lm, "stored", noted)
    docs = session.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).cache()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = session.conf.get(key)
    expected = {r.doc_id: r.score for r in lm.lm_scores(docs, in_fold("doc_id", 7, 2), SMALL).collect()}
    session.conf.set(key, "4")
    try:
        lm.lm_scores(docs, in_fold("doc_id", 7, 2), SMALL).count()
        (_, chunks), files = made["chunks"], 3
        assert chunks.count() > 4 * files and len(chunks.inputFiles()) == files
        monkeypatch.setattr(lm, "FILE_CHUNKS", 2)
        found = {r.doc_id: r.score for r in lm.lm_scores(docs, in_fold("doc_id", 7, 2), SMALL).collect()}
        assert len(made["chunks"][2].inputFiles()) > 2 * files and len(made["row-sums"]) == 3 + 3 + lm.ROUNDS
    finally:
        session.conf.set(key, before)
    assert found == pytest.approx(expected)


def test_words_are_neither_grouped_before_their_shuffle_nor_sorted_to_be_joined(session, sf_dir, monkeypatch):
    plans = {}

    def noted(df, purpose, *settings, **more):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, purpose, *settings, **more)

    monkeypatch.setattr(lm, "stored", noted)
    docs = session.read.parquet(f"{sf_dir}/documents.parquet")
    scores = lm.lm_scores(docs, in_fold("doc_id", 7, 2), SMALL)
    shuffle = plans["word-counts"].index("Exchange hashpartitioning(key")
    assert "HashAggregate" not in plans["word-counts"][shuffle:]
    assert "ShuffledHashJoin [key" in scores._jdf.queryExecution().executedPlan().toString()


def test_what_a_batch_asks_of_a_segment_is_looked_up_at_once(monkeypatch):
    keys = lm.unpacked(lm.packed(mixed(np.arange(400, dtype=np.uint64))))
    bits, calls = lm.filled_segment(keys[:300], np.arange(1, 301)), []
    look_up = lm.LogFrequencyFilter.steps
    monkeypatch.setattr(lm.LogFrequencyFilter, "steps", lambda self, asked: calls.append(len(asked)) or look_up(self, asked))
    rows = [(4, -1, bits), *((4, c, lm.packed(keys[c::5])) for c in range(5)), (6, 9, lm.packed(keys[:3]))]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*part, strict=True)], ["segment", "chunk", "data"])
        for part in (rows[:4], rows[4:])
    ]
    answers = pa.Table.from_batches(lm._answered(iter(batches))).to_pylist()
    assert [(a["segment"], a["chunk"]) for a in answers] == [(s, c) for s, c, _ in rows[1:]]
    expected = look_up(lm.LogFrequencyFilter(np.frombuffer(bits, np.uint8), 1, segments=1), keys)
    for c in range(5):
        assert list(answers[c]["data"]) == expected[c::5].tolist()
    assert answers[5]["data"] == bytes(3) and calls == [3 * 80, 2 * 80]


def test_logarithms_of_products_are_sums():
    rng = np.random.default_rng(3)
    counts = np.array([1, 7, 8, 9, 1, 300])
    words, pairs, context = (np.floor(1 / rng.random(counts.sum())) for _ in range(3))
    model = lm.LanguageModel(lm.SEGMENTS, 10**15, 10**14, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    found = np.array(model.sums(counts, words * 0, pairs * 0, context + 1e15).to_pylist())
    row = np.repeat(np.arange(len(counts)), counts)
    for k, weight in enumerate(lm.WEIGHTS):
        logs = np.log10(model.odds(words * 0, pairs * 0, context + 1e15, weight))
        assert found[:, k] == pytest.approx(np.bincount(row, logs), rel=1e-12)
