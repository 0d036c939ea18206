"""Toxicity and quality: held-out accuracy, what the methods promise, and odd input."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farebox.llm import quality, queries, toxicity
from rows import documents, labels, no_documents, odd_documents

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize(("name", "target", "least"), [("op3_toxicity", "toxic", 0.98), ("op7_quality", "quality", 0.95)])
def test_held_out_accuracy(session, name, target, least):
    known = session.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(target).alias("truth"))
    found = queries.queries()[name](session, SF)
    assert found.count() == session.read.parquet(f"{SF}/documents.parquet").count()
    judged = found.where("held_out").join(known, "doc_id")
    right, n = judged.agg(F.avg((F.col("predicted") == F.col("truth")).cast("double")), F.count("*")).head()
    assert n > 500 and right >= least
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def nobody():
    return F.lit(False)


def entries(texts):
    terms, rows = toxicity.terms_of(pa.array(texts))
    return toxicity._distinct(rows, terms, toxicity.TERM_BITS)


def test_pairs_count_beyond_their_parts():
    """Neither an insult alone nor a mention alone is toxic; both together are."""
    rng = random.Random(1)
    texts, truth = [], []
    for _ in range(1200):
        insult, mention = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(["plain", "words", "of", "no", "account"], k=8)
        texts.append(" ".join(words + ["zounderkite"] * insult + ["neighbours"] * mention))
        truth.append(insult and mention)
    truth = np.array(truth, dtype=float)
    model = toxicity.fit_entries(*entries(texts), truth)
    rows, terms = entries(["no zounderkite", "no neighbours", "no zounderkite neighbours", ""])
    known = model.place[terms] >= 0
    scores = model.logits(rows[known], model.place[terms[known]], 4)
    assert scores[2] > 0 > max(scores[0], scores[1], scores[3])
    assert np.linalg.norm(model.factors, axis=1).max() > 0.3


def test_a_model_without_labels_scores_all_alike(session):
    docs = odd_documents(session)
    for known in (labels(session, []), labels(session, [(None, 1, 1), (3, None, None)])):
        toxic = toxicity.fit(docs, known, nobody())
        scores = {r[0] for r in docs.select(toxicity.toxicity("text", toxic, docs)).collect()}
        assert len(scores) == 1 and scores.pop() < toxicity.THRESHOLD
        poor = quality.fit(docs, known, nobody())
        assert [r[0] for r in docs.select(quality.quality("text", poor, docs)).collect()] == pytest.approx([1.0] * 22)
    bad = quality.fit(docs, labels(session, [(4, 0, 0)]), nobody())
    assert max(r[0] for r in docs.select(quality.quality("text", bad, docs)).collect()) < 0.01


def test_repeated_rows_and_labels_teach_once(session):
    docs = documents(session, [(i, f"text number {i} {'bad' if i % 2 else 'good'}") for i in range(40)], clashing=True)
    known = labels(session, [(i, 1 - i % 2, i % 2) for i in range(40)] * 3)
    twice = docs.union(docs)
    for module, score in ((toxicity, toxicity.toxicity), (quality, quality.quality)):
        one, two = (module.fit(d, known, nobody()) for d in (docs, twice))
        scores = [[r[0] for r in docs.orderBy("doc_id").select(score("text", m, docs)).collect()] for m in (one, two)]
        assert scores[0] == pytest.approx(scores[1])


def test_held_out_labels_are_not_seen(session):
    docs = documents(session, [(i, f"words {'vile' if i < 20 else 'kind'} {i}") for i in range(40)])
    known = labels(session, [(i, int(i >= 20), int(i < 20)) for i in range(40)])
    model = toxicity.fit(docs, known, F.col("doc_id") >= 0)
    assert not len(model.weights)


def test_no_documents(session):
    docs, known = no_documents(session), labels(session, [(1, 1, 0)])
    assert docs.select(toxicity.toxicity("text", toxicity.fit(docs, known, nobody()), docs)).collect() == []
    assert docs.select(quality.quality("text", quality.fit(docs, known, nobody()), docs)).collect() == []


def test_windows_hold_the_whole_text():
    data = bytes(range(256)) * 33
    assert b"".join(quality.windows(data)) == data
    assert quality.CompressionClassifier(b"a b c d " * 50, b"% & $ # " * 50).difference(b"") == 0
