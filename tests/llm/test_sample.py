"""Samples are of distinct rows, whatever the number of copies and partitions."""

from farebox.llm.common import hashed_sample, in_fold, labelled_sample
from rows import documents, labels


def sampled(df, most):
    return sorted(map(tuple, hashed_sample(df, most).collect()))


def test_copies_do_not_thin_a_sample(session):
    for seed in range(4):
        rows = [(i, f"text {seed} {i}") for i in range(3)] * 1000
        copies = documents(session, rows).select("text").repartition(7)
        assert sampled(copies, 150) == sorted((text,) for _, text in rows[:3])


def test_large_and_small_tables_are_sampled_alike(session):
    docs = documents(session, [(i, f"text {i}") for i in range(5000)]).select("doc_id", "text")
    few = sampled(docs, 40)
    assert len(few) == 40 and set(few) <= set(sampled(docs, 400)) and len(sampled(docs, 6000)) == 5000
    assert sampled(docs.union(docs.where("doc_id < 2000")), 40) == few
    assert sampled(docs.where("false"), 40) == []


def test_labelled_documents_are_read_once(session):
    docs = documents(session, [(i, f"text {i}") for i in range(50)], clashing=True)
    marks = labels(session, [(i, i % 2, None) for i in range(50)] + [(3, 1, None), (None, 1, 1)])
    sample = labelled_sample(docs, marks, "quality", in_fold("doc_id", 5, 0), 20)
    assert sample.count() <= 20 and sample.columns == ["doc_id", "label", "text"]
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "labelled" in plan
