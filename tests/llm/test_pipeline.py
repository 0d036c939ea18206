"""The pipeline's stages, each against what its operator says of the documents before it."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline as pipeline
from farebox.llm import decontaminate, jaccard, quality, toxicity
from farebox.llm.common import in_fold, stored, table
from rows import odd_documents

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def passes(session):
    """The documents before and after each stage."""
    docs, found = table(session, SF, "documents"), []
    for _, stage in pipeline.STAGES:
        after = stored(stage(session, docs, SF), "stage")
        found.append((docs, after))
        docs = after
    return found


def ids(docs):
    return {row.doc_id for row in docs.select("doc_id").collect()}


def test_stages_keep_the_columns(passes):
    assert all(after.columns == COLUMNS for _, after in passes[:-1])
    assert [name for name, _ in pipeline.STAGES][2] == "n-gram Jaccard join"


def test_classifiers_drop_what_they_reject(session, passes):
    for (before, after), module, score, fold, target, rejected in (
        (passes[0], toxicity, toxicity.toxicity, in_fold("doc_id", 4, 2), "toxic", 1),
        (passes[1], quality, quality.quality, in_fold("doc_id", 5, 0), "quality", 0),
    ):
        labels = table(session, SF, "labels")
        model = module.fit(before, labels, fold)
        low = before.where(score("text", model, before) < module.THRESHOLD)
        kept = low if module is toxicity else before.join(low, "doc_id", "left_anti")
        assert ids(after) == ids(kept) and 0 < len(ids(after)) < len(ids(before))
        gone = labels.join(before, "doc_id").join(after, "doc_id", "left_anti")
        assert gone.where(F.col(target) == rejected).count() >= 0.8 * gone.count()


def test_one_of_each_group_stays(passes):
    before, after = passes[2]
    groups = jaccard.jaccard_groups(before).collect()
    assert ids(after) == {r.doc_id for r in groups if r.doc_id == r.component_id}


def test_no_item_is_left(session, passes):
    before, after = passes[3]
    leaked = {r.doc_id for r in decontaminate.leaked_items(before, table(session, SF, "benchmark")).collect()}
    assert leaked and ids(after) == ids(before) - leaked


def test_encoding_equals_the_library(passes):
    before, after = passes[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        expected = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.ids == expected and row.n_tokens == len(expected)
        assert row.decoded == library.decode(expected, skip_special_tokens=False)


def test_the_registered_query_runs_all_stages(session, passes):
    assert ids(driver.queries()["pipeline"](session, SF)) == ids(passes[-1][1])


def test_stages_take_odd_documents(session):
    for name, stage in pipeline.STAGES:
        for docs in (odd_documents(session), odd_documents(session).where("false")):
            after = stage(session, docs, SF)
            assert after.count() <= docs.count(), name
            if stage is not pipeline.encode:
                assert after.columns == docs.columns
