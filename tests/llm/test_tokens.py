"""Both tokenizer operators against the library, whose results they must give."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farebox.llm import bpe, queries, token_count
from rows import ODD_TEXTS, no_documents, odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()


def made_up(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    letters = "aabcdeéèßñ'’.,!?<|>0123 \n\tΣİKſ漢\U0001f600\x1c\x85　́"
    words = ["the", "a", "running", "don't", "<|endoftext|>", "x<|startoftext|>y", "we'LL", "12.5", "THEthe"]
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(n)]
    return mixed + [" ".join(rng.choices(words, k=30)) for _ in range(n // 4)]


TEXTS = [t or "" for t in ODD_TEXTS] + made_up(3, 400) + ["a" * 700, "ab" * 500, "aaa aa a" * 40]


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def test_encoding_and_decoding_equal_the_library():
    packed = bpe.encode_texts(pa.array(TEXTS), PATH)
    decoded = bpe.decode_ids(bpe._as_lists(packed), PATH).to_pylist()
    for text, ids, back in zip(TEXTS, packed, decoded, strict=True):
        assert (np.frombuffer(ids, "<u4").tolist(), back) == library(text)


def test_counts_equal_the_library():
    assert token_count.counter(PATH).count_texts(TEXTS) == [len(library(t)[0]) for t in TEXTS]


def test_both_forget_what_they_kept_without_harm(monkeypatch):
    for module, name in ((bpe, "KEPT_CHUNKS"), (bpe, "KEPT_PAIRS"), (token_count, "KEPT_CHUNKS")):
        monkeypatch.setattr(module, name, 3)
    encode = bpe.PrefixEncoder(bpe.vocabulary(PATH)).encode
    count = token_count.MergeCounter(bpe.vocabulary(PATH)).count_texts
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in TEXTS[:60]] == [library(t)[0] for t in TEXTS[:60]]
    assert count(TEXTS[:60]) == [len(library(t)[0]) for t in TEXTS[:60]]


def test_columns(session):
    docs = odd_documents(session)
    made = docs.select(
        "text", bpe.bpe_encode("text", PATH).alias("i"), token_count.token_count("text", PATH).alias("c")
    ).withColumn("back", bpe.bpe_decode("i", PATH))
    for row in made.collect():
        assert (row.i, row.back, row.c) == (*library(row.text), len(row.i))
    both = docs.select("text", bpe.bpe_codec("text", PATH).alias("made")).collect()
    assert all((row.made.ids, row.made.decoded) == library(row.text) for row in both)
    none = session.createDataFrame([(None,), ([],)], "ids ARRAY<INT>").select(bpe.bpe_decode("ids", PATH).alias("t"))
    assert [row.t for row in none.collect()] == ["", ""]


@pytest.mark.parametrize("name", ["op2_bpe_codec", "op9_token_count"])
def test_queries(session, sf_dir, name):
    texts = {r.doc_id: r.text for r in session.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.queries()[name](session, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        ids, decoded = library(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        if name.startswith("op2"):
            assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
            assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        else:
            assert (row.n_bytes, row.over_limit) == (len(texts[row.doc_id].encode()), len(ids) > 2048)


def test_no_rows(session):
    assert no_documents(session).select(bpe.bpe_digests("text", PATH), F.lit(1)).collect() == []


@pytest.mark.parametrize(
    "word",
    ["x" * 5000, "ab" * 3000, "aab" * 3000, "a" * 2001, "é" * 3000, "the" * 2000, "A1" * 4000, "w" * 2000 + "!"],
)
def test_long_words_that_merge(word):
    assert token_count.counter(PATH).count_texts([word, f"a {word} b"]) == [len(library(t)[0]) for t in (word, f"a {word} b")]
    assert [len(p) // 4 for p in bpe.encode_texts(pa.array([word]), PATH)] == [len(library(word)[0])]


def test_words_as_chains_equal_words_as_rows(monkeypatch):
    monkeypatch.setattr(token_count, "LONG_WORD", 2)
    fresh = token_count.MergeCounter(token_count.counter(PATH).vocab)
    texts = TEXTS + made_up(11, 300)
    assert fresh.count_texts(texts) == [len(library(t)[0]) for t in texts]


def test_a_million_letters_without_a_space():
    rng = np.random.default_rng(6)
    word = "".join(np.array(list("abcdefghijklmnopqrstuvwxyz"))[rng.integers(0, 26, 10**6)])
    expected = len(library(word)[0])
    started = time.perf_counter()
    assert token_count.counter(PATH).count_texts([word]) == [expected]
    assert len(bpe.encode_texts(pa.array([word]), PATH)[0]) == 4 * expected
    assert time.perf_counter() - started < 60
