"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest

from assayflow.llm import token_counts as tc
from assayflow.llm.queries import QUERIES
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def definition():
    return open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


@pytest.fixture(scope="module")
def counter(definition):
    return tc.Counter(definition)


def text_of(rng, n):
    parts = ["Word", "don't", "ÉÀ", "x́", " ", "  ", "\n", " ", " ", "\x1c", "\x85", "<|endoftext|>", "a<|startoftext|>b", "日本", "🙂", "123", "...", "Σ", "loooong" * 5, "\t", "'s"]
    return "".join(rng.choice(parts) + rng.choice(["", " ", "", "\n"]) for _ in range(n))


def test_spliced_chunks_equal_the_whole(counter):
    rng = random.Random(1)
    for n in range(80):
        text = text_of(rng, 150)
        whole = counter.encode(text)[0]
        for chunk, overlap in ((16, 4), (40, 8), (100, 1), (64, 63)):
            assert tc.spliced(text, counter.encode, chunk, overlap) == whole, (text, chunk, overlap)
    for text in ("a" * 500, "ab" * 300 + " " + "c" * 300, " " * 400, "x " * 300):
        assert tc.spliced(text, counter.encode, 50, 5) == counter.encode(text)[0]


def test_runs_equal_the_whole(counter, monkeypatch):
    rng = random.Random(2)
    texts = ["", " ", *(text_of(rng, 60) for _ in range(60))]
    want = [len(counter.encode(t)[0]) for t in texts]
    assert counter.count_short([t.encode() for t in texts]) == want
    monkeypatch.setattr(tc, "REMEMBERED", 10)
    assert [counter.count([t.encode()], 100, 10)[0] for t in texts] == want


def test_query_over_documents(spark, sf_dir, counter):
    rows = {r.doc_id: r for r in QUERIES["op8_token_counts"](spark, sf_dir).collect()}
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n = len(counter.encode(doc.text)[0])
        assert tuple(rows[doc.doc_id]) == (doc.doc_id, len(doc.text.encode()), n, n > 2048)


def test_edge_rows(spark, definition):
    docs = documents(spark, [(1, None), (2, ""), (2, ""), (None, "hello world"), (3, "word " * 20000)])
    rows = [tuple(r) for r in tc.count_tokens(docs, definition).collect()]
    assert sorted(rows, key=str) == sorted([(1, 0, 0, False), (2, 0, 0, False), (2, 0, 0, False), (None, 11, 2, False), (3, 100000, 20000, True)], key=str)
    assert tc.count_tokens(documents(spark, []), definition).collect() == []
