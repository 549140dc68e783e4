"""Packed token ids against the library and plain packing."""

import io
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from assayflow.llm import token_files
from assayflow.llm.queries import QUERIES
from tests.llm.helpers import documents

DEFINITION = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
TRICKY = [
    "",
    " ",
    "a",
    "two  blanks \n\n and\tmore  ",
    "été déjà là   x  y 　z \x85q \x1c r",
    "中文 字 \n字 😀 😀\n",
    "it's we'll don 't ' s",
    "an <|endoftext|> inside<|endoftext|>",
    "end.\n\nnext \r\n line\x0b\x0c x",
    " lead ​ zero",
]


class Source:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


class Sink(io.BytesIO):
    def close(self):
        self.data = self.getvalue()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(DEFINITION)
    return lambda text: [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


@given(st.integers(1, 32).flatmap(lambda b: st.tuples(st.just(b), st.lists(st.integers(0, 2**b - 1), max_size=40))))
@settings(max_examples=200, deadline=None)
def test_packing_is_the_bits_one_after_the_other(case):
    bits, ids = case
    plain = sum(v << (i * bits) for i, v in enumerate(ids)).to_bytes(-(-len(ids) * bits // 8), "little")
    packed = token_files.pack(np.array(ids, np.uint32), bits)
    assert packed == plain
    assert token_files.unpack(packed, len(ids), bits).tolist() == ids


def test_bits_are_as_few_as_the_vocabulary_allows():
    assert [token_files.id_bits(n) for n in (1, 2, 3, 256, 257, 50_257, 2**17, 2**17 + 1)] == [1, 1, 2, 8, 9, 16, 17, 18]


def test_random_access_reads_the_blocks_needed():
    ids = np.arange(1000, dtype=np.uint32) * 7 % 5000
    sink = Sink()
    writer = token_files.TokenFileWriter(sink, 13, block_ids=64)
    lengths = np.array([1, 400, 0, 199, 400])
    for at, upto in itertools.pairwise([0, 2, 5]):
        span = slice(int(lengths[:at].sum()), int(lengths[:upto].sum()))
        writer.add(np.arange(at, upto), np.array([d != 3 for d in range(at, upto)]), lengths[at:upto], ids[span])
    assert writer.close() == len(sink.data)
    reads = []
    source = Source(sink.data)
    file = token_files.TokenFile(source)
    plain = source.read_at
    source.read_at = lambda n, at: reads.append(n) or plain(n, at)
    bounds = [0, *np.cumsum(lengths).tolist()]
    for i in range(5):
        assert file.document(i).tolist() == ids[bounds[i] : bounds[i + 1]].tolist()
    assert file.with_id.tolist() == [True, True, True, False, True]
    reads.clear()
    assert file.ids(130, 131).tolist() == [int(ids[130])]
    assert reads == [64 * 13 // 8]
    assert np.concatenate([part for _, part in file.stretches(2)]).tolist() == ids.tolist()
    with pytest.raises(IndexError):
        file.ids(0, 1001)
    with pytest.raises(ValueError):
        token_files.TokenFile(Source(sink.data[:-40] + b"\1" + sink.data[-39:]))
    with pytest.raises(ValueError):
        token_files.TokenFile(Source(b"TIDS"))


def test_runs_encode_as_whole_texts(library):
    encoder = token_files.Encoder(DEFINITION, 2)
    assert encoder.bits == 16
    texts = TRICKY + ["".join(p) for p in itertools.permutations(TRICKY[3:8], 3)] + [" ".join(TRICKY) * 50]
    lengths, ids = encoder.encode(pa.array([t.encode() for t in texts]))
    wanted = [library(t) for t in texts]
    assert lengths.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


@given(st.lists(st.text(st.sampled_from("aé  \n\t.'s9中 \x1c\x85<|")), max_size=6))
@settings(max_examples=150, deadline=None)
def test_any_mixture_of_white_space(library, texts):
    lengths, ids = token_files.Encoder(DEFINITION, 2).encode(pa.array([t.encode() for t in texts], pa.binary()))
    assert ids.tolist() == [i for t in texts for i in library(t)]
    assert lengths.sum() == len(ids)


@given(st.lists(st.text(st.sampled_from("aé \n.,'s9<|>endoftx-#")) | st.just("<|endoftext|>"), max_size=12).map("".join))
@settings(max_examples=150, deadline=None)
def test_any_mixture_of_letters_and_signs(library, text):
    texts = [text, f"{text}, <|endoftext|>{text}<|endoftext", "don't, can't. 's, x's-y"]
    lengths, ids = token_files.encoder(DEFINITION, 2).encode(pa.array([t.encode() for t in texts], pa.binary()))
    assert ids.tolist() == [i for t in texts for i in library(t)]
    assert lengths.sum() == len(ids)


def test_repeated_runs_outlast_those_met_once(library, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 60)
    encoder = token_files.Encoder(DEFINITION, 2)
    encoded = []
    plain = encoder._encode_new
    encoder._encode_new = lambda runs, joinable: encoded.extend(runs) or plain(runs, joinable)
    often = [f" often{c}{d}" for c in "abcde" for d in "vwxyz"]
    for i in range(12):
        # Signs do not make other runs of the same word.
        text = "".join(f"{word}{',.!#'[i % 4]}" for word in often) + "".join(f" once{c}{'abcdefghijkl'[i]}" for c in "mnopqrst")
        lengths, ids = encoder.encode(pa.array([text.encode()], pa.binary()))
        assert ids.tolist() == library(text) and lengths.tolist() == [len(ids)]
    assert [encoded.count(word.encode()) for word in often] == [1] * len(often)
    # Runs met once are forgotten.
    assert len(encoder.store) <= 60 + 8 and b" oncema" not in encoder.store
    assert encoder.stored_bytes == sum(map(len, encoder.store)) and len(encoder.met) == len(encoder.store)


def test_signs_stay_with_letters_where_the_pattern_is_not_used():
    from tokenizers import Tokenizer, pre_tokenizers

    other = Tokenizer.from_str(DEFINITION)
    other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(False, use_regex=False)])
    texts = ["word, e.g. (this) end.", "a.b.c, x"]
    _, ids = token_files.Encoder(other.to_str(), 2).encode(pa.array([t.encode() for t in texts], pa.binary()))
    assert ids.tolist() == [i for t in texts for i in [*other.encode(t, add_special_tokens=False).ids, 2]]


def expected(rows, library):
    out, start = [], 0
    for doc_id, text in rows:
        ids = library(text or "")
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def read(frame):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frame.collect()), key=lambda r: r[1])


def test_every_document_of_the_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert read(QUERIES["op13_token_files"](spark, sf_dir)) == expected(rows, library)


def test_nulls_empty_long_and_repeated_rows(spark, library):
    long = "word été 12 " * 30_000
    rows = [(None, "no id"), (1, None), (2, ""), (3, long), (4, "same"), (4, "same"), (9, "x" * 3000), (-5, "first of ids")]
    found = read(token_files.round_trip(documents(spark, rows), DEFINITION, 2))
    ordered = [rows[0], rows[7], *rows[1:7]]
    assert found == expected(ordered, library)
    # Rows of one doc_id with different texts are all kept, in an order that reruns agree on.
    ties = documents(spark, [(7, t) for t in TRICKY])
    once, again = (read(token_files.round_trip(ties, DEFINITION, 2)) for _ in range(2))
    assert once == again and len(once) == len(TRICKY)
    assert sorted(r[2:] for r in once) == sorted(r[2:] for r in expected([(7, t) for t in TRICKY], library))


def test_no_rows_and_many_small_files(spark, library):
    empty = documents(spark, []).where("false")
    assert token_files.round_trip(empty, DEFINITION, 2).count() == 0
    rows = [(i, f"text {i} " * (i % 90)) for i in range(300)]
    folder = token_files.shared_folder(spark, "token-files")
    docs = documents(spark, rows).repartition(3)
    index = token_files.write_files(docs, folder, DEFINITION, 2, file_ids=500, block_ids=16)
    found = token_files.read_files(index, folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == expected(rows, library)
    assert {r.doc_id: list(r.ids) for r in found} == {i: library(t) for i, t in rows}
