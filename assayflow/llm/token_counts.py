"""Token counts of texts of any length, with overlapping chunks that are spliced where they agree.

A text longer than a chunk is encoded in chunks that overlap, with offsets. Two neighbours
are spliced at a token end inside the overlap that is proven stable: white space follows it,
at which the tokenizer cuts whatever stands around, and the token before it begins
and ends at the same places in both, as does the one after. Where the overlap holds no such
place, it is widened until it does or the text ends; so a text without white space is
encoded whole.

Within a chunk, tokens depend on nothing beyond the white space around a run of characters,
so runs seen before are looked up in a bounded store.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 256
#: Runs a Python worker remembers, and the length in bytes of those it does.
REMEMBERED, LONG = 400_000, 64

Encoder = Callable[[str], tuple[list[int], list[tuple[int, int]]]]


def stable_cut(text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], start: int, end: int) -> tuple[int, int] | None:
    """Where two encodings of overlapping pieces can be spliced: how many tokens of the left one stay, and
    from which token of the right one on; None if no place is proven.

    Offsets are those of the whole text; the pieces overlap in [start, end).
    """
    at_right = {span: i for i, span in enumerate(right) if span[1] <= end}
    for i in range(len(left) - 1, -1, -1):
        span = left[i]
        if span[0] < start:
            break
        j = at_right.get(span)
        # The first token of the right piece may have been cut off from what it belongs to.
        if j is None or j == 0 or span[1] >= end or not text[span[1]].isspace():
            continue
        following = left[i + 1] if i + 1 < len(left) else None
        # The last token of the left piece may have been cut; what follows the boundary in it must agree unless it was.
        if following is not None and following[1] < end and (j + 1 >= len(right) or right[j + 1] != following):
            continue
        return i + 1, j + 1
    return None


def spliced(text: str, encode: Encoder, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    """The token ids of a text of any length: those of its chunks, spliced."""
    piece = lambda a, b: (lambda ids, spans: (ids, [(a + s, a + e) for s, e in spans]))(*encode(text[a:b]))
    end = min(chunk, len(text))
    kept, done = [], 0  # tokens of chunks that are settled, and how many of the current chunk's are among them
    ids, spans = piece(0, end)
    while end < len(text):
        wide = overlap
        while True:
            start, stop = max(0, end - wide), min(len(text), end - wide + chunk if wide < chunk else end + chunk)
            more_ids, more_spans = piece(start, stop)
            cut = stable_cut(text, spans, more_spans, start, end)
            if cut is not None and cut[0] >= done:
                break
            if start == 0:
                # No place is stable: the text up to here is one piece.
                cut = (0, 0)
                kept, done = [], 0
                break
            wide *= 2
        kept += ids[done : cut[0]]
        ids, spans, done, end = more_ids, more_spans, cut[1], stop
    return kept + ids[done:]


class Counter:
    """Counts the tokens of texts as the tokenizer of a definition does, without tokens it adds itself."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a process for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.store: dict[bytes, int] = {}

    def encode(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return found.ids, found.offsets

    def count_short(self, texts: list[bytes]) -> list[int]:
        """Token counts of UTF-8 texts, run by run between ASCII white space."""
        runs = [text.split() for text in texts]
        new = list({run for each in runs for run in each if run not in self.store})
        if len(self.store) + len(new) > REMEMBERED:
            self.store.clear()
            new = list({run for each in runs for run in each})
        long = {}
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            found = self.tokenizer.encode_batch([run.decode() for run in part], add_special_tokens=False)
            for run, encoding in zip(part, found):
                (self.store if len(run) <= LONG else long)[run] = len(encoding)
        look = (lambda run: self.store[run] if run in self.store else long[run]) if long else self.store.__getitem__
        return [sum(map(look, each)) for each in runs]

    def count(self, texts: list[bytes], chunk: int, overlap: int) -> list[int]:
        """Token counts of UTF-8 texts; those of more than `chunk` characters are spliced."""
        out = [-1] * len(texts)
        short = []
        for i, text in enumerate(texts):
            # Characters are at most bytes, so most texts need no decoding to be known as short.
            if len(text) > chunk and len(whole := text.decode()) > chunk:
                out[i] = len(spliced(whole, self.encode, chunk, overlap))
            else:
                short.append(i)
        for i, n in zip(short, self.count_short([texts[i] for i in short])):
            out[i] = n
        return out


_counters: dict[str, Counter] = {}


def count_tokens(
    docs: DataFrame, definition: str, limit: int = 2048, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for every text.

    `docs` has doc_id and text; other columns are ignored, repeated rows are rows like any other.
    `definition` is the JSON text of a tokenizer that cuts at white space. Special strings inside
    texts are handled as by the library's default. A NULL text counts as empty, with no
    tokens; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition = shared.value
        counter = _counters.get(definition)
        if counter is None:
            counter = _counters[definition] = Counter(definition)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(1).to_pylist()
                tokens = np.array(counter.count(texts, chunk, overlap), np.int64)
                sizes = np.array([len(t) for t in texts], np.int64)
                columns = [part.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)]
                yield pa.record_batch(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
