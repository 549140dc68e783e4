"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text is encoded by the segmentation into pieces whose scores sum up highest. Blanks are
written as the marker U+2581, one of which stands before the text. A character that is no
piece costs ten less than the lowest score, and becomes its UTF-8 bytes.

No piece spans the end of a blank-separated word, nor a character that is in no piece, so
the best segmentation of a text is that of its chunks in a row. Chunks seen before are looked
up in a bounded store; the new ones of a batch of texts go through trie and Viterbi together,
one step for all start positions at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
UNKNOWN_COST = 10.0
#: Chunks a Python worker remembers; when there are more, it starts anew.
REMEMBERED = 400_000
#: Chunks longer than this many bytes are not remembered.
LONG = 64


@dataclass
class DoubleArray:
    """Trie of byte strings: from state s over byte c to base[s] + c + 1, if check there says s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> DoubleArray:
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            node = 0
            for code in key:
                following = children[node].get(code + 1)
                if following is None:
                    following = children[node][code + 1] = len(children)
                    children.append({})
                    values.append(-1)
                node = following
            values[node] = value
        size = 2 * len(children) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0] = 1
        slot = {0: 0}
        first_free = 1
        for node, below in enumerate(children):  # parents come before their children
            if not below:
                continue
            codes = sorted(below)
            at = max(first_free, codes[0])
            while True:
                at = used.find(0, at)
                b = at - codes[0]
                if all(not used[b + c] for c in codes):
                    break
                at += 1
            here = slot[node]
            base[here] = b
            for code in codes:
                used[b + code] = 1
                check[b + code] = here
                value[b + code] = values[below[code]]
                slot[below[code]] = b + code
            first_free = used.find(0, first_free)
        end = int(np.flatnonzero(np.frombuffer(used, np.uint8))[-1]) + 260
        base, check, value = (np.resize(x[:end], end) for x in (base, check, value))
        return cls(base, check, value)

    def matches(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray):
        """All keys that begin at the starts and end by their limits: start, end, value."""
        found: list[tuple] = []
        state, at, start, limit = np.zeros(len(starts), np.int64), starts, starts, limits
        while len(at):
            inside = at < limit
            state, at, start, limit = state[inside], at[inside], start[inside], limit[inside]
            following = self.base[state].astype(np.int64) + data[at] + 1
            going = (following < len(self.check)) & (self.check[np.minimum(following, len(self.check) - 1)] == state)
            state, at, start, limit = following[going], at[going] + 1, start[going], limit[going]
            value = self.value[state]
            hit = value >= 0
            found.append((start[hit], at[hit], value[hit]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (starts[:0],) * 3


@dataclass
class Model:
    """What encoding and decoding need of a model file; its size is that of the vocabulary."""

    trie: DoubleArray
    scores: np.ndarray
    byte_ids: np.ndarray
    surface: list[bytes]
    unknown_score: float
    hard: bytes

    @classmethod
    def from_pieces(cls, pieces: list[tuple[str, float, int]]) -> Model:
        """Pieces by id: text, score, type (1 normal, 2 unknown, 3 control, 4 user-defined, 6 byte)."""
        words = {text.encode(): i for i, (text, _, kind) in enumerate(pieces) if kind in (1, 4) and text}
        inner = [text for text, _, kind in pieces if kind in (1, 4) and MARKER in text.lstrip(MARKER)]
        if inner:
            raise ValueError(f"pieces with a marker inside cannot be encoded word by word: {inner[:3]}")
        byte_ids = np.full(256, -1, np.int64)
        surface = []
        for i, (text, _, kind) in enumerate(pieces):
            if kind == 6:
                byte_ids[int(text[3:5], 16)] = i
                surface.append(bytes([int(text[3:5], 16)]))
            else:
                surface.append(b"" if kind in (2, 3) else text.replace(MARKER, " ").encode())
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte fallback")
        lowest = min(score for _, score, kind in pieces if kind == 1)
        hard = b"" if any("\n" in text for text, _, kind in pieces if kind in (1, 4)) else b"\n"
        return cls(
            DoubleArray.build(words), np.array([s for _, s, _ in pieces], np.float64), byte_ids, surface, lowest - UNKNOWN_COST, hard
        )

    @classmethod
    def load(cls, path: str) -> Model:
        """From a model file, whose vocabulary the installed library reads.

        The scores are taken as they are. Those of a BPE file, such as piece_bpe_32k.model, are minus the merge rank and no
        logarithms, so the best path differs from what its merges give: the ids are not that tokenizer's.
        """
        import sentencepiece

        from_file = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: 6 if from_file.is_byte(i) else 3 if from_file.is_control(i) else 2 if from_file.is_unknown(i) else 1
        return cls.from_pieces([(from_file.id_to_piece(i), from_file.get_score(i), kind(i)) for i in range(from_file.get_piece_size())])

    def segment(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk, marker included, as packed 32-bit integers: Viterbi for all of them at once."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        data = np.frombuffer(b"".join(chunks), np.uint8)
        first = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(chunks)), lengths)
        begins = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
        starts, ends, ids = self.trie.matches(data, begins, (first + lengths)[owner[begins]])
        # Characters that are no piece of their own.
        after = np.minimum(np.append(begins[1:], len(data)), (first + lengths)[owner[begins]])
        single = np.zeros(len(data) + 1, np.int64)
        single[begins] = after
        known = np.zeros(len(data), bool)
        known[starts[ends == single[starts]]] = True
        unknown = ~known[begins]
        starts = np.concatenate([starts, begins[unknown]])
        ends = np.concatenate([ends, after[unknown]])
        ids = np.concatenate([ids, np.full(int(unknown.sum()), -1)])
        score = np.where(ids < 0, self.unknown_score, self.scores[ids])
        # Each chunk has a place more than it has bytes: its end.
        shift = owner[starts]
        own = starts - first[shift]
        order = np.argsort(own, kind="stable")
        starts, ends, ids, score, own, shift = (x[order] for x in (starts, ends, ids, score, own, shift))
        best = np.full(len(data) + len(chunks), -np.inf)
        best[first + np.arange(len(chunks))] = 0.0
        came, by = np.zeros(len(best), np.int64), np.zeros(len(best), np.int64)
        bounds = np.searchsorted(own, np.arange((own[-1] if len(own) else 0) + 2))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if a == b:
                continue
            source, target = starts[a:b] + shift[a:b], ends[a:b] + shift[a:b]
            value = best[source] + score[a:b]
            better = value > best[target]
            target = target[better]
            best[target], came[target], by[target] = value[better], source[better], ids[a:b][better]
        # Back from the ends, all chunks together.
        at, of = first + lengths + np.arange(len(chunks)), np.arange(len(chunks))
        bottom = first + np.arange(len(chunks))
        steps = []
        while len(at):
            steps.append((of, by[at], came[at]))
            at = came[at]
            open_ = at > bottom[of]
            at, of = at[open_], of[open_]
        of, piece, place = (np.concatenate([s[i] for s in reversed(steps)]) for i in range(3))
        order = np.argsort(of, kind="stable")
        of, piece, place = of[order], piece[order], place[order]
        cuts = np.searchsorted(of, np.arange(len(chunks) + 1)).tolist()
        packed = piece.astype(np.int32).tobytes()
        out = [packed[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:])]
        for i in np.unique(of[piece < 0]).tolist():
            ids_of: list[int] = []
            for p, s in zip(piece[cuts[i] : cuts[i + 1]].tolist(), (place[cuts[i] : cuts[i + 1]] - i).tolist()):
                ids_of += [p] if p >= 0 else self.byte_ids[data[s : int(single[s])]].tolist()
            out[i] = np.array(ids_of, np.int32).tobytes()
        return out

    def encode(self, texts: list[bytes], store: dict[bytes, bytes]) -> list[np.ndarray]:
        """The ids of UTF-8 texts; `store` is filled with those of their chunks."""
        # A chunk: blanks and what follows them up to the next blank; a character that is in no piece is one.
        stop = re.escape(self.hard)
        pattern = re.compile(rb" +[^ %s]*|[^ %s]+" % (stop, stop) + (rb"|" + stop if stop else rb""))
        cut = [pattern.findall(b" " + text) if text else [] for text in texts]
        new = {chunk for chunks in cut for chunk in chunks if chunk not in store}
        if len(store) + len(new) > REMEMBERED:
            store.clear()
            new = {chunk for chunks in cut for chunk in chunks}
        if new:
            wanted = list(new)
            marker = MARKER.encode()
            found = dict(zip(wanted, self.segment([chunk.replace(b" ", marker) for chunk in wanted])))
            store.update((chunk, ids) for chunk, ids in found.items() if len(chunk) <= LONG)
            long = {chunk: ids for chunk, ids in found.items() if len(chunk) > LONG}
        else:
            long = {}
        if long:
            look = lambda chunk: store[chunk] if chunk in store else long[chunk]
        else:
            look = store.__getitem__
        return [np.frombuffer(b"".join(map(look, chunks)), np.int32) for chunks in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: markers as blanks without the first one, bytes as UTF-8, U+FFFD where they are none."""
        text = b"".join(map(self.surface.__getitem__, ids))
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


#: Texts are encoded so many bytes at a time, or one text if it is larger.
BATCH_BYTES = 4 << 20


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > BATCH_BYTES:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


#: What this Python worker has encoded before, by model.
_stores: dict[int, dict[bytes, bytes]] = {}


def encode(docs: DataFrame, model: Model, name: str = "ids") -> DataFrame:
    """doc_id and the ids of its whole text.

    `docs` has doc_id and text; other columns are ignored, rows with equal ids are rows like any
    other. A NULL or empty text has no ids, not even that of the first marker. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        store = _stores.setdefault(hash(model.scores.tobytes()), {})
        for batch in batches:
            at = 0
            for texts in _groups(batch.column(1).to_pylist()):
                ids = model.encode(texts, store)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32)))
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), values], ["doc_id", name])
                at += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {name} array<int>")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id and the text of its ids; `encoded` has doc_id and ids. NULL ids give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [model.decode(ids or []) for ids in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text back.

    It does for every text without the marker character U+2581 itself, which decodes to a blank.
    NULL, empty and repeated rows as in `encode`; a NULL text counts as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        store = _stores.setdefault(hash(model.scores.tobytes()), {})
        for batch in batches:
            at = 0
            for texts in _groups(batch.column(1).to_pylist()):
                ids = model.encode(texts, store)
                same = [model.decode(i.tolist()).encode() == t for i, t in zip(ids, texts)]
                lengths = np.array([len(x) for x in ids], np.int64)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32)))
                columns = [batch.column(0).slice(at, len(texts)), pa.array(lengths), values, pa.array(same)]
                yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids", "lossless"])
                at += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, lossless boolean")
