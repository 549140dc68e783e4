"""Toxicity by compression distance: windows of a text under a dictionary of ordinary and one of toxic text.

Two zstandard dictionaries of the same size are trained, one on passages of ordinary text, one on what
sets toxic text apart: the whole words that begin with a stretch of letters found in many times the share of
toxic documents than of ordinary ones, each with the marked words around it. A window is compressed with
the ordinary dictionary alone and with both; what the toxic one saves is a sign of toxicity. How many
windows save how many bytes is weighed by a logistic model, fitted on other labelled documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import whole_text

#: The fit takes at most so many labelled documents of each kind for the dictionaries, so many for the
#: weights, and none longer than so many characters. Scores are of whole texts of any length.
FIT_DOCS, WEIGHT_DOCS, FIT_CHARS = 1500, 3000, 20_000
WINDOW_BYTES = 48
#: Both dictionaries may take so much; the toxic one is smaller where few words set toxic text apart.
DICTIONARY_BYTES = 32_768
#: Shorter stretches are not looked up in a dictionary.
MIN_MATCH = 6
#: Beginnings of words have so many bytes at least, the blank before them included, and so many at most.
LEAST_BYTES, MOST_BYTES = 5, 24
#: A beginning marks toxicity if its share of toxic documents is at least so much, and so many times the other share.
LEAST_SHARE, RATIO = 0.03, 20.0
#: So many bytes of a word are its beginning, written as other bytes than the rest.
HEAD, APART = 7, bytes(b ^ 0x80 for b in range(256))
SAVED = (3, 4, 5, 6, 7, 8, 10)
THRESHOLD = 0.3


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
        min_match=MIN_MATCH,
        strategy=zstandard.STRATEGY_GREEDY,
        window_log=17,
        hash_log=15,
        chain_log=15,
        search_log=3,
        target_length=0,
    )


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    # A dictionary must have 8 bytes; blanks are in every window.
    data = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=_parameters(), dict_data=data)


def _train(samples: list[bytes], size: int, **parameters) -> bytes:
    """A trained dictionary, or the end of the samples themselves if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, **parameters).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def spelled(text: str) -> list[bytes]:
    """The words of a lower-case text, a blank before each, their first HEAD bytes written apart from all others.

    What begins a word then matches the beginnings of words only: many a toxic word is made of
    syllables that ordinary words have inside. Lower-case text has no capitals, so nothing is confused.
    """
    return [b" " + word[:HEAD].translate(APART) + word[HEAD:] for word in text.lower().encode("utf-8", "replace").split()]


def windows(text: str) -> list[bytes]:
    """The spelled text cut between words into windows of about WINDOW_BYTES; every word is in one."""
    out, current, size = [], [], 0
    for word in spelled(text):
        current.append(word)
        size += len(word)
        if size >= WINDOW_BYTES:
            out.append(b"".join(current) + b" ")
            current, size = [], 0
    if current:
        out.append(b"".join(current) + b" ")
    return out


def _beginnings(word: bytes) -> Iterator[bytes]:
    """A spelled word as a whole, and its beginnings, from the blank before it on."""
    yield word[:MOST_BYTES] + b" "
    yield from (word[:end] for end in range(LEAST_BYTES, min(len(word), MOST_BYTES) + 1))


def marking_words(toxic: Sequence[str], ordinary: Sequence[str]) -> list[list[bytes]]:
    """Per toxic document the words, whole and in their order, that have a beginning which marks toxic documents.

    A beginning marks them if many times the share of toxic documents has it, or has it in two words or more.
    """

    def held(texts: Sequence[str]) -> tuple[Counter, Counter]:
        once, twice = Counter(), Counter()
        for text in texts:
            own = Counter(b for w in spelled(text) for b in _beginnings(w))
            once.update(own.keys())
            twice.update(b for b, n in own.items() if n > 1)
        return once, twice

    least = max(min(4, len(toxic)), LEAST_SHARE * len(toxic))
    marks: set[bytes] = set()
    for of_toxic, of_ordinary in zip(held(toxic), held(ordinary), strict=True):
        share = lambda b: (of_ordinary[b] + 0.5) / max(1, len(ordinary))
        marks |= {b for b, n in of_toxic.items() if n >= least and n / len(toxic) >= RATIO * share(b)}
    return [[w for w in spelled(text) if not marks.isdisjoint(_beginnings(w))] for text in toxic]


@dataclass
class Model:
    """Two dictionaries and the weights of the features; without toxic examples all scores are 0."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None

    def __post_init__(self):
        self.compressors = None

    def __getstate__(self):
        return self.__dict__ | {"compressors": None}

    def features(self, text: str) -> list[float]:
        if self.compressors is None:
            self.compressors = _compressor(self.ordinary), _compressor(self.toxic + self.ordinary)
        one, both = (c.compress for c in self.compressors)
        saved = np.array([len(one(w)) - len(both(w)) for w in windows(text)] or [0], np.float64)
        n = len(saved)
        counts = [int((saved >= least).sum()) for least in SAVED]
        most = np.sort(saved)[::-1][:3].tolist() + [0.0, 0.0]
        return [math.log(n + 1), *(math.log(c + 1) for c in counts), *(c / n for c in counts), *most[:3], float(saved.mean())]

    def score(self, texts: Sequence[str]) -> np.ndarray:
        if self.weights is None or not len(texts):
            return np.zeros(len(texts))
        x = (np.array([self.features(t) for t in texts]) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -35, 35)))

    @classmethod
    def fit(cls, toxic: Sequence[str], ordinary: Sequence[str], weigh: Sequence[tuple[str, int]]) -> Model:
        """Dictionaries from toxic and ordinary texts, weights from other labelled ones at their natural rate."""
        rng = np.random.default_rng(42)
        pieces = []
        for text in ordinary[: max(1, len(ordinary) // 2)]:
            words = spelled(text)
            pieces += [b"".join(words[i : i + 8]) for i in range(0, len(words), 8)]
        some = [pieces[i] for i in rng.permutation(len(pieces))[:40_000]]
        marked = [words for words in marking_words(toxic, ordinary) if words] if toxic else []
        # Training looks for stretches that recur; a document's marked words follow each other as passages of eight.
        passages = [b"".join(words[i : i + 8]) for words in marked for i in range(0, len(words), 8)]
        strung = [passages[i] for at in range(-(-6000 // len(passages))) for i in rng.permutation(len(passages))] if passages else []
        model = cls(
            _train(some, DICTIONARY_BYTES) if some else b"",
            _train(strung, DICTIONARY_BYTES, k=50, d=6) if strung else b"",
            np.zeros(1),
            np.ones(1),
            None,
        )
        y = np.array([label for _, label in weigh], np.float64)
        if not strung or not 0 < y.sum() < len(y):
            return model
        x = np.array([model.features(text) for text, _ in weigh])
        model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        x = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
        ridge = np.full(x.shape[1], 0.5)
        ridge[-1] = 1e-6
        w = np.zeros(x.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            w += np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        model.weights = w
        return model


def held_out() -> F.Column:
    """Whether a document's label is kept from the fit; never so for a row without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of the labelled documents that are not held out, from a sample of bounded size.

    `labels` has doc_id and toxic, 0 or 1; rows with a NULL in either are ignored, and a document
    with several labels is toxic if one says so. Which rows the sample takes depends on
    doc_id alone. Half the labelled documents are for the dictionaries, half for the weights.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = F.xxhash64(F.lit("toxicity"), F.col("doc_id").cast("long"))
    known = known.select(F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("toxic"), draw.alias("draw"))
    part = F.pmod("draw", F.lit(2))
    samples = [
        known.where((part == 0) & (F.col("toxic") == 1)).orderBy("draw").limit(FIT_DOCS),
        known.where((part == 0) & (F.col("toxic") == 0)).orderBy("draw").limit(FIT_DOCS),
        known.where(part == 1).orderBy("draw").limit(WEIGHT_DOCS),
    ]
    chosen = samples[0].unionByName(samples[1]).unionByName(samples[2])
    short = docs.where(F.length("text") <= FIT_CHARS).select("doc_id", "text")
    # The chosen ids are at most 2 * FIT_DOCS + WEIGHT_DOCS.
    rows = short.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).dropDuplicates(["doc_id"])
    rows = sorted(rows.select("draw", "toxic", "text").collect())
    kinds = [[r.text for r in rows if r.draw % 2 == 0 and r.toxic == kind] for kind in (1, 0)]
    return Model.fit(kinds[0], kinds[1], [(r.text, r.toxic) for r in rows if r.draw % 2 == 1])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every whole text.

    `docs` has doc_id and text; other columns are ignored, repeated rows are rows like any
    other. A NULL text counts as empty; empty texts get the score of a text without signs.
    No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                scores = model.score(part.column(2).to_pylist())
                predicted = (scores >= threshold).astype(np.int32)
                columns = [part.column(0), part.column(1), pa.array(scores), pa.array(predicted)]
                yield pa.record_batch(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole_text("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [text or "" for text in part.column(part.schema.names.index("text")).to_pylist()]
                yield part.filter(pa.array(model.score(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
