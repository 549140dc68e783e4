"""Near-duplicates by SimHash, found through pigeonhole blocks.

A fingerprint is cut into `blocks` parts. Two fingerprints that differ in at most
blocks - agree bits agree in at least `agree` parts, so they meet under one of the keys that
each choice of that many parts gives; only fingerprints under one key are compared. (With
`max_bits` above blocks - agree, as for long fingerprints and looser similarity, sharing a
key is likely rather than certain; see `near_duplicates`.) Under a key, fingerprints are
verified by Hamming distance and united in the task; what leaves it is about one link per
fingerprint, never a pair for each two members of a group.

`keep_first` takes such links for candidates only and holds the texts' sets of shingles against each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm import similar_sets
from assayflow.llm.common import staged, whole_text
from assayflow.llm.components import connected_components

#: Shingles whose bits are counted at a time: columns of bytes that cannot overflow, so many of them.
ROWS, CHUNK = 255, 255 * 64
#: Groups of up to so many fingerprints are compared by shifts of the whole batch.
SMALL = 12
#: More fingerprints under one key are dealt into pieces of that size, each two of which are searched together.
PIECE = 1 << 17


def _widen(hashes: np.ndarray, words: int) -> np.ndarray:
    """(n, words) hashes from n: the given ones, then independent mixes of them."""
    out = np.empty((len(hashes), words), np.uint64)
    out[:, 0] = hashes
    for i in range(1, words):
        x = (hashes ^ np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, i] = x ^ (x >> np.uint64(31))
    return out


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """A 64-bit hash of each shingle of `width` words of UTF-8 bytes; a text of fewer words is one shingle."""
    words = text.lower().split()  # of bytes: A-Z alone, and the six ASCII white-space characters
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        last = np.cumsum(lengths + 1) - 1
        starts, ends = (last - lengths)[: 1 - width].tolist(), last[width - 1 :].tolist()
    digest = xxhash.xxh64_digest
    data = b"".join([digest(joined[s:e], 42) for s, e in zip(starts, ends)])
    return np.frombuffer(data, ">u8").astype(np.uint64)


def majority(hashes: np.ndarray, words_out: int) -> bytes:
    """The bits that more than half of the hashes have, 8 bytes per word, big-endian."""
    counts = np.zeros(64 * words_out, np.int64)
    for at in range(0, len(hashes), CHUNK):
        data = _widen(hashes[at : at + CHUNK], words_out).astype(">u8").tobytes()
        bits = np.unpackbits(np.frombuffer(data, np.uint8).reshape(-1, 8 * words_out), axis=1)
        for row in range(0, len(bits), ROWS):
            counts += np.add.reduce(bits[row : row + ROWS], axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def fingerprint(text: bytes, width: int, words_out: int = 1) -> bytes:
    """The SimHash of UTF-8 bytes over shingles of `width` words, repeats included: 8 bytes per word, big-endian.

    A text of fewer words is one shingle; without words all bits are zero.
    """
    return majority(shingle_hashes(text, width), words_out)


def fingerprints(docs: DataFrame, width: int = 4, words_out: int = 1) -> DataFrame:
    """doc_id and the fingerprint of its whole text, 8 bytes per word; a NULL text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text.as_py(), width, words_out) for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(values, pa.binary())], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp binary")


def _masks(n_bits: int, blocks: int, agree: int) -> np.ndarray:
    """For each choice of `agree` parts, the bits of those parts: (choices, words)."""
    edges = [n_bits * i // blocks for i in range(blocks + 1)]
    bits = np.zeros((blocks, n_bits), np.uint8)
    for i in range(blocks):
        bits[i, edges[i] : edges[i + 1]] = 1
    chosen = [bits[list(parts)].sum(axis=0).astype(np.uint8) for parts in combinations(range(blocks), agree)]
    return np.packbits(np.array(chosen), axis=1).view(">u8").astype(np.uint64)


def block_keys(reps: DataFrame, n_bits: int, blocks: int, agree: int, alone: bool = False, carried: int | None = None) -> DataFrame:
    """Every fingerprint under each of its keys: key, rep, fp, or the key `alone`; of fp the first `carried` words.

    Keys are hashes; what meets by chance is verified away. A column `prefix` holds further keys, 8 bytes each.
    """
    further = ["prefix"] if "prefix" in reps.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = _masks(n_bits, blocks, agree)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _words(batch.column(1), n_bits)
            reps, prints = batch.column(0), batch.column(1)
            if carried:
                prints = pa.array([fp.as_py()[: 8 * carried] for fp in prints], pa.binary())
            if further:
                own = [np.frombuffer(p.as_py(), np.int64) for p in batch.column(2)]
                of = pa.array(np.repeat(np.arange(len(own)), [len(p) for p in own]))
                columns = [pa.array(np.concatenate(own)), reps.take(of), prints.take(of)]
                yield pa.record_batch(columns[:1] if alone else columns, ["key"] if alone else ["key", "rep", "fp"])
            for number, mask in enumerate(masks):
                key = np.full(len(values), number + 1, np.uint64)
                for i in np.flatnonzero(mask):
                    key = (key ^ (values[:, i] & mask[i])) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                columns = [pa.array(key.view(np.int64)), reps, prints]
                yield pa.record_batch(columns[:1] if alone else columns, ["key"] if alone else ["key", "rep", "fp"])

    return reps.select("rep", "fp", *further).mapInArrow(run, "key long" if alone else "key long, rep long, fp binary")


def _words(column, n_bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, n_bits // 64)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _unite(values: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Positions and the position each was reached from, connecting all that steps of up to `max_bits` connect.

    Values not yet reached are compared with one reached value at a time, so a dense group
    costs little more than one pass, however many of its pairs are close.
    """
    ends, roots = [], []
    unreached = np.arange(len(values))
    while len(unreached):
        root, unreached = unreached[0], unreached[1:]
        queue = [root]
        while queue and len(unreached):
            near = _distance(values[unreached], values[queue.pop()]) <= max_bits
            if near.any():
                found = unreached[near]
                queue.extend(found.tolist())
                ends.append(found)
                roots.append(np.full(len(found), root))
                unreached = unreached[~near]
    return ends, roots


def _links_of(keys: np.ndarray, reps: np.ndarray, values: np.ndarray, max_bits: int):
    """Links within each run of equal keys."""
    starts = np.flatnonzero(np.r_[True, np.any(keys[1:] != keys[:-1], axis=1)])
    sizes = np.diff(np.r_[starts, len(keys)])
    a, b = [], []
    left = np.repeat(np.where(sizes <= SMALL, sizes, 0), sizes) - (np.arange(len(keys)) - np.repeat(starts, sizes))
    for shift in range(1, SMALL):
        at = np.flatnonzero(left > shift)
        if not len(at):
            break
        at = at[_distance(values[at], values[at + shift]) <= max_bits]
        a.append(reps[at])
        b.append(reps[at + shift])
    for i in np.flatnonzero(sizes > SMALL):
        part = slice(starts[i], starts[i] + sizes[i])
        ends, roots = _unite(values[part], max_bits)
        a += [reps[part][x] for x in ends]
        b += [reps[part][x] for x in roots]
    return np.concatenate(a or [reps[:0]]), np.concatenate(b or [reps[:0]])


def _verify(n_bits: int, max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, reps, values = np.empty((0, 2), np.int64), np.empty(0, np.int64), np.empty((0, n_bits // 64), np.uint64)

        def out(upto: int):
            a, b = _links_of(keys[:upto], reps[:upto], values[:upto], max_bits)
            return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            more = np.column_stack([batch.column(i).to_numpy() for i in (0, 1)])
            keys = np.concatenate([keys, more])
            reps = np.concatenate([reps, batch.column(2).to_numpy()])
            values = np.concatenate([values, _words(batch.column(3), n_bits)])
            # The last key may go on in the next batch.
            upto = int(np.argmax(np.all(keys == keys[-1], axis=1)))
            if upto:
                yield out(upto)
                keys, reps, values = keys[upto:], reps[upto:], values[upto:]
        if len(keys):
            yield out(len(keys))

    return run


def links(
    reps: DataFrame, n_bits: int, blocks: int, agree: int, max_bits: int, piece: int = PIECE, carried: int | None = None
) -> DataFrame:
    """a, b: links between fingerprints' reps that connect all within `max_bits` of each other that share a key.

    `reps` has rep, fp, one row per fingerprint, and may have a `prefix` of further keys. With `carried`, fingerprints
    are compared by as many of their words, which is all of them that travels with the keys. The rows of a key that has more than
    `piece` are dealt into pieces, and each two pieces go to a task of their own.
    """
    keyed = block_keys(reps, n_bits, blocks, agree, carried=carried).withColumn("sub", F.lit(0).cast("long"))
    if reps.count() > piece:
        # Keys are computed again rather than kept: they take many times the room of the fingerprints.
        hot = block_keys(reps, n_bits, blocks, agree, alone=True).groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n")).where(F.col("n") > piece)
        hot, _ = staged(hot.select("of", F.ceil(F.col("n") * 2 / piece).alias("pieces")), "simhash-hot")
        if not hot.isEmpty():
            own = F.pmod(F.xxhash64("rep"), F.col("pieces"))
            pairs = F.when(F.col("pieces").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
                F.transform(
                    F.filter(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1), lambda i: i != own),
                    lambda i: F.least(i, own) * F.col("pieces") + F.greatest(i, own),
                )
            )
            keyed = keyed.join(hot, F.col("key") == F.col("of"), "left").withColumn("sub", F.explode(pairs))
    dealt = keyed.select("key", "sub", "rep", "fp").repartition("key", "sub").sortWithinPartitions("key", "sub")
    return dealt.mapInArrow(_verify(64 * carried if carried else n_bits, max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame, width: int = 4, n_bits: int = 64, blocks: int = 6, agree: int = 2, max_bits: int = 4
) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links of up to `max_bits` differing bits reach.

    `docs` has doc_id and text; other columns are ignored. One row per input row. A NULL text
    counts as empty; texts without words have the zero fingerprint, which links like any other. Rows
    that share a doc_id are in one component. Rows without doc_id take the component of
    their fingerprint, NULL if no row with that fingerprint has an id. No rows give no rows.

    The defaults find every link: fingerprints that differ in at most blocks - agree bits share a
    key for certain.
    """
    prints, _ = staged(fingerprints(docs, width, n_bits // 64), "simhash-prints")
    reps, _ = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    found = connected_components(links(reps.where("rep is not null"), n_bits, blocks, agree, max_bits))
    components = reps.join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("fp").alias("of"), F.coalesce("root", "rep").alias("component_id")
    )
    components, _ = staged(components, "simhash-components")
    return prints.join(components, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


#: Five-word shingles and a similarity (intersection by union of the sets) of 0.8, which is checked exactly; the rest
#: decides which texts are candidates. Texts of a similarity s have an angle of at most acos(2 s / (1 + s)) between them, for s = 0.8
#: 0.1515 of a half turn, and differ in about that part of the bits. They share one of 64 blocks of 16 bits with a
#: probability of 0.9917, and differ in 29 of the 192 bits that are compared, deviation 5; 58 are let pass, of 96 that
#: texts without a common shingle differ in.
SIMILAR = {"width": 5, "n_bits": 1024, "blocks": 64, "agree": 1, "carried": 3, "max_bits": 58}
LEAST = 0.8
#: Bits of a few shingles stray: sets of up to so many also meet under their smallest hashes, which finds all pairs of them.
SHORT = 80


def _prefix(hashes: np.ndarray, least: float) -> np.ndarray:
    """Of sorted hashes so many that two sets of a similarity of at least `least` share one."""
    return hashes[: len(hashes) - math.ceil(least * len(hashes) - 1e-9) + 1] if len(hashes) <= SHORT else hashes[:0]


def _sets(docs: DataFrame, width: int, words_out: int, least: float) -> DataFrame:
    """doc_id, text_hash, digest, n, fp, prefix: of each text's set of shingles a digest, its size and its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(text.as_py(), width)) for text in batch.column(2)]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            prints, prefixes = [majority(s, words_out) for s in sets], [_prefix(s, least).tobytes() for s in sets]
            columns = [pa.array(digests, pa.binary()), pa.array(map(len, sets), pa.int64()), pa.array(prints, pa.binary()), pa.array(prefixes, pa.binary())]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], ["doc_id", "text_hash", "digest", "n", "fp", "prefix"])

    rows = docs.select("doc_id", "text_hash", F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, digest binary, n long, fp binary, prefix binary")


def _set_data(texts: DataFrame, width: int):
    """root, node, n, data of members, from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.unique(shingle_hashes(text.as_py(), width)).tobytes() for text in batch.column(3)]
            yield pa.record_batch([*batch.columns[:3], pa.array(data, pa.binary())], ["root", "node", "n", "data"])

    def sets(members: DataFrame) -> DataFrame:
        different = texts.dropDuplicates(["doc_id", "text_hash"])
        rows = members.join(different, ["doc_id", "text_hash"]).select("root", "node", "n", F.col("text").cast("binary"))
        return rows.mapInArrow(run, "root long, node long, n long, data binary")

    return sets


def similar_texts(texts: DataFrame, least: float = LEAST, **parameters) -> DataFrame:
    """doc_id, text_hash: of each component of similar texts the smallest.

    `texts` has doc_id, text_hash and text, none of them NULL. Texts with equal sets of shingles are one; others are linked
    if `SIMILAR` takes them for candidates and their similarity is at least `least`.
    """
    chosen = SIMILAR | parameters
    width = chosen.pop("width")
    prints = _sets(texts, width, chosen["n_bits"] // 64, least)
    one = prints.groupBy("digest", "n", "fp", "prefix").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    nodes, _ = staged(one.select(F.monotonically_increasing_id().alias("node"), "first.*", "n", "fp", "prefix"), "simhash-nodes")
    candidates = connected_components(links(nodes.select(F.col("node").alias("rep"), "fp", "prefix"), **chosen))
    members, _ = staged(candidates.join(nodes.select("node", "doc_id", "text_hash", "n"), "node"), "simhash-candidates")
    alike, _ = staged(similar_sets.links(members, _set_data(texts, width), least), "simhash-alike")
    found, _ = staged(connected_components(alike), "simhash-found")
    grouped = nodes.select("node", "doc_id", "text_hash").join(found, "node", "left")
    return grouped.groupBy(F.coalesce("root", "node")).agg(F.min(F.struct("doc_id", "text_hash")).alias("kept")).select("kept.*")


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """The documents without near-duplicates: of each component of similar texts the row with the smallest doc_id.

    All columns of `docs` are kept, which has doc_id and text. Documents are similar if they share at least
    0.8 of their five-word shingles (`LEAST` and `SIMILAR`, unless parameters say otherwise); texts without words are
    alike. Rows of one doc_id are judged by their texts like any others: those that repeat a text are kept once, a text
    that is similar to no kept one stays, whatever its doc_id. Rows without doc_id are kept, as they cannot be told apart.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    kept, _ = staged(similar_texts(texts.withColumn("text_hash", F.xxhash64("text")), **parameters), "simhash-kept")
    # The documents in one column, so that no column of theirs can be taken for one of the join's.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    rows = docs.where("doc_id is not null").select(
        whole, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text("text")).alias("text_hash")
    )
    # Repeated rows may differ in other columns; the smallest hash of these decides, so that reruns agree.
    others = [F.col(f"whole.`{c}`").cast("string") for c, kind in docs.dtypes if c != "text" and not kind.startswith(("map", "variant"))]
    first = rows.join(kept, ["doc_id", "text_hash"], "left_semi").groupBy("doc_id", "text_hash")
    return first.agg(F.min_by("whole", F.xxhash64(*others)).alias("whole")).select("whole.*").unionByName(docs.where("doc_id is null"))
