"""Token ids in files, each id in the fewest bits that the vocabulary needs.

A file holds the ids of consecutive documents, all ids one after the other, each document ended
by an end id. Ids are packed in blocks of BLOCK_IDS, each beginning at a byte:

    head    "TIDS", version (2 bytes), bits of an id (2), ids of a block (4)
    blocks  id i of a block in bits i * bits .. (i + 1) * bits, lowest first
    tables  doc_id of every document (8 each), whether it has one (1 each), ids up to its end (8 each),
            place of every block, and of the end of the last (8 each)
    foot    documents (8), ids (8), place of the tables (8), CRC-32 of the tables (4), "SDIT"

All numbers are little-endian. As all ids have the same width, NumPy unpacks whole blocks at
once, and any id or document is found from the tables without reading what is before it.

Files are written in order of doc_id by one task for each range of ids. The index,
staged as a table, says which files count: a task that runs again writes new files, and those of the lost
attempt are in no index row.
"""

from __future__ import annotations

import os
import string
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayflow.llm.common import discard, staged, whole_text
from assayflow.sources.paths import scratch_dir

MAGIC, FOOT_MAGIC, VERSION = b"TIDS", b"SDIT", 1
HEAD, FOOT = struct.Struct("<4sHHI"), struct.Struct("<QQQI4s")
#: Ids of a block, a multiple of 8; a file is closed beyond so many ids or documents.
BLOCK_IDS, FILE_IDS, FILE_DOCS = 65_536, 1 << 25, 1 << 20
#: Blocks read at once.
READ_BLOCKS = 16
#: Texts are encoded together up to so many bytes, new runs so many in one text.
BATCH_BYTES, JOINED = 8 << 20, 500
#: Runs that a Python worker remembers, and bytes of them, before it keeps the half that texts repeat most.
REMEMBERED, REMEMBERED_BYTES = 500_000, 16 << 20

INDEX = "part int, seq int, file string, n_docs long, n_ids long, n_bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>"


def id_bits(ids: int) -> int:
    """The bits that each of so many different ids needs."""
    return max(1, (ids - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2^bits, bits <= 32, one after the other, lowest bits first; the last byte is filled with zeros."""
    n = len(ids)
    lanes = np.zeros((-(-n // 8), 8), np.uint64)
    lanes.reshape(-1)[:n] = ids
    # Eight ids take `bits` whole bytes, and each of the eight touches the same bytes in every such group.
    out = np.zeros((len(lanes), bits), np.uint8)
    for lane in range(8):
        first, shift = divmod(lane * bits, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for byte in range(-(-(shift + bits) // 8)):
            out[:, first + byte] |= (value >> np.uint64(8 * byte)).astype(np.uint8)
    return out.tobytes()[: -(-n * bits // 8)]


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first n ids packed in `data`, as 32-bit unsigned integers."""
    groups = -(-n // 8)
    raw = np.zeros(groups * bits, np.uint8)
    given = np.frombuffer(data, np.uint8)[: len(raw)]
    raw[: len(given)] = given
    raw = raw.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    for lane in range(8):
        first, shift = divmod(lane * bits, 8)
        value = np.zeros(groups, np.uint64)
        for byte in range(-(-(shift + bits) // 8)):
            value |= raw[:, first + byte].astype(np.uint64) << np.uint64(8 * byte)
        out[:, lane] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:n]


class TokenFileWriter:
    """Writes one file of token ids to a stream; memory holds a block and the tables."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_docs = 0
        self.doc_ids: list[np.ndarray] = []
        self.with_id: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.out.write(HEAD.pack(MAGIC, VERSION, bits, block_ids))
        self.places = [HEAD.size]

    def add(self, doc_ids: np.ndarray, with_id: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents with so many ids each, the ids all in one array."""
        self.doc_ids.append(doc_ids.astype("<i8"))
        self.with_id.append(with_id.astype(np.uint8))
        self.ends.append((self.n_ids + np.cumsum(lengths)).astype("<u8"))
        self.n_ids += len(ids)
        self.n_docs += len(lengths)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block_ids:
            together = np.concatenate(self.waiting)
            whole = len(together) // self.block_ids * self.block_ids
            for at in range(0, whole, self.block_ids):
                self._block(together[at : at + self.block_ids])
            self.waiting, self.n_waiting = [together[whole:]], len(together) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.places.append(self.places[-1] + len(data))

    def close(self) -> int:
        """Write what is left, the tables and the foot; return the size of the file."""
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        together = lambda parts, kind: np.concatenate(parts).astype(kind).tobytes() if parts else b""
        tables = together(self.doc_ids, "<i8") + together(self.with_id, "u1") + together(self.ends, "<u8")
        tables += np.array(self.places, "<u8").tobytes()
        self.out.write(tables)
        self.out.write(FOOT.pack(self.n_docs, self.n_ids, self.places[-1], zlib.crc32(tables), FOOT_MAGIC))
        self.out.close()
        return self.places[-1] + len(tables) + FOOT.size


class TokenFile:
    """A file of token ids, open for reading: `source` has size() and read_at(n, place). Damaged files raise."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        if size < HEAD.size + FOOT.size:
            raise ValueError("no file of token ids")
        magic, version, self.bits, self.block_ids = HEAD.unpack(source.read_at(HEAD.size, 0))
        self.n_docs, self.n_ids, at, crc, foot = FOOT.unpack(source.read_at(FOOT.size, size - FOOT.size))
        if (magic, version, foot) != (MAGIC, VERSION, FOOT_MAGIC):
            raise ValueError("no file of token ids")
        tables = source.read_at(size - FOOT.size - at, at)
        blocks = -(-self.n_ids // self.block_ids)
        if zlib.crc32(tables) != crc or len(tables) != 17 * self.n_docs + 8 * (blocks + 1):
            raise ValueError("damaged tables of a file of token ids")
        n = self.n_docs
        self.doc_ids = np.frombuffer(tables, "<i8", n)
        self.with_id = np.frombuffer(tables, "u1", n, 8 * n).astype(bool)
        self.ends = np.frombuffer(tables, "<u8", n, 9 * n).astype(np.int64)
        self.places = np.frombuffer(tables, "<u8", blocks + 1, 17 * n).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at places [start, stop) of the file; reads only the blocks that hold them."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError(f"ids {start} to {stop} of {self.n_ids}")
        if start == stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, -(-stop // self.block_ids)
        data = self.source.read_at(int(self.places[last] - self.places[first]), int(self.places[first]))
        # Only the last block of a file may be no whole number of bytes, so neighbours unpack as one.
        found = unpack(data, min(last * self.block_ids, self.n_ids) - first * self.block_ids, self.bits)
        return found[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, its end id included."""
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))

    def stretches(self, blocks: int = READ_BLOCKS) -> Iterator[tuple[int, np.ndarray]]:
        """The whole file some blocks at a time: place of the first id, and the ids."""
        step = blocks * self.block_ids
        for start in range(0, self.n_ids, step):
            yield start, self.ids(start, min(self.n_ids, start + step))


class Encoder:
    """Token ids of many texts at once, as the tokenizer of a byte-level definition gives them.

    Such a tokenizer always cuts between a character that is not white space and a blank or line
    feed, and its own pattern between an ASCII letter and a sign, so texts are cut there into runs, and
    every different run is encoded once. Runs are found and told apart over whole arrays; Python sees
    only the different ones. New ones are encoded many together, as what is cut may also be joined, and
    parted by the bytes that their ids stand for. Runs met in most batches are remembered longest.
    """

    def __init__(self, definition: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a process for each core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.end_id = end_id
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or any(c.isspace() for c in t.content) for t in added.values()):
            raise ValueError("an added token takes white space, so texts cannot be cut there")
        self.bits = id_bits(max(*vocabulary.values(), end_id) + 1)
        # Signs cut off the letter before them: never the apostrophe, or what an added token may hold.
        cutter = self.tokenizer.pre_tokenizer
        self.signs = np.zeros(256, bool)
        if self.tokenizer.normalizer is None and isinstance(cutter, pre_tokenizers.ByteLevel) and cutter.use_regex:
            held = {"'", *(c for t in added.values() for c in t.content)}
            self.signs[[ord(c) for c in string.punctuation if c not in held]] = True
        # A sign of a byte-level piece is a byte of the text.
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, number in vocabulary.items():
            self.widths[number] = len(added[number].content.encode()) if number in added else len(piece)
        # Runs seen, with their numbers in order; the ids of all, one after the other; where those of each begin and
        # end; the batches that had each, halved whenever others are forgotten.
        self.store: dict[bytes, int] = {}
        self.pool, self.bounds, self.met = np.empty(0, np.uint32), np.zeros(1, np.int64), np.empty(0, np.int32)
        self.stored_bytes = 0

    def _forget(self) -> None:
        """Keep the runs that most batches had, the latest of equal ones, up to half of what may be remembered."""
        runs = list(self.store)
        best = np.argsort(self.met, kind="stable")[::-1][: REMEMBERED // 2]
        sizes = np.cumsum([len(runs[i]) for i in best.tolist()])
        kept = np.sort(best[sizes <= REMEMBERED_BYTES // 2])
        self.pool, counts = self._stored(kept)
        self.bounds, self.met = np.append(0, np.cumsum(counts)), self.met[kept] // 2
        self.store = {runs[i]: number for number, i in enumerate(kept.tolist())}
        self.stored_bytes = sum(map(len, self.store))

    def _stored(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs by number, one run after the other, and how many each has."""
        begin = self.bounds[numbers]
        own = self.bounds[numbers + 1] - begin
        # Each run's ids are a stretch of the pool.
        ahead = np.cumsum(own)
        return self.pool[np.repeat(begin - (ahead - own), own) + np.arange(ahead[-1] if len(ahead) else 0)], own

    @staticmethod
    def solid(data: np.ndarray) -> np.ndarray:
        """Which bytes end a character that is not white space in any sense; some characters beyond ASCII are left out.

        Taken are ASCII signs, and letters of two bytes from U+00C0 on or three from U+4000 on.
        """
        out = (data > 0x20) & (data < 0x7F)
        tail = (data >= 0x80) & (data < 0xC0)
        out[1:] |= tail[1:] & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        out[2:] |= tail[2:] & (data[:-2] >= 0xE4) & (data[:-2] < 0xF0)
        return out

    def run_starts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where runs begin in the bytes of texts laid one after the other; the texts begin at `starts`."""
        letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
        cut = np.zeros(len(data), bool)
        cut[1:] = self.solid(data)[:-1] & ((data[1:] == 0x20) | (data[1:] == 0x0A))
        cut[1:] |= letter[:-1] & self.signs[data[1:]]
        cut[starts[starts < len(data)]] = True
        return np.flatnonzero(cut)

    def _encode_new(self, runs: list[bytes], joinable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs, those that may be joined first, and how many each has."""
        encode = lambda texts: [
            np.array(found.ids, np.uint32)
            for at in range(0, len(texts), 1000)
            for found in self.tokenizer.encode_batch_fast([t.decode() for t in texts[at : at + 1000]], add_special_tokens=False)
        ]
        together = [run for run, joined in zip(runs, joinable, strict=True) if joined]
        alone = encode([run for run, joined in zip(runs, joinable, strict=True) if not joined])
        parts = encode([b"".join(together[at : at + JOINED]) for at in range(0, len(together), JOINED)])
        ids = np.concatenate([*parts, np.empty(0, np.uint32)])
        upto = np.cumsum(self.widths[ids])
        ends = np.cumsum([len(run) for run in together]).astype(np.int64)
        last = np.searchsorted(upto, ends)
        if len(ends) and (last[-1] + 1 != len(ids) or not (upto[last] == ends).all()):
            raise ValueError("the tokenizer does not cut at white space")
        counts = np.concatenate([np.diff(last, prepend=-1), [len(found) for found in alone]]).astype(np.int64)
        return np.concatenate([ids, *alone]), counts

    def _numbers(self, runs: pa.Array) -> np.ndarray:
        """The numbers of different runs in the store, which new ones enter."""
        if len(self.store) > REMEMBERED or self.stored_bytes > REMEMBERED_BYTES:
            self._forget()
        offsets = np.frombuffer(runs.buffers()[1], np.int32, len(runs) + 1, 4 * runs.offset)
        data = np.frombuffer(runs.buffers()[2] or b"", np.uint8)
        values = runs.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist
        numbers = np.array([self.store.get(run, -1) for run in values], np.int64)
        self.met[numbers[numbers >= 0]] += 1
        new = np.flatnonzero(numbers < 0)
        first, solid = data[offsets[new]], self.solid(data)[offsets[new + 1] - 1]
        joinable = ((first == 0x20) | (first == 0x0A)) & solid
        ids, counts = self._encode_new([values[i] for i in new.tolist()], joinable)
        new = np.concatenate([new[joinable], new[~joinable]])
        numbers[new] = len(self.store) + np.arange(len(new))
        self.store.update((values[i], number) for i, number in zip(new.tolist(), numbers[new].tolist(), strict=True))
        self.stored_bytes += int((offsets[new + 1] - offsets[new]).sum())
        self.met = np.concatenate([self.met, np.ones(len(new), np.int32)])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts)])
        self.pool = np.concatenate([self.pool, ids])
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text (binary, UTF-8, none NULL) has with its end id, and all ids."""
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        starts = (offsets - offsets[0])[:-1]
        runs = self.run_starts(data, starts)
        places = np.append(runs, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(runs), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
        flat, own = self._stored(self._numbers(coded.dictionary)[coded.indices.to_numpy()])
        # The text that a run is of is the last to begin there; the ones before it are empty.
        of = np.searchsorted(starts, runs, side="right") - 1
        counts = np.bincount(of, weights=own, minlength=n).astype(np.int64) + 1
        ends = np.cumsum(counts) - 1
        ids = np.empty(len(flat) + n, np.uint32)
        inside = np.ones(len(ids), bool)
        inside[ends] = False
        ids[inside], ids[ends] = flat, self.end_id
        return counts, ids


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(definition: str, end_id: int) -> Encoder:
    """The encoder of this Python worker, with the runs that earlier tasks have seen."""
    if (definition, end_id) not in _encoders:
        _encoders[definition, end_id] = Encoder(definition, end_id)
    return _encoders[definition, end_id]


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about BATCH_BYTES of text."""
    texts = batch.column(column)
    if not batch.num_rows:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    groups = (offsets[:-1] - offsets[0]) // BATCH_BYTES
    bounds = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
    for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
        yield batch.slice(start, stop - start)


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    fs, root = pa.fs.FileSystem.from_uri(folder)
    return fs, root


def _write(folder: str, definition, end_id: int, file_ids: int, block_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        coder = encoder(definition.value, end_id)
        part, seq = TaskContext.get().partitionId(), 0
        writer, name, done = None, "", []

        def close() -> None:
            done.append((part, seq, name, writer.n_docs, writer.n_ids, writer.close()))

        for batch in batches:
            for piece in _pieces(batch, 1):
                lengths, ids = coder.encode(piece.column(1))
                if writer is not None and (writer.n_ids >= file_ids or writer.n_docs >= FILE_DOCS):
                    close()
                    writer, seq = None, seq + 1
                if writer is None:
                    name = f"{uuid.uuid4().hex}.tids"
                    writer = TokenFileWriter(fs.open_output_stream(f"{root}/{name}", compression=None), coder.bits, block_ids)
                doc_ids = piece.column(0)
                writer.add(doc_ids.fill_null(0).to_numpy(), doc_ids.is_valid().to_numpy(zero_copy_only=False), lengths, ids)
        if writer is not None:
            close()
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*done, strict=True)) or [()] * len(kinds)
        names = [field.split()[0] for field in INDEX.split(", ")]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return write


def write_files(
    docs: DataFrame, folder: str, definition: str, end_id: int, file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Encode all texts and write their ids to files in `folder`, a URI, in order of doc_id; return the index, stored.

    The index has the columns of INDEX and start, the ids of all files before. `docs` has
    doc_id and text; other columns are ignored. `definition` is the JSON text of a byte-level
    tokenizer that adds no prefix space; special strings inside texts are handled as by the
    library's default. A NULL text counts as empty. Rows with a NULL doc_id come first; rows
    of equal doc_id are in order of a hash of their texts, repeated rows one after another. No rows
    give no files.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)  # as large as the vocabulary
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").cast("binary").alias("text"))
    # The last key spreads a row that repeats very often.
    rows = rows.withColumn("by", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())
    keys = [F.asc_nulls_first("doc_id"), F.col("by"), F.col("nth")]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    index, _ = staged(ranged.mapInArrow(_write(folder, shared, end_id, file_ids, block_ids), INDEX), "token-index")
    # One row per file is ordered in one task: 1.5 million rows for 100 TB of files.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    index, _ = staged(index.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-starts")
    return index


def _read(folder: str, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]

        def rows(file: TokenFile, first: int, last: int, start: int, sums: list[int], lists: list | None) -> pa.RecordBatch:
            ends = file.ends[first:last]
            begins = np.concatenate([file.ends[first - 1 : first] if first else [0], ends[:-1]]).astype(np.int64)
            ids = pa.array(lists if lists is not None else [None] * (last - first), pa.list_(pa.int32()))
            return pa.record_batch(
                [
                    pa.array(file.doc_ids[first:last], mask=~file.with_id[first:last]),
                    pa.array(begins + start),
                    pa.array(ends - begins),
                    pa.array(sums, pa.int64()),
                    ids,
                ],
                names,
            )

        for batch in batches:
            for entry in batch.to_pylist():
                with fs.open_input_file(f"{root}/{entry['file']}") as source:
                    file = TokenFile(source)
                    if (file.n_docs, file.n_ids) != (entry["n_docs"], entry["n_ids"]):
                        raise ValueError(f"{entry['file']} is not the file that was written")
                    doc, crc, held = 0, 0, []  # the document being read, and what its earlier stretches gave
                    for at, ids in file.stretches():
                        data = memoryview(ids.astype("<u4").tobytes())
                        last = int(np.searchsorted(file.ends, at + len(ids), side="right"))
                        cuts = (file.ends[doc:last] - at).tolist()
                        begin, sums, lists = 0, [], [] if with_ids else None
                        for cut in cuts:
                            sums.append(zlib.crc32(data[4 * begin : 4 * cut], crc))
                            if with_ids:
                                lists.append(np.concatenate([*held, ids[begin:cut]]).astype(np.int32))
                            begin, crc, held = cut, 0, []
                        crc = zlib.crc32(data[4 * begin :], crc)
                        if with_ids:
                            held.append(ids[begin:])
                        yield rows(file, doc, last, entry["start"], sums, lists)
                        doc = last

    return read


def read_files(index: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files that the index names: DOCUMENTS, `ids` NULL unless wanted.

    start is the number of ids of all documents before it, ids_crc32 the unsigned CRC-32 of
    its ids as little-endian 32-bit integers. A file is read some blocks at a time.
    """
    spark = index.sparkSession
    # An index row stands for a whole file, so the number of rows decides on the tasks.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), index.count() // 4)
    return index.repartition(tasks, F.xxhash64("file")).mapInArrow(_read(folder, with_ids), DOCUMENTS)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for files, as a URI."""
    folder = scratch_dir(spark, purpose)
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def round_trip(docs: DataFrame, definition: str, end_id: int) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from files that are written and read back."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    index = write_files(docs, folder, definition, end_id)
    found, _ = staged(read_files(index, folder, with_ids=False).drop("ids"), "token-rows")
    discard(spark, folder)
    return found
