"""WARC archives, index first: records are written with an index of their places, and read by byte ranges.

Each task writes its rows to archives of its own in a folder all executors share, one gzip
member per record, and returns one index row per record. The index, staged as a table, is
what says which archives count: a task that is run again writes new archives, and those
of the lost attempt are in no index row. Reading selects index rows, sorts them by place,
coalesces neighbours into ranges of bounded size, and reads each range once.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.llm.common import discard, staged, whole_text
from assayflow.sources.paths import scratch_dir

ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 4 << 20
#: A task reads about so much.
TASK_BYTES = 256 << 20
GAP_BYTES = 64 << 10
GZIP_LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records have no crawl time of their own; equal input gives equal archives.
DATE = "1970-01-01T00:00:00Z"

INDEX = "archive string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, header_digest string, "
    "payload binary, payload_bytes long, payload_digest string"
)
#: The 32 signs of base 32 as `conv` writes them and as digests do.
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(column: F.Column) -> F.Column:
    """The bare upper-case base-32 SHA-1 of bytes: four times 40 bits, eight digits each."""
    digits = F.sha1(column)
    eights = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*eights), CONV_DIGITS, BASE32_DIGITS)


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Each page with its payload, digest and the page it refers to, NULL for a response.

    `pages` has page_id, url, html; other columns are ignored. A NULL html is the empty
    payload, a NULL url the empty one. Among pages with equal payloads of `min_bytes` or
    more, the largest page_id is the response; repeated rows of that page are responses too.
    A page without id revisits its payload's response, or is one if no page of that payload
    has an id.
    """
    payload = whole_text("html").cast("binary")
    rows = pages.select("page_id", whole_text("url").alias("url"), payload.alias("payload"), base32_sha1(payload).alias("digest"))
    groups = rows.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("digest").alias("of"))
    holders = groups.agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1 and holder is not null")
    # Written out, so that the join is of two plain inputs and a hot payload's rows can be split.
    holders, _ = staged(holders.select("of", "holder"), "warc-holders")
    joined = rows.join(holders, F.col("digest") == F.col("of"), "left")
    revisits = F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisits, F.col("holder")).alias("refers_to"))


def _record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC 1.1 record."""
    kind = "response" if refers_to is None else "revisit"
    name = "" if page_id is None else page_id
    # A header ends with its line, so line breaks and percent signs of a URL are percent-encoded.
    target = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _parse(record: bytes) -> dict:
    """Headers and payload of one record; raises if it is damaged."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    name = lambda value: int(value[len("<urn:page:") : -1]) if value and value != "<urn:page:>" else None
    url = headers["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return {
        "page_id": name(headers["WARC-Record-ID"]),
        "url": url,
        "record_type": headers["WARC-Type"],
        "refers_to": name(headers.get("WARC-Refers-To")),
        "header_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": rest[:length],
    }


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        names = [f.split()[0] for f in INDEX.split(", ")]
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    data = gzip.compress(_record(page_id, url, payload, digest, refers_to), GZIP_LEVEL, mtime=0)
                    out.write(data)
                    kind = "response" if refers_to is None else "revisit"
                    rows.append((name, at, len(data), page_id, url, digest, kind, refers_to))
                    at += len(data)
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        finally:
            if out is not None:
                out.close()

    return write


def write_archives(spark: SparkSession, records: DataFrame, folder: str) -> DataFrame:
    """Write the records of `plan_records` to archives in `folder`, a URI; return their index, staged."""
    rows = records.select("page_id", "url", "payload", "digest", "refers_to")
    index, _ = staged(rows.mapInArrow(_writer(folder), INDEX), "warc-index")
    return index


def plan_ranges(index: DataFrame, range_bytes: int = RANGE_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The byte ranges that cover the selected index rows: archive, first, records.

    A range holds the records that begin in one stretch of `range_bytes` of an archive, in
    order of place; a stretch whose records lie further apart than `gap_bytes` is read in
    several pieces by the reader. A record is never split.
    """
    stretch = F.floor(F.col("offset") / range_bytes)
    return index.groupBy("archive", stretch.alias("first")).agg(
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records")
    ).withColumn("gap", F.lit(gap_bytes))


def _reader(folder: str, with_payload: bool):
    def pieces(places, gap: int):
        """Neighbouring places together: start, end and the places."""
        run, end = [], 0
        for offset, length in places:
            if run and offset - end > gap:
                yield run[0][0], end, run
                run = []
            run.append((offset, length))
            end = max(end, offset + length) if len(run) > 1 else offset + length
        if run:
            yield run[0][0], end, run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fields = [f.split() for f in RECORDS.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        for batch in batches:
            for row in batch.to_pylist():
                places = [(r["offset"], r["length"]) for r in row["records"]]
                rows = []
                with fs.open_input_file(f"{root}/{row['archive']}") as source:
                    for start, end, run in pieces(places, row["gap"]):
                        data = source.read_at(end - start, start)
                        for offset, length in run:
                            member = data[offset - start : offset - start + length]
                            record = _parse(zlib.decompress(member, wbits=31))
                            payload = record["payload"]
                            record["payload_bytes"] = len(payload)
                            record["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if not with_payload:
                                record["payload"] = None
                            rows.append(record)
                yield pa.record_batch([pa.array([r[n] for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])

    return read


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records that the index rows name, read back and parsed: the columns of RECORDS.

    payload_bytes and payload_digest are of the record's own payload, which a revisit has
    not; `header_digest` is the one its header states. Damaged records raise.
    """
    # Rows of ranges are small whatever they stand for, so their number decides on the tasks, not their size.
    spark = index.sparkSession
    wanted = index.agg(F.sum("length")).head()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-wanted // TASK_BYTES))
    # By a hash of the range, as a shuffle by the range itself would be merged with that of the grouping.
    ranges = plan_ranges(index).repartition(tasks, F.xxhash64("archive", "first"))
    return ranges.mapInArrow(_reader(folder, with_payload), RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive all pages and read everything back: one row per page, sizes and digests of the full payloads.

    A revisit's size is that of the response it refers to, whose digest must be the stated one.
    An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc-archives")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    index = write_archives(spark, plan_records(pages, min_bytes), folder)
    records, _ = staged(read_records(index, folder, with_payload=False), "warc-records")
    discard(spark, folder)
    full = records.where("record_type = 'response'").select(
        F.col("page_id").alias("held_by"), F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest")
    )
    wanted = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("held_by")).distinct()
    # Only the responses that something refers to; repeated rows of a page may hold several payloads.
    full, _ = staged(full.join(wanted, "held_by", "left_semi").distinct(), "warc-held")
    same = (F.col("refers_to") == F.col("held_by")) & (F.col("header_digest") == F.col("full_digest"))
    joined = records.join(full, same, "left")
    revisit = F.col("record_type") == "revisit"
    return joined.select(
        "page_id",
        F.when(revisit, F.col("full_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("full_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
