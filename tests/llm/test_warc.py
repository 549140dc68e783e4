"""WARC archives: round trips, places, and what ranges read."""

import base64
import gzip
import hashlib
import random

import pytest

from assayflow.llm import warc
from assayflow.llm.queries import QUERIES, SQL
from tests.oracle import differences

SCHEMA = "page_id long, url string, html string, digest string, offset long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def expected(rows):
    holder = {}
    for i, _, html in rows:
        if i is not None:
            holder[html or ""] = max(i, holder.get(html or "", i))
    out = []
    for i, _, html in rows:
        body, held = (html or "").encode(), holder.get(html or "")
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        revisit = held is not None and held != i
        out.append((i, len(body), digest, "revisit" if revisit else "response", held if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/%\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "\r\n\r\nWARC/1.1\r\n"), (5, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>é</p>"), (None, "n", "own"), (None, "n", "own"), (7, "u", "x" * 300_000)]


def test_query_equals_its_sql(spark, sf_dir):
    name = "op5_warc_round_trip"
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []


@pytest.mark.parametrize("archive", [256 << 20, 500])
def test_round_trip(spark, monkeypatch, archive):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive)
    rng = random.Random(1)
    rows = ROWS + [(10 + i, f"http://h/{i}", rng.choice(["same", f"page {i}", "ü" * (i % 9)])) for i in range(200)]
    result = sorted((tuple(r) for r in warc.round_trip(table(spark, rows)).collect()), key=str)
    assert result == expected(rows)
    assert warc.round_trip(table(spark, [])).collect() == []


def test_index_names_members_and_selected_records_are_read(spark, tmp_path):
    folder = f"file://{tmp_path}/archives"
    rows = [(i, f"http://h/{i}", f"body {i} " * (1 + i % 50)) for i in range(300)] + [(1002, *ROWS[0][1:])]
    index = warc.write_archives(spark, warc.plan_records(table(spark, rows).coalesce(2)), folder)
    for r in index.collect():
        data = (tmp_path / "archives" / r.archive).read_bytes()[r.offset : r.offset + r.length]
        record = gzip.decompress(data)
        assert record.startswith(b"WARC/1.1\r\n") and f"<urn:page:{r.page_id}>".encode() in record and r.digest.encode() in record
    wanted = index.filter("page_id % 7 = 1")
    found = {r.page_id: (r.url, r.payload.decode()) for r in warc.read_records(wanted, folder).collect()}
    assert {i for i in found} == {r[0] for r in rows if r[0] % 7 == 1}
    assert all(found[i] == (u, h) for i, u, h in rows if i in found)
    assert warc.plan_ranges(wanted).count() <= 4
    whole = (tmp_path / "archives" / index.head().archive).read_bytes()
    assert gzip.decompress(whole).count(b"WARC-Type") == index.filter(index.archive == index.head().archive).count()


def test_small_payloads_can_be_left_as_responses(spark):
    rows = [(1, "u", "tiny"), (2, "u", "tiny"), (3, "u", "large" * 10), (4, "u", "large" * 10)]
    kinds = {r.page_id: r.refers_to for r in warc.plan_records(table(spark, rows), min_bytes=20).collect()}
    assert kinds == {1: None, 2: None, 3: 4, 4: None}


def test_damage_is_noticed():
    record = warc._record(1, "u", b"body", "D", None)
    with pytest.raises(ValueError):
        warc._parse(record[:-6] + b"x\r\n\r\n")
