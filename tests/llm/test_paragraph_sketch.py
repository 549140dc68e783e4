"""Paragraph sketches: recovered differences against plain sets, and the order of documents."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from assayflow.llm import paragraph_sketch as ps
from assayflow.llm.queries import QUERIES
from tests.llm.helpers import documents

PIECE = re.compile(r"[^ \t\n\x0b\f\r]{1,64}(?:[ \t]+[^ \t\n\x0b\f\r]{1,64}){0,15}")


def alike(a, b):
    x, y = set(PIECE.findall(a)), set(PIECE.findall(b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), pytest.approx(alike(text, edited)), pytest.approx(alike(text, following))))
    return out


def compare(result, rows):
    got = sorted(result, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want = sorted(expected(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got] == want


def test_query_equals_plain_sets(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    result = QUERIES["op6_paragraph_sketches"](spark, sf_dir).collect()
    compare(result, rows)
    texts = dict(rows)
    prints = {}
    for r in result:
        prints.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_large_differences_are_retried(spark):
    rng = random.Random(3)
    line = lambda: f"line {rng.randrange(10**9)} of text"
    shared = [line() for _ in range(700)]
    rows = []
    for i, own in enumerate((0, 1, 10, 60, 900, 3)):
        lines = shared + [line() for _ in range(own)]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    compare(ps.compare_versions(documents(spark, rows)).collect(), rows)


def test_without_larger_sketches_digests_are_compared(spark, monkeypatch):
    monkeypatch.setattr(ps, "DEPTH", 1)
    rows = [(i, "\n".join(f"{i} {k}" for k in range(900))) for i in range(2)]
    compare(ps.compare_versions(documents(spark, rows)).collect(), rows)


def test_next_document_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(ps, "STRETCH", 3)
    rng = random.Random(4)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(20)] + list(range(15)) + [7, 7, None, None]
    rows = [(i, f"text {n}") for n, i in enumerate(ids)]
    compare(ps.compare_versions(documents(spark, rows)).collect(), rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (3, " \n\t"), (None, "é🙂 日本 words"), (5, "x" * 1000), (6, "a\n" * 50)]
    compare(ps.compare_versions(documents(spark, rows)).collect(), rows)
    assert ps.compare_versions(documents(spark, [])).collect() == []
    compare(ps.compare_versions(documents(spark, [(4, "alone here")])).collect(), [(4, "alone here")])


def test_main_path_has_no_python(spark, sf_dir):
    text = QUERIES["op6_paragraph_sketches"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in text for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_sketches_subtract_to_what_differs(spark):
    a, b = [f"a{i}" for i in range(5)], [f"b{i}" for i in range(8)]
    both = [f"c{i}" for i in range(200)]
    hashes = lambda xs: F.array(*[F.xxhash64(F.lit(x)) for x in xs])
    sides = spark.range(1).select(hashes(a + both).alias("x"), hashes(both + b).alias("y"))
    sketched = sides.select(ps.sketch(F.col("x"), F.lit(0)).alias("x"), ps.sketch(F.col("y"), F.lit(0)).alias("y"))
    found = sketched.select(ps.peel(ps.subtract(F.col("x"), F.col("y")), F.lit(0)).alias("p")).head().p
    assert (found.first, found.second, found.whole) == (5, 8, True)
