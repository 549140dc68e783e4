"""Personal data: certain spans against plain patterns, dynamic programming against enumeration."""

import hashlib
import math
import random
import re

import pytest

from assayflow.llm import pii
from assayflow.llm.queries import QUERIES
from tests.llm.helpers import documents


def plain(text):
    """The certain spans, with the patterns as they are stated."""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        odd, even = digits[-1::-2], digits[-2::-2]
        if 16 <= len(digits) <= 19 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def field():
    return pii.Field.fit(["The and of words in plain sentences for all"] * 40)


def test_certain_spans_equal_the_stated_patterns():
    rng = random.Random(1)
    parts = ["a.b", "@", "x-1.org", ".", "..", "12", "255", "256", "007", "1.2.3.4", "+", "+49", "(30)", " ", "-", "4111111111111111", "é", "\n", "@@", "%", "5500 0000 0000 0004", "+1 (269) 555-3296"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 12)))
        assert pii.base_spans(text) == plain(text), text


def test_best_and_gradient_equal_enumeration(field):
    def segmentations(ending, j):
        if j == 0:
            yield []
            return
        for rest in segmentations(ending, j - 1):
            yield rest
        for i, kind, found in ending.get(j, ()):
            for rest in segmentations(ending, i):
                yield rest + [(kind, i, j, found)]

    for text in ("call 555-123-4567", "a [at] b.com 1.2", "4111-1111 2222"):
        edges, ending = field.segments(text, 0, len(text))
        every = list(segmentations(ending, len(edges) - 1))
        score = lambda s: sum(field.score(kind, found) for kind, _, _, found in s)
        best = max(every, key=score)
        assert field.best(text, 0, len(text)) == [(k, edges[i], edges[j]) for k, i, j, _ in best]
        total = sum(math.exp(score(s)) for s in every)
        truth = {(k, edges[i], edges[j]) for k, i, j, _ in best}
        change = field.gradient(text, 0, len(text), truth)
        for key in list(change)[:20]:
            expected = sum(math.exp(score(s)) / total * sum(k == key[0] and f == key[1] for k, _, _, fs in s for f in fs) for s in every)
            seen = sum(k == key[0] and f == key[1] for k, _, _, fs in best for f in fs)
            assert change[key] == pytest.approx(seen - expected, abs=1e-4)


def test_field_adds_other_spellings_and_leaves_clean_text(field):
    find = lambda text: [(k, text[s:e]) for k, s, e in field.spans(text)]
    assert find("ring (555) 123-4567 today") == [("phone", "(555) 123-4567")]
    assert find("mail bob.smith [at] example.com ok") == [("email", "bob.smith [at] example.com")]
    assert find("to +1 (269) 555-3296 4524132264652876 and") == [("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]
    for clean in ("on 2024-01-31 at 12:30:00 we met", "order 123456789012 of 5", "pages 12-14, 3. and 4.", "at [12] and (3)", "x" * 5000 + "1" * 5000):
        assert find(clean) == [], clean


def test_query_keeps_every_certain_span(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op9_personal_data"](spark, sf_dir).collect()}
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        base, row = plain(doc.text), rows[doc.doc_id]
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(b[0] == kind for b in base) for kind in pii.KINDS]
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(row.spans.split(",") if row.spans else [])


def test_masking_and_edge_rows(spark, field):
    rows = [(1, None), (2, ""), (2, ""), (None, "a@b.co"), (3, "é a@b.co, 10.0.0.1 x"), (4, "1" * 200_000), (5, "clean")]
    found = pii.find(documents(spark, rows), field).collect()
    assert len(found) == len(rows) and {r.spans for r in found if r.doc_id == 3} == {"email:2:8,ip:10:18"}
    kept = pii.mask(documents(spark, rows), field)
    assert kept.columns == documents(spark, []).columns
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect() if r.doc_id != 4} == {
        1: (None, None), 2: ("", 0), None: ("[EMAIL]", 7), 3: ("é [EMAIL], [IP] x", 17), 5: ("clean", 5)
    }
    assert pii.masked("0123456789", [("ip", 1, 4), ("card", 3, 6)]) == "0[IP]6789"
    assert pii.find(documents(spark, []), field).collect() == [] == pii.mask(documents(spark, []), field).collect()
