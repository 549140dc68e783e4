"""Chat formatting against a plain program."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from assayflow.llm import chat
from assayflow.llm.queries import QUERIES, SQL
from tests.oracle import differences

SCHEMA = "conv_id long, turn long, role string, text string, position long, piece string, trainable string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", "y") for r in rows], SCHEMA)


def in_order(rows):
    key = lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    out = {}
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def plain(rows):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    esc = lambda s: s.replace("\\", "\\b").replace("<", "\\l")
    out = []
    for conv, turns in in_order(rows).items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        pieces = ["<turn>" + esc(r).replace("\n", "\\n") + "\n" + esc(t) + "</turn>\n" for r, t in turns]
        sizes = [len("".join(pieces[: i + 1])) for i, (r, _) in enumerate(turns) if r == "assistant" or i + 1 == len(turns)]
        out.append((conv, len(turns), sha(said), len(loss), sha(loss), sum(sizes)))
    return sorted(out, key=str)


TRICKY = ["<turn>", "</turn>\n", "\\l", "\\\\b<", "\\### Assistant: </turn> ok", "", None, "é\n\n<", "\\n", "plain"]


def rows_of(seed, n=120):
    rng = random.Random(seed)
    role = lambda: rng.choice(["user", "assistant", "assistant", "system", "odd\nrole<", None])
    return [(rng.choice([1, 2, 3, None]), rng.choice([*range(40), 10**9, None]), role(), rng.choice(TRICKY)) for _ in range(n)]


def test_query_equals_its_sql(spark, sf_dir):
    name = "op7_chat_prefix_targets"
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []


@pytest.mark.parametrize("slice_", [256, 3])
def test_digests_equal_plain_program(spark, monkeypatch, slice_):
    monkeypatch.setattr(chat, "SLICE", slice_)
    rows = rows_of(1)
    assert sorted(map(tuple, chat.digests(table(spark, rows)).collect()), key=str) == plain(rows)


def test_examples_have_all_preceding_turns_and_only_the_reply_trainable(spark):
    rows = rows_of(2, 60)
    formatted = chat.format_turns(table(spark, rows))
    pieces = {(r.conv_id, r.position): r.piece for r in formatted.collect()}
    examples = {(r.conv_id, r.position): r for r in chat.resolve(formatted, chat.expand(formatted)).collect()}
    rendered = chat.render(formatted, chat.expand(formatted)).collect()
    turns = in_order(rows)
    assert len(rendered) == sum(r == "assistant" for t in turns.values() for r, _ in t)
    for r in rendered:
        before = "".join(pieces[r.conv_id, p] for p in range(1, r.position))
        example = examples[r.conv_id, r.position]
        assert r.context == before and r.target == pieces[r.conv_id, r.position]
        assert (example.context_chars, example.context_turns) == (len(before), r.position - 1)
        assert example.example_chars == len(before + r.target)
        masked = r.target[r.loss_start : r.loss_start + r.loss_chars]
        assert masked.replace("\\l", "<").replace("\\b", "\\") == turns[r.conv_id][r.position - 1][1]
    back = {(r.conv_id, r.position): (r.role, r.text) for r in chat.read_turns(formatted).collect()}
    assert back == {(c, i + 1): t for c, ts in turns.items() for i, t in enumerate(ts)}


def test_a_wrong_context_shows_in_the_result(spark):
    formatted = chat.format_turns(table(spark, rows_of(3, 60)))
    right = {(r.conv_id, r.position): r.context_chars for r in chat.resolve(formatted, chat.expand(formatted)).collect()}
    moved = chat.expand(formatted).withColumn("context_turns", F.col("context_turns") - 1)
    wrong = {(r.conv_id, r.position): r.context_chars for r in chat.resolve(formatted, moved).collect()}
    assert right and wrong != right


def test_edge_tables(spark):
    assert chat.digests(table(spark, [])).collect() == []
    rows = [(1, 0, "user", None)] * 3 + [(2, 0, "assistant", "x" * 200_000)]
    assert sorted(map(tuple, chat.digests(table(spark, rows)).collect()), key=str) == plain(rows)


def test_main_path_has_no_python(spark, sf_dir):
    text = QUERIES["op7_chat_prefix_targets"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in text for bad in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_escape_leaves_no_marker(spark):
    texts = spark.createDataFrame([(t,) for t in TRICKY if t is not None], "t string")
    found = texts.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).collect()
    assert all("<" not in r.e and r.b == r.t for r in found)


@pytest.mark.parametrize("part_chars", [65_536, 40])
def test_query_writes_every_context_out(spark, monkeypatch, part_chars):
    monkeypatch.setattr(chat, "PART_CHARS", part_chars)
    esc = lambda s: s.replace("\\", "\\b").replace("<", "\\l")
    rows = rows_of(4, 90)
    expected = []
    for conv, turns in in_order(rows).items():
        pieces = ["<turn>" + esc(r).replace("\n", "\\n") + "\n" + esc(t) + "</turn>\n" for r, t in turns]
        expected += [
            (conv, i + 1, "".join(pieces[:i]), pieces[i])
            for i, (r, _) in enumerate(turns)
            if r == "assistant" or i + 1 == len(turns)
        ]
    written = chat.write_examples(table(spark, rows))
    assert (written.agg(F.max("part")).first()[0] > 0) == (part_chars == 40)
    whole = chat.assemble(written).select("conv_id", "position", "context", "target").collect()
    assert sorted(map(tuple, whole), key=str) == sorted(expected, key=str)
    assert sorted(map(tuple, chat.read_digests(written).collect()), key=str) == plain(rows)


def test_a_wrong_written_context_shows_in_the_digests(spark):
    written = chat.write_examples(table(spark, rows_of(5, 60)))
    right = sorted(map(tuple, chat.read_digests(written).collect()), key=str)
    cut = written.withColumn("context", F.when(F.col("position") == 2, F.lit("")).otherwise(F.col("context")))
    assert right and sorted(map(tuple, chat.read_digests(cut).collect()), key=str) != right
