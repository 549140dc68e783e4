"""The stages of the corpus pipeline, each against brute force over its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from assayflow.llm import pii, simhash, toxicity
from assayflow.llm.common import staged, table
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output rows of each stage, and the input frames."""
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result, _ = staged(stage(spark, docs, sf_dir), f"test-{name}")
        out.append((name, docs, docs.collect(), result.collect(), result.columns))
        docs = result
    return {x[0]: x[1:] for x in out}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "personal_data", "source_mix", "sentencepiece"]
    for name in list(stages)[:-1]:
        assert stages[name][3] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxicity_keeps_what_scores_low(stages, spark, sf_dir):
    docs, before, after, _ = stages["toxicity"]
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    assert Counter(after) == Counter(r for r in before if model.score([r.text])[0] < 0.3)


def test_near_duplicates_leave_one_of_each_group(stages):
    _, before, after, _ = stages["simhash_near_dedup"]
    shingles = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})(t.lower().split())
    kept = {r.doc_id for r in after}
    sets = {r.doc_id: shingles(r.text) for r in before}
    likeness = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    for gone in sets.keys() - kept:
        assert max(likeness(gone, other) for other in sets if other != gone) >= 0.8
    pairs = [(a, b) for a in kept for b in kept if a < b and likeness(a, b) >= 0.8]
    assert pairs == []
    assert set(after) <= set(before)


def test_personal_data_is_masked(stages):
    docs, before, after, _ = stages["personal_data"]
    field = pii.fit(docs)
    want = Counter((r.doc_id, t := pii.masked(r.text, field.spans(r.text)), r.lang, r.source, len(t)) for r in before)
    assert Counter(map(tuple, after)) == want
    assert not any(pii.base_spans(r.text) for r in after)


def test_mix_takes_words_near_the_targets(stages, spark):
    docs, before, after, _ = stages["source_mix"]
    n = lambda r: len(r.text.encode().split())
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += n(r)
    for r in after:
        taken[r.source] += n(r)
    order, weights = sorted(sizes, key=lambda s: s.encode()), {}
    for i, s in enumerate(order):
        weights[s] = (3, 1, 2)[i % 3]
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over
    largest = {s: max(n(r) for r in before if r.source == s) for s in order}
    off = {s: (taken[s], target[s], largest[s], sizes[s]) for s in order if abs(taken[s] - target[s]) > largest[s] / 2 + 1}
    assert off == {}
    times = Counter(r.doc_id for r in after)
    assert max(times.values()) <= 2 and set(after) <= set(before)


def test_last_stage_encodes_every_row(stages):
    _, before, after, columns = stages["sentencepiece"]
    assert columns == ["doc_id", "n_tokens", "ids", "lossless"]
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    assert all(r.lossless and r.n_tokens > 0 for r in after)


def test_odd_rows_pass_every_stage(spark, sf_dir):
    rows = [(1, None, "a"), (2, "", None), (3, "one two three", None), (3, "one two three", None), (None, "x@y.zz", "a"), (5, "word " * 50_000, "b")]
    for docs in (documents(spark, rows), documents(spark, [])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs, _ = staged(stage(spark, docs, sf_dir), "test-odd")
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()


def test_no_text_is_lost_among_rows_of_one_id(spark):
    """Clashing column names; one id with quite different texts, with a similar text and with repeated rows."""
    text = lambda word, n=30: " ".join(f"{word}{i}" for i in range(n))
    near = text("a") + " more"
    rows = [(1, text("a"), 1), (1, text("b"), 2), (1, text("a"), 3), (2, near, 4), (2, text("c"), 5), (None, text("a"), 6), (None, text("a"), 7)]
    full = [(*r, 1, 2, "x", 9, "w") for r in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, n int, kept_id int, kept_text int, text_hash string, node int, whole string")
    runs = [sorted(map(str, simhash.keep_first(docs.repartition(k)).collect())) for k in (1, 5)]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and runs[0] == runs[1]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        [(1, text("a")), (1, text("b")), (2, text("c")), (0, text("a")), (0, text("a"))]
    )
