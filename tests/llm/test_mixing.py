"""Mixing: targets by repeated sharing, and the sample against a plain sort."""

import random

from assayflow.llm import mixing
from assayflow.llm.queries import QUERIES, SQL
from tests.llm.helpers import documents
from tests.oracle import differences

ORDER = lambda s: (s is None, (s or "").encode())


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share by weight, fix what is above its limit, share the excess again, until none is above."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=ORDER))}
    fixed, free = {}, set(sizes)
    while free:
        left = share * sum(sizes.values()) - sum(fixed.values())
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if part[s] > most * sizes[s]}
        if not over:
            return fixed | part
        fixed |= {s: most * sizes[s] for s in over}
        free -= over
    return fixed


def check(result, truth, sources):
    sizes = {}
    for i, n in truth.items():
        sizes[sources[i]] = sizes.get(sources[i], 0) + n
    want, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    for r in result:
        s = sources[r.doc_id]
        assert r.size == truth[r.doc_id] and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken in (0, r.size, 2 * r.size) and r.taken >= int(r.target // max(1, r.source_size)) * r.size
        taken[s] += r.taken
    for s in sizes:
        largest = max(n for i, n in truth.items() if sources[i] == s)
        assert abs(taken[s] - want[s]) <= largest / 2 + 1e-6


def test_query_equals_its_sql_and_the_plain_targets(spark, sf_dir):
    name = "op10_source_mix"
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    check(QUERIES[name](spark, sf_dir).collect(), {d.doc_id: len(d.text.encode().split()) for d in docs}, {d.doc_id: d.source for d in docs})


def test_uneven_sources(spark):
    for seed in range(4):
        rng = random.Random(seed)
        names = [None, "", "é", "z", "a", "B", "empty"]
        rows = []
        for i in range(400):
            source = names[min(6, int(rng.expovariate(0.9)))]
            rows.append((i, "w " * (0 if source == "empty" else rng.choice([1, 3, 10, 200])), source))
        docs = documents(spark, rows)
        result = mixing.mix(docs).collect()
        check(result, {r[0]: len(r[1].split()) for r in rows}, {r[0]: r[2] for r in rows})
        assert sorted(map(tuple, mixing.mix(docs.repartition(3)).collect())) == sorted(map(tuple, result))


def test_better_documents_are_taken_more_often(spark):
    docs = documents(spark, [(i, "a b c d", "s") for i in range(2000)] + [(3000 + i, "x y", "t") for i in range(3000)])
    quality = spark.createDataFrame([(i, 4.0 if i % 2 else 1.0) for i in range(2000)], "doc_id long, quality double")
    sampled = [r.doc_id % 2 for r in mixing.mix(docs, quality, share=1.1).collect() if r.doc_id < 3000 and r.copies > r.target // r.source_size]
    assert 200 < len(sampled) < 1999 and sum(sampled) / len(sampled) > 0.6


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "one two three", None), (3, "one two three", None), (None, "x", "a")]
    result = mixing.mix(documents(spark, rows)).collect()
    assert len(result) == len(rows) and {(r.size, r.source_size) for r in result} == {(0, 1), (0, 6), (3, 6), (1, 1)}
    copies = {r.copies for r in result if r.doc_id == 3}
    assert len(copies) == 1
    assert mixing.mix(documents(spark, [])).collect() == []
    mixed = mixing.mixed_documents(documents(spark, rows))
    assert mixed.columns == documents(spark, []).columns and mixed.where("doc_id = 3").count() == 2 * copies.pop()
