"""Epsilon grid order join against brute force."""

import math
import random

import numpy as np
import pytest

from assayflow.llm import ego
from assayflow.llm.queries import QUERIES, SQL
from tests.llm.helpers import components
from tests.oracle import differences

SCHEMA = "vec_id long, embedding array<float>, label int, node int, n_links string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def expected(rows, least=0.9):
    usable = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    units = {}
    for at, (i, v) in enumerate(rows):
        if i is not None and usable(v):
            x = np.array(np.array(v, np.float32), np.float64)
            units[at] = x / np.linalg.norm(x)
    linked = lambda a, b: len(units[a]) == len(units[b]) and units[a] @ units[b] >= least
    found = components(list(units), linked)
    smallest = {r: min(rows[m][0] for m in found if found[m] == r) for r in set(found.values())}
    out = []
    for at, (i, _) in enumerate(rows):
        n = sum(linked(at, o) for o in units if o != at) if at in units else 0
        component = smallest[found[at]] if at in units else i
        out.append((i, n, component, i is not None and i == component))
    return sorted(out, key=str)


def test_query_equals_its_sql(spark, sf_dir):
    name = "op1_embedding_near_duplicates"
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []


@pytest.mark.parametrize("block, fan, tile", [(1024, 8, 16), (8, 2, 2), (5, 3, 1)])
def test_clusters_chains_and_copies(spark, monkeypatch, block, fan, tile):
    monkeypatch.setattr(ego, "BLOCK", block)
    monkeypatch.setattr(ego, "FAN", fan)
    monkeypatch.setattr(ego, "TILE", tile)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 12))
    rows = [[int(i), (centres[i % 6] * (1 + i % 3) + rng.normal(size=12) * 0.4).tolist()] for i in range(90)]
    rows += [[100 + i, [math.cos(i * 0.4), math.sin(i * 0.4), *[0.0] * 10]] for i in range(12)]  # a chain, each link 0.92
    rows += [[200 + i, [1.0, -1.0] * 6] for i in range(25)]
    rows += [[300 + i, (rng.normal(size=12)).tolist()] for i in range(60)]
    random.Random(1).shuffle(rows)
    result = sorted((tuple(r) for r in ego.near_duplicates(table(spark, rows)).collect()), key=str)
    assert result == expected([tuple(r) for r in rows])


def test_far_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(ego, "BLOCK", 16)
    rng = np.random.default_rng(8)
    centres = np.eye(8)
    rows = [(int(i), (centres[i // 40] + rng.normal(size=8) * 0.02).tolist()) for i in range(320)]
    vectors = ego.unit_vectors(table(spark, rows)).cache()
    full = ego.blocks(ego.grid_order(vectors, ego.principal_axes(vectors), math.sqrt(0.2)))
    pairs, levels = ego.near_blocks(full.select("block", "lows", "highs"), math.sqrt(0.2))
    assert levels == 3 and pairs.count() < 20 * 21 / 2 / 2


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e-30, 1e-30]), (11, [3e38, 3e38])]
    result = sorted((tuple(r) for r in ego.near_duplicates(table(spark, rows)).collect()), key=str)
    assert result == expected(rows)
    assert ego.near_duplicates(table(spark, [])).collect() == []
    assert len(ego.near_duplicates(table(spark, [(1, None)])).collect()) == 1


def test_tiny_and_huge_doubles_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ego, "BLOCK", 8)
    monkeypatch.setattr(ego, "FAN", 2)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(5, 6))
    units = [(centres[i % 5] + rng.normal(size=6) * 0.1).tolist() for i in range(60)]
    rows = [(i, [x * (1e-170, 1.0, 1e170)[i % 3] for x in v]) for i, v in enumerate(units)]
    result = ego.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((tuple(r) for r in result), key=str) == expected(list(enumerate(units)))
