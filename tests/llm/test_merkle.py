"""Merkle manifests and multiproofs against plain trees."""

import hashlib
import zlib

import numpy as np
import pytest

from assayflow.llm import merkle
from assayflow.llm.queries import QUERIES, SQL
from tests.oracle import differences

KINDS = "doc_id long, text string, lang string, source string, n_chars long, place int, n int, tree long, leaf string, part int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    fields = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return h(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(hashes):
    """All levels of a tree."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, place):
    out = []
    for nodes in levels[:-1]:
        sibling = place ^ 1
        out.append((place & 1, nodes[sibling] if sibling < len(nodes) else None))
        place >>= 1
    return out


def plain(rows):
    """The result's rows for (doc_id, text, lang, source, n_chars) rows."""
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    langs = sorted({r[2] for r in rows}, key=lambda k: (k is not None, (k or "").encode()))
    members = {k: sorted((r for r in rows if r[2] == k), key=order) for k in langs}
    trees = {k: climb([leaf(r) for r in members[k]]) for k in langs}
    top = climb([trees[k][-1][0] for k in langs])
    out = []
    for number, k in enumerate(langs):
        for place, row in enumerate(members[k]):
            proof = path(trees[k], place) + path(top, number)
            touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, 1 if touched else 0)
            for right, sibling in proof:
                node = h(node) if sibling is None else h(sibling, node) if right else h(node, sibling)
            root = top[-1][0]
            digest = h(*(s for _, s in proof if s is not None))
            out.append((row[0], leaf(row), trees[k][-1][0], root, digest, node, node == root))
    return out


def result(frame):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4) for r in rows], KINDS)


ROWS = [
    *[(i, f"text {i}", ("en", "de", "fr")[i % 3 if i > 20 else 0], "web", i) for i in range(61)],
    (70, "alone", "zz", None, 5),
    (71, None, None, None, None),
    (72, "", None, "", 0),
    (None, "no id", "en", "web", 3),
    (5, "text 5", "en", "web", 5),
    (5, "another text", "en", "web", 5),
    (80, "é" * 40_000, "ÿ", "sourcé:1", 9),
    (81, "tab\tand\nline", "Z", "web", -3),
]


@pytest.mark.parametrize("levels, part", [(12, 8192), (2, 5)])
def test_every_leaf_against_plain_trees(spark, monkeypatch, levels, part):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "PART_LEAVES", part)
    found = result(merkle.verify(documents(spark, ROWS).repartition(3)))
    assert found == sorted(plain(ROWS), key=str)
    verdicts = {r[0]: r[-1] for r in found}
    assert not all(verdicts.values()) and verdicts[71] is True


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 8, 9, 17])
def test_trees_of_every_shape(spark, monkeypatch, count):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    rows = [(i, str(i), "en", "s", i) for i in range(count)]
    assert result(merkle.verify(documents(spark, rows))) == sorted(plain(rows), key=str)


def test_no_rows(spark):
    assert merkle.verify(documents(spark, ROWS).where("false")).count() == 0


def test_proofs_of_some_leaves(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PART_LEAVES", 16)
    manifest = merkle.make_manifest(documents(spark, ROWS))
    wanted = manifest.leaves.where("doc_id in (3, 4, 21, 70)")
    found = {r.doc_id: r for r in merkle.prove(manifest, wanted, with_proofs=True).collect()}
    want = {r[0]: r for r in plain(ROWS) if r[0] in (3, 4, 21, 70)}
    assert {i: (r.leaf, r.subroot, r.root, r.proof_sha256) for i, r in found.items()} == {i: r[1:5] for i, r in want.items()}
    assert all(h(*r.proof) == r.proof_sha256 for r in found.values())


@pytest.mark.parametrize("n", [1, 2, 7, 64, 100])
def test_missing_nodes_are_the_least_that_derive_the_root(n):
    rng = np.random.default_rng(n)
    levels = climb([h(str(i)) for i in range(n)])
    for size in {1, n // 2, n} - {0}:
        places = np.sort(rng.choice(n, size, replace=False))
        fetched = {(level, int(p)): levels[level][p] for level, found in merkle.missing_nodes(places, n) for p in found}
        derived = merkle.derive({int(p): levels[0][p] for p in places}, fetched, n)
        assert derived[-1] == {0: levels[-1][0]}
        # Nothing fetched could have been derived from the leaves that are given.
        for level, place in fetched:
            below = range(place << level, min((place + 1) << level, n))
            assert not set(below) & set(places.tolist())
    assert not merkle.missing_nodes(np.arange(n), n)


def test_whole_table_against_sql(spark, sf_dir):
    name = "op11_merkle_manifest"
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []
