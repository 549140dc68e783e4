"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from assayflow.llm import similar_sets, simhash
from assayflow.llm.components import connected_components
from assayflow.llm.queries import QUERIES
from tests.llm.helpers import components, documents


def plain_fingerprint(text):
    words = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text).translate(
        str.maketrans("\t\n\x0b\x0c\r", "     ")
    ).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    prints = {i: plain_fingerprint(t or "") for i, t in rows}
    found = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    return {i: (f"{prints[i]:016x}", found[i]) for i in prints}


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    result = QUERIES["op4_simhash_near_duplicates"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in result} == expected(rows)
    assert len(result) == len(rows)


def test_chains_hot_copies_and_near_copies(spark):
    rng = random.Random(1)
    base = [rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(900)]
    rows = [(i, " ".join(base)) for i in range(40)]
    for i in range(40, 120):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(900)] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(i, f"some {i} text {i} of its own {i * 7}") for i in range(120, 200)]
    rng.shuffle(rows)
    result = simhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: (r.fp.hex(), r.component_id) for r in result} == expected(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d"), (7, "A B\tC D"), (7, "a b c d"), (8, "x\x1cy"), (9, "é É"), (None, "lone row without id")]
    result = simhash.near_duplicates(documents(spark, rows)).collect()
    assert len(result) == len(rows)
    assert {(r.doc_id, r.component_id) for r in result} == {(1, 1), (2, 1), (3, 1), (None, 7), (7, 7), (8, 8), (9, 9), (None, None)}
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_hot_keys_are_dealt_without_losing_links(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    prints = {centre}
    while len(prints) < 300:
        bits = rng.choice(64, 3, replace=False)
        prints.add(int(np.int64(rng.choice(list(prints)[:40])) ^ sum(np.int64(1) << np.int64(b) for b in bits if b < 63)))
    rows = list(enumerate(sorted(prints)))
    reps = spark.createDataFrame([(i, bytearray(v.to_bytes(8, "big", signed=True))) for i, v in rows], "rep long, fp binary")
    value = dict(rows)
    want = components([i for i, _ in rows], lambda a, b: bin((value[a] ^ value[b]) & (2**64 - 1)).count("1") <= 4)
    for piece in (20, 1000):
        found = connected_components(simhash.links(reps, 64, 6, 2, 4, piece=piece)).collect()
        got = {i: i for i in value} | {r.node: r.root for r in found}
        assert got == want


def test_similar_texts_are_dropped_and_clean_ones_stay(spark):
    rng = random.Random(2)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    base = fresh(400)
    near = [base[:i] + fresh(2) + base[i + 2 :] for i in (50, 150, 250)]  # similarity about 0.97
    rows = [(i, " ".join(w)) for i, w in enumerate([base, *near, base])] + [(10 + i, " ".join(fresh(100))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "kept")]
    kept = simhash.keep_first(documents(spark, rows))
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 0, *range(10, 70), 100]
    assert kept.columns == documents(spark, []).columns


@pytest.mark.parametrize("links, want", [([], {}), ([(1, 1), (None, 2)], {}), ([(i, i + 1) for i in range(50)] + [(90, 80)] * 3, {**dict.fromkeys(range(51), 0), 90: 80, 80: 80})])
def test_components(spark, links, want):
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == want


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(rng, size, common):
    """Two texts of `size` shingles each, of which they share `common`."""
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    shared = fresh(common + 4)
    return " ".join(shared + fresh(size - common)), " ".join(shared + fresh(size - common))


def test_pairs_at_the_similarity_are_found_and_others_stay(spark):
    """A bound on fingerprints alone refuses half of the first pairs and lets many of the others pass."""
    rng = random.Random(11)
    cases = [(180, 160), (9, 8), (45, 40), (450, 400), (180, 158), (9, 7), (450, 399), (450, 390)]
    rows, alike = [], []
    for case in cases:
        for _ in range(60):
            pair = similar(rng, *case)
            a, b = map(shingles, pair)
            alike.append(len(a & b) / len(a | b) >= 0.8)
            rows += [(len(rows), pair[0]), (len(rows) + 1, pair[1])]
    kept = {r.doc_id for r in simhash.keep_first(documents(spark, rows)).collect()}
    assert kept >= set(range(0, len(rows), 2))
    gone = [2 * i + 1 not in kept for i in range(len(alike))]
    assert not any(g and not a for g, a in zip(gone, alike))
    assert sum(alike) == 240 and sum(g for g, a in zip(gone, alike) if a) >= 234
    assert all(g for g, a, (one, _) in zip(gone, alike, [c for c in cases for _ in range(60)]) if a and one < 64)


@pytest.mark.parametrize("shingles_held, most", [(1 << 20, 1 << 12), (2000, 1 << 12), (1 << 20, 4), (500, 5)])
def test_large_groups_of_candidates_lose_no_links(spark, shingles_held, most):
    """Chains, two dense groups and sets of their own in one component, and one more."""
    rng = np.random.default_rng(4)
    base = rng.integers(1 << 62, size=200)
    other = np.r_[base[:150], rng.integers(1 << 62, size=50)]
    sets = [np.r_[np.roll(base, -9 * i)[:170], rng.integers(1 << 62, size=8)] for i in range(14)]
    sets += [np.r_[np.delete(other, rng.integers(200, size=6)), rng.integers(1 << 62, size=4)] for _ in range(25)] + [other[:140], base[:60], base[:0]]
    sets = {i: set(map(int, s)) for i, s in enumerate(sets)}
    root = {i: 0 if i < 39 or i > 40 else 39 for i in sets}
    rows = [(root[i], i, len(s), bytearray(np.sort(np.array(list(s), np.uint64)).tobytes())) for i, s in sets.items()]
    members = spark.createDataFrame(rows, "root long, node long, n long, data binary")
    found = connected_components(similar_sets.links(members, lambda m: m, 0.8, shingles_held, most)).collect()
    likeness = lambda a, b: root[a] == root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = components(list(sets), likeness)
    assert 3 < len(set(want.values())) < 20
    assert {i: i for i in sets} | {r.node: r.root for r in found} == want
