"""Brute force shared by the tests."""

import itertools


def components(nodes, linked):
    """The smallest member reachable from each node, where linked(a, b) says which are linked directly."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


def documents(spark, rows):
    """(doc_id, text[, source]) rows as a documents table, with clashing extra columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 1, "x", 2, 3.0) for r in rows]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, size int, fp string, key int, score double"
    return spark.createDataFrame(full, kinds)
