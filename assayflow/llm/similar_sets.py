"""Links between sets of shingles by their exact similarity, within groups of candidates.

Candidates come as connected components. A component of bounded size is one task's: a set is compared
with all that are not reached yet, so a dense group costs little more than one pass. The sets of a
larger component are first compared with that of its root; those not similar to it meet all
others in pieces, each two of which are searched together. Links leave a task as about one per set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import staged

#: A component of more shingles or sets is dealt into pieces of half as many, each two of which are searched together.
SHINGLES, SETS = 1 << 20, 1 << 12


def similarity(common, one, other):
    """Intersection by union, 1 for two empty sets."""
    union = one + other - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


def unite(sets: list[np.ndarray], reached: int, least: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Positions and the position each was reached from, connecting all that similarities of `least` or more connect.

    The first `reached` sets are connected already.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.r_[0, np.cumsum(sizes)]
    mark = np.zeros(len(ids) + 1, bool)
    ends, roots = [], []
    unreached, flat = np.arange(reached, len(sets)), ids[bounds[reached] :]
    queue = list(range(reached))
    while len(unreached):
        if not queue:
            queue = [int(unreached[0])]
            flat, unreached = flat[sizes[unreached[0]] :], unreached[1:]
        root = queue[0]
        while queue and len(unreached):
            one = queue.pop()
            mark[ids[bounds[one] : bounds[one + 1]]] = True
            upto = np.r_[0, np.cumsum(mark[flat])][np.r_[0, np.cumsum(sizes[unreached])]]
            mark[ids[bounds[one] : bounds[one + 1]]] = False
            near = similarity(np.diff(upto), sizes[one], sizes[unreached]) >= least
            if near.any():
                found = unreached[near]
                queue.extend(found.tolist())
                ends.append(found)
                roots.append(np.full(len(found), root))
                flat, unreached = flat[np.repeat(~near, sizes[unreached])], unreached[~near]
        queue = []
    return ends, roots


def _search(least: float):
    """a, b from rows of root, sub, reached, node, data that come sorted, reached ones first."""

    def links(nodes, sets, reached):
        nodes = np.array(nodes, np.int64)
        ends, roots = unite([np.frombuffer(s, np.uint64) for s in sets], reached, least)
        a, b = (nodes[np.concatenate(x)] if x else nodes[:0] for x in (ends, roots))
        return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets, reached = None, [], [], 0
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for row, (root, sub, known, node) in enumerate(keys):
                if (root, sub) != now:
                    if len(nodes) > 1:
                        yield links(nodes, sets, reached)
                    now, nodes, sets, reached = (root, sub), [], [], 0
                nodes.append(node)
                sets.append(batch.column(4)[row].as_py())
                reached += known
        if len(nodes) > 1:
            yield links(nodes, sets, reached)

    return run


def _searched(rows: DataFrame, least: float) -> DataFrame:
    dealt = rows.select("root", "sub", "known", "node", "data").repartition("root", "sub")
    return dealt.sortWithinPartitions("root", "sub", F.desc("known")).mapInArrow(_search(least), "a long, b long")


def _beside_root(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = []
            for row in range(batch.num_rows):
                one, other = (np.frombuffer(batch.column(i)[row].as_py(), np.uint64) for i in (2, 3))
                common = len(np.intersect1d(one, other, assume_unique=True))
                known.append(bool(similarity(common, len(one), len(other)) >= least))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(known, pa.bool_())], ["root", "node", "known"])

    return run


def links(members: DataFrame, sets, least: float, shingles: int = SHINGLES, most: int = SETS) -> DataFrame:
    """a, b: links between nodes that connect all whose sets have a similarity of at least `least` and that share a root.

    `members` has root, node, the number n of the node's shingles, and what `sets` needs to make root,
    node, n, data of them, data being the sorted hashes.
    """
    total = members.groupBy(F.col("root").alias("of")).agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    large, _ = staged(total.where((F.col("n") > shingles) | (F.col("rows") > most)).select("of"), "sets-large")
    alone = [F.lit(0).cast("long").alias("sub"), F.lit(False).alias("known")]
    if large.isEmpty():
        return _searched(sets(members).select("*", *alone), least)
    within = lambda how: members.join(large, F.col("root") == F.col("of"), how)
    found = _searched(sets(within("left_anti")).select("*", *alone), least)
    held, _ = staged(sets(within("left_semi")), "sets-held")
    roots = held.where("node = root").select(F.col("root").alias("of"), F.col("data").alias("beside"))
    compared = held.join(roots, F.col("root") == F.col("of")).select("root", "node", "data", "beside")
    star, _ = staged(compared.mapInArrow(_beside_root(least), "root long, node long, known boolean"), "sets-star")
    found = found.unionByName(star.where("known").select(F.col("node").alias("a"), F.col("root").alias("b")))
    # What is not similar to the root meets all others, `known` the sets that are and `new` those that are not.
    counted = star.join(held.select(F.col("node").alias("held"), "n"), F.col("node") == F.col("held")).groupBy(F.col("root").alias("of"))
    parts = lambda known: F.ceil(
        F.greatest(F.sum(F.when(known, F.col("n"))) * 2 / shingles, F.count(F.when(known, 1)) * 2 / most)
    )
    pieces, _ = staged(counted.agg(parts(F.col("known")).alias("old"), parts(~F.col("known")).alias("new")).where("new > 0"), "sets-pieces")
    if pieces.isEmpty():
        return found
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    of = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    subs = F.when(F.col("known"), F.transform(upto("new"), lambda j: of("old") * F.col("new") + j)).otherwise(
        F.concat(
            F.transform(upto("old"), lambda i: i * F.col("new") + of("new")),
            F.transform(
                F.filter(upto("new"), lambda j: j != of("new")),
                lambda j: (F.col("old") + F.least(j, of("new"))) * F.col("new") + F.greatest(j, of("new")),
            ),
        )
    )
    dealt = star.join(pieces, F.col("root") == F.col("of")).select("root", "node", "known", F.explode(subs).alias("sub"))
    rows = dealt.join(held.select(F.col("node").alias("held"), "data"), F.col("node") == F.col("held"))
    return found.unionByName(_searched(rows, least))
