"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors whose cosine is at least c are at most eps = sqrt(2 - 2 c) apart, and so are their
projections on any axes. Vectors are put in the order of grid cells of side eps on their
leading principal axes and cut into blocks of that order. Intervals of the order are joined
recursively: two intervals whose boxes on these axes are further apart than eps
are skipped with all that is in them, others are split, down to pairs of blocks. Pairs of
blocks are compared in tiles, each of which a task holds in whole and bounded size; what
leaves it are counts and one link per vector, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import discard, staged
from assayflow.llm.components import connected_components

#: Vectors the axes are fitted on, and how many axes; they decide what is skipped, not what is found.
SAMPLE, AXES = 4096, 8
#: Vectors of a block, intervals of one level that make one of the next, and blocks on a side of a tile.
BLOCK, FAN, TILE = 1024, 8, 16


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """node, rep, weight, vec: each different usable vector once, with its smallest vec_id and its number of rows.

    Unusable are NULL and empty vectors, those with NULL, infinite or NaN components, zero vectors, and
    rows without vec_id.
    """
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = F.col("vec_id").isNotNull() & finite & F.exists(vec, lambda x: x != 0)
    rows = embeddings.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
    grouped = rows.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    return grouped.select(F.monotonically_increasing_id().alias("node"), "rep", "weight", "vec")


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """The leading principal axes of a sample of at most SAMPLE vectors, as columns; the sample depends on the vectors alone.

    Their hashes are chosen first, so that only chosen vectors leave their tasks.
    """
    drawn = vectors.select("vec", F.xxhash64("vec").alias("draw"))
    draws = [r.draw for r in drawn.select("draw").orderBy("draw").limit(SAMPLE).collect()]
    # At most SAMPLE and those that share the last hash; vectors are different.
    rows = drawn.where(F.col("draw") <= draws[-1]).select("draw", "vec").collect() if draws else []
    rows.sort()
    size = max((len(r.vec) for r in rows), default=1)
    x = np.zeros((len(rows), size))
    for i, r in enumerate(rows):
        x[i, : len(r.vec)] = r.vec
    x /= np.abs(x).max(axis=1, keepdims=True, initial=0)  # so that squares neither vanish nor overflow
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x -= x.mean(axis=0) if len(x) else 0
    _, axes = np.linalg.eigh(x.T @ x)
    return np.ascontiguousarray(axes[:, ::-1][:, :AXES])


def grid_order(vectors: DataFrame, axes: np.ndarray, eps: float) -> DataFrame:
    """node, weight, data, place: the vectors with their grid cells as a sortable key and their coordinates."""
    shared = vectors.sparkSession.sparkContext.broadcast(axes)  # AXES columns of a vector's length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = shared.value
        for batch in batches:
            cells, data, places = [], [], []
            for vec in batch.column(2):
                x = np.array(vec.as_py(), np.float64)
                n = min(len(x), len(axes))
                unit = x / np.abs(x).max()
                # Vectors of another length than the sample's: what they have of these axes; longer ones lose a part,
                # which brings projections nearer and so skips less.
                place = (unit[:n] / np.linalg.norm(unit)) @ axes[:n]
                cell = np.clip(np.floor(place / eps), -30000, 30000).astype(np.int64) + 32768
                cells.append(len(x).to_bytes(4, "big") + cell.astype(">u2").tobytes())
                data.append(x.tobytes())
                places.append(place.tolist() + [0.0] * (AXES - len(place)))
            columns = [batch.column(0), batch.column(1), pa.array(cells, pa.binary()), pa.array(data, pa.binary()), pa.array(places, pa.list_(pa.float64()))]
            yield pa.record_batch(columns, ["node", "weight", "cell", "data", "place"])

    schema = "node long, weight long, cell binary, data binary, place array<double>"
    return vectors.select("node", "weight", "vec").mapInArrow(run, schema)


def blocks(ordered: DataFrame) -> DataFrame:
    """block, lows, highs, members: consecutive vectors of the grid order, BLOCK at a time, with their boxes."""
    parts, _ = staged(
        ordered.orderBy("cell", F.col("place")[0], "node").withColumn("at", F.monotonically_increasing_id()), "ego-order"
    )
    part = F.shiftright("at", 33)
    sizes = parts.groupBy(part.alias("of")).agg(F.count("*").alias("n"))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    sizes, _ = staged(sizes.select("of", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "ego-parts")
    number = F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)
    rows = parts.join(sizes, part == F.col("of")).withColumn("block", F.floor(number / BLOCK).cast("long"))
    box = lambda f: F.array(*[f(F.col("place")[i]) for i in range(AXES)])
    return rows.groupBy("block").agg(
        box(F.min).alias("lows"), box(F.max).alias("highs"), F.collect_list(F.struct("node", "weight", "data")).alias("members")
    )


def near_blocks(boxes: DataFrame, eps: float) -> tuple[DataFrame, int]:
    """Pairs a <= b of blocks whose boxes are at most eps apart, found from the top of the order down; and their number of levels."""
    levels = [boxes]
    while levels[-1].count() > 1:
        edge = lambda f, column: F.array(*[f(F.col(column)[i]) for i in range(AXES)])
        upper = levels[-1].groupBy(F.floor(F.col("block") / FAN).cast("long").alias("block"))
        above, _ = staged(upper.agg(edge(F.min, "lows").alias("lows"), edge(F.max, "highs").alias("highs")), "ego-level")
        levels.append(above)
    pairs = levels[-1].select(F.col("block").alias("a"), F.col("block").alias("b"))
    path = None
    for level in reversed(levels[:-1]):
        below = lambda c: F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1))
        split = pairs.select(below("a").alias("a"), "b").select("a", below("b").alias("b")).where("a <= b")
        side = lambda name: level.select(F.col("block").alias(name), F.col("lows").alias(f"lows_{name}"), F.col("highs").alias(f"highs_{name}"))
        joined = split.join(side("a"), "a").join(side("b"), "b")
        gap = [
            F.greatest(F.col("lows_a")[i] - F.col("highs_b")[i], F.col("lows_b")[i] - F.col("highs_a")[i], F.lit(0.0)) for i in range(AXES)
        ]
        # A little more than eps, as projections are rounded.
        near = sum((g * g for g in gap[1:]), gap[0] * gap[0]) <= eps * eps + 1e-9
        old, (pairs, path) = path, staged(joined.where(near).select("a", "b"), "ego-pairs")
        if old:
            discard(boxes.sparkSession, old)
    return pairs, len(levels)


class _Side:
    """The vectors of a block, by length: places in the tile, their unit vectors and weights."""

    def __init__(self, members, first: int):
        self.nodes = np.array([m["node"] for m in members], np.int64)
        self.weights = np.array([m["weight"] for m in members], np.float64)
        self.first = first
        lengths = np.array([len(m["data"]) // 8 for m in members])
        self.units = {}
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            x = np.frombuffer(b"".join(members[i]["data"] for i in at), np.float64).reshape(-1, n)
            x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            self.units[n] = (at, x, x.astype(np.float32))


def _linked(one: _Side, two: _Side, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in two blocks of linked vectors: those single precision cannot rule out, checked in double precision."""
    rows, columns = [], []
    for n, (at, x, x32) in one.units.items():
        if n not in two.units:
            continue
        other, y, y32 = two.units[n]
        i, j = np.nonzero(x32 @ y32.T >= least - 1e-4)
        if one is two:
            i, j = i[i < j], j[i < j]
        exact = np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 65536]], y[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.empty(0)])
        rows.append(at[i[exact >= least]])
        columns.append(other[j[exact >= least]])
    return np.concatenate(rows or [np.empty(0, np.int64)]), np.concatenate(columns or [np.empty(0, np.int64)])


def _compare(tile: dict[int, tuple[list[int], _Side]], size: int, least: float):
    """node, n, root of a tile: how many vectors each is linked with here, and one it is connected with."""
    counts, labels = np.zeros(size), np.arange(size)
    nodes = np.empty(size, np.int64)
    for _, side in tile.values():
        nodes[side.first : side.first + len(side.nodes)] = side.nodes
    for partners, one in tile.values():
        for partner in partners:
            two = tile[partner][1]
            i, j = _linked(one, two, least)
            if not len(i):
                continue
            counts[one.first : one.first + len(one.nodes)] += np.bincount(i, two.weights[j], len(one.nodes))
            counts[two.first : two.first + len(two.nodes)] += np.bincount(j, one.weights[i], len(two.nodes))
            i, j = i + one.first, j + two.first
            while True:
                low = np.minimum(labels[i], labels[j])
                if (low == labels[i]).all() and (low == labels[j]).all():
                    break
                np.minimum.at(labels, i, low)
                np.minimum.at(labels, j, low)
    some = np.flatnonzero(counts)
    return pa.record_batch(
        [pa.array(nodes[some]), pa.array(counts[some].astype(np.int64)), pa.array(nodes[labels[some]])], ["node", "n", "root"]
    )


def _tiles(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tile, size = None, {}, 0
        for batch in batches:
            for row in range(batch.num_rows):
                of = (batch.column(0)[row].as_py(), batch.column(1)[row].as_py())
                if of != now:
                    if tile:
                        yield _compare(tile, size, least)
                    now, tile, size = of, {}, 0
                side = _Side(batch.column(4)[row].as_py(), size)
                tile[batch.column(2)[row].as_py()] = (batch.column(3)[row].as_py(), side)
                size += len(side.nodes)
        if tile:
            yield _compare(tile, size, least)

    return run


def join_blocks(full: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """node, n, root from every pair of blocks, TILE blocks by TILE at a time."""
    tile = [F.floor(F.col(c) / TILE).cast("long").alias(f"tile_{c}") for c in ("a", "b")]
    placed = pairs.select(*tile, "a", "b")
    sides = placed.select("tile_a", "tile_b", F.col("a").alias("block"), F.col("b").alias("partner")).unionByName(
        placed.select("tile_a", "tile_b", F.col("b").alias("block"), F.lit(None).cast("long").alias("partner"))
    )
    sides = sides.groupBy("tile_a", "tile_b", "block").agg(F.collect_set("partner").alias("partners"))
    rows = sides.join(full.select("block", "members"), "block").select("tile_a", "tile_b", "block", "partners", "members")
    spread = int(full.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(spread, "tile_a", "tile_b").sortWithinPartitions("tile_a", "tile_b")
    return dealt.mapInArrow(_tiles(least), "node long, n long, root long")


def near_duplicates(embeddings: DataFrame, least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    `embeddings` has vec_id and embedding; other columns are ignored. Two rows are linked if the
    cosine of their vectors, in double precision, is at least `least`. Equal vectors are joined
    once and counted as often as they occur, so repeated rows link with each other. Vectors that
    are NULL, empty, zero or have NULL, infinite or NaN components link with nothing, nor do vectors of
    different lengths or rows without vec_id, whose component_id is NULL and kept false.
    component_id is the smallest vec_id that links reach, kept whether it is the row's own.
    No rows give no rows.
    """
    eps = math.sqrt(2 - 2 * least)
    vectors, _ = staged(unit_vectors(embeddings), "ego-vectors")
    full, _ = staged(blocks(grid_order(vectors, principal_axes(vectors), eps)), "ego-blocks")
    pairs, _ = near_blocks(full.select("block", "lows", "highs"), eps)
    found, _ = staged(join_blocks(full, pairs, least), "ego-links")
    counts = found.groupBy(F.col("node").alias("counted")).agg(F.sum("n").alias("n"))
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    members = vectors.select("node", "rep", "weight", "vec").join(groups.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    members = members.join(counts, F.col("node") == F.col("counted"), "left").select(
        F.coalesce("root", "node").alias("root"), "rep", "vec", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    members, _ = staged(members, "ego-members")
    smallest, _ = staged(members.groupBy(F.col("root").alias("of")).agg(F.min("rep").alias("component_id")), "ego-components")
    labelled, _ = staged(
        members.join(smallest, F.col("root") == F.col("of")).select(F.col("vec").alias("same"), "n_links", "component_id"), "ego-labels"
    )
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    own = F.when(F.col("vec_id").isNotNull(), F.col("vec"))
    joined = rows.withColumn("own", own).join(labelled, F.col("own") == F.col("same"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
