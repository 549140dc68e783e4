"""Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf, its digest that of all its columns. Each language has a binary tree over its
leaves in order of doc_id, and one more tree joins the languages' roots. A level's nodes are hashed
two by two; the last one of an odd level is hashed alone.

Trees are built in aligned blocks of 2^BLOCK_LEVELS nodes, so a tree of any size takes a few rounds and
no task holds more than a block. Proofs are made by partition of leaves: a partition works out which
nodes it can neither see nor derive - the least union of siblings for all its leaves -
fetches those once, derives the interiors its leaves share, and expands every leaf's proof locally.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import discard, staged

#: Levels hashed in one round; a block is 2^BLOCK_LEVELS nodes.
BLOCK_LEVELS = 12
#: Leaves of one partition for proofs.
PART_LEAVES = 8192
#: The tree over the languages' roots; the languages' own trees are numbered from 0.
TOP = -1

NODES = "tree long, level int, place long, hash binary, n long"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, proof array<string>"


def digest(*parts: str) -> str:
    """H: SHA-256 in lowercase hex of the concatenated parts, digests among them as hex text."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(n_chars: Column) -> Column:
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    return F.unhex(F.sha2(F.concat(*[_field(f) for f in fields]).cast("binary"), 256))


def tampered() -> Column:
    """Whether a row is one of those altered after the manifest was made; never so without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """lang, doc_id, leaf and claimed, the leaf of the row as a later reader finds it: n_chars one more where tampered."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    claimed = F.when(tampered(), _leaf(F.col("n_chars") + 1))
    return rows.select("lang", "doc_id", _leaf(F.col("n_chars")).alias("leaf"), claimed.alias("claimed"))


def numbered(frame: DataFrame, group: list[str], order: list[str], purpose: str) -> DataFrame:
    """The rows with place, counted from 0 within their group in the given order (NULLs first), and n, the group's size.

    Rows are ranged over partitions and counted within each, so a group of any size is spread
    over tasks; what is summed along a group is one count per partition. Rows that are
    equal in all of `order` are interchangeable, and may be spread too. `frame` must be stored.
    """
    keys = [F.asc_nulls_first(c) for c in [*group, *order]] + [F.col("nth")]
    ranged = frame.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The lower 33 bits of this id are the row's number within its partition.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored, _ = staged(ranged.drop("nth").withColumn("part", F.spark_partition_id()).withColumn("row", row), f"{purpose}-order")
    counts = stored.groupBy(*group, "part").agg(F.min("row").alias("first_row"), F.count("*").alias("in_part"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *[F.col(c).alias(f"of_{c}") for c in group],
        F.col("part").alias("of_part"),
        (F.coalesce(F.sum("in_part").over(before), F.lit(0)) - F.col("first_row")).alias("lift"),
        F.sum("in_part").over(whole).alias("n"),
    )
    counts, _ = staged(counts, f"{purpose}-counts")
    same = F.col("part") == F.col("of_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    joined = stored.join(counts, same).withColumn("place", F.col("row") + F.col("lift"))
    return joined.select(*[c for c in frame.columns], "place", "n")


def _climb(levels: int):
    def climb(block: pa.Table) -> pa.Table:
        """The nodes above one aligned block of a level, up to so many levels higher or the root."""
        tree, level, n = (block.column(c)[0].as_py() for c in ("tree", "level", "n"))
        order = np.argsort(block.column("place").to_numpy(), kind="stable")
        hashes = [h.hex() for h in block.column("hash").take(pa.array(order)).to_pylist()]
        first = block.column("place")[int(order[0])].as_py()
        out = []
        for up in range(1, levels + 1):
            if n == 1:
                break
            hashes = [digest(*hashes[i : i + 2]) for i in range(0, len(hashes), 2)]
            first, n = first >> 1, (n + 1) >> 1
            out += [(tree, level + up, first + i, bytes.fromhex(h), n) for i, h in enumerate(hashes)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["tree", "level", "place", "hash", "n"])

    return climb


def build(level0: DataFrame) -> DataFrame:
    """All nodes of the trees over `level0` (tree, place, hash, n): NODES, stored; n is the number of nodes of that level."""
    spark = level0.sparkSession
    nodes = level0.select("tree", F.lit(0).alias("level"), "place", "hash", "n")
    current, level, most = nodes, 0, nodes.agg(F.max("n")).head()[0] or 0
    while most > 1:
        block = F.shiftright("place", BLOCK_LEVELS)
        rows = current.where("n > 1").withColumn("block", block)
        above, _ = staged(rows.groupBy("tree", "block").applyInArrow(_climb(BLOCK_LEVELS), NODES), "merkle-nodes")
        nodes = nodes.unionByName(above)
        level += BLOCK_LEVELS
        current = above.where(F.col("level") == level)
        most = -(-most >> BLOCK_LEVELS) if most > 1 << BLOCK_LEVELS else 1
    return spark.createDataFrame([], NODES).unionByName(nodes)


@dataclass
class Manifest:
    """leaves: tree, place, n, doc_id, leaf, claimed; nodes: NODES of all trees; trees: how many languages there are."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int


def make_manifest(docs: DataFrame) -> Manifest:
    """The trees of `docs`, stored in the shared folder.

    `docs` has doc_id, source, lang, n_chars, text; other columns are ignored. Rows with a NULL
    lang form the first tree, rows with a NULL doc_id come first in theirs; rows with equal
    doc_id are ordered by their leaf. No rows give no trees.
    """
    # Written first, so that ranging the leaves does not hash the texts twice.
    found, path = staged(leaves(docs), "merkle-leaves")
    placed, _ = staged(numbered(found, ["lang"], ["doc_id", "leaf"], "merkle"), "merkle-placed")
    langs, _ = staged(placed.select("lang", F.col("n").alias("size")).distinct(), "merkle-langs")
    trees = numbered(langs, [], ["lang"], "merkle-langs").select(F.col("lang").alias("of"), F.col("place").alias("tree"), F.col("n").alias("trees"))
    trees, _ = staged(trees, "merkle-trees")
    joined = placed.join(trees, F.col("lang").eqNullSafe(F.col("of"))).select("tree", "place", "n", "doc_id", "leaf", "claimed")
    joined, _ = staged(joined, "merkle-table")
    discard(docs.sparkSession, path)
    count = trees.count()
    own = build(joined.select("tree", "place", F.col("leaf").alias("hash"), "n"))
    subroots = own.where("n = 1").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "hash", F.lit(count).cast("long").alias("n"))
    # A tree of one leaf has its root at level 0; the others' roots are the only nodes of their last level.
    subroots, _ = staged(subroots, "merkle-subroots")
    return Manifest(joined, own.unionByName(build(subroots)), count)


def missing_nodes(places: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Per level, the least union of nodes that proofs of all these places need beyond what they give themselves.

    A node is needed if it is the sibling of one that is given or derived, and neither itself.
    """
    known, out, level = np.unique(places), [], 0
    while n > 1:
        siblings = known ^ 1
        need = siblings[siblings < n]
        need = need[~np.isin(need, known, assume_unique=True)]
        if len(need):
            out.append((level, need))
        known, n, level = np.unique(known >> 1), (n + 1) >> 1, level + 1
    return out


def height(n: int) -> int:
    return max(0, n - 1).bit_length()


def _coordinates(trees: int):
    def coordinates(key: tuple, table: pa.Table) -> pa.Table:
        """The nodes that one partition of leaves fetches, and the two published roots."""
        tree, part = (k.as_py() for k in key)
        n = table.column("n")[0].as_py()
        wanted = [(tree, level, place) for level, found in missing_nodes(table.column("place").to_numpy(), n) for place in found.tolist()]
        wanted += [(TOP, level, place) for level, found in missing_nodes(np.array([tree]), trees) for place in found.tolist()]
        # Roots are published with the manifest; a proof never derives them from what is fetched alone.
        wanted += [(tree, height(n), 0), (TOP, height(trees), 0)]
        wanted = sorted(set(wanted))
        out = {
            "for_tree": pa.array([tree] * len(wanted), pa.int64()),
            "part": pa.array([part] * len(wanted), pa.int64()),
            "tree": pa.array([w[0] for w in wanted], pa.int64()),
            "level": pa.array([w[1] for w in wanted], pa.int32()),
            "place": pa.array([w[2] for w in wanted], pa.int64()),
        }
        return pa.table(out)

    return coordinates


def derive(known: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """Per level all nodes that the known leaves and the fetched nodes give; shared interiors are hashed once."""
    levels, level = [], 0
    while True:
        here = dict(known)
        levels.append(here)
        if n == 1:
            return levels
        for place in list(known):
            sibling = place ^ 1
            if sibling < n and sibling not in here:
                here[sibling] = fetched[level, sibling]
        known = {}
        for place in here:
            up = place >> 1
            if up not in known:
                left, right = up << 1, (up << 1) + 1
                known[up] = digest(here[left], here[right]) if right < n else digest(here[left])
        n, level = (n + 1) >> 1, level + 1


def siblings(levels: list[dict[int, str]], place: int) -> list[tuple[int, str | None]]:
    """A leaf's proof in its tree: per level whether the leaf's side is the right one, and the sibling, None if it has none."""
    out = []
    for here in levels[:-1]:
        out.append((place & 1, here.get(place ^ 1)))
        place >>= 1
    return out


def fold(leaf: str, proof: list[tuple[int, str | None]]) -> str:
    """The root that a leaf and its proof give."""
    for right, sibling in proof:
        leaf = digest(leaf) if sibling is None else digest(sibling, leaf) if right else digest(leaf, sibling)
    return leaf


def _expand(trees: int, with_proofs: bool):
    def expand(key: tuple, own: pa.Table, fetched: pa.Table) -> pa.Table:
        """Proofs of one partition's leaves from what it has fetched."""
        tree = key[0].as_py()
        n = own.column("n")[0].as_py()
        found: dict[int, dict] = {tree: {}, TOP: {}}
        for t, level, place, h in zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "place", "hash")), strict=True):
            found[t][level, place] = h.hex()
        places = own.column("place").to_pylist()
        given = [h.hex() for h in own.column("leaf").to_pylist()]
        claimed = [h and h.hex() for h in own.column("claimed").to_pylist()]
        levels = derive(dict(zip(places, given, strict=True)), found[tree], n)
        subroot, root = found[tree].get((height(n), 0), levels[-1].get(0)), found[TOP][height(trees), 0]
        top = siblings(derive({tree: subroot}, found[TOP], trees), tree)
        proofs, hashes, folded = [], [], []
        for place, leaf, other in zip(places, given, claimed, strict=True):
            proof = siblings(levels, place) + top
            parts = [s for _, s in proof if s is not None]
            hashes.append(digest(*parts))
            folded.append(fold(other or leaf, proof))
            proofs.append(parts if with_proofs else None)
        rows = own.num_rows
        return pa.table(
            {
                "doc_id": own.column("doc_id"),
                "leaf": pa.array(given),
                "subroot": pa.array([subroot] * rows),
                "root": pa.array([root] * rows),
                "proof_sha256": pa.array(hashes),
                "folded_root": pa.array(folded),
                "proof": pa.array(proofs, pa.list_(pa.string())),
            }
        )

    return expand


def prove(manifest: Manifest, wanted: DataFrame | None = None, with_proofs: bool = False) -> DataFrame:
    """PROOFS of the wanted leaves, some or all rows of `manifest.leaves`; `proof` is NULL unless asked for.

    proof_sha256 is the digest of the siblings' digests from the leaf's level up to the root,
    folded_root the root that `claimed`, or the leaf where that is NULL, gives with the
    original siblings. A tree of one leaf under one language has no siblings.
    """
    parts = (F.floor(F.col("place") / PART_LEAVES)).cast("long")
    own = (manifest.leaves if wanted is None else wanted).withColumn("for_tree", F.col("tree")).withColumn("part", parts)
    schema = "for_tree long, part long, tree long, level int, place long"
    coordinates = own.select("for_tree", "part", "place", "n").groupBy("for_tree", "part").applyInArrow(_coordinates(manifest.trees), schema)
    coordinates, _ = staged(coordinates, "merkle-coordinates")
    nodes = manifest.nodes.select("tree", "level", "place", "hash")
    fetched, _ = staged(coordinates.join(nodes, ["tree", "level", "place"]), "merkle-fetched")
    return (
        own.groupBy("for_tree", "part")
        .cogroup(fetched.groupBy("for_tree", "part"))
        .applyInArrow(_expand(manifest.trees, with_proofs), PROOFS)
    )


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row, tampered ones with what they claim."""
    proofs = prove(make_manifest(docs)).drop("proof")
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
