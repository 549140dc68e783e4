"""Joins that stay even when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_fanout(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left equi join whose right side may repeat a key very often.

    Adaptive execution splits a skewed partition only on the preserved side of an
    outer join, so one hot key on the right of a plain left join ends up in one
    task. An inner join can be split on both sides; the left rows without partner
    come from an anti join against the distinct keys, which are reduced on the
    map side. Same rows as the plain left join, NULL keys included.
    """
    keys = list(keys)
    matched = left.join(right, keys, "inner")
    unmatched = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def orphans(child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """Child keys without a parent row, with the number of child rows of each.

    Rows are counted per key before the join, so the join sees each key once.
    A key with a NULL part refers to nothing and is not an orphan.
    """
    per_key = child.dropna(subset=list(child_keys)).groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(*(F.col(p).alias(c) for p, c in zip(parent_keys, child_keys, strict=True))).distinct()
    return per_key.join(known, list(child_keys), "left_anti")


def pairs_by_type(stocks: DataFrame, samples: DataFrame, key: str, type_column: str) -> DataFrame:
    """Stocks and owning samples per sample type: pairs, and how many distinct samples have one."""
    per_sample = stocks.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_sample.join(samples.select(key, type_column), key)
        .groupBy(type_column)
        .agg(F.sum("n").alias("n_pairs"), F.countDistinct(key).alias("n_samples"))
    )
