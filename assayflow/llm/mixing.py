"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Every document draws u in (0, 1) from its id and gets the key u^(1/w) for its quality
weight w; sorted by falling key, any prefix is a weighted sample without replacement. A
source takes its complete epochs first; of the rest of its target it takes the prefix
of its documents whose sizes sum up to it.

The prefix is found digit by digit: keys are 40-bit integers, and each step sums sizes
over the 1,024 values of the next 10 bits within the one interval of a source where the
budget runs out. No source is sorted in one task, whatever its share of the rows, and
only sums per source and digit are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import WORD, discard, staged

KEY_BITS, DIGIT_BITS = 40, 10


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: its size, its weight's part of `share` times all sizes, and how that is taken.

    `sizes` has source, source_size, one row per source. Sources in code-point order, NULL
    last, get the weights in turn, repeating. A target stops at `most` times its source's
    size; what is above is shared anew among the rest by weight until none is above. In the
    result target = min(most * size, level * weight), with the level that spends all.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, len(weights)) + 1).cast("int")
    )
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    # In this order the sources that reach their limit come first.
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "source",
        "source_size",
        "weight",
        "most",
        (
            (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("level"),
    )
    # The level that spends all is the one at the first source that does not reach its limit; levels fall from there on.
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(everything)
    target = F.least("most", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    rows = rows.withColumn("target", target)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return rows.select(
        "source", "source_size", "target", epochs.alias("epochs"), (F.col("target") - epochs * F.col("source_size")).alias("rest")
    )


def _cutoffs(rows: DataFrame, per_source: DataFrame) -> tuple[DataFrame, str]:
    """Per source the key at which the rest of its target runs out, and whether that key is still taken.

    A source all of whose documents fit has no row.
    """
    spark = rows.sparkSession
    # lower: the keys of the interval begin with this number; before: the sizes of all keys below it.
    at = per_source.select("source", "rest", F.lit(0).cast("long").alias("lower"), F.lit(0).cast("long").alias("before"))
    path = None
    for level in range(KEY_BITS // DIGIT_BITS):
        left = KEY_BITS - DIGIT_BITS * (level + 1)
        at = at.select(F.col("source").alias("of"), "rest", "lower", "before")
        inside = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("key", left + DIGIT_BITS) == F.col("lower"))
        sums = rows.join(at, inside).groupBy("source", "rest", "before", F.shiftright("key", left).alias("digit"))
        run = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.agg(F.sum("size").alias("n")).withColumn("upto", F.col("before") + F.sum("n").over(run))
        found = sums.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest"))).select(
            "source", "rest", F.col("digit").alias("lower"), (F.col("upto") - F.col("n")).alias("before"), "upto"
        )
        old, (at, path) = path, staged(found, "mix-cut")
        if old:
            discard(spark, old)
    nearer = F.col("upto") - F.col("rest") < F.col("rest") - F.col("before")
    return at.select(F.col("source").alias("of"), F.col("lower").alias("cut"), nearer.alias("cut_taken")), path


def weigh_documents(docs: DataFrame, quality: DataFrame | None, seed: int) -> DataFrame:
    """doc (the whole row), doc_id, source, size in words, and the 40-bit key in the order of sampling.

    `quality` has doc_id and quality, a positive weight; documents without one weigh 1.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", "source", size.alias("size"))
    if quality is None:
        rows = rows.withColumn("quality", F.lit(1.0))
    else:
        per_doc = quality.where("doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(F.avg("quality").alias("quality"))
        rows = rows.join(per_doc, F.col("doc_id") == F.col("of"), "left").drop("of")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    weight = F.when(F.col("quality") > 0, F.col("quality")).otherwise(1.0)
    key = F.floor((1 - F.pow(u, 1 / weight)) * float(2**KEY_BITS)).cast("long")
    return rows.select("doc", "doc_id", "source", "size", key.alias("key"))


def plan_sources(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source, as `of`: source_size, target, epochs, rest, and where its sampled prefix ends."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    per_source, _ = staged(targets(sizes, weights, share, most), "mix-sources")
    cuts, _ = _cutoffs(rows, per_source)
    plan = per_source.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "epochs", "rest", "cut", "cut_taken"
    )
    return staged(plan, "mix-plan")[0]


def _copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with their source's plan and `copies`, how often the mix takes them."""
    sampled = (
        F.when(F.col("cut").isNull(), F.col("rest") > 0)
        .when(F.col("key") == F.col("cut"), F.col("cut_taken"))
        .otherwise(F.col("key") < F.col("cut"))
    )
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    return joined.withColumn("copies", F.col("epochs") + sampled.cast("long"))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
) -> DataFrame:
    """Every document with how often the mix takes it.

    `docs` has doc_id, source, text; other columns are ignored. Returns doc_id, size (words;
    0 for a NULL or empty text), source_size, target, copies (complete epochs, and one more if
    the document is in the sampled prefix) and taken = copies * size. The draws depend on
    the seed and doc_id alone, so reruns agree and repeated rows of one id are taken
    together. A prefix ends with the document where the budget runs out if its words bring
    the sum nearer to the target than leaving it out. A NULL source is a source of its own;
    a source of empty texts has target 0. No rows give no rows.
    """
    rows, _ = staged(weigh_documents(docs, quality, seed).drop("doc"), "mix-rows")
    return _copies(rows, plan_sources(rows, weights, share, most)).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame,
    quality: DataFrame | None = None,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
) -> DataFrame:
    """The documents of the mix, each as often as `mix` takes it, with all columns of `docs`."""
    weighed = weigh_documents(docs, quality, seed)
    rows, _ = staged(weighed.drop("doc"), "mix-rows")
    taken = _copies(weighed, plan_sources(rows, weights, share, most)).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return taken.select("doc", copies.alias("copy")).select("doc.*")
