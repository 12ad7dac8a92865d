"""Reproducible splits that depend on a row's keys only.

A hash of the keys decides, so every model sees the same split, a recomputed task
gives the same answer, and rows with equal keys stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import DIGEST_BITS, SPLIT_BUCKETS, key_digest, split_bucket
from plumbline.operators.order_stats import order_statistics
from plumbline.session import stored


#: Target values that a stratified split accepts; their limits live on the driver.
MAX_CLASSES = 1_000


def random_split(
    df: DataFrame, keys: Sequence[str], fraction: float = 0.7, seed: int = 42, output: str = "split"
) -> DataFrame:
    """Marks every row 'train' or 'test'."""
    limit = round(fraction * SPLIT_BUCKETS)
    return df.withColumn(output, F.when(split_bucket(keys, seed) < limit, "train").otherwise("test"))


def half_up(value: float) -> int:
    return int(value + 0.5)


def stratified_split(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    test: float = 0.1,
    cv: float = 0.1,
    seed: int = 2020,
    output: str = "split",
) -> DataFrame:
    """Marks rows 'test', 'cv' or 'train' with exact shares per target value.

    Rows with equal keys stay together, so repeated keys can move a limit by their number.

    The rows of a class with the lowest key hashes form the test part, the next ones
    the cv part. The two limits per class are found by counting; no row is shuffled.
    """
    hashed = df.withColumn("_t", key_digest(keys, seed))
    parts: dict[tuple, tuple[int, int]] = {}

    def wanted(group: tuple, size: int) -> list[int]:
        first = half_up(test * size)
        parts[group] = (first, first + half_up(cv * (size - first)))
        return [end - 1 for end in parts[group] if end > 0]

    sizes = df.select(target).groupBy(target).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} values; a split per value needs a class column")
    known = {(r[target],): (0, 2**DIGEST_BITS - 1, r["n"]) for r in sizes}
    digests = stored(hashed.select(target, "_t"), "digests")  # hashed once for all counting passes
    limits = {(s.group, s.rank): s.value for s in order_statistics(digests, "_t", wanted, [target], known)}
    split = F.lit("train")
    for group, ends in parts.items():
        test_limit, cv_limit = (limits.get((group, end - 1), -1) for end in ends)
        part = F.when(F.col("_t") <= test_limit, "test").when(F.col("_t") <= cv_limit, "cv").otherwise("train")
        split = F.when(F.col(target).eqNullSafe(F.lit(group[0])), part).otherwise(split)
    return hashed.withColumn(output, split).drop("_t")
