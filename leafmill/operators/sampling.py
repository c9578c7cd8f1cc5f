"""Sampling that two engines draw alike: the order is that of md5(seed:key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_key(seed: int | str, *keys: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)).cast("binary"))


def stratified(frame: DataFrame, stratum: str, key: str, size: int, seed: int = 0) -> DataFrame:
    """``size`` rows a stratum without replacement, numbered in draw order."""
    w = Window.partitionBy(stratum).orderBy(draw_key(seed, key), key)
    return frame.withColumn("draw", F.row_number().over(w)).where(F.col("draw") <= size)


def simple(frame: DataFrame, key: str, size: int, seed: int = 0) -> DataFrame:
    """A top-k by hash; no single partition sorts the frame."""
    return frame.withColumn("_k", draw_key(seed, key)).orderBy("_k", key).limit(size).drop("_k")


def quota(frame: DataFrame, group: str, key: str, forced: Column, size: int, seed: int = 0) -> DataFrame:
    """Forced rows first, then drawn ones until the group has ``size``; more forced rows all stay."""
    w = Window.partitionBy(group).orderBy(F.when(forced, 0).otherwise(1), draw_key(seed, key), key)
    return frame.withColumn("place", F.row_number().over(w)).where(forced | (F.col("place") <= size))


def round_robin(frame: DataFrame, bucket: str, order: list[Column], last: str = "unknown") -> DataFrame:
    """Each bucket's rows by turns; ``turn`` and then ``bucket`` give the order, the bucket ``last`` at the end of each turn."""
    return frame.withColumn("turn", F.row_number().over(Window.partitionBy(bucket).orderBy(*order))).withColumn("bucket_rank", (F.col(bucket) == last).cast("int"))


def one_per(frame: DataFrame, group: str, key: str, size: int, seed: int = 0) -> DataFrame:
    """``size`` groups by hash, one row of each by hash."""
    groups = simple(frame.select(group).distinct(), group, size, seed)
    return stratified(frame.join(groups, group, "left_semi"), group, key, 1, seed + 1).drop("draw")


def split(frame: DataFrame, key: str, seen: Column, every: int = 3, seed: int = 0) -> DataFrame:
    """Rows seen before belong to development; of the rest about one in ``every`` is held out, by hash alone.

    A row's half depends on itself only, so halves stay when rows are added.
    """
    held = F.conv(F.substring(draw_key(seed, key), 1, 8), 16, 10).cast("long") % every == 0
    return frame.withColumn("half", F.when(seen | ~held, "development").otherwise("held_out"))


def strangers(records: DataFrame, key: str, lease: str, size: int, seed: int = 0) -> DataFrame:
    """At most ``size`` pairs (first, second) of records: neighbours in draw order, without those of one known lease.

    Twice ``size`` records are drawn by a top-k, so only those are put in order; no pairs are made beyond the ones drawn.
    """
    drawn = simple(records.select(key, lease), key, 2 * size, seed)
    place = drawn.withColumn("_n", F.row_number().over(Window.orderBy(draw_key(seed, key), key)) - 1)
    half = F.floor(F.col("_n") / 2)
    pair = place.groupBy(half.alias("_pair")).agg(*(F.max(F.when(F.col("_n") % 2 == side, F.struct(key, lease))).alias(name) for side, name in ((0, "a"), (1, "b"))))
    apart = (F.coalesce(F.col(f"a.{lease}"), F.lit("")) == "") | ~F.col(f"a.{lease}").eqNullSafe(F.col(f"b.{lease}"))
    return pair.where(F.col("b").isNotNull() & apart).select(F.col(f"a.{key}").alias("first"), F.col(f"b.{key}").alias("second"))
