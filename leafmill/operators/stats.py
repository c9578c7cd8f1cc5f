"""Aggregates and statistics: rates, strata, intervals, paired tests, picks by rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rate(hit: Column, among: Column) -> Column:
    """The share of ``hit`` among rows of ``among``; null where there are none."""
    return F.try_divide(F.count_if(hit & among), F.count_if(among))


def learned_map(rows: DataFrame, key: str, value: str) -> DataFrame:
    """A3: keys with one value only; ambiguous ones are left out."""
    return rows.groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_other")).where(F.col(value) == F.col("_other")).drop("_other")


def confusion(rows: DataFrame, want: str, got: str) -> DataFrame:
    """A4"""
    return rows.groupBy(want, got).agg(F.count(F.lit(1)).alias("n"))


def era_buckets(rows: DataFrame, label: str) -> DataFrame:
    """Rows with their bucket's key and label: the shortest spelling, the first by alphabet among equals."""
    keyed = rows.withColumn("era_key", S.revision_key(label))
    names = keyed.groupBy("era_key").agg(F.min(F.struct(F.length(label).alias("n"), F.col(label).alias("v"))).alias("s")).select("era_key", F.col("s.v").alias("era_label"))
    return keyed.join(names, "era_key")


def nearest_rank(x: Column | str, share: float) -> Column:
    """sorted[min(n - 1, floor(share * n))] of the values that aren't null.

    The sorted array is one group's values: for groups of unbounded size take ``ranked_pick``.
    """
    values = F.sort_array(F.collect_list(_c(x)))
    return F.get(values, F.least(F.size(values) - 1, F.floor(F.size(values) * share).cast("int")))


def ranked_pick(rows: DataFrame, group: list[str], x: str, share: float, upper: bool = False) -> DataFrame:
    """A22, A23 by row numbers: no group is gathered. ``upper``: the middle or the upper of two middle values."""
    w = Window.partitionBy(*group)
    n = F.count(x).over(w)
    at = F.floor(n / 2) if upper else F.least(n - 1, F.floor(n * share))
    numbered = rows.where(F.col(x).isNotNull()).withColumn("_i", F.row_number().over(w.orderBy(x)) - 1).withColumn("_at", at)
    return numbered.where("_i = _at").select(*group, F.col(x).alias("picked"))


def mode_first(rows: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value, of equals the one seen first by ``order``."""
    counted = rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    best = counted.groupBy(*group).agg(F.max(F.struct("n", (-F.col("first_seen")).alias("r"), F.col(value).alias("v"))).alias("b"))
    return best.select(*group, F.col("b.v").alias("mode_value"), F.col("b.n").alias("mode_count"))


def stratified_proportion(strata: DataFrame) -> DataFrame:
    """One row from strata (frame_size, sampled, hits): proportion and its standard error with the finite
    population correction; a stratum sampled whole adds no variance. Also the error planned at p = 0.5."""
    weight = F.col("frame_size") / F.sum("frame_size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    p = F.col("hits") / F.col("sampled")
    fpc = 1 - F.col("sampled") / F.col("frame_size")

    def variance(p: Column) -> Column:
        return F.when(F.col("sampled") >= F.col("frame_size"), 0.0).otherwise(F.try_divide(fpc * p * (1 - p), F.col("sampled") - 1))

    rows = strata.select((weight * p).alias("part"), (weight * weight * variance(p)).alias("var"), (weight * weight * variance(F.lit(0.5))).alias("plan"), "frame_size", "sampled")
    return rows.agg(F.sum("part").alias("proportion"), F.sqrt(F.sum("var")).alias("standard_error"), F.sqrt(F.sum("plan")).alias("planned_error"), F.sum("frame_size").alias("frame"), F.sum("sampled").alias("sampled"))


def bad_strata(strata: DataFrame) -> DataFrame:
    """Invariant: frame of one at least, sampled within it, hits within that, no single draw from a larger frame."""
    return strata.where("frame_size < 1 OR sampled > frame_size OR hits > sampled OR (sampled = 1 AND frame_size > 1)")


def domain_ratio(drawn: DataFrame, stratum: str, frame: str, hit: Column, inside: Column) -> DataFrame:
    """Weighted hits over weighted members of a domain; a drawn row weighs frame / rows drawn in its stratum."""
    w = F.col(frame) / F.count(F.lit(1)).over(Window.partitionBy(stratum))
    rows = drawn.select(w.alias("w"), hit.alias("h"), inside.alias("i"))
    return rows.agg(F.sum(F.when(F.col("i"), F.col("w"))).alias("weighted_members"), F.try_divide(F.sum(F.when(F.col("i") & F.col("h"), F.col("w"))), F.sum(F.when(F.col("i"), F.col("w")))).alias("ratio"))


def bootstrap(rows: DataFrame, stratum: str, key: str, hit: str, replicates: int = 2000, seed: int = 0) -> DataFrame:
    """Nearest-rank 5th and 95th percentile of the frame-weighted share over resamples within strata.

    Each replicate gives each row a Poisson(1) count from a hash, so a resample is one more aggregate of the
    same scan: no draw refers to another row, and nothing is gathered. Draws aren't those of other generators.
    """
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("replicate"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    steps, total, term = [], 0.0, 2.718281828459045**-1
    for k in range(1, 8):
        total += term
        term /= k
        steps.append(F.when(u >= total, 1).otherwise(0))
    count = sum(steps[1:], steps[0])
    reps = rows.select(stratum, key, hit, F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")).withColumn("c", count)
    per = reps.groupBy("replicate", stratum).agg(F.sum(F.col("c") * F.col(hit)).alias("h"), F.sum("c").alias("n"), F.count(F.lit(1)).alias("frame"))
    share = per.groupBy("replicate").agg(F.try_divide(F.sum(F.col("frame") * F.try_divide("h", "n")), F.sum("frame")).alias("p"))
    return share.agg(nearest_rank("p", 0.05).alias("low"), F.avg("p").alias("mean"), nearest_rank("p", 0.95).alias("high"))


def binomial_tail(k: Column, n: Column) -> Column:
    """P(X <= k) of n fair throws, term by term in logarithms; exact for the small n of paired tests."""
    start = F.struct((-n * F.log(F.lit(2.0))).alias("t"), F.exp(-n * F.log(F.lit(2.0))).alias("s"))

    def step(acc: Column, i: Column) -> Column:
        t = acc["t"] + F.log((n - i + 1) / i)
        return F.struct(t.alias("t"), (acc["s"] + F.exp(t)).alias("s"))

    return F.when(k < 1, start["s"]).otherwise(F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))), start, step)["s"])


def mcnemar(b: Column, c: Column) -> Column:
    """Two-sided exact test over discordant pairs, at most 1."""
    n = (b + c).cast("double")
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * binomial_tail(F.least(b, c), n)))


def mcnemar_one_sided(b: Column, c: Column) -> Column:
    """The tail starts at min(b, c) where b < c, else at b."""
    n = (b + c).cast("double")
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), binomial_tail(F.when(b < c, F.least(b, c)).otherwise(b), n)))


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """A15"""
    p, n = F.try_divide(hits, n), n.cast("double")
    middle, half = (p + z * z / (2 * n)) / (1 + z * z / n), z / (1 + z * z / n) * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return middle - half, middle + half


def zero_bound(n: Column, confidence: float = 0.95) -> Column:
    """The upper bound where nothing was found, 1 - (1 - confidence)^(1/n)."""
    return F.when(n > 0, 1 - F.pow(F.lit(1 - confidence), 1 / n)).otherwise(1.0)


def upper_bound(hits: Column, n: Column, confidence: float = 0.95, steps: int = 40) -> Column:
    """The p at which ``hits`` or fewer of ``n`` has probability 1 - confidence, by bisection in an expression."""

    def tail(p: Column) -> Column:
        first = n * F.log(1 - p)
        start = F.struct(first.alias("t"), F.exp(first).alias("s"))

        def step(acc: Column, i: Column) -> Column:
            t = acc["t"] + F.log((n - i + 1) / i) + F.log(p / (1 - p))
            return F.struct(t.alias("t"), (acc["s"] + F.exp(t)).alias("s"))

        return F.when(hits < 1, start["s"]).otherwise(F.aggregate(F.when(hits >= 1, F.sequence(F.lit(1).cast("long"), hits.cast("long"))), start, step)["s"])

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        above = tail(mid) > 1 - confidence
        return F.struct(F.when(above, mid).otherwise(acc["lo"]).alias("lo"), F.when(above, acc["hi"]).otherwise(mid).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(1e-12).alias("lo"), F.lit(1 - 1e-12).alias("hi")), halve)
    return F.when(hits >= n, 1.0).otherwise((found["lo"] + found["hi"]) / 2)


def winner(gain: Column, p: Column, least: float = 0.05, alpha: float = 0.05) -> Column:
    """The cheaper arm unless the dearer gains more than ``least`` at p below ``alpha``."""
    return F.when((gain > least) & (p < alpha), "dear").otherwise("cheap")


def correlation(x: Column, y: Column) -> Column:
    """Pearson over two arrays of equal length; null, not NaN, where a side is constant."""
    n = F.size(x).cast("double")

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)

    sx, sy = total(x), total(y)
    xx, yy = total(F.transform(x, lambda v: v * v)), total(F.transform(y, lambda v: v * v))
    xy = total(F.zip_with(x, y, lambda a, b: a * b))
    vx, vy = xx - sx * sx / n, yy - sy * sy / n
    return F.when((vx > 1e-12) & (vy > 1e-12), (xy - sx * sy / n) / F.sqrt(F.when(vx > 1e-12, vx) * F.when(vy > 1e-12, vy)))


def accuracy_by(rows: DataFrame, bucket: str, hit: Column) -> DataFrame:
    """Hits and n for each bucket that rows name; a null or empty one is none, and a hit that can't be told is no hit."""
    named = rows.where(F.coalesce(F.col(bucket), F.lit("")) != "")
    out = named.groupBy(bucket).agg(F.count_if(F.coalesce(hit, F.lit(False))).alias("hits"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("accuracy", F.col("hits") / F.col("n"))


def comparable(rows: DataFrame, item: str, arm: str, truth: DataFrame) -> DataFrame:
    """Items with a truth that every arm among ``rows`` has a row for."""
    each = rows.select(item, arm).distinct()
    arms = each.agg(F.countDistinct(arm).alias("_arms"))  # one row
    per = each.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    return per.join(F.broadcast(arms), F.col("_n") == F.col("_arms")).select(item).join(truth.select(item), item, "left_semi")
