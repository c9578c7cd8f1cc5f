"""Window-shaped operators: gaps, runs, ranks, bounds, shifts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import stats, tiles


def previous_known(x: str, group: list[str], order: list[str]) -> Column:
    """The last value before this row that isn't null."""
    return F.last(x, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))


def gap_groups(rows: DataFrame, group: list[str], x: str, tie: list[str], tolerance: Column, out: str = "cluster") -> DataFrame:
    """Numbers of runs in which neighbours are within ``tolerance`` of each other."""
    w = Window.partitionBy(*group).orderBy(x, *tie)
    new = F.when(F.col(x) - F.lag(x).over(w) > tolerance, 1).otherwise(0)
    return rows.withColumn("_new", new).withColumn(out, F.sum("_new").over(w)).drop("_new")


def line_gaps(words: DataFrame, page: str, same_line: Column, ordinal: str) -> DataFrame:
    """The gap to the next word of the line, where there is one. ``words``: left, top, right, bottom; ``same_line`` may name next_top."""
    w = Window.partitionBy(page).orderBy("top", "left", ordinal)
    rows = words.withColumn("next_left", F.lead("left").over(w)).withColumn("next_top", F.lead("top").over(w))
    gap = F.col("next_left") - F.col("right")
    return rows.withColumn("gap", F.when(same_line & (gap > 0), gap)).drop("next_left", "next_top")


def gap_cutoff(gaps: DataFrame, page: str, height: float = 0.012, least: int = 20) -> DataFrame:
    """Four median gaps where there are enough of them, else one and a half line heights."""
    return gaps.groupBy(page).agg(F.count("gap").alias("n_gaps"), F.when(F.count("gap") >= least, 4 * F.median("gap")).otherwise(1.5 * height).alias("cutoff"))


def line_run(words: DataFrame, page: str, cutoff: float, line: float = 0.006) -> DataFrame:
    """For each page's matched word the run of words of its line without a wide gap, walking both ways.

    The walk compares each word with the last one taken in. Where all words of a line are within ``line`` of each other and
    farther from any other, both walks end where the line's words part, so runs are cut from arrays of whole pages. Lines that
    drift into each other are walked word by word.
    """

    def run(batches):
        for table in tiles.whole_groups(batches, [page]):
            row, words_, first, last = tiles.line_runs(tiles.group_codes(table, [page]), *(tiles.array(table, c) for c in ("ordinal", "left", "right", "top")), tiles.array(table, "matched"), cutoff, line)
            ends = {"left": table["left"].take(pa.array(first)), "right": table["right"].take(pa.array(last))}
            out = table.select([page, "ordinal"]).take(pa.array(row))
            for name, column in ends.items():
                out = out.append_column(name, column)
            yield from out.append_column("words", pa.array(words_)).to_batches(max_chunksize=50_000)

    rows = words.select(F.col(page).cast("long").alias(page), F.col("ordinal").cast("long").alias("ordinal"), *(F.col(c).cast("double").alias(c) for c in ("left", "right", "top")), F.coalesce("matched", F.lit(False)).alias("matched"))
    return rows.repartition(page).sortWithinPartitions(page).mapInArrow(run, f"{page} long, ordinal long, left double, right double, words long")


def prefix_rows(flag: str, group: list[str], order: list[str]) -> Column:
    """1 for each leading row whose flag, like all before it, is set."""
    return F.min(F.col(flag).cast("int")).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def band(k: Column, n: Column, top: Column, bottom: Column) -> tuple[Column, Column]:
    """Row k of n even bands, from 0."""
    h = (bottom - top) / n
    return top + k * h, top + (k + 1) * h


def first_run(values: Column, length: int, bright: float) -> Column:
    """The first place of ``length`` values in a row above ``bright``; null where there is none."""

    def step(acc: Column, v: Column) -> Column:
        run = F.when(v > bright, acc["run"] + 1).otherwise(0)
        return F.struct((acc["i"] + 1).alias("i"), run.cast("int").alias("run"), F.when(acc["at"] >= 0, acc["at"]).when(run == length, acc["i"] - length + 1).otherwise(-1).cast("int").alias("at"))

    found = F.aggregate(values, F.struct(F.lit(0).alias("i"), F.lit(0).alias("run"), F.lit(-1).alias("at")), step)["at"]
    return F.when(found >= 0, found)


def rotated(x: Column, k: Column | int) -> Column:
    """The profile rolled by k places."""
    k = F.lit(k) if isinstance(k, int) else k
    n = F.size(x)
    k = F.pmod(k, n)
    return F.when(k == 0, x).otherwise(F.concat(F.slice(x, n - k + 1, k), F.slice(x, F.lit(1), n - k)))


def oriented(x: Column, name: str) -> Column:
    """The profile as it looks after a flip of the sheet."""
    half = rotated(x, (F.size(x) / 2).cast("int"))
    return {"same": x, "turned": half, "mirrored": F.reverse(x), "turned_mirrored": F.reverse(half)}[name]


def margin(a: Column, b: Column, real: list[str], control: list[str]) -> Column:
    """The best real flip's correlation less the best control's; null where one side has none."""
    best = lambda names: F.array_max(F.array(*(stats.correlation(a, oriented(b, n)) for n in names)))
    return best(real) - best(control)


def neighbours_in_radius(marks: DataFrame, page: str, ordinal: str, radius: float) -> DataFrame:
    """How many other marks of the page, of comparable size, are within ``radius``.

    Marks go to the tiles that they reach and are counted there by arrays, so no row is made for a pair. The counts are
    joined by a sort, for their size isn't known before and a broadcast would pass the driver.
    """
    size, reach = 4 * radius, radius * (1 + 1e-6)
    rows = marks.select(page, F.col(ordinal).alias("o"), *(F.col(c).cast("double").alias(c) for c in ("x", "y", "area")))
    rows = rows.where((F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))).dropna()
    for t, c in (("tx", "x"), ("ty", "y")):
        rows = rows.withColumn(t, F.explode(F.sequence(F.floor((F.col(c) - reach) / size), F.floor((F.col(c) + reach) / size))))
    rows = rows.withColumn("own", (F.floor(F.col("x") / size) == F.col("tx")) & (F.floor(F.col("y") / size) == F.col("ty")))
    keys = [page, "tx", "ty"]
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def count(batches):
        for table in tiles.whole_groups(batches, keys):
            x, y, area, own = (tiles.array(table, c) for c in ("x", "y", "area", "own"))
            ordinals = table["o"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
            near = tiles.near_counts(tiles.group_codes(table, keys), ordinals, x, y, area, own, radius)
            some = np.flatnonzero(own)[near > 0]
            out = table.select([page, "o"]).take(pa.array(some)).append_column("near", pa.array(near[near > 0]))
            yield from out.to_batches(max_chunksize=50_000)

    found = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(count, f"{page} {kind[page]}, o {kind['o']}, near long")
    counts = found.groupBy(page, F.col("o").alias(ordinal)).agg(F.sum("near").alias("near"))
    return marks.join(counts.hint("merge"), [page, ordinal], "left").withColumn("near", F.coalesce("near", F.lit(0).cast("long")))
