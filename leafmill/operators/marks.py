"""Do two pages carry the same marks, seen from opposite sides of one sheet?

A plan of joins: marks meet by cells of a grid, whatever the number of page pairs; outlines are compared as arrays. Only
the choice of partners, where each depends on those before it, is a grouped function over one page pair and flip.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import windows

# What a flip does to a page's two axes and to an outline read by angle, the views that no second side
# shows, and frozen tolerances in page fractions.
FLIPS = {"flip_v": (False, True, "mirrored"), "flip_h": (True, False, "turned_mirrored")}
CONTROLS = ("same", "turned")
HARMONICS, AREA_RATIO, REACH, OFFSET, CLEAR, LEAST = 2, 1.6, 0.02, 0.06, 0.30, 2


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def tear(outline: pd.Series) -> pd.Series:
    """An outline without mean, centre offset and ellipticity: what a fit of its slowest waves leaves."""

    def left(x):
        if x is None or len(x) < 2 * HARMONICS + 2:
            return None
        x = np.asarray(x, float)
        turn = np.arange(len(x))[:, None] * np.arange(HARMONICS + 1) * (2 * np.pi / len(x))
        waves = np.hstack([np.cos(turn), np.sin(turn[:, 1:])])
        return x - waves @ np.linalg.lstsq(waves, x, rcond=None)[0]

    return outline.map(left)


def comparable(a: Column, b: Column) -> Column:
    return (F.least(a, b) > 0) & (F.greatest(a, b) <= AREA_RATIO * F.least(a, b))


def _around(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Each row in its own cell and the eight next to it: what is within ``size`` of it is in one of them."""
    for name, c in (("cx", x), ("cy", y)):
        own = F.floor(F.col(c) / size)
        df = df.withColumn(name, F.explode(F.sequence(own - 1, own + 1)))
    return df


def _flipped(marks: DataFrame) -> DataFrame:
    """A row a mark and flip: where the mark is on the other side of the sheet."""
    views = F.array(*(F.struct(F.lit(n).alias("flip"), F.when(F.lit(mx), 1 - F.col("x")).otherwise(F.col("x")).alias("fx"), F.when(F.lit(my), 1 - F.col("y")).otherwise(F.col("y")).alias("fy")) for n, (mx, my, _) in FLIPS.items()))
    return marks.withColumn("view", F.explode(views)).select("*", "view.*").drop("view")


def self_alike(marks: DataFrame) -> DataFrame:
    """(pair, side, mark, flip): marks that a flip lays on another mark of their own page, so that agreement tells nothing."""
    others = marks.select("pair", "side", F.col("mark").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("area").alias("oa"), F.floor(F.col("x") / REACH).alias("cx"), F.floor(F.col("y") / REACH).alias("cy"))
    met = _around(_flipped(marks), "fx", "fy", REACH).join(others, ["pair", "side", "cx", "cy"])
    return met.where((F.col("mark") != F.col("other")) & comparable(F.col("area"), F.col("oa")) & (F.hypot(F.col("fx") - F.col("ox"), F.col("fy") - F.col("oy")) < REACH)).select("pair", "side", "mark", "flip").distinct()


def partners(marks: DataFrame) -> DataFrame:
    """(pair, flip, mark, back): the one-to-one choice of partners under the offset of the two scans that gives most."""
    told = _flipped(marks).join(self_alike(marks), ["pair", "side", "mark", "flip"], "left_anti")
    far = OFFSET + REACH
    front = marks.where("side = 0").select("pair", "mark", "x", "y", "area", F.floor(F.col("x") / far).alias("cx"), F.floor(F.col("y") / far).alias("cy"))
    front = front.join(told.where("side = 0").select("pair", "mark", "flip"), ["pair", "mark"])
    back = _around(told.where("side = 1").select("pair", "flip", F.col("mark").alias("back"), F.col("area").alias("back_area"), "fx", "fy"), "fx", "fy", far)
    near = front.join(back, ["pair", "flip", "cx", "cy"]).where(comparable(F.col("area"), F.col("back_area")))
    near = near.select("pair", "flip", "mark", "back", "back_area", (F.col("x") - F.col("fx")).alias("dx"), (F.col("y") - F.col("fy")).alias("dy"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        gap = pdf[["dx", "dy"]].to_numpy()
        within = gap[(np.abs(gap) <= OFFSET).all(axis=1)]
        offsets = np.unique(np.vstack([np.zeros((1, 2)), within.round(5)]), axis=0)
        best = pdf.iloc[:0]
        for offset in offsets[np.argsort(np.hypot(*offsets.T), kind="stable")]:  # of equal ones the smallest offset
            rows = pdf.assign(miss=np.hypot(*(gap - offset).T))
            rows = rows[rows["miss"] < REACH].sort_values(["back_area", "back", "miss", "mark"], ascending=[False, True, True, True])
            taken, used, keep = set(), set(), []
            for mark, other in zip(rows["mark"], rows["back"], strict=True):
                keep.append(mark not in taken and other not in used)
                if keep[-1]:
                    taken.add(mark)
                    used.add(other)
            best = rows[keep] if sum(keep) > len(best) else best
        return best[["pair", "flip", "mark", "back"]]

    kind = {f.name: f.dataType.simpleString() for f in marks.schema.fields}
    return near.groupBy("pair", "flip").applyInPandas(choose, f"pair {kind['pair']}, flip string, mark {kind['mark']}, back {kind['mark']}")


def clear_of_controls(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """``pairs`` with ``margin``: how far the flip's correlation of two outlines is above the best view that no sheet shows."""
    sides = [marks.where(F.col("side") == s).select("pair", F.col("mark").alias(m), F.col("tear").alias(f"tear_{s}")) for s, m in ((0, "mark"), (1, "back"))]
    both = pairs.join(sides[0], ["pair", "mark"]).join(sides[1], ["pair", "back"])
    margin = F.lit(None).cast("double")
    for name, (_, _, view) in FLIPS.items():
        margin = F.when(F.col("flip") == name, windows.margin(F.col("tear_0"), F.col("tear_1"), [view], list(CONTROLS))).otherwise(margin)
    fits = F.size("tear_0") == F.size("tear_1")
    return both.withColumn("margin", F.when(fits, margin)).drop("tear_0", "tear_1")


def compare(marks: DataFrame, pair: str = "pair") -> DataFrame:
    """A verdict per pair of pages: pair, confirmed, transform, agreeing, compared, ambiguous, reason.

    ``marks``: pair, side (0 front, 1 back), x, y, area, outline. A pair is confirmed by LEAST marks that clear the
    margin under one flip; everything else abstains, with a code: ``unmarked`` or ``single`` page, ``self_alike`` marks only,
    ``unpaired``, ``below_margin``. Outlines that are null, constant or of unlike length clear nothing.
    """
    rows = marks.select(F.col(pair).alias("pair"), F.col("side").cast("int").alias("side"), "x", "y", "area", tear("outline").alias("tear"))
    rows = rows.withColumn("mark", F.xxhash64("side", "x", "y", "area"))
    found = clear_of_controls(partners(rows), rows)
    per = found.groupBy("pair", "flip").agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("margin") >= CLEAR).alias("agreeing"))
    rank = F.struct("agreeing", "compared", (F.col("flip") == next(iter(FLIPS))).cast("int").alias("first"), "flip")
    best = per.groupBy("pair").agg(F.max(rank).alias("best"))
    aside = self_alike(rows).groupBy("pair", "flip").agg(F.count(F.lit(1)).alias("n")).groupBy("pair").agg(F.max("n").alias("ambiguous"))
    pages = rows.groupBy("pair").agg(F.least(F.count_if(F.col("side") == 0), F.count_if(F.col("side") == 1)).alias("fewest"))
    out = pages.join(best, "pair", "left").join(aside, "pair", "left")
    agreeing, compared, ambiguous = (F.coalesce(c, F.lit(0).cast("long")) for c in (F.col("best.agreeing"), F.col("best.compared"), F.col("ambiguous")))
    enough = F.col("fewest") >= LEAST
    confirmed = enough & (agreeing >= LEAST)
    reason = F.when(F.col("fewest") == 0, "unmarked").when(~enough, "single").when(confirmed, "agree").when(compared > 0, "below_margin").when(ambiguous > 0, "self_alike").otherwise("unpaired")
    return out.select(F.col("pair").alias(pair), confirmed.alias("confirmed"), F.when(enough, F.col("best.flip")).alias("transform"), F.when(enough, agreeing).otherwise(0).alias("agreeing"), F.when(enough, compared).otherwise(F.col("fewest")).alias("compared"), ambiguous.alias("ambiguous"), reason.alias("reason"))


def confirmed_pairs(verdicts: DataFrame, pages: DataFrame) -> DataFrame:
    """Pairs for grouping: confirmed, of one file and of adjacent pages. ``pages``: pair, file, page, back_file, back_page."""
    near = (F.col("file") == F.col("back_file")) & (F.abs(F.col("page") - F.col("back_page")) == 1)
    return verdicts.where("confirmed").join(pages, "pair").where(near).select("file", "page", "back_page")
