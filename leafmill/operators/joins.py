"""Joins: adjacency, text snap, boxes, fuzzy labels, greedy one-to-one matching."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from . import tiles


def adjacent(pages: DataFrame, file: str, page: str, carry: list[str]) -> DataFrame:
    """Pairs of a page and the page with the next number; a gap gives no pair, as lead() would."""
    nxt = pages.select(file, (F.col(page) - 1).alias(page), *(F.col(c).alias(f"next_{c}") for c in carry))
    return pages.select(file, page, *carry).join(nxt, [file, page])


def first_later(left: DataFrame, right: DataFrame, file: str, page: str, beyond: int) -> DataFrame:
    """For each left row the first page of ``right`` in its file that is more than ``beyond`` later.

    One window over both sides, so no pairs are made.
    """
    rows = left.select(file, page, F.lit(True).alias("_want")).unionByName(right.select(file, (F.col(page) - beyond).alias(page), F.col(page).alias("later"), F.lit(False).alias("_want")), allowMissingColumns=True)
    w = Window.partitionBy(file).orderBy(F.col(page)).rangeBetween(1, Window.unboundedFollowing)
    return rows.withColumn("later", F.min("later").over(w)).where("_want").select(file, page, "later")


def mutual_unique(left: DataFrame, right: DataFrame, on: str, left_id: str, right_id: str, threshold: float = 0.3, grid: float = 0.1) -> DataFrame:
    """(on, left_id, right_id, iou) of pairs of boxes on one page with IoU of ``threshold`` at least where neither side has another such pair.

    Each box is judged once, in the tile of its upper left corner, where all boxes come that may overlap it enough. It
    counts partners up to two by arrays, so no row is made for a pair. ``threshold`` is above 0 and at most 1.
    """
    size, far, near = 4 * grid, (1 - threshold) / threshold * (1 + 1e-6) + 1e-6, (1 - threshold) * (1 + 1e-6) + 1e-6
    sides = [df.select(on, F.lit(s).alias("side"), F.col(i).alias("id"), *(F.col(f"{b}.{c}").cast("double").alias(c) for c in "ltrb")) for s, (df, i, b) in enumerate(((left, left_id, "box"), (right, right_id, "box")))]
    rows = sides[0].unionByName(sides[1]).where((F.col("r") > F.col("l")) & (F.col("b") > F.col("t")) & (F.abs("l") + F.abs("t") + F.abs("r") + F.abs("b") < float("inf"))).where(F.col(on).isNotNull())
    for t, lo, hi in (("tx", "l", "r"), ("ty", "t", "b")):
        long = F.col(hi) - F.col(lo)
        rows = rows.withColumn(t, F.explode(F.sequence(F.floor((F.col(lo) - far * long) / size), F.floor((F.col(lo) + near * long) / size))))
    rows = rows.withColumn("own", (F.floor(F.col("l") / size) == F.col("tx")) & (F.floor(F.col("t") / size) == F.col("ty")))
    keys = [on, "tx", "ty"]
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def judge(batches):
        for table in tiles.whole_groups(batches, keys):
            side, own, *box = (tiles.array(table, c) for c in ("side", "own", *"ltrb"))
            row, n, partner, iou = tiles.lone_partners(tiles.group_codes(table, keys), side, own, box, threshold)
            out = table.select([on, "side", "id"]).take(pa.array(row)).append_column("n", pa.array(n)).append_column("partner", table["id"].take(pa.array(partner))).append_column("iou", pa.array(iou))
            yield from out.to_batches(max_chunksize=50_000)

    found = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(judge, f"{on} {kind[on]}, side int, id {kind['id']}, n long, partner {kind['id']}, iou double")
    one = found.groupBy(on, "side", "id").agg(F.sum("n").alias("n"), F.first("partner").alias("partner"), F.first("iou").alias("iou")).where("n = 1")
    front = F.col("side") == 0
    pairs = one.groupBy(on, F.when(front, F.col("id")).otherwise(F.col("partner")).alias(left_id), F.when(front, F.col("partner")).otherwise(F.col("id")).alias(right_id))
    return pairs.agg(F.count(F.lit(1)).alias("sides"), F.first("iou").alias("iou")).where("sides = 2").drop("sides")


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """F16: matching blocks' share of both texts."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def may_reach(a: Column, b: Column, least: float) -> Column:
    """Lengths alone bound the ratio: 2 * shorter / (sum); what fails needs no comparison."""
    la, lb = F.length(a), F.length(b)
    return 2 * F.least(la, lb) >= least * (la + lb)


def fuzzy_labels(labels: DataFrame, specs: DataFrame, label: str, label_id: str, least: float = 0.80) -> DataFrame:
    """The one spec all of whose tokens have a like token in the label; two such specs give none.

    Distinct tokens are compared once, behind a length test and a shared-letter test; the label's tokens then join the
    verdicts. ``specs`` (spec, tokens array) is a fixed vocabulary; Spark decides by its size whether to broadcast it.
    """
    words = labels.select(label_id, F.explode(F.array_distinct(S.query_tokens(label))).alias("word")).where(F.length("word") >= 3)
    spec_words = specs.select("spec", F.explode("tokens").alias("token"))
    tokens = spec_words.select("token").distinct()
    pairs = words.select("word").distinct().join(tokens, may_reach(F.col("word"), F.col("token"), least))
    alike = pairs.where(ratio("word", "token") >= least).select("word", "token")
    hits = words.join(alike, "word").join(spec_words, "token").groupBy(label_id, "spec").agg(F.countDistinct("token").alias("got"))
    full = hits.join(specs.select("spec", F.size(F.array_distinct("tokens")).alias("need")), "spec").where("got = need")
    one = full.groupBy(label_id).agg(F.count(F.lit(1)).alias("n"), F.min("spec").alias("spec")).where("n = 1").select(label_id, "spec")
    return labels.join(one, label_id, "left")


def greedy_pairs(left: list[dict], right: list[dict], reach: float, area_ratio: float) -> list[tuple[int, int, float]]:
    """Largest first, each takes its nearest free partner of comparable area within reach."""
    orders = [sorted(range(len(s)), key=lambda i, s=s: s[i]["ordinal"]) for s in (left, right)]
    sides = [{c: np.array([s[i][c] for i in o], float) for c in ("x", "y", "area")} for s, o in zip((left, right), orders, strict=True)]
    return [(orders[0][i], orders[1][j], d) for i, j, d in tiles.greedy(*sides, reach, area_ratio)]


def greedy_match(marks: DataFrame, pair: str, reach: float, area_ratio: float = 0.5) -> DataFrame:
    """One-to-one matches within each pair of pages. ``marks``: pair, side (0 or 1), ordinal, x, y, area.

    Order decides, so a page pair's marks meet in one task, as arrays. A mark without place or area has no partner.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [pdf[pdf["side"] == s].dropna(subset=["x", "y", "area"]).sort_values("ordinal", kind="stable") for s in (0, 1)]
        found = tiles.greedy(*({c: s[c].to_numpy(float) for c in ("x", "y", "area")} for s in sides), reach, area_ratio)
        i, j, d = ([m[k] for m in found] for k in range(3))
        return pd.DataFrame({pair: pdf[pair].iloc[0], "left_ordinal": sides[0]["ordinal"].to_numpy()[i], "right_ordinal": sides[1]["ordinal"].to_numpy()[j], "distance": d}) if found else pd.DataFrame(columns=[pair, "left_ordinal", "right_ordinal", "distance"])

    return marks.select(pair, "side", "ordinal", "x", "y", "area").groupBy(pair).applyInPandas(run, f"{pair} long, left_ordinal long, right_ordinal long, distance double")
