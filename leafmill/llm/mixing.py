"""Operator 3: mixing sources to target weights by pivotal dependent rounding.

A document of a source with rate r = target / size is taken floor(r) times and once more with probability
r - floor(r). The fractional parts are rounded dependently: two documents exchange probability, in inverse
proportion to their sizes, until one of them is 0 or 1, so the expected and the total number of words
stay what they were. Chunks of a source round on their own and leave one fractional document
at most; these residuals meet in a reduction tree of fixed fan-in until each source has one.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Documents rounded in one task, and residuals that meet at one node of the tree.
CHUNK, FAN_IN = 4_000, 256
WEIGHTS = (5.0, 2.0, 1.0)
#: Equal rows that one task writes out again.
PART = 100_000


def source_targets(sizes: DataFrame, source_col: str, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """A row per source: source, source_size, n_docs, source_no, target. ``sizes``: source, size and how many rows (n) have it.

    Weights repeat over the sources by code point, null last. A target is min(cap * size, level * weight);
    the level at which the targets sum up to share * all sizes is found from the sources sorted by the level
    at which they reach their cap. These windows run over one row a source, not over documents.
    """
    w = Window.orderBy(F.col(source_col).isNull(), F.col(source_col))
    per = sizes.groupBy(source_col).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")).withColumn("source_no", F.row_number().over(w) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("top", F.lit(cap) * F.col("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("top") / F.col("weight"), "source_no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("want", F.least(F.lit(share), F.lit(cap)) * F.sum("source_size").over(everything).cast("double"))
    # if the sources before this one are at their cap, the rest shares what is left by weight
    per = per.withColumn("level", (F.col("want") - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    # of the levels that keep this source within its cap, the first in that order, which is the highest, holds
    per = per.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("top"), F.col("level"))).over(everything))
    target = F.least(F.col("top"), F.coalesce(F.col("level") * F.col("weight"), F.col("top")))
    return per.select(source_col, "source_size", "n_docs", "source_no", target.alias("target"))


def _unit(*parts) -> float:
    """A number in [0, 1) that depends on the parts alone."""
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), digest_size=7).digest(), "big") / 2**56


def pivot(sizes: list[int], chances: list[float], seeds: list) -> tuple[list[float], int | None]:
    """Round all chances but one; also gives the place of the one that may stay fractional."""
    out, at = list(chances), None
    for j, size in enumerate(sizes):
        if not 0.0 < out[j] < 1.0:
            continue
        if size <= 0:
            out[j] = float(_unit("empty", seeds[j]) < out[j])
            continue
        if at is None:
            at = j
            continue
        i, a, b = at, out[at] * sizes[at], out[j] * size
        up, down = min(sizes[i] - a, b), min(a, size - b)  # words that can go from j to i, and from i to j
        if _unit("pair", seeds[i], seeds[j]) * (up + down) < down:
            a, b, full_i, full_j = a + up, b - up, up == sizes[i] - a, up == b
        else:
            a, b, full_i, full_j = a - down, b + down, down == a, down == size - b
        if full_j:
            out[j], out[i] = float(round(b / size)), min(1.0, max(0.0, a / sizes[i]))
            at = None if full_i else i
        else:
            out[i], out[j] = float(round(a / sizes[i])), min(1.0, max(0.0, b / size))
            at = j
        if full_i and full_j:
            out[i] = float(round(a / sizes[i]))
    return out, at if at is not None and 0.0 < out[at] < 1.0 else None


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 0, chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: id, source, size (words), source_size, target, copies, taken.

    A null text has size 0. Sources are compared by code point; null is a source of its own and comes last.
    Documents of size 0 are taken by chance alone and take no words. Repeated rows are rounded as rows of
    their own; a null id is an id like any other. Rates come from whole counts, so reruns agree. A source whose
    documents are all empty has target 0. Rows with one (id, source, size) are counted before they are shuffled:
    n of them are rounded among themselves, which leaves one that is fractional. Only these
    are shuffled, in chunks that hold ``chunk`` of them on average whatever the source, so neither a source with a third
    of all rows nor an id with as many is in one task. An empty table gives an empty result; other columns aren't read.
    """
    common.ship(docs.sparkSession)
    words = F.regexp_count(common.text_of(text_col), F.lit(common.WORD)).cast("long")
    sizes = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words.alias("size"))
    sizes = common.materialise(sizes.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    per = common.materialise(source_targets(sizes, "source", weights, share, cap), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sizes.join(per.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / chunk))
    rows = rows.withColumn("whole", F.least(F.floor(rate), F.lit(int(cap))).cast("long")).withColumn("chance", rate - F.col("whole"))
    rows = rows.withColumn("ones", F.least(F.floor(F.col("n") * F.col("chance")), F.col("n") - 1).cast("long")).withColumn("chance", F.least(F.lit(1.0), F.col("n") * F.col("chance") - F.col("ones")))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.col("size")), parts)).drop("n_docs")
    schema = "id " + sizes.schema["id"].dataType.simpleString() + ", source string, size long, n long, source_size long, source_no int, target double, whole long, chance double, ones long, chunk long, open boolean"
    names = [x.split()[0] for x in schema.split(", ")]

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = [str(x) for x in pdf["id"].tolist()]
        # large documents first: what is left over at the end is small
        pdf = pdf.assign(_key=[_unit(seed, i, s) for i, s in zip(ids, pdf["size"], strict=True)]).sort_values(["size", "_key"], ascending=[False, True], kind="stable")
        seeds = [f"{seed}/{i}/{s}/{n}" for n, (i, s) in enumerate(zip(pdf["id"], pdf["size"], strict=True))]
        chances, at = pivot(pdf["size"].tolist(), pdf["chance"].tolist(), seeds)
        return pdf.assign(chance=chances, open=[n == at for n in range(len(pdf))])[names]

    level = common.materialise(rows.groupBy("source_no", "chunk").applyInPandas(settle, schema), "mix-0")
    done = level.where(~F.col("open"))
    width = level.agg(F.max("chunk")).first()[0] or 0
    while width:
        width //= fan_in
        level = level.where("open").withColumn("chunk", F.floor(F.col("chunk") / fan_in)).groupBy("source_no", "chunk").applyInPandas(settle, schema)
        level = common.materialise(level, "mix-tree")
        done = done.unionByName(level.where(~F.col("open")))
    last = level.where("open").withColumn("chance", (F.col("chance") * 2**20 > F.pmod(F.xxhash64(F.lit(seed), "id", "size"), F.lit(2**20))).cast("double"))
    # a row for each counted row again: the rounded one, those taken once more, the rest; many equal ones in parts
    out = done.unionByName(last).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {PART}"))))
    out = out.repartition("id", "size", "part").withColumn("k", F.explode(F.sequence(F.col("part") * PART, F.least(F.col("n"), (F.col("part") + 1) * PART) - 1)))
    copies = F.col("whole") + F.when(F.col("k") == 0, F.round("chance").cast("long")).otherwise((F.col("k") <= F.col("ones")).cast("long"))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` as often as ``mix_sources`` takes them, with its columns; reruns give the same rows.

    Rows are told apart by their id and a hash of all columns, so the order of files doesn't matter; rows repeated in full
    stand as one for all that is taken of them. Null ids and texts are kept or not like others. Texts move once.
    """
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.hex(F.xxhash64(*docs.columns)))
    rows = docs.withColumn("__lm_key", key)
    taken = mix_sources(rows, id_col="__lm_key", **how).groupBy("__lm_key").agg(F.sum("copies").alias("__lm_copies")).where("__lm_copies > 0")
    once = rows.withColumn("__lm_rank", F.row_number().over(Window.partitionBy("__lm_key").orderBy("__lm_key"))).where("__lm_rank = 1")
    return once.join(taken, "__lm_key").withColumn("__lm_copy", F.explode(F.sequence(F.lit(1).cast("long"), "__lm_copies"))).select(*docs.columns)
