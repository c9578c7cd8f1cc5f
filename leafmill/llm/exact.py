"""Operator 8: exact deduplication by a tree-merge of sorted digest runs. DataFrame functions only.

Each row becomes (digest, row identity). The rows of a run are sorted by digest and become one row for each. Then runs
meet in rounds, ``FAN_IN`` (a power of two: so many binomial rounds at once) at a time, until one run is left: a round sends every row to its
group of runs and its slice of the digest space, so the work of a round is spread as widely as the first one's however few runs
are left. What arrives are sorted blocks, which the sort merges (a merge sort that finds runs), once a round; of equal
digests the wanted identity and the number of rows are kept. A digest counts as the same only with the same byte length
and the same second hash, at every level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RUNS, FAN_IN, SLICE_BITS = 512, 8, 12
_KEY = ["digest", "n_bytes", "check"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, digest, n_bytes, check) of the normalised whole text of each row, written to the shared folder."""
    text = common.ascii_lower(common.text_of(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select("id", F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("check"))
    return common.materialise(rows, "digests")


def merge_runs(rows: DataFrame, keep: str = "max", runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: digest, n_bytes, check, kept (id, row), group_size."""
    pick = F.max if keep == "max" else F.min
    level = rows.select((F.shiftright("row", 33) % runs).alias("run"), *_KEY, F.struct(F.col("id").isNotNull().alias("known"), "id", "row").alias("kept"), F.lit(1).cast("long").alias("group_size"))
    if keep != "max":
        level = level.withColumn("kept", F.struct(F.col("kept.id").isNull().alias("known"), "kept.id", "kept.row"))
    merge = [pick("kept").alias("kept"), F.sum("group_size").alias("group_size")]
    level = level.groupBy(*_KEY, "run").agg(*merge)
    # bits of the digest itself, so equal digests are in one slice and a slice is a range
    level = level.withColumn("slice", F.shiftright(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), 32 - SLICE_BITS))
    while runs > 1:
        runs = -(-runs // fan_in)
        # grouped by more than what they are sent by: no second exchange, and one sort by digest
        level = level.withColumn("run", F.floor(F.col("run") / fan_in)).repartition("run", "slice").groupBy(*_KEY, "run", "slice").agg(*merge)
    return level.drop("run", "slice")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of equal texts the row
    with the largest id stays (``keep="min"``: the smallest); a null id only where no other has the text. Of
    repeated rows with that id exactly one stays. Columns other than the id and the text are not read. What is
    shuffled is 60 bytes a row, of which map-side aggregation leaves one a run for each group of copies; the
    join back lets Spark split a hot digest, as both sides are plain exchanges over stored tables.
    """
    rows = digests(docs, id_col, text_col)
    groups = common.materialise(merge_runs(rows, keep), "digest-groups")
    out = rows.join(groups, _KEY)
    return out.select(F.col("id").alias(id_col), F.col("kept.id").alias("keep_id"), "group_size", (F.col("row") == F.col("kept.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
