"""Queries that draw samples, splits and pairs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import sampling
from ..sources.scans import table
from .catalogue import register


@register(
    "stratified_sample",
    """
    SELECT doc_id, lang, draw FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(concat('7:', doc_id)), doc_id) AS draw FROM documents) WHERE draw <= 25
    """,
)
def stratified_sample(spark, sf):
    """A fixed number a stratum, by hash."""
    return sampling.stratified(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 25, seed=7).withColumn("draw", F.col("draw").cast("long"))


@register(
    "quota_round_robin",
    """
    WITH q AS (SELECT doc_id, source, doc_id % 50 = 0 AS forced, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN doc_id % 50 = 0 THEN 0 ELSE 1 END, md5(concat('3:', doc_id)), doc_id) AS place FROM documents),
    k AS (SELECT doc_id, source, forced FROM q WHERE forced OR place <= 5),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn FROM k),
    g AS (SELECT source FROM (SELECT DISTINCT source FROM documents) ORDER BY md5(concat('11:', source)), source LIMIT 6),
    o AS (SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(concat('12:', doc_id)), doc_id) AS n FROM documents WHERE source IN (SELECT source FROM g)) WHERE n = 1)
    SELECT r.doc_id, r.source, r.forced, r.turn, row_number() OVER (ORDER BY CASE WHEN r.source = 'src3' THEN 1 ELSE 0 END + turn * 2, r.source) AS place, o.doc_id IS NOT NULL AS alone,
           CASE WHEN r.forced OR ('0x' || substr(md5(concat('0:', r.doc_id)), 1, 8))::BIGINT % 3 <> 0 THEN 'development' ELSE 'held_out' END AS half
    FROM r LEFT JOIN o ON o.doc_id = r.doc_id
    """,
)
def quota_round_robin(spark, sf):
    """Quotas with forced rows, dealt by turns with one bucket last, one per group, and a split."""
    docs = table(spark, sf, "documents").select("doc_id", "source")
    kept = sampling.quota(docs, "source", "doc_id", F.col("doc_id") % 50 == 0, 5, seed=3).drop("place").withColumn("forced", F.col("doc_id") % 50 == 0)
    turns = sampling.round_robin(kept, "source", [F.col("doc_id")], last="src3")
    # the sheet's order runs over the drawn rows: a few for each bucket
    placed = turns.withColumn("place", F.row_number().over(Window.orderBy(F.col("turn") * 2 + F.col("bucket_rank"), "source")))
    alone = sampling.one_per(docs, "source", "doc_id", 6, seed=11).select("doc_id", F.lit(True).alias("alone"))
    out = sampling.split(placed.join(alone, "doc_id", "left"), "doc_id", F.col("forced"))
    return out.select("doc_id", "source", "forced", F.col("turn").cast("long").alias("turn"), F.col("place").cast("long").alias("place"), F.coalesce("alone", F.lit(False)).alias("alone"), "half")


@register(
    "negative_pairs",
    """
    WITH c AS (SELECT conv_id, turn, role, conv_id // 4 AS rec FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) >= 2)),
    s AS (SELECT 'same_file' AS kind, a.conv_id AS f1, a.turn AS p1, b.conv_id AS f2, b.turn AS p2 FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn > a.turn + 1),
    t AS (SELECT 'same_record' AS kind, a.conv_id AS f1, a.turn AS p1, b.conv_id AS f2, b.turn AS p2 FROM c a JOIN c b ON a.rec = b.rec AND a.conv_id < b.conv_id AND a.turn = 0 AND b.turn = 0),
    u AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5(concat_ws(':', '5', f1, p1, f2, p2)), f1, p1, f2, p2) AS n FROM (SELECT * FROM s UNION ALL SELECT * FROM t))
    SELECT kind, f1, p1, f2, p2 FROM u WHERE n <= 50
    """,
)
def negative_pairs(spark, sf):
    """Pairs that can't be one sheet: not adjacent in a file, or of two files of a record; drawn by hash."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    two = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    rows = rows.join(two, "conv_id", "left_semi").withColumn("rec", F.floor(F.col("conv_id") / 4))
    a, b = rows.select(F.col("conv_id").alias("f1"), F.col("turn").alias("p1"), F.col("rec").alias("r1")), rows.select(F.col("conv_id").alias("f2"), F.col("turn").alias("p2"), F.col("rec").alias("r2"))
    same = a.join(b, (F.col("f1") == F.col("f2")) & (F.col("p2") > F.col("p1") + 1)).withColumn("kind", F.lit("same_file"))
    first_a, first_b = a.where("p1 = 0"), b.where("p2 = 0")
    record = first_a.join(first_b, (F.col("r1") == F.col("r2")) & (F.col("f1") < F.col("f2"))).withColumn("kind", F.lit("same_record"))
    pairs = same.unionByName(record)
    w = Window.partitionBy("kind").orderBy(sampling.draw_key(5, "f1", "p1", "f2", "p2"), "f1", "p1", "f2", "p2")
    return pairs.withColumn("n", F.row_number().over(w)).where("n <= 50").select("kind", "f1", "p1", "f2", "p2")
