"""Queries that place fields by templates, list attachments with their evidence, and compare arms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import export, geometry, overlays, sampling, stats
from ..sources.scans import table
from .catalogue import register


@register(
    "template_regions",
    """
    WITH p AS (SELECT p_partkey AS k, p_size AS n, p_partkey % 4 AS kind, p_size % 5 AS i, 1 + p_partkey % 3 AS rows FROM part),
    f AS (SELECT k, CASE kind WHEN 0 THEN 'depth' WHEN 1 THEN concat('casing[', i, '].size') WHEN 2 THEN concat('tubing[', i, '].size') ELSE 'nothing' END AS field,
                 CASE WHEN kind = 0 THEN 'template' WHEN kind IN (1, 2) THEN 'template_row' END AS source,
                 -- casing has a header row and three measured ones, then bands; tubing has bands alone
                 CASE WHEN kind = 0 THEN 0.2 WHEN kind = 1 AND i < 3 THEN 0.35 + 0.05 * (i + 1) WHEN kind = 1 THEN 0.3 + 0.4 * i / greatest(rows, i + 1) WHEN kind = 2 THEN 0.5 + 0.3 * i / greatest(rows, i + 1) END AS top, n FROM p)
    SELECT k, field, CASE WHEN top IS NOT NULL AND 2 * (top - 0.1) < 1 THEN source END AS source, CASE WHEN 2 * (top - 0.1) < 1 THEN round(greatest(0.0, 2 * (top - 0.1)), 9) END AS t FROM f
    """,
)
def template_regions(spark, sf):
    """A field's box by its template, its measured row or an even band, put onto the page and cut to it."""
    k, i = F.col("p_partkey"), (F.col("p_size") % 5).cast("string")
    kind = k % 4
    field = F.when(kind == 0, "depth").when(kind == 1, F.concat(F.lit("casing["), i, F.lit("].size"))).when(kind == 2, F.concat(F.lit("tubing["), i, F.lit("].size"))).otherwise("nothing")
    box = lambda t, b: S.box(*map(F.lit, (0.1, t, 0.4, b)))
    measured = F.array(*(box(0.35 + 0.05 * r, 0.4 + 0.05 * r) for r in range(4)))
    rows = table(spark, sf, "part").select(
        k.alias("k"), field.alias("field"), F.create_map(F.lit("depth"), box(0.2, 0.25)).alias("fields"), F.create_map(F.lit("casing"), measured).alias("rows"), F.create_map(F.lit("casing"), F.lit(1)).alias("heads"),
        F.create_map(F.lit("casing"), box(0.3, 0.7), F.lit("tubing"), box(0.5, 0.8)).alias("blocks"), F.create_map(F.lit("casing"), (1 + k % 3).cast("int"), F.lit("tubing"), (1 + k % 3).cast("int")).alias("counts"),
        # the page onto the frame at half its size; the way back doubles
        F.struct(*(F.lit(v).alias(c) for c, v in zip("abcdef", (0.5, 0.0, 0.0, 0.0, 0.5, 0.1), strict=True))).alias("m"),
    )
    spot = overlays.placed(*map(F.col, ("field", "fields", "rows", "heads", "blocks", "counts")))
    out = rows.withColumn("spot", spot).withColumn("back", geometry.inverse("m"))
    page = S.clip(geometry.box_through("back", F.col("spot.box")))
    out = out.withColumn("page", page)
    return out.select("k", "field", F.when(F.col("page").isNotNull(), F.col("spot.source")).alias("source"), F.round("page.t", 9).alias("t"))


@register(
    "attachment_evidence",
    """
    WITH c AS (SELECT conv_id AS r, turn AS page, min(turn) OVER (PARTITION BY conv_id) AS face, conv_id % 3 AS f FROM (SELECT DISTINCT conv_id, turn FROM conversations)),
    a AS (SELECT *, CASE WHEN page % 3 = 1 THEN ['lease_name', 'well_number'] WHEN page % 3 = 2 THEN ['received_stamps', 'lease_name'] ELSE [] END AS fields FROM c WHERE page <> face)
    SELECT r AS record_id, f AS file_index, page, face, array_to_string(fields, ', ') AS joined_on,
           CASE page % 3 WHEN 1 THEN concat('lease_name: p', face, ' <- ', repeat('box ', 10), ' | p', page, ' <- field ', page, '; well_number: p', face, ' <- ? | p', page, ' <- ?')
                         WHEN 2 THEN concat('lease_name: p', face, ' <- ', repeat('box ', 10), ' | p', page, ' <- field ', page) ELSE '' END AS boxes,
           concat('p', face, ': Austin 1-2-60; Midland 3-4-61   /   p', page, CASE WHEN page % 2 = 0 THEN ': none' ELSE concat(': Austin 1-', page, '-60') END) AS received_stamps
    FROM a
    """,
)
def attachment_evidence(spark, sf):
    """Pages attached to a face with the fields that agreed, where each was printed, and the stamps of both."""
    pages = table(spark, sf, "conversations").select(F.col("conv_id").alias("record_id"), (F.col("conv_id") % 3).alias("file_index"), F.col("turn").alias("page")).distinct()
    kind = F.col("page") % 3
    fields = F.when(kind == 1, F.array(F.lit("lease_name"), F.lit("well_number"))).when(kind == 2, F.array(F.lit("received_stamps"), F.lit("lease_name")))
    docs = pages.groupBy("record_id", "file_index").agg(F.min("page").alias("face"), F.collect_list("page").alias("pages"), F.map_from_entries(F.collect_list(F.when(fields.isNotNull(), F.struct("page", fields.alias("fields"))))).alias("evidence"))
    found = lambda text: F.create_map(F.lit("lease_name"), text)
    stamp = lambda office, date: F.struct(F.lit(office).alias("office"), date.alias("date"))
    one = F.array(stamp("Austin", F.lit("1-2-60")), stamp("Midland", F.lit("3-4-61")))
    two = F.when(F.col("page") % 2 == 1, F.array(stamp("Austin", F.concat(F.lit("1-"), F.col("page").cast("string"), F.lit("-60")))))
    boxes = export.evidence_text(F.col("fields"), F.col("face"), F.col("page"), found(F.repeat(F.lit("box "), 12)), found(F.concat(F.lit("field "), F.col("page").cast("string"))))
    stamps = F.concat_ws("   /   ", export.stamps_text(F.col("face"), one), export.stamps_text(F.col("page"), two))
    return export.attachments(docs).select("record_id", "file_index", "page", "face", F.array_join("fields", ", ").alias("joined_on"), boxes.alias("boxes"), stamps.alias("received_stamps"))


@register(
    "confidence_accuracy",
    """
    WITH r AS (SELECT CASE doc_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE '' END AS confidence, quality = CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AND toxic = 0 AS hit FROM documents JOIN labels USING (doc_id))
    SELECT confidence, count(*) FILTER (WHERE hit) AS hits, count(*) AS n, count(*) FILTER (WHERE hit) / count(*) AS accuracy FROM r WHERE confidence <> '' GROUP BY 1
    """,
)
def confidence_accuracy(spark, sf):
    """Hits among the rows of each stated confidence; rows that state none are left out."""
    name = F.when(F.col("doc_id") % 4 == 0, "high").when(F.col("doc_id") % 4 == 1, "medium").when(F.col("doc_id") % 4 == 2, "low").otherwise("")
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumn("confidence", name)
    return stats.accuracy_by(rows, "confidence", (F.col("quality") == (F.col("n_chars") > 400).cast("int")) & (F.col("toxic") == 0))


@register(
    "comparable_items",
    """
    WITH a AS (SELECT DISTINCT l_orderkey AS item, l_returnflag AS arm FROM lineitem)
    SELECT item FROM a WHERE item IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY item HAVING count(*) = (SELECT count(DISTINCT arm) FROM a)
    """,
)
def comparable_items(spark, sf):
    """Items with a truth for which every arm has an answer."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("item"), F.col("l_returnflag").alias("arm"))
    truth = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("item"))
    return stats.comparable(lines, "item", "arm", truth)


@register(
    "negative_records",
    """
    WITH d AS (SELECT c_custkey AS k, CASE WHEN c_nationkey % 5 <> 0 THEN c_mktsegment ELSE '' END AS lease, row_number() OVER (ORDER BY md5(concat('5:', c_custkey)), c_custkey) - 1 AS n FROM customer)
    SELECT a.k AS first, b.k AS second FROM d a JOIN d b ON b.n = a.n + 1 AND a.n % 2 = 0 WHERE b.n < 200 AND (a.lease = '' OR a.lease <> b.lease)
    """,
)
def negative_records(spark, sf):
    """Pairs of two records that don't share a lease, drawn by hash."""
    lease = F.when(F.col("c_nationkey") % 5 != 0, F.col("c_mktsegment")).otherwise("")
    return sampling.strangers(table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), lease.alias("lease")), "k", "lease", 100, seed=5)
