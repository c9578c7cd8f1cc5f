"""Queries that join pages, boxes, labels, blocks and tiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins
from ..sources import scans
from ..sources.scans import table
from .catalogue import register


@register(
    "adjacency_pairs",
    """
    WITH c AS (SELECT conv_id, turn, role FROM conversations WHERE (conv_id + turn) % 5 <> 4),
    a AS (SELECT c.conv_id, c.turn, c.role, n.role AS next_role FROM c JOIN c n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1)
    SELECT c.conv_id, c.turn, c.role, a.next_role, (SELECT min(b.turn) FROM c b WHERE b.conv_id = c.conv_id AND b.turn > c.turn + 2 AND b.role = 'assistant') AS later
    FROM c LEFT JOIN a USING (conv_id, turn)
    """,
)
def adjacency_pairs(spark, sf):
    """The next page by number, and the first back-like page more than two later."""
    rows = table(spark, sf, "conversations").where("(conv_id + turn) % 5 <> 4").select("conv_id", "turn", "role")
    pairs = joins.adjacent(rows, "conv_id", "turn", ["role"]).select("conv_id", "turn", "next_role")
    later = joins.first_later(rows, rows.where("role = 'assistant'"), "conv_id", "turn", 2)
    return rows.join(pairs, ["conv_id", "turn"], "left").join(later, ["conv_id", "turn"])


@register(
    "text_snap",
    """
    WITH w AS (SELECT item_id, doc_id, w FROM (SELECT item_id, regexp_replace(lower(unnest(string_split(text, ' '))), '[^0-9a-z]', '', 'g') AS w FROM benchmark)
               JOIN (SELECT DISTINCT doc_id, regexp_replace(lower(unnest(string_split(text, ' '))), '[^0-9a-z]', '', 'g') AS w FROM documents) USING (w) WHERE length(w) >= 8),
    df AS (SELECT w, count(DISTINCT doc_id) AS docs FROM w GROUP BY 1),
    rare AS (SELECT item_id, min(docs) AS docs FROM w JOIN df USING (w) GROUP BY 1),
    pick AS (SELECT item_id, min(w) AS anchor FROM w JOIN df USING (w) JOIN rare USING (item_id, docs) GROUP BY 1)
    SELECT b.item_id, CASE WHEN anchor IS NULL THEN 'unanchored' WHEN docs = 1 THEN 'snapped' ELSE 'ambiguous' END AS outcome, anchor,
           CASE WHEN docs = 1 THEN (SELECT min(doc_id) FROM w WHERE w.item_id = b.item_id AND w.w = anchor) END AS doc_id
    FROM benchmark b LEFT JOIN pick USING (item_id) LEFT JOIN rare USING (item_id)
    """,
)
def text_snap(spark, sf):
    """A passage snaps to the document that alone has its rarest anchor word."""
    words = lambda df, i: df.select(i, F.explode(F.split("text", " ")).alias("w")).select(i, S.norm("w").alias("w")).where("length(w) >= 8").distinct()
    items, docs = table(spark, sf, "benchmark"), words(table(spark, sf, "documents"), "doc_id")
    found = words(items, "item_id").join(docs.groupBy("w").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("doc_id")), "w")
    best = found.groupBy("item_id").agg(F.min(F.struct("docs", F.col("w").alias("anchor"), "doc_id")).alias("b"))
    outcome = F.when(F.col("b").isNull(), "unanchored").when(F.col("b.docs") == 1, "snapped").otherwise("ambiguous")
    return items.select("item_id").join(best, "item_id", "left").select("item_id", outcome.alias("outcome"), F.col("b.anchor").alias("anchor"), F.when(F.col("b.docs") == 1, F.col("b.doc_id")).alias("doc_id"))


_BOXES = """
SELECT p_partkey % 40 AS page, p_partkey AS id, (p_partkey * 37 % 83) / 100.0 AS l, (p_partkey * 53 % 89) / 100.0 AS t, (p_partkey * 37 % 83) / 100.0 + 0.05 + p_size / 1000.0 AS r, (p_partkey * 53 % 89) / 100.0 + 0.04 + p_size / 2000.0 AS b FROM part
"""


def _boxes(spark, sf, shift=0.0):
    k = F.col("p_partkey")
    left, top = (k * 37 % 83) / 100.0, (k * 53 % 89) / 100.0
    box = S.box(left + shift, top + shift, left + 0.05 + F.col("p_size") / 1000.0 + shift, top + 0.04 + F.col("p_size") / 2000.0 + shift)
    return table(spark, sf, "part").select((k % 40).alias("page"), k.alias("id"), box.alias("box"))


@register(
    "iou_mutual_unique",
    f"""
    WITH a AS ({_BOXES}), b AS (SELECT page, id, l + 0.0125 AS l, t + 0.0125 AS t, r + 0.0125 AS r, b + 0.0125 AS b FROM a),
    j AS (SELECT a.page, a.id AS id1, b.id AS id2, greatest(0, least(a.r, b.r) - greatest(a.l, b.l)) * greatest(0, least(a.b, b.b) - greatest(a.t, b.t)) AS x, (a.r - a.l) * (a.b - a.t) AS xa, (b.r - b.l) * (b.b - b.t) AS xb FROM a JOIN b ON a.page = b.page),
    k AS (SELECT page, id1, id2, x / (xa + xb - x) AS iou FROM j WHERE x / (xa + xb - x) >= 0.3),
    u AS (SELECT *, count(*) OVER (PARTITION BY page, id1) AS n1, count(*) OVER (PARTITION BY page, id2) AS n2 FROM k)
    SELECT page, id1, id2, round(iou, 6) AS iou FROM u WHERE n1 = 1 AND n2 = 1
    """,
)
def iou_mutual_unique(spark, sf):
    """Boxes that overlap enough and only each other."""
    left, right = _boxes(spark, sf).withColumnRenamed("id", "id1"), _boxes(spark, sf, 0.0125).withColumnRenamed("id", "id2")
    return joins.mutual_unique(left, right, "page", "id1", "id2").select("page", "id1", "id2", F.round("iou", 6).alias("iou"))


@register("fuzzy_labels")
def fuzzy_labels(spark, sf):
    """Rows only: sequence similarity has no SQL form; tests hold it against a plain loop."""
    specs = spark.createDataFrame([("owner", ["customer"]), ("supply", ["supplier"]), ("segment", ["household", "furniture"]), ("build", ["building"]), ("auto", ["automobile"]), ("machine", ["machinery"])], "spec string, tokens array<string>")
    k = F.col("c_custkey")
    worn = F.when(k % 3 == 0, F.regexp_replace(F.lower("c_mktsegment"), "l", "")).otherwise(F.lower("c_mktsegment"))
    labels = table(spark, sf, "customer").select(k.alias("k"), worn.alias("label"))
    return joins.fuzzy_labels(labels, specs, "label", "k").select("k", "label", "spec")


def _block_edges(spark, sf, lines):
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    keys = lines.groupBy(F.concat(F.lit("k"), "l_orderkey").alias("id")).agg(F.transform(F.sort_array(F.collect_list(line)), lambda x: F.concat(F.lit("w"), x["l_partkey"])).alias("child_ids")).withColumn("kind", F.lit("KEY"))
    words = table(spark, sf, "part").where("p_partkey % 7 <> 0").select(F.concat(F.lit("w"), "p_partkey").alias("id"), F.lit("WORD").alias("kind"), F.col("p_name").alias("text"))
    out = scans.block_children(keys.unionByName(words, allowMissingColumns=True), "KEY")
    return out.select(F.substring("id", 2, 20).cast("long").alias("id"), "joined", "n_children")


@register(
    "block_edges",
    """
    WITH l AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i, l_partkey AS child FROM lineitem),
    j AS (SELECT l.id, i, p_name FROM l JOIN part ON p_partkey = child AND p_partkey % 7 <> 0)
    SELECT id, string_agg(p_name, ' ' ORDER BY i) AS joined, count(*) AS n_children FROM j GROUP BY id
    """,
)
def block_edges(spark, sf):
    """A block's text by its child ids in order; ids of no block are skipped."""
    return _block_edges(spark, sf, table(spark, sf, "lineitem"))


@register(
    "block_edges_whole",
    """
    WITH l AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i, l_partkey AS child FROM lineitem),
    j AS (SELECT l.id, i, p_name FROM l JOIN part ON p_partkey = child AND p_partkey % 7 <> 0)
    SELECT id, string_agg(p_name, ' ' ORDER BY i) AS joined, count(*) AS n_children FROM j GROUP BY id
    """,
)
def block_edges_whole(spark, sf):
    """block_edges over every block."""
    return _block_edges(spark, sf, table(spark, sf, "lineitem"))


@register(
    "ocr_words",
    """
    WITH b AS (SELECT p_partkey AS id, p_name AS text, (p_partkey % 101) / 100.0 + CASE p_partkey % 9 WHEN 1 THEN 5e-7 WHEN 2 THEN -5e-7 WHEN 3 THEN 0.5 ELSE 0 END AS l, p_partkey % 4 AS kind FROM part)
    SELECT id, text, CASE WHEN l >= -1e-6 AND l <= 1 + 1e-6 THEN round(least(1.0, greatest(0.0, l)), 9) END AS l, l < -1e-6 OR l > 1 + 1e-6 AS out_of_range FROM b WHERE kind <> 0
    """,
)
def ocr_words(spark, sf):
    """Word blocks of a JSON response; fractions are clamped within a tolerance, null and flagged beyond it."""
    k = F.col("p_partkey")
    left = (k % 101) / 100.0 + F.when(k % 9 == 1, 5e-7).when(k % 9 == 2, -5e-7).when(k % 9 == 3, 0.5).otherwise(0.0)
    block = F.struct(k.alias("Id"), F.when(k % 4 == 0, "LINE").otherwise("WORD").alias("BlockType"), F.col("p_name").alias("Text"), left.alias("Left"))
    responses = table(spark, sf, "part").groupBy((k % 50).alias("page")).agg(F.to_json(F.collect_list(block)).alias("body"))
    blocks = responses.select(F.inline(F.from_json("body", "array<struct<Id:bigint,BlockType:string,Text:string,Left:double>>"))).where("BlockType = 'WORD'")
    fraction = S.unit(F.col("Left"))
    return blocks.select(F.col("Id").alias("id"), F.col("Text").alias("text"), F.round(fraction, 9).alias("l"), fraction.isNull().alias("out_of_range"))


@register(
    "oversize_and_scale",
    """
    WITH s AS (SELECT p_partkey AS k, p_size * 61 + 300 AS w, CAST(p_partkey % 97 * 53 + 200 AS INT) AS h FROM part)
    SELECT k, greatest(w, h) / least(w, h) > 2.0 AS oversize, CAST(greatest(1, round_even(w * least(1.0, 1000 / greatest(w, h)), 0)) AS INT) AS w, CAST(greatest(1, round_even(h * least(1.0, 1000 / greatest(w, h)), 0)) AS INT) AS h FROM s
    """,
)
def oversize_and_scale(spark, sf):
    """The oversize guard, and sizes scaled to a longest side with halves to even."""
    w, h = F.col("p_size") * 61 + 300, (F.col("p_partkey") % 97 * 53 + 200).cast("int")
    size = S.scaled(w, h, 1000)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), S.oversize(w, h).alias("oversize"), size["w"].alias("w"), size["h"].alias("h"))


@register(
    "located_values",
    f"""
    WITH b AS ({_BOXES}), v AS (SELECT page, id, concat('liner_strings[', id % 4, '].top_depth') AS field, l, t, least(r, l + 0.45) AS r, least(b, t + 0.075) AS b FROM b WHERE id % 6 <> 0)
    SELECT id, 'top depth' AS label, CAST(id % 4 AS INT) AS row_no, round(l, 6) AS l, round(greatest(0.0, t - 2 * 0.012), 6) AS band_top, round(r, 6) AS r, round(b, 6) AS b, CAST(round_even(l * 1000, 0) AS INT) AS x_px FROM v
    """,
)
def located_values(spark, sf):
    """Values with a region: capped boxes, the band shown, pixels, labels of dotted fields."""
    rows = _boxes(spark, sf).withColumn("region", F.when(F.col("id") % 6 != 0, F.col("box"))).where("region IS NOT NULL")
    field = F.concat(F.lit("liner_strings["), F.col("id") % 4, F.lit("].top_depth"))
    r = F.col("region")
    return rows.select("id", S.field_label(field).alias("label"), S.row_index(field).alias("row_no"), F.round(r["l"], 6).alias("l"), F.round(F.greatest(F.lit(0.0), r["t"] - 2 * 0.012), 6).alias("band_top"), F.round(F.least(r["r"], r["l"] + 0.45), 6).alias("r"), F.round(F.least(r["b"], r["t"] + 0.075), 6).alias("b"), F.bround(r["l"] * 1000).cast("int").alias("x_px"))


@register(
    "tier_choice",
    f"""
    WITH b AS ({_BOXES})
    SELECT id, CASE WHEN id % 4 = 0 THEN 'text_layer' WHEN id % 4 = 1 AND id % 5 <> 0 AND least(1.0, r) > l THEN 'template' WHEN id % 3 <> 2 THEN 'model' END AS tier,
           CASE WHEN id % 4 = 0 THEN round(l, 6) WHEN id % 4 = 1 AND id % 5 <> 0 AND least(1.0, r) > l THEN round(l + 0.1, 6) WHEN id % 3 <> 2 THEN round(l - 0.01, 6) END AS l,
           CASE WHEN id % 7 < 3 THEN 'paper' ELSE 'identity' END AS channel, CASE WHEN id % 10 = 0 THEN CASE WHEN id % 4 = 0 THEN 'met' ELSE 'broken' END END AS pin
    FROM b
    """,
)
def tier_choice(spark, sf):
    """The region of the best tier; templates only place what is present; pins are checked."""
    boxes = _boxes(spark, sf)
    snap = boxes.where("id % 4 = 0").select("id", F.col("box.l").alias("snap_l"))
    template = boxes.where("id % 4 IN (0, 1)").select("id", S.clip(F.col("box")).alias("clipped"), (F.col("box.l") + 0.1).alias("template_l"))
    model = boxes.where("id % 3 <> 2").select("id", (F.col("box.l") - 0.01).alias("model_l"))
    present = F.col("id") % 5 != 0
    out = boxes.select("id").join(snap, "id", "left").join(template, "id", "left").join(model, "id", "left")
    placed = F.when(present & F.col("clipped").isNotNull(), F.col("template_l"))
    tier = F.when(F.col("snap_l").isNotNull(), "text_layer").when(placed.isNotNull(), "template").when(F.col("model_l").isNotNull(), "model")
    fields = F.when(F.col("id") % 7 >= 3, F.array(F.lit("lease"))).otherwise(F.array().cast("array<string>"))
    pin = F.when(F.col("id") % 10 == 0, F.when(tier == "text_layer", "met").otherwise("broken"))
    return out.select("id", tier.alias("tier"), F.round(F.coalesce("snap_l", placed, "model_l"), 6).alias("l"), F.when(F.size(fields) == 0, "paper").otherwise("identity").alias("channel"), pin.alias("pin"))


@register(
    "tiered_lookup",
    """
    WITH g AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2)
    SELECT k, n, coalesce(CASE WHEN pf.p_size < 10 THEN 'field' END, CASE WHEN su.s_acctbal > 0 THEN 'row' END, CASE WHEN o.o_orderstatus = 'F' THEN 'block' END, 'none') AS found_in,
           coalesce(CASE WHEN pf.p_size < 10 THEN pf.p_size END, CASE WHEN su.s_acctbal > 0 THEN su.s_nationkey END, CASE WHEN o.o_orderstatus = 'F' THEN 0 END) AS value
    FROM g LEFT JOIN part pf ON pf.p_partkey = p LEFT JOIN supplier su ON su.s_suppkey = s LEFT JOIN orders o ON o.o_orderkey = k
    """,
)
def tiered_lookup(spark, sf):
    """Graded rows against fields, then measured rows, then blocks."""
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    fields = table(spark, sf, "part").where("p_size < 10").select(F.col("p_partkey").alias("p"), F.col("p_size").alias("field"))
    measured = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("s"), F.col("s_nationkey").alias("row"))
    blocks = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"), F.lit(0).alias("block"))
    out = rows.join(fields, "p", "left").join(measured, "s", "left").join(blocks, "k", "left")
    found = F.when(F.col("field").isNotNull(), "field").when(F.col("row").isNotNull(), "row").when(F.col("block").isNotNull(), "block").otherwise("none")
    return out.select("k", "n", found.alias("found_in"), F.coalesce("field", "row", "block").alias("value"))
