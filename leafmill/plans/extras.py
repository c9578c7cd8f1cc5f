"""Queries over template overlays, aliases, families, viewports, invariants and marks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import marks, overlays
from ..sources import images
from ..sources.scans import table
from .catalogue import register


@register(
    "template_overlay",
    """
    WITH b AS (SELECT s_nationkey AS k, concat('f', s_suppkey % 5) AS f, max(s_acctbal) AS v FROM supplier WHERE s_nationkey % 6 <> 5 GROUP BY 1, 2),
    o AS (SELECT s_nationkey AS k, concat('f', s_suppkey % 3) AS f, min(s_suppkey) + 0.5 AS v FROM supplier WHERE s_suppkey % 2 = 0 GROUP BY 1, 2)
    SELECT coalesce(b.k, o.k) AS k, coalesce(b.f, o.f) AS f, CAST(coalesce(o.v, b.v) AS DOUBLE) AS v FROM b FULL JOIN o ON b.k = o.k AND b.f = o.f WHERE coalesce(b.k, o.k) IN (SELECT k FROM b)
    """,
)
def template_overlay(spark, sf):
    """Base maps with overlays that win entry by entry."""
    rows = table(spark, sf, "supplier")
    entries = lambda df, n, v: df.groupBy(F.col("s_nationkey").alias("k"), F.concat(F.lit("f"), (F.col("s_suppkey") % n).cast("string")).alias("f")).agg(v.alias("v")).groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("f", "v"))).alias("m"))
    base = entries(rows.where("s_nationkey % 6 <> 5"), 5, F.max("s_acctbal"))
    over = entries(rows.where("s_suppkey % 2 = 0"), 3, F.min("s_suppkey") + 0.5)
    return overlays.overlay(base, over, ["k"], ["m"]).select("k", F.explode("m").alias("f", "v"))


@register(
    "alias_expand",
    """
    WITH a AS (SELECT p_partkey % 20 AS k, concat('t', p_size % 9) AS token, min(p_retailprice) AS box FROM part GROUP BY 1, 2),
    s AS (SELECT DISTINCT p_partkey % 20 AS k, concat('t', p_size % 9) AS token, concat(CASE WHEN p_partkey % 4 = 0 THEN 't' ELSE 'x' END, p_partkey % 31) AS spelling FROM part WHERE p_partkey % 3 = 0),
    u AS (SELECT k, spelling, min(token) AS token FROM s GROUP BY 1, 2 HAVING count(*) = 1)
    SELECT k, token, box FROM a UNION ALL SELECT u.k, u.spelling, a.box FROM u JOIN a USING (k, token) WHERE NOT EXISTS (SELECT 1 FROM a b WHERE b.k = u.k AND b.token = u.spelling)
    """,
)
def alias_expand(spark, sf):
    """R2: aliases as more anchors, unless two claim a spelling or an anchor has it."""
    p = F.col("p_partkey")
    token = F.concat(F.lit("t"), (F.col("p_size") % 9).cast("string"))
    rows = table(spark, sf, "part").select((p % 20).alias("k"), token.alias("token"), F.col("p_retailprice").alias("box"), p.alias("p"))
    anchors = rows.groupBy("k", "token").agg(F.min("box").alias("box"))
    spelling = F.concat(F.when(F.col("p") % 4 == 0, "t").otherwise("x"), (F.col("p") % 31).cast("string"))
    return overlays.expand_anchors(anchors, rows.where("p % 3 = 0").select("k", "token", spelling.alias("spelling")), "k")


@register(
    "label_clusters",
    """
    WITH a AS (SELECT p_partkey % 12 AS label, concat('t', least(CASE WHEN p_partkey % 4 = 0 THEN p_size % 3 ELSE p_size % 8 END, p_partkey % 7)) AS token, p_partkey AS id, (p_partkey % 7) / 10.0 + (p_partkey % 3) / 100.0 AS y, (p_partkey * 53 % 89) / 900.0 AS x FROM part),
    g AS (SELECT *, CASE WHEN y - lag(y) OVER (PARTITION BY label ORDER BY y, token) > 0.03 THEN 1 ELSE 0 END AS new FROM a),
    r AS (SELECT *, sum(new) OVER (PARTITION BY label ORDER BY y, token ROWS UNBOUNDED PRECEDING) AS run FROM g),
    c AS (SELECT label, run, count(DISTINCT token) AS tokens, min(y) AS top, max(y) AS bottom FROM r GROUP BY 1, 2 HAVING max(x) - min(x) <= 0.25),
    n AS (SELECT *, row_number() OVER w AS i, lead(tokens) OVER w AS nxt FROM c WINDOW w AS (PARTITION BY label ORDER BY tokens DESC, run))
    SELECT label, tokens, round(top, 6) AS top, round(bottom, 6) AS bottom FROM n WHERE i = 1 AND (nxt IS NULL OR nxt < tokens)
    """,
)
def label_clusters(spark, sf):
    """The cluster with most of a label's tokens; none on a tie."""
    k = F.col("p_partkey")
    # seven runs a label, the last with most tokens; every fourth label has runs that tie
    token = F.least(F.when(k % 4 == 0, F.col("p_size") % 3).otherwise(F.col("p_size") % 8), k % 7)
    rows = table(spark, sf, "part").select((k % 12).alias("label"), F.concat(F.lit("t"), token.cast("string")).alias("token"), (k % 7 / 10.0 + k % 3 / 100.0).alias("y"), ((k * 53 % 89) / 900.0).alias("x"))
    return overlays.label_cluster(rows, "label", 0.03, 0.25).select("label", "tokens", F.round("top", 6).alias("top"), F.round("bottom", 6).alias("bottom"))


@register(
    "family_vote",
    """
    WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 'face' WHEN 1 THEN 'sec_ii' WHEN 2 THEN 'sec_iii' WHEN 3 THEN 'back' END AS part, c_custkey % 7 AS l FROM customer),
    v AS (SELECT *, CASE part WHEN 'sec_ii' THEN 'w2' WHEN 'sec_iii' THEN 'g1' END AS h, CASE WHEN l IN (0, 1) THEN 'g1' WHEN l = 2 THEN 'w2' END AS n FROM c)
    SELECT k, CASE WHEN h IS NOT NULL AND n IS NOT NULL AND h <> n THEN NULL ELSE coalesce(h, n, CASE WHEN part = 'face' THEN 'g1' END) END AS family, l IN (0, 1, 2, 3) AND l <> 5 AS looks_back FROM v
    """,
)
def family_vote(spark, sf):
    """Families by heading and numbered labels; disagreement is no family."""
    k = F.col("c_custkey")
    part = F.when(k % 5 == 0, "face").when(k % 5 == 1, "sec_ii").when(k % 5 == 2, "sec_iii").when(k % 5 == 3, "back")
    pick = k % 7
    labels = F.when(pick == 0, F.array(F.lit("19. Notice of Intention"), F.lit("4 Lease"))).when(pick == 1, F.array(F.lit("24 Location of Well"))).when(pick == 2, F.array(F.lit("31. LOCATION OF THE WELL"), F.lit("26 Notice of intention to drill")))
    labels = labels.when(pick == 3, F.array(F.lit("19. Notice of Intention"), F.lit("32 Location of well"))).when(pick == 5, F.array(F.lit("1. Operator"), F.lit("24 Location of Well name"))).otherwise(F.array(F.lit("7. Total depth")))
    # a label of the face on the page keeps it from being a back page, whatever else it cites
    labels = F.when(pick == 5, F.array(F.lit("1. Operator"), F.lit("7 county"))).otherwise(labels)
    back = overlays.looks_back(labels, ["operator"], ["notice of intention", "location of well", "location of the well"])
    return table(spark, sf, "customer").select(k.alias("k"), overlays.family(part, labels, F.lit("g1")).alias("family"), back.alias("looks_back"))


@register(
    "viewport",
    """
    WITH b AS (SELECT p_partkey AS id, (p_partkey * 37 % 83) / 100.0 AS l, (p_partkey * 53 % 89) / 100.0 AS t, (p_partkey * 37 % 83) / 100.0 + 0.05 + p_size / 100.0 AS r, (p_partkey * 53 % 89) / 100.0 + 0.04 + p_size / 200.0 AS b FROM part),
    c AS (SELECT *, greatest(8 * 0.012, b - t + 2 * 0.012) AS h, greatest(0.35, r - l + 4 * 0.012) AS w FROM b),
    p AS (SELECT id, w, h, least(greatest((l + r) / 2 - w / 2, 0), greatest(0, 1 - w)) AS x, least(greatest((t + b) / 2 - h / 2, 0), greatest(0, 1 - h)) AS y FROM c)
    SELECT id, round(CAST(x AS DOUBLE), 6) AS l, round(CAST(y AS DOUBLE), 6) AS t, round(CAST(least(1, x + w) AS DOUBLE), 6) AS r, round(CAST(least(1, y + h) AS DOUBLE), 6) AS b FROM p
    """,
)
def viewport(spark, sf):
    """What is shown around a region."""
    k = F.col("p_partkey")
    left, top = (k * 37 % 83) / 100.0, (k * 53 % 89) / 100.0
    view = overlays.viewport(S.box(left, top, left + 0.05 + F.col("p_size") / 100.0, top + 0.04 + F.col("p_size") / 200.0))
    return table(spark, sf, "part").select(k.alias("id"), *(F.round(view[c], 6).alias(c) for c in "ltrb"))


@register(
    "invariants",
    """
    WITH v AS (SELECT o_orderkey AS k, o_orderkey % 23 AS f FROM orders)
    SELECT CASE WHEN f = 1 THEN 'present without a region or reading' WHEN f = 2 THEN 'absent with a region or text' WHEN f IN (3, 4) THEN 'region out of bounds' WHEN f = 5 THEN 'region on a page of another document' WHEN f = 6 THEN 'no status' WHEN f = 7 THEN 'counted twice' WHEN f = 8 THEN 'not accounted for' END AS broken, count(*) AS n
    FROM v WHERE f BETWEEN 1 AND 8 GROUP BY 1
    """,
)
def invariants(spark, sf):
    """Section 1.4: rows that break an invariant, by kind; faults are put in by key."""
    k, f = F.col("o_orderkey"), F.col("o_orderkey") % 23
    orders = table(spark, sf, "orders")
    box = S.box(F.lit(0.1), F.lit(0.1), F.when(f == 3, 1.2).when(f == 4, 0.1).otherwise(0.5), F.lit(0.2))
    region = F.when(f != 1, F.struct(F.when(f == 5, 9).otherwise(1).alias("page"), box.alias("box"), F.lit("text_layer").alias("source")))
    status = F.when(f == 6, None).when(f == 2, "blank").otherwise("present")
    values = orders.select(k.alias("k"), status.alias("status"), F.lit("v").alias("value"), F.lit("v").alias("raw"), region.alias("region"))
    broken = overlays.broken_values(values, F.array(F.lit(1), F.lit(2)), ["text_layer", "template", "model"]).select("broken")
    keys = orders.select(k.alias("k"), f.alias("f"))
    lost = overlays.unaccounted(keys, keys.where("f <> 8 AND k % 2 = 0"), keys.where("f <> 8 AND (k % 2 = 1 OR f = 7)"), keys.where("f = 7 AND k % 2 = 1"), key="k")
    lost = lost.select(F.when(F.col("times") > 1, "counted twice").otherwise("not accounted for").alias("broken"))
    return broken.unionByName(lost).groupBy("broken").agg(F.count(F.lit(1)).alias("n"))


def _image_listing(customers):
    k = F.col("c_custkey")
    line = F.format_string("   1     0 image    %d  1400  gray    1   8  jpeg   no        12  0   300   300 99K 7.1%%", k % 100 + 1000)
    head = F.lit("page   num  type   width height color comp bpc  enc interp  object ID x-ppi y-ppi size ratio\n------")
    lines = F.when(k % 4 == 0, F.array(head)).otherwise(F.concat(F.array(head), F.array_repeat(line, (k % 4).cast("int"))))
    rows = customers.select(k.alias("k"), F.array_join(lines, "\n").alias("listing"))
    return images.listed_images(rows, "k", "listing")


@register(
    "image_listing",
    """
    WITH c AS (SELECT c_custkey AS k, c_custkey % 4 AS n FROM customer)
    SELECT k, 1 AS page, CASE WHEN n = 1 THEN CAST(1000 + k % 100 AS INT) ELSE 0 END AS width, CASE WHEN n = 1 THEN 1400 ELSE 0 END AS height, CASE WHEN n = 1 THEN 300.0::DOUBLE ELSE 0.0::DOUBLE END AS dpi FROM c WHERE n > 0
    """,
)
def image_listing(spark, sf):
    """Sizes and dpi of pages with one image; a page with several has none."""
    return _image_listing(table(spark, sf, "customer"))


@register(
    "image_listing_whole",
    """
    WITH c AS (SELECT c_custkey AS k, c_custkey % 4 AS n FROM customer)
    SELECT k, 1 AS page, CASE WHEN n = 1 THEN CAST(1000 + k % 100 AS INT) ELSE 0 END AS width, CASE WHEN n = 1 THEN 1400 ELSE 0 END AS height, CASE WHEN n = 1 THEN 300.0::DOUBLE ELSE 0.0::DOUBLE END AS dpi FROM c WHERE n > 0
    """,
)
def image_listing_whole(spark, sf):
    """image_listing over every listing."""
    return _image_listing(table(spark, sf, "customer"))


@register(
    "search_items",
    """
    SELECT e.event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS a, nullif(event_type, '') AS b, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 2 END AS n FROM events e
    """,
)
def search_items(spark, sf):
    """Pairs of text into a map; the last of equal keys wins, what has no = is left out."""
    text = F.concat(F.lit("a="), F.col("user_id").cast("string"), F.lit(" ; junk; b = "), F.col("event_type"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("; a="), F.col("event_type"))).otherwise(""))
    found = table(spark, sf, "events").select("event_id", images.search_items(text).alias("m"))
    return found.select("event_id", F.try_element_at("m", F.lit("a")).alias("a"), F.try_element_at("m", F.lit("b")).alias("b"), F.size("m").alias("n"))


@register("paper_compare")
def paper_compare(spark, sf):
    """Rows only: greedy pairing and Fourier filters; tests hold verdicts against made-up sheets."""
    rows = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("o"))
    x, y = (F.col("vec_id") * 37 % 83) / 100.0, (F.col("vec_id") * 53 % 89) / 100.0
    fronts = rows.select(F.floor(F.col("vec_id") / 5).alias("pair"), F.lit(0).alias("side"), x.alias("x"), y.alias("y"), F.lit(0.05).alias("area"), F.col("o").alias("outline"))
    backs = rows.select(F.floor(F.col("vec_id") / 5).alias("pair"), F.lit(1).alias("side"), x.alias("x"), (1 - y).alias("y"), F.lit(0.05).alias("area"), F.when(F.floor(F.col("vec_id") / 5) % 2 == 0, F.reverse("o")).otherwise(F.col("o")).alias("outline"))
    return marks.compare(fronts.unionByName(backs))


@register("chip_places")
def chip_places(spark, sf):
    """Rows only: each place depends on those before it; a test holds them apart."""
    k = F.col("p_partkey")
    left, top = k * 37 % 830, k * 53 % 890
    boxes = table(spark, sf, "part").select((k % 60).alias("page"), k.alias("n"), left.alias("l"), top.alias("t"), (left + 100).alias("r"), (top + 40).alias("b"))
    return overlays.place_chips(boxes, "page", "n", (18, 12), (1000, 1000))
