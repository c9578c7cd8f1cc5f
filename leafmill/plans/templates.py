"""Queries that register, route, match, search, export and stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import export, geometry, joins
from ..sources.scans import table
from ..streaming import ingest
from .catalogue import register

_POINTS = """
SELECT p_partkey % 12 AS page, (p_partkey * 17 % 101) / 100.0 AS x, (p_partkey * 31 % 103) / 100.0 AS y,
       1.02 * ((p_partkey * 17 % 101) / 100.0) + 0.01 * ((p_partkey * 31 % 103) / 100.0) + 0.03 + (p_partkey % 12) * 0.001 + (p_partkey % 5 - 2) * 0.0004 + CASE WHEN p_partkey % 41 = 0 THEN 0.3 ELSE 0 END AS u,
       0.98 * ((p_partkey * 31 % 103) / 100.0) - 0.02 * ((p_partkey * 17 % 101) / 100.0) + 0.01 + (p_partkey % 3 - 1) * 0.0005 AS v FROM part
"""


def _fit_sql(rows: str, name: str) -> str:
    """Centred regression on two variables: another way to the same least squares."""
    return f"""
    {name}_m AS (SELECT page, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv, covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(y, y) AS yy, covar_pop(x, u) AS xu, covar_pop(y, u) AS yu, covar_pop(x, v) AS xv, covar_pop(y, v) AS yv FROM {rows} GROUP BY page HAVING count(*) >= 8),
    {name}_s AS (SELECT *, (xu * yy - yu * xy) / (xx * yy - xy * xy) AS a, (yu * xx - xu * xy) / (xx * yy - xy * xy) AS b, (xv * yy - yv * xy) / (xx * yy - xy * xy) AS d, (yv * xx - xv * xy) / (xx * yy - xy * xy) AS e FROM {name}_m),
    {name} AS (SELECT page, n, a, b, mu - a * mx - b * my AS c, d, e, mv - d * mx - e * my AS f FROM {name}_s)"""


def _points(spark, sf):
    k = F.col("p_partkey")
    x, y = (k * 17 % 101) / 100.0, (k * 31 % 103) / 100.0
    u = 1.02 * x + 0.01 * y + 0.03 + (k % 12) * 0.001 + (k % 5 - 2) * 0.0004 + F.when(k % 41 == 0, 0.3).otherwise(0.0)
    v = 0.98 * y - 0.02 * x + 0.01 + (k % 3 - 1) * 0.0005
    return table(spark, sf, "part").select((k % 12).alias("page"), x.alias("x"), y.alias("y"), u.alias("u"), v.alias("v"))


@register(
    "affine_fit",
    f"""
    WITH p AS ({_POINTS}), {_fit_sql("p", "one")},
    r AS (SELECT p.*, sqrt(pow(a * x + b * y + c - u, 2) + pow(d * x + e * y + f - v, 2)) AS res FROM p JOIN one USING (page)),
    k AS (SELECT r.* FROM r JOIN (SELECT page, greatest(3 * median(res), 0.005) AS cut FROM r GROUP BY 1) USING (page) WHERE res <= cut), {_fit_sql("k", "two")}
    SELECT page, n, round(a, 5) AS a, round(b, 5) AS b, round(c, 5) AS c, round(d, 5) AS d, round(e, 5) AS e, round(f, 5) AS f, round((e * (0.5 - c) - b * (0.5 - f)) / (a * e - b * d), 5) AS back_x FROM two
    """,
)
def affine_fit(spark, sf):
    """A robust affine fit of each page, and a point taken back by the inverse."""
    fits = geometry.robust_fit(_points(spark, sf), ["page"]).withColumn("back", geometry.inverse("fit"))
    x, _ = geometry.apply("back", F.lit(0.5), F.lit(0.5))
    return fits.select("page", "n", *(F.round(F.col(f"fit.{k}"), 5).alias(k) for k in "abcdef"), F.round(x, 5).alias("back_x"))


@register(
    "route_argmin",
    """
    WITH c AS (SELECT p_partkey % 200 AS page, concat('rev', p_partkey % 6) AS revision, min((p_partkey * 7919 % 1009) / 40000.0 + 0.001) AS r FROM part WHERE p_partkey % 11 <> 0 GROUP BY 1, 2),
    n AS (SELECT *, lead(r) OVER w AS nxt, row_number() OVER w AS i FROM c WINDOW w AS (PARTITION BY page ORDER BY r, revision)),
    f AS (SELECT *, page % 3 = 0 AS known, r <= 0.010 AND (nxt IS NULL OR nxt >= 2 * r) AS clear FROM n WHERE i = 1)
    SELECT page, CASE WHEN known OR clear THEN revision END AS template, round(r, 8) AS residual, CASE WHEN known THEN 'known' WHEN clear THEN 'assigned' WHEN r > 0.010 THEN 'no_fit' ELSE 'abstain' END AS outcome FROM f
    """,
)
def route_argmin(spark, sf):
    """Pages to templates by least residual, or none."""
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").where(k % 11 != 0).select((k % 200).alias("page"), F.concat(F.lit("rev"), (k % 6).cast("string")).alias("revision"), ((k * 7919 % 1009) / 40000.0 + 0.001).alias("r"))
    least = rows.groupBy("page", "revision").agg(F.min("r").alias("r"))
    return geometry.route(least, "page", "revision", "r", F.col("page") % 3 == 0).withColumn("residual", F.round("residual", 8))


@register("greedy_match")
def greedy_match(spark, sf):
    """Rows only: each match depends on those before it; a test holds it against a plain loop."""
    k = F.col("p_partkey")
    marks = table(spark, sf, "part").select((k % 10).alias("pair"), (F.floor(k / 10) % 2).alias("side"), k.alias("ordinal"), ((k * 41 % 211) / 25.0).alias("x"), ((k * 67 % 227) / 25.0).alias("y"), (F.col("p_size") / 10.0).alias("area"))
    return joins.greedy_match(marks, "pair", 3.0)


@register(
    "search_rank",
    """
    WITH s AS (SELECT p_partkey AS id, concat(p_name, ' ', p_brand, ' ', p_type) AS text FROM part UNION ALL SELECT 1000000 + c_custkey, concat(c_name, ' ', c_mktsegment) FROM customer),
    t AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w, lower(text) AS l FROM s),
    c AS (SELECT id, CASE WHEN list_contains(w, 'red') THEN 2 WHEN instr(l, 'red') > 0 THEN 1 ELSE 0 END AS a, CASE WHEN list_contains(w, 'bran') THEN 2 WHEN instr(l, 'bran') > 0 THEN 1 ELSE 0 END AS b FROM t)
    SELECT id, a + b AS score, row_number() OVER (ORDER BY a + b DESC, id) AS place FROM c WHERE a > 0 AND b > 0 ORDER BY 3 LIMIT 100
    """,
)
def search_rank(spark, sf):
    """Every token must hit; whole words count double; the first hundred."""
    from pyspark.sql import Window

    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("text"))
    people = table(spark, sf, "customer").select((F.col("c_custkey") + 1_000_000).alias("id"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("text"))
    top = export.search(parts.unionByName(people), "text", "Red, BRAN").orderBy(F.col("score").desc(), "id").limit(100)
    return top.select("id", "score", F.row_number().over(Window.orderBy(F.col("score").desc(), "id")).cast("long").alias("place"))


@register(
    "bundle_export",
    """
    WITH v AS (SELECT o_orderkey AS k, 'dates' AS g, 'order' AS field, strftime(o_orderdate, '%Y-%m-%d') AS value, 0 AS o FROM orders WHERE o_orderkey % 4 <> 3
      UNION ALL SELECT l_orderkey, 'lines', concat('part', l_linenumber), CAST(min(l_partkey) AS VARCHAR), l_linenumber FROM lineitem WHERE l_orderkey % 4 <> 3 GROUP BY l_orderkey, l_linenumber
      UNION ALL SELECT o_orderkey, 'aside', 'status', o_orderstatus, 9 FROM orders WHERE o_orderkey % 4 <> 3)
    SELECT o_orderkey AS k, c_name AS customer, count(v.k) AS n_values, coalesce(string_agg(g || '.' || field || '=' || value, ';' ORDER BY CASE g WHEN 'dates' THEN 1 WHEN 'lines' THEN 2 ELSE 3 END, g, o, field, value), '') AS body
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN v ON v.k = o_orderkey GROUP BY 1, 2
    """,
)
def bundle_export(spark, sf):
    """Nested documents with their values in group order; shown flat."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    known = orders.where("o_orderkey % 4 <> 3")
    dates = known.select(F.col("o_orderkey").alias("k"), F.lit("dates").alias("group"), F.lit("order").alias("field"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("value"), F.lit(0).alias("o"))
    parts = lines.where("l_orderkey % 4 <> 3").groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("o")).agg(F.min("l_partkey").cast("string").alias("value"))
    parts = parts.select("k", F.lit("lines").alias("group"), F.concat(F.lit("part"), F.col("o").cast("string")).alias("field"), "value", "o")
    aside = known.select(F.col("o_orderkey").alias("k"), F.lit("aside").alias("group"), F.lit("status").alias("field"), F.col("o_orderstatus").alias("value"), F.lit(9).alias("o"))
    docs = orders.join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("k"), F.col("c_name").alias("customer"))
    out = export.bundle(docs, dates.unionByName(parts).unionByName(aside), "k", F.col("o"), ["dates", "lines"])
    body = F.array_join(F.transform("values", lambda v: F.concat(v["group"], F.lit("."), v["field"], F.lit("="), v["value"])), ";")
    return out.select("k", "customer", F.size("values").cast("long").alias("n_values"), body.alias("body"))


@register("greedy_chunks")
def greedy_chunks(spark, sf):
    """Rows only: a sum that starts anew; a test holds it against a plain loop."""
    return export.chunks(table(spark, sf, "documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", 20_000, 30)


@register("incremental_stream", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def incremental_stream(spark, sf):
    """Extension: the batch form of the streaming counts; a test holds the stream against it."""
    out = ingest.hourly(table(spark, sf, "events"))
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@register(
    "event_sessions",
    """
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, s
    """,
)
def event_sessions(spark, sf):
    """Extension: the batch form of session windows over events."""
    out = ingest.sessions(table(spark, sf, "events"))
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@register(
    "page_labels_checked",
    "SELECT doc_id, CASE WHEN n_chars <= 0 THEN 'empty' WHEN lang NOT IN ('en', 'de', 'fr', 'es') THEN 'unknown language' WHEN source NOT LIKE 'src%' THEN 'unknown source' ELSE 'ok' END AS \"check\", coalesce(nullif(regexp_replace(lower(source), '[^0-9a-z]', '', 'g'), ''), 'unknown') AS revision FROM documents",
)
def page_labels_checked(spark, sf):
    """Each row's check as a column."""
    check = F.when(F.col("n_chars") <= 0, "empty").when(~F.col("lang").isin("en", "de", "fr", "es"), "unknown language").when(~F.col("source").startswith("src"), "unknown source").otherwise("ok")
    return table(spark, sf, "documents").select("doc_id", check.alias("check"), S.revision_key("source").alias("revision"))
