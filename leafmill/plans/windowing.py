"""Queries of a window's shape."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import windows as W
from ..sources.scans import table
from .catalogue import register


@register(
    "casing_order",
    """
    WITH c AS (SELECT l_orderkey AS k, l_linenumber AS i, l_partkey AS p, l_suppkey AS s, l_extendedprice AS e, CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_quantity AS INT) END AS depth FROM lineitem),
    p AS (SELECT *, last(depth IGNORE NULLS) OVER (PARTITION BY k ORDER BY i, p, s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM c)
    SELECT k, i, before, depth FROM p WHERE depth < before
    """,
)
def casing_order(spark, sf):
    """Depths shallower than the last known one, which moves on after a violation too."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_extendedprice").alias("e"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity").cast("int")).alias("depth"))
    return rows.withColumn("before", W.previous_known("depth", ["k"], ["i", "p", "s", "e"])).where("depth < before").select("k", "i", "before", "depth")


_WORDS = """
SELECT doc_id AS page, o AS ordinal, w, (o - 1) // 12 * 0.02::DOUBLE AS top, ((o - 1) % 12) * 0.08::DOUBLE + (length(w) % 4) * 0.005::DOUBLE AS "left", ((o - 1) % 12) * 0.08::DOUBLE + (length(w) % 4) * 0.005::DOUBLE + least(length(w), 9) * 0.006::DOUBLE AS "right"
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS o FROM documents)
"""


def _words(spark, sf):
    # texts move once, a page to one task: what is grouped by page after that moves no words
    rows = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id").select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", " ", -1)).alias("o", "w"))
    n = F.length("w")
    left = (F.col("o") % 12) * 0.08 + (n % 4) * 0.005
    return rows.select("page", (F.col("o") + 1).cast("long").alias("ordinal"), "w", (F.floor(F.col("o") / 12) * 0.02).alias("top"), left.alias("left"), (left + F.least(n, F.lit(9)) * 0.006).alias("right"))


@register(
    "gap_runs",
    f"""
    WITH w AS ({_WORDS}), n AS (SELECT *, lead("left") OVER p AS nl, lead(top) OVER p AS nt FROM w WINDOW p AS (PARTITION BY page ORDER BY top, "left", ordinal)),
    g AS (SELECT page, CASE WHEN abs(nt - top) <= 0.006 AND nl - "right" > 0 THEN nl - "right" END AS gap FROM n),
    c AS (SELECT page, count(gap) AS n_gaps, CASE WHEN count(gap) >= 20 THEN 4 * median(gap) ELSE 0.018::DOUBLE END AS cutoff FROM g GROUP BY 1),
    e AS (SELECT user_id, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events)
    SELECT 'page' AS kind, page AS key, n_gaps AS n, round(cutoff, 6) AS value FROM c
    UNION ALL SELECT 'user', user_id, count(*), CAST(sum(new) + 1 AS DOUBLE) FROM e GROUP BY user_id
    """,
)
def gap_runs(spark, sf):
    """Gaps between words of a line and their adaptive cutoff; events in runs without a long pause."""
    gaps = W.line_gaps(_words(spark, sf), "page", F.abs(F.col("next_top") - F.col("top")) <= 0.006, "ordinal")
    cut = W.gap_cutoff(gaps, "page").select(F.lit("page").alias("kind"), F.col("page").alias("key"), F.col("n_gaps").alias("n"), F.round("cutoff", 6).alias("value"))
    events = table(spark, sf, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    runs = W.gap_groups(events, ["user_id"], "us", ["event_id"], F.lit(30 * 60 * 1_000_000))
    return cut.unionByName(runs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), (F.max("cluster") + 1).cast("double").alias("value")).select(F.lit("user").alias("kind"), F.col("user_id").alias("key"), "n", "value"))


@register("line_run")
def line_run(spark, sf):
    """Rows only: the walk depends on what it has taken in; tests hold it against a plain loop."""
    words = _words(spark, sf).withColumn("matched", F.col("ordinal") % 40 == 5)
    return W.line_run(words, "page", 0.05)


@register(
    "ranked_faces",
    """
    WITH c AS (SELECT conv_id, turn, length(text) AS n, role = 'user' AS face, role <> 'assistant' AS lead FROM conversations),
    r AS (SELECT *, CASE WHEN face THEN row_number() OVER (PARTITION BY conv_id, face ORDER BY n DESC, turn) END AS rank,
            min(CASE WHEN lead THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS header,
            row_number() OVER (PARTITION BY conv_id ORDER BY round(n / 1000.0, 9) DESC, turn) AS drawn FROM c)
    SELECT conv_id, turn, rank, header, drawn FROM r
    """,
)
def ranked_faces(spark, sf):
    """Faces by richness then page, leading rows, and the drawing order by area."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("n"), (F.col("role") == "user").alias("face"), (F.col("role") != "assistant").alias("lead"))
    rank = F.row_number().over(Window.partitionBy("conv_id", "face").orderBy(F.col("n").desc(), "turn"))
    drawn = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.round(F.col("n") / 1000.0, 9).desc(), "turn"))
    return rows.select("conv_id", "turn", F.when(F.col("face"), rank).cast("long").alias("rank"), W.prefix_rows("lead", ["conv_id"], ["turn"]).alias("header"), drawn.cast("long").alias("drawn"))


@register(
    "block_bounds",
    """
    WITH a AS (SELECT p_partkey % 60 AS page, p_partkey AS id, (p_partkey * 29 % 97) / 100.0 AS t, p_size % 3 AS col FROM part),
    n AS (SELECT a.page, a.id, a.t, a.col, (SELECT min(b.t) FROM a b WHERE b.page = a.page AND b.col = a.col AND b.t > a.t) AS below FROM a)
    SELECT page, id, round(t, 6) AS top, round(CASE WHEN below IS NOT NULL THEN least(below, t + 0.2) ELSE least(1.0, t + 0.1) END, 6) AS bottom,
           round(t + (id % 4) * (CASE WHEN below IS NOT NULL THEN least(below, t + 0.2) ELSE least(1.0, t + 0.1) END - t) / 4, 6) AS band_top FROM n
    """,
)
def block_bounds(spark, sf):
    """A block ends at the next heading below in its column, capped, with a default; and a row's even band."""
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select((k % 60).alias("page"), k.alias("id"), ((k * 29 % 97) / 100.0).alias("t"), (F.col("p_size") % 3).alias("col"))
    # the next larger top: a range frame by hundredths needs no pairs
    below = F.min("t").over(Window.partitionBy("page", "col").orderBy(F.bround(F.col("t") * 100).cast("int")).rangeBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("below", below).withColumn("bottom", F.coalesce(F.least(F.when(F.col("below").isNotNull(), F.col("below")), F.when(F.col("below").isNotNull(), F.col("t") + 0.2)), F.least(F.lit(1.0), F.col("t") + 0.1)))
    top, _ = W.band(F.col("id") % 4, F.lit(4), F.col("t"), F.col("bottom"))
    return rows.select("page", "id", F.round("t", 6).alias("top"), F.round("bottom", 6).alias("bottom"), F.round(top, 6).alias("band_top"))


@register(
    "run_length_edge",
    """
    WITH e AS (SELECT vec_id, embedding AS v FROM embeddings), p AS (SELECT vec_id, v, unnest(generate_series(1, len(v) - 2)) AS i FROM e)
    SELECT vec_id, CAST(min(CASE WHEN v[i] > 0 AND v[i + 1] > 0 AND v[i + 2] > 0 THEN i - 1 END) AS INT) AS edge, CAST(any_value(len(list_filter(v, lambda x: x > 0))) AS INT) AS bright, any_value(round(CAST(list_max(v) AS DOUBLE), 5)) AS brightest FROM p GROUP BY vec_id
    """,
)
def run_length_edge(spark, sf):
    """The first run of three bright values of a line."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", W.first_run(v, 3, 0.0).alias("edge"), F.size(F.filter(v, lambda x: x > 0)).alias("bright"), F.round(F.array_max(v), 5).alias("brightest"))


@register(
    "radius_neighbours",
    """
    WITH m AS (SELECT p_partkey % 25 AS page, p_partkey AS ordinal, (p_partkey * 41 % 211) / 25.0 AS x, (p_partkey * 67 % 227) / 25.0 AS y, p_size / 10.0 AS area FROM part),
    n AS (SELECT a.page, a.ordinal, count(*) AS near FROM m a JOIN m b ON a.page = b.page AND a.ordinal <> b.ordinal AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.35 AND greatest(a.area, b.area) <= 2 * least(a.area, b.area) GROUP BY ALL)
    SELECT m.page, m.ordinal, coalesce(near, 0) AS near, coalesce(near, 0) = 0 AND area < 3.0 AS kept FROM m LEFT JOIN n USING (page, ordinal)
    """,
)
def radius_neighbours(spark, sf):
    """Marks with like neighbours in a radius are no small marks."""
    k = F.col("p_partkey")
    marks = table(spark, sf, "part").select((k % 25).alias("page"), k.alias("ordinal"), ((k * 41 % 211) / 25.0).alias("x"), ((k * 67 % 227) / 25.0).alias("y"), (F.col("p_size") / 10.0).alias("area"))
    return W.neighbours_in_radius(marks, "page", "ordinal", 0.35).select("page", "ordinal", "near", ((F.col("near") == 0) & (F.col("area") < 3.0)).alias("kept"))


_ALL_PAIRS = "SELECT a.vec_id, list_transform(a.embedding, lambda x: CAST(x AS DOUBLE)) AS u, list_transform(b.embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"


def _all_pairs(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("u"))
    nxt = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("u").alias("v"))
    return rows.join(nxt, "vec_id")


def _best_shift(pairs):
    from ..operators.stats import correlation

    shifts = F.array_max(F.array(*(correlation(F.col("u"), W.rotated(F.col("v"), k)) for k in range(-3, 4))))
    return pairs.select("vec_id", F.round(shifts, 6).alias("best"))


def _best_transform(pairs):
    from ..operators.stats import correlation

    names = ("same", "turned", "mirrored", "turned_mirrored")
    scores = [F.struct(F.round(correlation(F.col("u"), W.oriented(F.col("v"), n)), 6).alias("s"), F.lit(-i).alias("o"), F.lit(n).alias("n")) for i, n in enumerate(names)]
    best = pairs.select("vec_id", F.array_max(F.array(*scores)).alias("b"))
    return best.select("vec_id", F.col("b.n").alias("transform"), F.col("b.s").alias("score"), (F.col("b.s") >= 0.3).alias("clears"))


@register(
    "shift_correlation",
    f"""
    WITH p AS ({_ALL_PAIRS}), s AS (SELECT vec_id, u, list_concat(v[len(v) - pmod + 1:len(v)], v[1:len(v) - pmod]) AS v, k FROM (SELECT *, (k + len(v)) % len(v) AS pmod FROM p, unnest([-3, -2, -1, 0, 1, 2, 3]) AS t(k))),
    c AS (SELECT vec_id, k, corr(a, b) AS c FROM (SELECT vec_id, k, unnest(u) AS a, unnest(v) AS b FROM s) GROUP BY ALL)
    SELECT vec_id, round(max(c), 6) AS best FROM c GROUP BY vec_id
    """,
)
def shift_correlation(spark, sf):
    """The best correlation over bounded shifts."""
    return _best_shift(_all_pairs(spark, sf))


@register(
    "shift_correlation_whole",
    f"""
    WITH p AS ({_ALL_PAIRS}), s AS (SELECT vec_id, u, list_concat(v[len(v) - pmod + 1:len(v)], v[1:len(v) - pmod]) AS v, k FROM (SELECT *, (k + len(v)) % len(v) AS pmod FROM p, unnest([-3, -2, -1, 0, 1, 2, 3]) AS t(k))),
    c AS (SELECT vec_id, k, corr(a, b) AS c FROM (SELECT vec_id, k, unnest(u) AS a, unnest(v) AS b FROM s) GROUP BY ALL)
    SELECT vec_id, round(max(c), 6) AS best FROM c GROUP BY vec_id
    """,
)
def shift_correlation_whole(spark, sf):
    """shift_correlation over every pair."""
    return _best_shift(_all_pairs(spark, sf))


@register(
    "best_transform",
    f"""
    WITH p AS ({_ALL_PAIRS}), h AS (SELECT vec_id, u, v, list_concat(v[len(v) // 2 + 1:len(v)], v[1:len(v) // 2]) AS w FROM p),
    t AS (SELECT vec_id, u, 0 AS o, v AS x FROM h UNION ALL SELECT vec_id, u, 1, w FROM h UNION ALL SELECT vec_id, u, 2, list_reverse(v) FROM h UNION ALL SELECT vec_id, u, 3, list_reverse(w) FROM h),
    c AS (SELECT vec_id, o, round(corr(a, b), 6) AS c FROM (SELECT vec_id, o, unnest(u) AS a, unnest(x) AS b FROM t) GROUP BY ALL)
    SELECT vec_id, CASE o WHEN 0 THEN 'same' WHEN 1 THEN 'turned' WHEN 2 THEN 'mirrored' ELSE 'turned_mirrored' END AS transform, c AS score, c >= 0.3 AS clears
    FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, o) AS n FROM c) WHERE n = 1
    """,
)
def best_transform(spark, sf):
    """The best of four transforms, the first on a tie, and whether it clears the threshold."""
    return _best_transform(_all_pairs(spark, sf))


@register(
    "best_transform_whole",
    f"""
    WITH p AS ({_ALL_PAIRS}), h AS (SELECT vec_id, u, v, list_concat(v[len(v) // 2 + 1:len(v)], v[1:len(v) // 2]) AS w FROM p),
    t AS (SELECT vec_id, u, 0 AS o, v AS x FROM h UNION ALL SELECT vec_id, u, 1, w FROM h UNION ALL SELECT vec_id, u, 2, list_reverse(v) FROM h UNION ALL SELECT vec_id, u, 3, list_reverse(w) FROM h),
    c AS (SELECT vec_id, o, round(corr(a, b), 6) AS c FROM (SELECT vec_id, o, unnest(u) AS a, unnest(x) AS b FROM t) GROUP BY ALL)
    SELECT vec_id, CASE o WHEN 0 THEN 'same' WHEN 1 THEN 'turned' WHEN 2 THEN 'mirrored' ELSE 'turned_mirrored' END AS transform, c AS score, c >= 0.3 AS clears
    FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, o) AS n FROM c) WHERE n = 1
    """,
)
def best_transform_whole(spark, sf):
    """best_transform over every pair."""
    return _best_transform(_all_pairs(spark, sf))


@register(
    "profile_margin",
    f"""
    WITH p AS ({_ALL_PAIRS}), h AS (SELECT vec_id, u, v, list_concat(v[len(v) // 2 + 1:len(v)], v[1:len(v) // 2]) AS w FROM p),
    t AS (SELECT vec_id, u, 2 AS o, list_reverse(v) AS x FROM h UNION ALL SELECT vec_id, u, 3, list_reverse(w) FROM h UNION ALL SELECT vec_id, u, 0, v FROM h UNION ALL SELECT vec_id, u, 1, w FROM h),
    c AS (SELECT vec_id, o, corr(a, b) AS c FROM (SELECT vec_id, o, unnest(u) AS a, unnest(x) AS b FROM t) GROUP BY ALL)
    SELECT vec_id, round(max(c) FILTER (WHERE o >= 2) - max(c) FILTER (WHERE o < 2), 6) AS margin FROM c GROUP BY vec_id
    """,
)
def profile_margin(spark, sf):
    """The real flips' best correlation less the controls'."""
    m = W.margin(F.col("u"), F.col("v"), ["mirrored", "turned_mirrored"], ["same", "turned"])
    return _all_pairs(spark, sf).select("vec_id", F.round(m, 6).alias("margin"))


@register(
    "pooled_medians",
    f"""
    WITH w AS (SELECT page, top, "left" AS l, regexp_replace(lower(w), '[^0-9a-z]', '', 'g') AS token FROM ({_WORDS})),
    u AS (SELECT page, token, min(l) AS l, min(top) AS t FROM w WHERE length(token) >= 4 GROUP BY 1, 2 HAVING count(*) = 1)
    SELECT token, count(*) AS pages, round(median(l), 6) AS l, round(median(t), 6) AS t, count(*) >= 8 AS shared, round(coalesce(nullif(median(t), 0), 0.012::DOUBLE), 6) AS height
    FROM u GROUP BY 1 HAVING count(*) >= 3 AND max(l) - min(l) <= 0.6 AND max(t) - min(t) <= 0.6
    """,
)
def pooled_medians(spark, sf):
    """Tokens once on a page, pooled by exact medians, with floors for support and spread."""
    words = _words(spark, sf).select("page", "top", "left", S.norm("w").alias("token")).where("length(token) >= 4")
    once = words.groupBy("page", "token").agg(F.count(F.lit(1)).alias("n"), F.min("left").alias("l"), F.min("top").alias("t")).where("n = 1")
    pooled = once.groupBy("token").agg(F.count(F.lit(1)).alias("pages"), F.median("l").alias("ml"), F.median("t").alias("mt"), (F.max("l") - F.min("l")).alias("sl"), (F.max("t") - F.min("t")).alias("st"))
    kept = pooled.where("pages >= 3 AND sl <= 0.6 AND st <= 0.6")
    return kept.select("token", "pages", F.round("ml", 6).alias("l"), F.round("mt", 6).alias("t"), (F.col("pages") >= 8).alias("shared"), F.round(F.coalesce(F.nullif("mt", F.lit(0.0)), F.lit(0.012)), 6).alias("height"))
