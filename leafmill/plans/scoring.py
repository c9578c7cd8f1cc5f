"""Queries that score predictions against labels, and the statistics about them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import stats
from ..sources.scans import table
from .catalogue import register

# a rule's prediction of quality, and a cheaper one
_RULE = "CASE WHEN n_chars > 400 AND instr(text, '!!') = 0 THEN 1 ELSE 0 END"
_CHEAP = "CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END"


def _rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", F.when((F.col("n_chars") > 400) & (F.instr("text", "!!") == 0), 1).otherwise(0).alias("rule"), F.when(F.col("n_chars") > 1500, 1).otherwise(0).alias("cheap"))
    return docs.join(table(spark, sf, "labels"), "doc_id")


_SCORED = f"SELECT doc_id, lang, source, n_chars, {_RULE} AS rule, {_CHEAP} AS cheap, quality, toxic FROM documents JOIN labels USING (doc_id)"


@register(
    "stratum_case",
    """
    SELECT stratum, count(*) AS n, min(n_chars) AS shortest, max(n_chars) AS longest FROM (
      SELECT n_chars, CASE WHEN l.doc_id IS NULL THEN 'parse_failure' WHEN n_chars > 20000 THEN 'oversize' WHEN lang = 'en' AND toxic = 1 THEN 'en_toxic'
             WHEN lang = 'en' AND quality = 0 THEN 'en_poor' WHEN instr(text, '|') > 0 THEN 'table' END AS stratum
      FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY stratum
    """,
)
def stratum_case(spark, sf):
    """Strata by fixed precedence, none as null; how many in each."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels").withColumn("seen", F.lit(True)), "doc_id", "left")
    en = F.col("lang") == "en"
    stratum = (
        F.when(F.col("seen").isNull(), "parse_failure")
        .when(F.col("n_chars") > 20_000, "oversize")
        .when(en & (F.col("toxic") == 1), "en_toxic")
        .when(en & (F.col("quality") == 0), "en_poor")
        .when(F.instr("text", "|") > 0, "table")
    )
    return rows.select(stratum.alias("stratum"), "n_chars").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))


@register(
    "code_map_unique",
    """
    SELECT n_name, min(code) AS code, count(*) AS customers FROM (
      SELECT n_name, c_nationkey + CASE WHEN c_custkey % 17 = 0 AND c_nationkey % 2 = 0 THEN 100 ELSE 0 END AS code FROM customer JOIN nation ON c_nationkey = n_nationkey)
    GROUP BY n_name HAVING count(DISTINCT code) = 1
    """,
)
def code_map_unique(spark, sf):
    """A3: codes learned from the rows; names with two codes are left out."""
    bad = (F.col("c_custkey") % 17 == 0) & (F.col("c_nationkey") % 2 == 0)
    rows = table(spark, sf, "customer").withColumn("code", F.col("c_nationkey") + F.when(bad, 100).otherwise(0)).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    counts = rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))
    return stats.learned_map(rows, "n_name", "code").join(counts, "n_name").select("n_name", "code", "customers")


@register("confusion_matrix", f"SELECT quality, rule, lang, count(*) AS n FROM ({_SCORED}) GROUP BY ALL")
def confusion_matrix(spark, sf):
    """Labels against a rule."""
    return _rules(spark, sf).groupBy("quality", "rule", "lang").agg(F.count(F.lit(1)).alias("n"))


@register(
    "grouping_sets_outcome",
    """
    SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(half) = 0 THEN 'half' WHEN grouping(kind) = 0 THEN 'kind' ELSE 'overall' END AS split,
           coalesce(lang, half, kind, 'all') AS bucket, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, count(*) FILTER (WHERE n_chars > 1000) AS hits
    FROM (SELECT lang, CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS half, CASE WHEN n_chars > 5000 THEN 'long' ELSE 'short' END AS kind, n_chars FROM documents)
    GROUP BY GROUPING SETS ((), (lang), (half), (kind))
    """,
)
def grouping_sets_outcome(spark, sf):
    """A5: several groupings of one scan."""
    docs = table(spark, sf, "documents").select("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("half"), F.when(F.col("n_chars") > 5000, "long").otherwise("short").alias("kind"), "n_chars")
    split = F.when(F.grouping("lang") == 0, "lang").when(F.grouping("half") == 0, "half").when(F.grouping("kind") == 0, "kind").otherwise("overall")
    sets = [[], [F.col("lang")], [F.col("half")], [F.col("kind")]]
    out = docs.groupingSets(sets, "lang", "half", "kind").agg(split.alias("split"), F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.count_if(F.col("n_chars") > 1000).alias("hits"))
    return out.select("split", F.coalesce("lang", "half", "kind", F.lit("all")).alias("bucket"), "n", "chars", "hits")


@register(
    "score_rates",
    """
    WITH b AS (SELECT o_orderkey AS k, o_orderpriority AS w, o_orderkey % 6 AS f, CASE o_orderkey % 4 WHEN 0 THEN 'Rev. 4/1/83' WHEN 1 THEN 'REV 4-1-83.' WHEN 2 THEN 'Rev. 6/30/75' END AS rev FROM orders),
    r AS (SELECT k, w AS want, CASE f WHEN 0 THEN w WHEN 1 THEN upper(w) || '.' WHEN 2 THEN 'other' WHEN 4 THEN '1,000' END AS got, CASE WHEN f = 3 THEN 'illegible' WHEN f = 5 THEN 'blank' ELSE 'present' END AS got_status,
                 CASE WHEN k % 10 = 9 THEN 'blank' ELSE 'present' END AS want_status, rev FROM b),
    e AS (SELECT *, coalesce(nullif(regexp_replace(lower(rev), '[^0-9a-z]', '', 'g'), ''), 'unknown') AS era_key FROM r),
    l AS (SELECT era_key, first(rev ORDER BY length(rev), rev) AS era_label FROM e GROUP BY 1)
    SELECT coalesce(era_label, 'unknown') AS era, count(*) AS n, round(avg(CASE WHEN got_status = want_status THEN 1.0 ELSE 0.0 END), 6) AS status_correct,
           round(avg(CASE WHEN got_status = 'present' AND want_status = 'present' THEN CASE WHEN regexp_replace(lower(got), '[.,;:]+$', '') = lower(want) THEN 1.0 ELSE 0.0 END END), 6) AS value_equivalent,
           round(avg(CASE WHEN want_status = 'present' THEN CASE WHEN got_status = 'present' AND regexp_replace(lower(got), '[.,;:]+$', '') = lower(want) THEN 1.0 ELSE 0.0 END END), 6) AS recovered
    FROM e LEFT JOIN l USING (era_key) GROUP BY era_key, era_label
    """,
)
def score_rates(spark, sf):
    """Rates on three denominators by era; an era's label is its shortest spelling."""
    k, w, f = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderkey") % 6
    got = F.when(f == 0, w).when(f == 1, F.concat(F.upper(w), F.lit("."))).when(f == 2, "other").when(f == 4, "1,000")
    rev = F.when(k % 4 == 0, "Rev. 4/1/83").when(k % 4 == 1, "REV 4-1-83.").when(k % 4 == 2, "Rev. 6/30/75")
    status = F.when(f == 3, "illegible").when(f == 5, "blank").otherwise("present")
    rows = table(spark, sf, "orders").select(w.alias("want"), got.alias("got"), status.alias("got_status"), F.when(k % 10 == 9, "blank").otherwise("present").alias("want_status"), rev.alias("rev"))
    rows = stats.era_buckets(rows, "rev")
    want, have = F.col("want_status") == "present", F.col("got_status") == "present"
    same = S.equivalent("want", "got")
    return rows.groupBy(F.coalesce("era_label", F.lit("unknown")).alias("era")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(stats.rate(F.col("got_status") == F.col("want_status"), F.lit(True)), 6).alias("status_correct"),
        F.round(stats.rate(same, want & have), 6).alias("value_equivalent"),
        F.round(stats.rate(same & have, want), 6).alias("recovered"),
    )


@register(
    "stratified_estimate",
    """
    WITH s AS (SELECT d.lang, count(*) AS f, count(l.doc_id) AS n, count(*) FILTER (WHERE quality = 1) AS h FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1),
    w AS (SELECT *, f / (SELECT sum(f) FROM s) AS w, h / n AS p FROM s)
    SELECT round(sum(w * p), 8) AS proportion, round(sqrt(sum(w * w * CASE WHEN n >= f THEN 0 ELSE (1 - n / f) * p * (1 - p) / (n - 1) END)), 8) AS standard_error,
           round(sqrt(sum(w * w * CASE WHEN n >= f THEN 0 ELSE (1 - n / f) * 0.25 / (n - 1) END)), 8) AS planned_error, CAST(sum(f) AS BIGINT) AS frame, CAST(sum(n) AS BIGINT) AS sampled
    FROM w
    """,
)
def stratified_estimate(spark, sf):
    """A frame-weighted proportion with its error, measured and planned."""
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    strata = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("frame_size"), F.count("quality").alias("sampled"), F.count_if(F.col("quality") == 1).alias("hits"))
    out = stats.stratified_proportion(strata)
    return out.select(*(F.round(c, 8).alias(c) for c in ("proportion", "standard_error", "planned_error")), "frame", "sampled")


@register(
    "domain_ratio",
    """
    WITH f AS (SELECT lang, count(*) AS frame FROM documents GROUP BY 1),
    d AS (SELECT lang, n_chars > 1000 AS inside, quality = 1 AS hit, frame / count(*) OVER (PARTITION BY lang) AS w FROM documents JOIN labels USING (doc_id) JOIN f USING (lang))
    SELECT round(sum(w) FILTER (WHERE inside), 6) AS weighted_members, round(sum(w) FILTER (WHERE inside AND hit) / sum(w) FILTER (WHERE inside), 8) AS ratio FROM d
    """,
)
def domain_ratio(spark, sf):
    """A ratio within a domain that cuts across the strata."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    drawn = docs.join(table(spark, sf, "labels"), "doc_id").join(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("frame")), "lang")
    out = stats.domain_ratio(drawn, "lang", "frame", F.col("quality") == 1, F.col("n_chars") > 1000)
    return out.select(F.round("weighted_members", 6).alias("weighted_members"), F.round("ratio", 8).alias("ratio"))


@register("bootstrap_interval")
def bootstrap_interval(spark, sf):
    """Rows only: the draws are hashes of this engine; tests hold the interval against its closed form."""
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return stats.bootstrap(rows, "lang", "doc_id", "quality")


@register(
    "mcnemar_paired",
    f"""
    WITH p AS (SELECT lang, count(*) FILTER (WHERE rule = quality AND cheap <> quality) AS b, count(*) FILTER (WHERE rule <> quality AND cheap = quality) AS c, count(*) AS n,
                      avg(CASE WHEN rule = quality THEN 1.0 ELSE 0.0 END) - avg(CASE WHEN cheap = quality THEN 1.0 ELSE 0.0 END) AS gain FROM ({_SCORED}) GROUP BY lang),
    t AS (SELECT *, CASE WHEN b + c = 0 THEN 1.0 ELSE least(1.0, 2 * list_sum(list_transform(generate_series(0, least(b, c)), lambda i: exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2))))) END AS p,
                 CASE WHEN b + c = 0 THEN 1.0 ELSE least(1.0, list_sum(list_transform(generate_series(0, CASE WHEN b < c THEN least(b, c) ELSE b END), lambda i: exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2))))) END AS p1 FROM p)
    SELECT lang, n, b, c, round(p, 8) AS two_sided, round(p1, 8) AS one_sided, CASE WHEN gain > 0.05 AND p < 0.05 THEN 'dear' ELSE 'cheap' END AS winner FROM t
    """,
)
def mcnemar_paired(spark, sf):
    """Two rules on the rows that both have labelled, and which wins."""
    a, b = F.col("rule") == F.col("quality"), F.col("cheap") == F.col("quality")
    pairs = _rules(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(a & ~b).alias("b"), F.count_if(~a & b).alias("c"), (F.count_if(a) - F.count_if(b)).alias("gain"))
    pairs = pairs.withColumn("p", stats.mcnemar(F.col("b"), F.col("c"))).withColumn("p1", stats.mcnemar_one_sided(F.col("b"), F.col("c")))
    return pairs.select("lang", "n", "b", "c", F.round("p", 8).alias("two_sided"), F.round("p1", 8).alias("one_sided"), stats.winner(F.col("gain") / F.col("n"), F.col("p")).alias("winner"))


@register(
    "intervals",
    """
    WITH s AS (SELECT lang, count(*) AS n, sum(quality) AS h FROM documents JOIN labels USING (doc_id) GROUP BY 1), z AS (SELECT *, h / n AS p, 1.959963984540054 AS z FROM s)
    SELECT lang, n, CAST(h AS BIGINT) AS hits, round((p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 8) AS low,
           round((p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n), 8) AS high, round(1 - pow(0.05, 1 / n), 8) AS zero_bound FROM z
    """,
)
def intervals(spark, sf):
    """Wilson intervals, and the bound where nothing was found."""
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("hits"))
    low, high = stats.wilson(F.col("hits"), F.col("n"))
    return rows.select("lang", "n", "hits", F.round(low, 8).alias("low"), F.round(high, 8).alias("high"), F.round(stats.zero_bound(F.col("n")), 8).alias("zero_bound"))


@register("interval_bisection")
def interval_bisection(spark, sf):
    """Rows only: upper bounds by bisection; tests hold them against the closed form and the binomial tail."""
    rows = table(spark, sf, "labels").groupBy((F.col("doc_id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
    return rows.select("k", "n", "hits", F.round(stats.upper_bound(F.col("hits"), F.col("n")), 6).alias("upper"))


@register(
    "cost_rollup",
    """
    WITH e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1),
    c AS (SELECT event_type, CAST(floor(value) AS BIGINT) AS tok FROM e WHERE value IS NOT NULL),
    g AS (SELECT event_type, count(*) AS calls, CAST(sum(tok) AS BIGINT) AS tokens, round(sum(tok) * 3.0 / 1e6, 9) AS cost_usd, round(avg(tok), 6) AS mean_tokens, max(tok) AS most FROM c GROUP BY 1)
    SELECT g.*, p.pages FROM g JOIN (SELECT event_type, first(k ORDER BY abs(k * 10 - mean_tokens), k) AS pages FROM g, unnest([1, 2, 4, 8]) AS u(k) GROUP BY 1) p USING (event_type)
    """,
)
def cost_rollup(spark, sf):
    """Cost over the latest entries, and the nearest page count, the smaller on a tie."""
    from ..sources.scans import latest

    rows = latest(table(spark, sf, "events"), ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    rows = rows.where("value IS NOT NULL").select("event_type", F.floor("value").alias("tok"))
    out = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("calls"), F.sum("tok").alias("tokens"), F.round(F.sum("tok") * 3.0 / 1e6, 9).alias("cost_usd"), F.round(F.avg("tok"), 6).alias("mean_tokens"), F.max("tok").alias("most"))
    nearest = F.array_min(F.transform(F.array(*map(F.lit, (1, 2, 4, 8))), lambda k: F.struct(F.abs(k * 10 - F.col("mean_tokens")).alias("d"), k.alias("k"))))
    return out.withColumn("pages", nearest["k"])


@register(
    "nearest_rank_p90",
    """
    WITH s AS (SELECT event_type, list_sort(list(value)) AS v FROM events WHERE value IS NOT NULL GROUP BY 1)
    SELECT event_type, len(v) AS n, round(v[1 + least(len(v) - 1, CAST(floor(len(v) * 0.9) AS BIGINT))], 8) AS p90, round(v[1 + len(v) // 2], 8) AS upper_median FROM s
    """,
)
def nearest_rank_p90(spark, sf):
    """Picks by rank, no interpolation."""
    rows = table(spark, sf, "events").select("event_type", "value")
    p90 = stats.ranked_pick(rows, ["event_type"], "value", 0.9).select("event_type", F.round("picked", 8).alias("p90"))
    middle = stats.ranked_pick(rows, ["event_type"], "value", 0.5, upper=True).select("event_type", F.round("picked", 8).alias("upper_median"))
    n = rows.where("value IS NOT NULL").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.join(p90, "event_type").join(middle, "event_type")


@register(
    "mode_first_seen",
    """
    SELECT user_id, event_type AS mode_value, n AS mode_count FROM (
      SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS r FROM events GROUP BY 1, 2) WHERE r = 1
    """,
)
def mode_first_seen(spark, sf):
    """The mode, of equals the first seen."""
    return stats.mode_first(table(spark, sf, "events"), ["user_id"], "event_type", "event_id")


@register(
    "sitting_score",
    """
    WITH j AS (SELECT doc_id, source, CASE WHEN toxic = 1 THEN 'different' WHEN quality = 0 THEN 'unsure' ELSE 'same' END AS verdict, doc_id % 4 <> 0 AS confirmed, doc_id % 13 / 13.0 AS margin FROM labels JOIN documents USING (doc_id)),
    s AS (SELECT source, count(*) AS pages FROM j GROUP BY 1 HAVING count(*) >= 2)
    SELECT verdict, count(*) AS n, count(*) FILTER (WHERE confirmed) AS confirmed, round(count(*) FILTER (WHERE confirmed) / count(*), 6) AS share, round(min(margin), 6) AS least, round(max(margin), 6) AS most, round(avg(margin), 6) AS mean
    FROM j JOIN s USING (source) GROUP BY 1
    """,
)
def sitting_score(spark, sf):
    """Judged pairs of groups that have two members, by verdict."""
    verdict = F.when(F.col("toxic") == 1, "different").when(F.col("quality") == 0, "unsure").otherwise("same")
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    rows = rows.select("source", verdict.alias("verdict"), (F.col("doc_id") % 4 != 0).alias("confirmed"), (F.col("doc_id") % 13 / 13.0).alias("margin"))
    two = rows.groupBy("source").agg(F.count(F.lit(1)).alias("pages")).where("pages >= 2")
    out = rows.join(two, "source", "left_semi").groupBy("verdict")
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if("confirmed").alias("confirmed"), F.round(stats.rate(F.col("confirmed"), F.lit(True)), 6).alias("share"), *(F.round(f("margin"), 6).alias(c) for f, c in ((F.min, "least"), (F.max, "most"), (F.avg, "mean"))))


@register(
    "arm_agreement",
    f"""
    WITH a AS (SELECT doc_id, rule FROM ({_SCORED}) WHERE doc_id % 5 <> 0), b AS (SELECT doc_id, cheap FROM ({_SCORED}) WHERE doc_id % 7 <> 0)
    SELECT CASE WHEN b.doc_id IS NULL THEN 'lost' WHEN a.doc_id IS NULL THEN 'gained' WHEN rule = cheap THEN 'agreed' ELSE 'changed' END AS outcome,
           CASE WHEN coalesce(a.doc_id, b.doc_id) % 2 = 0 THEN 'fuel' ELSE 'held_out' END AS part, count(*) AS n FROM a FULL JOIN b USING (doc_id) GROUP BY ALL
    """,
)
def arm_agreement(spark, sf):
    """What one arm found and the other didn't, by part."""
    rows = _rules(spark, sf)
    a, b = rows.where("doc_id % 5 <> 0").select("doc_id", "rule"), rows.where("doc_id % 7 <> 0").select("doc_id", "cheap")
    both = a.join(b, "doc_id", "full_outer")
    outcome = F.when(F.col("cheap").isNull(), "lost").when(F.col("rule").isNull(), "gained").when(F.col("rule") == F.col("cheap"), "agreed").otherwise("changed")
    return both.groupBy(outcome.alias("outcome"), F.when(F.col("doc_id") % 2 == 0, "fuel").otherwise("held_out").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "set_overlap",
    """
    WITH a AS (SELECT doc_id FROM documents WHERE n_chars > 800), b AS (SELECT doc_id FROM labels)
    SELECT 'intersect' AS op, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS s FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
    UNION ALL SELECT 'union', count(*), CAST(sum(doc_id) AS BIGINT) FROM (SELECT * FROM a UNION SELECT * FROM b)
    UNION ALL SELECT 'a_not_b', count(*), CAST(sum(doc_id) AS BIGINT) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_not_a', count(*), CAST(sum(doc_id) AS BIGINT) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    UNION ALL SELECT 'shares_token', count(*), CAST(sum(doc_id) AS BIGINT) FROM documents WHERE list_has_any(string_split(text, ' '), ['idiot', 'clown', 'der'])
    """,
)
def set_overlap(spark, sf):
    """Both differences, intersection, union without repeats, and overlap of token sets."""
    docs = table(spark, sf, "documents")
    a, b = docs.where("n_chars > 800").select("doc_id"), table(spark, sf, "labels").select("doc_id")
    token = docs.where(F.arrays_overlap(F.split("text", " "), F.array(*map(F.lit, ("idiot", "clown", "der"))))).select("doc_id")
    parts = {"intersect": a.intersect(b), "union": a.unionByName(b).dropDuplicates(["doc_id"]), "a_not_b": a.subtract(b), "b_not_a": b.join(a, "doc_id", "left_anti"), "shares_token": token}
    out = None
    for op, rows in parts.items():
        one = rows.agg(F.lit(op).alias("op"), F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("s"))
        out = one if out is None else out.unionByName(one)
    return out


@register("topk_limit", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND value IS NOT NULL ORDER BY value DESC, event_id LIMIT 12")
def topk_limit(spark, sf):
    """The first rows by value with a tie key: a top-k, no full sort."""
    return table(spark, sf, "events").where("event_type = 'click' AND value IS NOT NULL").select("event_id", "user_id", "value").orderBy(F.col("value").desc(), "event_id").limit(12)
