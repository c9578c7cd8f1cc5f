"""Queries over manifests, sheets, caches and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import scans
from ..sources.scans import table
from .catalogue import register


@register(
    "census_rollup",
    """
    SELECT d.lang AS form_class, count(*) AS pages, count(DISTINCT d.source) AS records,
           count(*) FILTER (WHERE coalesce(l.toxic, 0) = 0 AND d.n_chars > 200) AS eligible,
           count(*) FILTER (WHERE l.quality = 1) AS high_confidence
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.lang
    """,
)
def census_rollup(spark, sf):
    """Pages, distinct records, eligible and confident pages per class."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    eligible = (F.coalesce("toxic", F.lit(0)) == 0) & (F.col("n_chars") > 200)
    rows = docs.select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id", "left")
    return rows.groupBy(F.col("lang").alias("form_class")).agg(F.count(F.lit(1)).alias("pages"), F.countDistinct("source").alias("records"), F.count_if(eligible).alias("eligible"), F.count_if(F.col("quality") == 1).alias("high_confidence"))


@register(
    "manifest_explode",
    """
    WITH f AS (SELECT l_orderkey AS r, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS file_index,
                      CAST(l_quantity AS INT) % 4 AS pages FROM lineitem)
    SELECT CAST(r AS VARCHAR) AS record_id, CAST(file_index AS INT) AS file_index, pages, CAST(p AS INT) AS page, concat(r, '-', file_index, '-', p) AS page_id,
           CAST(sum(CASE WHEN p = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY file_index, p) % 2 AS INT) AS shade
    FROM f, unnest(generate_series(1, pages)) AS u(p) WHERE pages >= 1
    """,
)
def manifest_explode(spark, sf):
    """Records to files to pages; shade toggles where the file changes."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    files = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_quantity").cast("int") % 4).alias("pages"), F.row_number().over(w).alias("n"))
    manifest = files.groupBy(F.col("l_orderkey").cast("string").alias("record_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "pages"))), lambda f: F.struct(f["pages"].alias("pages"))).alias("files"))
    pages = scans.explode_manifest(manifest)
    by = Window.partitionBy("record_id").orderBy("file_index", "page")
    changed = F.when(F.lag("file_index").over(by).eqNullSafe(F.col("file_index")), 0).otherwise(1)
    return pages.withColumn("c", changed).withColumn("shade", (F.sum("c").over(by) % 2).cast("int")).drop("c")


@register("resume_anti", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def resume_anti(spark, sf):
    """Records without a fetched file."""
    done = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return scans.resume(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), done, ["o_orderkey"])


@register(
    "reconcile_full_outer",
    """
    SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'unexpected' ELSE 'matched' END AS outcome, count(*) AS n,
           CAST(sum(coalesce(d.doc_id, l.doc_id)) AS BIGINT) AS key_sum, count(*) > 200000 AS implausible
    FROM (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0) d FULL JOIN labels l USING (doc_id) GROUP BY 1
    """,
)
def reconcile_full_outer(spark, sf):
    """Expected against got, both ways, with the count that would abort a run."""
    want, got = table(spark, sf, "documents").where("doc_id % 3 <> 0").select(F.col("doc_id").alias("w")), table(spark, sf, "labels").select(F.col("doc_id").alias("g"))
    both = want.join(got, F.col("w") == F.col("g"), "full_outer")
    outcome = F.when(F.col("g").isNull(), "missing").when(F.col("w").isNull(), "unexpected").otherwise("matched")
    return both.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("w", "g")).alias("key_sum")).withColumn("implausible", F.col("n") > 200_000)


@register(
    "last_entry_wins",
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
)
def last_entry_wins(spark, sf):
    """The latest entry of each key."""
    rows = scans.latest(table(spark, sf, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return rows.select("user_id", "event_id", "event_type", "value")


@register(
    "doc_hash_key",
    "SELECT doc_id, substr(sha256(text), 1, 16) AS doc_hash, substr(sha256(concat(doc_id, '|', lang, '|', source)), 1, 16) AS cache_key, concat(substr(sha256(text), 1, 16), '-', n_chars % 7, '-', lang) AS response_key FROM documents",
)
def doc_hash_key(spark, sf):
    """Content hashes and cache keys."""
    return table(spark, sf, "documents").select("doc_id", S.key_hash("text").alias("doc_hash"), S.key_hash("doc_id", "lang", "source").alias("cache_key"), F.concat_ws("-", S.key_hash("text"), (F.col("n_chars") % 7).cast("string"), "lang").alias("response_key"))


@register(
    "lookup_dedup",
    """
    WITH s AS (SELECT s_name, s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS last_n, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS first_n FROM supplier)
    SELECT n_nationkey, n_name, r_name, coalesce(l.s_suppkey, 0) AS last_supplier, coalesce(f.s_suppkey, 0) AS first_supplier, coalesce(c.version, 'current') AS version
    FROM nation JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN s l ON l.s_nationkey = n_nationkey AND l.last_n = 1 LEFT JOIN s f ON f.s_nationkey = n_nationkey AND f.first_n = 1
    LEFT JOIN (SELECT c_nationkey, first(c_mktsegment ORDER BY c_custkey) AS version FROM customer WHERE c_acctbal < -990 GROUP BY 1) c ON c_nationkey = n_nationkey
    """,
)
def lookup_dedup(spark, sf):
    """Lookups by key, last wins or first wins, a default where nothing is recorded."""
    suppliers = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey")
    last = scans.latest(suppliers, ["s_nationkey"], [F.col("s_suppkey").desc()]).select(F.col("s_nationkey").alias("n_nationkey"), F.col("s_suppkey").alias("last_supplier"))
    first = scans.latest(suppliers, ["s_nationkey"], [F.col("s_suppkey")]).select(F.col("s_nationkey").alias("n_nationkey"), F.col("s_suppkey").alias("first_supplier"))
    version = table(spark, sf, "customer").where("c_acctbal < -990").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.min_by("c_mktsegment", "c_custkey").alias("version"))
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    out = nations.join(last, "n_nationkey", "left").join(first, "n_nationkey", "left").join(version, "n_nationkey", "left")
    return out.select("n_nationkey", "n_name", "r_name", F.coalesce("last_supplier", F.lit(0)).alias("last_supplier"), F.coalesce("first_supplier", F.lit(0)).alias("first_supplier"), F.coalesce("version", F.lit("current")).alias("version"))


@register(
    "split_form_feed",
    """
    WITH f AS (SELECT doc_id, CAST(n_chars % 5 AS INT) AS pages, string_split(text, '. ') AS parts FROM documents)
    SELECT doc_id, CAST(p AS INT) AS page, coalesce(parts[p], '') AS page_text, CASE WHEN len(parts) = pages THEN pages ELSE 0 END AS one_each
    FROM f, unnest(generate_series(1, pages)) AS u(p)
    """,
)
def split_form_feed(spark, sf):
    """Texts dealt out to pages; a page past the text is empty."""
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 5).cast("int").alias("pages"), F.replace("text", F.lit(". "), F.lit("\f")).alias("t"))
    rows = scans.split_pages(docs, F.col("t"), F.col("pages"))
    same = F.when(F.size(F.split("t", "\f", -1)) == F.col("pages"), F.col("pages")).otherwise(0)
    return rows.select("doc_id", "page", "page_text", same.alias("one_each"))


@register(
    "sheet_union",
    """
    SELECT doc_id, quality, toxic, CAST(NULL AS VARCHAR) AS note FROM labels
    UNION ALL SELECT doc_id, NULL, NULL, trim(' seen in ' || source || ' ') FROM documents WHERE doc_id % 9 = 0
    """,
)
def sheet_union(spark, sf):
    """Sheets of differing columns in one."""
    more = table(spark, sf, "documents").where("doc_id % 9 = 0").select("doc_id", F.trim(F.concat(F.lit(" seen in "), "source", F.lit(" "))).alias("note"))
    return table(spark, sf, "labels").unionByName(more, allowMissingColumns=True).select("doc_id", "quality", "toxic", "note")


@register(
    "versioned_cache",
    """
    WITH c AS (SELECT *, CAST(event_id % 3 AS INT) AS version FROM events WHERE event_id % 11 <> 0),
         l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM c WHERE version = 2) WHERE n = 1)
    SELECT u.user_id, l.event_id, l.value, l.event_id IS NULL AS recompute, l.value IS NOT NULL AND l.value < 5 AS empty_result
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN l USING (user_id)
    """,
)
def versioned_cache(spark, sf):
    """The cache of the current version; keys without an entry are to be made again, empty ones aren't."""
    events = table(spark, sf, "events")
    cache = events.where("event_id % 11 <> 0").withColumn("version", (F.col("event_id") % 3).cast("string"))
    now = scans.latest(scans.cached(cache, "2"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_id", "value")
    out = events.select("user_id").distinct().join(now, "user_id", "left")
    return out.select("user_id", "event_id", "value", F.col("event_id").isNull().alias("recompute"), F.coalesce(F.col("value") < 5, F.lit(False)).alias("empty_result"))


@register(
    "provider_misses",
    "SELECT d.doc_id, l.quality, CASE WHEN l.doc_id IS NULL THEN 'no response' END AS error, l.doc_id IS NOT NULL AS cached FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def provider_misses(spark, sf):
    """Every request has a row; a miss is an error, not a gap."""
    out = scans.answered(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return out.select("doc_id", "quality", "error", "cached")
