"""Queries that write by a sink and read by a source, so that both are compared with the tables they started from."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..sources import images, paged, scans, sinks, work
from ..sources.scans import table
from .catalogue import register


@register("jsonl_appends", "SELECT doc_id, lang, n_chars FROM documents WHERE n_chars > 500")
def jsonl_appends(spark, sf):
    """Two appends of JSON lines, read with a schema; the filter is given to the scan."""
    path = work.folder(spark, "jsonl")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    for half in (0, 1):
        sinks.append_jsonl(docs.where(F.col("doc_id") % 2 == half), path)
    return scans.read_jsonl(spark, path, "doc_id bigint, lang string, n_chars bigint").where("n_chars > 500")


@register(
    "partitions_overwritten",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'",
)
def partitions_overwritten(spark, sf):
    """K2: a run's output takes the place of the last one, whole; a partition that it lacks is gone."""
    path = work.folder(spark, "run")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    sinks.overwrite(orders, path, ["o_orderstatus"])
    sinks.overwrite(orders.where("o_orderstatus <> 'P'"), path, ["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "o_orderpriority")


@register(
    "cache_appends",
    """
    SELECT concat('k', o_orderkey) AS key, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 THEN concat('second ', o_orderpriority) ELSE concat('first ', o_orderpriority) END AS body
    FROM orders WHERE o_orderkey % 7 <> 0 OR (o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0)
    """,
)
def cache_appends(spark, sf):
    """Cut off answers aren't stored; of what is, the last of each key is read."""
    path, k = work.folder(spark, "cache"), F.col("o_orderkey")
    answers = table(spark, sf, "orders").select(F.concat(F.lit("k"), k.cast("string")).alias("key"), "o_orderpriority", k.alias("k"))
    for seq, (name, cut) in enumerate((("first ", 7), ("second ", 5))):
        some = answers if seq == 0 else answers.where("k % 3 = 0")
        rows = some.select("key", F.concat(F.lit(name), "o_orderpriority").alias("body"), F.when(F.col("k") % cut == 0, "max_tokens").otherwise("end").alias("stop_reason"), F.lit(seq).alias("seq"))
        sinks.cache_put(rows, path)
    return scans.latest(spark.read.parquet(path), ["key"], [F.desc("seq")]).select("key", "body")


@register(
    "sheets_extended",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS item, c_mktsegment AS note, CASE WHEN c_custkey % 4 <> 0 THEN concat('"', c_name, '", seen') END AS verdict FROM customer
    """,
)
def sheets_extended(spark, sf):
    """Sheets of other columns are united as text; an empty one may be extended, by rows that it lacks."""
    k = F.col("c_custkey").cast("string")
    rows = table(spark, sf, "customer")
    verdict = F.concat(F.lit('"'), F.col("c_name"), F.lit('", seen'))
    paths = [work.folder(spark, "sheet") for _ in range(2)]
    sinks.write_sheet(rows.where("c_custkey % 4 = 0").select(k.alias("item"), F.col("c_mktsegment").alias("note")), paths[0])
    sinks.write_sheet(rows.where("c_custkey % 4 IN (1, 2)").select(k.alias("item"), F.col("c_mktsegment").alias("note"), verdict.alias("verdict")), paths[1])
    old = scans.read_sheet(spark, paths)
    sinks.refuse_if_filled(scans.read_sheet(spark, paths[0]).withColumn("verdict", F.lit(None).cast("string")), ["verdict"])
    new = rows.where("c_custkey % 4 IN (2, 3)").select(k.alias("item"), F.col("c_mktsegment").alias("note"), verdict.alias("verdict"))
    return sinks.extend(old, new, ["item"])


@register(
    "templates_replaced",
    """
    SELECT n_regionkey AS region, CASE WHEN n_regionkey = 2 THEN 0 ELSE count(*) END AS members, CASE WHEN n_regionkey = 2 THEN 'none' ELSE min(n_name) END AS first FROM nation GROUP BY n_regionkey
    """,
)
def templates_replaced(spark, sf):
    """K6: one JSON document a key; a later write replaces the documents of its own keys."""
    path = work.folder(spark, "templates")
    per = table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.count(F.lit(1)).alias("members"), F.min("n_name").alias("first"))
    sinks.write_template(per, path, ["region"])
    sinks.write_template(per.where("region = 2").withColumn("members", F.lit(0).cast("long")).withColumn("first", F.lit("none")), path, ["region"])
    body = F.from_json("value", "region bigint, members bigint, first string")
    return spark.read.text(path).select(body.alias("b")).select("b.*")


@register(
    "sealed_rows",
    """SELECT p_partkey, p_size, sha256(concat('{"p_name":"', p_name, '","p_partkey":', p_partkey, ',"p_size":', p_size, '}')) AS seal, p_partkey % 10 = 0 AS broken FROM part""",
)
def sealed_rows(spark, sf):
    """K7: rows sealed by the hash of their columns; a row changed afterwards is found."""
    rows = sinks.sealed(table(spark, sf, "part").select("p_partkey", "p_size", "p_name"), ["p_size", "p_name", "p_partkey"])
    changed = rows.withColumn("p_size", F.when(F.col("p_partkey") % 10 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    broken = sinks.broken_seals(changed, ["p_partkey", "p_size", "p_name"]).select("p_partkey", F.lit(True).alias("broken"))
    return rows.join(broken, "p_partkey", "left").select("p_partkey", "p_size", "seal", F.coalesce("broken", F.lit(False)).alias("broken"))


@register(
    "binary_files",
    "SELECT n_nationkey AS k, left(sha256(concat('%PDF ', n_name, chr(10), n_regionkey, chr(10))), 16) AS doc_hash, strlen(concat('%PDF ', n_name, chr(10), n_regionkey, chr(10))) AS bytes, concat('%PDF ', n_name, chr(10), n_regionkey) AS text FROM nation WHERE n_nationkey % 5 <> 0",
)
def binary_files(spark, sf):
    """Files with their hash and text; those that don't begin as they should are left out."""
    path = work.folder(spark, "files")
    body = F.concat(F.when(F.col("n_nationkey") % 5 != 0, "%PDF ").otherwise("html "), F.col("n_name"), F.lit("\n"), F.col("n_regionkey").cast("string"))
    table(spark, sf, "nation").select("n_nationkey", body.alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    files = scans.read_binary(spark, f"{path}/*/*.txt", b"%PDF")
    texts = images.texts(files, lambda content: content.decode()).where("error IS NULL").select("path", "text")
    key = F.regexp_extract("path", r"n_nationkey=(\d+)", 1).cast("int")
    return files.join(texts, "path").select(key.alias("k"), "doc_hash", F.col("length").alias("bytes"), "text")


def nations(options: dict, page: int) -> dict:
    """A transport that needs no network: the answers come with the options."""
    items, size = json.loads(options["items"]), int(options["pagesize"])
    return {"total": len(items), "items": items[(page - 1) * size : page * size]}


@register("paged_listing", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation")
def paged_listing(spark, sf):
    """A listing read page by page, a partition a page."""
    paged.register(spark)
    # the transport's answers are the 25 rows of a table of fixed size
    items = [{"id": r.n_nationkey, "name": r.n_name} for r in table(spark, sf, "nation").select("n_nationkey", "n_name").collect()]
    load = spark.read.format("paged").options(transport="leafmill.plans.storage:nations", items=json.dumps(items), pagesize="4")
    return load.load().select("id", F.get_json_object("item", "$.name").alias("name"))


@register(
    "sheet_outlines",
    """
    SELECT p_partkey AS k, CASE WHEN p_size % 13 > 5 AND p_partkey % 6 <> 0 THEN 3 END AS l, CASE WHEN p_size % 13 > 5 AND p_partkey % 6 <> 0 THEN p_partkey % 4 END AS t, CASE WHEN p_size % 13 > 5 AND p_partkey % 6 <> 0 THEN 16 END AS r,
           CASE WHEN p_size % 13 > 5 AND p_partkey % 6 <> 0 THEN least(12, p_partkey % 4 + p_size % 13 + 1) END AS b
    FROM part
    """,
)
def sheet_outlines(spark, sf):
    """The box of rows and columns of an image that are mostly bright; an image that is dark or no image has none."""
    k, n = F.col("p_partkey"), F.col("p_size") % 13
    dark, lit = F.repeat(F.lit("00"), 16), F.concat(F.repeat(F.lit("00"), 3), F.repeat(F.lit("C8"), 13))
    top = k % 4
    lines = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda y: F.when((y >= top) & (y <= top + n), lit).otherwise(dark))
    head = F.when(k % 6 == 0, "P4").otherwise("P5")
    content = F.concat(F.concat(head, F.lit("\n16 12\n255\n")).cast("binary"), F.unhex(F.array_join(lines, "")))
    files = table(spark, sf, "part").select(k.cast("string").alias("path"), content.alias("content"))
    return images.sheet_bounds(files).select(F.col("path").cast("long").alias("k"), "l", "t", "r", "b")
