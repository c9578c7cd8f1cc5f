"""One query for each validation rule, and their counts. Faults are put in by arithmetic on keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules
from ..sources.scans import table
from .catalogue import register

_DOCS = """
WITH o AS (SELECT o_orderkey AS k, c_nationkey AS n, n_name, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
q AS (SELECT k, n, n_name AS county, CASE k % 12 WHEN 2 THEN '41' ELSE '42' END AS st, lpad(CAST(100 + n + CASE WHEN k % 29 = 0 THEN 300 ELSE 0 END AS VARCHAR), 3, '0') AS co, lpad(CAST(k % 100000 AS VARCHAR), 5, '0') AS un,
   k % 12 NOT IN (0, 1) AS parsed, CASE WHEN k % 5 <> 0 THEN CASE WHEN k % 31 = 0 THEN '999' ELSE lpad(CAST(100 + n AS VARCHAR), 3, '0') END END AS index_county, CASE WHEN k % 37 = 0 THEN '77777' ELSE CAST(k % 100000 AS VARCHAR) END AS index_number,
   CASE WHEN k % 13 <> 0 THEN d - 10 + CAST(k % 15 AS INT) END AS permit, d AS commenced, d - 3 + CAST(k % 20 AS INT) AS drilled, d - 2 + CAST(k % 25 AS INT) AS completion, d - 3 + CAST(k % 25 AS INT) + CAST(k % 9 AS INT) AS test,
   1000.0 + k % 100 AS total_depth, CASE WHEN k % 6 <> 0 THEN 1000.0 + k % 103 END AS plug_back, 900.0 + k % 250 AS pay_bottom, CASE WHEN k % 4 = 0 THEN 1090.0 END AS tubing_depth, 1000.0 + k % 110 AS packer FROM o)
"""


def documents(spark, sf):
    """A wide table of extracted values with faults at fixed keys; null stands for any absence."""
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    k, n, d = F.col("o_orderkey"), F.col("c_nationkey"), F.col("o_orderdate").cast("date")
    days = lambda start, by: F.date_add(start, by.cast("int"))
    api = F.concat_ws("-", F.when(k % 12 == 2, "41").otherwise("42"), F.lpad((n + 100 + F.when(k % 29 == 0, 300).otherwise(0)).cast("string"), 3, "0"), F.lpad((k % 100000).cast("string"), 5, "0"))
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))).alias("lines"))
    lines = lines.select(
        "doc_id",
        F.transform("lines", lambda x: F.when(x["l_partkey"] % 5 != 0, x["l_quantity"] * 21)).alias("casing"),
        F.transform("lines", lambda x: F.struct((x["l_partkey"] % 500).alias("from"), (x["l_suppkey"] % 480 + 20 + F.when(x["l_partkey"] % 11 == 0, 1000).otherwise(0)).alias("to"))).alias("intervals"),
    )
    cell = F.transform(F.sequence(F.lit(0), (k % 4).cast("int")), lambda i: F.struct((i * 0.1 + F.when(k % 5 == 0, i * 0.02).otherwise(0.0)).alias("l"), F.lit(0.2).alias("t"), (i * 0.1 + 0.1).alias("r"), F.lit(0.3).alias("b")))
    docs = orders.select(
        k.alias("doc_id"),
        F.when(k % 12 == 0, "no number").when(k % 12 == 1, None).otherwise(api).alias("api"),
        F.col("n_name").alias("county"),
        (k % 29 != 0).alias("learn"),
        F.when(k % 5 != 0, F.when(k % 31 == 0, "999").otherwise(F.lpad((n + 100).cast("string"), 3, "0"))).alias("index_county"),
        F.when(k % 37 == 0, "77777").otherwise((k % 100000).cast("string")).alias("index_number"),
        F.when(k % 13 != 0, days(d, k % 15 - 10)).alias("permit"),
        d.alias("commenced"),
        days(d, k % 20 - 3).alias("drilled"),
        days(d, k % 25 - 2).alias("completion"),
        days(d, k % 25 - 3 + k % 9).alias("test"),
        (k % 100 + 1000.0).alias("total_depth"),
        F.when(k % 6 != 0, k % 103 + 1000.0).alias("plug_back"),
        (k % 250 + 900.0).alias("pay_bottom"),
        F.transform(F.array(F.lit(0), F.lit(1)), lambda i: F.struct((F.when(k % 4 == 0, 1090.0) - i * 40).alias("depth"), (k % 110 + 1000.0 - i * 15).alias("packer"))).alias("tubing"),
        cell.alias("boxes"),
    )
    return docs.join(lines, "doc_id", "left")


_LINES = "SELECT l_orderkey AS k, row_number() OVER w - 1 AS i, CASE WHEN l_partkey % 5 <> 0 THEN l_quantity * 21 END AS depth, l_partkey % 500 AS f, l_suppkey % 480 + 20 + CASE WHEN l_partkey % 11 = 0 THEN 1000 ELSE 0 END AS t FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)"

_SQL = {
    "api.structure": f"{_DOCS} SELECT k AS doc_id, 'api' AS fields FROM q WHERE k % 12 = 0",
    "api.state": f"{_DOCS} SELECT k AS doc_id, 'api' AS fields FROM q WHERE parsed AND st <> '42'",
    "api.county_prefix": f"{_DOCS}, m AS (SELECT county, min(co) AS code FROM q WHERE parsed AND st = '42' AND k % 29 <> 0 GROUP BY 1 HAVING count(DISTINCT co) = 1) SELECT k AS doc_id, 'api,county' AS fields FROM q JOIN m USING (county) WHERE parsed AND st = '42' AND co <> code",
    "api.index_county": f"{_DOCS} SELECT k AS doc_id, 'api' AS fields FROM q WHERE parsed AND co <> index_county",
    "api.index_unique": f"{_DOCS} SELECT k AS doc_id, 'api' AS fields FROM q WHERE parsed AND regexp_replace(un, '^0+', '') <> regexp_replace(index_number, '^0+', '')",
    "date.date_permit_issued_before_drilling_commenced": f"{_DOCS} SELECT k AS doc_id, 'permit,commenced' AS fields FROM q WHERE permit > commenced",
    "date.drilling_commenced_before_drilling_completed": f"{_DOCS} SELECT k AS doc_id, 'commenced,drilled' AS fields FROM q WHERE commenced > drilled",
    "date.completed_before_started": f"{_DOCS} SELECT k AS doc_id, 'commenced,completion' AS fields FROM q WHERE commenced > completion",
    "date.test_before_completion": f"{_DOCS} SELECT k AS doc_id, 'test,completion' AS fields FROM q WHERE test < completion",
    "depth.below_total": f"{_DOCS}, l AS ({_LINES}), v AS (SELECT k, unnest(['plug_back', 'pay_bottom', 'tubing[0].depth', 'tubing[1].depth']) AS f, unnest([plug_back, pay_bottom, tubing_depth, tubing_depth - 40]) AS v FROM q"
    " UNION ALL SELECT k, concat('casing[', i, ']'), depth FROM l UNION ALL SELECT k, concat('intervals[', i, '].to'), t FROM l)"
    " SELECT k AS doc_id, concat(f, ',total_depth') AS fields FROM v JOIN q USING (k) WHERE v > total_depth",
    "depth.casing_order": f"{_DOCS}, l AS ({_LINES}), p AS (SELECT *, last(depth IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM l) SELECT k AS doc_id, concat('casing[', i, ']') AS fields FROM p WHERE depth < before AND k IN (SELECT k FROM q)",
    "depth.packer_below_tubing": f"{_DOCS} SELECT k AS doc_id, concat('tubing[', i, '].packer,tubing[', i, '].depth') AS fields FROM q, unnest([0, 1]) AS u(i) WHERE packer - i * 15 > tubing_depth - i * 40",
    "depth.interval_inverted": f"{_DOCS}, l AS ({_LINES}) SELECT k AS doc_id, concat('intervals[', i, ']') AS fields FROM l WHERE f > t AND k IN (SELECT k FROM q)",
    "geometry.schematic_grid": f"{_DOCS} SELECT k AS doc_id, 'boxes' AS fields FROM q WHERE k % 4 >= 2 AND k % 5 <> 0",
}


def _one(name: str):
    def query(spark, sf):
        found = rules.findings(documents(spark, sf), [name])
        return found.select("doc_id", F.concat_ws(",", "fields").alias("fields"), "rule", "severity")

    query.__doc__ = f"2.11: {name}"
    return query


for _name, (_severity, _) in rules.RULES.items():
    register("rule_" + _name.replace(".", "_"), f"SELECT *, '{_name}' AS rule, '{_severity}' AS severity FROM ({_SQL[_name]})")(_one(_name))


@register("rule_findings", " UNION ALL ".join(f"SELECT '{r[0]}' AS severity, '{n}' AS rule, count(*) AS n, count(DISTINCT doc_id) AS documents FROM ({_SQL[n]}) HAVING count(*) > 0" for n, r in rules.RULES.items()))
def rule_findings(spark, sf):
    """2.11 A29 O1 O2: findings by severity and rule."""
    found = rules.findings(documents(spark, sf))
    return rules.rule_counts(found)
