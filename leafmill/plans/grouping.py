"""Queries that put pages together."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grouping as G
from ..sources.scans import table
from .catalogue import register

_PAGES = """
WITH c AS (SELECT conv_id AS file, turn AS page, role = 'user' AS face, role = 'assistant' AS candidate, conv_id AS k, turn AS t FROM conversations),
p AS (SELECT file, page, face, candidate, CASE WHEN (k + t) % 4 = 0 THEN NULL WHEN (k * 3 + t) % 11 = 0 THEN 'w2' ELSE 'g1' END AS family,
  CASE WHEN (k + t) % 6 <> 0 THEN k % 7 + t // 4 END AS lease, CASE WHEN (k * 3 + t) % 7 <> 0 THEN k % 5 + t // 4 END AS operator, CASE WHEN (t * 5 + k) % 4 <> 0 THEN (t // 3) % 2 END AS district,
  CASE WHEN (k + 2 * t) % 5 = 0 THEN k % 9 END AS well, CAST(NULL AS BIGINT) AS api, CASE WHEN t % 3 = 0 THEN (k + t // 6) % 4 END AS field_name, CASE WHEN (k * t) % 3 <> 0 THEN t // 5 END AS total_depth FROM c)
"""
_FIELDS = ("lease", "operator", "district", "well", "api", "field_name", "total_depth")
_AGREED = "coalesce(array_to_string([" + ", ".join(f"CASE WHEN c.{f} = f.{f} THEN '{f}' END" for f in _FIELDS) + "], ','), '')"
_COUNT = " + ".join(f"coalesce(CAST(c.{f} = f.{f} AS INT), 0)" for f in _FIELDS)
_VETO = " OR ".join(f"coalesce(c.{f} <> f.{f}, false)" for f in _FIELDS[:-1])
_PAIRS = f"{_PAGES}, s AS (SELECT c.file, c.page, f.page AS parent, coalesce(c.family <> f.family, false) AS fam, {_VETO} AS veto, {_COUNT} AS n, {_AGREED} AS agreed FROM p c JOIN p f ON c.file = f.file AND f.face AND c.candidate)"


def pages(spark, sf):
    k, t = F.col("conv_id"), F.col("turn")
    div = lambda x, n: F.floor(x / n)
    values = F.struct(
        F.when((k + t) % 6 != 0, k % 7 + div(t, 4)).alias("lease"),
        F.when((k * 3 + t) % 7 != 0, k % 5 + div(t, 4)).alias("operator"),
        F.when((t * 5 + k) % 4 != 0, div(t, 3) % 2).alias("district"),
        F.when((k + 2 * t) % 5 == 0, k % 9).alias("well"),
        F.lit(None).cast("long").alias("api"),
        F.when(t % 3 == 0, (k + div(t, 6)) % 4).alias("field_name"),
        F.when((k * t) % 3 != 0, div(t, 5)).alias("total_depth"),
    )
    family = F.when((k + t) % 4 == 0, None).when((k * 3 + t) % 11 == 0, "w2").otherwise("g1")
    return table(spark, sf, "conversations").select(k.alias("file"), t.alias("page"), (F.col("role") == "user").alias("face"), (F.col("role") == "assistant").alias("candidate"), family.alias("family"), values.alias("values"))


@register("field_agreement", f"{_PAIRS} SELECT file, page, parent, fam AS family_conflict, veto AS contradicted, n AS agreements, agreed FROM s")
def field_agreement(spark, sf):
    """G1 compare and score, J10 P7 P8 P9 P10: candidates against faces."""
    pairs = G.score_pairs(pages(spark, sf))
    return pairs.select("file", "page", "parent", "family_conflict", "contradicted", F.size("fields").alias("agreements"), F.array_join("fields", ",").alias("agreed"))


@register(
    "group_documents",
    f"""{_PAIRS}, o AS (SELECT *, NOT fam AND NOT veto AND n >= 2 AS ok FROM s), b AS (SELECT *, max(CASE WHEN ok THEN n END) OVER (PARTITION BY file, page) AS best FROM o),
    w AS (SELECT file, page, count(*) FILTER (WHERE ok AND n = best) AS winners, min(parent) FILTER (WHERE ok AND n = best) AS parent, min(agreed) FILTER (WHERE ok AND n = best) AS agreed, bool_or(veto AND NOT fam) AS veto, bool_or(fam) AS fam FROM b GROUP BY 1, 2),
    r AS (SELECT p.file, p.page, p.face, CASE WHEN winners = 1 THEN parent END AS parent, CASE WHEN winners = 1 THEN agreed END AS agreed,
      CASE WHEN p.face THEN NULL WHEN NOT p.candidate THEN 'not_a_candidate' WHEN winners IS NULL THEN 'no_face' WHEN winners > 1 THEN 'tie' WHEN winners = 1 THEN NULL WHEN veto THEN 'contradicted' WHEN fam THEN 'different_form' ELSE 'below_threshold' END AS reason
      FROM p LEFT JOIN w USING (file, page)),
    d AS (SELECT *, CASE WHEN parent IS NOT NULL THEN count(*) OVER (PARTITION BY file, parent) END AS slot FROM r)
    SELECT file, page, face, CASE WHEN slot > 1 THEN NULL ELSE parent END AS parent, CASE WHEN slot > 1 THEN NULL ELSE agreed END AS agreed, CASE WHEN slot > 1 THEN 'slot_tie' ELSE reason END AS reason FROM d
    """,
)
def group_documents(spark, sf):
    """G1 form (b)."""
    return G.group_documents(pages(spark, sf))


@register("group_documents_exact")
def group_documents_exact(spark, sf):
    """G1 form (a): rows only: a sequential walk; a test holds it against form (b) where no face can be a child."""
    return G.group_exact(pages(spark, sf))
