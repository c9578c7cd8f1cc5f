"""Queries over tokens, dates, numbers, codes and JSON bodies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import forms
from ..sources import images
from ..sources.scans import table
from .catalogue import register


@register(
    "norm_fold_tokens",
    """
    WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents),
         n AS (SELECT doc_id, w, regexp_replace(lower(w), '[^0-9a-z]', '', 'g') AS n FROM w)
    SELECT doc_id, count(*) AS printed, count(DISTINCT translate(n, 'oli', '011')) AS folded,
           count(*) FILTER (WHERE length(n) >= 4 OR length(regexp_replace(w, '[^0-9]', '', 'g')) >= 3) AS anchors,
           min(translate(n, 'oli', '011')) AS first_token, CAST(sum(length(n)) AS BIGINT) AS signs
    FROM n WHERE n <> '' GROUP BY doc_id
    """,
)
def norm_fold_tokens(spark, sf):
    """Normalised and folded tokens per document."""
    # a document's words are in its own row: arrays need no shuffle
    words = F.filter(F.transform(F.split("text", " "), lambda w: F.struct(w.alias("w"), S.norm(w).alias("n"))), lambda p: p["n"] != "")
    rows = table(spark, sf, "documents").select("doc_id", words.alias("words"))
    rows = rows.where(F.size("words") > 0).withColumn("folded", F.array_distinct(F.transform("words", lambda p: F.translate(p["n"], "oli", "011"))))
    anchors = F.size(F.filter("words", lambda p: S.is_anchor(p["w"]))).cast("long")
    signs = F.aggregate("words", F.lit(0).cast("long"), lambda total, p: total + F.length(p["n"]))
    return rows.select("doc_id", F.size("words").cast("long").alias("printed"), F.size("folded").cast("long").alias("folded"), anchors.alias("anchors"), F.array_min("folded").alias("first_token"), signs.alias("signs"))


@register(
    "link_tokens",
    """
    WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS token FROM pages)
    SELECT token, count(DISTINCT page_id) AS pages, count(*) AS links FROM t WHERE token <> '' GROUP BY token
    """,
)
def link_tokens(spark, sf):
    """A2: tokens found by a pattern over markup, and the pages that have each."""
    found = table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("token")).where("token <> ''")
    return found.groupBy("token").agg(F.countDistinct("page_id").alias("pages"), F.count(F.lit(1)).alias("links"))


@register(
    "header_region_tokens",
    # what each kind of header says, written down kind by kind: this engine's patterns have no lookahead
    """
    WITH h AS (SELECT p_partkey AS k, p_partkey % 11 AS kind, p_size AS n, p_size % 7 AS m FROM part),
    t AS (SELECT k, kind, n, CASE kind WHEN 0 THEN [concat('W-', n)] WHEN 1 THEN [concat('P-', n)] WHEN 2 THEN ['FORM 3'] WHEN 4 THEN [concat('W-', n, 'A')] WHEN 5 THEN ['GWT-1'] WHEN 7 THEN ['G-1'] WHEN 9 THEN ['SW-1', 'W-1A']
                        ELSE [] END AS own FROM h)
    SELECT k, array_to_string(list_sort(own), ' ') AS own_tokens,
           CASE kind WHEN 0 THEN CASE WHEN n = 2 THEN 'w2' WHEN n IN (1, 3, 12, 15) THEN concat('w', n) WHEN n IN (4, 5, 6) THEN 'w4_family' END WHEN 1 THEN CASE WHEN n IN (4, 5, 12, 15, 17) THEN concat('p', n) END
                WHEN 2 THEN 'completion_face_legacy' WHEN 4 THEN CASE n WHEN 1 THEN 'w1' WHEN 4 THEN 'w4_family' END WHEN 5 THEN 'completion_face_legacy' WHEN 7 THEN 'g1' WHEN 9 THEN 'ws1_sw1' END AS first_class,
           CASE WHEN kind = 5 THEN 'A_revision_legible' WHEN kind = 7 OR (kind = 0 AND n = 2) THEN 'B_form_number_legible' ELSE 'C_neither' END AS legibility
    FROM t
    """,
)
def header_region_tokens(spark, sf):
    """A page's own form numbers, in lists of references and out, the class of the first, and what the header shows."""
    headers = _headers(table(spark, sf, "part")).withColumn("own", forms.header_tokens("header"))
    return headers.select("k", F.array_join(F.array_sort("own"), " ").alias("own_tokens"), forms.token_class(F.get("own", F.lit(0))).alias("first_class"), forms.legibility(F.col("header"), F.col("own")).alias("legibility"))


def _headers(part):
    n, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 11
    text = (
        F.when(kind == 0, F.concat(F.lit("RAILROAD COMMISSION OIL AND GAS DIVISION FORM W-"), n, F.lit(" WELL RECORD")))
        .when(kind == 1, F.concat(F.lit("filed with Forms W-2, G-1, and GT-1 for wells P-"), n))
        .when(kind == 2, "Form 3 POTENTIAL TEST")
        .when(kind == 3, "FORM 12-4 COMPLETION REPORT")
        .when(kind == 4, F.concat(F.lit("SURVEY A-38 W-"), n, F.lit("A")))
        .when(kind == 5, "WWW-1 APR-23 FORM GWT-1 Rev. 6-1-54")
        .when(kind == 6, F.concat(F.lit("copy of RRC Form G-5 shown on W-"), n))
        .when(kind == 7, "see W-2 A-12, G-1")
        .when(kind == 8, F.concat("p_name", F.lit(" REPORT")))
        .when(kind == 9, "SW-1 W-1A\npursuant to Form P-4")
        .otherwise(F.concat(F.repeat(F.lit("x "), 200), F.lit("W-2")))
    )
    return part.select(F.col("p_partkey").alias("k"), "p_size", text.alias("header"))


@register(
    "page_strata",
    """
    WITH p AS (SELECT p_partkey AS k, CASE p_partkey % 7 WHEN 0 THEN 'g1' WHEN 1 THEN 'w2' WHEN 2 THEN 'w15' WHEN 3 THEN 'other_form' WHEN 4 THEN 'plat_map' WHEN 5 THEN 'g1' ELSE 'w2' END AS cls, p_partkey % 5 AS part, p_size AS n FROM part)
    SELECT k, CASE WHEN n % 10 = 0 THEN 'I_parse_failure' WHEN n % 10 = 9 THEN 'H_oversize' WHEN cls IN ('g1', 'w2') AND part NOT IN (0, 1) THEN 'F_completion_non_face' WHEN cls = 'g1' AND n % 4 = 0 THEN 'B_g1_face_ocr_g1' WHEN cls = 'g1' THEN 'A_g1_face_ocr_silent'
           WHEN cls = 'w2' AND n % 4 = 1 THEN 'E_w2_face_ocr_w2' WHEN cls = 'w2' AND n % 4 = 2 THEN 'D_w2_face_ocr_w15' WHEN cls = 'w2' THEN 'C_w2_face_ocr_silent' WHEN cls = 'w15' AND part IN (0, 1) THEN 'G_confusable_not_completion'
           WHEN cls = 'other_form' AND part <> 3 THEN 'G_confusable_not_completion' END AS stratum,
           cls IN ('g1', 'w2') AND n % 10 <> 9 AND part <> 3 AND part <> 4 AS eligible
    FROM p
    """,
)
def page_strata(spark, sf):
    """Strata by fixed precedence, and pages to extract from."""
    k, n = F.col("p_partkey"), F.col("p_size")
    pick = lambda i, *names: F.get(F.array(*map(F.lit, names)), i.cast("int"))
    cls = pick(k % 7, "g1", "w2", "w15", "other_form", "plat_map", "g1", "w2")
    part = pick(k % 5, "face", "face", "sec_ii", "back_instructions", "unknown")
    tokens = F.when(n % 4 == 0, F.array(F.lit("G-1"))).when(n % 4 == 1, F.array(F.lit("W-15"), F.lit("W-2"))).when(n % 4 == 2, F.array(F.lit("W-15"))).otherwise(F.array().cast("array<string>"))
    large = n % 10 == 9
    return table(spark, sf, "part").select(k.alias("k"), forms.stratum(cls, part, large, n % 10 == 0, tokens).alias("stratum"), images.eligible(cls, part, large).alias("eligible"))


@register(
    "word_boxes",
    """
    WITH c AS (SELECT c_custkey AS k, c_nationkey AS x, unnest(string_split(c_name, '#')) AS text, generate_subscripts(string_split(c_name, '#'), 1) - 1 AS n FROM customer WHERE c_custkey % 9 <> 0)
    SELECT k, CAST(n AS INT) AS n, text, (x + 10 * n) / 612.0 AS l, 20.5 / 792.0 AS t, (x + 10 * n + 8.25) / 612.0 AS r, 30.0 / 792.0 AS b FROM c
    """,
)
def word_boxes(spark, sf):
    """Words with boxes out of a page's markup; a page without a size has none."""
    part = lambda w, i: F.concat(F.lit('<word xMin="'), (F.col("c_nationkey") + 10 * i).cast("string"), F.lit('" yMin="20.5" xMax="'), (F.col("c_nationkey") + 10 * i + 8.25).cast("string"), F.lit('" yMax="30.0">'), w, F.lit("</word>\n"))
    size = F.when(F.col("c_custkey") % 9 == 0, "<page>\n").otherwise('<page width="612" height="792">\n')
    pages = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.concat(size, F.array_join(F.transform(F.split("c_name", "#"), part), ""), F.lit("</page>")).alias("markup"))
    return images.word_boxes(pages, "k", "markup").select("k", "n", "text", *(F.col(f"box.{s}").alias(s) for s in "ltrb"))


@register(
    "report_regions",
    """
    WITH p AS (SELECT p_partkey AS k, p_size AS n, p_partkey % 6 AS kind FROM part)
    SELECT k, 'well.depth' AS field, CASE WHEN kind IN (4, 5) THEN CASE kind WHEN 4 THEN 'blank' ELSE 'missing' END ELSE 'present' END AS status, CASE WHEN kind < 4 THEN CAST(n AS VARCHAR) END AS value, CASE WHEN k % 4 = 0 THEN 2 ELSE 0 END AS dropped,
           CASE WHEN kind = 5 THEN 'unknown status' END AS error, CASE WHEN kind = 0 THEN CASE n % 3 WHEN 1 THEN 9 WHEN 2 THEN 10 ELSE 9 END WHEN kind = 3 THEN 9 END AS page, CASE WHEN kind IN (0, 3) THEN 0.25 END AS t
    FROM p
    """,
)
def report_regions(spark, sf):
    """Page numbers of an answer as pages of the file, boxes without an extent as none, unknown keys counted at both levels."""
    k, n = F.col("p_partkey"), F.col("p_size").cast("string")
    kind = k % 6
    status = F.when(kind == 4, "blank").when(kind == 5, "odd").otherwise("present")
    # kind 0 has a page number (0: no such page), 1 a box without height, 2 one of three numbers, 3 no page number
    place = F.when(kind == 0, F.concat(F.lit(', "page": '), (F.col("p_size") % 3).cast("string"), F.lit(', "box": [0.1, 0.25, 0.5, 0.75]'))).when(kind == 1, ', "page": 1, "box": [0.1, 0.25, 0.5, 0.25]').when(kind == 2, ', "box": [0.1, 0.25, 0.5]').otherwise(', "box": ["0.1", 0.25, 0.5, 0.3]')
    stray = F.when(k % 4 == 0, ', "odd": {}').otherwise("")
    body = F.concat(F.lit('{"well": {"depth": {"status": "'), status, F.lit('", "value": " '), n, F.lit(' "'), place, F.lit("}"), stray, F.lit("}"), stray, F.lit("}"))
    reports = table(spark, sf, "part").select(k.alias("k"), body.alias("body"), F.array(F.lit(9), F.lit(10)).alias("pages"))
    out = forms.flatten_report(reports, "k", "body", {"well": ["depth"]}, {}, "pages")
    return out.select("k", "field", "status", "value", "dropped", "error", F.col("region.page").alias("page"), F.col("region.box.t").alias("t"))


@register(
    "identity_reads",
    """
    WITH c AS (SELECT c_custkey AS k, c_custkey % 5 AS kind, c_name AS name FROM customer),
    f AS (SELECT k, kind, name, unnest(['lease_name', 'well_number']) AS field FROM c),
    r AS (SELECT *, CASE WHEN field = 'well_number' THEN 'not_on_this_form' WHEN kind = 1 THEN 'illegible' WHEN kind = 2 THEN 'blank' WHEN kind = 3 THEN NULL ELSE 'present' END AS status FROM f)
    SELECT k, field, status, CASE WHEN status = 'present' THEN name END AS raw, CASE WHEN status = 'present' THEN 'box 3' END AS found_in, coalesce(status = 'present', false) AS located, CASE WHEN status IS NULL THEN 'unknown status' END AS error,
           CASE WHEN kind = 4 THEN 'Austin 1-2-60' ELSE '' END AS stamps
    FROM r
    """,
)
def identity_reads(spark, sf):
    """Identity answers: present without a reading is illegible, absent ones keep no text, stamps need office and date."""
    k = F.col("c_custkey")
    kind = k % 5
    status = F.when(kind == 2, "blank").when(kind == 3, "odd").otherwise(" present ")
    entry = F.struct(status.alias("status"), F.when(kind == 1, "").otherwise(F.col("c_name")).alias("raw"), F.lit(" box 3 ").alias("found_in"))
    mark = lambda office, date: F.struct(F.lit(office).alias("office"), F.lit(date).alias("date"))
    body = F.to_json(F.struct(entry.alias("lease_name"), F.when(kind == 4, F.array(mark(" Austin", "1-2-60 "), mark("Midland", ""), mark(None, "1-2-60"))).alias("received_stamps")))
    reads = table(spark, sf, "customer").select(k.alias("k"), body.alias("body"))
    marks = reads.select("k", F.array_join(F.transform(forms.stamps("body"), lambda s: F.concat_ws(" ", s["office"], s["date"])), "; ").alias("stamps"))
    return forms.identity(reads, "k", "body", ["lease_name", "well_number"]).join(marks, "k")


@register(
    "url_parse",
    """
    WITH u AS (SELECT page_id, url, concat(page_id, '-', page_id % 3, '-', page_id % 4) AS pid FROM pages)
    SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page_arg,
           concat(regexp_replace(regexp_extract(url, '^([^:]*://[^/?#]*)', 1), '/+$', ''), '/', regexp_replace('//img/a.png', '^/+', '')) AS asset,
           CASE WHEN page_id % 4 <> 0 THEN page_id % 3 END AS file_part, CASE WHEN page_id % 4 <> 0 THEN page_id % 4 END AS page_part
    FROM u
    """,
)
def url_parse(spark, sf):
    """Parts of URLs and of page ids; an id with page 0 is none."""
    p = F.col("page_id")
    parts = S.page_parts(S.page_id("page_id", p % 3, p % 4))
    base = F.regexp_extract("url", "^([^:]*://[^/?#]*)", 1)
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), S.extract("url", "[?&]page=([0-9]+)").alias("page_arg"), S.asset_url(base, F.lit("//img/a.png")).alias("asset"), parts["file"].alias("file_part"), parts["page"].alias("page_part"))


_DATES = """
SELECT o_orderkey AS k, CASE o_orderkey % 8
         WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 2 THEN strftime(o_orderdate, '%-m-%-d-%y')
         WHEN 3 THEN strftime(o_orderdate, '%b %-d, %Y') WHEN 4 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 5 THEN concat('13/', day(o_orderdate), '/75')
         WHEN 6 THEN 'illegible' ELSE strftime(o_orderdate, '%-m.%-d.%y') END AS s, o_orderdate FROM orders
"""


@register(
    "parse_dates",
    f"""
    WITH d AS ({_DATES}),
    p AS (SELECT k, s, CASE WHEN k % 8 IN (5, 6) THEN NULL
            WHEN k % 8 IN (2, 7) THEN make_date(CASE WHEN year(o_orderdate) % 100 <= 30 THEN 2000 ELSE 1900 END + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate))
            ELSE CAST(o_orderdate AS DATE) END AS d, o_orderdate FROM d)
    SELECT k, s, d AS parsed, CASE WHEN k % 8 IN (3, 4) THEN strftime(o_orderdate, '%Y-%m') WHEN k % 8 <> 6 THEN array_to_string(regexp_extract_all(s, '[0-9]+')[2:3], '-') END AS stamp,
           CASE WHEN k % 8 IN (0, 1, 2, 5, 7) THEN array_to_string(list_transform(regexp_extract_all(s, '[0-9]+'), lambda x: CAST(CAST(x AS INT) % 100 AS VARCHAR)), '-') WHEN k % 8 <> 6 THEN regexp_replace(lower(s), '[^0-9a-z]', '', 'g') END AS grouping_form
    FROM p
    """,
)
def parse_dates(spark, sf):
    """Dates in several writings, stamps by month, and the form in which groupings compare them."""
    d = F.col("o_orderdate")
    day, month = F.dayofmonth(d).cast("string"), F.month(d).cast("string")
    yy = F.date_format(d, "yy")
    kind = F.col("o_orderkey") % 8
    s = (
        F.when(kind == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(d, "M/d/yyyy"))
        .when(kind == 2, F.concat_ws("-", month, day, yy))
        .when(kind == 3, F.date_format(d, "MMM d, yyyy"))
        .when(kind == 4, F.date_format(d, "MMMM d, yyyy"))
        .when(kind == 5, F.concat(F.lit("13/"), day, F.lit("/75")))
        .when(kind == 6, F.lit("illegible"))
        .otherwise(F.concat_ws(".", month, day, yy))
    )
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), s.alias("s"))
    named = F.when(F.col("k") % 8 != 6, S.field_value(F.lit("date"), "s"))
    return rows.select("k", "s", S.parse_date("s").alias("parsed"), S.month_year("s").alias("stamp"), named.alias("grouping_form"))


@register(
    "parse_depths",
    """
    WITH d AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, CAST(l_quantity AS INT) * 317 AS v, l_orderkey % 5 AS kind FROM lineitem)
    SELECT k, n, CASE kind WHEN 0 THEN CAST(v AS DOUBLE) WHEN 1 THEN CAST(v AS DOUBLE) WHEN 2 THEN CAST(-v AS DOUBLE) WHEN 3 THEN v + 0.5 END AS depth,
           CASE WHEN kind <> 4 THEN CAST(v AS VARCHAR) || CASE WHEN kind = 3 THEN '5' ELSE '' END END AS digits, count(*) AS c
    FROM d GROUP BY ALL
    """,
)
def parse_depths(spark, sf):
    """Depths in several writings."""
    v = F.col("l_quantity").cast("int") * 317
    kind = F.col("l_orderkey") % 5
    text = F.when(kind == 0, F.concat(F.format_number(v, 0), F.lit(" ft"))).when(kind == 1, F.concat(F.lit("T.D. "), v.cast("string"))).when(kind == 2, F.concat(F.lit("-"), v.cast("string"))).when(kind == 3, F.concat(v.cast("string"), F.lit(".5'"))).otherwise("none")
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), text.alias("s"))
    return rows.groupBy("k", "n", S.parse_depth("s").alias("depth"), S.field_value(F.lit("depth"), "s").alias("digits")).agg(F.count(F.lit(1)).alias("c"))


@register(
    "parse_api_codes",
    """
    WITH c AS (SELECT c_custkey AS k, lpad(CAST(30 + c_nationkey AS VARCHAR), 2, '0') AS st, lpad(CAST(c_custkey % 500 AS VARCHAR), 3, '0') AS co, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS un FROM customer)
    SELECT k, CASE WHEN k % 4 < 3 THEN st END AS state, CASE WHEN k % 4 < 3 THEN co END AS county, CASE WHEN k % 4 < 3 THEN un END AS number,
           CASE WHEN k % 4 = 3 THEN co END AS index_county, CASE WHEN k % 4 = 3 THEN un END AS index_number, k % 4 < 3 AND st = '42' AS in_state
    FROM c
    """,
)
def parse_api_codes(spark, sf):
    """Well numbers in running text, and quoted index tokens."""
    k = F.col("c_custkey")
    st, co, un = F.lpad((F.col("c_nationkey") + 30).cast("string"), 2, "0"), F.lpad((k % 500).cast("string"), 3, "0"), F.lpad((k % 100000).cast("string"), 5, "0")
    text = F.when(k % 4 == 0, F.concat_ws("-", st, co, un)).when(k % 4 == 1, F.concat(F.lit("API No. "), st, co, un)).when(k % 4 == 2, F.concat(st, F.lit(" - "), co, F.lit("/ "), un)).otherwise(F.concat(F.lit("ft '"), co, un, F.lit("'")))
    rows = table(spark, sf, "customer").select(k.alias("k"), text.alias("s"))
    api, index = S.parse_api("s"), S.index_token("s")
    return rows.select("k", *(api[f].alias(f) for f in ("state", "county", "number")), index["county"].alias("index_county"), index["number"].alias("index_number"), F.coalesce(api["state"] == "42", F.lit(False)).alias("in_state"))


@register(
    "strict_json_labels",
    """
    WITH b AS (SELECT o_orderkey AS k, o_orderkey % 9 AS fault, CASE o_orderkey % 4 WHEN 0 THEN 'g1' WHEN 1 THEN 'w2' WHEN 2 THEN 'completion_face_legacy' ELSE 'letter_memo' END AS cls, o_custkey % 3 <> 0 AS legible, o_custkey % 5 = 0 AS w15, o_custkey % 7 <> 0 AS face FROM orders),
    r AS (SELECT *, fault NOT IN (3, 4, 5, 6, 8) AS fine, face AND cls IN ('g1', 'w2') AND NOT legible AS unread, face AND cls <> 'letter_memo' AND w15 AS other FROM b)
    SELECT k, CASE fault WHEN 3 THEN 'no object' WHEN 4 THEN 'missing key' WHEN 5 THEN 'unknown class' WHEN 6 THEN 'not a boolean' WHEN 8 THEN 'unknown orientation' END AS error,
           CASE WHEN fine THEN CASE WHEN other THEN 'w15' WHEN unread THEN 'completion_face_unknown_form' ELSE cls END END AS form_class, CASE WHEN fine THEN CASE WHEN face THEN 'face' ELSE 'continuation' END END AS part,
           CASE WHEN fine AND (other OR unread) THEN cls END AS was, fine AND unread AND NOT other AS routed
    FROM r
    """,
)
def strict_json_labels(spark, sf):
    """Strict bodies; an illegible number makes a face unknown, a header token corrects the class."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    fault = k % 9
    cls = F.get(F.array(*map(F.lit, ("g1", "w2", "completion_face_legacy", "letter_memo"))), (k % 4).cast("int"))
    legible = F.when(c % 3 != 0, "true").otherwise("false")
    rest = F.concat(F.lit(', "part": "'), F.when(c % 7 != 0, "face").otherwise("continuation"), F.lit('", "orientation": "'), F.when(fault == 8, "left").otherwise("up"), F.lit('", "alt_class": null, "confidence": "high"'))
    body = F.concat(F.lit('{"form_class": "'), F.when(fault == 5, "g7").otherwise(cls), F.lit('", "form_number_legible": '), F.when(fault == 6, '"yes"').otherwise(legible), F.when(fault == 4, "").otherwise(rest), F.lit("}"))
    text = F.when(fault == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(fault == 2, F.concat(F.lit("The page: "), body)).when(fault == 3, F.lit("I can't read it")).otherwise(body)
    rows = table(spark, sf, "orders").select(k.alias("k"), text.alias("body"), F.when(c % 5 == 0, F.array(F.lit("W-15"))).otherwise(F.array().cast("array<string>")).alias("header"))
    return forms.page_labels(rows, "body", "header").select("k", "error", "form_class", "part", "was", "routed")


def _report_flatten(spark, sf, orders):
    orders = orders.select(F.col("o_orderkey").alias("k"), "o_orderstatus", "o_orderpriority")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k"), "l_linenumber").agg(F.min("l_partkey").alias("p"))
    tables = lines.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "p"))).alias("rows"))
    rows = F.transform("rows", lambda r: F.struct(F.struct(F.lit("present").alias("status"), r["p"].cast("string").alias("value")).alias("key")))
    # every fifth report has a value in the table's place: such a slot gives no rows
    part = F.when(F.col("k") % 5 == 0, F.lit('{"status": "present", "value": "x"}')).otherwise(F.coalesce(F.to_json(rows), F.lit("[]")))
    status = F.when(F.col("o_orderstatus") == "P", "illegible").otherwise("present")
    blank = F.when(F.col("k") % 3 == 0, "blank").otherwise("present")
    head = F.to_json(F.struct(F.struct(status.alias("status"), F.col("o_orderstatus").alias("value")).alias("status"), F.struct(blank.alias("status"), F.col("o_orderpriority").alias("value")).alias("priority")))
    body = F.concat(F.lit('{"document": '), head, F.lit(', "parts": '), part, F.lit(', "stray": 1}'))
    reports = orders.join(tables, "k", "left").select("k", body.alias("body"))
    return forms.flatten_report(reports, "k", "body", {"document": ["status", "priority"]}, {"parts": ["key"]}).select("k", "field", "status", "value", "dropped")


@register(
    "report_flatten",
    """
    WITH r AS (SELECT o_orderkey AS k, o_totalprice, o_orderpriority, o_orderstatus FROM orders),
         l AS (SELECT l_orderkey AS k, CAST(l_linenumber AS INT) AS i, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2),
         t AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS i, part FROM l)
    SELECT k, 'document.status' AS field, CASE WHEN o_orderstatus = 'P' THEN 'illegible' ELSE 'present' END AS status, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS value, 1 AS dropped FROM r
    UNION ALL SELECT k, 'document.priority', CASE WHEN k % 3 = 0 THEN 'blank' ELSE 'present' END, CASE WHEN k % 3 <> 0 THEN o_orderpriority END, 1 FROM r
    UNION ALL SELECT k, concat('parts[', i, '].key'), 'present', CAST(part AS VARCHAR), 1 FROM t WHERE k IN (SELECT k FROM r) AND k % 5 <> 0
    """,
)
def report_flatten(spark, sf):
    """Nested reports as one row per dotted field; absence keeps no text, unknown keys are counted."""
    return _report_flatten(spark, sf, table(spark, sf, "orders"))


@register(
    "report_flatten_whole",
    """
    WITH r AS (SELECT o_orderkey AS k, o_totalprice, o_orderpriority, o_orderstatus FROM orders),
         l AS (SELECT l_orderkey AS k, CAST(l_linenumber AS INT) AS i, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2),
         t AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS i, part FROM l)
    SELECT k, 'document.status' AS field, CASE WHEN o_orderstatus = 'P' THEN 'illegible' ELSE 'present' END AS status, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS value, 1 AS dropped FROM r
    UNION ALL SELECT k, 'document.priority', CASE WHEN k % 3 = 0 THEN 'blank' ELSE 'present' END, CASE WHEN k % 3 <> 0 THEN o_orderpriority END, 1 FROM r
    UNION ALL SELECT k, concat('parts[', i, '].key'), 'present', CAST(part AS VARCHAR), 1 FROM t WHERE k IN (SELECT k FROM r) AND k % 5 <> 0
    """,
)
def report_flatten_whole(spark, sf):
    """report_flatten over every report."""
    return _report_flatten(spark, sf, table(spark, sf, "orders"))


@register(
    "vocab_normalise",
    """
    WITH p AS (SELECT p_partkey AS k, trim(p_type) AS t, CASE WHEN p_partkey % 10 = 0 THEN '  ' WHEN p_partkey % 10 = 1 THEN 'Form 2' WHEN p_partkey % 10 = 2 THEN 'G-1' WHEN p_partkey % 10 = 3 THEN 'W4 Family' WHEN p_partkey % 10 = 4 THEN 'GWT-1' ELSE p_type END AS s FROM part)
    SELECT k, nullif(trim(s), '') AS cleaned, CASE k % 10 WHEN 1 THEN 'completion_face_legacy' WHEN 2 THEN 'g1' WHEN 3 THEN 'w4_family' WHEN 4 THEN 'other_form' END AS form_class,
           CASE WHEN k % 10 NOT IN (0, 1, 2, 3, 4) THEN 'unknown class' WHEN k % 10 = 0 THEN 'empty' END AS error, concat(k, '-', k % 5, ' p', k % 3 + 1, '+p', k % 3 + 2) AS pair, CAST(k % 3 + 2 AS INT) AS second_page
    FROM p
    """,
)
def vocab_normalise(spark, sf):
    """Class names by vocabulary, then by alias; labels of pairs and back."""
    k = F.col("p_partkey")
    s = F.when(k % 10 == 0, "  ").when(k % 10 == 1, "Form 2").when(k % 10 == 2, "G-1").when(k % 10 == 3, "W4 Family").when(k % 10 == 4, "GWT-1").otherwise(F.col("p_type"))
    rows = table(spark, sf, "part").select(k.alias("k"), s.alias("s"))
    pair = F.format_string("%d-%d p%d+p%d", F.col("k"), F.col("k") % 5, F.col("k") % 3 + 1, F.col("k") % 3 + 2)
    cls, error = forms.form_class("s")
    return rows.select("k", S.clean("s").alias("cleaned"), cls.alias("form_class"), error.alias("error"), pair.alias("pair"), S.extract(pair, r"\+p(\d+)$").cast("int").alias("second_page"))
