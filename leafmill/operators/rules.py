"""Deterministic validation rules over one row per document.

Every rule reads present values only, which a null column stands for otherwise, so absence never makes a finding. Input
columns: doc_id, api (text), index_county, index_number, county, dates, total_depth and other depths, casing (array of
depths), tubing (array of depth, packer), intervals (array of from, to), boxes. A rule is an expression that gives the
fields of each of its findings in a document, so all rules together read a document once and move nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import stats

STATE = "42"
DEPTHS = ("plug_back", "pay_bottom")
RULES: dict[str, tuple[str, Callable[[], Column]]] = {}
#: The one rule that reads more than its document: the codes of counties, learned from all.
LEARNED = "api.county_prefix"


def rule(name: str, severity: str):
    def keep(f):
        RULES[name] = (severity, f)
        return f

    return keep


def _api(part: str) -> Column:
    """A part of the number, parsed once a document."""
    return F.col("_api")[part]


def _when(broken: Column, *fields: str) -> Column:
    return F.when(broken, F.array(F.array(*map(F.lit, fields))))


def _later(first: str, second: str) -> Column:
    return _when(F.col(first) > F.col(second), first, second)


def _rows(table: str, broken: Callable[[Column], Column], *names: str) -> Column:
    """A finding for each broken row of a table, its place in the names of its fields; names with no dot before them are the document's."""

    def fields(i: Column) -> Column:
        return F.array(*(F.concat(F.lit(f"{table}["), i.cast("string"), F.lit(f"]{n}")) if not n or n[0] == "." else F.lit(n) for n in names))

    return F.filter(F.transform(table, lambda x, i: F.when(broken(x), fields(i))), lambda f: f.isNotNull())


def _all(*found: Column) -> Column:
    none = F.array().cast("array<array<string>>")
    return F.concat(*(F.coalesce(f, none) for f in found))


@rule("api.structure", "error")
def api_structure():
    return _when(F.col("api").isNotNull() & F.col("_api").isNull(), "api")


@rule("api.state", "error")
def api_state():
    return _when(_api("state") != STATE, "api")


def learned_counties(docs: DataFrame) -> DataFrame:
    """A3: the county code of each county name, where all documents have the same; ``docs`` with the parsed number ``_api``."""
    rows = docs.select("county", _api("county").alias("code"), _api("state").alias("state")).where(F.col("county").isNotNull() & F.col("code").isNotNull() & (F.col("state") == STATE))
    return stats.learned_map(rows, "county", "code")


@rule(LEARNED, "error")
def api_county_prefix():
    return _when((_api("state") == STATE) & (_api("county") != F.col("_learned_code")), "api", "county")


@rule("api.index_county", "error")
def api_index_county():
    return _when(_api("county") != F.col("index_county"), "api")


@rule("api.index_unique", "warning")
def api_index_unique():
    bare = lambda c: F.regexp_replace(c, "^0+", "")
    return _when(bare(_api("number")) != bare(F.col("index_number")), "api")


@rule("date.date_permit_issued_before_drilling_commenced", "error")
def permit_before_start():
    return _later("permit", "commenced")


@rule("date.drilling_commenced_before_drilling_completed", "error")
def start_before_finish():
    return _later("commenced", "drilled")


@rule("date.completed_before_started", "error")
def start_before_completion():
    return _later("commenced", "completion")


@rule("date.test_before_completion", "warning")
def test_after_completion():
    return _when(F.col("test") < F.col("completion"), "test", "completion")


@rule("depth.below_total", "error")
def below_total():
    total = F.col("total_depth")
    single = (_when(F.col(c) > total, c, "total_depth") for c in DEPTHS)
    tables = (("casing", lambda x: x, ""), ("tubing", lambda x: x["depth"], ".depth"), ("intervals", lambda x: x["to"], ".to"))
    return _all(*single, *(_rows(t, lambda x, of=of: of(x) > total, n, "total_depth") for t, of, n in tables))


@rule("depth.casing_order", "warning")
def casing_order():
    """W1 within a document: the last known depth before each string, folded over the strings."""
    start = F.struct(F.lit(None).cast("double").alias("before"), F.array().cast("array<array<string>>").alias("found"))

    def step(acc: Column, row: Column) -> Column:
        field = F.array(F.concat(F.lit("casing["), row["i"].cast("string"), F.lit("]")))
        found = F.when(row["depth"] < acc["before"], F.concat(acc["found"], F.array(field))).otherwise(acc["found"])
        return F.struct(F.coalesce(row["depth"], acc["before"]).alias("before"), found.alias("found"))

    return F.aggregate(F.transform("casing", lambda d, i: F.struct(i.alias("i"), d.cast("double").alias("depth"))), start, step, lambda acc: acc["found"])


@rule("depth.packer_below_tubing", "error")
def packer_below_tubing():
    return _rows("tubing", lambda x: x["packer"] > x["depth"], ".packer", ".depth")


@rule("depth.interval_inverted", "error")
def interval_inverted():
    return _rows("intervals", lambda x: x["from"] > x["to"], "")


def even_grid(boxes: Column, slack: float = 0.005) -> Column:
    """Three boxes or more of one height band, each starting where the one before ended."""
    sorted_ = F.array_sort(boxes)
    pairs = F.arrays_zip(F.slice(sorted_, F.lit(1), F.size(sorted_) - 1).alias("a"), F.slice(sorted_, F.lit(2), F.size(sorted_) - 1).alias("b"))
    abut = F.forall(pairs, lambda p: (F.abs(p["b"]["l"] - p["a"]["r"]) <= slack) & (F.abs(p["b"]["t"] - p["a"]["t"]) <= slack) & (F.abs(p["b"]["b"] - p["a"]["b"]) <= slack))
    return F.when(F.size(boxes) >= 3, abut).otherwise(F.lit(False))


@rule("geometry.schematic_grid", "warning")
def schematic_grid():
    return _when((F.size("boxes") >= 3) & even_grid(F.col("boxes")), "boxes")


def findings(docs: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """All findings: doc_id, rule, severity, ordinal, fields; errors first, then by rule (O1, O2), in ``ordinal``.

    One pass over the documents; the only other input is the small map of county codes. What that is learned from may be
    marked by a column ``learn``, so that a corpus may leave known faults out.
    """
    names = list(rules or RULES)
    docs = docs.withColumn("_api", S.parse_api("api"))
    if LEARNED in names:
        learned = learned_counties(docs.where("learn") if "learn" in docs.columns else docs)
        docs = docs.join(learned.withColumnRenamed("code", "_learned_code"), "county", "left")
    rank = lambda name: F.lit(0 if RULES[name][0] == "error" else 1)

    def found(name: str) -> Column:
        fields = F.coalesce(RULES[name][1](), F.array().cast("array<array<string>>"))
        return F.transform(fields, lambda f: F.struct(rank(name).alias("rank"), F.lit(name).alias("rule"), f.alias("fields")))

    every = F.array_sort(F.concat(*map(found, names)))
    rows = docs.select("doc_id", F.posexplode(every).alias("at", "f"))
    severity = F.when(F.col("f.rank") == 0, "error").otherwise("warning")
    return rows.select("doc_id", F.col("f.rule").alias("rule"), severity.alias("severity"), F.col("f.fields").alias("fields"), (F.col("at") + 1).alias("ordinal"))


def rule_counts(found: DataFrame) -> DataFrame:
    """Counts by severity and rule."""
    return found.groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("documents"))
