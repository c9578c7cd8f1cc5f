"""Scalar expressions over text, dates, numbers, boxes and JSON. All of them stay in the JVM.

Where two engines differ the portable form is taken: no lookaround in patterns, an empty match is null, casts that
may fail are tried, two-digit years are never left to a date format.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names by number, readings that are no value, spellings of form classes.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# Readings that stand for no value, as they are compared.
NO_VALUE = ("na", "n", "none", "nil", "notapplicable", "unknown", "blank", "nonvalue", "no", "0")
PAGE_ID = r"^(\d+)-(\d+)-([1-9]\d*)$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def extract(x: Column | str, pattern: str, group: int = 1) -> Column:
    """A regex group, null where there is no match."""
    return F.nullif(F.regexp_extract(_c(x), pattern, group), F.lit(""))


def norm(x: Column | str) -> Column:
    """lower case, letters a-z and digits only. ``lower`` leaves ß alone where a full case fold would not."""
    return F.regexp_replace(F.lower(_c(x)), "[^0-9a-z]", "")


def fold(x: Column | str) -> Column:
    """what scanning confuses becomes one sign."""
    return F.translate(norm(x), "oli", "011")


def clean(x: Column | str) -> Column:
    """trimmed, empty as null."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


def is_anchor(x: Column | str) -> Column:
    """Four normalised signs or three digits."""
    return (F.length(norm(x)) >= 4) | (F.length(F.regexp_replace(_c(x), "[^0-9]", "")) >= 3)


def scorer_norm(x: Column | str) -> Column:
    """spaces collapsed, commas dropped, trailing stops dropped."""
    squeezed = F.trim(F.regexp_replace(F.regexp_replace(F.lower(_c(x)), ",", ""), r"\s+", " "))
    return F.regexp_replace(squeezed, r"[.,;:]+$", "")


def revision_key(x: Column | str) -> Column:
    """F9"""
    return F.coalesce(F.nullif(norm(x), F.lit("")), F.lit("unknown"))


def page_id(record: Column | str, file: Column | str, page: Column | str) -> Column:
    """F10"""
    return F.concat_ws("-", _c(record).cast("string"), _c(file).cast("string"), _c(page).cast("string"))


def page_parts(x: Column | str) -> Column:
    """F10 read back: null unless well formed and of 64 signs at most."""
    ok = _c(x).rlike(PAGE_ID) & (F.length(_c(x)) <= 64)
    part = [F.regexp_extract(_c(x), PAGE_ID, k).cast("long") for k in (1, 2, 3)]
    return F.when(ok, F.struct(part[0].alias("record"), part[1].alias("file"), part[2].alias("page")))


def century(year: Column) -> Column:
    """A year written with four digits as it is; a shorter one up to 30 is of this century, others of the last."""
    value = year.try_cast("int")
    return F.when(F.length(year) == 4, value).when(value <= 30, value + 2000).otherwise(value + 1900)


# The writings of a date that forms use.
ISO_DATE = r"^(\d{4})-(\d{2})-(\d{2})$"
SLASHED_DATE = r"^(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2,4})$"
WORDED_DATE = r"^([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{2,4})$"
THREE_NUMBERS = r"(\d{1,4})\D+(\d{1,2})\D+(\d{1,4})"


def parse_date(x: Column | str) -> Column:
    """ISO, month/day/year with ``/``, ``-`` or ``.``, or a month by name; null for what is no date."""
    x = F.trim(_c(x))

    def build(y: Column, m: Column, d: Column) -> Column:
        text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
        return F.try_to_date(text, "yyyy-MM-dd")

    def number(p: str, k: int) -> Column:
        return extract(x, p, k).try_cast("int")

    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(F.regexp_extract(x, WORDED_DATE, 1), 1, 3))).cast("int")
    return (
        F.when(x.rlike(ISO_DATE), build(number(ISO_DATE, 1), number(ISO_DATE, 2), number(ISO_DATE, 3)))
        .when(x.rlike(SLASHED_DATE), build(century(extract(x, SLASHED_DATE, 3)), number(SLASHED_DATE, 1), number(SLASHED_DATE, 2)))
        .when(x.rlike(WORDED_DATE) & (month > 0), build(century(extract(x, WORDED_DATE, 3)), month, number(WORDED_DATE, 2)))
    )


def month_year(x: Column | str) -> Column:
    """D3: a stamp at the precision of months, as yyyy-mm; without a month by name or a year, its last two numbers."""
    x = F.lower(_c(x))
    month = F.coalesce(*(F.when(x.contains(m), F.lit(f"{n:02d}")) for n, m in enumerate(MONTHS, 1)))
    year, numbers = extract(x, r"((?:19|20)\d\d)"), F.regexp_extract_all(x, F.lit(r"(\d+)"), F.lit(1))
    return F.when(month.isNotNull() & year.isNotNull(), F.concat_ws("-", year, month)).when(F.size(numbers) >= 2, F.array_join(F.slice(numbers, -2, 2), "-"))


def parse_depth(x: Column | str) -> Column:
    """The first signed number, thousands commas dropped."""
    return F.replace(extract(x, r"(-?\d[\d,]*(?:\.\d+)?)"), F.lit(","), F.lit("")).try_cast("double")


def field_value(field: Column | str, x: Column | str) -> Column:
    """what two readings of a field are compared by; null for readings that are no value, whatever signs they have."""
    field, raw = _c(field), _c(x)
    text = norm(raw)
    bare = lambda v: F.regexp_replace(v, "^0+", "")
    parts = F.array(*(F.regexp_extract(raw, THREE_NUMBERS, k).try_cast("int") % 100 for k in (1, 2, 3)))
    by = (
        F.when(field == "district", F.coalesce(F.nullif(bare(text), F.lit("")), F.lit("0")))
        .when(field == "date", F.when(raw.rlike(THREE_NUMBERS), F.array_join(parts.cast("array<string>"), "-")).otherwise(text))
        .when(field == "received_date", month_year(raw))
        .when(field == "depth", bare(F.regexp_replace(raw, "[^0-9]", "")))
        .otherwise(text)
    )
    known = (text != "") & ~text.isin(*NO_VALUE)
    return F.when(known, F.nullif(by, F.lit("")))


def equivalent(want: Column | str, got: Column | str) -> Column:
    """equal when normalised, or the same date, or the same number where both are a number alone."""
    want, got = _c(want), _c(got)
    lone = r"^\s*-?\d[\d,]*(\.\d+)?\s*(ft|feet|')?\s*$"
    same_date = F.coalesce(parse_date(want) == parse_date(got), F.lit(False))
    same_depth = want.rlike(lone) & got.rlike(lone) & F.coalesce(parse_depth(want) == parse_depth(got), F.lit(False))
    return F.coalesce((scorer_norm(want) == scorer_norm(got)) | same_date | same_depth, F.lit(False))


def parse_api(x: Column | str) -> Column:
    """state, county and unique parts with up to three separators between them."""
    pattern = r"(\d{2})[^0-9]{0,3}(\d{3})[^0-9]{0,3}(\d{5})"
    return F.when(_c(x).rlike(pattern), F.struct(*(F.regexp_extract(_c(x), pattern, k + 1).alias(n) for k, n in enumerate(("state", "county", "number")))))


def index_token(x: Column | str) -> Column:
    """eight quoted digits, split three and five."""
    digits = extract(x, "['\"](\\d{8})['\"]")
    return F.when(digits.isNotNull(), F.struct(F.substring(digits, 1, 3).alias("county"), F.substring(digits, 4, 5).alias("number")))


def field_label(x: Column | str) -> Column:
    """the last dotted part, underscores as spaces."""
    return F.replace(F.substring_index(_c(x), ".", -1), F.lit("_"), F.lit(" "))


def row_index(x: Column | str) -> Column:
    return extract(x, r"\[(\d+)\]").try_cast("int")


def query_tokens(x: Column | str) -> Column:
    """runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(_c(x)), "[^a-z0-9]+"), lambda t: t != "")


def asset_url(base: Column | str, path: Column | str) -> Column:
    """exactly one slash between."""
    return F.concat(F.regexp_replace(_c(base), "/+$", ""), F.lit("/"), F.regexp_replace(_c(path), "^/+", ""))


def key_hash(*parts: Column | str) -> Column:
    """Sixteen hexadecimal digits of a SHA-256."""
    joined = F.concat_ws("|", *(_c(p).cast("string") for p in parts)) if len(parts) > 1 else _c(parts[0]).cast("string")
    return F.substring(F.sha2(joined.cast("binary"), 256), 1, 16)


# boxes: structs of l, t, r, b in page fractions


def box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    return F.struct(left.alias("l"), top.alias("t"), right.alias("r"), bottom.alias("b"))


def area(x: Column) -> Column:
    return F.greatest(F.lit(0.0), x["r"] - x["l"]) * F.greatest(F.lit(0.0), x["b"] - x["t"])


def overlap(x: Column, y: Column) -> Column:
    return box(F.greatest(x["l"], y["l"]), F.greatest(x["t"], y["t"]), F.least(x["r"], y["r"]), F.least(x["b"], y["b"]))


def iou(x: Column, y: Column) -> Column:
    """Intersection over union, 0 for two empty boxes."""
    both = area(overlap(x, y))
    return F.coalesce(F.try_divide(both, area(x) + area(y) - both), F.lit(0.0))


def clip(x: Column) -> Column:
    """Within the page; null for no box and if nothing is left. ``least`` and ``greatest`` skip nulls, so no box is asked for first."""
    y = overlap(x, box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)))
    return F.when(x.isNotNull() & (y["r"] > y["l"]) & (y["b"] > y["t"]), y)


def unit(x: Column, slack: float = 1e-6) -> Column:
    """A page fraction, clamped within ``slack``; null beyond it."""
    return F.when((x >= -slack) & (x <= 1 + slack), F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)))


def oversize(width: Column, height: Column, ratio: float = 2.0) -> Column:
    """Null for sizes that aren't positive."""
    return F.when((width > 0) & (height > 0), F.greatest(width, height) / F.least(width, height) > ratio)


def scaled(width: Column, height: Column, longest: int) -> Column:
    """The size scaled down to ``longest``, halves to even; small ones stay."""
    ratio = F.least(F.lit(1.0), longest / F.greatest(width, height))
    return F.struct(F.greatest(F.lit(1), F.bround(width * ratio).cast("int")).alias("w"), F.greatest(F.lit(1), F.bround(height * ratio).cast("int")).alias("h"))


def json_body(x: Column | str) -> Column:
    """The object of a bare, fenced or prefaced body; null for anything else."""
    x = F.trim(_c(x))
    fenced = extract(x, r"(?s)^[^{]*```(?:json)?\s*(\{.*\})\s*```\s*$")
    return F.when(x.startswith("{") & x.endswith("}"), x).otherwise(F.coalesce(fenced, extract(x, r"(?s)^[^{`]*(\{.*\})$")))
