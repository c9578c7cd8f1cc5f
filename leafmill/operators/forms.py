"""Form tokens, page labels and nested reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Classes, other spellings of them, parts, orientations, confidences and statuses of a value.
CLASSES = (
    "g1", "w2", "completion_face_unknown_form", "completion_face_legacy", "w1", "w3", "p4", "p5", "p12", "p15", "g5", "g6", "gt1", "l1", "w12", "w15", "p17",
    "w4_family", "ws1_sw1", "letter_memo", "plat_map", "schematic", "separator_card", "blank_or_artifact", "other_form", "other_nonform",
)
ALIASES = {"2": "completion_face_legacy", "form2": "completion_face_legacy", "3": "other_form", "form3": "other_form", "g3": "other_form", "gwt1": "other_form", "other": "other_form", "welltestreport": "other_form"}
PARTS = ("face", "sec_ii", "sec_iii", "continuation", "back_instructions", "unknown")
ORIENTATIONS = ("up", "cw90", "ccw90", "down")
CONFIDENCES = ("high", "medium", "low")
STATUSES = ("present", "blank", "illegible", "not_on_this_form", "page_not_in_document")
FACES = ("g1", "w2")
COMPLETIONS = (*FACES, "completion_face_unknown_form", "completion_face_legacy")
CONFUSABLE = ("w15", "g5", "l1", "ws1_sw1", "other_form")

# How form numbers are printed, what is none, the wording before a reference, what keeps a list of references
# going, how much of a page is its header, how far back a wording is looked for, and the class that owns each number.
FORM_NUMBER = r"\b(?:FORM\s+)?([A-Z]{1,2}-\d{1,2}[A-Z]?)\b|\b(?i:FORMS?)\s+([A-Z]{3}-\d{1,2}[A-Z]?)\b|\b(?i:FORMS?)\s+(\d{1,2})(?!\s*-\s*\d)\b"
NO_FORM = ("A",)
REFERENCE = r"(?i)\b(shown on|as per|as shown|see|per|filed on|filed with|attached|copy of|copies of|accompanying|pursuant to|with|on)\s+(RRC\s+)?(FORMS?\s+)?$"
LIST_GOES_ON = r"(?i)^[\s,;/]*(and|or)?[\s,;/]*$"
HEADER_CHARS, LOOKBACK_CHARS = 400, 28
CLASS_OF = {
    "G-1": "g1", "W-2": "w2", "W-1": "w1", "W-1A": "w1", "W-1C": "w1", "W-1H": "w1", "W-3": "w3", "P-4": "p4", "P-5": "p5", "P-12": "p12", "P-15": "p15",
    "G-5": "g5", "G-6": "g6", "GT-1": "gt1", "L-1": "l1", "W-12": "w12", "W-15": "w15", "P-17": "p17", "W-4": "w4_family", "W-4A": "w4_family",
    "W-5": "w4_family", "W-6": "w4_family", "WS-1": "ws1_sw1", "SW-1": "ws1_sw1", "FORM 2": "completion_face_legacy", "FORM 3": "completion_face_legacy", "GWT-1": "completion_face_legacy",
}
REVISION = r"(?i)Rev[.\s]*\s*\d{1,2}\s*[/\-]"


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(v) for pair in values.items() for v in pair)), key)


def header_tokens(text: Column | str) -> Column:
    """The form numbers that a page's header names as its own, in order, each once.

    The header is taken apart into numbers and the text before each. A number that a wording leads to is a reference, and
    so is one that only a separator parts from a reference; bare numbers keep the word FORM. A null text has none.
    """
    head = F.substring(F.col(text) if isinstance(text, str) else text, 1, HEADER_CHARS)
    piece = F.lit(rf"(?s)\G(.*?)({FORM_NUMBER})")  # each piece starts where the last one ended
    groups = F.arrays_zip(*(F.regexp_extract_all(head, piece, F.lit(i)).alias(n) for i, n in enumerate(("before", "printed", "lettered", "long", "bare"), 1)))

    def step(seen: Column, part: Column) -> Column:
        lead = F.concat(seen["text"], part["before"])
        since = F.concat(seen["since"], part["before"])
        text_now = F.concat(lead, part["printed"])
        token = F.when(part["bare"] != "", F.concat(F.lit("FORM "), part["bare"])).otherwise(F.concat(part["lettered"], part["long"]))
        led = F.right(lead, F.lit(LOOKBACK_CHARS)).rlike(REFERENCE) | (seen["led"] & since.rlike(LIST_GOES_ON))
        own = F.when(led, seen["own"]).otherwise(F.array_append(seen["own"], token))
        ours = F.struct(text_now.alias("text"), F.lit("").alias("since"), led.alias("led"), own.alias("own"))
        none = F.struct(text_now.alias("text"), F.concat(since, part["printed"]).alias("since"), seen["led"].alias("led"), seen["own"].alias("own"))
        return F.when(F.substring_index(token, "-", 1).isin(*NO_FORM), none).otherwise(ours)

    start = F.struct(F.lit("").alias("text"), F.lit("").alias("since"), F.lit(False).alias("led"), F.array().cast("array<string>").alias("own"))
    return F.coalesce(F.aggregate(groups, start, step, lambda s: F.array_distinct(s["own"])), F.array().cast("array<string>"))


def token_class(token: Column) -> Column:
    """the class that owns a printed form number; null for one that no class owns."""
    return _lookup(CLASS_OF, F.upper(F.trim(token)))


def form_class(x: Column | str) -> tuple[Column, Column]:
    """the class by vocabulary first, by alias second; else an error. Case, dashes, blanks and underscores don't count."""
    x = F.col(x) if isinstance(x, str) else x
    key = F.regexp_replace(F.lower(F.trim(F.coalesce(x, F.lit("")))), "[- _]", "")
    found = F.coalesce(_lookup({c.replace("_", ""): c for c in CLASSES}, key), _lookup(ALIASES, key))
    error = F.when(key == "", "empty").when(found.isNull(), "unknown class")
    return found, error


def stratum(cls: Column, part: Column, oversize: Column, failed: Column, tokens: Column) -> Column:
    """P5: the stratum of a page by fixed precedence, null outside the frame."""
    said = lambda token: F.array_contains(tokens, token)
    face, reverse = F.coalesce(part == "face", F.lit(False)), F.coalesce(part == "back_instructions", F.lit(False))
    return (
        F.when(failed, "I_parse_failure")
        .when(oversize, "H_oversize")
        .when(cls.isin(*FACES) & ~face, "F_completion_non_face")
        .when((cls == "g1") & said("G-1"), "B_g1_face_ocr_g1")
        .when(cls == "g1", "A_g1_face_ocr_silent")
        .when((cls == "w2") & said("W-2"), "E_w2_face_ocr_w2")
        .when((cls == "w2") & said("W-15"), "D_w2_face_ocr_w15")
        .when(cls == "w2", "C_w2_face_ocr_silent")
        .when(cls.isin(*CONFUSABLE) & (face | ((cls == "other_form") & ~reverse)), "G_confusable_not_completion")
    )


def legibility(text: Column, tokens: Column) -> Column:
    """Whether the first 800 characters show a revision, else whether the header shows the number of a completion report."""
    return F.when(F.substring(text, 1, 800).rlike(REVISION), "A_revision_legible").when(F.arrays_overlap(tokens, F.array(F.lit("G-1"), F.lit("W-2"))), "B_form_number_legible").otherwise("C_neither")


def page_labels(rows: DataFrame, body: str, header: str) -> DataFrame:
    """Adds error, form_class, part, was (the class before a rule changed it) and routed.

    All six keys must be there. A value may be null, but for the legibility, and else belongs to its vocabulary. A G-1 or
    W-2 face whose number can't be read becomes a face of an unknown form; a W-15 in the header then corrects any completion
    face, whatever path the label came by.
    """
    known = {"form_class": CLASSES, "part": PARTS, "orientation": ORIENTATIONS, "confidence": CONFIDENCES, "alt_class": CLASSES}
    names = (*known, "form_number_legible")
    parsed = rows.withColumn("_o", S.json_body(body)).withColumn("_keys", F.json_object_keys("_o"))
    for name in names:
        parsed = parsed.withColumn(f"_{name}", F.get_json_object("_o", f"$.{name}"))
    quoted = F.col("_o").rlike(r'"form_number_legible"\s*:\s*"')
    legible = F.col("_form_number_legible")
    error = F.when(F.col("_keys").isNull(), "no object").when(F.size(F.array_except(F.array(*map(F.lit, names)), "_keys")) > 0, "missing key")
    for name, words in known.items():
        error = error.when(~F.col(f"_{name}").isin(*words), f"unknown {name.replace('form_', '').replace('alt_', 'other ')}")
    error = error.when(~F.coalesce(legible, F.lit("")).isin("true", "false") | quoted, "not a boolean")
    parsed = parsed.withColumn("error", error)
    fine, face = F.col("error").isNull(), F.col("_part") == "face"
    routed = F.coalesce(fine & face & F.col("_form_class").isin(*FACES) & (legible == "false"), F.lit(False))
    corrected = F.coalesce(fine & face & F.col("_form_class").isin(*COMPLETIONS) & F.array_contains(header, "W-15"), F.lit(False))
    out = parsed.withColumn("was", F.when(corrected | routed, F.col("_form_class"))).withColumn("routed", routed & ~corrected)
    cls = F.when(corrected, "w15").when(routed, "completion_face_unknown_form").when(fine, F.col("_form_class"))
    return out.withColumn("form_class", cls).withColumn("part", F.when(fine, F.col("_part"))).drop("_o", "_keys", *(f"_{n}" for n in names))


def region(entry: Column, pages: Column, hint: Column) -> Column:
    """Where a value stands: the page of the file behind the answer's page number, and the box. A box without four numbers or an extent is none, and so is one on no page."""
    number = entry["page"].try_cast("int")
    page = F.coalesce(F.when(pages.isNull(), number).when(number >= 1, F.get(pages, number - 1)), hint)
    b = F.transform(entry["box"], lambda v: v.try_cast("double"))
    side = lambda i: F.get(b, F.lit(i))
    drawn = (F.size(entry["box"]) == 4) & (side(0) < side(2)) & (side(1) < side(3))
    return F.when(drawn & page.isNotNull(), F.struct(page.alias("page"), S.box(*map(side, range(4))).alias("box")))


def identity(reads: DataFrame, key: str, body: str, fields: list[str]) -> DataFrame:
    """A row per field: status, raw, found_in, located. Present without a reading is illegible; what isn't present keeps no text;
    a field that the answer lacks isn't on the form. An unknown status is an error row."""
    shape = "struct<" + ",".join(f"`{f}`:struct<status:string,raw:string,found_in:string>" for f in fields) + ">"
    base = reads.withColumn("_r", F.from_json(S.json_body(body), shape)).where(F.col("_r").isNotNull())
    out = base.select(key, F.inline(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"_r.{f}").alias("v")) for f in fields))))
    said = F.trim(F.coalesce("v.status", F.lit("not_on_this_form")))
    raw = F.when(F.col("v.raw") != "", F.col("v.raw"))
    status = F.when(~said.isin(*STATUSES), F.lit(None)).when((said == "present") & raw.isNull(), "illegible").otherwise(said)
    present = F.coalesce(status == "present", F.lit(False))
    return out.select(key, "field", status.alias("status"), F.when(present, raw).alias("raw"), F.when(present, S.clean("v.found_in")).alias("found_in"), present.alias("located"), F.when(status.isNull(), "unknown status").alias("error"))


def stamps(body: Column | str) -> Column:
    """(office, date) of every received stamp that has both."""
    listed = F.from_json(F.get_json_object(S.json_body(body), "$.received_stamps"), "array<struct<office:string,date:string>>")
    tidy = F.transform(F.coalesce(listed, F.array().cast("array<struct<office:string,date:string>>")), lambda e: F.struct(F.trim(e["office"]).alias("office"), F.trim(e["date"]).alias("date")))
    return F.filter(tidy, lambda e: F.coalesce((e["office"] != "") & (e["date"] != ""), F.lit(False)))


def flatten_report(reports: DataFrame, key: str, body: str, groups: dict[str, list[str]], tables: dict[str, list[str]], pages: str | None = None) -> DataFrame:
    """A row per dotted field. A status other than present keeps no value; a table slot without a list has no rows.

    ``dropped`` counts keys that no group or table has, at the root and in the groups (P24). ``error`` names a status that isn't
    one, also a missing one; such a row has the status "missing". With ``pages``, a column with the file's pages of each report, ``region`` says where a present value
    stands; a value without a page number stands on the first.
    """
    value = "struct<status:string,value:string,page:string,box:array<string>>"

    def strays(x: Column | str, names: list[str]) -> Column:
        keys = F.coalesce(F.json_object_keys(x), F.array().cast("array<string>"))
        return F.size(F.array_except(keys, F.array(*map(F.lit, names))))

    dropped = strays(S.json_body(body), [*groups, *tables])
    for group, fields in groups.items():
        dropped = dropped + strays(F.get_json_object(S.json_body(body), f"$.{group}"), fields)
    # each body is parsed once: groups as structs, tables as text, since a slot may hold a list, one row or neither
    row = {n: "struct<" + ",".join(f"`{f}`:{value}" for f in fields) + ">" for n, fields in (groups | tables).items()}
    shape = ",".join([*(f"`{n}` {row[n]}" for n in groups), *(f"`{n}` string" for n in tables)])
    base = reports.withColumn("_o", S.json_body(body)).where(F.col("_o").isNotNull()).select(key, *([pages] if pages else []), dropped.alias("dropped"), F.from_json("_o", shape).alias("_r"))
    entry = lambda name, v: F.struct(name.alias("field"), v.alias("v"))
    parts = [F.array(*(entry(F.lit(f"{group}.{f}"), F.col(f"_r.{group}.{f}")) for f in fields)) for group, fields in groups.items()]
    for name, fields in tables.items():
        slot = F.trim(F.col(f"_r.{name}"))
        # one row alone may stand for a list of one; a value in the table's place has no such columns
        lone = F.array(F.from_json(slot, row[name]))
        rows = F.when(slot.startswith("["), F.from_json(slot, f"array<{row[name]}>")).when(F.get_json_object(slot, f"$.{fields[0]}.status").isNotNull(), lone)
        place = lambda i, f: F.concat(F.lit(f"{name}["), i.cast("string"), F.lit(f"].{f}"))  # noqa: B023, E731
        parts.append(F.coalesce(F.flatten(F.transform(rows, lambda r, i: F.array(*(entry(place(i, f), r[f]) for f in fields)))), F.array().cast(f"array<struct<field:string,v:{value}>>")))
    out = base.select(key, *([pages] if pages else []), "dropped", F.inline(F.concat(*parts)))
    status = F.when(F.col("v.status").isin(*STATUSES), F.col("v.status")).otherwise("missing")
    error = F.when(F.col("v.status").isNull(), "no status").when(status == "missing", "unknown status")
    out = out.select("*", status.alias("status"), F.when(status == "present", S.clean("v.value")).alias("value"), error.alias("error"))
    if not pages:
        return out.select(key, "field", "status", "value", "dropped", "error")
    place = F.when(F.col("status") == "present", region(F.col("v"), F.col(pages), F.get(pages, F.lit(0))))
    return out.select(key, "field", "status", "value", "dropped", "error", place.alias("region"))
