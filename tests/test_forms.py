"""Form numbers, labels, reports, identity answers, placing and evidence: nulls, edges and cases written by hand."""

import json

from pyspark.sql import functions as F

from leafmill.functions import scalars as S
from leafmill.operators import export, forms, geometry, overlays, sampling, stats
from leafmill.sources import images, scans, sinks

BOX = "struct<l:double,t:double,r:double,b:double>"


def test_own_form_numbers(spark):
    cases = {
        None: [], "": [], "no number": [], "FORM W-2 and W-2": ["W-2"], "GAS DIVISION G-1": ["G-1"], "shown on Form P-5, Organization Report P-4": ["P-4"],
        "attached Forms W-2 / G-1 and GT-1; L-1": [], "see W-2. G-1": ["G-1"], "A-38 A-39": [], "www.x WWW-1 NAD-27": [], "Form GWT-1 Form 2": ["GWT-1", "FORM 2"],
        "FORM 2 - 4": [], "form 3": ["FORM 3"], "w-2": [], "W-123": [], "per A-2 W-3": ["W-3"], "x" * 398 + " W-2": [], "W-1H\nW-1A": ["W-1H", "W-1A"], "pursuant to Form W-15": [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.own for r in df.select("t", forms.header_tokens("t").alias("own")).collect()}
    assert got == cases


def test_long_headers_take_no_more_than_their_length(spark):
    df = spark.range(2000).select(F.repeat(F.lit("FORMS "), 5000).alias("t"))
    assert df.select(forms.header_tokens("t").alias("own")).where("size(own) > 0").count() == 0


def test_classes_of_numbers_and_names(spark):
    df = spark.createDataFrame([("W-1H", "W 4-family"), ("x", "Other"), (None, None), (" g-1 ", "WS1_SW1")], "n string, c string")
    cls, error = forms.form_class("c")
    rows = [tuple(r) for r in df.select(forms.token_class(F.col("n")), cls, error).collect()]
    assert rows == [("w1", "w4_family", None), (None, "other_form", None), (None, None, "empty"), ("g1", "ws1_sw1", None)]


def test_label_keys_may_be_null_but_not_missing(spark):
    full = {"form_class": "g1", "part": "face", "orientation": None, "confidence": "low", "alt_class": None, "form_number_legible": False}
    bodies = [full, full | {"part": None}, {k: v for k, v in full.items() if k != "alt_class"}, full | {"part": "back"}, full | {"form_number_legible": None}, full | {"form_class": "w3"}]
    df = spark.createDataFrame([(i, json.dumps(b), ["W-15"] if i == 5 else []) for i, b in enumerate(bodies)], "i int, body string, header array<string>")
    rows = {r.i: (r.error, r.form_class, r.was, r.routed) for r in forms.page_labels(df, "body", "header").collect()}
    assert rows == {0: (None, "completion_face_unknown_form", "g1", True), 1: (None, "g1", None, False), 2: ("missing key", None, None, False), 3: ("unknown part", None, None, False), 4: ("not a boolean", None, None, False), 5: (None, "w3", None, False)}


def test_regions_of_values(spark):
    v = lambda **k: {"status": "present", "value": "x", **k}
    cells = [v(page=2, box=[0, 0, 1, 1]), v(box=[0, 0, 1, 1]), v(page=3, box=[0, 0, 1, 1]), v(box=[0, 0, 0, 0]), v(box=["a", 0, 1, 1]), v(box=None), {"status": "blank", "box": [0, 0, 1, 1]}]
    df = spark.createDataFrame([(i, json.dumps({"g": {"f": c}}), [4, 7]) for i, c in enumerate(cells)], "k int, body string, pages array<int>")
    rows = {r.k: r.region and r.region.page for r in forms.flatten_report(df, "k", "body", {"g": ["f"]}, {}, "pages").collect()}
    assert rows == {0: 7, 1: 4, 2: 4, 3: None, 4: None, 5: None, 6: None}


def test_identity_answers(spark):
    body = json.dumps({"a": {"status": "present", "raw": "x", "found_in": " "}, "b": {"status": "blank", "raw": "y"}, "c": 3, "received_stamps": "none"})
    df = spark.createDataFrame([(1, body), (2, None), (3, "no")], "k int, body string")
    rows = {(r.k, r.field): (r.status, r.raw, r.found_in, r.located, r.error) for r in forms.identity(df, "k", "body", ["a", "b", "c"]).collect()}
    assert rows == {(1, "a"): ("present", "x", None, True, None), (1, "b"): ("blank", None, None, False, None), (1, "c"): ("not_on_this_form", None, None, False, None)}
    assert [r[0] for r in df.select(forms.stamps("body")).collect()] == [[], [], []]


def test_nothing_is_placed_without_a_box(spark):
    maps = f"fields map<string,{BOX}>, rows map<string,array<{BOX}>>, heads map<string,int>, blocks map<string,{BOX}>, counts map<string,int>"
    flat = (0.1, 0.5, 0.2, 0.5)
    df = spark.createDataFrame([("t[1].c", {}, {}, {}, {"t": flat}, {}), ("t[0].c", {}, {"t": [flat]}, {"t": 1}, {}, {}), ("t", None, None, None, None, None), (None, {}, {}, {}, {}, {})], f"field string, {maps}")
    spot = overlays.placed(*map(F.col, df.columns))
    assert [r[0] for r in df.select(spot).collect()] == [None] * 4
    none = spark.createDataFrame([(None,)], f"x {BOX}")
    one = none.withColumn("m", F.struct(*(F.lit(float(c in "ae")).alias(c) for c in "abcdef")))
    assert tuple(one.select(S.clip(F.col("x")), geometry.box_through("m", F.col("x"))).first()) == (None, None)


def test_word_boxes_need_a_page_size(spark):
    word = '<word xMin="1" yMin="2" xMax="3.5" yMax="4">a&amp;b</word>'
    df = spark.createDataFrame([(1, '<page width="10" height="20">' + word), (2, word), (3, '<page width="0" height="20">' + word), (4, None)], "k int, m string")
    rows = [(r.k, r.n, r.text, *(round(x, 9) for x in r.box)) for r in images.word_boxes(df, "k", "m").collect()]
    assert rows == [(1, 0, "a&amp;b", 0.1, 0.1, 0.35, 0.2)]


def test_attachments_of_documents_without_evidence(spark):
    docs = spark.createDataFrame([("r", 0, 3, [3, 4, 5], {4: ["lease_name"]}), ("s", 0, 1, [1], None), ("t", 0, 1, [1, 2], None)], "record_id string, file_index int, face int, pages array<int>, evidence map<int,array<string>>")
    rows = sorted((r.record_id, r.page, r.fields) for r in export.attachments(docs).collect())
    assert rows == [("r", 4, ["lease_name"]), ("r", 5, []), ("t", 2, [])]
    assert docs.select(export.stamps_text(F.lit(3), F.lit(None).cast("array<struct<office:string,date:string>>"))).first()[0] == "p3: none"


def test_accuracy_comparable_items_and_strangers(spark):
    rows = spark.createDataFrame([("high", True), ("high", None), (None, True), ("", True)], "c string, hit boolean")
    assert [tuple(r) for r in stats.accuracy_by(rows, "c", F.col("hit")).collect()] == [("high", 1, 2, 0.5)]
    items = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (3, "a"), (3, "b")], "i int, arm string")
    assert [r.i for r in stats.comparable(items, "i", "arm", spark.createDataFrame([(1,), (2,)], "i int")).collect()] == [1]
    people = spark.range(7).select("id", F.lit("same").alias("lease"))
    assert sampling.strangers(people, "id", "lease", 3).count() == 0
    assert sampling.strangers(people.withColumn("lease", F.lit(None).cast("string")), "id", "lease", 9).count() == 3


def test_sheets_keep_quotes_and_commas(spark, tmp_path):
    df = spark.createDataFrame([("1", 'said "yes", then\nno')], "k string, note string")
    sinks.write_sheet(df, str(tmp_path / "s"))
    assert scans.read_sheet(spark, str(tmp_path / "s")).collect() == df.collect()
