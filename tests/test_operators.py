"""Operators on small literal tables, their abstentions included, and against plain loops."""

import datetime
import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.functions import scalars as S
from leafmill.operators import export, forms, geometry, grouping, joins, rules, sampling, stats
from leafmill.operators import windows as W
from leafmill.plans import grouping as grouping_plans
from leafmill.plans import scoring
from leafmill.sources import scans, sinks
from leafmill.streaming import ingest

SF = "/root/testdata/sf0.001"


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def column(spark, texts, f):
    return [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string").orderBy("i").select(f("s")).collect()]


def test_dates(spark):
    texts = ["9-22-77", "4/1/83", "5.6.30", "7/4/1931", "May 4, 1977", "sept 3 29", "1975-04-23", "13/1/75", "2/30/80", "", None, "illegible"]
    d = datetime.date
    assert column(spark, texts, S.parse_date) == [d(1977, 9, 22), d(1983, 4, 1), d(2030, 5, 6), d(1931, 7, 4), d(1977, 5, 4), d(2029, 9, 3), d(1975, 4, 23), None, None, None, None, None]


def test_depths_and_codes(spark):
    assert column(spark, ["1,234 ft", "T.D. 88.5'", "-12", "none", None], S.parse_depth) == [1234.0, 88.5, -12.0, None, None]
    got = column(spark, ["42-123-45678", "No 4212345678", "42 - 123 / 45678", "421-23", None], S.parse_api)
    assert [tuple(x) if x else None for x in got] == [("42", "123", "45678")] * 3 + [None, None]


def test_equivalence(spark):
    rows = [("Smith, J.", "smith j", True), ("4/1/83", "April 1, 1983", True), ("1,000", "1000 ft", True), ("1000 and 3", "1000", False), (None, "x", False)]
    assert values(spark, rows, "a string, b string, w boolean", S.equivalent("a", "b"), "w") == [(w, w) for _, _, w in rows]


def test_json_bodies(spark):
    texts = ['{"a": 1}', '```json\n{"a": 1}\n```', 'Here it is: {"a": 1}', '{"a": 1} and more', "nothing", None]
    assert column(spark, texts, S.json_body) == ['{"a": 1}'] * 3 + [None, None, None]


def test_page_ids_round_trip(spark):
    parts = column(spark, ["12-0-3", "12-0-0", "x-1-2", "1-2-3-4"], S.page_parts)
    assert [tuple(p) if p else None for p in parts] == [(12, 0, 3), None, None, None]


def test_manifest_with_empty_files(spark):
    df = spark.createDataFrame([("r", [{"pages": 2}, {"pages": 0}, {"pages": 1}]), ("s", [])], "record_id string, files array<struct<pages:int>>")
    assert sorted(r.page_id for r in scans.explode_manifest(df).collect()) == ["r-0-1", "r-0-2", "r-2-1"]


def test_pages_past_the_text_are_empty(spark):
    df = spark.createDataFrame([(1, "a\fb", 3), (2, "x", 0)], "k int, t string, n int")
    assert sorted((r.k, r.page, r.page_text) for r in scans.split_pages(df, F.col("t"), F.col("n")).collect()) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "")]


def test_sheets_with_marks_and_other_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,note\n01, x \n".encode())
    (tmp_path / "b.csv").write_bytes(b"id,verdict\n02,ok\n")
    (tmp_path / "c.csv").write_bytes("id,note\n03,café\n".encode("latin-1"))
    rows = {tuple(r) for r in scans.read_sheet(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()}
    assert rows == {("01", "x", None), ("02", None, "ok")}
    assert scans.read_sheet(spark, str(tmp_path / "c.csv"), latin1=True).first().note == "café"


def test_json_lines_and_binary_files(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"record_id": "1", "files": [{"pages": 2}]}\n\n{"record_id": "2"}\n')
    assert scans.read_jsonl(spark, str(tmp_path / "m.jsonl"), scans.MANIFEST).where("record_id IS NOT NULL").count() == 2
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1")
    (tmp_path / "y.pdf").write_bytes(b"html")
    assert [r.path.endswith("x.pdf") for r in scans.read_binary(spark, str(tmp_path / "*.pdf"), b"%PDF").collect()] == [True]


def test_misses_go_to_the_provider_and_else_are_errors(spark):
    wanted, have = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(1, "a")], "k int, body string")
    assert sorted((r.k, r.body, r.error) for r in scans.answered(wanted, have, "k").collect()) == [(1, "a", None), (2, None, "no response"), (3, None, "no response")]
    provider = lambda missing: missing.where("k = 2").withColumn("body", F.lit("new"))
    assert {(r.k, r.body, r.error) for r in scans.answered(wanted, have, "k", provider).collect()} == {(1, "a", None), (2, "new", None), (3, None, "no response")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", ""), ("2", " ")], "k string, verdict string")
    sinks.refuse_if_filled(df, ["verdict"])
    with pytest.raises(sinks.Filled):
        sinks.refuse_if_filled(df.withColumn("verdict", F.lit("x")), ["verdict"])
    with pytest.raises(KeyError):
        sinks.filled_rows(df, ["nope"])
    sinks.append_jsonl(df, str(tmp_path / "j"))
    sinks.append_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4
    sinks.overwrite(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    sinks.cache_put(spark.createDataFrame([("a", "max_tokens"), ("b", "end"), ("c", None)], "key string, stop_reason string"), str(tmp_path / "c"))
    assert sorted(r.key for r in spark.read.parquet(str(tmp_path / "c")).collect()) == ["b", "c"]
    sinks.write_sheet(df, str(tmp_path / "s"))
    assert scans.read_sheet(spark, str(tmp_path / "s")).columns == ["k", "verdict"]
    sinks.write_template(df, str(tmp_path / "t"), ["k"])
    sinks.write_template(df.where("k = '1'").withColumn("verdict", F.lit("z")), str(tmp_path / "t"), ["k"])
    assert sorted(json.loads(r.value).get("verdict", "").strip() for r in spark.read.text(str(tmp_path / "t")).collect()) == ["", "z"]
    kept = sinks.extend(df, spark.createDataFrame([("2", "n"), ("3", "n")], df.schema), ["k"])
    assert sorted(r.k for r in kept.collect()) == ["1", "2", "3"]
    seal = sinks.sealed(df, ["verdict", "k"])
    assert sinks.broken_seals(seal, ["k", "verdict"]).count() == 0
    assert sinks.broken_seals(seal.withColumn("verdict", F.lit("changed")), ["k", "verdict"]).count() == 2


def test_report_slots(spark):
    body = '{"document": {"a": {"status": "present", "value": " x "}, "b": {"status": "odd", "value": "y"}}, "t": {"c": {"status": "present", "value": "1"}}, "more": 1}'
    df = spark.createDataFrame([(1, body), (2, '{"document": {}, "t": {"status": "present", "value": "v"}}'), (3, "no")], "k int, body string")
    rows = sorted((r.k, r.field, r.status, r.value, r.dropped) for r in forms.flatten_report(df, "k", "body", {"document": ["a", "b"]}, {"t": ["c"]}).collect())
    assert rows == [(1, "document.a", "present", "x", 1), (1, "document.b", "missing", None, 1), (1, "t[0].c", "present", "1", 1), (2, "document.a", "missing", None, 0), (2, "document.b", "missing", None, 0)]


def tail(k, n, p=0.5):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_paired_tests_and_bounds(spark):
    rows = [(0, 0), (12, 1), (13, 0), (5, 5), (3, 9)]
    got = values(spark, rows, "b int, c int", stats.mcnemar(F.col("b"), F.col("c")), stats.mcnemar_one_sided(F.col("b"), F.col("c")))
    for (b, c), (two, one) in zip(rows, got, strict=True):
        n = b + c
        assert math.isclose(two, min(1, 2 * tail(min(b, c), n)) if n else 1, rel_tol=1e-9)
        assert math.isclose(one, min(1, tail(min(b, c) if b < c else b, n)) if n else 1, rel_tol=1e-9)
    bounds = values(spark, [(0, 20), (1, 20), (5, 40), (7, 7)], "h int, n int", "h", "n", stats.upper_bound(F.col("h"), F.col("n")), stats.zero_bound(F.col("n")))
    assert math.isclose(bounds[0][2], 1 - 0.05 ** (1 / 20), abs_tol=1e-9) and math.isclose(bounds[0][2], bounds[0][3], abs_tol=1e-9) and bounds[3][2] == 1
    assert all(math.isclose(tail(h, n, p), 0.05, abs_tol=1e-6) for h, n, p, _ in bounds[:3])


def test_bootstrap_is_near_its_closed_form(spark):
    r = scoring.bootstrap_interval(spark, "/root/testdata/sf0.01").first()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    p, n = labels.agg(F.avg("quality")).first()[0], labels.count()
    se = math.sqrt(p * (1 - p) / n)
    assert abs(r.mean - p) < se and 2 * se < r.high - r.low < 5 * se


def test_bad_strata(spark):
    df = spark.createDataFrame([("a", 5, 2, 1), ("b", 5, 1, 1), ("c", 2, 3, 1), ("d", 3, 2, 3), ("e", 1, 1, 0)], "s string, frame_size int, sampled int, hits int")
    assert sorted(r.s for r in stats.bad_strata(df).collect()) == ["b", "c", "d"]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([([1.0, 1.0, 1.0], [1.0, 2.0, 4.0])], "x array<double>, y array<double>")
    r = df.select(stats.correlation(F.col("x"), F.col("y")), stats.correlation(F.col("y"), F.reverse("y"))).first()
    assert r[0] is None and -1 <= r[1] < 0


def test_picks_by_rank(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", 3.0), ("b", None)], "g string, x double")
    assert {tuple(r) for r in stats.ranked_pick(df, ["g"], "x", 0.9).collect()} == {("a", 9.0), ("b", 3.0)}
    assert {tuple(r) for r in stats.ranked_pick(df, ["g"], "x", 0.5, upper=True).collect()} == {("a", 5.0), ("b", 3.0)}
    assert {tuple(r) for r in df.groupBy("g").agg(stats.nearest_rank("x", 0.9)).collect()} == {("a", 9.0), ("b", 3.0)}


def test_splits_stay_when_rows_are_added(spark):
    few, many = (spark.range(n).select(F.col("id"), (F.col("id") < 5).alias("seen")) for n in (60, 300))
    a, b = ({r.id: r.half for r in sampling.split(df, "id", F.col("seen")).collect()} for df in (few, many))
    assert all(b[i] == h for i, h in a.items()) and all(a[i] == "development" for i in range(5)) and 60 < sum(h == "held_out" for h in b.values()) < 140


def test_adjacency_skips_gaps(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 4, "c"), (2, 3, "d")], "f int, p int, r string")
    assert [tuple(r) for r in joins.adjacent(df, "f", "p", ["r"]).collect()] == [(1, 1, "a", "b")]


def test_fuzzy_labels_abstain_on_ties(spark):
    specs = spark.createDataFrame([("lease", ["lease", "name"]), ("county", ["county"]), ("counts", ["counts"])], "spec string, tokens array<string>")
    labels = spark.createDataFrame([(1, "Leese Name"), (2, "Lease"), (3, "County"), (4, "xyz"), (5, None)], "k int, label string")
    assert {r.k: r.spec for r in joins.fuzzy_labels(labels, specs, "label", "k").collect()} == {1: "lease", 2: None, 3: None, 4: None, 5: None}
    assert {r.k: r.spec for r in joins.fuzzy_labels(labels, specs.where("spec <> 'counts'"), "label", "k").collect()}[3] == "county"


def test_greedy_takes_the_largest_first_and_each_once():
    mark = lambda o, x, a: {"ordinal": o, "x": x, "y": 0.0, "area": a}
    left, right = [mark(0, 0.0, 1.0), mark(1, 0.2, 1.5)], [mark(0, 0.1, 1.2), mark(1, 5.0, 1.0), mark(2, 0.0, 9.0)]
    assert [(i, j) for i, j, _ in joins.greedy_pairs(left, right, 1.0, 0.5)] == [(1, 0)]


@settings(max_examples=60, deadline=None)
@given(st.permutations(range(7)), st.integers(0, 200))
def test_grouping_ignores_the_order_of_pages(order, seed):
    pages = []
    for i in range(7):
        v = {n: ((seed + i * k) // 3) % 3 if (seed + i * k) % 4 else None for k, n in enumerate(grouping.EVIDENCE, 1)}
        pages.append({"page": i, "face": i % 3 == 0, "candidate": i % 3 != 2, "family": [None, "g1", "w2"][(seed + i) % 3], "values": v, "looks_back": (seed + i) % 5 == 0})
    want = grouping.group_file(pages, {(0, 1)})
    assert grouping.group_file([pages[i] for i in order], {(0, 1)}) == want and len(want) == 7
    for page, document, parent, _, reason in want:
        assert (document, parent is not None, reason is not None).count(True) == 1, page


def test_paper_confirms_but_a_contradiction_vetoes():
    base = dict.fromkeys(grouping.EVIDENCE)
    face = {"page": 1, "face": True, "candidate": False, "family": None, "values": base | {"lease": 1, "operator": 2}}
    back = lambda p, **v: {"page": p, "face": False, "candidate": True, "family": None, "values": base | v}
    group = lambda *pages, sure=(): {r[0]: (r[2], r[4]) for r in grouping.group_file([face, *pages], set(sure))}
    assert group(back(2), sure=[(1, 2)])[2] == (1, None)
    assert group(back(2, lease=9), sure=[(1, 2)])[2] == (None, "contradicted")
    assert group(back(2, lease=1))[2] == (None, "below_threshold")
    two = group(back(2, lease=1, operator=2), back(3, lease=1, operator=2))
    assert two[2] == two[3] == (None, "slot_tie")
    assert group(back(2, lease=1, operator=2), back(3), sure=[(1, 3)]) == {1: (None, None), 2: (1, None), 3: (1, None)}


def test_both_forms_of_grouping_agree(spark):
    pages = grouping_plans.pages(spark, "/root/testdata/sf0.01")
    a = sorted(tuple(r) for r in grouping.group_exact(pages).select("file", "page", "parent", "agreed", "reason").fillna({"parent": -1, "agreed": "", "reason": ""}).collect())
    b = sorted(tuple(r) for r in grouping.group_documents(pages).select("file", "page", "parent", "agreed", "reason").fillna({"parent": -1, "agreed": "", "reason": ""}).collect())
    assert a == b and len(a) == pages.count()


def test_inverse_takes_points_back(spark):
    df = spark.createDataFrame([((1.1, 0.2, 0.3, -0.1, 0.9, 0.5), 0.4, 0.7), ((1.0, 2.0, 0.0, 2.0, 4.0, 0.0), 0.0, 0.0)], "m struct<a:double,b:double,c:double,d:double,e:double,f:double>, x double, y double")
    u, v = geometry.apply("m", F.col("x"), F.col("y"))
    rows = df.withColumn("u", u).withColumn("v", v).withColumn("w", geometry.inverse("m"))
    x, y = geometry.apply("w", F.col("u"), F.col("v"))
    (a, b), flat = rows.select(x, y).collect()
    assert math.isclose(a, 0.4) and math.isclose(b, 0.7) and flat == (None, None)


def test_fits_refuse_few_or_collinear_points(spark):
    few = [(1, i * 0.1, (i * i) * 0.01, i * 0.1, i * 0.1) for i in range(7)]
    line = [(2, i * 0.1, i * 0.2, i * 0.1, i * 0.1) for i in range(12)]
    assert geometry.robust_fit(spark.createDataFrame(few + line, "g int, x double, y double, u double, v double"), ["g"]).count() == 0


def test_line_runs_match_a_plain_walk(spark):
    rows = [(1, 0, 0.0, 0.1, 0.5, False), (1, 1, 0.12, 0.2, 0.5, True), (1, 2, 0.21, 0.3, 0.503, False), (1, 3, 0.22, 0.25, 0.7, False), (1, 4, 0.6, 0.7, 0.5, False)]
    got = W.line_run(spark.createDataFrame(rows, "page long, ordinal long, left double, right double, top double, matched boolean"), "page", 0.05).collect()
    assert [tuple(r) for r in got] == [(1, 1, 0.0, 0.3, 3)]


def test_edges_and_rolls(spark):
    df = spark.createDataFrame([([0.0, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0],), ([0.0, 1.0],), ([],)], "v array<double>")
    assert [r[0] for r in df.select(W.first_run(F.col("v"), 3, 0.5)).collect()] == [4, None, None]
    assert [r[0] for r in spark.createDataFrame([([1, 2, 3, 4],)], "v array<int>").select(W.rotated(F.col("v"), 1)).collect()] == [[4, 1, 2, 3]]


def test_batches_match_a_plain_loop(spark):
    sizes = [5, 9, 30, 1, 1, 1, 1, 8, 12, 3]
    df = spark.createDataFrame([("g", i, n) for i, n in enumerate(sizes)], "g string, i int, n long")
    got = [r.batch for r in export.chunks(df, "g", "i", "n", 15, 3).orderBy("i").collect()]
    assert got == [0, 0 + (5 + 9 > 15), 1, 2, 2, 2, 3, 3, 4, 4]


def test_search_needs_every_token(spark):
    df = spark.createDataFrame([(1, "Red widget"), (2, "bored reds"), (3, "blue")], "k int, t string")
    assert {(r.k, r.score) for r in export.search(df, "t", "red!").collect()} == {(1, 2), (2, 1)}
    assert export.search(df, "t", "red widget").count() == 1 and export.search(df, "t", " ").count() == 3


def test_findings_put_errors_first(spark):
    from leafmill.plans import validation

    found = rules.findings(validation.documents(spark, SF))
    for doc in {r.doc_id for r in found.limit(20).collect()}:
        kinds = [r.severity for r in found.where(F.col("doc_id") == doc).orderBy("ordinal").collect()]
        assert kinds == sorted(kinds)


def test_streams_agree_with_their_batch_form(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for i in range(3):
        events.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.read_events(spark, str(tmp_path / "in"), events.schema, 1)
    # files come in any order, so nothing may be late
    got = ingest.drain(ingest.hourly(stream, late="400 days"), "hours", str(tmp_path / "cp"))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(got) == key(ingest.hourly(events))
    for n in range(2):
        q = ingest.resumed(ingest.read_events(spark, str(tmp_path / "in"), events.schema), str(tmp_path / "out"), ["event_id"]).option("checkpointLocation", str(tmp_path / f"r{n}")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_dates_and_field_values_at_their_edges(spark):
    dates = {"1975-4-3": None, "1975-04-03": "1975-04-03", "9 / 22 / 77": None, "9.22.77": "1977-09-22", "1/2/30": "2030-01-02", "1/2/31": "1931-01-02", "1/2/0077": "0077-01-02", "1/2/977": "2877-01-02", "Sept. 4 1977": "1977-09-04", "Ma 4, 1977": None, "2/30/77": None}
    df = spark.createDataFrame([(k,) for k in dates], "x string")
    assert {r.x: r.d and str(r.d) for r in df.select("x", S.parse_date("x").alias("d")).collect()} == dates
    values = {
        ("district", "00"): "0", ("district", "03"): "3", ("date", "March 1990"): "march1990", ("date", "1977-09-22"): "77-9-22", ("date", "9/22/1977"): "9-22-77",
        ("depth", "00450 ft"): "450", ("depth", "none"): None, ("lease", "N.A."): None, ("lease", "n/a"): None, ("lease", "No."): None, ("lease", "0"): None, ("lease", "Smith #1"): "smith1",
        ("received_date", "AUG 18 2009"): "2009-08", ("received_date", "MAR 1990"): "1990-03", ("received_date", "stamp 8 09"): "8-09", ("received_date", "8"): None, ("lease", None): None,
    }
    rows = spark.createDataFrame(list(values), "f string, x string")
    assert {(r.f, r.x): r.v for r in rows.select("f", "x", S.field_value("f", "x").alias("v")).collect()} == values
