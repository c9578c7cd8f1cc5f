"""Paged sources, images, overlays, marks."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.operators import grouping, marks, overlays
from leafmill.plans import extras
from leafmill.sources import images, paged


def test_paged_source(spark, tmp_path):
    for p in range(3):
        items = [{"id": i, "v": i * i} for i in range(p * 4, min(10, p * 4 + 4))]
        (tmp_path / f"page-{p + 1:05d}.json").write_text(json.dumps({"total": 10, "items": items}))
    paged.register(spark)
    load = lambda **o: spark.read.format("paged").options(path=str(tmp_path), pagesize="4", **o).load()
    rows = load().collect()
    assert sorted(int(r.id) for r in rows) == list(range(10)) and json.loads(rows[0].item)["v"] >= 0
    assert load(maxpages="2").count() == 8
    with pytest.raises(Exception, match="implausible"):
        load(most="5").count()


def pgm(image):
    return b"P5\n%d %d\n255\n" % image.shape[::-1] + image.astype(np.uint8).tobytes()


def test_texts_and_sheet_bounds(spark, tmp_path):
    sheet = np.zeros((30, 40))
    sheet[5:25, 10:35] = 255
    (tmp_path / "a.pgm").write_bytes(pgm(sheet))
    (tmp_path / "b.pgm").write_bytes(pgm(np.zeros((4, 4))))
    (tmp_path / "c.pgm").write_bytes(b"junk")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = {r.path[-5]: (r.l, r.t, r.r, r.b) for r in images.sheet_bounds(files).collect()}
    assert got == {"a": (10, 5, 35, 25), "b": (None,) * 4, "c": (None,) * 4}
    texts = {r.path[-5]: (r.text, r.error is None) for r in images.texts(files, lambda b: b.decode()).collect()}
    assert texts["c"] == ("junk", True) and texts["a"] == (None, False)


def test_eligibility(spark):
    df = spark.createDataFrame([("g1", "face", False), ("g1", "face", True), ("plat_map", "face", None), ("w2", None, None), ("w2", "sec_ii", None)], "c string, p string, o boolean")
    assert [r[0] for r in df.select(images.eligible(F.col("c"), F.col("p"), F.col("o"))).collect()] == [True, False, False, None, True]


def test_labels_that_no_page_has(spark):
    rows = [("g1", None, None), ("plat_map", "face", None), ("w2", "face", False), ("completion_face_unknown_form", "back_instructions", None), ("g1", "face", True), ("other_form", None, False)]
    assert overlays.broken_labels(spark.createDataFrame(rows, "form_class string, part string, form_number_legible boolean")).count() == 4


def sheet_marks(rng, n=5, points=720):
    xy = rng.uniform(0.05, 0.95, (n, 2))
    smooth = np.convolve(rng.normal(size=points * n + 20), np.ones(20) / 20, "same")[: points * n].reshape(n, points)
    return xy, np.full(n, 0.05), [row for row in smooth]


def sheets(spark, *pairs):
    """Marks of numbered page pairs from ((xy, area, outlines) of the front, of the back)."""
    rows = [(n, side, float(x), float(y), float(a), [float(v) for v in o]) for n, sides in enumerate(pairs) for side, (xy, area, outline) in enumerate(sides) for (x, y), a, o in zip(xy, area, outline, strict=True)]
    return spark.createDataFrame(rows, "pair long, side int, x double, y double, area double, outline array<double>")


def other_side(xy, outline, flip):
    """What the back of a sheet shows after the flip; an angle's profile is read backwards, from half way on for flip_h."""
    back = [o[::-1] for o in outline]
    if flip == "flip_h":
        return np.abs(np.array([1, 0]) - xy), [np.roll(o, len(o) // 2) for o in back]
    return np.abs(np.array([0, 1]) - xy), back


def test_one_sheet_is_confirmed_from_both_sides_and_others_abstain(spark):
    (xy, area, one), (_, _, two) = sheet_marks(np.random.default_rng(7)), sheet_marks(np.random.default_rng(8))
    pairs, shift = [], np.array([0.013, -0.02])
    for flip in ("flip_v", "flip_h"):
        there, seen = other_side(xy, one, flip)
        pairs.append(((xy, area, one), (there + shift, area, seen)))
    there, seen = other_side(xy, one, "flip_v")
    pairs.append(((xy, area, two), (there, area, seen)))  # other tears at the same places
    pairs.append(((xy, area, one), (xy, area, one)))  # the same side twice
    pairs.append(((xy[:1], area[:1], one[:1]), (there, area, seen)))
    pairs.append(((xy[:0], area[:0], one[:0]), (there, area, seen)))
    pairs.append(((xy, area, [np.ones(720)] * 5), (there, area, seen)))  # no shape on one side
    got = {r.pair: r for r in marks.compare(sheets(spark, *pairs)).collect()}
    assert [(got[n].confirmed, got[n].transform, got[n].agreeing, got[n].reason) for n in (0, 1)] == [(True, "flip_v", 5, "agree"), (True, "flip_h", 5, "agree")]
    assert not any(got[n].confirmed for n in range(2, 7))
    assert [got[n].reason for n in (2, 4, 5, 6)] == ["below_margin", "single", "unmarked", "below_margin"]


def test_marks_that_a_flip_lays_on_their_own_page_tell_nothing(spark):
    _, _, one = sheet_marks(np.random.default_rng(7))
    punched = (np.array([[0.3, 0.5], [0.7, 0.5]]), np.array([0.05, 0.05]), one[:2])
    rows = marks.compare(sheets(spark, (punched, punched))).collect()
    assert not rows[0].confirmed and rows[0].ambiguous == 4


def test_slow_waves_go_and_tears_stay(spark):
    turn = np.arange(72) * 2 * np.pi / 72
    slow, fast = 3 + np.cos(turn) - 2 * np.sin(2 * turn), np.cos(5 * turn)
    df = spark.createDataFrame([((slow + fast).tolist(),), (None,), ([1.0],)], "o array<double>")
    got = [r[0] for r in df.select(marks.tear("o")).collect()]
    assert np.allclose(got[0], fast) and got[1:] == [None, None]


def test_half_of_the_made_up_pairs_are_one_sheet(spark):
    rows = {r.pair: r.confirmed for r in extras.paper_compare(spark, "/root/testdata/sf0.001").collect()}
    assert all(c == (p % 2 == 0) for p, c in rows.items() if p < 40)


def test_confirmed_pairs_are_adjacent_pages_of_a_file(spark):
    verdicts = spark.createDataFrame([(1, True), (2, True), (3, False), (4, True)], "pair long, confirmed boolean")
    pages = spark.createDataFrame([(1, 7, 1, 7, 2), (2, 7, 1, 7, 4), (3, 7, 2, 7, 3), (4, 7, 1, 8, 2)], "pair long, file long, page long, back_file long, back_page long")
    assert [tuple(r) for r in marks.confirmed_pairs(verdicts, pages).collect()] == [(7, 1, 2)]


def test_chips_stay_on_the_page_and_apart_where_there_is_room(spark):
    rows = extras.chip_places(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(0 <= r.x <= 982 and 0 <= r.y <= 988 for r in rows)
    for page in range(60):
        spots = [(r.x, r.y) for r in rows if r.page == page]
        assert all(abs(a - c) >= 18 or abs(b - d) >= 12 for i, (a, b) in enumerate(spots) for c, d in spots[:i])


def test_confirmations_reach_the_grouping(spark):
    values = {n: None for n in grouping.EVIDENCE}
    schema = "file long, page long, face boolean, candidate boolean, family string, confirmed array<long>, values struct<" + ",".join(f"{n}:string" for n in grouping.EVIDENCE) + ">"
    df = spark.createDataFrame([(1, 1, True, False, None, None, values), (1, 2, False, True, None, [1], values), (1, 3, False, True, None, None, values)], schema)
    got = {r.page: (r.parent, r.reason) for r in grouping.group_exact(df).collect()}
    assert got == {1: (None, None), 2: (1, None), 3: (None, "below_threshold")}
