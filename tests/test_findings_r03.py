"""Cases of round 3's findings: dense pages, against plain loops, by plans that hold no pairs."""

import math
import random
import time
from collections import Counter

from leafmill.operators import joins
from leafmill.operators import windows as W
from leafmill.plans import catalogue


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_dense_neighbours_are_counted_without_pairs_or_broadcasts(spark):
    draw = random.Random(3)
    marks = [(p, i if i % 50 else 0, draw.random() * 2 if p else draw.randrange(40) / 25, draw.random() * 2, draw.randrange(0, 30) / 10) for p in range(2) for i in range(600)] + [(0, 9000, None, 1.0, 1.0), (0, 9001, float("nan"), 1.0, 1.0)]
    got = W.neighbours_in_radius(spark.createDataFrame(marks, "page long, ordinal long, x double, y double, area double"), "page", "ordinal", 0.35)
    want = {}
    for p, i, x, y, a in marks:
        near = sum(p == q and i != j and None not in (x, u) and ((x - u) ** 2 + (y - v) ** 2) ** 0.5 <= 0.35 and max(a, b) <= 2 * min(a, b) for q, j, u, v, b in marks)
        want[p, i] = want.get((p, i), 0) + near
    assert sorted((r.page, r.ordinal, r.near) for r in got.collect()) == sorted((p, i, want[p, i]) for p, i, *_ in marks)
    assert "Broadcast" not in plan_of(got) and plan_of(got).count("SortMergeJoin") >= 1


def test_greedy_matches_of_a_dense_page_pair_are_those_of_one_loop():
    draw = random.Random(5)
    for grid in (False, True):
        sides = [[{"ordinal": o, "x": draw.randrange(30) / 25 if grid else draw.random(), "y": draw.random(), "area": draw.randrange(1, 30) / 10} for o in draw.sample(range(900), 400)] for _ in range(2)]
        free, want = dict(enumerate(sides[1])), []
        for i, a in sorted(enumerate(sides[0]), key=lambda m: (-m[1]["area"], m[1]["ordinal"])):
            near = [(math.hypot(a["x"] - b["x"], a["y"] - b["y"]), b["ordinal"], j) for j, b in free.items() if min(a["area"], b["area"]) >= 0.5 * max(a["area"], b["area"])]
            if near and min(near)[0] <= 0.3:
                want.append((i, min(near)[2], min(near)[0]))
                del free[min(near)[2]]
        assert joins.greedy_pairs(*sides, 0.3, 0.5) == want and len(want) > 200


def test_greedy_matches_of_twenty_thousand_marks_take_seconds():
    draw = random.Random(6)
    sides = [[{"ordinal": o, "x": draw.random(), "y": draw.random(), "area": draw.randrange(1, 50) / 10} for o in range(20_000)] for _ in range(2)]
    begun = time.process_time()
    found = joins.greedy_pairs(*sides, 0.3, 0.5)
    # one loop over all free partners looks at 400 million pairs
    assert len({i for i, *_ in found}) == len({j for _, j, _ in found}) == len(found) > 15_000 and time.process_time() - begun < 30


def test_lone_box_partners_of_a_dense_page_are_found_without_a_row_per_pair(spark):
    draw = random.Random(8)

    def boxes(first):
        for i in range(500):
            spot = (0.1, 0.05) if i < 300 else (2.0, 2.0)  # a crowd, and boxes of which some have one partner
            x, y = draw.random() * spot[0], draw.random() * spot[1]
            yield draw.randrange(2), first + (i if i % 97 else 0), (x, y, x + 0.05 + draw.random() * 0.1, y + 0.05 + draw.random() * 0.1)

    left, right = list(boxes(0)), list(boxes(1000))

    def iou(a, b):
        both = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
        return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)

    pairs = [(p, i, j, iou(a, b)) for p, i, a in left for q, j, b in right if p == q and iou(a, b) >= 0.3]
    n1, n2 = (Counter((p[0], p[k]) for p in pairs) for k in (1, 2))
    want = sorted(p for p in pairs if n1[p[0], p[1]] == n2[p[0], p[2]] == 1)
    frames = [spark.createDataFrame(rows, f"page long, {name} long, box struct<l:double,t:double,r:double,b:double>") for rows, name in ((left, "id1"), (right, "id2"))]
    got = joins.mutual_unique(*frames, "page", "id1", "id2").select("page", "id1", "id2", "iou")
    assert sorted(map(tuple, got.collect())) == want and len(want) > 5
    assert "Join" not in plan_of(got)


def walked(rows, cutoff, line):
    out, rows = [], sorted(rows, key=lambda r: (r[2], r[1]))
    for start, row in enumerate(rows):
        if not row[5]:
            continue
        lo = hi = row
        n = 1
        for r in rows[start + 1 :]:
            if abs(r[4] - hi[4]) <= line:
                if r[2] - hi[3] > cutoff:
                    break
                hi, n = r, n + 1
        for r in reversed(rows[:start]):
            if abs(r[4] - lo[4]) <= line:
                if lo[2] - r[3] > cutoff:
                    break
                lo, n = r, n + 1
        out.append((row[0], row[1], lo[2], hi[3], n))
    return out


def test_line_runs_of_clear_and_of_drifting_lines_are_those_of_a_walk(spark):
    draw, rows, want = random.Random(9), [], []
    for page in range(12):
        # even pages have lines apart; on odd ones lines drift into each other
        tops = [draw.randrange(5) * 0.02 + draw.random() * 0.003 if page % 2 == 0 else draw.random() * 0.06 for _ in range(80)]
        lefts = [draw.random() for _ in tops]
        own = [(page, i, x, x + draw.random() * 0.05, t, draw.random() < 0.2) for i, (x, t) in enumerate(zip(lefts, tops, strict=True))]
        rows += own
        want += walked(own, 0.05, 0.006)
    draw.shuffle(rows)
    got = W.line_run(spark.createDataFrame(rows, "page long, ordinal long, left double, right double, top double, matched boolean"), "page", 0.05)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_words_of_a_page_are_not_shuffled(spark):
    # texts move once by doc_id; pooling by token moves what is left
    for name, moves in (("line_run", 1), ("pooled_medians", 2)):
        plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == moves and plan.count("Exchange hashpartitioning(doc_id") == 1, plan
