import hashlib
from collections import Counter, defaultdict

import duckdb
import pyarrow.parquet as pq

from leafmill.llm import exact, linededup, mixing, queries


def targets(sizes, share=1.5, cap=2.0):
    """Capping round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            open_.discard(s)
        left -= sum(cap * sizes[s] for s in over)
    return out


def test_mix_of_the_table(spark, sf):
    t = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in t}
    per = defaultdict(int)
    for r in t:
        per[r["source"]] += size[r["doc_id"]]
    want = targets(per)
    rows = queries.op3_mix_sources(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(size))
    taken = defaultdict(int)
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == per[r.source] and abs(r.target - want[r.source]) < 1e-6 * want[r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, w in want.items():
        assert abs(taken[s] - w) <= max(r.size for r in rows if r.source == s), (s, taken[s], w)  # one document at most
    assert sum(abs(taken[s] - w) for s, w in want.items()) < 0.01 * sum(want.values())
    again = queries.op3_mix_sources(spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_in_small_chunks_meets_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix_sources(docs, chunk=7, fan_in=3).collect()
    taken, want = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        want[r.source] = r.target
    assert len(rows) == docs.count() and all(abs(taken[s] - w) < 2500 for s, w in want.items())


def test_mix_of_odd_rows(odd, empty, odd_rows):
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(odd_rows) and all(r.taken <= 2 * r.size for r in rows)
    per = defaultdict(int)
    for r in odd_rows:
        per[r[3]] += len((r[1] or "").encode().split())
    want = targets(per)
    assert all(abs(r.target - want[r.source]) < 1e-6 for r in rows)
    assert mixing.mix_sources(empty).count() == 0


def test_pivot_keeps_words_and_leaves_one_fraction():
    sizes, chances = [10, 7, 7, 3, 1, 1], [0.5, 0.25, 0.9, 0.4, 0.5, 0.1]
    for seed in range(50):
        out, at = mixing.pivot(sizes, chances, [f"{seed}/{i}" for i in range(6)])
        assert abs(sum(s * c for s, c in zip(sizes, out, strict=True)) - sum(s * c for s, c in zip(sizes, chances, strict=True))) < 1e-9
        assert sum(0 < c < 1 for c in out) <= 1 and (at is None) == all(c in (0, 1) for c in out)


def test_pivot_is_fair():
    totals = [0.0] * 3
    for seed in range(4000):
        out, at = mixing.pivot([5, 3, 2], [0.3, 0.6, 0.5], [f"{seed}/{i}" for i in range(3)])
        totals = [a + b for a, b in zip(totals, out, strict=True)]
    assert all(abs(t / 4000 - w) < 0.03 for t, w in zip(totals, [0.3, 0.6, 0.5], strict=True))


LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_exact_dedup_of_odd_rows(odd, odd_rows, empty):
    groups = defaultdict(list)
    for r in odd_rows:
        groups[(r[1] or "").translate(LOW)].append(r[0])
    for keep, best in (("max", max), ("min", min)):
        rows = exact.exact_dedup(odd, keep=keep).collect()
        assert len(rows) == len(odd_rows) and sum(r.kept for r in rows) == len(groups)
        for text, ids in groups.items():
            mine = [r for r in rows if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
            known = [i for i in ids if i is not None]
            assert sorted(map(str, (r.doc_id for r in mine))) == sorted(map(str, ids))
            assert {r.keep_id for r in mine} == {best(known) if known else None} and {r.group_size for r in mine} == {len(ids)}
            assert all(r.doc_id == r.keep_id for r in mine if r.kept)
    assert exact.exact_dedup(empty).count() == 0


def test_exact_dedup_matches_sql(spark, sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    names = "doc_id, keep_id, group_size, kept, text_sha256"
    want = sorted(duckdb.sql(f"SELECT {names} FROM ({exact.ORACLE})").fetchall())
    assert sorted(map(tuple, queries.op8_exact_dedup(spark, sf).select(*names.split(", ")).collect())) == want


def test_runs_merge_in_any_tree(odd):
    rows = exact.digests(odd)
    want = sorted(map(str, exact.merge_runs(rows, runs=1).collect()))
    for runs, fan_in in ((4, 2), (64, 4), (512, 8)):
        assert sorted(map(str, exact.merge_runs(rows, runs=runs, fan_in=fan_in).collect())) == want


NOTICE = "This notice number {} was printed on page {} of the bulletin for all readers"
LONG = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))


def brute_lines(rows, min_docs=3):
    """The same templates, by hand: tokens with a digit are open; long lines also match by either half."""
    found, mine = defaultdict(dict), {}
    docs = sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    for d, text in docs:
        for n, line in enumerate(text.split("\n")):
            w = ["<*>" if any(c in "0123456789" for c in x) else x for x in line.encode().decode().split()]
            if len(w) < 8:
                continue
            half = (len(w) - 3) // 2
            parts = [("whole", tuple(w[3:]))] + ([("first", tuple(w[3 : 3 + half])), ("second", tuple(w[3 + half :]))] if len(w) >= 24 else [])
            mine[d, text, n] = keys = [(len(w), tuple(w[:3]), *p) for p in parts]
            for k in keys:
                found[k].setdefault((d, text), n)
    out = {}
    for (d, text, n), keys in mine.items():
        for k in keys:
            if len(found[k]) >= min_docs and next(iter(found[k].items())) != ((d, text), n):
                out.setdefault((d, text), set()).add(n)
    return {k: gone for k, gone in out.items() if any(x.encode().split() for n, x in enumerate(k[1].split("\n")) if n not in gone)}


def test_recurring_lines_go_and_their_first_stays(spark):
    odd_one = LONG.replace("wza", "other")
    rows = [(i, f"own text number {chr(97 + i)} stays here because nobody else has it\n{NOTICE.format(i, i * 7)}\n{LONG if i % 2 else odd_one}", "clash") for i in range(6)]
    rows += [(7, None, "x"), (8, "", "x"), (None, NOTICE.format(1, 2), "x"), (2, rows[2][1], "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    got = {(r.doc_id, r.n_dropped): r for r in linededup.line_dedup(docs).collect()}
    assert got[0, 0].text == rows[0][1] and got[7, 0].text is None and got[8, 0].text == "" and got[None, 0].text == NOTICE.format(1, 2)
    assert all(got[i, 2].text == rows[i][1].split("\n")[0] for i in range(1, 6))
    assert linededup.line_dedup(docs).count() == len(rows)


def test_line_dedup_of_the_table(spark, sf):
    t = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    want = brute_lines(t)
    rows = {r.doc_id: r for r in queries.op9_line_dedup(spark, sf).collect()}
    assert len(rows) == len(t)
    for d, text in t:
        gone = want.get((d, text), set())
        kept = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone)
        assert rows[d].n_dropped == len(gone) and rows[d].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest(), d


def test_line_dedup_of_an_empty_table(empty):
    assert linededup.line_dedup(empty).count() == 0
