import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.llm import common, components, fingerprint, jaccard, quality, queries, toxicity, urls


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    """Every pair that shares a shingle is compared."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    for i, s in enumerate(sets):
        for j, shared in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=key)


def test_jaccard_join_of_the_table(spark, sf):
    t = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    assert joined(queries.op2_jaccard_join(spark, sf)) == sorted(brute_components(t), key=key)


def chained_rows():
    """Chains in which only neighbours link, stars of near copies, and texts that share a long passage only."""
    rng, rows = np.random.default_rng(3), []
    passage = " ".join(f"shared{i}" for i in range(40))
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(60)]
        for k in range(12):
            rows.append(" ".join(words))
            words[(7 * k) % 60] = f"g{g}k{k}"
    base = [f"b{i}" for i in range(80)]
    for k in range(60):
        words = list(base)
        words[int(rng.integers(80))] = f"edit{k}"
        rows.append(" ".join(words))
    for k in range(50):
        rows.append(" ".join([f"u{k}x{i}" for i in range(12)] + [passage]))
        rows.append(" ".join([f"v{k}x{i}" for i in range(3)] + [passage]))
    rows += ["a b", "A B", "a b c", "a", "", None, " \t", rows[0], rows[0].upper()]
    order = rng.permutation(len(rows))
    return [(int(i), rows[int(i)]) for i in order]


@pytest.mark.parametrize(("pivots", "cell"), [(2, 8), (6, 20)])
def test_links_of_chains_stars_and_passages(spark, pivots, cell, monkeypatch):
    rows, told = chained_rows(), []
    monkeypatch.setattr(jaccard.links, "__defaults__", (80, pivots, cell, 0.4, None))
    monkeypatch.setattr(jaccard, "CELL", cell)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert joined(jaccard.jaccard_components(df, told=told)) == sorted(brute_components(rows), key=key)
    assert sum(r["split"] for r in told[1:]) > 0 and sum(r["windows"] for r in told) > 0


def crowd(n, words=72, edits=4, seed=1):
    """Near copies of one text, each with edits of its own: many link with no other, all are near all."""
    rng, base = np.random.default_rng(seed), [f"c{i}" for i in range(words)]
    rows = []
    for i in range(n):
        mine = list(base)
        for k in rng.choice(words, 1 + i % edits, replace=False):
            mine[k] = f"e{i % 97}x{k}"
        rows.append((i, " ".join(mine)))
    return rows


def test_production_parameters_split_a_crowd_and_make_windows(spark):
    rows, told = crowd(1500, 60, 2), []
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert joined(jaccard.jaccard_components(df, told=told)) == sorted(brute_components(rows), key=key)
    assert sum(r["split"] for r in told[1:]) > 0 and sum(r["windows"] for r in told) > 0


def test_parts_of_a_region_hold_each_pair_near_enough_once(spark):
    """Points on a line stand for sets: each pair within reach of which one was at home meets where one is at home."""
    rng = np.random.default_rng(1)
    at, home = np.sort(rng.random(60)) * 2, rng.random(60) < 0.7
    far = lambda d: float(min(1.0, d))
    spans = [("r", i, 9, 9, bool(home[i]), 60, p, far(abs(at[i] - at[p])), far(abs(at[i] - at[p])) if abs(at[i] - at[p]) <= 0.4 else 1.0) for p in (3, 20, 40) for i in range(60) if i not in (3, 20, 40)]
    df = spark.createDataFrame([(1, *s[1:]) for s in spans], "region long, node long, n long, most long, home boolean, homes long, p long, low double, high double")
    parts = defaultdict(list)
    for r in jaccard.voronoi(df, None, 0.4, 0.2, 1).collect():
        parts[r.region].append((r.node, r.home))
    met = Counter()
    for rows in parts.values():
        for x, hx in rows:
            for y, hy in rows:
                if x < y and (hx or hy):
                    met[x, y] += 1
    rest = [i for i in range(60) if i not in (3, 20, 40)]
    for i in rest:
        for j in rest:
            if i < j and abs(at[i] - at[j]) <= 0.2 and (home[i] or home[j]):
                assert met[i, j] >= 1, (i, j)
                assert met[i, j] == 1 or not (home[i] and home[j])


def test_jaccard_join_of_odd_rows(odd, odd_rows, empty):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert joined(jaccard.jaccard_components(odd)) == sorted(brute_components(rows), key=key)
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.keep_one(empty).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    texts = Counter(r.text for r in kept.collect())
    assert texts[""] == 3 - 1 and texts[None] == 2 and sum(texts[t] for t in texts if t and "many documents share" in t) == 1


def test_ids_of_any_type_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [("b", text, 1, "x"), ("a", text + " more", 2, "y"), (None, text, 3, "z"), ("c", None, 4, "n"), ("c", None, 4, "n")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n long, component_id string")
    assert {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect()} == {("b", "a"), ("a", "a"), (None, "a"), ("c", "c")}
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == [rows[1], rows[3]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=40), st.lists(st.sampled_from("abcdef"), max_size=40))
def test_sets_alike_share_a_prefix_in_any_order(x, y):
    known = jaccard._Words()
    a, b = (jaccard.shingles(" ".join(v).encode(), known) for v in (x, y))
    hot = np.unique(np.concatenate([a[::2], b[::3]])) if len(a) and len(b) else np.zeros(0, np.uint64)
    shared = len(np.intersect1d(a, b))
    if shared and 100 * shared >= 80 * (len(a) + len(b) - shared):
        pa, pb = (jaccard.prefix(v, hot, np.arange(len(hot))) for v in (a, b))
        assert len(np.intersect1d(pa, pb))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=600), st.lists(st.integers(0, 400), max_size=90))
def test_sketches_bound_what_is_shared(x, y):
    a, b = (np.unique(jaccard._mix(np.array(v, np.uint64))) for v in (x, y))
    assert len(np.intersect1d(a, b)) <= jaccard.most_shared(jaccard.sketch(a), jaccard.sketch(b), len(a), len(b)) <= min(len(a), len(b))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_components(spark, edges):
    parent = {i: i for e in edges for i in e}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {i for a, b in edges if a != b for i in (a, b)}
    assert got == {i: min(j for j in parent if find(j) == find(i)) for i in linked}


def naive_levels(x):
    out = []
    for i in range(len(x) - 63):
        total = sum(int(fingerprint._G[c]) for c in Counter(x[i : i + 64]).values())
        top = 6 * 64 * fingerprint._UNIT
        out.append((top - total) * 1000 // top)
    return out


def naive_features(ranks):
    if len(ranks) <= 64:
        return [ranks.index(min(ranks))]
    votes = Counter()
    for i in range(len(ranks) - 63):
        part = ranks[i : i + 64]
        votes[i + part.index(min(part))] += 1
    chosen = sorted(p for p, n in votes.items() if n >= fingerprint.VOTES)
    return chosen or [max(sorted(votes), key=lambda p: votes[p])]


def test_entropies_and_features_match_a_plain_form():
    rng = np.random.default_rng(1)
    for n in (64, 65, 127, 128, 129, 300, 900):
        x = rng.integers(97, 103, n).astype(np.uint8)
        x[: n // 3] = 97
        levels = fingerprint.window_entropies(x)
        assert levels.tolist() == naive_levels(x.tobytes())
        ranks = (levels * 7919) % 1001
        assert fingerprint._features(x, ranks).tolist() == naive_features(ranks.tolist())
    big = rng.integers(0, 256, 150_000).astype(np.uint8)
    assert fingerprint.window_entropies(big)[::5000].tolist() == [naive_levels(big[i : i + 64].tobytes())[0] for i in range(0, len(big) - 63, 5000)]


def check_fingerprints(rows, docs, unique_ids=True):
    order = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0))
    texts = [t or "" for _, t in order]
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for (d, _), t, u in zip(order, texts, texts[1:] + texts[:1], strict=True):
        r, m = by[d], len(t) // 2
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256((t[: len(t) - m] + u[:m]).encode()).hexdigest(), d
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if t == u:
            assert r.near_next == 1 and r.near_edited == 1
    same = defaultdict(set)
    for (d, _), t in zip(order, texts, strict=True):
        same[t].add(by[d].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_fingerprints_of_the_table(spark, sf):
    t = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    rows = queries.op10_fingerprints(spark, sf).collect()
    check_fingerprints(rows, t)
    a, b = np.array([r.near_edited for r in rows]), np.array([r.near_next for r in rows])
    assert np.median(a) > 0.3 and np.median(b) < 0.05 and (a > b).mean() > 0.9


def test_fingerprints_over_many_ranges_and_any_layout(spark, sf):
    """Several ranges, ids repeated across their borders; files and batches change no fingerprint and no likeness."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 120")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0")).unionByName(docs.where("doc_id % 7 = 0").withColumn("text", docs.lang)).cache()
    want = [(r.doc_id, r.text) for r in docs.collect()]
    seen = set()
    for n, mb in ((1, 0.02), (7, 0.02), (3, 24)):
        rows = fingerprint.neighbour_likeness(docs.repartition(n), part_mb=mb).collect()
        assert len(rows) == len(want)
        seen.add(tuple(sorted((r.doc_id, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in rows)))
    assert len(seen) == 1
    size = sum(len((t or "").encode()) for _, t in want)
    assert size / (0.02 * 2**20) > 5
    once = docs.dropDuplicates(["doc_id"])
    check_fingerprints(fingerprint.neighbour_likeness(once.repartition(3), part_mb=0.02).collect(), [(r.doc_id, r.text) for r in once.collect()])


def plain_likeness(a, b):
    """The definition, filter by filter and bit by bit."""
    a, b = ([set(np.flatnonzero(np.unpackbits(row)).tolist()) for row in chain] for chain in (a, b))
    if not a or not b:
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for x in a:
        best = 0.0
        for y in b:
            most, chance = min(len(x), len(y)), len(x) * len(y) / 2048
            cut = chance + 0.1 * (most - chance)
            best = max(best, (len(x & y) - cut) / max(most - cut, 1e-9))
        total += best
    return min(1.0, total / len(a))


def test_likeness_of_neighbours_by_its_definition(spark, sf):
    t = sorted((r["doc_id"], r["text"] or "") for r in pq.read_table(f"{sf}/documents.parquet").to_pylist())[:60]
    rows = {r.doc_id: r for r in fingerprint.neighbour_likeness(spark.createDataFrame(t, "doc_id long, text string")).collect()}
    for (d, _), (e, _) in zip(t, t[1:] + t[:1], strict=True):
        own, new, after = (fingerprint.read(x) for x in (rows[d].fingerprint, rows[d].edited_fingerprint, rows[e].fingerprint))
        assert rows[d].near_edited == pytest.approx(plain_likeness(own, new), abs=1e-9)
        assert rows[d].near_next == pytest.approx(plain_likeness(own, after), abs=1e-9)


def test_fingerprints_with_ids_of_text(spark):
    rows = [("b", "y" * 70), ("a", None), (None, "last"), ("c", "z"), ("é", "w")]
    got = {r.doc_id: r for r in fingerprint.neighbour_likeness(spark.createDataFrame(rows, "doc_id string, text string"), part_mb=1e-5).collect()}
    order = ["a", "b", "c", "é", None]
    texts = dict(rows)
    for d, e in zip(order, order[1:] + order[:1], strict=True):
        x, y = texts[d] or "", texts[e] or ""
        assert got[d].edited_sha256 == hashlib.sha256((x[: len(x) - len(x) // 2] + y[: len(x) // 2]).encode()).hexdigest()


def test_fingerprints_of_odd_rows(spark, odd_rows, empty):
    rows = [(r[0], r[1]) for r in odd_rows[:18]] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_fingerprints(fingerprint.neighbour_likeness(df).collect(), rows)
    one = spark.createDataFrame([(1, "x" * 100)], "doc_id long, text string")
    assert fingerprint.neighbour_likeness(one).first().near_next == 1
    twice = spark.createDataFrame([(1, "same"), (1, "same"), (2, None), (2, "b")], "doc_id long, text string")
    assert fingerprint.neighbour_likeness(twice).count() == 4
    assert fingerprint.neighbour_likeness(empty).count() == 0
    assert fingerprint.fingerprints(df).count() == len(rows)


def test_likeness_of_chains():
    rng = np.random.default_rng(2)
    ranks = np.arange(1001)
    a, b = (bytes(rng.integers(97, 123, 30_000).astype(np.uint8)) for _ in range(2))
    x, y, z = fingerprint.chains([a, a[:15_000] + b[:15_000], b], ranks)
    assert len(x) > 1 and fingerprint.likeness(x, x) == 1 and fingerprint.likeness(x, z) < 0.1 and 0.3 < fingerprint.likeness(x, y) < 0.8
    assert np.array_equal(fingerprint.read(fingerprint.write(x)), x)


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def accuracy(rows, labels):
    mine = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    return sum(p == y for p, y in mine) / len(mine)


def test_quality_of_held_out_rows(spark, sf):
    rows = queries.op7_quality(spark, sf).collect()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.3) for r in rows)
    assert accuracy(rows, labels) > 0.95


def test_toxicity_of_held_out_rows(spark, sf):
    rows = queries.op6_toxicity(spark, sf).collect()
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) for r in rows)
    assert accuracy(rows, labels) > 0.9


def test_scores_of_odd_rows_and_few_labels(spark, odd, empty, odd_rows):
    some = spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(18)] + [(None, 1, 1), (3, None, None), (4, 7, -1)], "doc_id long, quality int, toxic int")
    none = some.where("false")
    for labels in (some, none, some.where("quality = 1 AND toxic = 0")):
        for rows in (quality.quality_scores(odd, labels).collect(), toxicity.toxicity_scores(odd, labels).collect()):
            assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in rows)
            assert all(r.held_out for r in rows if r.doc_id is None)
        kept = toxicity.toxicity_scores(odd, labels, keep=True)
        assert kept.columns == [*odd.columns, "score", "predicted"] and kept.count() == len(odd_rows)
        assert quality.quality_scores(empty, labels).count() == 0 and toxicity.toxicity_scores(empty, labels).count() == 0


def test_held_out_labels_teach_nothing(spark, sf):
    docs, labels = (common.table(spark, sf, n) for n in ("documents", "labels"))
    other = labels.withColumn("toxic", (common.held_out() != (labels.toxic == 1)).cast("int")).withColumn("quality", (common.held_out() != (labels.quality == 1)).cast("int"))
    for f in (toxicity.toxicity_scores, quality.quality_scores):
        a, b = ({r.doc_id: round(r.score, 9) for r in f(docs, x).collect()} for x in (labels, other))
        assert a == b


def test_label_model_finds_good_voters_and_shares_weight():
    rng = np.random.default_rng(4)
    y = rng.random(4000) < 0.3
    vote = lambda right: np.where(rng.random(4000) < right, y, ~y) * 2 - 1
    good, fair = vote(0.95), vote(0.75)
    votes = np.stack([good, fair, vote(0.75), vote(0.5), fair, vote(0.8), vote(0.85), vote(0.8)], axis=1).astype(np.int8)
    model = toxicity.LabelModel(votes, 0.3)
    assert model.accuracy[0] > model.accuracy[1] > model.accuracy[3] and model.weights[1] < model.weights[2] and model.correlations[1, 4] > 0.9
    assert ((model.posterior > 0.5) == y).mean() > 0.9


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda f: len(f[0])) if fits else (None, None))


URLS = [None, "", "no scheme", "http://", "https://COM/", "http://xCOM/", "http://a.com", "http://a.com?x=/en/", "http://Example.com/en/1", "http://www.example.com/en/", "ftp://b.www.example.com/en/x#y", "x://y://a.net/es/", "http://a.net/fr", "http://a.net/fr/z?q", "http://É.com/É", "http://free-casino-bets.org/play", "http://cheappillscasino.org/a", "http://a.net/de/\nx"]


def test_rules_and_parts_of_urls(spark):
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(URLS + URLS)], "page_id long, url string, html string, host string")
    rows = urls.judge_urls(pages).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path, rule, verdict = brute_rule(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block"), r
    assert urls.judge_urls(pages.where("false")).count() == 0


def test_urls_of_the_table(spark, sf):
    rows = queries.op5_url_filters(spark, sf).collect()
    t = {r["page_id"]: r["url"] for r in pq.read_table(f"{sf}/pages.parquet").to_pylist()}
    topics = ("spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track")
    for r in rows:
        host, path, rule, verdict = brute_rule(t[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if any(x in host for x in topics) else "allow")), r


def test_names_are_split_into_words():
    split = urls.Splitter({"free": 50, "casino": 20, "bets": 20, "be": 60, "a": 90, "in": 80}).split
    assert split("freecasinobets") == ["free", "casino", "bets"] and split("") == [] and "".join(split("zqxfree")) == "zqxfree"


def cheapest_split(name, counts):
    """Every way to cut the name, priced by the definition."""
    total = sum(counts.values()) + 1
    price = lambda w: math.log(total / counts[w]) if w in counts else (math.log(total) + 2) * len(w)
    ways = [[name[i:j] for i, j in zip((0, *cut), (*cut, len(name)), strict=True)] for n in range(len(name)) for cut in itertools.combinations(range(1, len(name)), n)]
    return min(sum(map(price, way)) for way in ways), price


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=9), st.dictionaries(st.text("abc", min_size=1, max_size=4), st.integers(1, 50), max_size=8))
def test_viterbi_finds_the_cheapest_of_all_splits(name, counts):
    least, price = cheapest_split(name, counts)
    got = urls.Splitter(counts).split(name)
    assert "".join(got) == name and sum(map(price, got)) == pytest.approx(least)


def test_verdicts_by_a_plain_naive_bayes(spark, sf):
    """Counts of all pages gathered in plain loops, multinomial Bayes by its formula, on every url of the table."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    parts = {r.page_id: (r.host, r.path) for r in rows.values()}
    host, path = urls.url_parts(pages.url)
    splitter = urls.Splitter(urls.word_counts(pages, pages.select(host.alias("host"), path.alias("path")), "html"))
    found = {k: urls.tokens(*p, splitter) for k, p in parts.items()}
    bad = {k for k, t in found.items() if any(x[2:] in urls.TOPICS for x in t)}
    classes = [Counter(x for k, t in found.items() if (k in bad) == side for x in t) for side in (True, False)]
    kinds = set(classes[0]) | set(classes[1])
    size = len(kinds) + 1
    seen = [len(bad), sum(bool(t) for t in found.values()) - len(bad)]
    for k, t in found.items():
        logs = [math.log(seen[c] + 1) + sum(math.log((classes[c][x] + 1) / (sum(classes[c].values()) + size)) for x in t) for c in (0, 1)]
        if t:
            assert rows[k].score == pytest.approx(logs[0] - logs[1], abs=1e-6)
            assert rows[k].rule is not None or rows[k].verdict == ("block" if logs[0] > logs[1] else "allow")
        else:
            assert rows[k].score is None and (rows[k].rule is not None or rows[k].verdict == "allow")


def test_quality_by_a_plain_discriminant():
    """Two shrunk Gaussians with full inverses and determinants, in place of sums and Cholesky factors."""
    rng = np.random.default_rng(5)
    p = len(quality.NAMES)
    x = {0: rng.normal(size=(300, p)) @ rng.normal(size=(p, p)), 1: rng.normal(size=(200, p)) @ rng.normal(size=(p, p)) + 0.7}
    model = quality.Discriminant({k: (len(v), v.sum(axis=0), v.T @ v) for k, v in x.items()})
    every = np.vstack([x[0], x[1]])
    z = {k: (v - every.mean(axis=0)) / every.std(axis=0) for k, v in x.items()}
    cov = {k: np.cov(v.T, bias=True) for k, v in z.items()}
    pooled = (300 * cov[0] + 200 * cov[1]) / 500
    density = {}
    probe = rng.normal(size=(50, p)) * every.std(axis=0)
    y = (probe - every.mean(axis=0)) / every.std(axis=0)
    for k, n in ((0, 300), (1, 200)):
        c = 0.8 * cov[k] + 0.2 * pooled
        c = 0.95 * c + 0.05 * (np.trace(c) / p + 1e-6) * np.eye(p)
        d = y - z[k].mean(axis=0)
        density[k] = -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.linalg.slogdet(c)[1] + math.log(n / 500)
    want = 1 / (1 + np.exp(-np.clip(density[1] - density[0], -30, 30)))
    assert np.allclose(model.scores(probe), want, atol=1e-7)


def shuffled(spark):
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_jaccard_join_sends_neither_texts_that_meet_nothing_nor_prefixes_twice(spark):
    """Random texts with a few near copies: what is shuffled is a part of the compressed texts."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50_000, 400))) for i in range(400)]
    rows += [(400 + i, rows[i][1] + " and more") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).localCheckpoint()
    before = shuffled(spark)
    out = joined(jaccard.jaccard_components(df))
    assert shuffled(spark) - before < 0.75 * sum(len(zlib.compress(t.encode())) for _, t in rows)
    assert [c for _, _, c in out] == [*range(400), *range(8)]


@given(st.lists(st.lists(st.integers(0, 2**64 - 1), min_size=3, max_size=3), min_size=1, max_size=50))
def test_packed_columns_come_back(rows):
    columns = [np.array(c, np.uint64) for c in zip(*rows, strict=True)]
    back = jaccard.unpacked_columns(jaccard.packed_columns(*columns), len(rows), 3)
    assert all((a == b).all() for a, b in zip(columns, back, strict=True))


def test_shared_prefixes_match_a_plain_join(spark, monkeypatch):
    """Rows of a region by counting: another row has the shingle, one has it early; common ones always stay."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(300):
        first = sorted({int(x) for x in rng.integers(0, 400, rng.integers(1, 12))} | {2**40 - 1 - int(rng.integers(0, 5))})
        rows.append((k + (k % 3 << 33), int(rng.integers(len(first), 60)), first, int(rng.integers(0, len(first) + 1))))
    monkeypatch.setattr(jaccard, "_CHUNK", 100)
    df = spark.createDataFrame(rows + [(9000, 5, None, None)], "row long, n long, prefix array<long>, cold long").repartition(3)
    held, want = defaultdict(list), set()
    for row, n, first, cold in rows:
        for i, x in enumerate(first):
            if i < cold:
                held[x].append((row, i, 180 * (n - i) // 80 - n >= n))
            else:
                want.add((x, row, i))
    want |= {(x, row, i) for x, got in held.items() if len(got) > 1 and any(e for *_, e in got) for row, i, _ in got}
    got = [tuple(r) for r in jaccard.shared_prefixes(df, 80).select("region", "row", "i").collect()]
    assert len(got) == len(want) and set(got) == want
    keep = {r[0] for r in rows[::7]}
    nodes = spark.createDataFrame([(x,) for x in keep] * 2, "node long")
    for most in (jaccard.WORDS, 0):  # by a broadcast bitmap and by a shuffle
        monkeypatch.setattr(jaccard, "WORDS", most)
        assert sorted(r.node for r in jaccard.among(df.withColumnRenamed("row", "node"), nodes).collect()) == sorted(keep)
