"""Each stage of the pipeline against a brute-force form on its own input, and the oracles of operators 2, 8 and 9."""

import math
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from leafmill.llm import queries
from tests.llm.test_jaccard_models import brute_components
from tests.llm.test_mixing_exact_lines import brute_lines, targets
from tests.llm.test_tokens_packing import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Inputs and outputs of all stages, stored and read again as the contract has it."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        out = stage(spark, docs, SF)
        out.write.parquet(path)
        back = spark.read.parquet(path)
        found.append((name, docs.columns, [r.asDict() for r in docs.collect()], back.columns, [r.asDict() for r in back.collect()]))
        docs = back
    return found


def test_names_and_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "line_dedup", "jaccard_join", "mix_sources", "best_fit_packing"]
    assert all(s[1] == s[3] for s in stages[:-1])


def test_toxic_documents_go(spark, stages):
    _, _, before, _, after = stages[0]
    scores = {r.doc_id: r.predicted for r in queries.op6_toxicity(spark, SF).collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if not scores[r["doc_id"]])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert not [i for i in gone if labels.get(i) == 0]


def test_only_recurring_lines_go(stages):
    _, _, before, _, after = stages[1]
    want, by = brute_lines([(r["doc_id"], r["text"]) for r in before]), {r["doc_id"]: r for r in after}
    assert len(after) == len(before)
    for r in before:
        gone = want.get((r["doc_id"], r["text"]), set())
        kept = "\n".join(x for n, x in enumerate(r["text"].split("\n")) if n not in gone)
        assert by[r["doc_id"]]["text"] == kept and (not gone or by[r["doc_id"]]["n_chars"] == len(kept))


def test_one_document_of_each_group_stays(stages):
    _, _, before, _, after = stages[2]
    groups = defaultdict(list)
    for (d, _, c), r in zip(brute_components([(r["doc_id"], r["text"]) for r in before]), before, strict=True):
        groups[c].append(r)
    assert sorted(r["doc_id"] for r in after) == sorted(groups) and all(r in before for r in after)


def test_the_mix_takes_whole_documents_near_targets(stages):
    _, _, before, _, after = stages[3]
    size, per, taken = {r["doc_id"]: len(r["text"].encode().split()) for r in before}, Counter(), Counter()
    for r in before:
        per[r["source"]] += size[r["doc_id"]]
    times = Counter(r["doc_id"] for r in after)
    assert max(times.values()) <= 2 and {tuple(sorted(r.items(), key=str)) for r in after} <= {tuple(sorted(r.items(), key=str)) for r in before}
    for r in before:
        taken[r["source"]] += times[r["doc_id"]] * size[r["doc_id"]]
    longest = max(size.values())
    assert all(abs(taken[s] - w) <= longest for s, w in targets(per).items())


def test_all_of_the_mix_is_packed(spark, stages):
    _, _, before, _, after = stages[4]
    rows = [type("R", (), r) for r in after]
    n = check_packing(rows, {r["doc_id"]: r["text"] for r in before}, 2048)
    total = sum(r["length"] for r in after)
    assert math.ceil(total / 2048) <= n <= 1.02 * total / 2048 + 1
    times, pieces = Counter(r["doc_id"] for r in before), Counter(r["doc_id"] for r in after if r["piece"] == 0)
    assert times == pieces
    assert corpus_pipeline.run(spark, SF).count() == len(after)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall())


CLASHES = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted string, n_lines string, n_dropped long, size long, n long, row long, node long, comp long, region long, copies long, taken long, length long"


@pytest.mark.parametrize("number", range(5))
def test_stages_of_odd_rows_and_of_none(spark, odd_rows, number):
    """Nulls, empty and long texts, ties, repeated rows and clashing names: columns stay, values of other columns too."""
    name, stage = corpus_pipeline.STAGES[number]
    rows = [(r[0], r[1], r[2], r[3], r[4], 42.0, "mine", "x", 7, 1, 2, 3, 4, 5, 6, 8, 9, 10) for r in odd_rows]
    docs = spark.createDataFrame(rows, CLASHES).repartition(3)
    out = stage(spark, docs, SF)
    got = out.collect()
    if name != "best_fit_packing":
        assert out.schema.names == docs.schema.names and {(r.score, r.predicted, r.n_lines, r.n_dropped, r.length) for r in got} == {(42.0, "mine", "x", 7, 10)}
        known = {(r[0], r[1]) for r in rows}
        assert all((r.doc_id, r.text) in known for r in got if name != "line_dedup")
    else:
        assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r[0] for r in rows)
    none = stage(spark, docs.where("false"), SF)
    assert none.count() == 0


def test_mix_of_files_in_any_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 4 = 0"))
    one, two = (sorted(r.doc_id for r in corpus_pipeline.mix(spark, docs.repartition(n), SF).collect()) for n in (1, 6))
    assert one == two and max(Counter(one).values()) <= 4
