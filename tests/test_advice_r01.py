
import pyarrow.parquet as pq

from leafmill.plans import catalogue

SF = "/root/testdata/sf0.001"


def column(table, *names):
    return list(zip(*(pq.read_table(f"{SF}/{table}.parquet", columns=list(names))[n].to_pylist() for n in names), strict=True))


def test_block_edges_of_every_block(spark):
    names, blocks = dict(column("part", "p_partkey", "p_name")), {}
    for k, *line in sorted(column("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")):
        if line[1] in names and line[1] % 7:
            blocks.setdefault(k, []).append(names[line[1]])
    got = {r.id: (r.joined, r.n_children) for r in catalogue.QUERIES["block_edges_whole"](spark, SF).collect()}
    assert got == {k: (" ".join(x), len(x)) for k, x in blocks.items()} and {k % 3 for k in got} == {0, 1, 2}


def test_report_flatten_of_every_report(spark):
    keys = {r.k for r in catalogue.QUERIES["report_flatten_whole"](spark, SF).select("k").distinct().collect()}
    assert keys == {k for k, in column("orders", "o_orderkey")}


def test_image_listing_of_every_listing(spark):
    keys = {r.k for r in catalogue.QUERIES["image_listing_whole"](spark, SF).collect()}
    assert keys == {k for k, in column("customer", "c_custkey") if k % 4}


def test_every_vector_is_compared_with_its_successor(spark):
    ids = {k for k, in column("embeddings", "vec_id")}
    for name in ("shift_correlation_whole", "best_transform_whole"):
        assert {r.vec_id for r in catalogue.QUERIES[name](spark, SF).select("vec_id").collect()} == {k for k in ids if k + 1 in ids}, name
