import random

import duckdb
import numpy as np
import pytest
from llm_cases import SF_ORACLE
from pyspark.sql import functions as F

from vitrine.llm import op6_mtree
from vitrine.llm.op6_mtree import top_k


def plain(rows, every, k=10):
    import math

    by_id = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        by_id[i] = min(by_id.get(i, v), v)
    ints = {i: [math.floor(1024 * x) for x in v] for i, v in by_id.items()}
    out = []
    for q in sorted(i for i in ints if i % every == 0):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("copies", [0, 200])
def test_many_small_trees_and_blocks(spark, copies):
    rng = np.random.default_rng(copies)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=8)).astype(float).tolist()) for i in range(500)]
    rows += [(1000 + i, rows[3][1]) for i in range(copies)]  # one very common vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("id") % 20 == 0, tree_rows=40, page=8, block=7, pivots=5, sample=100)
    assert sorted(map(tuple, got.collect())) == plain(rows, 20)


def test_pages_go_only_where_queries_go(spark):
    """Copies of a tree follow its own visitors: none without, and no more for other trees' queries."""
    pages = spark.createDataFrame([(t, p) for t in range(4) for p in range(3)], "tree long, page int")

    def copies(visitors):
        rows = [(t, i, b"", 0.0, i) for t, n in visitors.items() for i in range(n)]
        routed = spark.createDataFrame(rows, "tree long, id long, x binary, bound double, rid long")
        paged, dealt = op6_mtree.visits(pages, routed, 10)
        assert dealt.count() == len(rows) and dealt.join(paged, ["tree", "block"], "left_anti").count() == 0
        return {r["tree"]: r["count"] for r in paged.groupBy("tree").count().collect()}

    assert copies({0: 1, 1: 25}) == {0: 3, 1: 9}
    assert copies({0: 1, 1: 250}) == {0: 3, 1: 75}
    assert copies({}) == {}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]),
            (7, []), (8, [-0.3]), (9, [1.0, 0.5, 2.0]), (None, [1.0, 1.0]), (1, [1.0, 0.5]), (2, [0.5, 0.5]), (10, [0.0, 0.0]),
            (20, [1e-20, -1e-20])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, F.col("id") % 10 == 0).collect())) == plain(rows, 10)
    assert top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0
    assert top_k(df, F.lit(False)).count() == 0


def test_products_beyond_doubles_are_exact(spark):
    rnd = random.Random(4)
    rows = [(i, [float(rnd.randrange(2**19)) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, F.col("id") % 10 == 0, tree_rows=20, page=4)
    assert sorted(map(tuple, got.collect())) == plain(rows, 10)


def test_bounds_avoid_computations():
    rng = np.random.default_rng(0)
    centres = 40 * rng.normal(size=(30, 8))
    m = np.floor(1024 * (centres[rng.integers(0, 30, 3000)] + 0.05 * rng.normal(size=(3000, 8))))
    top = float((m * m).sum(1).max())
    pages = op6_mtree.build(np.arange(3000), m, top, 32)
    rows = [
        {**p, "router": m[p["router"]].tobytes(), "ids": p["rows"].tolist(), "vectors": m[p["rows"]].tobytes(),
         "entry_distances": p.get("entry_distances", np.empty(0)).tobytes()} for p in pages
    ]

    class Table:
        def to_pylist(self):
            return rows

    tree, computed, dots = op6_mtree.Tree(Table(), top), [], op6_mtree.dots
    try:
        op6_mtree.dots = lambda a, b, t: (computed.append(len(a)), dots(a, b, t))[1]
        found = tree.search(-1, m[5], 10, float("inf"))
    finally:
        op6_mtree.dots = dots
    want = sorted(((-int(s), i) for i, s in enumerate(m @ m[5])))[:10]
    assert sorted((-s, i) for s, i in found) == want
    assert sum(computed) < 1500


def test_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_ORACLE}/embeddings.parquet'")
    got = sorted(map(tuple, op6_mtree.op6_mtree(spark, SF_ORACLE).collect()))
    assert got == sorted(con.sql(op6_mtree.SQL).fetchall())


def test_repeated_rows_count_as_in_the_sql(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(260)]
    rows += [(i, rng.normal(size=4).tolist()) for i in (0, 100, 7, 7, 8)] + [rows[9], rows[200], rows[55], rows[55]]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, op6_mtree.op6_mtree(spark, str(tmp_path)).collect()))
    small = top_k(
        spark.read.parquet(f"{tmp_path}/embeddings.parquet"), F.col("id") % 100 == 0, tree_rows=20, page=4, block=2, every_row=True
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(op6_mtree.SQL).fetchall())
    assert got == want and sorted(map(tuple, small.collect())) == want
