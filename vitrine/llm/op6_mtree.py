"""Exact top-k search by inner product with best-first search in M-trees.

Vectors become integers, floor(1024 * x), held exactly as doubles. Inner products
are turned into distances by one more coordinate, sqrt(M^2 - |x|^2) for a stored
vector (M: the greatest norm) and 0 for a query: then
distance^2 = |q|^2 + M^2 - 2 * q.x, so the k nearest are the k greatest products,
and the distance of a query to any stored vector is exact but for one root.

Build: pivots come from a bounded sample (``sample`` vectors, farthest first);
every row goes to its nearest pivot; a pivot with many rows is cut into several
trees by the hash of the id, so also a third of all rows being one vector fills
many equal trees. Each task builds one tree of about ``tree_rows`` rows: pages of
at most ``page`` entries, each entry with its covering radius and its distance to
the page's routing vector (the parent distance). Pages are rows of a table.

Search: a query first searches its own tree, which bounds its k-th distance; it
then visits only pivots whose covering radius comes within that bound, in blocks
of about ``block`` queries per tree, so no task holds more than one tree and one block.
A tree has as many blocks as its own visitors fill, and its pages are copied to these
only: a tree that nobody visits is not read again, and copies grow with the visits.
Inside a tree pages wait in a queue by lower bound; entries whose parent distance
alone rules them out (triangle inequality) are skipped without computing a
distance. Bounds allow for rounding, and scores are exact, so results are too.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import Input, bounded_sample, written

EXACT = 2.0**52  # products up to this are exact in doubles, in any order of adding
SLACK = 1e-9


def dots(m: np.ndarray, q: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products of the rows of ``m`` with ``q``; python integers beyond the doubles' range."""
    if top <= EXACT:
        return m @ q
    whole = [int(x) for x in q]
    return np.array([sum(int(a) * b for a, b in zip(r, whole)) for r in m], object)


def lift(m: np.ndarray, top: float) -> np.ndarray:
    """The further coordinate of stored vectors."""
    return np.sqrt(np.maximum(top - (m * m).sum(1), 0.0))


def distances(m: np.ndarray, more: np.ndarray, q: np.ndarray, q_more: float) -> np.ndarray:
    d = m - q
    return np.sqrt((d * d).sum(1) + (more - q_more) ** 2)


def spread(m: np.ndarray, more: np.ndarray, count: int) -> list[int]:
    """Up to ``count`` rows far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    far = distances(m, more, m[0], more[0])
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(m, more, m[chosen[-1]], more[chosen[-1]]))
    return chosen


def build(ids: np.ndarray, m: np.ndarray, top: float, page: int) -> list[dict]:
    """Pages of one tree. Page 0 is the root; an inner page's entries are its child pages."""
    more, pages, rng = lift(m, top), [], np.random.default_rng(1)

    def deal(rows: np.ndarray, routers: np.ndarray) -> list[tuple[int, np.ndarray]]:
        owner = np.array([distances(m[rows], more[rows], m[r], more[r]) for r in routers]).argmin(0)
        return [(int(r), rows[owner == i]) for i, r in enumerate(routers)]

    def make(rows: np.ndarray, router: int, parent_distance: float) -> dict:
        out = {"page": len(pages), "router": router, "parent_distance": parent_distance, "children": [], "rows": rows}
        pages.append(out)
        to_router = distances(m[rows], more[rows], m[router], more[router])
        out["radius"] = float(to_router.max())
        if len(rows) <= page:
            out["entry_distances"] = to_router
            return out
        fan = min(page, -(-len(rows) // page) + 1)
        parts = deal(rows, rng.choice(rows, fan, replace=False))
        if max(len(own) for _, own in parts) == len(rows):
            parts = deal(rows, rows[spread(m[rows], more[rows], fan)])
        if max(len(own) for _, own in parts) == len(rows):  # all alike: any cut does
            step = max(page, -(-len(rows) // page))
            parts = [(rows[i], rows[i : i + step]) for i in range(0, len(rows), step)]
        for r, own in parts:
            if len(own):
                away = float(distances(m[r][None], more[r][None], m[router], more[router])[0])
                out["children"].append(make(own, r, away)["page"])
        out["rows"] = rows[:0]
        return out

    make(np.arange(len(ids)), 0, 0.0)
    return pages


class Tree:
    """One tree's pages as arrays."""

    def __init__(self, table, top: float):
        self.top = top
        self.pages = {}
        for r in table.to_pylist():
            p = self.pages[r["page"]] = dict(r)
            p["router"] = np.frombuffer(r["router"])
            p["ids"] = np.array(r["ids"], np.int64)
            p["vectors"] = np.frombuffer(r["vectors"]).reshape(len(p["ids"]), -1) if r["ids"] else None
            p["entry_distances"] = np.frombuffer(r["entry_distances"])
        for p in self.pages.values():
            kids = [self.pages[c] for c in p["children"]]
            p["kids"] = kids
            if kids:
                p["routers"] = np.array([k["router"] for k in kids])
                p["radii"] = np.array([k["radius"] for k in kids])
                p["kid_distances"] = np.array([k["parent_distance"] for k in kids])

    def search(self, qid: int, q: np.ndarray, k: int, bound: float) -> list[tuple[int, int]]:
        """The tree's part of the query's k best (score, id); entries beyond distance ``bound`` may be left out."""
        own, top = float(q @ q), self.top

        def away(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            s = dots(m, q, top)
            return s, np.sqrt(np.maximum(own + top - 2 * s.astype(float), 0.0))

        room = SLACK * (own + top) ** 0.5 if top <= EXACT else 1e-6 * (own + top) ** 0.5
        best: list[tuple] = []  # heap of (score, -id), the worst first
        root = self.pages[0]
        d = float(away(root["router"][None])[1][0])
        queue = [(max(0.0, d - root["radius"]), 0, d)]
        while queue:
            low, at, d = heapq.heappop(queue)
            if low > bound + room:
                break  # all that wait are farther still
            p = self.pages[at]
            if p["kids"]:
                near = np.abs(d - p["kid_distances"]) - p["radii"] <= bound + room
                if near.any():
                    far = away(p["routers"][near])[1]
                    for i, f in zip(np.flatnonzero(near).tolist(), far.tolist()):
                        kid = p["kids"][i]
                        if (lb := max(0.0, f - kid["radius"])) <= bound + room:
                            heapq.heappush(queue, (lb, kid["page"], f))
                continue
            near = np.abs(d - p["entry_distances"]) <= bound + room
            near &= p["ids"] != qid
            if not near.any():
                continue
            scores, far = away(p["vectors"][near])
            ids = p["ids"][near]
            within = far <= bound + room
            for s, i in zip(scores[within].tolist(), ids[within].tolist()):
                entry = (int(s), -i)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                bound = min(bound, max(0.0, own + top - 2 * float(best[0][0])) ** 0.5)
        return [(s, -i) for s, i in best]


PAGES = (
    "tree long, page int, router binary, radius double, parent_distance double, children array<int>, "
    "ids array<long>, vectors binary, entry_distances binary"
)
FOUND = "query_id long, vec_id long, score long"
LEAST, MOST = -(2**63), 2**63 - 1


def matrix(column, dims: int) -> np.ndarray:
    """Rows of an Arrow list column as floor(1024 * x), filled with zeros to ``dims``."""
    out = np.zeros((len(column), dims))
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return np.floor(out * 1024.0)


def _unpack(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(-1, dims)


def top_k(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    sample: int = 2048,
    pivots: int = 256,
    tree_rows: int = 4096,
    page: int = 64,
    block: int = 4096,
    every_row: bool = False,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` best others; ``queries`` is a condition over ``id``.

    Rows with a null id, a null vector or a null or non-finite component take no
    part. Ids name vectors: rows with one id count once (of different vectors
    the least counts), and a query is no candidate of its own. With
    ``every_row`` each row counts, as in the SQL: repeated rows of an id are
    candidates and queries each, but never candidates of their own id. Shorter vectors
    are filled with zeros. Ties go to the smaller id; a query with fewer than
    ``k`` candidates gets them all. Scores beyond 64 bits are cut to the range
    of a long. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    src = Input(vectors, id=id_col, vec=vector_col)
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        src.df.select(src["id"].cast("long").alias("id"), src["vec"].cast("array<double>").alias("vec"))
        .where(F.col("id").isNotNull() & vec.isNotNull())
        .where(finite)
    )
    rows = rows if every_row else rows.groupBy("id").agg(F.min("vec").alias("vec"))
    number = F.monotonically_increasing_id() if every_row else F.col("id")  # deals repeated rows over trees and blocks
    rows = rows.withColumn("asks", F.coalesce(queries, F.lit(False))).withColumn("rid", number)
    valid = written(rows.select("id", "vec", "asks", "rid"), "op6-valid")
    length = F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + F.pow(F.abs(x) * 1024.0 + 1, F.lit(2.0)))
    n, asked, dims, top = valid.agg(
        F.count("*"), F.count(F.when(F.col("asks"), 1)), F.max(F.size("vec")), F.max(length)
    ).first()
    if not n or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, dims)

    some = bounded_sample(valid.select("rid", "vec"), "rid", sample).select("vec").toArrow().column(0)
    m = matrix(some, dims)
    count = min(pivots, -(-n // tree_rows))
    at = spread(m, lift(m, top), count)
    m = m[at]
    more = lift(m, top)

    def assign(batches):
        import pyarrow as pa

        for b in batches:
            x = matrix(b.column(1), dims)
            xm = lift(x, top)
            near, far = np.zeros(len(x), np.int32), np.full(len(x), np.inf)
            for i in range(len(m)):
                d = distances(x, xm, m[i], more[i])
                closer = d < far
                near[closer], far[closer] = i, d[closer]
            packed = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), packed, b.column(2), b.column(3), pa.array(near), pa.array(far)],
                names=["id", "x", "asks", "rid", "pivot", "away"],
            )

    dealt = written(
        valid.select("id", "vec", "asks", "rid").mapInArrow(
            assign, "id long, x binary, asks boolean, rid long, pivot int, away double"
        ),
        "op6-dealt",
    )
    radius, trees, first = [0.0] * len(m), [0] * len(m), [0] * len(m)
    for r in dealt.groupBy("pivot").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect():  # <= pivots
        radius[r["pivot"]], trees[r["pivot"]] = r["r"], -(-r["n"] // tree_rows)
    for i in range(1, len(m)):
        first[i] = first[i - 1] + trees[i - 1]

    def of(values: list) -> Column:
        return F.get(F.array(*[F.lit(x).cast("long") for x in values]), F.col("pivot"))

    cut = F.pmod(F.xxhash64("rid"), F.greatest(F.lit(1).cast("long"), of(trees)))
    dealt = dealt.withColumn("tree", of(first) + cut)

    def make_pages(table):
        import pyarrow as pa

        ids, x = table.column("id").to_numpy(), _unpack(table.column("x"), dims)
        tree = table.column("tree")[0].as_py()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        rows = [
            {
                "tree": tree,
                "page": p["page"],
                "router": x[p["router"]].tobytes(),
                "radius": p["radius"],
                "parent_distance": p["parent_distance"],
                "children": p["children"],
                "ids": ids[p["rows"]].tolist(),
                "vectors": x[p["rows"]].tobytes(),
                "entry_distances": p.get("entry_distances", np.empty(0)).tobytes(),
            }
            for p in build(ids, x, top, page)
        ]
        return pa.Table.from_pylist(rows, schema=page_schema())

    pages = written(dealt.select("tree", "id", "x").groupBy("tree").applyInArrow(make_pages, PAGES), "op6-pages")
    asking = dealt.where("asks").select("tree", "pivot", "id", "x", "rid")

    def search(left, right):
        import pyarrow as pa

        out: list[tuple[int, int, int]] = []
        if len(left) and len(right):
            tree = Tree(left, top)
            for q in right.to_pylist():
                found = tree.search(q["id"], np.frombuffer(q["x"]), k, q["bound"])
                out += [(q["id"], i, min(MOST, max(LEAST, s))) for s, i in found]
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    everywhere = F.lit(float("inf")).alias("bound")
    home = written(
        pages.groupBy("tree").cogroup(asking.select("tree", "id", "x", everywhere).groupBy("tree")).applyInArrow(search, FOUND),
        "op6-home",
    )
    kth = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    kth = kth.where((F.col("n") >= k) & (F.col("kth") > LEAST)).select(F.col("query_id").alias("id"), "kth")

    def route(batches):
        import pyarrow as pa

        for b in batches:
            x, kths = _unpack(b.column(2), dims), b.column(3).to_pylist()
            bounds, where = [], []
            for q, worst in zip(x, kths):
                own = float(q @ q)
                bound = np.inf if worst is None else max(0.0, own + top - 2 * float(worst)) ** 0.5 + 1e-6 * (own + top) ** 0.5
                d = np.sqrt(np.maximum(own + top - 2 * (m @ q), 0.0))
                bounds.append(bound)
                where.append(np.flatnonzero(d - np.array(radius) <= bound).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(1), b.column(2), pa.array(bounds, pa.float64()),
                    pa.array(where, pa.list_(pa.int32())), b.column(4),
                ],
                names=["home", "id", "x", "bound", "pivots", "rid"],
            )

    routed = (
        asking.join(kth, "id", "left")
        .select(F.col("tree").alias("home"), "id", "x", "kth", "rid")
        .mapInArrow(route, "home long, id long, x binary, bound double, pivots array<int>, rid long")
        .select("home", "id", "x", "bound", "rid", F.explode("pivots").alias("pivot"))
        .where(of(trees) > 0)
        .select("home", "id", "x", "bound", "rid", F.explode(F.sequence(of(first), of(first) + of(trees) - 1)).alias("tree"))
        .where("tree <> home")
    )
    routed = written(routed.select("tree", "id", "x", "bound", "rid"), "op6-routed")
    paged, dealt_queries = visits(pages, routed, block)
    others = paged.groupBy("tree", "block").cogroup(dealt_queries.groupBy("tree", "block")).applyInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = home.union(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def visits(pages: DataFrame, routed: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """(pages, queries), both with a block: a tree's queries dealt over blocks of about ``block``, its pages to each.

    The copies of a tree are as many as its visitors fill blocks (none without a visitor). Queries are dealt by the hash
    of their row, so that the few rows of a block differ from ``block`` by chance only.
    """
    blocks = routed.groupBy("tree").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    dealt = routed.join(blocks, "tree").withColumn("block", F.pmod(F.xxhash64("rid"), "blocks"))
    copied = pages.join(blocks, "tree").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return copied.drop("blocks"), dealt.select("tree", "block", "id", "x", "bound")


def page_schema():
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    kinds |= {f"array<{c}>": pa.list_(kinds[c]) for c in ("int", "long")}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, PAGES.split(", "))])


def op6_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.col("id") % 100 == 0, every_row=True)


SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s
QUALIFY rank <= 10
"""
