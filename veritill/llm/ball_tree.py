"""Exact top-k search by inner product with ball trees.

Rows are dealt to shards; each shard is one ball tree, built once and stored: nodes with centre and
radius, rows in leaf order.  No row below a node can score more than q . centre + |q| * radius, so
each query visits nodes in the order of that bound and stops when the bound is below its current
k-th score.  Queries come in blocks.  Every block first searches one shard; the k-th scores found
there are shared with its searches of all other shards, which start pruning at once.

Components are turned into floor(scale * x) before anything else, and scores are exact integers.

Cases: vectors that are null, empty, or hold null or non-finite components take no part, neither do
rows without id; vectors of different lengths never meet; a repeated row counts once; a candidate
with the query's id is the query's own row; ties go to the smaller id; a query without candidates
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritill.llm.common import stored

SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS = 8192, 512, 256


def whole_vectors(df: DataFrame, scale: int = 64, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim) of the usable vectors with integer components."""
    usable = F.size(vector) > 0
    finite = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))),
    )
    return (
        df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & usable & finite)
        .select(
            F.col(id_column).cast("bigint").alias("vec_id"),
            F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint")).alias("v"),
        )
        .withColumn("dim", F.size("v"))
        .distinct()
    )


def _matrix(rows: list[list[int]]) -> np.ndarray:
    """Exact arithmetic: floating point while all products stay whole, else Python integers."""
    whole = np.array(rows, dtype=np.int64)
    largest = float(np.abs(whole.astype(np.float64)).max(initial=0.0))
    return whole.astype(np.float64) if largest * largest * whole.shape[1] < 2.0**52 else whole.astype(object)


def _build(ids: np.ndarray, x: np.ndarray) -> dict:
    """Split at the median along the line between two far points until leaves are small."""
    as_float = x.astype(np.float64)
    order = np.arange(len(ids))
    nodes: list[tuple] = []  # centre, radius, start, end, left, right
    todo = [(0, len(ids), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        part = as_float[order[start:end]]
        centre = part.mean(axis=0)
        far = np.sqrt(((part - centre) ** 2).sum(axis=1))
        number = len(nodes)
        nodes.append([centre, float(far.max()) * (1 + 1e-9) + 1e-9, start, end, -1, -1])
        if parent >= 0:
            nodes[parent][4 + side] = number
        if end - start > LEAF_ROWS and far.max() > 0:
            a = part[far.argmax()]
            b = part[((part - a) ** 2).sum(axis=1).argmax()]
            by = np.argsort(part @ (b - a), kind="stable")
            order[start:end] = order[start:end][by]
            middle = (start + end) // 2
            todo += [(start, middle, number, 0), (middle, end, number, 1)]
    return {
        "ids": ids[order], "x": x[order], "centre": np.array([n[0] for n in nodes]), "radius": np.array([n[1] for n in nodes]),
        "start": [n[2] for n in nodes], "end": [n[3] for n in nodes], "left": [n[4] for n in nodes], "right": [n[5] for n in nodes],
    }


def _search(tree: dict, own: int, q: np.ndarray, bounds: np.ndarray, k: int, kth: float) -> list[tuple[int, int]]:
    """(score, id) of the k best rows of one shard that score ``kth`` or more."""
    ids, x, start, end, left, right = (tree[n] for n in ("ids", "x", "start", "end", "left", "right"))
    slack = 1e-6 * (1 + np.abs(bounds[0]))
    best: list[tuple[int, int]] = []
    open_ = [(-bounds[0], 0)]
    while open_:
        bound, node = heapq.heappop(open_)
        if -bound + slack < kth:
            break
        if left[node] >= 0:
            for child in (left[node], right[node]):
                reach = min(-bound, bounds[child])
                if reach + slack >= kth:
                    heapq.heappush(open_, (-reach, child))
            continue
        scores = x[start[node] : end[node]] @ q
        keep = np.flatnonzero(scores >= kth)
        if len(keep):
            found = [(int(scores[i]), int(ids[start[node] + i])) for i in keep]
            best = sorted(best + [f for f in found if f[1] != own], key=lambda f: (-f[0], f[1]))[:k]
            if len(best) == k:
                kth = max(kth, best[-1][0])
    return best


def trees(vectors: DataFrame, rows: int) -> DataFrame:
    """One row per shard with its pickled tree; ``rows`` is the number of vectors."""
    shards = max(1, -(-rows // SHARD_ROWS))

    def build(key, table):
        ids = table.column("vec_id").to_numpy()
        tree = _build(ids, _matrix(table.column("v").to_pylist()))
        return pa.table({"dim": [key[0].as_py()], "shard": [key[1].as_py()], "tree": [pickle.dumps(tree)]}, schema=target)

    target = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("tree", pa.binary())])
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, tree binary")


def _wave(tree_table: DataFrame, queries: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Search the shards in ``pairs`` (dim, shard, block) for the queries of their blocks."""
    target = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(key, left, right):
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            tree = pickle.loads(left.column("tree")[0].as_py())
            q = _matrix(right.column("v").to_pylist())
            as_float = q.astype(np.float64)
            lengths = np.sqrt((as_float**2).sum(axis=1))
            bounds = as_float @ tree["centre"].T + lengths[:, None] * tree["radius"][None, :]
            exact = tree["x"].dtype == q.dtype or q.dtype != object
            rows = q if exact else q.astype(object)
            if tree["x"].dtype == object and rows.dtype != object:
                rows = rows.astype(np.int64).astype(object)
            elif rows.dtype == object and tree["x"].dtype != object:
                tree["x"] = tree["x"].astype(np.int64).astype(object)
            for i, (own, kth) in enumerate(zip(right.column("vec_id").to_pylist(), right.column("kth").to_pylist())):
                least = float("-inf") if kth is None else kth
                out += [(own, vec, score) for score, vec in _search(tree, own, rows[i], bounds[i], k, least)]
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    shards = pairs.join(tree_table, ["dim", "shard"])
    blocks = pairs.join(queries, ["dim", "block"]).select(
        F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard"), F.col("block").alias("q_block"), "vec_id", "v", "kth"
    )
    return (
        shards.groupBy("dim", "shard", "block")
        .cogroup(blocks.groupBy("q_dim", "q_shard", "q_block"))
        .applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    )


def top_k(
    df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k best partners of every row with ``is_query``: query_id, rank, vec_id, score."""
    vectors = stored(whole_vectors(df, scale, id_column, vector), "vectors")
    rows, n_queries = vectors.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    built = stored(trees(vectors, rows), "ball-trees")
    blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    queries = vectors.where(is_query).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))

    # the stated queries, in blocks, against all shards
    n_shards = max(1, -(-rows // SHARD_ROWS))
    pairs = built.select("dim", "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pilot = F.pmod(F.col("block"), F.lit(n_shards)) == F.col("shard")
    fresh = queries.withColumn("kth", F.lit(None).cast("bigint"))
    first = stored(_wave(built, fresh, pairs.where(pilot), k), "top-k-first")
    kth = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count("*") >= k, F.min("score")).alias("kth")
    )
    others = _wave(built, queries.join(kth, "vec_id", "left"), pairs.where(~pilot), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionAll(others)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
