"""Exact top-k inner products with buckets of vectors of like length.

Vectors are ranked by length and cut into buckets of equal count. Each block of queries first meets the bucket of
the longest vectors, which gives every query a threshold: the k-th best product so far. A product is at most
|q| |v|, so the buckets whose longest vector can't reach any threshold of a query block are left out before anything is sent;
as buckets are in order of length, the others are a prefix. In a bucket, a query's threshold and the bucket's longest
vector give a local cosine threshold, and per query the cheaper of two prunings is chosen: by length (only vectors
long enough), or by the query's largest coordinate (only vectors whose coordinate lies in the interval that
the cosine threshold allows). What is left is verified by exact integer products.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, growing, ranked

K = 20
QUERY_EVERY = 20
SCALE = 64
BUCKET_VECTORS = 4096
BLOCK_QUERIES = 2048
QUERIES_AT_ONCE = 256
COORDINATE_SHARE = 0.25  # coordinate pruning is chosen if it leaves at most this share of what length pruning leaves
SLACK = 1e-9
NONE = np.iinfo(np.int64).min
ROW = "__truegrain_row"
FOUND = "query_row long, query_id long, vec_id long, vec_row long, score long"


def integers(column: Column, scale: int) -> Column:
    return F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a vector of finite components."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False)))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _product(q: np.ndarray, v: np.ndarray, bound: float) -> np.ndarray:
    """Exact products: in doubles where these hold all sums, else in 64-bit integers."""
    if bound < 2.0**52:
        return (q.astype(float) @ v.T.astype(float)).astype(np.int64)
    return q @ v.T


def _best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) places of each query's k best scores of at least ``floor``, ties to smaller ids."""
    if scores.shape[1] > k:
        floor = np.maximum(floor, np.partition(scores, -k, axis=1)[:, -k])
    q, v = np.nonzero((scores >= floor[:, None]) & (scores > NONE))
    order = np.lexsort((rows[v], ids[v], -scores[q, v], q))
    q, v = q[order], v[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], v[place < k]


def search_bucket(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """The products of one query block with one bucket that can be among a query's k best."""
    widths = [pa.compute.max(pa.compute.list_value_length(t["v"])).as_py() or 0 for t in (queries, vectors) if len(t)]
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    if len(queries) and len(vectors):
        vectors = vectors.sort_by([("length", "descending"), (ROW, "ascending")])
        width = max(widths)
        q, v = _matrix(queries["v"], width), _matrix(vectors["v"], width)
        ids, rows, length = (vectors[c].to_numpy() for c in ("vec_id", ROW, "length"))
        q_rows, q_ids, q_length, floor = (queries[c].to_numpy() for c in (ROW, "vec_id", "length", "floor"))
        bound = float(q_length.max() * length.max())
        # Vectors long enough for each query; the slack keeps rounding from losing any.
        need = np.where(floor > 0, floor / np.maximum(q_length, 1e-300), 0.0) * (1 - SLACK)
        enough = np.where(floor > 0, np.searchsorted(-length, -need, "right"), len(v))
        by_coordinate = _coordinate_candidates(q, q_length, v, length, floor, enough)
        for i, some in by_coordinate.items():
            _collect(out, q[i : i + 1], v[some], ids[some], rows[some], q_rows[i : i + 1], q_ids[i : i + 1], floor[i : i + 1], bound, k)
        plain = np.array([i for i in np.argsort(enough, kind="stable") if i not in by_coordinate and enough[i]], np.int64)
        for at in range(0, len(plain), QUERIES_AT_ONCE):
            i = plain[at : at + QUERIES_AT_ONCE]
            n = enough[i].max()
            _collect(out, q[i], v[:n], ids[:n], rows[:n], q_rows[i], q_ids[i], floor[i], bound, k)
    names = [part.split()[0] for part in FOUND.split(", ")]
    return pa.table({n: np.concatenate([np.zeros(0, np.int64), *c]) for n, c in zip(names, out)})


def _collect(out: list, q: np.ndarray, v: np.ndarray, ids, rows, q_rows, q_ids, floor, bound: float, k: int) -> None:
    scores = _product(q, v, bound)
    scores[q_rows[:, None] == rows[None, :]] = NONE  # a query isn't its own result
    a, b = _best(scores, ids, rows, floor, k)
    for column, values in zip(out, (q_rows[a], q_ids[a], ids[b], rows[b], scores[a, b])):
        column.append(values)


def _coordinate_candidates(q, q_length, v, length, floor, enough) -> dict[int, np.ndarray]:
    """Per query that coordinate pruning suits better: the vectors it leaves."""
    longest = float(length.max())
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(floor > 0, floor / (q_length * longest), 0.0) * (1 - SLACK)
    chosen, unit, ordered = {}, v / np.maximum(length, 1e-300)[:, None], {}
    for i in np.flatnonzero((cosine > 0.5) & (cosine <= 1) & (enough > 0)):
        focus = int(np.argmax(np.abs(q[i])))
        x = q[i, focus] / q_length[i]
        spread = np.sqrt(max(0.0, (1 - x * x) * (1 - cosine[i] ** 2)))
        # The cap around q: below the cosine of the pole the bound in its direction is 1.
        low = x * cosine[i] - spread if -x < cosine[i] else -1.0
        high = x * cosine[i] + spread if x < cosine[i] else 1.0
        if focus not in ordered:
            order = np.argsort(unit[:, focus], kind="stable")
            ordered[focus] = order, unit[order, focus]
        order, values = ordered[focus]
        start, end = np.searchsorted(values, [low - SLACK, high + SLACK])
        if end - start <= COORDINATE_SHARE * enough[i]:
            some = order[start:end]
            chosen[int(i)] = np.sort(some[some < enough[i]])
    return chosen


def _searching(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda queries, vectors: search_bucket(queries, vectors, k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    bucket_vectors: int = BUCKET_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best integer products of each query with every other row.

    Components are floor(scale * x). Fewer than k other rows give fewer results. Rows without an id, and vectors that are null or
    hold null or non-finite components, take no part. A shorter vector counts as if zeros followed. Rows that repeat a
    vec_id are rows of their own; only the query's own row is left out. Products have to fit into 64 bits.
    """
    scratch = Scratch(vectors.sparkSession, "top-k")
    whole = usable(vectors.withColumn(ROW, F.monotonically_increasing_id())).select(
        ROW, F.col("vec_id").cast("long"), integers(F.col("embedding"), scale).alias("v"), is_query.alias("asks")
    )
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    order = F.desc("length"), F.col("vec_id"), F.col(ROW)
    by_length = ranked(scratch, whole.withColumn("length", F.sqrt(squares)), *order, name="place")
    table = scratch.store(by_length.withColumn("bucket", F.floor(F.col("place") / bucket_vectors).cast("int")).drop("place"))
    lengths = table.groupBy("bucket").agg(F.max("length").alias("longest")).orderBy("bucket").collect()  # one a bucket
    asked = table.where("asks").count()
    block = F.pmod(F.xxhash64(ROW), F.lit(max(1, -(-asked // block_queries)))).cast("int")
    queries = scratch.store(table.where("asks").select(ROW, "vec_id", "v", "length", block.alias("block")))
    blocks = [r["block"] for r in queries.select("block").distinct().orderBy("block").collect()]  # one a block of queries

    def search(queries: DataFrame, pairs: dict[int, range]) -> DataFrame:
        """Meet query blocks with the buckets that ``pairs`` names."""
        reach = scratch.spark.createDataFrame([(b, p.start, p.stop) for b, p in pairs.items()], "block int, start int, stop int")
        spans = reach.where("start < stop").select("block", F.explode(F.expr("sequence(start, stop - 1)")).alias("bucket"))
        left = queries.join(growing(spans), "block")
        right = table.select(ROW, "vec_id", "v", "length", "bucket").join(growing(spans), "bucket")
        keys = ["block", "bucket"]
        return scratch.store(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searching(k), FOUND))

    first = search(queries.withColumn("floor", F.lit(NONE)), {b: range(0, min(1, len(lengths))) for b in blocks})
    floors = first.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(NONE)).alias("floor"))
    known = queries.drop("block").join(growing(floors), queries[ROW] == floors["query_row"], "left").drop("query_row")
    known = known.withColumn("floor", F.coalesce("floor", F.lit(NONE)))
    # Blocks anew, of queries that need vectors of like length: the least of a block decides which buckets it meets.
    need = F.when(F.col("floor") > 0, F.col("floor") / F.greatest("length", F.lit(1e-300))).otherwise(F.lit(0.0))
    known = ranked(scratch, known.withColumn("need", need), F.desc("need"), F.col(ROW), name="place")
    known = scratch.store(known.withColumn("block", F.floor(F.col("place") / block_queries).cast("int")).drop("place"))
    least = {r["block"]: r["need"] for r in known.groupBy("block").agg(F.min("need").alias("need")).collect()}
    longest = np.array([-r["longest"] for r in lengths])
    reach = {b: int(np.searchsorted(longest, -need * (1 - SLACK), "right")) for b, need in least.items()}
    rest = search(known, {b: range(1, max(1, n)) for b, n in reach.items()})
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    found = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
