"""Near duplicates by SimHash fingerprints, with vantage-point trees for the exact pairs.

Fingerprints of 64 bits are computed per document. A tree of vantage points, fitted on a bounded
sample, deals the distinct fingerprints to shards: at a node the points within the radius go to
the near side and the others to the far side. By the triangle bound a partner of a near point lies within the
radius plus the link distance, so far points of that border go to the near side too, and each
linked pair meets in a shard. Inside a shard the same rule splits on until few points are left,
which are compared exactly. Shards return one link per point to the least point of its local group, never all
pairs, and groups are joined across shards by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, arrow_schema, growing, lowest, only_rows, text_or_empty, with_row_id

SHINGLE = 3
LINK_BITS = 2
SAMPLE = 20_000  # fingerprints the tree is fitted on
SHARD_POINTS = 16_384  # aimed at per shard
SHARD_LIMIT = 1 << 22  # points one task splits on; a larger shard is compared block by block
LEAF_POINTS = 512  # compared all with all inside a task
ROW = "__truegrain_row"
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> bytes:
    """Eight bytes: a bit is set if it is set in over half the hashes of the shingles, repeats counted."""
    words = text.encode().lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - width] + 1)).tolist()
    ends = ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        some = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE])
        hashes = np.frombuffer(b"".join([digest(joined[a:b], 42) for a, b in some]), np.uint8)
        ones += np.unpackbits(hashes).reshape(-1, 64).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(starts)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Row number, doc_id and fingerprint (a signed long of the same bits). Null text: no words."""
    rows = with_row_id(docs, ROW).select(ROW, "doc_id", text_or_empty().alias("text"))
    ddl = f"{ROW} string, doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long"
    schema = arrow_schema(ddl)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(fingerprint(t.as_py(), shingle) for t in batch.column("text"))
            bits = pa.array(np.frombuffer(raw, ">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), bits], schema=schema)

    return rows.mapInArrow(prints, ddl)


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def split(points: np.ndarray, link_bits: int) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that part the points; None if no radius leaves both sides smaller.

    Of a few candidates the one whose larger side, borders included, is least is taken.
    """
    best = None
    for vantage in points[:: max(1, len(points) // 5)][:5]:
        upto = np.cumsum(np.bincount(distances(points, vantage), minlength=65))
        near = np.minimum(upto[np.minimum(np.arange(65) + link_bits, 64)], len(points))
        larger = np.maximum(near, len(points) - upto)
        radius = int(np.argmin(larger))
        if larger[radius] < len(points) and (best is None or larger[radius] < best[0]):
            best = (larger[radius], vantage, radius)
    return best and (best[1], best[2])


def sides(points: np.ndarray, vantage: np.uint64, radius: int, link_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which points the near side gets, border included, and which the far side."""
    away = distances(points, vantage)
    return away <= radius + link_bits, away > radius


def fit_tree(sample: np.ndarray, shards: int, link_bits: int) -> list | int:
    """Nested [vantage, radius, near, far]; leaves are numbered from 0."""
    number = iter(range(1 << 30))

    def grow(points: np.ndarray, wanted: float) -> list | int:
        found = split(points, link_bits) if wanted > 1 and len(points) > 16 else None
        if found is None:
            return next(number)
        near, far = sides(points, *found, link_bits)
        parts = (points[near], points[far])
        return [*found, *(grow(p, wanted * len(p) / len(points)) for p in parts)]

    return grow(sample, float(shards))


def route(tree: list | int, points: np.ndarray, link_bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, points) for every leaf a point belongs to."""
    if not len(points):
        return
    if isinstance(tree, int):
        yield tree, points
        return
    near, far = sides(points, tree[0], tree[1], link_bits)
    yield from route(tree[2], points[near], link_bits)
    yield from route(tree[3], points[far], link_bits)


def local_links(points: np.ndarray, link_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that connect exactly the points that linked pairs connect, found by splitting on."""
    todo = [points]
    while todo:
        some = todo.pop()
        if len(some) > LEAF_POINTS and (found := split(some, link_bits)) is not None:
            near, far = sides(some, *found, link_bits)
            if near.sum() + far.sum() < 1.8 * len(some):
                todo += [some[near], some[far]]
                continue
        for at in range(0, len(some), LEAF_POINTS):
            close = np.bitwise_count(some[at : at + LEAF_POINTS, None] ^ some[None, at:]) <= link_bits
            i, j = np.nonzero(close)
            keep = j > i
            if keep.any():
                yield some[at + i[keep]], some[at + j[keep]]


def least_roots(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For sorted points, the place of the least point each one is connected with."""
    root = np.arange(len(points))
    i, j = np.searchsorted(points, a), np.searchsorted(points, b)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def shard_links(shard: pd.DataFrame, link_bits: int) -> pd.DataFrame:
    """For each point that isn't the least of its local group, a link to that least point."""
    points = np.unique(shard["print"].to_numpy().view(np.uint64))
    root = np.arange(len(points))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for pair in local_links(points, link_bits):
        waiting.append(pair)
        held += len(pair[0])
        if held > 1 << 20:  # fold links into the groups so far, so that few are held
            root, waiting, held = _folded(points, root, waiting), [], 0
    root = _folded(points, root, waiting)
    moved = root != np.arange(len(points))
    return pd.DataFrame({"a": points[moved].view(np.int64), "b": points[root[moved]].view(np.int64)})


def _folded(points: np.ndarray, root: np.ndarray, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    a = np.concatenate([points, *(x for x, _ in links)])
    b = np.concatenate([points[root], *(y for _, y in links)])
    return least_roots(points, a, b)


def links(
    scratch: Scratch,
    points: DataFrame,
    link_bits: int = LINK_BITS,
    shard_points: int = SHARD_POINTS,
    shard_limit: int = SHARD_LIMIT,
) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that differ in few bits."""
    total = points.count()
    fitted = lowest(points.select("print"), ["print"], SAMPLE, total).collect()
    sample = np.array([r[0] for r in fitted], np.int64).view(np.uint64)
    tree = fit_tree(sample, -(-total // shard_points), link_bits)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for leaf, some in route(tree, batch["print"].to_numpy().view(np.uint64), link_bits):
                yield pd.DataFrame({"leaf": leaf, "print": some.view(np.int64)})

    dealt = scratch.store(points.select("print").mapInPandas(deal, "leaf int, print long"))
    # A shard above the limit becomes blocks that meet pair by pair; any other is one block. The tree has few leaves.
    sizes = dealt.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(shard_limit)).alias("n"))
    parts = sizes.withColumn("n", F.when(F.col("n") > 1, 2 * F.col("n")).otherwise(1))
    placed = dealt.join(F.broadcast(scratch.store(parts)), "leaf").withColumn("own", F.expr("pmod(xxhash64(print), n)"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)))
    keyed = met.select("leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "print")
    return keyed.groupBy("leaf", "i", "j").applyInPandas(lambda shard: shard_links(shard, link_bits), "a long, b long")


def components(scratch: Scratch, pairs: DataFrame) -> DataFrame:
    """(node, root): every node that has a smaller one in its component, and the smallest.

    Large-star and small-star steps in turn, each a join by node that adaptive execution can split.
    """

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = scratch.store(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = signature(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = scratch.store(both.where("b > a").join(growing(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = scratch.store(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(growing(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = scratch.store(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, link_bits: int = LINK_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Per document: row number, doc_id, fingerprint (hex), component_id, and whether it is the one that stays.

    component_id is the smallest doc_id that links reach (null ids aside); the first row with it stays.
    A text without words, or null, has fingerprint zero and links like any other. Other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.store(fingerprints(docs, shingle))
    first = F.min(F.struct(F.isnull("doc_id").alias("unknown"), "doc_id", F.col(ROW).alias("row")))
    points = scratch.store(prints.groupBy("print").agg(first.alias("first")))
    roots = components(scratch, links(scratch, points, link_bits, shard_points))
    rooted = scratch.store(
        points.join(growing(roots), F.col("print") == F.col("node"), "left").select(
            "print", "first", F.coalesce("root", "print").alias("root")
        )
    )
    firsts = scratch.store(rooted.groupBy("root").agg(F.min("first").alias("stays")))
    groups = scratch.store(rooted.join(growing(firsts), "root").select("print", "stays"))
    return prints.join(growing(groups), "print").select(
        ROW,
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("stays.doc_id").alias("component_id"),
        (F.col(ROW) == F.col("stays.row")).alias("stays"),
    )


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, link_bits: int = LINK_BITS) -> DataFrame:
    """One document of each group of near duplicates, with all its columns, whatever their names.

    It is the one with the smallest doc_id, nulls last; of rows that tie one stays, the same on each run. Null and empty
    texts have fingerprint zero and form one group.
    """
    return only_rows(docs, near_groups(docs, shingle, link_bits).where("stays"), ROW)
