"""Mixing sources to target weights by balanced sampling with the cube method.

A document of a source whose target is r times its size is taken floor(r) times, and once more with probability
r - floor(r). The cube method decides which: inclusion probabilities move through the
null-space of the balancing constraints (words and documents), so that both totals of a source stay what they
were expected to be, until all but two probabilities of a chunk are 0 or 1. What chunks leave open goes on in the next
round, and the last two documents of a source are the landing problem, solved by trying all cases.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, free_name, growing, ranked, text_or_empty, with_row_id

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
CHUNK_DOCS = 2048
SEED = 11
ROW, MARK = "__truegrain_row", "__truegrain_mark"
WORD = r"[^\x20\x09-\x0D]+"
SETTLED = 1e-9
LANDING_TURNS = 8


def targets(scratch: Scratch, sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Per source: rank, docs, source_size and target.

    Sources in the order of their code points, null last, have ``weights`` in turn and share the total of all
    sizes; no target exceeds ``most`` times the source's size, and what is above is shared again by weight.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranks = ranked(scratch, sums, F.col("source").isNull(), F.col("source"), name="rank")
    turn = F.array(*(F.lit(float(w)) for w in weights))
    sources = scratch.store(ranks.withColumn("weight", F.get(turn, (F.col("rank") % len(weights)).cast("int"))))
    cap = F.col("source_size") * F.lit(float(most))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share, capped = None, -1
    while True:
        full = F.lit(False) if share is None else F.col("weight") * share > cap
        left, open_weight, now = sources.agg(
            F.lit(float(total)) - F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.sum(F.when(~full, F.col("weight"))),
            F.count_if(full),
        ).first()
        if now == capped:
            break
        share, capped = (left / open_weight if open_weight else 0.0), now
    return sources.select("source", "rank", "docs", "source_size", F.least(cap, F.col("weight") * share).alias("target"))


def move(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The flight: probabilities after moves that keep sum(p) and sum(p * size), at most two of them open.

    Each move goes along the projection of the largest open document's axis on the null-space, so the
    largest documents are settled first and small ones are left to the end.
    """
    p = p.copy()
    open_ = np.flatnonzero((p > SETTLED) & (p < 1 - SETTLED))
    open_ = open_[np.argsort(-size[open_], kind="stable")]
    while len(open_) > 2:
        x, q = size[open_], p[open_]
        spread = x - x.mean()
        square = float(spread @ spread)
        step = np.full(len(x), -1.0 / len(x))
        if square > 0:
            step -= spread * (spread[0] / square)
        step[0] += 1.0
        if step @ step < 1e-18:  # the first one alone has another size: take its axis off the constraints
            step = np.full(len(x), 0.0)
            step[1], step[2] = 1.0, -1.0
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(step > 0, (1 - q) / step, np.where(step < 0, -q / step, np.inf)).min()
            down = np.where(step > 0, q / step, np.where(step < 0, (q - 1) / step, np.inf)).min()
        q = q + step * (up if rng.random() * (up + down) < down else -down)
        q[q < SETTLED], q[q > 1 - SETTLED] = 0.0, 1.0
        p[open_] = q
        open_ = open_[(q > 0) & (q < 1)]
    return p


def land(p: np.ndarray, size: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Settle the open rest: the case with totals nearest to what was expected, words before documents.

    A large document among the last can leave a gap of many words; settled documents of the same small problem are
    then turned over, one at a time, as long as that brings the words nearer to ``expected``.
    """
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    cases = [np.array(c, float) for c in itertools.product((0, 1), repeat=len(open_))]
    gap = [(abs(float((c - p[open_]) @ size[open_])), abs(float((c - p[open_]).sum()))) for c in cases]
    p[open_] = cases[min(range(len(cases)), key=gap.__getitem__)]
    for _ in range(LANDING_TURNS):
        over = float((p - expected) @ size)
        turned = np.abs(over + (1 - 2 * p) * size)
        best = int(np.argmin(turned))
        if turned[best] >= abs(over):
            break
        p[best] = 1 - p[best]
    return p


def _flight(seed: int, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fly(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values([MARK, ROW])
        key = [seed, turn, *(int(chunk[c].iloc[0]) for c in ("rank", "__chunk", "__sub"))]
        size = chunk["size"].to_numpy(float)
        expected = chunk["p"].to_numpy()
        p = move(expected, size, np.random.default_rng(key))
        p = land(p, size, expected) if chunk["__chunks"].iloc[0] == 1 and chunk["__subs"].iloc[0] == 1 else p
        landed = (p <= 0) | (p >= 1)
        return pd.DataFrame({**{c: chunk[c] for c in (ROW, MARK, "rank", "size")}, "p": p, "landed": landed})

    return fly


def balanced(scratch: Scratch, docs: DataFrame, chunk_docs: int, seed: int) -> DataFrame:
    """(row, p) with p 0 or 1, for rows (row, mark, rank, size, p, docs): ``docs`` is the number of rows of their source.

    Rows are dealt to chunks, and ordered in them, by their mark, which comes from id and text: the draws don't depend on
    where a row lies. A chunk that grows too large, which takes many rows alike, is cut by row number.
    """
    ddl = f"{ROW} string, {MARK} long, rank long, size long, p double, landed boolean"
    settled, turn = [], 0
    while True:
        chunks = F.greatest(F.ceil(F.col("docs") / chunk_docs), F.lit(1))
        chunk = F.pmod(F.xxhash64(F.lit(turn), MARK), F.col("__chunks"))
        dealt = docs.withColumn("__chunks", chunks).withColumn("__chunk", chunk)
        counts = dealt.groupBy("rank", "__chunk").agg(F.count("*").alias("__n")).where(F.col("__n") > 4 * chunk_docs)
        subs = F.coalesce(F.ceil(F.col("__n") / chunk_docs), F.lit(1))
        dealt = dealt.join(growing(scratch.store(counts)), ["rank", "__chunk"], "left").withColumn("__subs", subs)
        dealt = dealt.withColumn("__sub", F.pmod(F.xxhash64(F.lit(turn), ROW), F.col("__subs")))
        flown = scratch.store(dealt.groupBy("rank", "__chunk", "__sub").applyInPandas(_flight(seed, turn), ddl))
        settled.append(flown.where("landed").select(ROW, "p"))
        open_ = flown.where("not landed")
        left = scratch.store(open_.groupBy("rank").agg(F.count("*").alias("docs")))
        if left.isEmpty():
            break
        docs, turn = open_.join(growing(left), "rank").select(ROW, MARK, "rank", "size", "p", "docs"), turn + 1
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_REPEATS,
    chunk_docs: int = CHUNK_DOCS,
    seed: int = SEED,
    size: Column | None = None,
) -> DataFrame:
    """Per document: row number, doc_id, source, size, source_size, target, times and taken (times * size).

    A document without words (or null text) has size 0 and is taken no time. Rows with the same doc_id are separate.
    A null source is a source of its own. The same rows and seed give the same mix, in whatever order they are stored.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    size = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long") if size is None else size
    mark = F.xxhash64(F.lit(seed), "doc_id", text_or_empty())
    rows = with_row_id(docs, ROW).select(ROW, mark.alias(MARK), "doc_id", "source", size.alias("size"))
    sizes = scratch.store(rows)
    sources = scratch.store(targets(scratch, sizes, weights, most))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ratio = F.when(F.abs(ratio - F.round(ratio)) < SETTLED, F.round(ratio)).otherwise(ratio)
    known = sizes.join(growing(sources), sizes["source"].eqNullSafe(sources["source"])).select(
        ROW, MARK, "doc_id", sizes["source"], "size", "source_size", "target", "rank", "docs",
        F.floor(ratio).alias("whole"), (ratio - F.floor(ratio)).alias("p"),
    )
    known = scratch.store(known)
    picked = balanced(scratch, known.where("size > 0 and p > 0").select(ROW, MARK, "rank", "size", "p", "docs"), chunk_docs, seed)
    times = F.when(F.col("size") > 0, F.col("whole") + F.coalesce(F.col("pick"), F.lit(0.0))).otherwise(0).cast("long")
    return known.join(growing(picked.withColumnRenamed("p", "pick")), ROW, "left").select(
        ROW, "doc_id", "source", "size", "source_size", "target", times.alias("times"), (times * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns, whatever their names.

    Nulls and ties are treated as in ``mix``; copies of a document are equal rows.
    """
    row, copy = free_name(docs, ROW), free_name(docs, "__truegrain_copy")
    times = mix(docs).where("times > 0").select(F.col(ROW).alias(row), F.sequence(F.lit(1), F.col("times").cast("int")).alias(copy))
    copies = with_row_id(docs, row).join(growing(times), row)
    return copies.withColumn(copy, F.explode(copy)).select(docs.columns)
