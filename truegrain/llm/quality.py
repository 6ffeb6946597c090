"""Quality scores: random-indexing word vectors, pooled per document, under a small calibrated network.

Each word has a fixed sparse index vector of +1 and -1. A word's context vector is the sum of the index vectors of
its neighbours over all documents of the corpus, so words used alike get vectors alike. Words share a fixed number
of hashed slots, which bounds the table at every corpus size; the written form of a token (letters, digits or signs,
case, length, whether it touches the token before) is indexed beside the word. A document is the mean of its words'
vectors. A network of two layers, trained on a bounded sample of labelled documents, gives a logit, and a
temperature fitted on labelled documents kept apart makes it a probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import arrow_schema, growing, lowest, mixed, slices, text_or_empty

SLOTS = 1 << 15  # hashed words
FORMS = 256  # written forms of tokens
WIDTH = 64
ONES = 2  # entries of an index vector
TRAIN_ROWS = 20_000  # labelled documents the network is fitted on, at most
KEEP_AT = 0.7
HIDDEN = 32
SEED = 5
TEXT_AT_ONCE = 1 << 19
TOKENS_AT_ONCE = 1 << 14
PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)

#: Bytes by kind: 0 white space, 1 letters (all bytes beyond ASCII too), 2 digits, 3 signs.
KIND = np.full(256, 3, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
KIND[[*range(0x30, 0x3A)]] = 2


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every slot's and form's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, WIDTH, (SLOTS + FORMS, ONES)), rng.choice(np.array([-1.0, 1.0]), (SLOTS + FORMS, ONES))


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot, form and document of each token in UTF-8 bytes; ``starts`` are the documents' first bytes.

    A token is a run of bytes of one kind other than white space.
    """
    kind = KIND[data]
    first = np.ones(len(data) + 1, bool)
    first[1:-1] = kind[1:] != kind[:-1]
    first[starts[starts < len(data)]] = True
    edge = np.flatnonzero(first)
    begin, end = edge[:-1], edge[1:]
    spoken = kind[begin] > 0
    begin, end = begin[spoken], end[spoken]
    upper = (data >= 0x41) & (data <= 0x5A)
    low = np.where(upper, data + 32, data).astype(np.uint64) + np.uint64(1)
    powers = np.cumprod(np.full(len(data), PRIME, np.uint64))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(low * powers, dtype=np.uint64)))
    inverse = np.uint64(pow(int(PRIME), -1, 1 << 64))
    back = np.cumprod(np.full(len(data), inverse, np.uint64))
    hashes = mixed((sums[end] - sums[begin]) * back[begin])
    slot = (hashes >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
    capitals = np.concatenate(([0], np.cumsum(upper)))
    many = capitals[end] - capitals[begin]
    length = end - begin
    case = np.where(many == 0, 0, np.where(many == length, 2, np.where(upper[begin] & (many == 1), 1, 3)))
    touches = np.zeros(len(begin), np.int64)
    touches[1:] = begin[1:] == end[:-1]
    doc = np.searchsorted(starts, begin, "right") - 1
    touches[1:][doc[1:] != doc[:-1]] = 0
    form = ((kind[begin] - 1) * 4 + case) * 16 + np.minimum(length, 8) - 1 + 8 * touches
    return slot, form, doc


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the bytes of their texts and where each begins."""
    for some in slices(batch, "text", TEXT_AT_ONCE):
        texts = some.column("text").cast(pa.string()).fill_null("")
        sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(t.as_buffer() for t in texts), np.uint8)
        yield some, data, np.cumsum(sizes) - sizes


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Context vectors of all slots and forms (a table of fixed size), summed over all documents."""
    columns = [f"v{i}" for i in range(WIDTH)]
    ddl = "slot int, " + ", ".join(f"{c} int" for c in columns)
    schema = arrow_schema(ddl)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        total = np.zeros((SLOTS + FORMS) * WIDTH)
        for batch in batches:
            for _, data, starts in _texts(batch):
                slot, form, doc = tokens(data, starts)
                form = form + SLOTS
                near = doc[1:] == doc[:-1]
                left, right = np.flatnonzero(near), np.flatnonzero(near) + 1
                of, by = [], []
                for a, b in ((left, right), (right, left)):
                    of += [slot[a], slot[a], form[a], form[a]]
                    by += [slot[b], form[b], slot[b], form[b]]
                owner, neighbour = np.concatenate([*of, slot]), np.concatenate([*by, form])
                at = place[neighbour] + (owner * WIDTH)[:, None]
                total += np.bincount(at.ravel(), sign[neighbour].ravel(), len(total))
        table = np.rint(total).astype(np.int64).reshape(-1, WIDTH)
        while len(table):  # more than an int holds goes out in several rows
            some = np.clip(table, -(1 << 31) + 1, (1 << 31) - 1)
            used = np.flatnonzero(some.any(1))
            if not len(used):
                break
            arrays = [pa.array(used, pa.int32()), *(pa.array(some[used, i], pa.int32()) for i in range(WIDTH))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
            table = table - some

    parts = docs.select(text_or_empty().alias("text")).mapInArrow(sums, ddl)
    rows = parts.groupBy("slot").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
    table = np.zeros((SLOTS + FORMS, WIDTH), np.float32)
    if rows.num_rows:
        values = np.stack([rows[c].to_numpy() for c in columns], 1).astype(float)
        table[rows["slot"].to_numpy()] = values / np.maximum(np.sqrt((values**2).sum(1, keepdims=True)), 1e-9)
    return table


def pooled(table: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per document: the means of its words' and of its forms' vectors, then how often a token has the vector of the
    one before, and the logarithm of the number of tokens; zeros without tokens."""
    slot, form, doc = tokens(data, starts)
    out = np.zeros((len(starts), 2 * WIDTH + 2), np.float32)
    if len(slot):
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        there = doc[first]
        for place, start, end in zip(there.tolist(), first.tolist(), [*first[1:].tolist(), len(slot)]):
            for at in range(start, end, TOKENS_AT_ONCE):
                out[place, :WIDTH] += table.take(slot[at : min(end, at + TOKENS_AT_ONCE)], axis=0).sum(0)
        counts = np.bincount(doc * FORMS + form, minlength=len(starts) * FORMS).reshape(-1, FORMS)
        out[:, WIDTH : 2 * WIDTH] = counts.astype(np.float32) @ table[SLOTS:]
        again = np.flatnonzero((slot[1:] == slot[:-1]) & (doc[1:] == doc[:-1])) + 1
        out[:, -2] = np.bincount(doc[again], minlength=len(starts))
        out[there] /= (many := np.bincount(doc, minlength=len(starts))[there, None])
        out[there, -1] = np.log1p(many[:, 0])
    return out


class Network:
    """Two layers and a temperature; ``fit`` is repeatable for the same rows in the same order."""

    def __init__(self, base: float = 0.5):
        self.base = base
        self.weights: list[np.ndarray] | None = None
        self.temperature = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), np.log(self.base / (1 - self.base)))
        mean, scale, w1, b1, w2, b2 = self.weights
        return np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, turns: int = 30, rate: float = 3e-3, decay: float = 1e-4) -> Network:
        self.base = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        if len(y) < 10 or y.min() == y.max():
            return self
        rng = np.random.default_rng(SEED)
        order = rng.permutation(len(y))
        kept, used = order[: len(y) // 5], order[len(y) // 5 :]
        mean, scale = x[used].mean(0), x[used].std(0) + 1e-6
        z = (x - mean) / scale
        w = [rng.normal(0, WIDTH**-0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for _ in range(turns):
            for batch in np.array_split(rng.permutation(used), -(-len(used) // 256)):
                hidden = np.tanh(z[batch] @ w[0] + w[1])
                error = (1 / (1 + np.exp(-(hidden @ w[2] + w[3]))) - y[batch]) / len(batch)
                back = error[:, None] * w[2] * (1 - hidden**2)
                grads = [z[batch].T @ back + decay * w[0], back.sum(0), hidden.T @ error + decay * w[2], error.sum(keepdims=True)]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = [mean, scale, *w]
        logits, wanted = self.logit(x[kept]), y[kept]
        heats = np.geomspace(0.25, 8, 101)
        loss = [np.mean(np.logaddexp(0, logits / t) - wanted * logits / t) for t in heats]
        self.temperature = float(heats[int(np.argmin(loss))])
        return self


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, table: np.ndarray, rows: int = TRAIN_ROWS) -> Network:
    """Fit the network on at most ``rows`` labelled documents, taken by a hash of their ids; held-out ids never."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    there = one.join(growing(docs.select("doc_id").distinct()), "doc_id", "left_semi")
    sample = lowest(there, ["doc_id"], rows, there.count())
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id")
    ddl = "doc_id long, quality int, x array<float>"
    schema = arrow_schema(ddl)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, data, starts in _texts(batch):
                x = pooled(shared.value, data, starts)
                arrays = [some.column("doc_id").cast(pa.int64()), some.column("quality").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    shared = docs.sparkSession.sparkContext.broadcast(table)
    # Rows that repeat an id are one document of the sample, so that the bound holds.
    got = texts.mapInArrow(vectors, ddl).groupBy("doc_id").agg(F.min(F.struct("x", "quality")).alias("one"))
    fitted = got.select("doc_id", "one.*").toArrow().sort_by("doc_id").combine_chunks()
    shared.unpersist()
    if not fitted.num_rows:
        return Network()
    x = fitted["x"].combine_chunks().flatten().to_numpy().reshape(fitted.num_rows, -1)
    return Network().fit(x.astype(float), fitted["quality"].to_numpy().astype(float))


def _scoring(docs: DataFrame, labels: DataFrame) -> tuple[bool, Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, np.ndarray]]]]:
    """Fit on the documents; whether a network was fitted, and what gives, in a task, slices of a batch with their scores."""
    table = context_vectors(docs)
    network = train(docs, labels, table)
    shared = docs.sparkSession.sparkContext.broadcast((table, network))  # of fixed size

    def scores(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        table, network = shared.value
        for some, data, starts in _texts(batch):
            yield some, network.score(pooled(table, data, starts).astype(float))

    return network.weights is not None, scores


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted (1 from KEEP_AT on).

    Only the text makes the score; null counts as empty, and an empty text gets the score of a document without words.
    Without labels of both kinds all scores are the share of label 1. A null doc_id is not held out.
    """
    _, scores = _scoring(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, held_out boolean, score double, predicted int"
    schema = arrow_schema(ddl)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, score in scores(batch):
                arrays = [some.column("doc_id"), some.column("held_out"), pa.array(score), pa.array((score >= KEEP_AT).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows.mapInArrow(rated, ddl)


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with all their columns; rows stay where they are.

    Where no network is fitted, as with fewer than 10 labels that can be used or labels of one kind, nothing tells good
    documents from bad, and all are kept.
    """
    fitted, scores = _scoring(docs, labels)
    if not fitted:
        return docs

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, score in scores(batch):
                yield some.filter(pa.array(score >= KEEP_AT))

    return docs.mapInArrow(good, docs.schema)
