"""Repeated passages: words of windows that also start in an earlier document are removed.

Documents are kept in compressed blocks. A first pass counts windows in a count-min sketch of several rows: each block sends the
distinct cells its windows fall on with their counts, cut into ranges; per range the counts of all blocks are added up, and each
block gets back one bit per cell: counted more than once or not. A window's count is estimated by its least cell, never too low, so a window
with a cell counted once occurs once, and is dropped. A second pass groups the windows that are left exactly, by
a 128-bit hash of their words: each block sends the smallest doc_id it has per window and gets back
whether another block has a smaller one. A third pass marks the covered words.

The sketch is sent sparse and is spread over its ranges, so no task holds it whole, and it grows with the corpus: its
width is a multiple of the number of windows. One row goes from a block to a range. Ranges grow with the square root of the
number of windows, up to ``RANGE_MOST`` times; blocks are as large as ``block_bytes`` says, to be raised for very large corpora.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, arrow_schema, mixed, text_or_empty

WINDOW = 13
DEPTH = 2  # rows of the sketch
CELLS_PER_WINDOW = 4  # in each row: two rows let about 5 % of the single windows through, as one of 20 would
BLOCK_BYTES = 4 << 20
RANGE_WINDOWS = 1 << 20
RANGES_FROM, RANGE_MOST = 1 << 28, 16  # windows from which on ranges grow, and how much
LAST = np.iinfo(np.int64).max  # compared in place of a null doc_id: smaller than none
SPACE = 0x20
PRIMES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

Row = dict[str, list]


def blocks(docs: DataFrame, block_bytes: int, window: int) -> DataFrame:
    """(block, body, windows): documents with their words joined by one space, about ``block_bytes`` a block."""
    ddl = "block long, body binary, windows long"
    schema = arrow_schema(ddl)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, texts, held, windows = [], [], 0, 0

        def block() -> pa.RecordBatch:
            table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())})
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, table.schema) as writer:
                writer.write_table(table)
            body = zstandard.compress(out.getvalue().to_pybytes(), 5)
            return pa.RecordBatch.from_arrays([[number], pa.array([body], pa.binary()), [windows]], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = text.as_py().encode().split()
                ids.append(doc_id)
                texts.append(b" ".join(words))
                held += len(texts[-1]) + 16
                windows += max(0, len(words) - window + 1)
                if held >= block_bytes:
                    yield block()
                    number, ids, texts, held, windows = number + 1, [], [], 0, 0
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(packed, ddl)


class Block:
    """A block's words and windows. All passes see the same windows in the same order."""

    def __init__(self, body: bytes, window: int):
        with pa.ipc.open_stream(zstandard.decompress(body)) as reader:
            table = reader.read_all()
        self.given = table["doc_id"].combine_chunks()
        self.ids = self.given.fill_null(LAST).to_numpy()
        self.texts = table["text"].to_pylist()
        self.window = window
        self.bytes = b" ".join([t for t in self.texts if t] + [b""])
        data = np.frombuffer(self.bytes, np.uint8)
        self.ends = np.flatnonzero(data == SPACE)
        self.begins = np.concatenate(([0], self.ends[:-1] + 1)) if len(self.ends) else self.ends
        sizes = np.array([len(t) + 1 if t else 0 for t in self.texts], np.int64)
        self.doc = np.searchsorted(np.cumsum(sizes), self.begins, "right")
        last = len(self.begins) - window + 1
        inside = self.doc[: max(last, 0)] == self.doc[window - 1 :] if last > 0 else np.zeros(0, bool)
        self.at = np.flatnonzero(inside)  # first word of each window
        self._data = data

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per window, from rolling sums; these only choose cells."""
        words = np.empty(len(self.begins), np.uint64)
        step = 1 << 19
        for start in range(0, len(self.begins), step):
            begins, ends = self.begins[start : start + step], self.ends[start : start + step]
            base = int(begins[0])
            piece = self._data[base : int(ends[-1])].astype(np.uint64) + np.uint64(1)
            sums, back = _rolling(piece, PRIMES[0])
            words[start : start + step] = (sums[ends - base] - sums[begins - base]) * back[begins - base]
        sums, back = _rolling(mixed(words), PRIMES[1])
        return mixed((sums[self.at + self.window] - sums[self.at]) * back[self.at])

    def cells(self, depth: int, bits: int) -> np.ndarray:
        """(depth, windows): the cells of each window; every row of the sketch has 2**bits cells."""
        hashed = self.hashes()
        rows = [mixed(hashed + np.uint64(r)) >> np.uint64(64 - bits) | np.uint64(r << bits) for r in range(depth)]
        return np.array(rows, np.uint64).reshape(depth, -1)

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """(windows, 2): the exact 128-bit names of windows, from their words joined by one space."""
        digest, text = xxhash.xxh3_128_digest, self.bytes
        spans = zip(self.begins[windows].tolist(), self.ends[windows + self.window - 1].tolist())
        return np.frombuffer(b"".join([digest(text[a:b]) for a, b in spans]), np.uint64).reshape(-1, 2)


def _rolling(values: np.ndarray, prime: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    sums = np.concatenate(([np.uint64(0)], np.cumsum(values * _powers(prime, len(values)), dtype=np.uint64)))
    return sums, _powers(np.uint64(pow(int(prime), -1, 1 << 64)), len(values) + 1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _planes(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes: the high bytes of small numbers cost next to nothing."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return zstandard.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def _values(body: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(body), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(flags).tobytes(), 1)


def _flags(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(body), np.uint8), count=n).astype(bool)


def _runs(ordered: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run of equal values."""
    edges = [0, *(np.flatnonzero(np.diff(ordered)) + 1).tolist(), len(ordered)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield int(ordered[start]), start, end


def _sketch_rows(block: Block, depth: int, bits: int, shift: int) -> Row:
    cells, counts = np.unique(block.cells(depth, bits), return_counts=True)
    out: Row = {"part": [], "cells": [], "often": []}
    for part, start, end in _runs(cells >> np.uint64(shift)):
        out["part"].append(part)
        out["cells"].append(_planes(np.diff(cells[start:end], prepend=np.uint64(part << shift))))
        out["often"].append(_planes(counts[start:end].astype(np.uint32)))
    return out


def _merged_counts(table: pa.Table) -> pa.Table:
    """Add up one range of the sketch; each block gets a bit per cell it sent: counted more than once."""
    cells = [np.cumsum(_values(c, "u8"), dtype=np.uint64) for c in table["cells"].to_pylist()]
    counts = [_values(o, "u4") for o in table["often"].to_pylist()]
    order, place = np.unique(np.concatenate(cells), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(order)) > 1
    ends = np.cumsum([len(c) for c in cells])
    answers = [_bits(total[place[e - len(c) : e]]) for c, e in zip(cells, ends)]
    return pa.table({"block": table["block"], "part": table["part"], "answer": pa.array(answers, pa.binary())})


def _answered(answers: pa.Table, sizes: list[tuple[int, int, int]]) -> np.ndarray:
    """One flag per item from the answers of all parts; ``sizes`` are the runs of items by part."""
    by_part = dict(zip(answers["part"].to_pylist(), answers["answer"].to_pylist()))
    return np.concatenate([np.zeros(0, bool), *(_flags(by_part[p], e - s) for p, s, e in sizes)])


def _candidates(block: Block, answers: pa.Table, depth: int, bits: int, shift: int) -> np.ndarray:
    """Windows all of whose cells are counted more than once (places in ``block.at``)."""
    cells = block.cells(depth, bits)
    distinct, place = np.unique(cells, return_inverse=True)
    often = _answered(answers, list(_runs(distinct >> np.uint64(shift))))
    return np.flatnonzero(often[place.reshape(cells.shape)].all(0)) if len(distinct) else np.zeros(0, np.int64)


def _exact_windows(block: Block, chosen: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order of part and key, their parts, their smallest doc_id here, and each window's key."""
    keys = block.keys(block.at[chosen])
    part = (keys[:, 0] % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((keys[:, 1], keys[:, 0], part))
    keys, part, owner = keys[order], part[order], block.ids[block.doc[block.at[chosen[order]]]]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(1)
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(owner, first) if len(first) else owner
    key_of = np.empty(len(keys), np.int64)
    key_of[order] = np.cumsum(new) - 1
    return keys[first], part[first], least, key_of


def _earlier(table: pa.Table) -> pa.Table:
    """Group one part of the windows exactly; each block gets a bit per key: a smaller doc_id has it elsewhere."""
    keys = [np.frombuffer(zstandard.decompress(k), np.uint64).reshape(-1, 2) for k in table["cells"].to_pylist()]
    least = [_values(o, "i8") for o in table["often"].to_pylist()]
    every, owner = np.concatenate(keys), np.concatenate(least)
    order = np.lexsort((every[:, 1], every[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (every[order][1:] != every[order][:-1]).any(1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    smallest = np.minimum.reduceat(owner[order], np.flatnonzero(new))
    flags, ends = smallest[group] < owner, np.cumsum([len(k) for k in keys])
    answers = [_bits(flags[e - len(k) : e]) for k, e in zip(keys, ends)]
    return pa.table({"block": table["block"], "part": table["part"], "answer": pa.array(answers, pa.binary())})


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    depth: int = DEPTH,
    cells_per_window: int = CELLS_PER_WINDOW,
    block_bytes: int = BLOCK_BYTES,
    range_windows: int = RANGE_WINDOWS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text and kept_sha256.

    A window is ``window`` consecutive words of one document. All words of a window are removed if the same words also
    start in a document with a smaller doc_id. Rows that share a doc_id don't remove each other's words; a null doc_id
    is larger than any other. A null text has no words. Other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    held = scratch.store(blocks(docs, block_bytes, window))
    windows = held.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
    range_windows *= min(RANGE_MOST, max(1.0, (windows / RANGES_FROM) ** 0.5))
    parts = max(1, math.ceil(windows / range_windows))
    bits = max(10, (cells_per_window * windows - 1).bit_length())
    shift = max(1, bits - (parts - 1).bit_length())
    sent, back = "part long, block long, cells binary, often binary", "block long, part long, answer binary"
    sent_schema = arrow_schema(sent)

    def sent_rows(number: int, rows: Row) -> pa.Table:
        return pa.table({"part": rows["part"], "block": [number] * len(rows["part"]), **{c: rows[c] for c in ("cells", "often")}}, sent_schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column("block").to_pylist(), batch.column("body")):
                yield from sent_rows(number, _sketch_rows(Block(body.as_py(), window), depth, bits, shift)).to_batches()

    def exact(one: pa.Table, answers: pa.Table) -> pa.Table:
        block, rows = Block(one["body"][0].as_py(), window), {"part": [], "cells": [], "often": []}
        keys, part, least, _ = _exact_windows(block, _candidates(block, answers, depth, bits, shift), parts)
        for number, start, end in _runs(part):
            rows["part"].append(number)
            rows["cells"].append(zstandard.compress(keys[start:end].tobytes(), 1))
            rows["often"].append(_planes(least[start:end]))
        return sent_rows(one["block"][0].as_py(), rows)

    kept = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
    kept_schema = arrow_schema(kept)

    def remove(one: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(one["body"][0].as_py(), window)
        again, later = (answers.filter(pa.compute.equal(answers["pass"], p)) for p in (1, 2))
        chosen = _candidates(block, again, depth, bits, shift)
        _, part, least, key_of = _exact_windows(block, chosen, parts)
        elsewhere = _answered(later, list(_runs(part)))
        at = block.at[chosen]
        covered = elsewhere[key_of] | (block.ids[block.doc[at]] > least[key_of])
        edges = np.zeros(len(block.begins) + 1, np.int64)
        np.add.at(edges, at[covered], 1)
        np.add.at(edges, at[covered] + window, -1)
        gone = np.cumsum(edges[:-1]) > 0
        n_words = np.bincount(block.doc, minlength=len(block.ids))
        n_removed = np.bincount(block.doc[gone], minlength=len(block.ids))
        first, texts = np.cumsum(n_words) - n_words, list(block.texts)
        for i in np.flatnonzero(n_removed):
            words = texts[i].split(b" ")
            stay = np.flatnonzero(~gone[first[i] : first[i] + n_words[i]])
            texts[i] = b" ".join([words[j] for j in stay])
        digests = [hashlib.sha256(t).hexdigest() for t in texts]
        return pa.table([block.given, pa.array(n_words), pa.array(n_removed), [t.decode() for t in texts], digests], schema=kept_schema)

    cells = held.select("block", "body").mapInArrow(sketch, sent)
    repeated = scratch.store(cells.groupBy("part").applyInArrow(_merged_counts, back))
    by_block = held.select("block", "body").groupBy("block")
    keys = by_block.cogroup(repeated.groupBy("block")).applyInArrow(exact, sent)
    earlier = scratch.store(keys.groupBy("part").applyInArrow(_earlier, back))
    answers = repeated.withColumn("pass", F.lit(1)).unionByName(earlier.withColumn("pass", F.lit(2)))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(remove, kept)
