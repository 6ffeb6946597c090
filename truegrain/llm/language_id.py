"""Language of web pages by Bayesian fusion of evidence.

Four sources are fused: the likelihood of the page's text under letter models of the languages; the language its markup declares;
the suffix of its address; and a prior of its host, smoothed over a hierarchy (all pages, suffix, domain, host).
The letter models are counts of letter triples over all labelled documents. What a declaration is worth, how
languages spread over suffixes, and all priors are sums of text posteriors over groups of pages; a
page's own share is taken out of each sum before the sum is used on it, so that no page confirms itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, arrow_schema, growing, slices, text_or_empty, with_row_id

SLOTS = 1 << 14  # hashed letter triples
TEXT_WEIGHT = 0.25  # triples overlap and repeat, so a text's likelihood counts less than its length says
TEXT_MOST = 12.0  # nats that a text can speak for one language against another
STRENGTH = 4.0  # pages' worth of the coarser prior in a finer one
TEXT_AT_ONCE = 1 << 20
ROW = "__truegrain_row"
LEVELS = ("suffix", "domain", "host")
NOT_TEXT = re.compile(rb"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[^>]*>?|&[a-z#0-9]{1,8};")

#: Bytes as letter classes: ASCII letters in lower case, all bytes beyond ASCII as they are, anything else a space.
LETTER = np.full(256, 32, np.uint8)
LETTER[0x61:0x7B] = LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTER[0x80:] = np.arange(0x80, 0x100)


def triples(data: np.ndarray) -> np.ndarray:
    """Slots of the letter triples of UTF-8 bytes; triples of nothing but spaces, or with two spaces in a row, are left out."""
    x = LETTER[data].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    a, b, c = x[:-2], x[1:-1], x[2:]
    told = (a * np.uint32(65536) + b * np.uint32(256) + c)[~((b == 32) & ((a == 32) | (c == 32)))]
    return ((told * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64)


def _bytes(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for i, text in enumerate(column):
        yield i, np.frombuffer(text.as_buffer(), np.uint8)


def letter_models(docs: DataFrame, language: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order, and per language the log-probability of each slot, from all labelled documents."""
    ddl = "lang string, slot int, n long"
    schema = arrow_schema(ddl)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for some in slices(batch, "text", TEXT_AT_ONCE):
                names = some.column("lang").to_pylist()
                for i, data in _bytes(some.column("text")):
                    for at in range(0, len(data), TEXT_AT_ONCE):
                        found = np.bincount(triples(data[at : at + TEXT_AT_ONCE + 2]), minlength=SLOTS)
                        sums[names[i]] = sums.get(names[i], 0) + found
        for name, table in sums.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used)), pa.array(used, pa.int32()), pa.array(table[used])], schema=schema)

    labelled = docs.where(F.col(language).isNotNull()).select(F.col(language).alias("lang"), text_or_empty(text).alias("text"))
    rows = labelled.mapInArrow(counts, ddl).groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()  # SLOTS a language
    names = sorted(set(rows["lang"]))
    table = np.zeros((len(names), SLOTS))
    for k, name in enumerate(names):
        own = rows[rows["lang"] == name]
        table[k, own["slot"]] = own["n"]
    return names, np.log((table + 0.5) / (table + 0.5).sum(1, keepdims=True)) if len(names) else table


def visible(html: bytes) -> bytes:
    """The text of a page without markup, scripts, styles and comments."""
    return NOT_TEXT.sub(b" ", html)


def _address(url: Column) -> dict[str, Column]:
    host = F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return {
        "host": host,
        "domain": F.substring_index(host, ".", -2),
        "suffix": F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise(""),
    }


def _likelihoods(pages: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """Row, page_id, address parts, declared language and the text posterior (a double per language)."""
    tags = F.array_join(F.regexp_extract_all(text_or_empty("html"), F.lit(r"(?i)<html\b[^>]*+"), F.lit(0)), ">")
    declared = F.lower(F.regexp_extract(tags, r"(?i)\blang\s*+=\s*+[\"']?\s*+([a-z]{2,3})\b", 1))
    rows = with_row_id(pages, ROW).select(
        ROW, "page_id", declared.alias("declared"), text_or_empty("html").alias("text"),
        *(c.alias(n) for n, c in _address(F.col("url")).items()),
    )
    kept = [ROW, "page_id", "declared", *LEVELS]
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    ddl = f"{types}, likely array<double>"
    schema = arrow_schema(ddl)
    shared = pages.sparkSession.sparkContext.broadcast(table)  # SLOTS numbers a language

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            out = np.zeros((batch.num_rows, len(table)))
            for i, data in _bytes(batch.column("text")):
                text = np.frombuffer(visible(data.tobytes()), np.uint8)
                found = np.zeros(SLOTS)
                for at in range(0, len(text), TEXT_AT_ONCE):
                    found += np.bincount(triples(text[at : at + TEXT_AT_ONCE + 2]), minlength=SLOTS)
                logs = TEXT_WEIGHT * (table @ found)
                logs = np.maximum(logs - logs.max(), -TEXT_MOST)
                out[i] = np.exp(logs) / np.exp(logs).sum()
            arrays = [*(batch.column(c) for c in kept), pa.array(list(out), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows.select(*kept, "text").mapInArrow(likely, ddl)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normal(values: Column) -> Column:
    """An array of numbers over their sum."""
    return bound(values, lambda v: bound(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), lambda whole: F.transform(v, lambda x: x / whole)))


def identify(pages: DataFrame, docs: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """Per page: page_id, lang, confidence (its posterior), text_lang, declared, suffix and host.

    Languages are those of the labelled documents; without any, lang is null. A page without text, or null html, has the same
    likelihood under all languages and is told by its address alone; without an address (null url) host, domain and suffix are
    empty, which is a host like any other. Ties go to the first language by name. Rows that repeat a page_id are judged by themselves.
    """
    scratch = Scratch(pages.sparkSession, "language-id")
    names, table = letter_models(docs)
    if not names:
        empty = [F.lit(None).cast(t).alias(n) for n, t in (("lang", "string"), ("confidence", "double"), ("text_lang", "string"))]
        return pages.select("page_id", *empty, F.lit(None).cast("string").alias("declared"), *(
            _address(F.col("url"))[c].alias(c) for c in ("suffix", "host")))
    told = scratch.store(_likelihoods(pages, names, table))
    sums = [F.sum(F.get("likely", F.lit(k))).alias(f"s{k}") for k in range(len(names))]
    total = told.agg(*(F.coalesce(s, F.lit(0.0)) for s in sums)).first()
    grand = [float(t or 0.0) for t in total]

    def grouped(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        """Join a group's sums of text posteriors to its pages, less the page's own."""
        stored = scratch.store(told.groupBy(*keys).agg(F.array(*sums).alias(name)))
        less = F.zip_with(name, "likely", lambda s, p: F.greatest(s - p, F.lit(0.0)))
        return df.join(growing(stored), keys).withColumn(name, less)

    fused = told
    for level in LEVELS:
        fused = scratch.store(grouped(fused, [level], f"by_{level}"))
    fused = scratch.store(grouped(fused, ["declared"], "by_declared"))

    def prior(first: Column) -> Column:
        """From all pages down to the host, each level smoothed by the one above."""
        for level in LEVELS:
            first = normal(F.zip_with(f"by_{level}", first, lambda s, p: s + strength * p))
        return first

    def share(first: Column) -> Column:
        """How many times likelier a declaration is under a language than over all: its posterior share over the global share."""
        return normal(F.zip_with("by_declared", first, lambda s, p: s + strength * p))

    def fuse(first: Column) -> Column:
        by_address = F.zip_with("likely", prior(first), lambda x, p: x * p)
        both = F.zip_with(by_address, share(first), lambda x, s: x * s)
        return normal(F.zip_with(both, first, lambda x, p: x / p))

    everywhere = F.zip_with(F.array(*map(F.lit, grand)), "likely", lambda t, p: F.greatest(t - p, F.lit(0.0)) + 1.0)
    fused = fused.withColumn("__posterior", bound(normal(everywhere), fuse))

    def best(values: str) -> Column:
        return F.get(F.array(*map(F.lit, names)), (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    confidence = F.array_max("__posterior").alias("confidence")
    return fused.select("page_id", best("__posterior").alias("lang"), confidence, best("likely").alias("text_lang"), "declared", "suffix", "host")
