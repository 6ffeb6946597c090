"""How the sources of a language differ in the words they use.

Terms come from one ``bytes.translate``, which lowers letters and blanks separators, and ``bytes.split``; a
``Counter`` per document gives its frequencies, and Arrow adds those of many documents up before they leave the
task. From then on only counts above zero are rows: a group's smoothed rate of a term it never uses depends on the
group alone, so a pair's sum over all terms is put together from the terms both use, the terms one
of them uses, and the number of all terms.

With p and q the smoothed rates of a term, in billionths, the divergence is f = floor((p - q)^2 / (p + q)).
Every step is in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from truegrain.llm.common import Scratch, arrow_schema, blanking, growing, slices, text_or_empty

LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
TERMS = blanking("a-zA-Z")
SLICE_BYTES = 1 << 23
HELD_PAIRS = 1 << 19  # sums of pairs that a task holds before it passes them on
PAIRS_AT_ONCE = 1 << 20


def terms(text: bytes) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, A-Z lowered, of a text in UTF-8."""
    return text.translate(TERMS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that have the term. Null lang, source and text are empty."""
    ddl = "lang string, source string, term string, n long, docs long"
    schema = arrow_schema(ddl)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                keys: list[bytes] = []
                often: list[int] = []
                sizes = []
                for text in some.column("text").cast(pa.binary()):
                    found = Counter(terms(text.as_py()))
                    keys.extend(found.keys())
                    often.extend(found.values())
                    sizes.append(len(found))
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                groups = pa.table({c: some.column(c) for c in ("lang", "source")}).take(owner)
                table = groups.append_column("term", pa.array(keys, pa.binary())).append_column("n", pa.array(often, pa.int64()))
                sums = table.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("n", "count")])
                sums = sums.rename_columns(["lang", "source", "term", "n", "docs"])
                sums = sums.set_column(2, "term", sums["term"].cast(pa.string()))
                yield from sums.cast(schema).to_batches()

    return named(docs).mapInArrow(counted, ddl).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def named(docs: DataFrame) -> DataFrame:
    return docs.select(*(text_or_empty(c).alias(c) for c in ("lang", "source", "text")))


def rate(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * terms)); decimals hold the product."""
    wide = lambda c: c.cast("decimal(27,0)")
    over = wide(total + 2 * terms)
    return F.when(over > 0, F.call_function("div", wide(n + 2) * F.lit(SCALE).cast("decimal(10,0)"), over) + 1)


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def rates(scratch: Scratch, docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Groups (lang, source, terms, p0) and cells (lang, source, term, n, p, p0, q), both stored.

    A cell is a kept term that the group uses, with the group's rate p and the language's rate q; p0 is the group's rate of
    a kept term that it doesn't use. A group without kept terms has 0 terms and no p0.
    """
    counts = scratch.store(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"))
    kept = scratch.store(kept.where(F.col("docs") >= least_docs).drop("docs"))
    used = scratch.store(counts.drop("docs").join(growing(kept), ["lang", "term"]))
    langs = scratch.store(kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total")))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = named(docs).select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["terms", "total", "lang_total"])
    groups = scratch.store(groups.withColumn("p0", rate(F.lit(0), F.col("total"), F.col("terms"))))
    cells = used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", rate(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "p0",
        rate(F.col("all"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    return groups.select("lang", "source", "terms", "p0"), scratch.store(cells)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _alike(batch: pa.Table) -> np.ndarray:
    """Numbers that change where the term or language of the next row does."""
    same = np.ones(batch.num_rows, bool)
    for c in ("lang", "term"):
        codes = batch[c].combine_chunks().dictionary_encode().indices.to_numpy()
        same[1:] &= codes[1:] == codes[:-1]
    same[0] = False
    return np.cumsum(~same)


def _pair_sums(table: pa.Table, sums: Counter) -> None:
    """Add to ``sums`` what the terms of the table, each with all its cells, say of the pairs that both use them.

    That is f(ps, pt) less f(ps, p0 of t), less f(p0 of s, pt), and f(p0 of s, p0 of t) again: the last three are put in for all terms
    of one group.
    """
    if not table.num_rows:
        return
    run = _alike(table)
    lang, source = (table[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
    langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
    language, code = (x.indices.to_numpy().astype(np.int64) for x in (lang, source))
    p, p0 = (table[c].to_numpy() for c in ("p", "p0"))
    first, step = np.arange(len(run)), 0
    while True:
        step += 1
        first = first[first + step < len(run)]
        first = first[run[first + step] == run[first]]
        if not len(first):
            return
        for at in range(0, len(first), PAIRS_AT_ONCE):
            i = first[at : at + PAIRS_AT_ONCE]
            j = i + step
            more = _f(p[i], p[j]) - _f(p[i], p0[j]) - _f(p0[i], p[j]) + _f(p0[i], p0[j])
            pair = (language[i] * len(sources) + code[i]) * len(sources) + code[j]
            order = np.argsort(pair, kind="stable")
            pair, more = pair[order], more[order]
            starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            for k, v in zip(pair[starts].tolist(), np.add.reduceat(more, starts).tolist()):
                k, t = divmod(k, len(sources))
                k, s = divmod(k, len(sources))
                sums[langs[k], sources[s], sources[t]] += v


def shared_terms(cells: DataFrame) -> DataFrame:
    """(lang, source, item, value), source before item: a pair's part of the sum that comes from terms both use.

    Cells of a term meet in one task, which adds pairs up over all its terms, so pairs don't leave it term by term.
    """
    ddl = "lang string, source string, item string, value long"
    schema = arrow_schema(ddl)

    def rows(sums: Counter) -> pa.RecordBatch:
        split = [(*names, v) for names, v in sums.items()]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*split), schema)], schema=schema)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if left is None else [left, batch])
            run = _alike(table)
            last = int(np.searchsorted(run, run[-1]))  # its term may go on in the next batch
            _pair_sums(table.slice(0, last), sums)
            left = table.slice(last).combine_chunks().to_batches()[0]
            if len(sums) > HELD_PAIRS:
                yield rows(sums)
                sums = Counter()
        if left is not None:
            _pair_sums(pa.Table.from_batches([left]), sums)
        if sums:
            yield rows(sums)

    by_term = cells.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return by_term.mapInArrow(added, ddl)


def pair_divergence(scratch: Scratch, groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each ordered pair of sources of a language, f summed over all kept terms."""
    both = scratch.store(shared_terms(cells).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"))
    spread = scratch.store(cells.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("k")))
    alone = spread.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("k") * (apart(F.col("p"), F.col("item_p0")) - apart(F.col("p0"), F.col("item_p0")))).alias("value")
    )
    alone = scratch.store(alone.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    unused = groups.join(other, "lang").where("source <> item").select(
        "lang", "source", "item", F.coalesce(F.col("terms") * apart(F.col("p0"), F.col("item_p0")), F.lit(0)).cast("long").alias("value")
    )
    turned = lambda df: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    parts = unused.unionByName(both).unionByName(turned(both)).unionByName(alone).unionByName(turned(alone))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergence(cells: DataFrame) -> DataFrame:
    """(lang, source, item, value): the terms that a group uses more than its language does, with f."""
    return cells.where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Per (lang, source): its other sources by divergence, and the terms it overuses most.

    Columns lang, source, part ('pair' or 'term'), item, value, rank; ranks go by value, then by the item's bytes. A term
    counts in a language where at least ``least_docs`` of its rows have it; each row of ``docs`` is a document, repeated
    ids too. Null text, lang and source are empty strings, so null and empty are one group. A group without terms has its
    pairs all the same, with value 0 where the language keeps none. Other columns are not looked at; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    groups, cells = rates(scratch, docs, least_docs)
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.row_number().over(by).alias("rank")]
    pairs = pair_divergence(scratch, groups, cells).withColumn("part", F.lit("pair")).select(columns)
    top = term_divergence(cells).withColumn("part", F.lit("term")).select(columns).where(F.col("rank") <= top_terms)
    return pairs.unionByName(top)
