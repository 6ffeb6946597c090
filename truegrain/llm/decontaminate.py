"""Passages of test items in training documents, found with a generalised suffix automaton.

The items' words are the letters of the automaton. A document's words run through it once: at each word the
state and the matched length name the longest stretch ending there that occurs in some item. Where it reaches the
window, the last ``window`` words are hit, and the state leads to the items that have them.

The items are cut into shards of bounded size; each shard's automaton goes to all tasks in turn.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, arrow_schema, blanking, free_name, growing, text_or_empty, with_row_id

WINDOW = 10
SHARD_WORDS = 100_000  # words of items in one automaton, about 60 MB at most
PIECE_WORDS = 20_000
LETTERS = "0-9a-zA-Z"
WORDS = blanking(LETTERS)
PLACES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
ROW = "__truegrain_row"


def words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z lowered, of a text in UTF-8."""
    return text.translate(WORDS).split()


class Automaton:
    """All stretches of words of the pieces (item number, words, whole): smallest automaton of their suffixes.

    A piece of fewer words than the window counts where all of it occurs, if it is ``whole``, an item's only piece.
    """

    def __init__(self, pieces: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        coded = [(item, [self.number.setdefault(w, len(self.number)) for w in found]) for item, found in pieces]
        for _, codes in coded:
            state = 0
            for code in codes:
                state = self._extended(state, code)
        self._name_windows(coded)

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, code: int, target: int) -> int:
        """The state for the stretches of ``target`` that end a step after ``state``, made if longer ones share it."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state != -1 and self.next[state].get(code) == target:
            self.next[state][code] = copy
            state = self.link[state]
        return copy

    def _extended(self, last: int, code: int) -> int:
        if code in self.next[last]:  # another piece has been here
            return self._split(last, code, self.next[last][code])
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state != -1 and code not in self.next[state]:
            self.next[state][code] = new
            state = self.link[state]
        if state != -1:
            self.link[new] = self._split(state, code, self.next[state][code])
        return new

    def _name_windows(self, coded: list[tuple[int, list[int]]]) -> None:
        """``at``: a state's ancestor that stands for the last ``window`` words; ``owners``: the items that have those.

        ``whole`` has the short items that a state's stretch is, and ``short`` the nearest state with such, from it on upward.
        """
        states = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.at = [0] * len(states)
        self.owners: dict[int, list[int]] = {}
        self.whole: dict[int, tuple[int, list[int]]] = {}
        for state in states[1:]:
            self.at[state] = self.at[self.link[state]] if self.length[self.link[state]] >= self.window else state
        for item, codes in coded:
            state = 0
            for i, code in enumerate(codes):
                state = self.next[state][code]
                if i + 1 >= self.window:
                    owners = self.owners.setdefault(self.at[state], [])
                    if not owners or owners[-1] != item:
                        owners.append(item)
            if 0 < len(codes) < self.window:
                self.whole.setdefault(state, (len(codes), []))[1].append(item)
        self.short = [-1] * len(states)
        for state in states[1:]:
            self.short[state] = state if state in self.whole else self.short[self.link[state]]

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Hit stretches (start, end) of a document's words, the items that they come from, and the longest match."""
        moves, link, length, window, at = self.next, self.link, self.length, self.window, self.at
        short = self.short if self.whole else None
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        state = matched = longest = 0
        number = self.number.get
        for i, code in enumerate([number(w, -1) for w in found]):
            if code < 0:
                state = matched = 0
                continue
            target = moves[state].get(code)
            if target is None:
                while state and target is None:
                    state = link[state]
                    target = moves[state].get(code)
                matched = length[state]
                if target is None:
                    continue
            state = target
            matched += 1
            if matched > longest:
                longest = matched
            if matched >= window:
                spans.append((i + 1 - window, i + 1))
                items.update(self.owners[at[state]])
            if short is not None:
                above = short[state]
                while above != -1:
                    size, whole = self.whole[above]
                    if size <= matched:
                        spans.append((i + 1 - size, i + 1))
                        items.update(whole)
                    above = short[link[above]]
        return joined(spans), items, longest


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that meet or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def pieces(scratch: Scratch, items: DataFrame, window: int, piece_words: int) -> DataFrame:
    """(item_id, piece, n): items' words, joined by spaces, in pieces that share ``window - 1`` words; items without words have none.

    Each window is in one piece at least, and an item of fewer words than the window is one piece.
    """
    ddl = "item_id string, piece string, n int"
    schema = arrow_schema(ddl)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                found = words(text.encode())
                for start in range(0, max(len(found) - window, 0) + 1, piece_words):
                    some = found[start : start + piece_words + window - 1]
                    if some:
                        rows.append((item, b" ".join(some).decode(), len(some)))
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return scratch.store(items.select(text_or_empty("item_id").alias("item_id"), text_or_empty().alias("text")).distinct().mapInArrow(cut, ddl))


def _shards(scratch: Scratch, items: DataFrame, window: int, shard_words: int, piece_words: int) -> tuple[DataFrame, int]:
    """The items' pieces, and the number of shards to deal them to."""
    cut = pieces(scratch, items, window, piece_words)
    total = cut.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return cut, max(1, -(-total // shard_words))


def _automaton(cut: DataFrame, shard: int, shards: int, window: int) -> Broadcast:
    """A shard's automaton and the ids of its items, by their numbers in it."""
    dealt = cut.where(F.pmod(F.xxhash64("item_id", "piece"), F.lit(shards)) == shard).orderBy("item_id", "piece").collect()
    ids = sorted({r["item_id"] for r in dealt})
    place = {item: i for i, item in enumerate(ids)}
    built = Automaton([(place[r["item_id"]], r["piece"].encode().split(b" ")) for r in dealt], window)
    return cut.sparkSession.sparkContext.broadcast((built, ids))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, piece_words: int = PIECE_WORDS
) -> DataFrame:
    """Per document: row number, doc_id, n_words, spans (start, end; in words, end exclusive), longest match, items.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item, or of a whole shorter item. Spans
    are the runs of hit words; ``items`` are the ids, as sorted strings, of the items that occur. Null texts have no words; rows of items
    with the same id are one item, a null id the empty string. Rows of documents are separate, whatever their ids.
    Empty tables of either kind are fine. Documents are never joined or shuffled while there is one shard of items.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    cut, shards = _shards(scratch, items, window, shard_words, piece_words)
    rows = with_row_id(docs, ROW).select(ROW, "doc_id", text_or_empty().alias("text"))
    ddl = f"{ROW} string, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, spans array<struct<start:int,end:int>>, longest int, items array<string>"
    schema = arrow_schema(ddl)

    def scan(shard: int) -> DataFrame:
        shared = _automaton(cut, shard, shards, window)

        def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton, ids = shared.value
            for batch in batches:
                n_words, spans, longest, found_items = [], [], [], []
                for text in batch.column("text").cast(pa.binary()):
                    found = words(text.as_py())
                    hit, of, most = automaton.hits(found)
                    n_words.append(len(found))
                    spans.append([{"start": a, "end": b} for a, b in hit])
                    longest.append(most)
                    found_items.append(sorted(ids[i] for i in of))
                arrays = [batch.column(ROW), batch.column("doc_id"), *(pa.array(x, schema.field(i + 2).type) for i, x in enumerate((n_words, spans, longest, found_items)))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        return rows.mapInArrow(scanned, ddl)

    if shards == 1:
        return scan(0)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"start": a, "end": b} for a, b in joined([(s["start"], s["end"]) for s in x])] for x in batch.column("spans").to_pylist()]
            yield batch.set_column(batch.schema.names.index("spans"), schema.field("spans"), pa.array(spans, schema.field("spans").type))

    found = scratch.store(scan(0))
    for shard in range(1, shards):
        found = found.unionByName(scratch.store(scan(shard).where(F.size("items") > 0)))
    same = F.sort_array(F.array_distinct(F.flatten(F.collect_list("items"))))
    together = found.groupBy(ROW).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.max("longest").alias("longest"), same.alias("items"),
    )
    return together.mapInArrow(merged, ddl)


def report(found: DataFrame) -> DataFrame:
    """What ``contamination`` found as numbers: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text less its words in the spans and what stands between them; what is left is joined by one space."""
    raw = text.encode()
    places = [m.span() for m in PLACES.finditer(raw)]
    left, at = [], 0
    for start, end in spans:
        left.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    parts = [p.decode() for p in (*left, raw[at:])]
    return " ".join(p.strip() for p in parts if p.strip())


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    longest: int = 0,
    coverage: float = 0.5,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The documents, with all their columns, less the spans of more than ``longest`` words.

    A document whose hit words are more than ``coverage`` of its words goes as a whole. Texts without such spans, and null ones,
    stay as they are. With one shard of items documents stay where they are; with several, spans of all shards are put together first
    and joined to the documents.
    """
    cut, shards = _shards(Scratch(docs.sparkSession, "decontaminate"), items, window, shard_words, PIECE_WORDS)
    if shards == 1:
        shared = _automaton(cut, 0, 1, window)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton, _ = shared.value
            for batch in batches:
                texts, stay = batch.column("text").to_pylist(), []
                for i, text in enumerate(texts):
                    found = words((text or "").encode())
                    spans, _, _ = automaton.hits(found)
                    stay.append(sum(b - a for a, b in spans) <= coverage * len(found))
                    far = [(a, b) for a, b in spans if b - a > longest]
                    texts[i] = without(text, far) if far and stay[-1] else text
                yield _with_texts(batch, texts).filter(pa.array(stay, pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)

    row, cuts = free_name(docs, ROW), free_name(docs, "__truegrain_cuts")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    far = F.filter("spans", lambda s: s["end"] - s["start"] > longest)
    found = contamination(docs, items, window, shard_words).where(F.size("spans") > 0)
    verdict = F.struct((n_hit > coverage * F.col("n_words")).alias("drop"), far.alias("spans"))
    told = with_row_id(docs, row).join(growing(found.select(F.col(ROW).alias(row), verdict.alias(cuts))), row, "left")
    told = told.where(F.col(cuts).isNull() | ~F.col(cuts)["drop"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(s["start"], s["end"]) for s in c["spans"]] if c else [] for c in batch.column(cuts).to_pylist()]
            texts = [without(t, x) if x else t for t, x in zip(batch.column("text").to_pylist(), spans)]
            yield _with_texts(batch, texts).select([i for i, c in enumerate(batch.schema.names) if c != cuts])

    return told.select(*docs.columns, cuts).mapInArrow(remove, docs.schema)


def _with_texts(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
    place = batch.schema.names.index("text")
    return batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
