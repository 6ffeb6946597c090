"""Spelling variants: words one edit apart, found with an index of grams of variable length.

A word, between two end marks, is cut into grams of two to four characters: from each place the shortest stretch that
the dictionary doesn't hold as frequent, unless the gram before reaches as far. An edit at place i of the marked word only
touches grams that end after i and within ``MOST`` of it, whose number per word is counted; the others stand in the word's variant
as well, at the same distance from the start if they are left of the edit and from the end if right of it. Grams end at different
places, the first by 4 and the last with the word, so a word of seven characters or more keeps one at least.

So of a word's grams, rarest first, only as many lists as an edit can touch and one more have to be merged. A list holds the
words of one length that have the gram at one place, and those one shorter; the words of a list are compared by their characters.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, arrow_schema, growing, mixed, slices, text_or_empty

LEAST, MOST = 2, 4  # characters of a gram
LEAST_CHARS = 7
LEAST_COUNT = 2
FORM_TIMES = 10
SPOILT = 31  # a run is spoilt if this divides its mark
DICTIONARY = 1 << 16  # frequent grams of a length: no more than this many can be
LEAST_FREQUENT = 16
LIST_WORDS = 8192  # words of a list that meet in one task; longer ones are cut into blocks that meet pair by pair
LONG_LISTS = 1 << 18  # no more lists than this are that long
PAIRS_AT_ONCE = 1 << 18
COMPARED_BYTES = 1 << 24
SLICE_BYTES = 1 << 23
#: Latin-1: A-Z lowered; a-z and the characters from U+00C0 on stay; all else is blank.
RUNS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 192 else 32 for i in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters up to U+00FF, in Latin-1, A-Z lowered."""
    return text.encode("latin-1", "replace").translate(RUNS).split()


def spoilt(run: bytes, mark: int) -> bytes:
    """The run less one character if ``SPOILT`` divides the crc32 of the document's mark and the run."""
    hashed = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), mark)
    if hashed % SPOILT:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough. Null text: no words; null doc_id: marked as empty."""
    ddl = "word string, n long"
    schema = arrow_schema(ddl)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                found: Counter[bytes] = Counter()
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    mark = zlib.crc32(f"{doc_id}:".encode())
                    for run, n in Counter([r for r in runs(text) if len(r) >= least_chars]).items():
                        found[spoilt(run, mark)] += n
                words = [w.decode("latin-1") for w in found]
                table = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(found.values(), pa.int64())], schema=schema)
                yield table.filter(pa.compute.greater_equal(pa.compute.utf8_length(table.column("word")), least_chars))

    rows = docs.select(text_or_empty("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(counted, ddl).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def frequent_grams(scratch: Scratch, words: DataFrame, dictionary: int = DICTIONARY, least: int = LEAST_FREQUENT) -> tuple[dict[str, int], int]:
    """The gram dictionary, and the number of places of all words.

    It has the grams of up to ``MOST`` characters that are more frequent than a threshold, which grows with the number of places, so
    that no length has more than ``dictionary`` of them.
    """

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for word in batch.column("word").to_pylist():
                marked = f"^{word}$"
                for size in range(LEAST, MOST + 1):
                    found.update([marked[i : i + size] for i in range(len(marked) - size + 1)])
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(found.values(), pa.int64())], ["gram", "n"])

    counts = scratch.store(words.select("word").mapInArrow(grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    places = counts.where(F.length("gram") == LEAST).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    threshold = max(least, -(-places // dictionary))
    return {r["gram"]: r["n"] for r in counts.where(F.col("n") > threshold).collect()}, places


def decomposed(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of a word's grams, between its end marks."""
    marked = f"^{word}$"
    out, reached = [], 0
    for start in range(len(marked) - LEAST + 1):
        end = start + LEAST
        while end < len(marked) and end - start < MOST and marked[start:end] in frequent:
            end += 1
        if end > reached:
            out.append((start, end))
            reached = end
    return out


def touched(grams: list[tuple[int, int]]) -> int:
    """The most grams that one edit can touch: an edit at place i touches grams that end in (i, i + MOST]."""
    ends = [end for _, end in grams]
    most = last = 0
    for first, end in enumerate(ends):
        while last < len(ends) and ends[last] < end + MOST:
            last += 1
        most = max(most, last - first)
    return most


def merged_lists(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """(start, gram) of the lists to merge: rarest first, one more than an edit can touch."""
    grams = decomposed(word, frequent)
    marked = f"^{word}$"
    named = [(frequent.get(gram, 0), gram, a) for a, gram in [(a, marked[a:b]) for a, b in grams]]
    named.sort()
    return [(a, gram) for _, gram, a in named[: touched(grams) + 1]]


def listings(words: list[str], frequent: dict[str, int], above: int = -1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list, chars, place of the word): four entries for each gram to merge, of those more frequent than ``above``.

    A list is named by gram, place from the start (even) or from the end (odd), and number of characters of its longer words.
    """
    known: dict[str, int] = {}
    hashes, starts, owner = [], [], []
    for i, word in enumerate(words):
        for start, gram in merged_lists(word, frequent):
            if above >= 0 and frequent.get(gram, 0) <= above:
                continue
            hashed = known.get(gram)
            if hashed is None:
                hashed = known[gram] = xxhash.xxh64_intdigest(gram.encode())
            hashes.append(hashed)
            starts.append(start)
            owner.append(i)
    owner, starts = np.array(owner, np.int64), np.array(starts, np.int64)
    size = np.array([len(w) for w in words], np.int64)[owner]
    gram = np.array(hashes, np.uint64)
    lists, chars = [], []
    for side, place in ((0, starts), (1, size + 2 - starts)):
        for longer in (size, size + 1):
            named = mixed(gram ^ mixed((place * 2 + side).astype(np.uint64) + mixed(longer.astype(np.uint64))))
            lists.append(named & ~np.uint64(1) | np.uint64(side))
            chars.append(longer)
    return np.concatenate(lists).view(np.int64), np.concatenate(chars), np.tile(owner, 4)


def long_lists(words: DataFrame, frequent: Broadcast, limit: int) -> dict[int, int]:
    """Lists of more than ``limit`` words, with the number of blocks to cut them into.

    Only grams that are more frequent than that can have them, and the entries over the limit bound their number.
    """
    if not any(n > limit for n in frequent.value.values()):
        return {}
    schema = arrow_schema("list long")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, _, _ = listings(batch.column("word").to_pylist(), frequent.value, limit)
            yield pa.RecordBatch.from_arrays([pa.array(lists)], schema=schema)

    counts = words.select("word").mapInArrow(listed, "list long").groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    return {r["list"]: 2 * -(-r["n"] // limit) for r in counts.collect()}


def entries(words: DataFrame, frequent: Broadcast, blocks: dict[int, int]) -> DataFrame:
    """(list, pair, own, chars, word, n): a word in each list it has to be met in.

    A long list's words are dealt to blocks; a word is then there once for each pair of blocks its own takes part in.
    """
    ddl = "list long, pair long, own int, chars int, word string, n long"
    schema = arrow_schema(ddl)
    cut = words.sparkSession.sparkContext.broadcast(blocks)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            lists, chars, owner = listings(words, frequent.value)
            own, pair = np.zeros((2, len(lists)), np.int64)
            if cut.value:
                number = np.array([cut.value.get(x, 1) for x in lists.tolist()])
                hashed = np.array([xxhash.xxh64_intdigest(w.encode(), 1) for w in words], np.uint64)
                own = (hashed[owner] % number.astype(np.uint64)).astype(np.int64)
                times = np.repeat(np.arange(len(lists)), number)
                other = np.arange(len(times)) - np.repeat(np.cumsum(number) - number, number)
                lists, chars, owner, own = lists[times], chars[times], owner[times], own[times]
                pair = np.minimum(own, other) << 32 | np.maximum(own, other)
            taken = batch.take(pa.array(owner))
            arrays = [pa.array(lists), pa.array(pair), pa.array(own.astype(np.int32)), pa.array(chars.astype(np.int32)), taken.column("word"), taken.column("n")]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return words.select("word", "n").mapInArrow(listed, ddl)


def one_edit(longer: np.ndarray, other: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Row by row: other is the longer word with one character replaced or, where ``short``, less one (its row then ends in 0)."""
    differ = longer != other
    good = (differ.sum(1) == 1) & ~short
    if short.any():
        some = np.flatnonzero(short)
        first = differ[some].argmax(1)
        shifted = longer[some, 1:] != other[some, :-1]
        good[some] = ~(shifted & (np.arange(shifted.shape[1]) >= first[:, None])).any(1)
    return good


def _differing(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes aren't 0."""
    x = x | x >> np.uint64(4)
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return np.bitwise_count(x & np.uint64(0x0101010101010101))


def _low_bits(x: np.ndarray) -> np.ndarray:
    """Eight times the number of bytes that are 0 before the first that isn't, for numbers above 0."""
    return np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) & np.uint8(0xF8)


def one_edit_packed(longer: np.ndarray, other: np.ndarray, short: np.ndarray) -> np.ndarray:
    """The same for words of up to 16 characters, as two numbers of eight bytes each, the first character lowest."""
    lo, hi = longer[:, 0] ^ other[:, 0], longer[:, 1] ^ other[:, 1]
    good = (_differing(lo) + _differing(hi) == 1) & ~short
    some = np.flatnonzero(short)
    if len(some):
        # Less one character at the first difference: from there on the rest has to fit, moved by one.
        lo, hi, a, b = lo[some], hi[some], longer[some], other[some]
        rest_lo = (a[:, 0] >> np.uint64(8) | a[:, 1] << np.uint64(56)) ^ b[:, 0]
        rest_hi = a[:, 1] >> np.uint64(8) ^ b[:, 1]
        early = lo != 0
        first = rest_lo >> _low_bits(np.where(early, lo, 1)).astype(np.uint64)
        later = rest_hi >> _low_bits(np.where(hi != 0, hi, 1)).astype(np.uint64)
        good[some] = np.where(early, (first == 0) & (rest_hi == 0), later == 0)
    return good


def _asked(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with start[i] <= j < end[i], about ``PAIRS_AT_ONCE`` at a time."""
    number = np.maximum(end - start, 0)
    upto = np.cumsum(number)
    at = 0
    while at < len(number):
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] - number[at] + PAIRS_AT_ONCE, "right")))
        some = number[at:stop]
        first = np.repeat(np.arange(at, stop), some)
        yield first, np.arange(len(first)) - np.repeat(np.cumsum(some) - some, some) + np.repeat(start[at:stop], some)
        at = stop


def near_in_lists(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (longer or either, other) of near words in lists that are whole, each in consecutive rows."""
    names = [table[c].to_numpy() for c in ("chars", "list", "pair")]
    own, size = table["own"].to_numpy(), pa.compute.utf8_length(table["word"]).to_numpy()
    change = np.zeros(table.num_rows, bool)
    for c in names:
        change[1:] |= c[1:] != c[:-1]
    run = np.cumsum(change)
    order = np.lexsort((size != names[0], run))  # the longer words of a list first
    words = [w.encode("latin-1") for w in table["word"].to_pylist()]
    edges = np.flatnonzero(np.r_[True, names[0][1:] != names[0][:-1], True])
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        rows = order[start:end]
        width = int(names[0][start])
        room = max(16, width)
        letters = np.frombuffer(b"".join([words[i].ljust(room, b"\0") for i in rows.tolist()]), np.uint8).reshape(-1, room)
        packed = letters.view(np.uint64) if width <= 16 else letters
        test = one_edit_packed if width <= 16 else one_edit
        ids, full = run[rows], size[rows] == width
        number = np.arange(len(rows))
        last = np.searchsorted(ids, ids, "right")
        shorter = np.searchsorted(ids, ids, "left") + np.bincount(ids - ids[0], full)[ids - ids[0]].astype(np.int64)
        # By the start, a longer word meets those after it; by the end, the shorter ones. Shorter words don't meet each other.
        first = np.where(names[1][rows] & 1, shorter, number + 1)
        several = names[2][rows] >> 32 != names[2][rows] & 0xFFFFFFFF
        for a, b in _asked(np.where(full, first, last), last):
            if several.any():
                ask = ~several[a] | (own[rows[a]] != own[rows[b]])
                a, b = a[ask], b[ask]
            step = max(1, COMPARED_BYTES // room)
            for at in range(0, len(a), step):
                x, y = a[at : at + step], b[at : at + step]
                good = test(packed[x], packed[y], ~full[y])
                if good.any():
                    yield rows[x[good]], rows[y[good]]


def near_words(scratch: Scratch, words: DataFrame, dictionary: int = DICTIONARY, list_words: int = LIST_WORDS) -> DataFrame:
    """(word, near, near_n): each ordered pair of words one edit apart, once."""
    grams, places = frequent_grams(scratch, words, dictionary)
    frequent = words.sparkSession.sparkContext.broadcast(grams)
    limit = max(list_words, -(-4 * places // LONG_LISTS))
    blocks = long_lists(words, frequent, limit)
    ddl = "word string, near string, n long, near_n long"
    schema = arrow_schema(ddl)
    group = ["list", "pair"]

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        word, n = table["word"].combine_chunks(), table["n"].combine_chunks()
        for a, b in near_in_lists(table):
            a, b = pa.array(a), pa.array(b)
            left, right = word.take(a), word.take(b)
            turn = pa.compute.greater(left, right)  # each pair one way round
            put = lambda x, y: pa.compute.if_else(turn, y, x)
            x, y = n.take(a), n.take(b)
            yield pa.RecordBatch.from_arrays([put(left, right), put(right, left), put(x, y), put(y, x)], schema=schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by list; the last list of a batch may go on in the next."""
        left: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy() for c in group], 1)
            change = np.flatnonzero((names[1:] != names[:-1]).any(1))
            if left and any(left[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in group):
                yield from found(pa.Table.from_batches(left))
                left = []
            if not len(change):
                left.append(batch)
                continue
            last = int(change[-1]) + 1
            yield from found(pa.Table.from_batches([*left, batch.slice(0, last)]))
            left = [batch.slice(last)]
        if left:
            yield from found(pa.Table.from_batches(left))

    met = entries(words, frequent, blocks).repartition(*group).sortWithinPartitions("chars", *group)
    pairs = scratch.store(met.mapInArrow(meet, ddl).distinct())
    turned = pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.drop("n").unionByName(turned)


def roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: where following forms ends.

    Each turn doubles the steps taken, and forms grow tenfold in number, so a few turns do.
    """
    now = scratch.store(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = scratch.store(now.join(growing(further), "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), "beyond"))
        if step.where("beyond is not null").isEmpty():
            return now
        now = step.select("word", "root")


def variants(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    times: int = FORM_TIMES,
    dictionary: int = DICTIONARY,
    list_words: int = LIST_WORDS,
) -> DataFrame:
    """Per word: form, root, n, n_near and form_n.

    Words are runs of Latin letters after spoiling (see ``spoilt``), with ``least_chars`` characters and ``least_count`` occurrences at least;
    the guarantee above needs seven characters. A word's form is the most frequent word one edit away, of ties the least, if it is ``times``
    as frequent as the word; root is where forms lead, the word itself if it has none. Null or empty texts add no words, a null doc_id
    marks like an empty one, repeated rows count each. Other columns are not looked at.
    """
    if least_chars < LEAST_CHARS:
        raise ValueError(f"words under {LEAST_CHARS} characters may share no gram with a variant")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.store(word_counts(docs, least_chars, least_count))
    near = near_words(scratch, words, dictionary, list_words)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    about = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    told = words.join(growing(about), "word", "left").withColumn("best_n", -F.col("best.less"))
    good = F.col("best_n") >= times * F.col("n")
    told = scratch.store(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best.near")).alias("form"), F.when(good, F.col("best_n")).alias("form_n"),
        )
    )
    ends = roots(scratch, told.where("form is not null"))
    return told.join(growing(ends), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
