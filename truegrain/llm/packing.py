"""Best-fit packing of token pieces into sequences, certified by lower bounds.

Documents are tokenised and cut into pieces. Pieces are dealt to partitions of bounded size, each packed by
best-fit decreasing. Dual-feasible functions give a lower bound on the sequences any packing
of a partition needs. A partition that meets its bound is certified: its sequences stay, but for the last one
if that has room, which is what rounding the bound up costs. A partition with a gap gives away all sequences
with room. The pieces given away are dealt anew, by another hash, and packed again, as long as that saves sequences.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import Scratch, arrow_schema, text_or_empty

SEQUENCE = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k"
PARTITION_PIECES = 8192
ROUNDS = 6
#: Text in which the two libraries could differ goes to the slower one: special tokens' strings, controls,
#: letters beyond Latin (they may know different Unicode versions), and very long runs of space.
RARE = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u024f]|<\||\s{1000}")


def encoder(name: str = TOKENIZER) -> Callable[[str], list[int]]:
    """Token ids as ``tokenizers`` gives them for ``name``.json without special tokens.

    Plain Latin text is encoded by ``tiktoken`` from the same vocabulary, which gives the same ids three
    times as fast; all other text by ``tokenizers`` itself.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    full = []

    def encode(text: str) -> list[int]:
        if not RARE.search(text):
            return plain.encode_ordinary(text)
        if not full:
            from tokenizers import Tokenizer

            full.append(Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))
        return full[0].encode(text, add_special_tokens=False).ids

    return encode


def cuts(length: int, sequence: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first can be shorter than a sequence."""
    first = length % sequence or sequence
    yield 0, min(first, length)
    for start in range(first, length, sequence):
        yield start, sequence


def pieces(docs: DataFrame, sequence: int = SEQUENCE, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32; the last id of each document is END_ID. Null text: empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    schema = arrow_schema(ddl)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows = []
            for place, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py()), END_ID], "<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), sequence)):
                    rows.append((place, piece, start, length, zlib.crc32(ids[start : start + length])))
            place, *columns = zip(*rows) if rows else ((),) * 5
            owners = batch.column("doc_id").take(pa.array(place, pa.int64()))
            arrays = [owners, *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut, ddl)


def least_sequences(lengths: np.ndarray, sequence: int) -> int:
    """A lower bound on the sequences that hold all pieces: the best of two families of dual-feasible functions.

    A dual-feasible function maps sizes to shares so that the shares of what fits into one sequence add up
    to 1 at most; the sum of all shares, rounded up, is then a bound.
    """
    count = np.bincount(lengths, minlength=sequence + 1).astype(np.int64)
    size = np.arange(sequence + 1)
    number, amount = np.cumsum(count), np.cumsum(count * size)
    best = -(-int(amount[-1]) // sequence)
    cut = np.arange(1, sequence // 2 + 1)  # sizes below a cut count 0, sizes above sequence - cut count 1
    whole = (number[-1] - number[sequence - cut]) * sequence
    middle = amount[sequence - cut] - amount[cut - 1]
    if len(cut):
        best = max(best, int(np.max(-(-(whole + middle) // sequence))))
    for k in range(1, 21):  # sizes rounded down to multiples of 1/k, those on a multiple of 1/(k+1) kept
        scaled = size * (k + 1)
        share = np.where(scaled % sequence == 0, size * k, (scaled // sequence) * sequence)
        best = max(best, -(-int((share * count).sum()) // (k * sequence)))
    return best


def best_fit_decreasing(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and each sequence's room; ``lengths`` come in falling order."""
    with_room: list[list[int]] = [[] for _ in range(sequence + 1)]
    rooms = 0  # bit r is set if a sequence has room r
    where, offset, room = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, length in enumerate(lengths.tolist()):
        fitting = rooms >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            chosen = with_room[left].pop()
            if not with_room[left]:
                rooms ^= 1 << left
        else:
            left, chosen = sequence, len(room)
            room.append(sequence)
        where[i], offset[i] = chosen, sequence - left
        room[chosen] = left - length
        if left > length:
            with_room[left - length].append(chosen)
            rooms |= 1 << (left - length)
    return where, offset, np.array(room, np.int64)


def packed_partition(part: pa.Table, sequence: int, first_id: int) -> pa.Table:
    """Pack one partition; ``stays`` is false for pieces it gives away."""
    falling = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
    part = part.take(pa.compute.sort_indices(part, falling))
    lengths = part["length"].to_numpy()
    where, offset, room = best_fit_decreasing(lengths, sequence)
    stays = room == 0
    if len(room) == least_sequences(lengths, sequence):
        stays = np.ones(len(room), bool)
        stays[np.argmax(room)] = room.max() == 0
    number = first_id + (part["__part"][0].as_py() << 24)
    packed = {"sequence_id": number + where, "offset": offset, "stays": stays[where]}
    return pa.table({**{c: part[c] for c in part.column_names if c != "__part"}, **packed})


def pack(
    docs: DataFrame, sequence: int = SEQUENCE, tokenizer: str = TOKENIZER, partition_pieces: int = PARTITION_PIECES
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Rows with the same doc_id are separate documents. An empty document is one piece of one id.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pool = scratch.store(pieces(docs, sequence, tokenizer))
    columns = pool.columns
    kind = pool.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, stays boolean"

    def packing(pool: DataFrame, turn: int) -> DataFrame:
        parts = max(1, -(-pool.count() // partition_pieces))
        part = F.pmod(F.xxhash64(F.lit(turn), F.monotonically_increasing_id()), F.lit(parts))
        dealt = pool.withColumn("__part", part)
        first_id = turn << 56
        return scratch.store(
            dealt.groupBy("__part").applyInArrow(lambda p: packed_partition(p, sequence, first_id), ddl)
        )

    placed = packing(pool, 0)
    done = []
    for turn in range(1, ROUNDS + 1):
        given = placed.where("not stays")
        before = given.where("offset = 0").count()
        if before < 2:
            break
        again = packing(given.select(columns), turn)
        if again.where("offset = 0").count() >= before:
            break
        done.append(placed.where("stays"))
        placed = again
    for part in done:
        placed = placed.unionByName(part)
    return placed.drop("stays")
