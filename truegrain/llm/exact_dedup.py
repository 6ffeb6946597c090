"""Exact duplicates by deterministic block naming.

Each normalised text is cut into blocks of fixed size. The distinct blocks of the whole corpus are dealt by
hash and sorted in their partitions; partition and place there make a block's integer name. Then adjacent names are
paired, the distinct pairs sorted and named again, and so on: each level halves the length of a
document, until one name is left. Two documents of the same level have the same name exactly when
their texts are the same, since equal names stand for equal blocks or equal pairs at each level.

Only distinct blocks cross the network with their characters. An occurrence finds its block's name by a
64-bit hash of the block, which routes but does not decide: a hash that two different blocks share is
found in the name table, and occurrences of such blocks are matched by their characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.llm.common import SPACES, Scratch, growing, only_rows, text_or_empty, with_row_id

BLOCK_CHARS = 4096
ABSENT = -(1 << 63)  # stands to the right of an odd last name
ROW = "__truegrain_row"


def _blocks(text: Column, block_chars: int) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(found)


def _hashed(block: Column, hash_bits: int) -> Column:
    hashed = F.xxhash64(block)
    return hashed if hash_bits >= 64 else hashed.bitwiseAND((1 << hash_bits) - 1)


def _named(scratch: Scratch, things: DataFrame, *keep: str) -> DataFrame:
    """Distinct rows, sorted within their partitions, with a number no other row has."""
    distinct = things.distinct().sortWithinPartitions(*things.columns)
    return scratch.store(distinct.select(*keep, F.monotonically_increasing_id().alias("name")))


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64) -> DataFrame:
    """One row per document: its row number, doc_id, text_sha256, and (level, name), its identity.

    A null text is an empty one. ``docs`` has to be a stored table, as it is read more than once.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = with_row_id(docs, ROW).select(ROW, "doc_id", text_or_empty().alias("text"))
    cut = rows.select(
        ROW, "doc_id", F.regexp_replace("text", SPACES, " ").alias("text")
    ).select(ROW, "doc_id", "text", _blocks(F.col("text"), block_chars).alias("blocks"))
    digests = scratch.store(
        cut.select(
            ROW,
            "doc_id",
            F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
            F.transform("blocks", lambda b: _hashed(b, hash_bits)).alias("hashes"),
        )
    )
    blocks = cut.select(F.explode("blocks").alias("block")).select(
        _hashed(F.col("block"), hash_bits).alias("hash"), "block"
    )
    names = _named(scratch, blocks, "hash")
    places = digests.select(ROW, F.size("hashes").cast("long").alias("n"), F.posexplode("hashes").alias("pos", "hash"))
    shared = scratch.store(names.groupBy("hash").count().where("count > 1").select("hash"))
    if shared.isEmpty():
        level = places.join(growing(names), "hash").select(ROW, "n", F.col("pos").cast("long").alias("pos"), "name")
    else:
        level = _named_by_characters(scratch, cut, places, names, shared, hash_bits)
    longest = digests.agg(F.max(F.size("hashes"))).first()[0] or 1
    done = [level.where("n = 1").select(ROW, F.lit(0).alias("level"), "name")]
    for depth in range(1, (longest - 1).bit_length() + 1):
        half = F.floor(F.col("pos") / 2).cast("long")
        pairs = scratch.store(
            level.where("n > 1")
            .groupBy(ROW, half.alias("pos"), F.ceil(F.col("n") / 2).cast("long").alias("n"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(ABSENT)).alias("right"),
            )
        )
        names = _named(scratch, pairs.select("left", "right"), "left", "right")
        level = pairs.join(growing(names), ["left", "right"]).select(ROW, "n", "pos", "name")
        done.append(level.where("n = 1").select(ROW, F.lit(depth).alias("level"), "name"))
    ids = done[0]
    for more in done[1:]:
        ids = ids.unionByName(more)
    return scratch.store(digests.select(ROW, "doc_id", "text_sha256").join(growing(ids), ROW))


def _named_by_characters(
    scratch: Scratch, cut: DataFrame, places: DataFrame, names: DataFrame, shared: DataFrame, hash_bits: int
) -> DataFrame:
    """Names of all blocks where some hashes stand for several blocks; names of those are negative."""
    texts = scratch.store(
        cut.select(ROW, F.posexplode("blocks").alias("pos", "block"))
        .withColumn("hash", _hashed(F.col("block"), hash_bits))
        .join(growing(shared), "hash", "left_semi")
    )
    exact = _named(scratch, texts.select("block"), "block").select("block", (-1 - F.col("name")).alias("name"))
    told = texts.join(growing(exact), "block").select(ROW, F.col("pos").cast("long").alias("pos"), "name")
    plain = places.join(growing(shared), "hash", "left_anti").join(growing(names), "hash")
    widths = places.join(growing(shared), "hash", "left_semi").select(ROW, "n", F.col("pos").cast("long").alias("pos"))
    return plain.select(ROW, "n", F.col("pos").cast("long").alias("pos"), "name").unionByName(
        widths.join(growing(told), [ROW, "pos"]).select(ROW, "n", "pos", "name")
    )


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64) -> DataFrame:
    """Per document: row number, doc_id, keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the smallest doc_id stays; a null doc_id comes last, and of rows
    with the same doc_id and text one stays, the same on each run. Other columns are not looked at.
    """
    members = identities(docs, block_chars, hash_bits)
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    first = F.min(F.struct(F.isnull("doc_id").alias("unknown"), "doc_id", F.col(ROW).alias("row")))
    groups = scratch.store(
        members.groupBy("level", "name").agg(first.alias("first"), F.count("*").alias("group_size"))
    )
    return members.join(growing(groups), ["level", "name"]).select(
        ROW,
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names."""
    return only_rows(docs, exact_groups(docs).where("kept"), ROW)
