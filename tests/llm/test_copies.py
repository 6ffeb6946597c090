"""Exact, near and passage duplicates against brute force."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import functions as F

from truegrain.llm import exact_dedup, mixing, simhash, substring_dedup
from truegrain.llm.common import Scratch, cleared_after, lowest, with_row_id

SPACE = re.compile(r"[\x20\x09-\x0d]+")


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def check_exact(rows, found):
    norm = [SPACE.sub(" ", r["text"] or "") for r in rows]
    members = defaultdict(list)
    for r, t in zip(rows, norm):
        members[t].append(r["doc_id"])
    wanted = Counter()
    for r, t in zip(rows, norm):
        least = min(members[t], key=order)
        wanted[(r["doc_id"], least, len(members[t]), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter((f["doc_id"], f["keep_id"], f["group_size"], f["text_sha256"]) for f in found) == wanted
    kept = Counter(f["text_sha256"] for f in found if f["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len(members)
    assert all(f["doc_id"] == f["keep_id"] for f in found if f["kept"])


def test_exact_groups(messy):
    check_exact(messy.collect(), exact_dedup.exact_groups(messy, block_chars=64).collect())


def test_exact_groups_where_hashes_collide(messy):
    """Eight values of the routing hash for all blocks: names then come from characters."""
    check_exact(messy.collect(), exact_dedup.exact_groups(messy, block_chars=700, hash_bits=3).collect())


def test_exact_dedup_keeps_columns(messy, empty):
    kept = exact_dedup.deduplicated(messy)
    assert kept.columns == messy.columns
    assert kept.count() == len({SPACE.sub(" ", r["text"] or "") for r in messy.collect()})
    assert exact_dedup.exact_groups(empty).count() == 0


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = words_of(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, link):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = list(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= link:
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def check_near(rows, found, link=2):
    prints = [slow_fingerprint(r["text"]) for r in rows]
    root = roots(set(prints), link)
    least = {}
    for r, p in zip(rows, prints):
        least[root[p]] = min(least.get(root[p], None) or order(r["doc_id"]), order(r["doc_id"]))
    ids = {k: None if unknown else i for k, (unknown, i) in least.items()}
    wanted = Counter((r["doc_id"], f"{p:016x}", ids[root[p]]) for r, p in zip(rows, prints))
    assert Counter((f["doc_id"], f["fingerprint"], f["component_id"]) for f in found) == wanted
    assert sum(f["stays"] for f in found) == len(least)


def test_near_groups(messy, empty):
    rows = [r for r in messy.collect() if r["doc_id"] not in (230, 231)]
    few = messy.where("doc_id is null or doc_id not in (230, 231)")
    check_near(rows, simhash.near_groups(few).collect())
    assert simhash.deduplicated(messy).columns == messy.columns
    assert simhash.near_groups(empty).count() == 0


def test_fingerprints_of_long_texts():
    text = " ".join(map(str, range(3000)))
    assert simhash.fingerprint(text) == slow_fingerprint(text).to_bytes(8, "big")
    simhash_step, simhash.HASHES_AT_ONCE = simhash.HASHES_AT_ONCE, 100
    try:
        assert simhash.fingerprint(text) == slow_fingerprint(text).to_bytes(8, "big")
    finally:
        simhash.HASHES_AT_ONCE = simhash_step


def test_tree_loses_no_pair(spark):
    """Clusters, chains and a dense ball of prints, small shards, blocks inside shards: groups equal brute force."""
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for start in list(prints)[:40]:
        for _ in range(12):
            start ^= 1 << rng.randrange(64)
            start ^= 1 << rng.randrange(64)
            prints.add(start)
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    points = Scratch(spark, "t").store(spark.createDataFrame(signed, "print long"))
    wanted = Counter(Counter(roots(prints, 2).values()).values())
    for settings in ({"shard_points": 16, "shard_limit": 30}, {"shard_points": 10_000}, {"shard_limit": 200}):
        scratch = Scratch(spark, "t")
        pairs = scratch.store(simhash.links(scratch, points, 2, **settings))
        root = {r["node"]: r["root"] for r in simhash.components(scratch, pairs).collect()}
        assert Counter(Counter(root.get(p, p) for (p,) in signed).values()) == wanted
        if "shard_limit" not in settings:
            assert pairs.count() < 2 * len(prints)  # links to local roots, never all pairs


def test_local_links_of_a_dense_ball():
    points = np.unique(np.array([(1 << a) | (1 << b) for a in range(64) for b in range(64)], np.uint64))
    old, simhash.LEAF_POINTS = simhash.LEAF_POINTS, 64
    try:
        a, b = zip(*simhash.local_links(points, 2))
    finally:
        simhash.LEAF_POINTS = old
    root = simhash.least_roots(points, np.concatenate(a), np.concatenate(b))
    assert (root == 0).all()


def slow_repeats(rows, window):
    first = {}
    texts = [words_of(r["text"]) for r in rows]
    for r, words in zip(rows, texts):
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, order(r["doc_id"])), order(r["doc_id"]))
    for r, words in zip(rows, texts):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < order(r["doc_id"]):
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        yield r["doc_id"], len(words), sum(gone), kept, hashlib.sha256(kept.encode()).hexdigest()


def test_repeated_passages(messy, empty):
    wanted = Counter(slow_repeats(messy.collect(), 13))
    assert sum(w[2] > 0 for w in wanted.elements()) > 80
    for settings in ({}, {"depth": 3, "block_bytes": 2000, "range_windows": 500, "cells_per_window": 1}, {"depth": 1}):
        found = substring_dedup.remove_repeats(messy, **settings).collect()
        assert Counter(map(tuple, found)) == wanted
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_sketch_counts_are_never_too_low(messy):
    """Cells of all blocks added up: a window's least cell is at least its count, and most single windows have a cell of their own."""
    texts = [" ".join(words_of(r["text"])).encode() for r in messy.collect()]
    table = lambda some: pa.table({"doc_id": pa.array(range(len(some)), pa.int64()), "text": pa.array(some, pa.large_binary())})

    def body(some):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table(some).schema) as writer:
            writer.write_table(table(some))
        return zstandard.compress(out.getvalue().to_pybytes())

    held = [substring_dedup.Block(body(texts[i::3]), 13) for i in range(3)]
    bits = (4 * sum(len(b.at) for b in held) - 1).bit_length()
    sums, exact = Counter(), Counter()
    for b in held:
        rows = substring_dedup._sketch_rows(b, 2, bits, bits)
        for part, cells, counts in zip(rows["part"], rows["cells"], rows["often"]):
            places = np.cumsum(substring_dedup._values(cells, "u8"), dtype=np.uint64) + np.uint64(part << bits)
            sums.update(dict(zip(places.tolist(), substring_dedup._values(counts, "u4").tolist())))
        exact.update(map(bytes, b.keys(b.at)))
    kept = Counter()
    for b in held:
        for key, own in zip(map(bytes, b.keys(b.at)), b.cells(2, bits).T.tolist()):
            estimate = min(sums[c] for c in own)
            assert estimate >= exact[key]
            kept[estimate > 1] += exact[key] == 1
    assert 0 < kept[True] < 0.1 * kept[False]


def test_short_texts_have_no_windows(messy):
    few = messy.where("doc_id in (240, 241, 242, 300)")
    found = substring_dedup.remove_repeats(few).collect()
    assert sum(f["n_removed"] for f in found) == 0 and len(found) == few.count()


def test_steps_are_stored_and_cleared(spark):
    scratch = Scratch(spark, "t")
    rows = scratch.store(spark.range(5))
    assert rows.count() == 5 and os.path.exists(scratch.path)
    scratch.clear()
    assert not os.path.exists(scratch.path)


def test_rows_are_named_by_file_and_place(spark, tmp_path):
    """Another split of the same files gives the same names; no two rows share one."""
    path = str(tmp_path / "t.parquet")
    spark.range(20_000).selectExpr("id", "repeat(uuid(), 3) AS x").repartition(3).write.option("parquet.block.size", 65536).parquet(path)
    named = [with_row_id(spark.read.parquet(path), "n").collect()]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        table = with_row_id(spark.read.parquet(path), "n")
        assert table.rdd.getNumPartitions() > 3
        named.append(table.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    names = [{r["n"]: r["id"] for r in rows} for rows in named]
    assert names[0] == names[1] and len(names[0]) == 20_000


def test_lowest_is_a_bounded_sample(spark):
    rows = spark.range(5000)
    found = lowest(rows, ["id"], 300, 5000).collect()
    assert len(found) == 300 and found == lowest(rows.repartition(7), ["id"], 300, 5000).collect()
    assert lowest(rows, ["id"], 9000, 5000).count() == 5000


def test_names_that_operators_use_inside_are_free(spark, messy, tmp_path):
    """Whatever a user's columns are called, they come back with their values."""
    odd = ["__truegrain_row", "__TRUEGRAIN_COPY", "__times", "__truegrain_mark", "print"]
    path = str(tmp_path / "odd.parquet")
    messy.where("doc_id < 230").select("doc_id", "text", "source", *(F.lit(f"own {i}").alias(c) for i, c in enumerate(odd))).write.parquet(path)
    docs = spark.read.parquet(path)
    for operator in (exact_dedup.deduplicated, simhash.deduplicated, mixing.mixed_documents):
        kept = operator(docs)
        assert kept.columns == docs.columns
        assert [tuple(r) for r in kept.select(odd).distinct().collect()] == [tuple(f"own {i}" for i in range(len(odd)))]


def test_folders_made_inside_are_cleared(spark):
    outer = Scratch(spark, "t")
    with cleared_after():
        inner = Scratch(spark, "t")
        rows = outer.store(inner.store(spark.range(5)))
    assert rows.count() == 5 and not os.path.exists(inner.path)
