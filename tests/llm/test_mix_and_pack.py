"""Packing and mixing: round trips, bounds, balance."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from truegrain.llm import mixing, packing


@pytest.fixture(scope="module")
def ids_of():
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: full.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_tokenizers(ids_of):
    encode = packing.encoder()
    odd = ["", " ", " a  b", "a\x85b\x1cc", "don't  stop\n\n\n now", "<|endoftext|>x<|", "naïve Ünïcode ¼²", "文字 🙂", " " * 3000, "9" * 400]
    rng = random.Random(1)
    odd += ["".join(rng.choice(" \t\nabcXYZ019'.,!-éñßÿ Āɏ") for _ in range(300)) for _ in range(200)]
    for text in odd:
        assert encode(text) == ids_of(text), text


def test_cuts():
    assert list(packing.cuts(1, 8)) == [(0, 1)]
    assert list(packing.cuts(8, 8)) == [(0, 8)]
    assert list(packing.cuts(19, 8)) == [(0, 3), (3, 8), (11, 8)]


def check_packing(rows, ids_of, found, sequence):
    wanted = Counter()
    for r in rows:
        ids = np.array([*ids_of(r["text"]), 0], "<u4")
        for k, (start, length) in enumerate(packing.cuts(len(ids), sequence)):
            wanted[(r["doc_id"], k, start, length, zlib.crc32(ids[start : start + length]))] += 1
    assert Counter(tuple(f)[:5] for f in found) == wanted
    held = defaultdict(list)
    for f in found:
        held[f["sequence_id"]].append((f["offset"], f["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= sequence
    return len(held)


def test_packing(messy, empty, ids_of):
    rows = messy.collect()
    total = sum(len(ids_of(r["text"])) + 1 for r in rows)
    for settings in ({}, {"partition_pieces": 20}):
        used = check_packing(rows, ids_of, packing.pack(messy, **settings).collect(), 2048)
        least = -(-total // 2048)
        assert used <= least + (4 if settings else 0), (used, least, settings)
    assert packing.pack(empty).count() == 0


def test_lower_bounds_and_best_fit():
    """Bounds never exceed what an exhaustive search needs, and packing never needs less."""
    rng = random.Random(5)

    def fewest(lengths, room):
        best = [len(lengths)]

        def place(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(lengths):
                best[0] = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] + lengths[i] <= room:
                    place(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1 :])
            place(i + 1, bins + [lengths[i]])

        place(0, [])
        return best[0]

    for _ in range(60):
        room = rng.choice([7, 10, 16])
        lengths = sorted((rng.randint(1, room) for _ in range(8)), reverse=True)
        where, offset, left = packing.best_fit_decreasing(np.array(lengths), room)
        bound, need = packing.least_sequences(np.array(lengths), room), fewest(lengths, room)
        assert bound <= need <= len(left)
        load = np.bincount(where, lengths)
        assert (load + left == room).all()
    assert packing.least_sequences(np.array([6] * 9), 10) == 9  # by size alone it would be 6


def test_targets_and_takes(messy, empty):
    found = mixing.mix(messy).collect()
    rows = messy.collect()
    size = {id(r): len([w for w in (r["text"] or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]) for r in rows}
    assert Counter((f["doc_id"], f["size"]) for f in found) == Counter((r["doc_id"], size[id(r)]) for r in rows)
    sums = defaultdict(int)
    for r in rows:
        sums[r["source"]] += size[id(r)]
    names = sorted((s for s in sums if s is not None)) + ([None] if None in sums else [])
    weight = dict(zip(names, itertools.cycle((5, 2, 1))))
    target, left = {}, float(sum(sums.values()))
    while True:
        open_ = [s for s in names if s not in target]
        share = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * share > 3 * sums[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sums[s]
            left -= target[s]
    target |= {s: weight[s] * share for s in names if s not in target}
    taken = defaultdict(int)
    for f in found:
        assert f["source_size"] == sums[f["source"]]
        assert f["target"] == pytest.approx(target[f["source"]])
        assert f["taken"] == f["times"] * f["size"] and f["times"] <= 3
        taken[f["source"]] += f["taken"]
    largest = {s: max(f["size"] for f in found if f["source"] == s) for s in names}
    for s in names:
        assert abs(taken[s] - target[s]) <= max(5, largest[s] / 2 + 1), s
    again = mixing.mix(messy).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert mixing.mix(empty).count() == 0


def test_the_mix_does_not_depend_on_the_order_of_rows(messy, tmp_path):
    messy.repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    moved = messy.sparkSession.read.parquet(str(tmp_path / "documents.parquet"))
    taken = [Counter((f["doc_id"], f["size"], f["taken"]) for f in mixing.mix(d, chunk_docs=8).collect()) for d in (messy, moved)]
    assert taken[0] == taken[1]


def test_small_chunks_keep_the_totals(messy):
    found = mixing.mix(messy.where("source = 'hot' or doc_id < 60"), chunk_docs=8).collect()
    for source in {f["source"] for f in found}:
        mine = [f for f in found if f["source"] == source]
        assert abs(sum(f["taken"] for f in mine) - mine[0]["target"]) <= max(f["size"] for f in mine)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    for size in (rng.integers(1, 500, 300).astype(float), np.full(50, 7.0), np.array([9.0, 4, 4, 4])):
        p = np.full(len(size), 0.37)
        out = mixing.move(p, size, rng)
        assert abs(out.sum() - p.sum()) < 1e-6 and abs(out @ size - p @ size) < 1e-3
        assert ((out > 0) & (out < 1)).sum() <= 2
        landed = mixing.land(out, size, p)
        assert set(np.unique(landed)) <= {0.0, 1.0}


def test_inclusion_is_fair():
    """Over many draws every document is taken about as often as its probability says."""
    size = np.array([50.0, 31, 30, 22, 17, 9, 8, 5, 4, 2])
    taken = sum(mixing.move(np.full(10, 0.3), size, np.random.default_rng(k)) for k in range(3000)) / 3000
    assert np.abs(taken - 0.3).max() < 0.04


def test_mixed_documents(messy):
    times = Counter()
    for f in mixing.mix(messy).collect():
        times[f["doc_id"]] += f["times"]
    rows = mixing.mixed_documents(messy)
    assert rows.columns == messy.columns
    assert Counter(r["doc_id"] for r in rows.collect()) == +times
