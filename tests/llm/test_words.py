"""Divergence of sources, spelling variants and test passages against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.llm.conftest import DOCS, prose, write
from tests.llm.test_copies import order
from truegrain.llm import decontaminate, divergence, spelling
from truegrain.llm.common import Scratch

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LATIN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def slow_audit(rows, least_docs=10):
    docs = [(r["lang"] or "", r["source"] or "", LETTERS.findall(lower(r["text"]))) for r in rows]
    having, used, groups = Counter(), defaultdict(Counter), {(a, b) for a, b, _ in docs}
    for lang, source, found in docs:
        having.update((lang, t) for t in set(found))
        used[lang, source].update(found)
    for lang, source in groups:
        kept = [t for (g, t), n in having.items() if g == lang and n >= least_docs]
        counts = {s: {t: used[lang, s][t] for t in kept} for g, s in groups if g == lang}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        own, q = p(counts[source]), p(whole)
        pairs = [(sum(f(own[t], x) for t, x in p(c).items()), s) for s, c in counts.items() if s != source]
        over = [(f(own[t], q[t]), t) for t in kept if counts[source][t] and own[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", over, 10)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            yield from ((lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked))


@pytest.mark.parametrize("least_docs", [1, 3, 10])
def test_audit(messy, least_docs):
    found = divergence.audit(messy, least_docs)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == Counter(slow_audit(messy.collect(), least_docs))


def test_audit_of_little(spark, messy, empty, monkeypatch):
    assert divergence.audit(empty).count() == 0
    blank = messy.where("text is null or text = ''")  # groups without terms, languages that keep none
    assert Counter(map(tuple, divergence.audit(blank).collect())) == Counter(slow_audit(blank.collect()))
    monkeypatch.setattr(divergence, "HELD_PAIRS", 0)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert Counter(map(tuple, divergence.audit(messy, 2).collect())) == Counter(slow_audit(messy.collect(), 2))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def slow_words(rows):
    counts = Counter()
    for r in rows:
        for run in LATIN.findall(r["text"] or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def slow_variants(rows):
    words = slow_words(rows)
    form, near = {}, {}
    for w in words:
        near[w] = [x for x in words if one_edit(w, x)]
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None


def wordy_rows():
    """Common words with variants one and two edits away, chains of forms, ties, letters up to U+00FF, long runs."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé×ÿ") for _ in range(rng.randint(6, 14))) for _ in range(60)]
    base += ["aaaaaaa", "aaaaaaaa", "abababab", "babababa", "ababababab", "z" * 400, "z" * 399 + "y"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.choice([5, 60])):
            w = rng.choice(base[: rng.choice([5, 60, 67])])
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", rng.choice("abcé"), w[at] + rng.choice("abz")]) + w[at + 1 :]
            words.append(rng.choice([w, w.upper() if w.isascii() else w]))
        rows.append((i, rng.choice([" ", "-", "ß文", "\x85", "1"]).join(words), "en", "s"))
    rows += [(None, " ".join(base), "en", "s"), (None, None, None, None), (500, "", "", ""), (501, "chainedword " * 3000, "en", "s")]
    rows += [(502, "chainedwore " * 250 + "chainedwoqe " * 20 + "chaimedwoqe " * 2, "en", "s")] * 2
    return [(*r, 0, "h", "sz", "rk", "tm", "kp") for r in rows]


@pytest.fixture(scope="module")
def wordy(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("wordy"), "documents", wordy_rows(), DOCS)


@pytest.mark.parametrize("settings", [{}, {"dictionary": 50}, {"dictionary": 8, "list_words": 5}])
def test_variants(wordy, settings, monkeypatch):
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", 1 if settings else 16)
    found = spelling.variants(wordy, **settings)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = Counter(slow_variants(wordy.collect()))
    assert Counter(map(tuple, found.collect())) == wanted
    assert any(form and root != form for _, form, root, *_ in wanted)


def test_variants_in_blocks(spark, wordy, monkeypatch):
    """A threshold under the length of lists: long lists are cut into blocks that meet pair by pair."""
    scratch = Scratch(spark, "t")
    words = scratch.store(spelling.word_counts(wordy))
    monkeypatch.setattr(spelling, "LONG_LISTS", 1 << 40)
    asked = []
    plain = spelling.long_lists
    monkeypatch.setattr(spelling, "long_lists", lambda *a: asked.append(plain(*a)) or asked[-1])
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", 1)
    pairs = {(r["word"], r["near"]) for r in spelling.near_words(scratch, words, list_words=3).collect()}
    assert max(asked[0].values()) > 4
    every = list(slow_words(wordy.collect()))
    assert pairs == {(a, b) for a in every for b in every if one_edit(a, b)}


def test_variants_of_little(messy, empty):
    assert spelling.variants(empty).count() == 0
    assert Counter(map(tuple, spelling.variants(messy).collect())) == Counter(slow_variants(messy.collect()))
    with pytest.raises(ValueError):
        spelling.variants(messy, least_chars=6)


def test_words_compared_as_numbers():
    """The packed comparison and the one by bytes agree with plain Python on words of all lengths."""
    rng = random.Random(6)
    for _ in range(40):
        width = rng.randint(7, 24)
        longer = ["".join(rng.choice("abÿ") for _ in range(width)) for _ in range(60)]
        other = []
        for w in longer:
            at, kind = rng.randrange(width), rng.randrange(3)
            x = w[:at] + ("" if kind else rng.choice("abc")) + w[at + 1 :]
            other.append(x if kind < 2 else rng.choice([x[:-1] + "b", "a" + x[1:], x[::-1]]))
        short = np.array([len(x) < width for x in other])
        room = max(16, width)
        rows = lambda words: np.frombuffer(b"".join(w.encode("latin-1").ljust(room, b"\0") for w in words), np.uint8).reshape(-1, room)
        wanted = [one_edit(a, b) for a, b in zip(longer, other)]
        assert spelling.one_edit(rows(longer), rows(other), short).tolist() == wanted
        if width <= 16:
            assert spelling.one_edit_packed(rows(longer).view(np.uint64), rows(other).view(np.uint64), short).tolist() == wanted


def test_grams_that_an_edit_leaves():
    """Every word keeps a merged list in common with each of its variants, whatever is frequent."""
    rng = random.Random(9)
    for _ in range(3000):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(8, 14)))
        at = rng.randrange(len(word))
        other = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abc") + word[at + 1 :]])
        frequent = {"".join(rng.choice("^ab$") for _ in range(rng.randint(2, 4))): rng.randint(1, 9) for _ in range(rng.randint(0, 60))}
        lists = lambda w: {(g, a, 0) for a, g in spelling.merged_lists(w, frequent)} | {(g, len(w) + 2 - a, 1) for a, g in spelling.merged_lists(w, frequent)}
        assert lists(word) & lists(other)


ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.StringType())])


def slow_contamination(rows, items, window=10):
    windows = defaultdict(set)
    for r in items:
        found = ALNUM.findall(lower(r["text"]))
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if found else 0):
            windows[tuple(found[i : i + size])].add("" if r["item_id"] is None else str(r["item_id"]))
    for r in rows:
        found, hit, of = ALNUM.findall(lower(r["text"])), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                if tuple(found[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    of |= windows[tuple(found[i : i + size])]
        yield r["doc_id"], len(found), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def tests_and_docs(spark, tmp_path_factory):
    """Items with shared stretches, repeats inside, short ones, one inside another, copies, nulls; documents that quote them."""
    rng = random.Random(4)
    texts = [prose(rng, rng.randint(12, 40)) for _ in range(20)]
    texts += [texts[0], texts[1] + " " + texts[2], "a b " * 12, "river", "Stone, cloud!", " ".join(texts[3].split()[:12]), "", "12 文字 Été 7", None]
    items = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, texts[4], "x"), (3, prose(rng, 15), "x")]
    rows = []
    for i in range(150):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            words = rng.choice(items)[1] or ""
            words = words.split()
            at = rng.randrange(max(1, len(words)))
            parts += [" ".join(words[at : at + rng.randint(1, 40)]).upper(), prose(rng, rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", ".\n", "--"]).join(parts).replace(" ", rng.choice([" ", ", ", "\u0007"])), "en", "s"))
    rows += [(200, "a b " * 30_000, "en", "s"), (201, None, None, None), (None, texts[5], "en", "s"), (202, "", "", "")]
    rows += [(203, "12 文字 ÉtÉ 7, 12 文字 Été 7", "fr", "s")] * 2
    folder = tmp_path_factory.mktemp("leaks")
    docs = write(spark, folder, "documents", [(*r, 0, "h", "sz", "rk", "tm", "kp") for r in rows], DOCS)
    return docs, write(spark, folder, "benchmark", items, ITEMS)


@pytest.mark.parametrize("settings", [{}, {"window": 3}, {"shard_words": 100}, {"shard_words": 60, "piece_words": 5, "window": 4}])
def test_contamination(tests_and_docs, settings):
    docs, items = tests_and_docs
    found = decontaminate.report(decontaminate.contamination(docs, items, **settings)).collect()
    wanted = list(slow_contamination(docs.collect(), items.collect(), settings.get("window", 10)))
    assert Counter(map(tuple, found)) == Counter(wanted)
    assert 20 < sum(w[-1] for w in wanted)


def test_contamination_of_little(spark, tests_and_docs, empty):
    docs, items = tests_and_docs
    none = spark.createDataFrame([], ITEMS)
    assert {r["n_hit"] for r in decontaminate.report(decontaminate.contamination(docs, none)).collect()} == {0}
    assert decontaminate.contamination(empty, items).count() == 0
    longest = {r["doc_id"]: r["longest"] for r in decontaminate.contamination(docs, items).collect()}
    assert longest[201] == 0 and longest[200] == 24 and longest[203] == 4


@pytest.mark.parametrize("shard_words", [decontaminate.SHARD_WORDS, 100])
def test_spans_are_removed(tests_and_docs, shard_words):
    docs, items = tests_and_docs
    texts = {order(r["doc_id"]): r["text"] for r in docs.collect()}
    about = {order(w[0]): w for w in slow_contamination(docs.collect(), items.collect())}
    kept = decontaminate.decontaminated(docs, items, shard_words=shard_words)
    assert kept.columns == docs.columns
    left = {order(r["doc_id"]): r["text"] for r in kept.collect()}
    assert set(left) == {k for k, w in about.items() if w[2] <= 0.5 * w[1]}
    for k, text in left.items():
        assert len(ALNUM.findall(lower(text))) == about[k][1] - about[k][2]
        assert about[k][2] or text == texts[k]
    assert decontaminate.without("One, two; three four!", [(1, 3)]) == "One, four!"
    longer = decontaminate.decontaminated(docs, items, longest=15, coverage=1.0, shard_words=shard_words)
    assert longer.count() == docs.count()
