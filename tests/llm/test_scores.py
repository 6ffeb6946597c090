"""Quality and language scores: held-out accuracy, repeatability, odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.llm.conftest import DOCS, NOUNS, prose, write
from truegrain.llm import language_id, quality

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("text", T.StringType())])


def labelled(n):
    """Good prose, and three kinds of junk; documents of both kinds in every hash class."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(20, 60))
        if not good:
            text = rng.choice([lambda t: t.upper() + "!!", lambda t: t.replace(" ", "### "), lambda t: f"{NOUNS[i % 9]} " * 40])(text)
        rows.append((i, text, "en", f"s{i % 3}", len(text), *["x"] * 5))
        labels.append((i, int(good), "clash"))
    return rows, labels


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("labelled")
    rows, labels = labelled(600)
    odd = [(1000, None), (1001, ""), (1002, " \n"), (1003, "9" * 300_000), (None, "river stone"), (5, "repeated id")]
    rows += [(i, t, None, None, None, *["x"] * 5) for i, t in odd]
    labels += [(7, None, None), (None, 1, None), (5, 1, None), (9999, 0, None)]
    return write(spark, folder, "documents", rows, DOCS), write(spark, folder, "labels", labels, LABELS)


def test_quality_on_documents_held_out(spark, corpus):
    docs, labels = corpus
    found = quality.scored(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    truth = dict(labelled(600)[1][i][:2] for i in range(600))
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 100 and np.mean([p == t for p, t in held]) > 0.95
    again = {r["doc_id"]: r["score"] for r in quality.scored(docs, labels).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in rows if r["doc_id"] not in (5, None))
    kept = quality.kept(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_quality_without_labels(spark, corpus, empty):
    docs, labels = corpus
    none = labels.where("quality > 7")
    assert {r["score"] for r in quality.scored(docs.limit(20), none).collect()} == {0.5}
    assert quality.scored(empty, labels).count() == 0


def test_kept_without_a_network(spark, corpus):
    """No labels, few labels, labels of one kind: scores are one constant, and no document is dropped by it."""
    docs, labels = corpus
    for some in (labels.where("quality > 7"), labels.where("doc_id < 5"), labels.where("quality = 0")):
        kept = quality.kept(docs, some)
        assert kept.columns == docs.columns and kept.count() == docs.count()


def test_tokens_and_context_vectors(spark, corpus):
    """Context sums equal a plain count of neighbours; tokens end at a change of kind and at documents' ends."""
    texts = ["Ab,c 12x", "", "ab Ab", "q"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    slot, form, doc = quality.tokens(data, starts)
    assert doc.tolist() == [0, 0, 0, 0, 0, 2, 2, 3]
    assert slot[0] == slot[5] == slot[6] and form[0] == form[6] != form[5]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    table = quality.context_vectors(docs)
    place, sign = quality.index_vectors()
    slow = defaultdict(lambda: np.zeros(quality.WIDTH))

    def add(owner, what):
        for k in range(quality.ONES):
            slow[owner][place[what, k]] += sign[what, k]

    for i in range(len(slot)):
        add(slot[i], quality.SLOTS + form[i])
        for j in (i - 1, i + 1):
            if 0 <= j < len(slot) and doc[i] == doc[j]:
                for owner in (slot[i], quality.SLOTS + form[i]):
                    add(owner, slot[j])
                    add(owner, quality.SLOTS + form[j])
    for owner, vector in slow.items():
        assert np.allclose(table[owner], vector / max(np.linalg.norm(vector), 1e-9), atol=1e-5)
    pooled = quality.pooled(table, data, starts)
    assert np.allclose(pooled[0, : quality.WIDTH], table[slot[:5]].mean(0), atol=1e-5)
    assert not pooled[1].any()


TOKENS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z\x80-\xff0-9\x20\x09-\x0D]+")


def slow_tokens(text):
    """Slot and form of each token, hashed character by character."""
    ended = None
    for found in TOKENS.finditer((text or "").encode()):
        run, total, power = found.group(), 0, 1
        for byte in run:
            total = (total + ((byte + 32 if 65 <= byte <= 90 else byte) + 1) * power) % 2**64
            power = power * int(quality.PRIME) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            total = (total ^ total >> shift) * factor % 2**64
        upper = sum(65 <= byte <= 90 for byte in run)
        kind = 1 if run[:1].isdigit() else 0 if run[:1].isalpha() or run[0] >= 128 else 2
        case = 0 if not upper else 2 if upper == len(run) else 1 if upper == 1 and run[:1].isupper() else 3
        form = (kind * 4 + case) * 16 + min(len(run), 8) - 1 + 8 * (found.start() == ended)
        ended = found.end()
        yield ((total ^ total >> 31) >> 20) % quality.SLOTS, form


def slow_scores(docs, labels):
    """Each row's score from its text, by loops over tokens and their neighbours; only ``Network.fit`` is shared."""
    found = [list(slow_tokens(r["text"])) for r in docs]
    place, sign = quality.index_vectors()
    vectors = defaultdict(lambda: np.zeros(quality.WIDTH))
    for tokens in found:
        for i, (slot, form) in enumerate(tokens):
            met = [(slot, quality.SLOTS + form)]
            for j in (i - 1, i + 1):
                if 0 <= j < len(tokens):
                    met += [(a, b) for a in (slot, quality.SLOTS + form) for b in (tokens[j][0], quality.SLOTS + tokens[j][1])]
            for owner, neighbour in met:
                for k in range(quality.ONES):
                    vectors[owner][place[neighbour, k]] += sign[neighbour, k]
    unit = {k: v / max(math.sqrt(v @ v), 1e-9) for k, v in vectors.items()}
    x = np.zeros((len(found), 2 * quality.WIDTH + 2))
    for row, tokens in zip(x, found):
        for i, (slot, form) in enumerate(tokens):
            row[: quality.WIDTH] += unit[slot] / len(tokens)
            row[quality.WIDTH : -2] += unit.get(quality.SLOTS + form, 0) / len(tokens)
            row[-2] += (i > 0 and tokens[i - 1][0] == slot) / len(tokens)
        row[-1] = math.log1p(len(tokens))
    marks = defaultdict(list)
    for r in labels:
        if r["doc_id"] is not None and r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            marks[r["doc_id"]].append(r["quality"])
    known = sorted({r["doc_id"] for r in docs} & set(marks))
    first = [min(tuple(row) for r, row in zip(docs, x) if r["doc_id"] == i) for i in known]
    network = quality.Network().fit(np.array(first), np.array([float(min(marks[i])) for i in known]))
    mean, scale, w1, b1, w2, b2 = network.weights
    columns = w1.T.tolist()
    for row in ((x - mean) / scale).tolist():
        hidden = [math.tanh(sum(a * b for a, b in zip(row, column)) + shift) for column, shift in zip(columns, b1)]
        logit = sum(a * b for a, b in zip(hidden, w2)) + b2[0]
        yield 1 / (1 + math.exp(-max(-30, min(30, logit / network.temperature))))


def test_quality_against_plain_loops(corpus):
    """From texts to scores: tokens, context sums, pooling, choice of labels and the network, all done row by row."""
    docs, labels = corpus
    rows = docs.collect()
    wanted = sorted(zip(map(str, (r["doc_id"] for r in rows)), slow_scores(rows, labels.collect())))
    found = sorted((str(r["doc_id"]), r["score"]) for r in quality.scored(docs, labels).collect())
    assert [i for i, _ in found] == [i for i, _ in wanted]
    assert max(abs(a - b) for (_, a), (_, b) in zip(found, wanted)) < 1e-3


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 8))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.Network().fit(x, y)
    test = rng.normal(size=(3000, 8))
    truth = 1 / (1 + np.exp(-2 * test[:, 0]))
    assert abs(net.score(test).mean() - truth.mean()) < 0.05
    assert np.abs(net.score(test) - truth).mean() < 0.1


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("lang", T.StringType())])
SPOKEN = {
    "en": "the river and the garden with windows that they think about when there is nothing else".split(),
    "de": "der Fluss und die Gärten mit Fenstern über welche sie nachdenken wenn sonst nichts geschieht".split(),
    "es": "el río y los jardines con ventanas sobre las cuales ellos piensan cuando no hay nada más".split(),
}


@pytest.fixture(scope="module")
def web(spark, tmp_path_factory):
    folder, rng = tmp_path_factory.mktemp("web"), random.Random(2)
    say = lambda lang, n: " ".join(rng.choice(SPOKEN[lang]) for _ in range(n))
    docs = [(i, say(lang, 80), lang, "s", 1, *["x"] * 5) for i, lang in enumerate(list(SPOKEN) * 20)]
    pages, truth = [], {}
    for i in range(120):
        lang = list(SPOKEN)[i % 3]
        host = {"en": "www.big.example.com", "de": f"h{i % 4}.example.de", "es": "news.example.es"}[lang]
        text = say(lang, 3 if i % 10 == 0 else 60)
        markup = "" if i % 4 == 0 else f' lang="{lang}-XX"'
        pages.append((i, f"https://{host}/p/{i}?q=1", f"<html{markup}><script>{say('en', 30)}</script><p>{text}</p></html>", "zz"))
        truth[i] = lang
    pages += [(500, "https://h1.example.de/", None, None), (501, None, None, None), (502, "no address", "", None), (503, "http://a/", "<" * 1000, None)]
    pages += [(504, None, "x" * 200_000, None), (None, None, "<p>der Fluss", None), (1, "https://www.big.example.com/", "<html lang=en>", None)]
    return write(spark, folder, "pages", pages, PAGES), write(spark, folder, "documents", docs, DOCS), truth


def slow_identify(pages, names, table):
    """The same fusion with dictionaries."""
    told = []
    for p in pages:
        url, html = p["url"] or "", p["html"] or ""
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url)
        host = (m[1] if m else "").lower().rstrip(".")
        declared = re.search(r"(?i)<html\b[^>]{0,1000}?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", html)
        slots = language_id.triples(np.frombuffer(language_id.visible(html.encode()), np.uint8))
        logs = language_id.TEXT_WEIGHT * table[:, slots].sum(1)
        logs = np.maximum(logs - logs.max(), -language_id.TEXT_MOST)
        parts = {"host": host, "domain": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1] if "." in host else ""}
        told.append((p["page_id"], np.exp(logs) / np.exp(logs).sum(), {**parts, "declared": declared[1].lower() if declared else ""}))
    norm = lambda v: v / v.sum()
    sums = defaultdict(lambda: np.zeros(len(names)))
    for _, own, keys in told:
        sums["all", ""] += own
        for k in keys.items():
            sums[k] += own
    for page_id, own, keys in told:
        prior = first = norm(np.maximum(sums["all", ""] - own, 0) + 1)
        for level in language_id.LEVELS:
            prior = norm(np.maximum(sums[level, keys[level]] - own, 0) + language_id.STRENGTH * prior)
        share = norm(np.maximum(sums["declared", keys["declared"]] - own, 0) + language_id.STRENGTH * first)
        post = norm(own * prior * share / first)
        yield page_id, names[int(post.argmax())], float(post.max())


def test_language_fusion(web):
    pages, docs, truth = web
    found = language_id.identify(pages, docs).collect()
    names, table = language_id.letter_models(docs)
    assert names == sorted(SPOKEN)
    wanted = sorted(slow_identify(pages.collect(), names, table), key=str)
    got = sorted(((f["page_id"], f["lang"], f["confidence"]) for f in found), key=str)
    assert [g[0] for g in got] == [w[0] for w in wanted]
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(wanted, key=lambda r: (str(r[0]), r[2]))):
        assert math.isclose(g[2], w[2], rel_tol=1e-6) and g[1] == w[1]
    by_id = {f["page_id"]: f["lang"] for f in found}
    assert np.mean([by_id[i] == lang for i, lang in truth.items() if i != 1]) > 0.98
    assert by_id[500] == "de"  # by its host alone


def test_language_result_can_be_filtered(web):
    """A filter on the result takes no longer than the result: the plan grows by a term, not by a power."""
    pages, docs, _ = web
    found = language_id.identify(pages, docs)
    rows = found.collect()
    sure, german = found.where("confidence > 0.9 and lang = 'de'"), found.where("lang = 'de'").groupBy("host").avg("confidence")
    assert sure.count() == sum(r["confidence"] > 0.9 and r["lang"] == "de" for r in rows) > 30
    assert german.count() == len({r["host"] for r in rows if r["lang"] == "de"})
    assert len(sure._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_language_declared_after_long_attributes(spark, web, tmp_path):
    _, docs, _ = web
    tags = ["<html data-x='" + "y" * 5000 + "' lang=de>", "<HTML\nLANG = 'es-ES'>", "<html><p lang=de>", "<html>" + "<html lang=en>"]
    pages = write(spark, tmp_path, "pages", [(i, None, t, None) for i, t in enumerate(tags)], PAGES)
    found = {f["page_id"]: f["declared"] for f in language_id.identify(pages, docs).collect()}
    assert found == {0: "de", 1: "es", 2: "", 3: "en"}


def test_language_without_models(spark, web, empty):
    pages, docs, _ = web
    assert {f["lang"] for f in language_id.identify(pages, docs.where("lang = 'none'")).collect()} == {None}
    assert language_id.identify(pages.where("page_id = -1"), docs).count() == 0
