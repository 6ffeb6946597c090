"""Top-k search, personal data and role repair against brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.conftest import DOCS, NOUNS, prose, write
from truegrain.llm import chat_format, pii, topk

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("length", T.StringType()), T.StructField("bucket", T.StringType())])


def slow_top(rows, k=20, every=20):
    whole = []
    for i, r in enumerate(rows):
        x = r["embedding"]
        if r["vec_id"] is not None and x is not None and all(v is not None and np.isfinite(v) for v in x):
            whole.append((i, r["vec_id"], [int(np.floor(64 * float(v))) for v in x]))
    for i, q_id, q in whole:
        if q_id % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, v)), v_id) for j, v_id, v in whole if j != i]
            for rank, (score, v_id) in enumerate(sorted(scores)[:k], 1):
                yield q_id, rank, v_id, -score


@pytest.mark.parametrize("kind", ["alike", "spread", "odd"])
def test_top_k(spark, tmp_path, kind):
    rng = np.random.default_rng(4)
    if kind == "odd":
        rows = [(i, [1.0, 2.0], "x", "y") for i in range(60)]  # one very common vector: all ties
        rows += [(100 + 20 * i, v, "x", "y") for i, v in enumerate([None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [0.0, 0.0], [3.0], [-1.0, -1.0, 5.0]])]
        rows += [(None, [1.0, 1.0], "x", "y"), (40, [1.0, 2.0], "x", "y"), (41, [9e9, -9e9], "x", "y")]
    else:
        x = rng.normal(size=(300, 8))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        if kind == "spread":  # long tails and near copies, which the prunings see
            x = np.repeat(x[:30], 10, axis=0) + 0.02 * x
            x *= np.exp(rng.normal(size=(300, 1)))
        rows = [(i, list(map(float, v)), "x", "y") for i, v in enumerate(x)]
    table = write(spark, tmp_path, "embeddings", rows, VECTORS)
    wanted = Counter(slow_top(table.collect()))
    for settings in ({}, {"bucket_vectors": 32, "block_queries": 4}):
        found = topk.top_k(table, F.col("vec_id") % 20 == 0, **settings).collect()
        assert Counter(map(tuple, found)) == wanted
    assert topk.top_k(table.where("vec_id = -1"), F.col("vec_id") % 20 == 0).count() == 0


def test_coordinate_pruning_is_taken_and_loses_nothing():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(2000, 6))
    v = np.rint(1000 * v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.int64)
    length = np.linalg.norm(v, axis=1)
    order = np.argsort(-length)
    v, length = v[order], length[order]
    q = v[:50] * 2
    scores = q @ v.T
    floor = np.full(50, int(0.96 * 2_000_000))
    chosen = topk._coordinate_candidates(q, np.linalg.norm(q, axis=1), v, length, floor, np.full(50, 2000))
    assert chosen
    for i, some in chosen.items():
        assert set(np.flatnonzero(scores[i] >= floor[i])) <= set(some) and len(some) < 600


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        each = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in each) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def slow_spans(text):
    found = [(m.start(), list(PLAIN).index(k), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return [f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_base_spans(spark, tmp_path, messy, empty):
    rng = random.Random(8)
    texts = ["a@b.c@d.e.f", "a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.255", "4111 1111-1111 1111", "4111  1111", "+1 (706) 555-3138.", "+49", "x@y", "@a.b"]
    texts += ["🙂 me@ex.org 文字 10.0.0.1", "a@b..c a@b.c. .a.@b-.c", "1-2-3-4-5-6-7-8-9-1-2-3 4", "+1+2 3456 7890", "￾4111￾1111", "5500 0000 0000 0004\n4"]
    pieces = ["a", "Z9", "@", ".", "-", " ", "+", "1", "23", "255", "4111111111111111", "b.c", "\n", "(", "_", "é", "🙂"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    texts += ["1 " * 30_000, "a." * 30_000 + "@b", "9" * 60_000, "a@" + "b." * 20_000 + "c", "+" + "1 " * 20_000]
    rows = [(i, t, None, None, None, *["x"] * 5) for i, t in enumerate(texts)] + [(None, "q@w.er", None, None, None, *["x"] * 5)] * 2
    docs = write(spark, tmp_path, "documents", rows, DOCS)
    found = pii.personal_data(docs).select("doc_id", *(f"n_{k}" for k in pii.KINDS), pii.joined("base"), pii.joined("spans")).collect()
    assert len(found) == len(rows)
    texts = dict(enumerate(texts))
    for f in found:
        wanted = slow_spans(texts.get(f["doc_id"], "q@w.er"))
        assert f[5] == ",".join(wanted), texts.get(f["doc_id"])
        assert list(f[1:5]) == [sum(w.startswith(k) for w in wanted) for k in pii.KINDS]
        assert set(wanted) <= set(f[6].split(",")) or not wanted
    assert pii.personal_data(messy).count() == messy.count()
    assert pii.personal_data(empty).count() == 0


def test_contexts_find_unseen_numbers(spark, tmp_path):
    """Numbers in the places of seeds are found; numbers elsewhere, and words in those places, aren't."""
    rng = random.Random(3)
    rows, hidden = [], {}
    for i in range(60):
        text = f"{prose(rng, 9)} my telephone is "
        if i % 6 == 0:
            hidden[i] = (len(text), len(text) + 10)
            text += f"0{rng.randint(10**8, 10**9 - 1)} thanks {prose(rng, 5)}"
        elif i % 6 == 1:
            text += f"nothing thanks in {1900 + i} {prose(rng, 5)} code{rng.randint(10**7, 10**8)}"
        else:
            text += f"+49{rng.randint(10**8, 10**9 - 1)} thanks {prose(rng, 5)}"
        rows.append((i, text, None, None, None, *["x"] * 5))
    found = pii.personal_data(write(spark, tmp_path, "documents", rows, DOCS)).collect()
    for f in found:
        more = {(s["kind"], s["start"], s["end"]) for s in f["spans"]} - {(s["kind"], s["start"], s["end"]) for s in f["base"]}
        assert more == ({("phone", *hidden[f["doc_id"]])} if f["doc_id"] in hidden else set())


@pytest.mark.parametrize(("seeds", "unseen", "finds"), [(3, 1, True), (2, 1, False), (10, 30, True), (3, 0, False)])
def test_contexts_settle(spark, tmp_path, seeds, unseen, finds):
    """Three different seeds make a pattern, two don't; turns go on until scores settle, so many unseen numbers don't hide."""
    rng = random.Random(seeds)
    number = lambda: rng.randint(10**8, 10**9 - 1)
    texts = [f"{prose(rng, 9)} telephone is +49{number()} thanks {prose(rng, 5)}" for _ in range(seeds)]
    texts += [texts[0]] * 5  # the same seed again is no other
    texts += [f"{prose(rng, 9)} telephone is 0{number()} thanks {prose(rng, 5)}" for _ in range(unseen)]
    rows = [(i, t, None, None, None, *["x"] * 5) for i, t in enumerate(texts)]
    found = pii.personal_data(write(spark, tmp_path, "documents", rows, DOCS)).collect()
    more = {f["doc_id"]: len(f["spans"]) - len(f["base"]) for f in found}
    assert more == {i: int(finds and i >= seeds + 5) for i in range(len(texts))}


def test_contexts_hold_words_with_digits(spark, tmp_path):
    """Words with digits beside seeds and unseen numbers make patterns, for candidates as for seeds."""
    rng = random.Random(5)
    rows, hidden = [], {}
    for i in range(60):
        text = f"{prose(rng, 9)} ext {i % 10} "
        if i % 6 == 0:
            hidden[i] = (len(text), len(text) + 10)
            text += f"0{rng.randint(10**8, 10**9 - 1)} thanks {prose(rng, 5)}"
        else:
            text += f"+49{rng.randint(10**8, 10**9 - 1)} thanks {prose(rng, 5)}"
        rows.append((i, text, None, None, None, *["x"] * 5))
    rows.append((99, "pin 7-8 9 me@a.b 1.2 x@c.d é 12 4111 1111-1111 1111 z", None, None, None, *["x"] * 5))
    docs = write(spark, tmp_path, "documents", rows, DOCS)
    for m in pii.matches(docs).where("doc_id = 99 and kind <> 'document'").collect():
        assert m["before"] == rows[-1][1][: m["start"]][-64:] and m["after"] == rows[-1][1][m["end"] :][:64]
    for f in pii.personal_data(docs.where("doc_id < 60")).collect():
        more = {(s["kind"], s["start"], s["end"]) for s in f["spans"]} - {(s["kind"], s["start"], s["end"]) for s in f["base"]}
        assert more == ({("phone", *hidden[f["doc_id"]])} if f["doc_id"] in hidden else set())


def test_personal_data_runs_no_python(messy):
    plan = pii.matches(messy)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("block", T.StringType()), T.StructField("item", T.StringType())])


def slow_cost(roles):
    """The cheapest repair by trying all choices per turn."""
    follows, cost = chat_format.FOLLOWS, chat_format.COST
    paths = {"open": 0}

    def inserted(paths):
        paths = dict(paths)
        for _ in range(2):
            for s, c in list(paths.items()):
                for t in follows[s]:
                    paths[t] = min(paths.get(t, 10**9), c + cost["insert"])
        return paths

    for role in roles:
        new = {}
        for s, c in paths.items():
            if s != "open":
                new[s] = min(new.get(s, 10**9), c + cost["merge" if s == role else "merge_other"])
        for s, c in inserted(paths).items():
            for t in follows[s]:
                new[t] = min(new.get(t, 10**9), c + cost["keep" if t == role else "relabel"])
        paths = new
    return min(c for s, c in inserted(paths).items() if s in chat_format.ENDS)


def check_repair(rows, found):
    convs, out = defaultdict(list), defaultdict(list)
    for r in rows:
        convs[r["conv_id"]].append(r)
    for f in sorted(found, key=lambda f: f["place"]):
        out[f["conv_id"]].append(f)
    assert set(out) == set(convs)
    for conv_id, mine in out.items():
        assert sum(f["action"] != "end" for f in mine) == len(convs[conv_id])
        state = "open"
        for f in mine:
            for r in f["inserted"]:
                assert r in chat_format.FOLLOWS[state]
                state = r
            if f["action"] == "merge":
                assert f["role"] == state and not f["inserted"]
            elif f["action"] != "end":
                assert f["role"] in chat_format.FOLLOWS[state]
                state = f["role"]
        assert state in chat_format.ENDS
        turns = sorted(convs[conv_id], key=lambda r: (r["turn"] is not None, r["turn"] or 0))
        if len({r["turn"] for r in turns}) == len(turns):
            roles = [(r["role"] or "").strip().lower() for r in turns]
            assert sum(f["cost"] for f in mine) == slow_cost(roles), roles
        rendered = "".join(f["rendered"] for f in mine)
        assert len(re.findall(r"<\|(\w+)\|>", rendered)) == sum(len(f["inserted"]) + (f["action"] in ("keep", "relabel")) for f in mine)
        for r in turns:
            assert (r["text"] or "").replace("<|", "< |") in rendered


def test_role_repair(spark, tmp_path):
    rng = random.Random(6)
    choices = ["user", "assistant", "system", "User ", "tool", None]
    rows = []
    for conv_id, roles in enumerate(itertools.product(["user", "assistant", "system", "tool"], repeat=3)):
        rows += [(conv_id, i, r, f"t{i}", "b", "i") for i, r in enumerate(roles)]
    for conv_id in range(100, 140):
        rows += [(conv_id, i, rng.choice(choices), rng.choice(NOUNS), "b", "i") for i in range(rng.randint(1, 12))]
    rows += [(200, i, rng.choice(choices), f"hot {i}", "b", "i") for i in range(300)]  # over half of all rows of its kind
    rows += [(201, 0, "user", "x" * 100_000, "b", "i"), (202, None, "assistant", None, "b", "i"), (None, 0, "user", "<|system|> hi", "b", "i")]
    rows += [(203, 1, "user", "twice", "b", "i")] * 2
    table = write(spark, tmp_path, "conversations", rows, TURNS)
    for block_items in (4096, 16):
        check_repair(rows := table.collect(), chat_format.repair(table, block_items=block_items).collect())
    assert chat_format.repair(table.where("conv_id = -1")).count() == 0


def test_legal_conversations_stay(spark, tmp_path):
    rows = [(1, 0, "system", "s", "b", "i"), (1, 1, "user", "u", "b", "i"), (1, 2, "assistant", "a", "b", "i"), (2, 0, "user", "u", "b", "i")]
    found = chat_format.repair(write(spark, tmp_path, "conversations", rows, TURNS)).orderBy("place").collect()
    assert [f["cost"] for f in found] == [0] * 4
    assert "".join(f["rendered"] for f in found[:3]) == "<|system|>\ns\n<|user|>\nu\n<|assistant|>\na\n"
