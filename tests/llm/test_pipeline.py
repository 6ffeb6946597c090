"""The corpus pipeline, stage by stage, against plain Python over each stage's own input."""

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.conftest import DOCS, messy_rows, write
from tests.llm.test_copies import SPACE, order, roots, slow_fingerprint
from tests.llm.test_mix_and_pack import check_packing
from tests.llm.test_scores import LABELS, labelled
from truegrain.llm import mixing, quality


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Each stage's input and output rows."""
    folder = tmp_path_factory.mktemp("pipeline")
    rows, labels = labelled(400)
    rows += [r if r[0] is None else (r[0] + 10_000, *r[1:]) for r in messy_rows() if (r[0] or 0) not in (230, 231)]
    docs = write(spark, folder, "documents", rows, DOCS)
    write(spark, folder, "labels", labels, LABELS)
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, steps[-1], str(folder)).write.parquet(path)
        steps.append(spark.read.parquet(path))
    return str(folder), steps


def test_stages_and_columns(run):
    _, steps = run
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "best_fit_packing",
    ]
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert {"pipeline"} | {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in contract.queries() if k == "pipeline" or k.startswith("op")}


def test_classifier_stage(spark, run):
    folder, (docs, kept, *_) = run
    scores = quality.scored(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    wanted = Counter(r["doc_id"] for r in scores.where("predicted = 1").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == wanted
    assert not Counter((r["doc_id"], r["text"]) for r in kept.collect()) - good
    junk = {r[0] for r, (_, q, _) in zip(*(x for x in labelled(400))) if q == 0}
    assert len(junk & {r["doc_id"] for r in kept.collect()}) < 0.1 * len(junk)


def test_exact_stage(run):
    _, (_, docs, kept, *_) = run
    first = {}
    for r in docs.collect():
        text = SPACE.sub(" ", r["text"] or "")
        first[text] = min(first.get(text, order(r["doc_id"])), order(r["doc_id"]))
    assert Counter((order(r["doc_id"]), SPACE.sub(" ", r["text"] or "")) for r in kept.collect()) == Counter((i, t) for t, i in first.items())


def test_near_stage(run):
    _, (_, _, docs, kept, *_) = run
    rows = docs.collect()
    prints = [slow_fingerprint(r["text"]) for r in rows]
    root = roots(set(prints), 2)
    first = {}
    for r, p in zip(rows, prints):
        first[root[p]] = min(first.get(root[p], order(r["doc_id"])), order(r["doc_id"]))
    assert Counter(order(r["doc_id"]) for r in kept.collect()) == Counter(first.values())


def test_mixing_stage(run):
    _, (_, _, _, docs, mixed, _) = run
    times = Counter()
    for r in mixing.mix(docs).collect():
        times[r["doc_id"]] += r["times"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +times
    assert max(Counter((r["doc_id"], r["text"]) for r in mixed.collect()).values()) <= 3 * 2


def test_packing_stage(run):
    _, (*_, docs, packed) = run
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids_of = lambda text: full.encode(text or "", add_special_tokens=False).ids
    rows = docs.collect()
    used = check_packing(rows, ids_of, packed.collect(), 2048)
    assert used == -(-sum(len(ids_of(r["text"])) + 1 for r in rows) // 2048)


def test_run_gives_the_last_stage(spark, run):
    folder, steps = run
    again = corpus_pipeline.run(spark, folder)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, again.select(key).collect())) == Counter(map(tuple, steps[-1].select(key).collect()))
