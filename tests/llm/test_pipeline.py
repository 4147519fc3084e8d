"""Stages of the corpus pipeline on planted documents."""

from collections import defaultdict

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from roadgauge.session import stage
from tests.conftest import SAMPLE


def test_registered():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_stages(spark, docs_of, tmp_path):
    rng_text = " ".join(f"clean{i}" for i in range(200))
    planted = [
        (1, "plain words about nothing"), (2, "PLAIN words about nothing"), (3, rng_text), (4, rng_text.replace("clean100", "other")),
        (5, "card 4111111111111111 here"), (6, "you idiot moron stupid trash"), (7, None), (8, ""),
    ]
    rng = np.random.default_rng(8)
    words = lambda n: ["".join(chr(97 + x // 17 ** i % 17) for i in range(3)) + "w" for x in rng.integers(0, 4000, n).tolist()]
    insults = "idiot moron stupid trash".split()
    known = [(1000 + i, " ".join(words(60) + (list(rng.choice(insults, 3)) if i % 4 == 0 else []))) for i in range(400)]
    spark.createDataFrame([(i, int((i - 1000) % 4 == 0)) for i, _ in known], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = docs_of(planted + known)
    kept = docs
    for (name, function), ids in zip(pipeline.STAGES[:-1], ({1, 2, 3, 4, 5, 7, 8}, {2, 3, 4, 5, 8}, {2, 3, 5, 8}, {2, 3, 5, 8})):
        kept = stage(function(spark, kept, str(tmp_path)), "test-stage")
        found = {r["doc_id"] for r in kept.collect()}
        assert kept.columns == docs.columns and {i for i in found if i < 1000} == ids, name
        assert {i for i in found if i >= 1000} == {i for i, _ in known if i % 4}
    assert "4111111111111111" not in kept.where("doc_id = 5").first()["text"]
    lengths, totals = defaultdict(int), {}
    for r in pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).collect():
        lengths[r["doc_id"]] += r["length"]
        totals[r["doc_id"]] = r["doc_tokens"]
    assert lengths == totals and set(lengths) == {r["doc_id"] for r in kept.collect()} and lengths[8] == 1


def test_empty(spark, docs_of):
    docs = docs_of([])
    for _, function in pipeline.STAGES:
        docs = function(spark, docs, SAMPLE)
        assert docs.count() == 0 or _ == "packing"
