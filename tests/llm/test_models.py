"""Fitted operators and fingerprints: brute-force scores, held-out accuracy, defined results for odd input."""

import hashlib

import re
import tracemalloc

import numpy as np
import pytest

from roadgauge.llm import fingerprints, lang_id, queries, toxicity

PIECES = queries.tokenizer_path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.01"


def brute_word(own, word, share):
    """Log of the sum over all segmentations of a word."""
    marked = "▁" + word
    ways = [0.0] + [-np.inf] * len(marked)
    for end in range(1, len(marked) + 1):
        for start in range(max(0, end - own.longest), end):
            if marked[start:end] in own.automaton:
                ways[end] = np.logaddexp(ways[end], ways[start] + np.log(share[own.automaton.get(marked[start:end])[0]]))
        ways[end] = np.logaddexp(ways[end], ways[end - 1] + np.log(lang_id.UNKNOWN))
    return ways[-1]


def test_prediction_equals_brute_force(docs_of):
    """Letter runs of any length are summed whole; repeated rows are scored alike."""
    rows = [(100 + i, f"der die das und haus {i}", "de") for i in range(20)] + [(200 + i, f"the cat and house {i}", "en") for i in range(20)]
    texts = ["das Haus, the cat 12", "derdiedasundhaus" * 20, "thecatandhouse" * 200, "Ünd x9y", "日本", "a.b", "42"]
    languages, table = lang_id.train(docs_of(rows), PIECES)
    own = lang_id.pieces(PIECES)
    got = lang_id.predict(docs_of([*enumerate(texts), (0, texts[0])]), PIECES, languages, table).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        words = re.findall(r"[^\W\d_]+", texts[r["doc_id"]].lower())
        sums = np.array([sum(brute_word(own, w, table[:, i]) for w in words) for i in range(2)])
        best = int(sums.argmax())
        want = (languages[best], 1 / np.exp(sums - sums[best]).sum()) if words else ("und", 0.0)
        assert (r["lang_pred"], r["score"]) == (want[0], pytest.approx(want[1]))


def test_forward_sums_all_segmentations():
    own = lang_id.pieces(PIECES)
    rng = np.random.default_rng(1)
    table = rng.dirichlet(np.ones(own.size), 2).T
    table[-1] = lang_id.UNKNOWN

    words = ["the", "zählungen", "ciónente", "x", "日本", "a" * 40, "zählungen" * 60, "e" * 2000]
    got = own.word_scores(words, table)
    assert np.allclose(got, [[brute_word(own, w, table[:, 0]), brute_word(own, w, table[:, 1])] for w in words])


def test_expected_counts_spend_every_letter():
    own = lang_id.pieces(PIECES)
    table = np.full((own.size, 1), 1.0 / own.size)
    sizes = np.ones(own.size)
    for piece in own.automaton:
        number, size = own.automaton.get(piece)
        sizes[number] = size
    counts = own.expected(["heating", "ab", "heatingab" * 50], np.array([3.0, 2.0, 4.0]), table)
    assert counts @ sizes == pytest.approx(3 * 8 + 2 * 3 + 4 * 451)


def test_language_accuracy(spark):
    got = queries.QUERIES["op2_language_id"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 250 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd_input(docs_of, awkward):
    rows = [(100 + i, f"der die das und haus {i}", "de") for i in range(20)] + [(200 + i, f"the cat and house {i}", "en") for i in range(20)]
    languages, table = lang_id.train(docs_of([*rows, *awkward]), PIECES)
    assert languages == ["de", "en"]
    got = {r["doc_id"]: r for r in lang_id.predict(docs_of([*awkward, (50, "123 ..."), (51, "das haus")]), PIECES, languages, table).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0.0 for i in (2, 3, 4, 50))
    assert got[51]["lang_pred"] == "de"
    empty = lang_id.train(docs_of([]), PIECES)
    assert empty[0] == [] and lang_id.predict(docs_of([(1, "text")]), PIECES, *empty).first()["lang_pred"] == "und"


def test_toxicity_accuracy(spark):
    got = queries.QUERIES["op9_toxicity"](spark, FOLDER)
    rows = got.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.95
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_label_model_finds_accuracies():
    """A good voter outweighs five copies of a poor one."""
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.4
    flip = lambda right: np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1
    poor = flip(0.6)
    votes = np.stack([flip(0.95), flip(0.85), *[poor] * 5], axis=1)
    posterior = toxicity.label_model(votes, votes[:, 0] > 0, np.ones(4000))
    assert ((posterior > 0.5) == truth).mean() > 0.93


def test_toxicity_holds_the_words_of_one_text():
    own, texts = toxicity.StemIndex(["awf", "bad$"]), ["an awful text and a bad word in it " * 500] * 200 + [None, ""]
    tracemalloc.start()
    counts, sizes = toxicity.counted(texts, own)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.tolist() == [[500, 500]] * 200 + [[0, 0]] * 2 and sizes.tolist() == [4500] * 200 + [0, 0]
    # the words of all texts together take 50 MB and more
    assert most < 4_000_000


def test_toxicity_odd_input(spark, docs_of, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int, extra string")
    docs = docs_of(awkward)
    model = toxicity.train(docs, none)
    assert {r["predicted"] for r in toxicity.score(docs, model).collect()} == {0}
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(awkward)
    one = toxicity.train(docs, spark.createDataFrame([(1, 1), (5, 1), (None, 0), (6, None)], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.score(docs, one).collect()} == {1}
    assert toxicity.score(docs_of([]), model).count() == 0


def brute_fingerprints(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        changed = t[:len(t) - half] + following[:half]
        own, other, after = map(fingerprints.fingerprint, (t, changed, following))
        out.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), own, other,
                    fingerprints.likeness(own, other), fingerprints.likeness(own, after)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 4, 48])
def test_fingerprints(docs_of, awkward, ranges):
    rows = [*awkward, *[(30 + i, f"short text {i % 4}") for i in range(20)]]
    got = [(r[0], r[1], hashlib.sha256(r[2].encode()).hexdigest(), *r[3:]) for r in fingerprints.fingerprints(docs_of(rows), ranges).collect()]
    assert sorted(got, key=repr) == brute_fingerprints(rows)


def test_single_and_empty(docs_of):
    row = fingerprints.fingerprints(docs_of([(1, "abcd")])).first()
    assert row["edited_text"] == "abab" and row["near_next"] == 1.0
    assert fingerprints.fingerprints(docs_of([])).count() == 0


def test_likeness_follows_edits():
    text = "".join(chr(97 + x) for x in np.random.default_rng(4).integers(0, 26, 2000).tolist())
    one = fingerprints.fingerprint(text)
    few = fingerprints.fingerprint(text[:300] + "q" + text[302:1500] + "zz" + text[1500:])
    half = fingerprints.fingerprint(text[:1000] + text[:1000][::-1])
    assert fingerprints.likeness(one, few) > 0.8 > fingerprints.likeness(one, half) > 0.3
    assert fingerprints.likeness(one, fingerprints.fingerprint(text[::-1])) < 0.3


def test_near_links(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(1, text), (2, text[:700] + "X" + text[701:]), (3, text[::-1])]
    prints = spark.createDataFrame([(d, fingerprints.fingerprint(t)) for d, t in rows], "doc_id long, fingerprint string")
    assert [tuple(r) for r in fingerprints.near_links(prints).collect()] == [(2, 1)]


def test_rows_without_text_stay_whatever_the_model(docs_of):
    """Even if every document that was learnt from is toxic."""
    rows = [(i, f"foul awful words {i}") for i in range(20)]
    labels = docs_of([]).sparkSession.createDataFrame([(i, 1, 1) for i in range(20)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs_of(rows), labels)
    kept = toxicity.keep_clean(docs_of([(50, None), (51, None)]), model)
    assert sorted(r["doc_id"] for r in kept.collect()) == [50, 51]
