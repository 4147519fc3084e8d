"""Context-tree scores against a plain recursion over dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadgauge.llm import common, context_tree, queries
from tests.conftest import SAMPLE

LARGER = "/root/testdata/sf0.01"


def words_of(text):
    return (text or "").encode().lower().split()


def string_of(text):
    return b"".join(w + b" " for w in words_of(text)) + b"\n"


def places(data, depth):
    """(context, latest byte first; byte) of each byte."""
    padded = b"\n" * depth + data
    return [(padded[i:i + depth][::-1], padded[i + depth]) for i in range(len(data))]


class Tree:
    def __init__(self, texts, depth):
        self.depth, self.counts, self.children, self.memo = depth, defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for text in texts:
            for context, byte in places(string_of(text), depth):
                for choice in range(8):
                    node = (1 << choice) | (byte >> (8 - choice))
                    for level in range(depth + 1):
                        self.counts[node, context[:level]][byte >> (7 - choice) & 1] += 1
                        if level:
                            self.children[node, context[:level - 1]].add(context[:level])

    def weighted(self, node, context):
        key = node, context
        if key not in self.memo:
            zeros, ones = self.counts.get(key, (0, 0))
            own = math.lgamma(zeros + .5) + math.lgamma(ones + .5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)
            if len(context) == self.depth:
                self.memo[key] = own, own, None
            else:
                below = sum(self.weighted(node, c)[0] for c in self.children.get(key, ()))
                high = max(own, below)
                total = math.log(.5) + high + math.log(math.exp(own - high) + math.exp(below - high))
                self.memo[key] = total, own, below
        return self.memo[key]

    def one(self, node, context, level=0):
        """Probability of a one."""
        zeros, ones = self.counts.get((node, context[:level]), (0, 0))
        own = (ones + .5) / (zeros + ones + 1)
        if level == self.depth:
            return own
        _, explained, below = self.weighted(node, context[:level])
        share = 1 / (1 + math.exp(max(min(below - explained, 700), -700)))
        return share * own + (1 - share) * self.one(node, context, level + 1)

    def score(self, text):
        total = 0.0
        for context, byte in places(string_of(text), self.depth):
            for choice in range(8):
                p = self.one((1 << choice) | (byte >> (8 - choice)), context)
                total += math.log10(p if byte >> (7 - choice) & 1 else 1 - p)
        return total


def brute(rows, depth):
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    train = [t for (_, t), out in zip(rows, held) if not out]
    tree, counts = Tree(train, depth), Counter()
    for t in train:
        counts.update([*words_of(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for (d, t), flag in zip(rows, held):
        tokens = [*words_of(t), b"\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((d, flag, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, tree.score(t)))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, round(r[6], 4), r[2])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def run(docs, depth):
    return context_tree.score_texts(docs, common.fold_of("doc_id", 7) == 2, depth).collect()


@pytest.mark.parametrize("depth", [3, 5])
def test_random_texts(docs_of, depth, monkeypatch):
    rng = np.random.default_rng(depth)
    names = ["the", "cat", "Dog", "sat", "über", "on", "a", "mat.", "x"]
    rows = [(d, " ".join(rng.choice(names, rng.integers(0, 40)))) for d in range(60)]
    same(run(docs_of(rows), depth), brute(rows, depth))


def test_awkward_texts(docs_of):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Same"), (5, "same"), (5, "same"), (9, "a b"), (9, "a c"), (None, "a"), (None, None),
            (-13, "x" * 700), (16, "\U0001F600 日本 \x1c\x00"), (23, "word " * 300)]
    same(run(docs_of(rows), 5), brute(rows, 5))
    assert run(docs_of([]), 5) == []


def test_long_text_and_small_packs(docs_of, monkeypatch):
    """Many shards give what one gives; a held-out side without any training rows still gets scores."""
    rows = [(d, " ".join(f"w{i * 7919 % 503}" for i in range(d * 50))) for d in range(1, 12)] + [(99, "q" * 40_000)]
    whole = sorted(map(tuple, run(docs_of(rows), 5)))
    monkeypatch.setattr(context_tree, "PACK_BYTES", 300)
    monkeypatch.setattr(context_tree, "SHARD_BYTES", 2000)
    parted = sorted(map(tuple, run(docs_of(rows), 5)))
    assert [r[:5] for r in parted] == [r[:5] for r in whole]
    assert np.allclose([r[5:] for r in parted], [r[5:] for r in whole], rtol=1e-9)
    none = context_tree.score_texts(docs_of([(1, "ab c")]), F.lit(True)).collect()
    assert [tuple(r) for r in none] == [(1, True, 3, 0, 0, 0.0, pytest.approx(6 * 8 * math.log10(.5)))]


def test_held_out_texts(spark):
    """The query scores every document; deep contexts score unseen documents above smoothed word counts, even on few texts."""
    rows = queries.QUERIES["op12_context_tree_scores"](spark, SAMPLE).collect()
    assert len(rows) == spark.read.parquet(f"{SAMPLE}/documents.parquet").count()
    held_out = common.fold_of("doc_id", 7) == 2
    rows = context_tree.score_texts(common.table(spark, LARGER, "documents"), held_out, 7).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
