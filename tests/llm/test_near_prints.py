"""Links of op4's fingerprints against brute force over all pairs."""

from itertools import combinations

import numpy as np
import pytest

from roadgauge.llm import fingerprints


@pytest.mark.parametrize("part_rows", [fingerprints.PART_ROWS, 7])
def test_near_components(spark, part_rows):
    """Groups with 8 to 15 changed nibbles; rows b and c alike to each other but not to the smallest of their band; copies, null ids."""
    rng = np.random.default_rng(11)
    hexed = lambda x: "".join("0123456789abcdef"[v] for v in x)
    prints = []
    for _ in range(25):
        base = rng.integers(0, 16, 64)
        prints.append(base)
        for _ in range(3):
            other = base.copy()
            at = rng.choice(64, rng.integers(8, 16), replace=False)
            other[at] = (other[at] + rng.integers(1, 16, len(at))) % 16
            prints.append(other)
    lead = rng.integers(0, 16, 64)
    for _ in range(10):  # one large band: the first 20 nibbles are equal, the rest differ from pair to pair
        pair = np.concatenate([lead[:20], rng.integers(0, 16, 44)])
        prints += [pair, np.concatenate([pair[:58], (pair[58:] + 1) % 16])]
    rows = list(enumerate(map(hexed, prints)))
    rows += [(500, rows[3][1]), (None, rows[5][1]), (None, hexed(rng.integers(0, 16, 64)))]
    root = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if fingerprints.likeness(rows[i][1], rows[j][1]) >= fingerprints.ALIKE:
            low, high = sorted((root[i], root[j]))
            root = [low if x == high else x for x in root]
    want = []
    for i, (d, f) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        want.append((d, f, min(ids, default=None)))
    made = fingerprints.near_components(spark.createDataFrame(rows, "doc_id long, fingerprint string"), part_rows=part_rows)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in made.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    links = sum(1 for d, _, c in want if d is not None and d > c)
    assert links > 30
