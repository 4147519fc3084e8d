"""Near duplicates of the pipeline against brute force, on both sides of the threshold."""

from itertools import combinations

import numpy as np
import pytest

from roadgauge.llm import similar_sets, simhash


def with_words(rng, n):
    return [f"w{x}" for x in rng.integers(0, 1 << 40, n).tolist()]


def planted():
    """Pairs of similarity around 0.75 to 0.85 (each changed word changes 5 shingles), long and short; texts around one common passage."""
    rng = np.random.default_rng(7)
    rows = []
    for n in (9, 14, 60, 504, 2004):
        for share in (0.75, 0.77, 0.79, 0.8, 0.8, 0.81, 0.82, 0.85):
            base = with_words(rng, n)
            changes = max(1, round((1 - share) / (1 + share) * (n - 4) / 5))
            for d in (0, 1, -1):
                other = list(base)
                for i in range(min(changes + d, n // 6)):
                    other[i * (n // (changes + 2)) + 4] = "changed"
                rows.append(" ".join(other))
            rows.append(" ".join(base))
    passage = with_words(rng, 120)
    rows += [" ".join(passage + with_words(rng, int(k))) for k in rng.integers(0, 60, 40)]
    # a chain: each alike to the next only
    chain = with_words(rng, 300)
    for i in range(12):
        rows.append(" ".join(chain[20 * i:20 * i + 200]))
    # more than one changed copy of one text, not all alike to the smallest
    for _ in range(30):
        copy = list(passage)
        for at in rng.choice(120, rng.integers(1, 4), replace=False):
            copy[at] = f"x{rng.integers(1 << 40)}"
        rows.append(" ".join(copy))
    return list(enumerate(rng.permutation(rows).tolist()))


def brute(rows):
    sets = {d: frozenset(similar_sets.shingle_set(t).tolist()) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sets, 2):
        if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
            one, other = sorted((find(a), find(b)))
            root[other] = one
    groups = {d: find(d) for d in sets}
    return {(d, r) for d, r in groups.items() if list(groups.values()).count(r) > 1}


@pytest.mark.parametrize("unit_shingles", [similar_sets.UNIT_SHINGLES, 700])
def test_equals_brute_force(docs_of, unit_shingles):
    rows = planted()
    got = {(r["a"], r["root"]) for r in simhash.near_groups(docs_of(rows), unit_shingles).collect()}
    assert got == brute(rows)


def test_unit_links():
    """Random units: with the labels, the same components as all pairs give."""
    rng = np.random.default_rng(1)
    for _ in range(30):
        pool = rng.integers(0, 1 << 60, 60)
        entries = [(i, i if rng.random() < 0.7 else 0, np.unique(rng.choice(pool, rng.integers(35, 56), replace=False))) for i in range(40)]
        root = list(range(40))
        for i, j in combinations(range(40), 2):
            a, b = set(entries[i][2].tolist()), set(entries[j][2].tolist())
            if entries[i][1] == entries[j][1] or 9 * len(a & b) >= 4 * (len(a) + len(b)):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
        want = {(i, root[i]) for i in range(40) if root[i] != i}
        assert set(similar_sets.unit_links(entries)) == want
