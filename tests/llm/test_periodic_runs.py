"""Runs against brute force over all periods."""

import hashlib
import zlib

import numpy as np
import pytest

from roadgauge.llm import periodic_runs, queries


def brute_runs(words):
    best = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            low = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - low
            if length >= max(6, 4 * q):
                best.setdefault((low, length), q)
    return sorted((low, length, q) for (low, length), q in best.items())


def collapsed(words, runs):
    gone = {i for low, length, q in runs for i in range(low + q, low + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def brute(rows):
    out = []
    for d, text in rows:
        words = (text or "").encode().split()
        runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
        out.append((d, runs, b" ".join(collapsed(words, runs)).decode()))
    return sorted(out, key=repr)


def found(docs):
    return sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed_text"]) for r in docs.collect()), key=repr)


def random_rows(rng, count, most=120):
    rows = []
    for d in range(count):
        words = [str(x) for x in rng.integers(0, rng.integers(1, 4) + 1, rng.integers(0, most))]
        for _ in range(rng.integers(0, 3)):
            block, at = [str(x) for x in rng.integers(0, 3, rng.integers(1, 20))], rng.integers(0, len(words) + 1)
            words[at:at] = (block * 9)[:int(len(block) * rng.uniform(2, 9))]
        rows.append((d, " ".join(words)))
    return rows


@pytest.mark.parametrize("tile", [8, 512])
def test_random_texts(docs_of, monkeypatch, tile):
    """Small tiles, so that runs cross many of their borders."""
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile)
    monkeypatch.setattr(periodic_runs, "TILE_OCTAVES", 4 if tile < 512 else 16)
    rows = random_rows(np.random.default_rng(tile), 400)
    assert found(periodic_runs.find_runs(docs_of(rows))) == brute(rows)


def test_awkward_texts(docs_of, awkward):
    rows = [r for r in awkward if r[0] not in (6, 7)] + [(20, "a " * 6), (21, "a " * 5), (22, "a b " * 4 + "a"), (23, "a b " * 3 + "a")]
    rows += [(24, " ".join("ab"[bin(i).count("1") % 2] for i in range(600)))]  # no overlaps, though hashes of blocks may agree
    assert found(periodic_runs.find_runs(docs_of(rows))) == brute(rows)
    assert found(periodic_runs.find_runs(docs_of([]))) == []


def test_block_hashes_rule_out_nearly_all_boundaries():
    ids = np.random.default_rng(2).integers(0, 50, 20_000)
    for octave in (1, 2, 8, 64, 1024):
        assert len(periodic_runs.candidates(ids, octave)[0]) <= 3
    at, period = periodic_runs.candidates(np.tile(ids[:100], 10), 64)
    assert set(period.tolist()) == {100} and len(at) > 5


def test_long_text(docs_of):
    """Long periods over many tiles: 100,000 words that repeat 4 1/2 times, and as many equal words."""
    block = [f"w{i * i % 20011}" for i in range(22_000)]
    long = ["start"] + (block * 5)[:99_000] + ["end"]
    rows = found(periodic_runs.find_runs(docs_of([(1, " ".join(long)), (2, "z " * 100_000)])))
    assert [r[:2] for r in rows] == [(1, [(1, 99_000, 22_000)]), (2, [(0, 100_000, 1)])]
    assert rows[0][2].split() == ["start", *block, "end"] and rows[1][2] == "z"


def test_query(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = random_rows(rng, 150) + [(1000 + d, " ".join(f"w{x}" for x in rng.integers(0, 200, 300))) for d in range(100)]
    rows += [(5000, None), (5001, ""), (None, "x " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, text in rows:
        words = (text or "").encode().split()
        h = 1 if d is None else zlib.crc32(str(d).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
        top = min(((-length, low, q) for low, length, q in runs), default=None)
        best = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
        lines = "".join(f"{low},{length},{q}\n" for low, length, q in runs)
        want.append((d, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()))
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 100
