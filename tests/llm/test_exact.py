"""Operators whose results are compared with brute force, row by row."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadgauge.llm import bpe, common, exact_dedup, packing, queries, simhash, substring_dedup, token_counts
from tests.conftest import SAMPLE

WORD_BPE, PIECES = queries.tokenizer_path("word_bpe_49k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op3_exact_dedup"])
def test_sql(spark, name):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{SAMPLE}/documents.parquet'")
    cursor = db.execute(queries.CHECK_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert rows_of(queries.QUERIES[name](spark, SAMPLE).select(*columns)) == sorted(cursor.fetchall(), key=repr)


def brute_substring(rows, size):
    first = {}
    words = [(d, substring_dedup.words_of(t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - size + 1 if d is not None else 0):
            key = tuple(w[i:i + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - size + 1 if d is not None else 0):
            if first[tuple(w[i:i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


def test_substring_random(docs_of):
    rng = np.random.default_rng(3)
    base = [str(x) for x in rng.integers(0, 40, 60)]
    rows = []
    for d in rng.permutation(60).tolist():
        w = [str(x) for x in rng.integers(0, 9, rng.integers(0, 50))]
        for _ in range(rng.integers(0, 4)):
            a, n, at = rng.integers(0, 50), rng.integers(3, 25), rng.integers(0, len(w) + 1)
            w[at:at] = base[a:a + n]
        rows.append((d, " ".join(w)))
    for size, seed in ((13, 5), (6, 2)):
        got = substring_dedup.deduplicate(docs_of(rows), size, seed).select("doc_id", "n_words", "n_removed", "kept_text")
        assert rows_of(got) == brute_substring(rows, size)


@pytest.mark.parametrize("spread", ["none", "half", "all"])
def test_substring_hot_anchor(docs_of, monkeypatch, spread):
    """One passage inside different surroundings: how many of its anchors are spread over tasks changes nothing."""
    passage = "one passage of seven words stands here".split()
    rng = np.random.default_rng(11)
    rows = [(d, " ".join([*map(str, rng.integers(0, 3, 9)), *passage, *map(str, rng.integers(0, 3, 9))])) for d in range(120)]
    rows += [(d + 1000, t) for d, t in rows[:30]]
    found = substring_dedup.frequent_anchors(docs_of(rows), 13, 5)
    assert found == sorted(set(found)) and len(found) > 3
    assert substring_dedup.frequent_anchors(docs_of([]), 13, 5) == []
    hot = {"none": [], "half": found[::2], "all": found}[spread]
    monkeypatch.setattr(substring_dedup, "frequent_anchors", lambda *_: hot)
    got = substring_dedup.deduplicate(docs_of(rows)).select("doc_id", "n_words", "n_removed", "kept_text")
    assert rows_of(got) == brute_substring(rows, 13)


def test_join_spread(spark):
    """Hot keys, others and a null: the same rows as a plain join."""
    rows = spark.createDataFrame([(i, 7 if i % 3 else i) for i in range(5000)] + [(-1, None)], "doc_id long, fp long")
    named = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("component_id"))
    plain = rows.join(named.drop("n_rows"), "fp").select("doc_id", "fp", "component_id")
    got = common.join_spread(rows, named, "fp", "n_rows").select("doc_id", "fp", "component_id")
    assert rows_of(got) == rows_of(plain) and got.count() == 5000
    assert common.join_spread(rows.limit(0), named.limit(0), "fp", "n_rows").count() == 0


def test_substring_awkward(docs_of, awkward):
    got = substring_dedup.deduplicate(docs_of(awkward))
    assert rows_of(got.select("doc_id", "n_words", "n_removed", "kept_text")) == brute_substring(awkward, 13)
    by_id = {r["doc_id"]: r for r in got.where("doc_id in (6, 7)").collect()}
    assert not by_id[6]["spans"] and [tuple(s) for s in by_id[7]["spans"]] == [(0, 30_000)]
    assert substring_dedup.deduplicate(docs_of([])).count() == 0


def brute_copies(rows):
    groups = defaultdict(list)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d, t in rows:
        groups[(t or "").translate(lower)].append(d)
    out = []
    for text, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep = max(known) if known else None
        stays = 1
        for d in sorted(ids, key=lambda d: (d is not None, d), reverse=True):
            kept = d == keep and stays > 0
            stays -= kept
            out.append((d, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup(spark, docs_of, awkward):
    docs = docs_of(awkward)
    assert rows_of(exact_dedup.deduplicate(docs, exact_dedup.new_index(spark))) == brute_copies(awkward)
    stay = exact_dedup.survivors(docs, exact_dedup.new_index(spark))
    assert stay.columns == docs.columns
    assert Counter(r["doc_id"] for r in stay.collect()) == Counter([4, 3, 5, 6, 7, 8, 9, 9, None, None, 12, -13])
    assert exact_dedup.deduplicate(docs_of([]), exact_dedup.new_index(spark)).count() == 0


def test_index_persists(spark, docs_of, tmp_path):
    path = str(tmp_path / "index")
    exact_dedup.deduplicate(docs_of([(1, "a"), (2, "A"), (3, "b")]), exact_dedup.DigestIndex(spark, path)).count()
    again = exact_dedup.DigestIndex(spark, path)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.deduplicate(docs_of([(7, "a"), (8, "c")]), again).collect()}
    assert got == {7: (2, False), 8: (8, True)}
    assert again.table().count() == 3
    plan = docs_of([(1, "a")]).select(exact_dedup.digest(F.col("text")).alias("digest")).distinct().join(
        again.table().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_bpe_equals_library(docs_of, awkward):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for d, t in awkward:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    got = [(r[0], r[1], bytes(r[2]), r[3]) for r in bpe.encode(docs_of(awkward), WORD_BPE).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_chunks_are_reused():
    own = bpe.ChunkEncoder(WORD_BPE)
    first = own.encode("lead " + SHARED)
    before = own.encoded_chunks
    assert own.encode("other start here, then " + SHARED)[-400:] == first[-400:]
    assert own.encoded_chunks - before < before / 2


SHARED = " ".join(f"shared{i * 31 % 97} passage, number {i}." for i in range(400))


def test_packing(docs_of, awkward):
    rows = [r for r in awkward if r[0] is not None and r[0] != 9]
    got = [r.asDict() for r in packing.pack(docs_of(rows), WORD_BPE).collect()]
    own, texts = bpe.ChunkEncoder(WORD_BPE), dict(rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        whole = own.encode(texts[d] or "") + struct.pack("<I", 2)
        pieces.sort(key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == whole
        assert all(r["doc_tokens"] == len(whole) // 4 and r["length"] == len(r["ids"]) // 4 for r in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces])[:-1].tolist()
        total = sum(r["length"] for r in pieces)
        assert total <= 4096 and total & (total - 1) == 0


def test_packing_query_digests(spark):
    got = queries.QUERIES["op7_harmonic_packing"](spark, SAMPLE).where("length > 0").limit(20).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()}
    own = bpe.ChunkEncoder(WORD_BPE)
    for r in got:
        ids = (own.encode(texts[r["doc_id"]]) + struct.pack("<I", 2))[4 * r["start"]:4 * (r["start"] + r["length"])]
        assert zlib.crc32(ids) == r["ids_crc32"]


def brute_components(fps):
    """fps: (doc_id, fingerprint)."""
    low = {i: d for i, (d, _) in enumerate(fps)}
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(fps):
            for j, (_, b) in enumerate(fps):
                if (a ^ b).bit_count() <= 3 and low[j] is not None and (low[i] is None or low[j] < low[i]):
                    low[i], changed = low[j], True
    return sorted(((d, f, low[i]) for i, (d, f) in enumerate(fps)), key=repr)


def test_simhash(docs_of, awkward):
    assert simhash.fingerprint("") == 0
    got = rows_of(simhash.near_duplicates(docs_of(awkward)))
    fps = [(d, simhash.fingerprint(t or "")) for d, t in awkward]
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    assert got == sorted(((d, signed(f), c) for d, f, c in brute_components(fps)), key=repr)


@pytest.mark.parametrize("shard_rows", [4096, 5])
def test_links_lose_nothing(spark, shard_rows):
    """Chains of fingerprints 1 to 4 bits apart, in one hot shard split into parts or not."""
    rng = np.random.default_rng(5)
    fps, at = set(), 0x0123456789ABCDEF
    for _ in range(120):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
            at ^= 1 << bit
        fps.add(at)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    stars = simhash.components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), shard_rows=shard_rows)).collect()
    root = {r["a"]: r["root"] for r in stars}
    want = {f: c for _, f, c in brute_components(list(enumerate(fps)))}
    groups = defaultdict(set)
    for f, s in zip(fps, signed):
        groups[root.get(s, s)].add(want[f])
    assert all(len(x) == 1 for x in groups.values()) and len(groups) == len(set(want.values()))


def test_fingerprint_is_the_contract():
    from xxhash import xxh64_intdigest

    text = "One TWO three Four five Öl"
    words = "one two three four five Öl".split()
    hashes = [xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(4)]
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 4)
    assert simhash.fingerprint("A b") == xxh64_intdigest("a b", 42)


def test_near_groups(docs_of):
    words = [f"t{i}" for i in range(300)]
    near = words[:100] + ["changed"] + words[101:]
    other = [f"u{i}" for i in range(300)]
    docs = docs_of([(4, " ".join(words)), (7, " ".join(near)), (9, " ".join(other)), (None, " ".join(words)), (11, None), (12, "")])
    assert {(r["a"], r["root"]) for r in simhash.near_groups(docs).collect()} == {(4, 4), (7, 4), (11, 11), (12, 11)}
    assert sorted((r["doc_id"] for r in simhash.survivors(docs).collect()), key=repr) == [11, 4, 9, None]


def test_token_counts(docs_of, awkward):
    from tokenizers import Tokenizer, models, normalizers

    library = Tokenizer(models.Unigram(token_counts.vocabulary(PIECES), unk_id=0, byte_fallback=True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    rows = awkward + [(20, "<s> <0x41> ▁▁ tie aaaaaaaa"), (21, "\n\n \n"), (22, "一\U0001F601" * 40)]
    got = Counter((r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(docs_of(rows), PIECES).collect())
    assert got == Counter((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)


def test_parts_equal_the_library():
    """Random texts over letters, marks, digits, combining marks, apostrophes, special tokens and odd white space."""
    own = bpe.ChunkEncoder(WORD_BPE)
    rng = np.random.default_rng(11)
    atoms = ["the", "Of", "é", "É", "e\u0301", "ß", "ñ", "日本", "\u0301", ".", "..", "!?", "'s", "'", "'t", "|", "<|", "|>", "<|endoftext|>",
             " ", "  ", "\n", "\t", "\u00a0", "\x1c", "\x85", "7", "42", "\U0001F600", "$%", "-", "_", "×", "ǅ", "a.b", ",", "İ", "K"]
    texts = ["".join(rng.choice(atoms, rng.integers(0, 14))) for _ in range(4000)] + ["", "x" * 5000, "a. " * 4000]
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.encode_parts(texts) == want and own.encode_all(texts) == want


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="not supported"):
        bpe.ChunkEncoder(queries.tokenizer_path("byte_bpe_50k.json"))


def test_the_memo_of_parts_is_bounded_and_forgets_no_id(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PARTS", 3000)
    monkeypatch.setattr(bpe, "LEARN_CHARACTERS", 5000)
    own = bpe.ChunkEncoder(WORD_BPE)
    texts = [" ".join(f"{'abcdefghij'[(i + j) % 10]}w{(i * 37 + j * 101) % 9000}" for j in range(100)) for i in range(300)]
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.encode_parts(texts) == want
    # a generation may exceed its bound by the parts of one call
    assert own.words.old and max(len(own.words), len(own.words.old)) < 3000 + 2000


def test_packed_batches_are_bounded_by_bytes():
    """Few long pieces leave in as small batches as many short ones."""
    own, text = bpe.ChunkEncoder(WORD_BPE), "the word and a " * 1500
    n = len(own.encode_parts([text])[0]) // 4 + 1
    batches = (pa.RecordBatch.from_pydict({"doc_id": list(range(i, i + 50)), "text": [text] * 50}) for i in range(0, 400, 50))
    made = list(packing.packed(batches, own, packing.Packer(0), struct.pack("<I", 2)))
    assert sum(sum(b.column("length").to_pylist()) for b in made) == 400 * n
    assert len(made) > 2 and max(b.nbytes for b in made) < 3 * packing.BYTES_OUT < 4 * 400 * n


def test_harmonic_classes():
    """A full bin holds k whole remainders of class k, its slack is smaller than they are, and few documents are cut."""
    rng = np.random.default_rng(4)
    packer, rows = packing.Packer(0), []
    sizes = [int(x) for x in np.minimum(rng.lognormal(6.3, 1.1, 4000), 20_000)] + [4096, 4095, 2048, 1, 8192]
    for d, size in enumerate(sizes):
        rows += packer.add(d, bytes(4 * size))
    before = {r[5] for r in rows}
    assert all(sum(len(s[2]) // 4 for s in b) < 4096 for b in packer.open.values()) and packer.spare < 8192 + 4096
    rows += packer.finish()
    bins, pieces = defaultdict(list), Counter(r[0] for r in rows)
    for r in rows:
        bins[r[5]].append(r)
    for number, inside in bins.items():
        total = sum(r[2] for r in inside)
        assert total == 4096 or (number not in before and total & (total - 1) == 0)
        rests = [r[2] for r in inside if r[1] + r[2] == r[4] and r[1] % 4096 == 0 and r[2] < 4096]
        if number in before and inside[0][2] < 4096:
            k = 4096 // inside[0][2]
            assert len(rests) >= k and all(4096 // n == k for n in rests[:k]) and 4096 - sum(rests[:k]) < 4096 / (k + 1)
    whole = sum(size // 4096 for size in sizes)
    assert (len(rows) - whole) / len(sizes) < 1.5 and max(pieces.values()) < 30
    assert sum(r[2] for r in rows) == sum(sizes)


def test_survivors_follow_links_of_fingerprints_and_of_sets(docs_of):
    # 1 and 2 are alike by fingerprint only, 3 and 2 by sets of shingles only
    lines = "one two three four five " * 60
    tail = " ".join(f"w{i}" for i in range(30))
    rows = [(1, lines + "alpha beta gamma delta"), (2, lines + tail), (3, "one two three four five " * 2 + tail), (4, "quite another text of its own"), (None, lines)]
    docs = docs_of(rows)
    prints = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect() if r["doc_id"]}
    sets = {r["a"]: r["root"] for r in simhash.near_groups(docs).collect()}
    assert prints == {1: 1, 2: 1, 3: 3, 4: 4} and sets == {2: 2, 3: 2}
    assert sorted((r["doc_id"] for r in simhash.survivors(docs).collect()), key=repr) == [1, 4, None]
