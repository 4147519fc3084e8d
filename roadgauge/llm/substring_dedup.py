"""Substring deduplication by seed and extend.

A window is WINDOW consecutive words. Winnowing picks one anchor in every window: the SEED_WORDS-gram with the
smallest hash, a function of the window's words alone, so equal windows have equal anchors at equal places. A seed is an anchor with the
segment around it: the words of all windows that it anchors, at most 8 words to each side.

1. Documents meet on anchors. Equal segments are equal windows: all documents but the one with the smallest
   id lose them, whole copies at once. An anchor with several different segments is contested.
2. Contested anchors are extended both ways, word by word, over the first holder of each segment: the windows around the
   anchor are compared, so a match ends exactly where the texts part.
3. Matched windows of a document are merged into maximal spans, and their words go.

No pairs are made: per anchor and segment (or window) only the smallest id matters. Seeds of a batch that agree travel as one row,
so passages shared by very many documents arrive pre-aggregated. Seeds of an anchor that is frequent in a probe of the documents are dealt
by segment, too, and whether it is contested is then told by an aggregate over all of them. Hashes are 64 bits wide and two independent ones must
agree. Texts travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadgauge.llm import common
from roadgauge.session import stage

WINDOW = 13
SEED_WORDS = 5
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
REMOVED, CONTESTED, FIRST = 0, 1, 2
#: Documents, about, among which anchors are counted to find those that need spreading, and the share of seeds from which one does.
#: This decides where seeds meet and no result.
PROBED, PROBED_SHARE = 4000, 1 / 2000
#: Sort key of a text among the rows of its document.
TEXT = -1


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        size = max(n, 2 * len(have))
        factor = _BASE if kind == "up" else _INVERSE
        with np.errstate(over="ignore"):
            have = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, factor, np.uint64)]).cumprod(dtype=np.uint64)
        _powers[kind] = have
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


class Seeds:
    """Anchors, segments and windows of one text, as arrays.

    first, last: each segment's first and last window; anchor, segment: their hashes.
    """

    def __init__(self, words: list[bytes], window: int = WINDOW, seed_words: int = SEED_WORDS):
        from xxhash import xxh64_intdigest as hashed

        n, self.window = len(words), window
        self.first = self.last = np.zeros(0, np.int64)
        self.anchor = self.segment = np.zeros(0, np.int64)
        if n < window:
            return
        own = np.fromiter(map(hashed, words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * _power("up", n), dtype=np.uint64)])
        self.down = _power("down", n + 1)
        grams = self._ranges(np.arange(n - seed_words + 1), seed_words)
        reach = window - seed_words + 1
        at = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(1) + np.arange(n - window + 1)
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.first, self.last = starts, np.concatenate([starts[1:], [n - window + 1]]) - 1
        self.anchor = grams[at[starts]].view(np.int64)
        # the salt keeps a segment's hash independent of the anchor's
        self.segment = _mix(self._ranges(self.first, self.last - self.first + window) + np.uint64(0xD6E8FEB86659FD93)).view(np.int64)

    def _ranges(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of word ranges, independent of their place."""
        return _mix((self.sums[start + length] - self.sums[start]) * self.down[start])

    def windows(self, start: np.ndarray) -> np.ndarray:
        return _mix(self._ranges(start, self.window) + np.uint64(0xA0761D6478BD642F)).view(np.int64)


def _grouped(key: np.ndarray, value: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """One row per (key, value): the smallest document, and the others packed, if any."""
    order = np.lexsort((doc, value, key))
    key, value, doc = key[order], value[order], doc[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (value[1:] != value[:-1])])
    fresh = new | np.concatenate([[True], doc[1:] != doc[:-1]])
    key, value, doc, new = key[fresh], value[fresh], doc[fresh], new[fresh]
    starts = np.flatnonzero(new)
    ends = np.concatenate([starts[1:], [len(doc)]])
    more: list[bytes | None] = [None] * len(starts)
    for i in np.flatnonzero(ends - starts > 1).tolist():
        more[i] = doc[starts[i] + 1:ends[i]].tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array(key[starts]), pa.array(value[starts]), pa.array(doc[starts]), pa.array(more, pa.binary())],
        ["key", "value", "doc_id", "more"])


GROUPED = "key long, value long, doc_id long, more binary"
MARKS = "doc_id long, key long, value long, kind int"


def seeds(docs: DataFrame, window: int, seed_words: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        keys, values, ids = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own = Seeds(words_of(text), window, seed_words)
            keys.append(own.anchor)
            values.append(own.segment)
            ids.append(np.full(len(own.anchor), doc_id, np.int64))
        key = np.concatenate(keys)
        return _grouped(key, np.concatenate(values), np.concatenate(ids)) if len(key) else None

    return common.map_batches(docs, run, GROUPED)


def frequent_anchors(docs: DataFrame, window: int, seed_words: int, probed: int = PROBED) -> list[int]:
    """Anchors with more than PROBED_SHARE of the seeds of about so many documents: fewer than 2000 of them, ascending."""
    share = min(1.0, probed / max(docs.count(), 1))
    few = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    counted = stage(seeds(few, window, seed_words).groupBy("key").agg(
        F.sum(1 + F.coalesce(F.octet_length("more"), F.lit(0)) / 8).alias("n")), "seed-probe")
    total = counted.agg(F.sum("n")).first()[0] or 0
    # one or two seeds are no sign of a frequent anchor
    return sorted(r["key"] for r in counted.where((F.col("n") > total * PROBED_SHARE) & (F.col("n") > 2)).select("key").collect())


def decide(grouped: DataFrame, contested: bool, hot: list[int] = ()) -> DataFrame:
    """Marks (doc_id, key, value, kind): removed for every document of a (key, value) but the first; and, if asked
    for, contested for the first document of each value of a key with several values in several documents.

    Rows of the keys in hot are dealt by value, too. No task sees all values of such a key, so each value's first document is
    marked as first instead; contested_firsts tells which of these are contested.
    """
    hot_keys = np.array(hot, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None      # key, value, first document of that value
        waiting = None   # the key's only value so far, not yet known to be contested
        for batch in batches:
            if not batch.num_rows:
                continue
            key, value, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            more = batch.column(3).to_pylist()
            n = len(key)
            same_key = np.empty(n, bool)
            same_key[1:] = key[1:] == key[:-1]
            same_key[0] = last is not None and key[0] == last[0]
            same = same_key.copy()
            same[1:] &= value[1:] == value[:-1]
            same[0] = same_key[0] and value[0] == last[1]
            lead = np.maximum.accumulate(np.where(same, -1, np.arange(n)))
            leader = np.where(lead >= 0, doc[lead], last[2] if last else 0)
            gone = same & (doc != leader)
            out = [(doc[gone], key[gone], value[gone], REMOVED)]
            packed = [i for i, x in enumerate(more) if x is not None]
            if packed:
                others = [np.frombuffer(more[i], np.int64) for i in packed]
                sizes = [len(x) for x in others]
                out.append((np.concatenate(others), np.repeat(key[packed], sizes), np.repeat(value[packed], sizes), REMOVED))
            if contested:
                first = ~same
                runs = np.cumsum(~same_key)  # run 0 goes on from the batch before
                values = np.bincount(runs[first], minlength=runs[-1] + 1)
                low = np.full(runs[-1] + 1, np.iinfo(np.int64).max)
                high = np.full(runs[-1] + 1, np.iinfo(np.int64).min)
                np.minimum.at(low, runs[first], doc[first])
                np.maximum.at(high, runs[first], doc[first])
                several = (values > 1) & (low != high)
                # a key that crosses a border of batches counts as contested as soon as a second value comes
                several[0] = values[0] > 0
                several[-1] |= values[-1] > 1
                spread = np.isin(key, hot_keys)
                chosen = first & several[runs] & ~spread
                out.append((doc[chosen], key[chosen], value[chosen], CONTESTED))
                out.append((doc[first & spread], key[first & spread], value[first & spread], FIRST))
                if waiting is not None and several[0]:
                    out.append(tuple(np.array([x], np.int64) for x in waiting) + (CONTESTED,))
                    waiting = None
                if runs[-1] > 0:
                    i = np.flatnonzero(first)[-1]
                    waiting = None if several[-1] or spread[i] else (doc[i], key[i], value[i])
            last = (key[-1], value[-1], leader[-1])
            ids, keys, values_, kinds = zip(*out)
            if sum(map(len, ids)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(values_)),
                     pa.array(np.repeat(np.array(kinds, np.int32), [len(x) for x in ids]))], ["doc_id", "key", "value", "kind"])

    # values of a key need each other only to tell whether it is contested
    if contested:
        dealt = grouped.repartition("key", F.when(F.col("key").isin(hot), F.col("value"))) if hot else grouped.repartition("key")
    else:
        dealt = grouped.repartition("key", "value")
    return dealt.sortWithinPartitions("key", "value", "doc_id").mapInArrow(run, MARKS)


def contested_firsts(marks: DataFrame) -> DataFrame:
    """The marks without kind first: those of keys with several values in several documents become contested. Such keys are few and broadcast."""
    first = marks.where(F.col("kind") == FIRST)
    several = first.groupBy("key").agg(
        F.min("value").alias("v"), F.max("value").alias("w"), F.min("doc_id").alias("d"), F.max("doc_id").alias("e")
    ).where("v < w and d < e").select("key")
    made = first.join(F.broadcast(several), "key").withColumn("kind", F.lit(CONTESTED))
    return marks.where(F.col("kind") != FIRST).unionByName(made)


def beside_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Texts (compressed) and the marks of their documents, side by side, each text before its marks."""
    def squeeze(batch: pa.RecordBatch) -> pa.RecordBatch:
        import zstandard

        own = zstandard.ZstdCompressor(level=3)
        packed = [own.compress(text.encode("utf-8", "surrogatepass")) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    texts = common.map_batches(docs, squeeze, "doc_id long, packed binary").select(
        "doc_id", F.lit(TEXT).alias("kind"), "packed", F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("value"))
    rows = texts.union(marks.select("doc_id", "kind", F.lit(None).cast("binary").alias("packed"), "key", "value"))
    return rows.repartition("doc_id").sortWithinPartitions("doc_id", "kind")


def each_document(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str], dict[int, list[tuple]]]]:
    """Of sorted rows: the id, its texts (several if rows repeat an id), and its marks by kind as arrays."""
    import zstandard

    own, at, texts, marks = zstandard.ZstdDecompressor(), None, [], {}
    for batch in batches:
        ids, kinds = batch.column("doc_id").to_numpy(), batch.column("kind").to_numpy()
        packed = batch.column("packed")
        key, value = (batch.column(name).fill_null(0).to_numpy() for name in ("key", "value"))
        edges = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (kinds[1:] != kinds[:-1])])).tolist()
        for i, j in zip(edges, [*edges[1:], len(ids)]):
            if at != ids[i]:
                if at is not None:
                    yield at, texts, marks
                at, texts, marks = int(ids[i]), [], {}
            if kinds[i] == TEXT:
                texts += [own.decompress(packed[k].as_py()).decode("utf-8", "surrogatepass") for k in range(i, j)]
            else:
                marks.setdefault(int(kinds[i]), []).append((key[i:j], value[i:j]))
    if at is not None:
        yield at, texts, marks


def _as_set(marks: list[tuple] | None) -> set[tuple[int, int]]:
    return set() if not marks else {pair for key, value in marks for pair in zip(key.tolist(), value.tolist())}


def _picked(own: Seeds, wanted: set[tuple[int, int]]) -> np.ndarray:
    if not wanted:
        return np.zeros(0, np.int64)
    return np.array([i for i, pair in enumerate(zip(own.anchor.tolist(), own.segment.tolist())) if pair in wanted], np.int64)


def _windows_in(own: Seeds, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment number, window) for each window of the picked segments."""
    sizes = own.last[picked] - own.first[picked] + 1
    before = np.cumsum(sizes) - sizes
    return np.repeat(picked, sizes), np.arange(sizes.sum()) - np.repeat(before - own.first[picked], sizes)


def extensions(docs: DataFrame, marks: DataFrame, window: int, seed_words: int) -> DataFrame:
    """Windows of the contested segments, grouped by anchor and window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, ids, size = [], [], [], 0
        for doc_id, texts, marks in each_document(batches):
            wanted = _as_set(marks.get(CONTESTED))
            for text in texts if wanted else []:
                own = Seeds(words_of(text), window, seed_words)
                picked = _picked(own, wanted)
                if len(picked):
                    segment, start = _windows_in(own, picked)
                    keys.append(own.anchor[segment])
                    values.append(own.windows(start))
                    ids.append(np.full(len(start), doc_id, np.int64))
                    size += len(start)
            if size > 100_000:
                yield _grouped(np.concatenate(keys), np.concatenate(values), np.concatenate(ids))
                keys, values, ids, size = [], [], [], 0
        if size:
            yield _grouped(np.concatenate(keys), np.concatenate(values), np.concatenate(ids))

    return beside_marks(docs, marks.where(F.col("kind") == CONTESTED)).mapInArrow(run, GROUPED)


def spans_of(covered: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of covered words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def deduplicate(docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, spans (array of word ranges that went) and kept_text of every row.

    A word goes if a window over it has the words of a window of a document with a smaller doc_id. Windows are judged on
    the input. A null text has no words; texts shorter than a window lose none. Rows without doc_id
    have no place in the order: they neither lose words nor take any. Rows that repeat an id are judged each, against smaller ids only.
    """
    if not 0 < seed_words < window:
        raise ValueError("an anchor must be shorter than a window")
    rows = common.id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    placed = rows.where("doc_id is not null")
    hot = frequent_anchors(placed, window, seed_words)
    first = stage(decide(seeds(placed, window, seed_words), True, hot), "seed-marks")
    if hot:
        first = contested_firsts(first)
    second = stage(decide(extensions(placed, first, window, seed_words), contested=False), "window-marks")
    marks = first.where(F.col("kind") == REMOVED).unionByName(second.withColumn("kind", F.lit(CONTESTED)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for doc_id, texts, marks in each_document(batches):
            whole, single = _as_set(marks.get(REMOVED)), _as_set(marks.get(CONTESTED))
            anchors = {anchor for anchor, _ in single}
            for text in texts:
                words = words_of(text)
                covered = np.zeros(len(words) + 1, np.int64)
                if whole or single:
                    own = Seeds(words, window, seed_words)
                    picked = _picked(own, whole)
                    np.add.at(covered, own.first[picked], 1)
                    np.add.at(covered, own.last[picked] + window, -1)
                    if anchors:
                        near = np.array([i for i, anchor in enumerate(own.anchor.tolist()) if anchor in anchors], np.int64)
                        segment, start = _windows_in(own, near)
                        hit = [pair in single for pair in zip(own.anchor[segment].tolist(), own.windows(start).tolist())] if len(near) else []
                        start = start[np.array(hit, bool)]
                        np.add.at(covered, start, 1)
                        np.add.at(covered, start + window, -1)
                gone = np.cumsum(covered)[:-1] > 0
                spans = spans_of(gone)
                kept = [word for word, out in zip(words, gone.tolist()) if not out] if spans else words
                made.append((doc_id, len(words), int(gone.sum()), spans, b" ".join(kept)))
                size += len(text) + 200
            if size > 4_000_000:
                yield to_batch(made)
                made, size = [], 0
        if made:
            yield to_batch(made)

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept_text string"
    found = beside_marks(placed, marks).mapInArrow(run, schema)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    unplaced = rows.where("doc_id is null").select(
        "doc_id", F.size(words).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.from_json(F.lit("[]"), "array<struct<start: long, end: long>>").alias("spans"), F.array_join(words, " ").alias("kept_text"))
    return found.unionByName(unplaced)


def to_batch(made: list[tuple]) -> pa.RecordBatch:
    doc_id, n_words, n_removed, spans, kept = zip(*made)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
         pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], kind), pa.array(kept, pa.binary()).cast(pa.string())],
        ["doc_id", "n_words", "n_removed", "spans", "kept_text"])
