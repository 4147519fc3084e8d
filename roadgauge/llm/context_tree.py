"""Scores of texts under a context-tree weighting model of bytes.

A byte is eight binary choices, one after another; each of the 255 choices has a context tree of its own, whose contexts are the bytes
before. Every node has Krichevsky-Trofimov estimates of its counts; the weighted probability of an
inner node is half its own estimate and half the product of its children's. A choice's probability mixes the estimates of all
depths along its context, each node by how much its own estimate explains the training bytes better than its children do.

All follows from the counts of windows of depth + 1 bytes. Texts lie in shards of bounded size; a shard asks once for each of its
distinct windows (training counts included, zero for windows that only held-out texts have) and once for each of its
distinct words. Questions and answers travel as packed arrays, by bucket of the window or word, so that what is
moved is small beside the texts and a common window costs a bucket one entry per shard. Windows are counted over the whole
corpus and dealt by their three latest context bytes: what lies deeper is solved within a task, upwards; the few levels above are solved per choice (at most 65,536 contexts each) and
go back down to the tasks, which give every window its probability. Answers return to the shards, and texts are scored there.
Nothing is broadcast, and no count, context or window is dropped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from roadgauge.llm import common
from roadgauge.session import scratch_dir, stage

DEPTH = 5
#: Levels above this one are solved per choice, those below by context.
SPLIT = 3
SHARD_BYTES = 32 << 20
PACK_BYTES = 1 << 20
#: Distinct windows that one task solves together.
TASK_WINDOWS = 1_000_000
#: Bytes of text per bucket of windows and words; a bucket's task sees what all shards ask of it.
BUCKET_BYTES = 64 << 20
#: Bytes of text per byte of a pack, about.
TEXT_PER_PACKED = 3
END = b"\n"
PACKS = "shard long, doc_ids binary, known binary, held_out binary, sizes binary, data binary"
ASKED = "bucket int, shard long, is_word boolean, keys binary, train binary"
ANSWERS = "shard long, is_word boolean, keys binary, found binary"
NODES = "node int, context long, zeros long, ones long, log_weighted double"
TOPS = "node int, context long, own double, passed double"
SCORED = "bucket int, grams binary, log_p binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def normalised(text: bytes) -> bytes:
    """Words with A-Z lowered, a space after each, then the end mark. Words hold neither, so this loses nothing of the tokens."""
    words = text.lower().split()
    return b" ".join([*words, END]) if words else END


def grams_of(docs: list[bytes], depth: int) -> np.ndarray:
    """The window of every byte of each text: the byte in the lowest place, the latest context byte in the highest.

    Before a text lie end marks.
    """
    pad = END * depth
    data = np.frombuffer(b"".join([pad + doc for doc in docs]), np.uint8).astype(np.int64)
    sizes = np.array([len(doc) for doc in docs], np.int64)
    starts = np.cumsum(sizes + depth) - sizes - depth
    n = len(data) - depth
    grams = data[depth:].copy()
    for back in range(1, depth + 1):
        grams |= data[depth - back:depth - back + n] << np.int64(8 * (depth + 1 - back))
    inside = np.ones(len(data), bool)
    inside[(starts[:, None] + np.arange(depth)).ravel()] = False
    return grams[inside[depth:]]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for positive x: Stirling's series, after a shift by eight if x is small."""
    small = x < 8
    y = np.where(small, x + 8, x)
    inverse = 1 / (y * y)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse * (1 / 1680 - inverse / 1188)))) / y
    value = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    shift = np.ones_like(y)
    for i in range(8):
        shift *= np.where(small, x + i, 1.0)
    return value - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def weigh(zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logarithm of the weighted probability, share of the own estimate, own probability of a one) of nodes.

    children: summed logarithms of their children's weighted probabilities; None at the deepest level.
    """
    zeros, ones = zeros.astype(np.float64), ones.astype(np.float64)
    own, one = log_kt(zeros, ones), (ones + 0.5) / (zeros + ones + 1.0)
    if children is None:
        return own, np.ones(len(own)), one
    share = 1 / (1 + np.exp(np.clip(children - own, -700, 700)))
    return math.log(0.5) + np.logaddexp(own, children), share, one


class Branch:
    """One binary choice over the contexts of some windows, from the deepest level up to a given one."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, choice: int, depth: int, top: int):
        byte = grams & 255
        self.bit = (byte >> (7 - choice)) & 1
        ids, self.of_gram = np.unique((grams & ~np.int64(255)) | (byte >> (8 - choice)), return_inverse=True)
        zeros = self._sum(self.of_gram, counts * (1 - self.bit), len(ids))
        ones = self._sum(self.of_gram, counts * self.bit, len(ids))
        self.levels, children = [], None
        for level in range(depth, top - 1, -1):
            weighted, share, one = weigh(zeros, ones, children)
            self.ids, self.zeros, self.ones, self.weighted = ids, zeros, ones, weighted
            if level == top:
                self.levels.append((share, one, None))
                break
            parents, above = np.unique(ids & ~np.int64(255 << (8 * (depth + 1 - level))), return_inverse=True)
            self.levels.append((share, one, above))
            children = np.bincount(above, weighted, len(parents))
            zeros, ones, ids = (*(self._sum(above, x, len(parents)) for x in (zeros, ones)), parents)

    @staticmethod
    def _sum(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size, np.int64)
        np.add.at(out, index, values)
        return out

    def down(self, own: np.ndarray, passed: np.ndarray) -> np.ndarray:
        """Probability of each window's bit. own, passed: for the nodes of the top level, the probability of a one from the levels
        above, and the weight they leave to this level."""
        for share, one, above in reversed(self.levels):
            if above is not None:
                own, passed = own[above], passed[above]
            own, passed = own + passed * share * one, passed * (1 - share)
        one = own[self.of_gram]
        return np.where(self.bit == 1, one, 1 - one)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised texts in compressed packs, several of which make up a shard."""
    from pyspark import TaskContext

    shard, in_shard = TaskContext.get().partitionId() << 32, 0
    ids, known, held, docs, size = [], [], [], [], 0

    def made() -> pa.RecordBatch:
        row = (shard, np.array(ids, "<i8").tobytes(), bytes(known), bytes(held),
               np.array([len(d) for d in docs], "<i8").tobytes(), zstandard.compress(b"".join(docs), 1))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds)],
                                          [column.split()[0] for column in PACKS.split(", ")])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for doc_id, text, out in zip(batch.column("doc_id").to_pylist(), texts, batch.column("held_out").to_pylist()):
            ids.append(doc_id or 0)
            known.append(doc_id is not None)
            held.append(bool(out))
            docs.append(normalised(text or b""))
            size += len(docs[-1])
            if size >= PACK_BYTES:
                yield made()
                in_shard += size
                ids, known, held, docs, size = [], [], [], [], 0
                if in_shard >= SHARD_BYTES:
                    shard, in_shard = shard + 1, 0
    if docs:
        yield made()


def unpacked(sizes: bytes, data: bytes) -> list[bytes]:
    blob, out, at = zstandard.decompress(data), [], 0
    for size in np.frombuffer(sizes, "<i8").tolist():
        out.append(blob[at:at + size])
        at += size
    return out


def _parts(order: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places) of the buckets that occur."""
    places = np.argsort(order, kind="stable")
    edges = np.searchsorted(order[places], np.arange(buckets + 1))
    for bucket in range(buckets):
        if edges[bucket] < edges[bucket + 1]:
            yield bucket, places[edges[bucket]:edges[bucket + 1]]


def gram_buckets(grams: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def word_bucket(word: bytes, buckets: int) -> int:
    return xxhash.xxh64_intdigest(word) % buckets


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising integers as compressed differences."""
    return zstandard.compress(np.diff(values, prepend=0).astype("<i8").tobytes(), 1)


def sorted_values(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), "<i8"))


def pack_words(words: list[bytes]) -> bytes:
    """Words hold no line ends. The end mark is told by an empty word."""
    return zstandard.compress(b"\n".join(b"" if word == END else word for word in words), 1)


def words_of(data: bytes) -> list[bytes]:
    return [word or END for word in zstandard.decompress(data).split(b"\n")]


def pack_counts(counts: np.ndarray) -> bytes:
    return zstandard.compress(counts.astype("<i8").tobytes(), 1)


def counts_of(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i8")


def _asks(depth: int, buckets: int):
    """Distinct windows and words of each shard, with their counts in its training texts, as packed arrays by bucket."""
    def rows(shard: int, words: Counter, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        grams, counts = _merged(found)
        out = [(bucket, shard, False, pack_sorted(grams[at]), pack_counts(counts[at]))
               for bucket, at in _parts(gram_buckets(grams, buckets), buckets)]
        by_bucket: dict[int, list[bytes]] = {}
        for word in words:
            by_bucket.setdefault(word_bucket(word, buckets), []).append(word)
        out += [(bucket, shard, True, pack_words(own), pack_counts(np.array([words[word] for word in own])))
                for bucket, own in ((bucket, sorted(own)) for bucket, own in by_bucket.items())]
        yield _table(ASKED, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, words, found = None, Counter(), []
        for batch in batches:
            for pack in batch.to_pylist():
                if shard is not None and pack["shard"] != shard:
                    yield from rows(shard, words, found)
                    words, found = Counter(), []
                shard = pack["shard"]
                docs, held = unpacked(pack["sizes"], pack["data"]), pack["held_out"]
                for out in (0, 1):
                    own = [doc for doc, flag in zip(docs, held) if flag == out]
                    if own:
                        grams, counts = np.unique(grams_of(own, depth), return_counts=True)
                        found.append((grams, np.zeros_like(counts) if out else counts))
                        tokens = b"".join(own).split()
                        if out:
                            words.update(dict.fromkeys(tokens, 0))
                        else:
                            words.update(tokens)
                        words[END] += 0 if out else len(own)
                if len(found) > 16:
                    found = [_merged(found)]
        if shard is not None:
            yield from rows(shard, words, found)

    return run


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
    fields = [column.split() for column in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows and the sums of their counts."""
    grams, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.add.reduceat(counts, first)


def _count_grams(asked: pa.Table) -> pa.Table:
    """A bucket's windows with their counts in the whole corpus."""
    pairs = zip(asked.column("keys").to_pylist(), asked.column("train").to_pylist())
    grams, counts = _merged([(sorted_values(keys), counts_of(train)) for keys, train in pairs])
    return pa.table({"gram": grams, "train": counts})


def _count_words(asked: pa.Table) -> pa.Table:
    """For each shard the corpus counts of its words of a bucket; and once, without a shard, how many words and occurrences there are."""
    totals: dict[bytes, int] = {}
    lists = [words_of(keys) for keys in asked.column("keys").to_pylist()]
    for words, train in zip(lists, asked.column("train").to_pylist()):
        for word, count in zip(words, counts_of(train).tolist()):
            totals[word] = totals.get(word, 0) + count
    rows = [(shard, True, keys, pack_counts(np.array([totals[word] for word in words])))
            for shard, keys, words in zip(asked.column("shard").to_pylist(), asked.column("keys").to_pylist(), lists)]
    rows.append((None, True, None, pack_counts(np.array([sum(n > 0 for n in totals.values()), sum(totals.values())]))))
    return pa.Table.from_batches([_table(ANSWERS, rows)])


def _answer_grams(asked: pa.Table, scores: pa.Table) -> pa.Table:
    """For each shard the scores of its windows of a bucket."""
    grams = np.concatenate([sorted_values(x) for x in scores.column("grams").to_pylist()])
    log_p = np.concatenate([np.frombuffer(x, "<f8") for x in scores.column("log_p").to_pylist()])
    order = np.argsort(grams)
    grams, log_p = grams[order], log_p[order]
    rows = [(shard, False, keys, log_p[np.searchsorted(grams, sorted_values(keys))].tobytes())
            for shard, keys in zip(asked.column("shard").to_pylist(), asked.column("keys").to_pylist())]
    return pa.Table.from_batches([_table(ANSWERS, rows)])


def _columns(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    """Whole columns of a partition; nulls as zero."""
    parts = [[batch.column(name).fill_null(0).to_numpy(zero_copy_only=False) for name in names] for batch in batches if batch.num_rows]
    return [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0, np.int64) for _ in names]


def _solve_up(depth: int):
    """Nodes of the split level, each complete, as a context's windows are all in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = _columns(batches, "gram", "train")
        for choice in range(8 if len(grams) else 0):
            branch = Branch(grams, counts, choice, depth, SPLIT)
            nodes = (1 << choice) | (branch.ids & 255)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.astype(np.int32)), pa.array(branch.ids >> (8 * (depth + 1 - SPLIT))), pa.array(branch.zeros),
                 pa.array(branch.ones), pa.array(branch.weighted)],
                ["node", "context", "zeros", "ones", "log_weighted"])

    return run


def _solve_tops(table: pa.Table) -> pa.Table:
    """The levels above the split of one choice: at most 256^(SPLIT - 1) contexts. Returns what reaches the split level."""
    contexts, zeros, ones, children = (table.column(name).to_numpy() for name in ("context", "zeros", "ones", "log_weighted"))
    order = np.argsort(contexts)
    contexts, zeros, ones, children = contexts[order], zeros[order], ones[order], children[order]
    levels, ids = [], contexts
    for level in range(SPLIT - 1, -1, -1):
        weighted, share, one = weigh(zeros, ones, children)
        parents, above = np.unique(ids >> 8, return_inverse=True)
        levels.append((share, one, above if level else None))
        children = np.bincount(above, weighted, len(parents))
        zeros, ones, ids = (*(Branch._sum(above, x, len(parents)) for x in (zeros, ones)), parents)
    own, passed = np.zeros(1), np.ones(1)
    for share, one, above in reversed(levels):
        if above is not None:
            own, passed = own[above], passed[above]
        own, passed = own + passed * share * one, passed * (1 - share)
    return pa.table({
        "node": pa.array(np.full(len(contexts), table.column("node")[0].as_py(), np.int32)), "context": pa.array(contexts),
        "own": pa.array(own), "passed": pa.array(passed)})


def _solve_down(depth: int, buckets: int):
    """log10 of the probability of every window of a task, packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, key, counts, own, passed = _columns(batches, "node", "key", "train", "own", "passed")
        top = node > 0
        grams, counts, total = key[~top], counts[~top], 0.0
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        ids = (key[top] << 8) | node[top]
        order = np.argsort(ids)
        ids, own, passed = ids[order], own[top][order], passed[top][order]
        if not len(grams):
            return
        for choice in range(8):
            branch = Branch(grams, counts, choice, depth, SPLIT)
            split = branch.ids >> (8 * (depth + 1 - SPLIT)) << 8
            at = np.searchsorted(ids, split | (1 << choice) | (branch.ids & 255))
            total = total + np.log10(branch.down(own[at], passed[at]))
        yield _table(SCORED, [
            (bucket, pack_sorted(grams[at]), total[at].tobytes()) for bucket, at in _parts(gram_buckets(grams, buckets), buckets)])

    return run


def gram_scores(grams: DataFrame, buckets: int, depth: int = DEPTH) -> DataFrame:
    """bucket, grams, log_p (packed): log10 of the probability of each window's byte after its context.

    grams: gram (distinct), train (its count in the training texts, possibly zero).
    """
    rows = grams.count()
    split = 8 * (depth + 1 - SPLIT)
    tasks = max(int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_WINDOWS))
    up = grams.repartition(tasks, F.shiftright("gram", split)).mapInArrow(_solve_up(depth), NODES)
    nodes = stage(up, "context-nodes")
    tops = (
        nodes.groupBy("node", F.shiftright("context", 8).alias("context"))
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_weighted").alias("log_weighted"))
        .groupBy("node").applyInArrow(_solve_tops, TOPS))
    tops = stage(tops.withColumnRenamed("context", "above").withColumnRenamed("node", "choice"), "context-tops")
    reached = nodes.join(tops, (F.col("node") == F.col("choice")) & (F.shiftright("context", 8) == F.col("above"))).select(
        "node", F.col("context").alias("key"), F.lit(0).cast("long").alias("train"), "own", "passed")
    asked = grams.select(
        F.lit(0).alias("node"), F.col("gram").alias("key"), "train", F.lit(0.0).alias("own"), F.lit(0.0).alias("passed"))
    context = F.when(F.col("node") > 0, F.col("key")).otherwise(F.shiftright("key", split))
    return asked.unionByName(reached).repartition(tasks, context).mapInArrow(_solve_down(depth, buckets), SCORED)


def _score(depth: int, train_tokens: int, distinct: int):
    whole = math.log10(train_tokens + distinct + 1)

    def run(packs: pa.Table, answers: pa.Table) -> pa.Table:
        counts: dict[bytes, int] = {}
        asked, values = [], []
        for row in answers.to_pylist():  # a shard that was read by two tasks has asked twice, and some things twice
            if row["is_word"]:
                counts.update(zip(words_of(row["keys"]), counts_of(row["found"]).tolist()))
            else:
                asked.append(sorted_values(row["keys"]))
                values.append(np.frombuffer(row["found"], "<f8"))
        gram, first = np.unique(np.concatenate(asked), return_index=True)
        index, log_p = pd.Index(gram), np.concatenate(values)[first]
        out = {name.split()[0]: [] for name in SCORES.split(", ")}
        for pack in packs.to_pylist():
            docs = unpacked(pack["sizes"], pack["data"])
            places = index.get_indexer(grams_of(docs, depth))
            if places.min() < 0:
                raise ValueError("a window of a shard has no answer")
            sizes = np.array([len(doc) for doc in docs])
            out["score"] += np.add.reduceat(log_p[places], np.cumsum(sizes) - sizes).tolist()
            ids = np.frombuffer(pack["doc_ids"], "<i8").tolist()
            out["doc_id"] += [doc_id if known else None for doc_id, known in zip(ids, pack["known"])]
            out["held_out"] += [bool(flag) for flag in pack["held_out"]]
            numbers: dict[bytes, int] = {END: 0}
            flat, lengths = [], []
            for doc in docs:
                tokens = doc.split()
                flat += [numbers.setdefault(token, len(numbers)) for token in tokens]
                flat.append(0)
                lengths.append(len(tokens) + 1)
            count = np.array([counts[word] for word in numbers])[np.array(flat)]
            begins = np.cumsum(lengths) - lengths
            out["n_tokens"] += lengths
            out["n_known"] += np.add.reduceat((count > 0).astype(np.int64), begins).tolist()
            out["base_score"] += (np.add.reduceat(np.log10(count + 1.0), begins) - np.array(lengths) * whole).tolist()
        out["train_tokens"] = [train_tokens] * len(out["score"])
        kinds = {"held_out": pa.bool_(), "base_score": pa.float64(), "score": pa.float64()}
        return pa.table({name: pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()})

    return run


def score_texts(docs: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    docs: doc_id, text; held_out: which rows are not learnt from (null: learnt from). A null or empty text is the end mark alone.
    Repeated rows and null ids are scored each, and learnt from each. score is the model's log10 probability
    of the text's words and end; base_score that of smoothed word counts. Without training rows every bit has probability 1/2, and
    every token base score 0. An empty table gives no rows. A text must fit a task; a group holds one shard. depth: 3 to 7.
    """
    if not SPLIT <= depth <= 7:
        raise ValueError(f"depth must lie between {SPLIT} and 7")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"))
    packs = stage(narrow.mapInArrow(_pack, PACKS), "packs")
    size = packs.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0] * TEXT_PER_PACKED
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    asked = stage(packs.mapInArrow(_asks(depth, buckets), ASKED), "asked")

    words = stage(asked.where("is_word").groupBy("bucket").applyInArrow(_count_words, ANSWERS), "words")
    stats = words.where("shard is null").select("found").collect()  # one row per bucket
    v, n = np.sum([counts_of(row.found) for row in stats], axis=0).tolist() if stats else (0, 0)

    wanted = asked.where("not is_word")
    grams = stage(wanted.groupBy("bucket").applyInArrow(_count_grams, "gram long, train long"), "grams")
    scores = stage(gram_scores(grams, buckets, depth), "gram-scores")
    answers = wanted.groupBy("bucket").cogroup(scores.groupBy("bucket")).applyInArrow(_answer_grams, ANSWERS)
    answers = answers.unionByName(words.where("shard is not null"))
    return packs.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_score(depth, n, v), SCORES)
