"""Texts whose sets of five-word shingles are at least 4/5 alike (shared share of all shingles), found exactly.

In any one order of all shingles, two such texts share one among the first n - ceil(4n/5) + 1 of their n shingles each (prefix
filtering), and in prefixes longer by k - 1 at least k. Two orders are used, one after the other. In hash order the longer prefix is the
smallest three tenths of the hashes; texts with fewer shingles of it in other prefixes than any alike text shares are done. For the others all shingles are counted, and the prefix is taken in order of rarity;
shingles of one text alone come first and propose nothing.

A shingle's bucket holds the texts with it in their prefix; buckets with the same texts are one. First every text is compared with its
bucket's smallest one, by a join with the whole sets. Buckets whose other texts are then not yet in one component are searched
in units of bounded size: components are walked, and only pairs of different components are compared, on whole sets.
No likeness is estimated anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadgauge.llm import common
from roadgauge.llm.components import components
from roadgauge.session import stage

SHINGLE_WORDS = 5
#: Shingles of a part of a bucket; a unit of work holds two parts.
UNIT_SHINGLES = 500_000


def prefix_length(n):
    """Of n shingles, a number or a column. Any text at least 4/5 alike shares one of so many first ones."""
    if isinstance(n, int):
        return n - (4 * n + 4) // 5 + 1
    return n - F.floor((4 * n + 4) / 5) + 1


def more(n: int) -> int:
    """Prefixes this much longer, less one, share at least so many shingles; it never falls as n rises."""
    return max(1, n // 10)


def shingle_set(text: str) -> np.ndarray:
    """Distinct shingle hashes, ascending. A text without words has the one shingle 0."""
    from roadgauge.llm.simhash import shingle_hashes

    hashes = np.unique(shingle_hashes(text, SHINGLE_WORDS))
    return hashes if len(hashes) else np.zeros(1, "<u8")


def _sets(docs: DataFrame, whole: bool) -> DataFrame:
    """doc_id, set_id, n, need and hashes (all, or those of the longer prefix in hash order) of every row. Equal sets have equal ids.

    need: the least number of prefix shingles that any alike text has in its own prefix; such a text has 4n/5 shingles or more.
    """
    from xxhash import xxh64_intdigest

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(text or "") for text in batch.column("text").to_pylist()]
        ids = np.array([xxh64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)
        sizes = np.array(list(map(len, sets)), np.int64)
        parts = sets if whole else [x[:prefix_length(len(x)) + more(len(x)) - 1] for x in sets]
        ends = np.cumsum([0, *map(len, parts)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))
        need = pa.array([more((4 * len(x) + 4) // 5) for x in sets], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids), pa.array(sizes), need, lists], ["doc_id", "set_id", "n", "need", "hashes"])

    return common.map_batches(docs, run, "doc_id long, set_id long, n long, need long, hashes array<long>")


def unit_links(entries: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """(set_id, smallest set_id reached) over (set_id, component, hashes) of one unit; sets of one component are linked already.

    A component is walked from one set; what it reaches leaves the unit with its own component. A set asks either the lists
    of its shingles or the hashes of the sets left, whichever are shorter.
    """
    ids = np.array([e[0] for e in entries])
    labels = np.unique(np.array([e[1] for e in entries]), return_inverse=True)[1]
    sizes = np.array([len(e[2]) for e in entries])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    codes = np.unique(np.concatenate([e[2] for e in entries]), return_inverse=True)[1]
    owners = np.repeat(np.arange(len(ids)), sizes)[np.argsort(codes, kind="stable")]
    listed = np.bincount(codes)
    list_starts = np.cumsum(listed) - listed
    marked = np.zeros(len(listed), bool)
    left, made = np.ones(len(ids), bool), []

    def alike(x: int) -> np.ndarray:
        """Sets left that are at least 4/5 alike to set x."""
        n = sizes[x]
        others = np.flatnonzero(left & (5 * np.minimum(sizes, n) >= 4 * np.maximum(sizes, n)))
        if not len(others):
            return others
        own = codes[starts[x]:ends[x]]
        if listed[own].sum() < sizes[others].sum():
            lengths = listed[own]
            steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            shared = np.bincount(owners[np.repeat(list_starts[own], lengths) + steps], minlength=len(ids))[others]
        else:
            lengths = sizes[others]
            begins = np.cumsum(lengths) - lengths
            places = np.repeat(starts[others] - begins, lengths) + np.arange(lengths.sum())
            marked[own] = True
            shared = np.add.reduceat(marked[codes[places]].astype(np.int64), begins)
            marked[own] = False
        return others[9 * shared >= 4 * (n + sizes[others])]

    for first in range(len(ids)):
        if not left[first]:
            continue
        todo = np.flatnonzero(left & (labels == labels[first])).tolist()
        left[todo] = False
        members = list(todo)
        while todo and left.any():
            reached = alike(todo.pop())
            if len(reached):
                more = np.flatnonzero(left & np.isin(labels, labels[reached])).tolist()
                left[more] = False
                members += more
                todo += more
        low = min(ids[members].tolist())
        made += [(x, low) for x in ids[members].tolist() if x != low]
    return made


def _bucket_links(rows: DataFrame, unit_shingles: int) -> DataFrame:
    """Stars (a, b) whose components, with those of the labels, are those of all links in any bucket. rows: key, set_id, n, label, hashes."""
    sizes = rows.groupBy("key").agg(F.ceil(F.sum("n") / unit_shingles).cast("int").alias("parts"))
    parts = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"))
    units = parts.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "key", F.least("own", "part").alias("one"), F.greatest("own", "part").alias("other"), "set_id", "label", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, entries, made = None, [], []

        def close() -> None:
            if len(entries) > 1:
                made.extend(unit_links(entries))

        for batch in batches:
            hashes = batch.column("hashes")
            values, offsets = hashes.values.to_numpy(), hashes.offsets.to_numpy()
            heads = zip(*(batch.column(name).to_pylist() for name in ("key", "one", "other", "set_id", "label")))
            for i, (key, one, other, set_id, label) in enumerate(heads):
                if at != (key, one, other):
                    close()
                    at, entries = (key, one, other), []
                entries.append((set_id, label, values[offsets[i]:offsets[i + 1]].copy()))
            if made:
                yield edges(made)
                made = []
        close()
        if made:
            yield edges(made)

    def edges(made: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*made)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return units.repartition("key", "one", "other").sortWithinPartitions("key", "one", "other", "set_id").mapInArrow(run, "a long, b long")


def set_components(sets: DataFrame, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """(a, root) of the distinct sets (set_id, n, hashes) that have a link, as components() gives them."""
    shingles = sets.select("set_id", "n", F.explode("hashes").alias("hash"))
    counts = shingles.groupBy("hash").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    shared = shingles.join(counts, "hash").groupBy("set_id", "n").agg(F.array_sort(F.collect_list(F.struct("count", "hash"))).alias("shared"))
    # shingles of one set alone are the rarest and fill the prefix first
    first = prefix_length(F.col("n")) - (F.col("n") - F.size("shared"))
    keyed = stage(shared.withColumn("first", first.cast("int")).where("first > 0").select(
        "set_id", "n", F.explode(F.slice("shared", F.lit(1), F.col("first"))).alias("at")).select(F.col("at.hash").alias("key"), "set_id", "n"), "near-keys")
    # bucket contents are told apart by two 64-bit hashes; equal buckets are kept once
    buckets = keyed.groupBy("key").agg(
        F.min(F.struct("set_id", "n")).alias("lead"), F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64("set_id")).alias("one"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("other")).where("rows > 1")
    buckets = buckets.groupBy("lead", "rows", "one", "other").agg(F.min("key").alias("key"))
    held = stage(keyed.join(buckets.select("key", "lead"), "key").where(F.col("set_id") != F.col("lead.set_id")), "near-buckets")

    proposed = held.where(5 * F.least("n", "lead.n") >= 4 * F.greatest("n", "lead.n")).select(
        F.col("lead.set_id").alias("a"), F.col("set_id").alias("b")).distinct()
    one = sets.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("hashes_a"))
    other = sets.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("hashes_b"))
    links = stage(proposed.join(one, "a").join(other, "b").where(
        9 * F.size(F.array_intersect("hashes_a", "hashes_b")) >= 4 * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "near-links")

    roots = stage(components(links), "near-roots")
    labelled = held.join(roots.withColumnRenamed("a", "set_id"), "set_id", "left").select("key", "set_id", F.coalesce("root", "set_id").alias("label"))
    labelled = stage(labelled, "near-labels")
    unsettled = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    rest = labelled.join(unsettled, "key").join(sets, "set_id").select("key", "set_id", "n", "label", "hashes")
    return components(links.union(_bucket_links(rest, unit_shingles)))


def similar_groups(docs: DataFrame, unit_shingles: int = UNIT_SHINGLES) -> DataFrame:
    """(a, root): documents linked to another one, by equal or alike sets, and the smallest id of their group.

    Rows with a null id take no part; rows that repeat an id are one document.
    """
    rows = common.id_and_text(docs).where("doc_id is not null")
    made = stage(_sets(rows, False).withColumn("row", F.monotonically_increasing_id()), "near-prefixes")
    keys = made.select("row", F.explode("hashes").alias("hash"))
    shared = keys.groupBy("hash").agg(F.count(F.lit(1)).alias("count")).where("count > 1").select("hash")
    met = keys.join(shared, "hash").groupBy("row").agg(F.count(F.lit(1)).alias("met"))
    live = stage(made.select("row", "set_id", "need").join(met, "row").where("met >= need").select("set_id").distinct(), "near-live")
    # of each set that may have links one document is read again
    readers = made.join(live, "set_id").groupBy("set_id").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    whole = _sets(rows.join(readers, "doc_id", "left_semi"), True)
    sets = stage(whole.groupBy("set_id").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")).join(live, "set_id", "left_semi"), "near-sets")
    roots = set_components(sets, unit_shingles)

    labelled = stage(made.select("doc_id", "set_id").join(roots.withColumnRenamed("a", "set_id"), "set_id", "left").select(
        "doc_id", F.coalesce("root", "set_id").alias("label")), "near-documents")
    lowest = labelled.groupBy("label").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("high")).where("b < high").select("label", "b")
    return components(labelled.join(lowest, "label").select(F.col("doc_id").alias("a"), "b"))
