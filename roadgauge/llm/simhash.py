"""SimHash near-duplicates found with BK-trees.

Two 64-bit fingerprints that differ in at most 3 bits agree on at least two of five blocks of bits. Distinct
fingerprints are therefore dealt to shards by each pair of blocks and their bits; every link lies in some shard. A task builds
a shard's BK-tree (children keyed by their integer Hamming distance to the parent) and follows only edges within the
radius. Shards meet their queries in a shuffle; a broadcast of all trees would grow with the data. A shard of
more than SHARD_ROWS fingerprints is split into parts, and a tree is built for each pair of parts, so no tree holds more than
two parts. A task reports links as stars below its smallest fingerprints: never all pairs.

near_duplicates links fingerprints of three-word shingles within 3 bits; near_groups links texts of similarity 0.8 or more, without trees.
survivors takes both.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadgauge.llm import common, similar_sets
from roadgauge.llm.components import components
from roadgauge.session import stage

RADIUS = 3
SHARD_ROWS = 4096
#: (first bit, bits) of the five blocks
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
AGREEING = 2
SEED = 42
SHINGLE_WORDS = 3


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of the shingles of a text, in order, repeats included. Fewer words than size: the whole sequence."""
    from xxhash import xxh64_intdigest as hashed

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= size:
        return np.array([hashed(b" ".join(words), SEED)] if words else [], "<u8")
    whole = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    return np.array([hashed(whole[i:j], SEED) for i, j in zip(starts, ends[size - 1:].tolist())], "<u8")


def folded(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes. No hashes: zero."""
    counts, step = np.zeros(64, np.int64), 1 << 14  # bounded memory for very long texts
    for i in range(0, len(hashes), step):
        counts += np.unpackbits(hashes[i:i + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str) -> int:
    return folded(shingle_hashes(text, SHINGLE_WORDS))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (a signed long) of every row. A null text has no words."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(text or "") for text in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return common.map_batches(common.id_and_text(docs), run, "doc_id long, fp long")


class BKTree:
    """Entries (fingerprint, ...) in nodes; each node's children are keyed by their Hamming distance to it.

    Entries can be taken out. A node knows how many entries are left at and below it, and empty branches are not followed.
    """

    VALUE, CHILDREN, ENTRIES, LEFT, PARENT = range(5)

    def __init__(self):
        self.root: list | None = None

    def add(self, entry: tuple) -> list:
        """Returns the node that holds the entry."""
        value = entry[0]
        if self.root is None:
            self.root = [value, {}, [], 0, None]
        node = self.root
        while True:
            node[self.LEFT] += 1
            d = (node[self.VALUE] ^ value).bit_count()
            if d == 0:
                break
            child = node[self.CHILDREN].get(d)
            if child is None:
                child = node[self.CHILDREN][d] = [value, {}, [], 0, node]
            node = child
        node[self.ENTRIES].append(entry)
        return node

    def take(self, node: list, entry: tuple) -> None:
        node[self.ENTRIES].remove(entry)
        while node is not None:
            node[self.LEFT] -= 1
            node = node[self.PARENT]

    def near(self, value: int, radius: int) -> list[tuple[list, tuple]]:
        """(node, entry) of the entries left within the radius."""
        found, todo = [], [self.root] if self.root and self.root[self.LEFT] else []
        while todo:
            node = todo.pop()
            other, children, entries, left, _ = node
            d = (other ^ value).bit_count()
            if entries and d <= radius:
                found += [(node, entry) for entry in entries]
            if left > len(entries):
                todo += [child for e, child in children.items() if d - radius <= e <= d + radius and child[3]]
        return found


def unit_links(entries: list[tuple], radius: int, alike=None) -> list[tuple[int, int]]:
    """(node, smallest node reached) of one shard unit. Entries are (fingerprint, node, more); alike compares the more of two.

    Each component is walked from one entry to its neighbours, which leave the tree as they are reached. In a dense group
    of copies one search empties the tree, instead of every entry finding every other.
    """
    tree, made = BKTree(), []
    places = [(tree.add(entry), entry) for entry in entries]
    reached: set[int] = set()
    for node, entry in places:
        if id(entry) in reached:
            continue
        tree.take(node, entry)
        reached.add(id(entry))
        members, todo = [entry[1]], [entry]
        while todo:
            asking = todo.pop()
            for other_node, other in tree.near(asking[0], radius):
                if alike is None or alike(asking[2], other[2]):
                    tree.take(other_node, other)
                    reached.add(id(other))
                    members.append(other[1])
                    todo.append(other)
        if len(members) > 1:
            low = min(members)
            made += [(x, low) for x in members if x != low]
    return made


def _keys():
    """Shard keys of fp: the pair of blocks and their bits."""
    bits = [F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1)) for at, n in BLOCKS]
    keys = []
    for number, (i, j) in enumerate(combinations(range(len(BLOCKS)), AGREEING)):
        keys.append(F.shiftleft(F.shiftleft(F.lit(number).cast("long"), 13).bitwiseOR(bits[i]), 13).bitwiseOR(bits[j]))
    return F.array(*keys)


def links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Stars (a, b) over distinct fingerprints fp whose components are those of all links within the radius."""
    if radius > RADIUS:
        raise ValueError("five blocks guarantee two agreeing ones up to a radius of 3")
    keyed = distinct.select(F.explode(_keys()).alias("key"), "fp", F.col("fp").alias("node"), F.lit(None).cast("binary").alias("more"))
    return shard_links(keyed, radius, shard_rows, None, unsigned=True)


def shard_links(keyed: DataFrame, radius: int, shard_rows: int, alike, unsigned: bool = False) -> DataFrame:
    """Stars (a, b) over nodes linked within any shard. keyed: key, fp, node, more.

    unsigned: nodes are compared as unsigned numbers.
    """
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = keyed.join(sizes, "key").withColumn("parts", F.ceil(F.col("n") / shard_rows).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    units = parts.withColumn("own", own).select(
        "key", "fp", "node", "more", "own", F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
    ).select("key", F.least("own", "part").alias("one"), F.greatest("own", "part").alias("other"), "fp", "node", "more")
    mask = 0xFFFFFFFFFFFFFFFF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, entries, made = None, [], []

        def close() -> None:
            if at is not None and len(entries) > 1:
                made.extend(unit_links(entries, radius, alike))

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("key", "one", "other", "fp", "node", "more")]
            for key, one, other, fp, node, more in zip(*columns):
                if at != (key, one, other):
                    close()
                    at, entries = (key, one, other), []
                entries.append((fp & mask, node & mask if unsigned else node, more))
            if made:
                yield to_edges(made, unsigned)
                made = []
        close()
        if made:
            yield to_edges(made, unsigned)

    dealt = units.repartition("key", "one", "other").sortWithinPartitions("key", "one", "other", "fp", "node")
    return dealt.mapInArrow(run, "a long, b long")


def to_edges(made: list[tuple[int, int]], unsigned: bool) -> pa.RecordBatch:
    values = np.array(made, np.uint64 if unsigned else np.int64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(values[:, 0].copy()), pa.array(values[:, 1].copy())], ["a", "b"])


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id of every row: the smallest doc_id reachable over links within the radius.

    Rows without words share the fingerprint zero. Null ids are ignored as component ids; a component
    of null ids alone has none. An empty table gives no rows.
    """
    rows = stage(fingerprints(docs), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_rows")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius))
    linked = roots.join(distinct, F.col("a") == F.col("fp")).select("fp", "root", "first_id")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = linked.join(lowest, "root").select("fp", "component_id")
    named = stage(
        distinct.join(labelled, "fp", "left").select("fp", "n_rows", F.coalesce("component_id", "first_id").alias("component_id")),
        "fingerprint-components")
    return common.join_spread(rows, named, "fp", "n_rows").select("doc_id", "fp", "component_id")


def near_groups(docs: DataFrame, unit_shingles: int = similar_sets.UNIT_SHINGLES) -> DataFrame:
    """(a, root): documents with a near duplicate of similarity 0.8 or more over five-word shingles, and the smallest id of their group.

    Such texts differ in about 10 of 64 bits, more than blocks of bits can find; they are found by their sets of shingles, exactly.
    """
    return similar_sets.similar_groups(docs, unit_shingles)


def survivors(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates, all columns unchanged.

    Near duplicates are linked by their fingerprints, within the radius and by BK-trees, and by their sets of shingles, which find those
    farther apart, too; a group is what either link reaches. Rows that repeat a doc_id are one document and stay or go together. Rows
    without doc_id have no identity and all stay.
    """
    by_prints = near_duplicates(docs.where("doc_id is not null")).select(
        F.col("doc_id").cast("long").alias("a"), F.col("component_id").cast("long").alias("b")).where("a <> b")
    by_sets = near_groups(docs).where("a <> root").select("a", F.col("root").alias("b"))
    groups = components(stage(by_prints.union(by_sets).distinct(), "near-links-of-both"))
    gone = groups.where("a <> root").select(F.col("a").alias("__id")).distinct()
    named = docs.withColumn("__id", F.col("doc_id").cast("long"))
    return named.join(gone, "__id", "left_anti").select(*docs.columns)
