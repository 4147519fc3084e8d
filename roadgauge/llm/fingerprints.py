"""Document fingerprints by a randomised edit embedding.

A walk reads a text: at step j it looks at the current character and a random bit, shared by all texts, of (j, character)
says whether to move on. Two texts with few edits fall into step again after each edit, so their walks
see mostly the same characters: edit distance becomes Hamming distance. A text of n characters is walked for 2n
steps, the expected length. The fingerprint samples SAMPLES steps of the walk, a nibble of a hash of the character seen there.

Sampled steps are consistent over lengths: each sample follows one random sequence of record places, so it is uniform over
the walk, and texts of nearly equal length sample the same steps. The whole text is walked.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadgauge.llm import common
from roadgauge.llm.components import components
from roadgauge.session import stage

SAMPLES = 64
#: The walk's random bits repeat after PERIOD steps; characters share CLASSES rows of bits.
PERIOD, CLASSES = 4096, 64
SEED = 20
#: Least likeness of linked fingerprints; fingerprints in a part of a large band.
ALIKE, PART_ROWS = 0.8, 4096


@lru_cache(maxsize=1)
def waits() -> list[list[int]]:
    """Per class and step: how many steps a walk stays on a character before it moves on."""
    bits = np.random.default_rng(SEED).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    bits[:, -1] = True
    out = np.zeros((CLASSES, PERIOD), np.int64)
    ahead = np.zeros(CLASSES, np.int64)
    for j in range(2 * PERIOD - 1, -1, -1):
        ahead = np.where(bits[:, j % PERIOD], 1, ahead + 1)
        if j < PERIOD:
            out[:, j] = ahead
    return out.tolist()


@lru_cache(maxsize=1)
def records() -> list[np.ndarray]:
    """Per sample the rising record places: the sampled step of a walk of m steps is the last record below m."""
    out = []
    for sample in range(SAMPLES):
        own, place, places = random.Random(SEED * 1000 + sample), 0, [0]
        while place < 1 << 40:
            place = int((place + 1) / own.random())
            if place > places[-1]:
                places.append(place)
        out.append(np.array(places, np.int64))
    return out


def sampled_steps(walk: int) -> np.ndarray:
    return np.array([places[np.searchsorted(places, walk) - 1] for places in records()], np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def walk(codes: np.ndarray, start: int = 0) -> list[int]:
    """The step at which the walk, at step start now, leaves each character."""
    table, mask, j, left = waits(), PERIOD - 1, start, []
    put = left.append
    for kind in ((codes * np.uint32(2654435761)) >> np.uint32(26)).tolist():
        j += table[kind][j & mask]
        put(j)
    return left


def sampled(codes: np.ndarray, left: np.ndarray) -> str:
    """Fingerprint in hex, a nibble per sample; an empty text has zeros throughout."""
    if not len(codes):
        return "0" * SAMPLES
    steps = sampled_steps(2 * len(codes))
    at = np.searchsorted(left, steps, "right")
    seen = codes[np.minimum(at, len(codes) - 1)].astype(np.uint64) + np.uint64(1)
    # past the text's end the walk sees nothing: a nibble of the step alone
    seen = np.where(at < len(codes), seen, np.uint64(0))
    mixed = (seen * np.uint64(0x9E3779B97F4A7C15)) ^ ((np.arange(SAMPLES, dtype=np.uint64) + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return "".join("0123456789abcdef"[x] for x in (mixed >> np.uint64(60)).tolist())


def fingerprint(text: str) -> str:
    codes = _codes(text)
    return sampled(codes, np.array(walk(codes), np.int64))


def likeness(one: str, other: str) -> float:
    """Share of equal nibbles, of which 1 in 16 agree by chance: 0 at or below chance, 1 if equal."""
    same = sum(map(str.__eq__, one, other)) / SAMPLES
    return max(0.0, (same - 1 / 16) / (15 / 16))


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many, or all, first ones of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


class _Fingerprints:
    """Fingerprints of a text and of its edited text; the walk over the half they share is done once."""

    def of(self, text: str, following: str) -> tuple[str, str, str]:
        codes = _codes(text)
        left = np.array(walk(codes), np.int64)
        changed = edited(text, following)
        if changed == text:
            own = sampled(codes, left)
            return own, changed, own
        shared = len(text) - len(text) // 2
        rest = _codes(changed[shared:])
        at = int(left[shared - 1]) if shared else 0
        return sampled(codes, left), changed, sampled(
            np.concatenate([codes[:shared], rest]), np.concatenate([left[:shared], np.array(walk(rest, at), np.int64)]))


SCHEMA = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _place(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the value: first among every so many of them, then among those between."""
    step = max(1, math.isqrt(len(bounds)))
    longs = lambda values: F.array(*[F.lit(x).cast("long") for x in values]).cast("array<bigint>")
    reached = lambda some: F.size(F.filter(some, lambda x: x <= value))
    groups = reached(longs(bounds[step - 1::step]))
    return groups * step + reached(F.slice(longs(bounds), groups * step + 1, F.lit(step)))


def with_following(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows sorted by (doc_id, text) within ranges of doc_id: place, doc_id, text, guest.

    A range ends with a guest, the first document of the next range; the last with the first document of all. Texts move once.
    A null id is the smallest. The bounds are quantiles of the ids, one less than the ranges: by default as many as the session
    has shuffle partitions, which are to grow with the data.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = common.id_and_text(docs).withColumn("text", F.coalesce("text", F.lit(""))).withColumn(
        "order_id", F.coalesce("doc_id", F.lit(-1 << 63)))
    ids = rows.select("order_id")
    low, bounds = ids.agg(
        F.min("order_id"), F.percentile_approx("order_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()
    bounds = sorted({x for x in bounds or [] if x > low})
    own = rows.withColumn("place", _place(F.col("order_id"), bounds))
    starts = [low, *bounds] if low is not None else []
    is_start = F.col("order_id").isin(starts) if starts else F.lit(False)
    previous = F.when(F.col("order_id") == F.lit(low), F.lit(len(bounds))).otherwise(F.col("place") - 1)
    copies = F.when(is_start, F.array(F.struct(F.col("place").alias("place"), F.lit(0).alias("guest")),
                                      F.struct(previous.alias("place"), F.lit(1).alias("guest")))).otherwise(
        F.array(F.struct(F.col("place").alias("place"), F.lit(0).alias("guest"))))
    dealt = own.select("order_id", "doc_id", "text", F.explode(copies).alias("copy")).select(
        F.col("copy.place").alias("place"), F.col("copy.guest").alias("guest"), "order_id", "doc_id", "text")
    return dealt.repartition(ranges, "place").sortWithinPartitions("place", "guest", "order_id", "text")


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Of every row: n_chars, its edited text, both fingerprints, and the likeness to the edited text's and to the next document's.

    The next document is the next in ascending (doc_id, text), after the last the first; a null text is empty and a null id the smallest.
    A single document is its own next. Equal texts have equal fingerprints.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, made, size = _Fingerprints(), [], 0
        held = None  # the row that waits for the next one, with its fingerprint parts
        for batch in batches:
            for place, guest, doc_id, text in zip(*(batch.column(name).to_pylist() for name in ("place", "guest", "doc_id", "text"))):
                if held is not None and held[0] == place:
                    made.append([held[1], held[2], *maker.of(held[2], text)])
                    made[-1].append(text if guest else None)
                    size += len(text)
                held = None if guest else (place, doc_id, text)
            if size > 4_000_000 or len(made) > 5000:
                # the last row's next fingerprint is not known yet
                yield from finish(made[:-1], made[-1])
                made, size = made[-1:], 0
        yield from finish(made, None)

    def finish(rows: list, after: list | None) -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        out = []
        for row, following in zip(rows, [*rows[1:], after]):
            doc_id, text, own, changed, changed_print, guest = row
            # a row before a guest is the last of its range
            next_print = fingerprint(guest) if guest is not None else following[2]
            out.append((doc_id, len(text), changed, own, changed_print, likeness(own, changed_print), likeness(own, next_print)))
        columns = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, kinds)], [part.split()[0] for part in SCHEMA.split(", ")])

    return with_following(docs, ranges).mapInArrow(run, SCHEMA)


def unit_links(entries: list[tuple[int, bytes]], least: int) -> list[tuple[int, int]]:
    """(node, smallest node reached) over (node, fingerprint) of one unit, for links of at least so many equal nibbles.

    Each component is walked from one entry; what it reaches leaves the unit.
    """
    nodes = np.array([e[0] for e in entries])
    prints = np.frombuffer(b"".join(e[1] for e in entries), np.uint8).reshape(len(entries), SAMPLES)
    left, made = np.arange(len(entries)), []
    while len(left):
        members, todo, left = [left[0]], [left[0]], left[1:]
        while todo and len(left):
            near = (prints[left] == prints[todo.pop()]).sum(1) >= least
            members += left[near].tolist()
            todo += left[near].tolist()
            left = left[~near]
        reached = nodes[members].tolist()
        low = min(reached)
        made += [(x, low) for x in reached if x != low]
    return made


def _band_links(distinct: DataFrame, alike: float, part_rows: int) -> DataFrame:
    """Stars (a, b) whose components are those of all links of at least that likeness. distinct: node, fingerprint."""
    least = next(n for n in range(SAMPLES + 1) if max(0.0, (n / SAMPLES - 1 / 16) / (15 / 16)) >= alike)
    # one band more than nibbles may differ: some band of two linked fingerprints is equal
    bands = min(SAMPLES, SAMPLES - least + 1)
    edges = [i * SAMPLES // bands for i in range(bands + 1)]
    keyed = distinct.select("node", "fingerprint", F.explode(F.array(*[
        F.concat(F.lit(f"{i}:"), F.substring("fingerprint", i + 1, j - i)) for i, j in zip(edges, edges[1:])])).alias("band"))
    sizes = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band", F.ceil(F.col("n") / part_rows).cast("int").alias("parts"))
    own = keyed.join(sizes, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    units = own.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "band", F.least("own", "part").alias("one"), F.greatest("own", "part").alias("other"), "node", "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, entries, made = None, [], []

        def close() -> None:
            if len(entries) > 1:
                made.extend(unit_links(entries, least))

        def flushed() -> pa.RecordBatch:
            a, b = zip(*made)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for band, one, other, node, own_print in zip(*(batch.column(name).to_pylist() for name in ("band", "one", "other", "node", "fingerprint"))):
                if at != (band, one, other):
                    close()
                    at, entries = (band, one, other), []
                entries.append((node, own_print.encode()))
            if made:
                yield flushed()
                made.clear()
        close()
        if made:
            yield flushed()

    return units.repartition("band", "one", "other").sortWithinPartitions("band", "one", "other", "node").mapInArrow(run, "a long, b long")


def near_components(prints: DataFrame, alike: float = ALIKE, part_rows: int = PART_ROWS) -> DataFrame:
    """prints with component_id: the smallest doc_id reachable over links of at least that likeness.

    prints: doc_id and fingerprint, and any other columns but node; it is read several times. Every link is found: with one band more
    than nibbles may differ, two linked fingerprints have an equal band. A band of more than part_rows fingerprints is searched part by
    part. Null ids are ignored as component ids; a component of null ids alone has none.
    """
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")).withColumn("node", F.xxhash64("fingerprint")), "distinct-prints")
    roots = components(_band_links(distinct.select("node", "fingerprint"), alike, part_rows))
    named = distinct.join(roots.withColumnRenamed("a", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stage(named.select("fingerprint", "root", "first_id"), "print-roots")
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(named.join(lowest, "root").select("fingerprint", "component_id"), "fingerprint")


def near_links(prints: DataFrame, alike: float = ALIKE) -> DataFrame:
    """doc_id and lead_id, the smallest id of its component, of every row that is not its component's lead. prints: doc_id and fingerprint."""
    return near_components(prints.select("doc_id", "fingerprint"), alike).where("doc_id > component_id").select(
        "doc_id", F.col("component_id").alias("lead_id"))
