"""Codes of vectors: product quantisation on integers, exact at every step.

Components become integers, vectors are cut into equal parts, and each part position has a small codebook that is
refined by rounds of nearest entry and mean. Dot products of parts and entries are matrix products in float64 (BLAS), and still
exact: integers are split into limbs so short that no sum of limb products passes 2^53, and the products of limbs are put
together in int64. Squared distances are therefore exact integers, and the first smallest one wins.

A round reads all vectors where they lie; a task returns sums and counts per codebook entry only, so what is shuffled and what
reaches the driver is bounded by the size of the codebooks, at any number of vectors and however many are alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from roadgauge.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
MANTISSA = 53
LONGEST_LONG = (1 << 63) - 1
SUM_BITS = 32
SUMS = "part int, entry int, position int, limb int, total long"


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * value), as int64; as Python integers if a squared distance could pass 63 bits."""
    scaled = np.floor(values.astype(np.float64) * scale)
    width = values.shape[-1] if values.ndim else 1
    most = float(np.abs(scaled).max()) if scaled.size else 0.0
    if 4 * max(width, 1) * (most + 1) ** 2 < 2.0 ** 62:
        return scaled.astype(np.int64)
    if np.isfinite(scaled).all():
        return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)
    exact = [(n * scale) // d for n, d in (float(x).as_integer_ratio() for x in values.ravel())]
    return np.array(exact, object).reshape(values.shape)


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays whose sum, shifted by bits per place, is values. All but the last lie in [0, 2^bits)."""
    out = []
    while values.size and (values.max() >= 1 << bits or values.min() < -(1 << bits)):
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*out, values.astype(np.float64)]


def limb_bits(terms: int) -> int:
    """Widest limbs for which a sum of so many products stays within float64's exact integers."""
    return (MANTISSA - max(terms, 1).bit_length()) // 2


def products(left: np.ndarray, right: np.ndarray, bits: int | None = None) -> np.ndarray:
    """left @ right.T of integers, exact. int64 results must fit int64."""
    if left.dtype == object or right.dtype == object:
        return left.astype(object) @ right.astype(object).T
    bits = bits or limb_bits(left.shape[1])
    total = np.zeros((len(left), len(right)), np.int64)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(limbs(right, bits)):
            total += (a @ b.T).astype(np.int64) << np.int64(bits * (i + j))
    return total


def nearest(parts: np.ndarray, entries: np.ndarray, bits: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part (ties: the lower index), and the squared distance."""
    if parts.dtype != entries.dtype:
        parts, entries = parts.astype(object), entries.astype(object)
    squares = (entries * entries).sum(axis=1)
    distances = squares[None, :] - 2 * products(parts, entries, bits)
    index = np.argmin(distances, axis=1)
    own = (parts * parts).sum(axis=1)
    return index, own + distances[np.arange(len(parts)), index]


def entry_sums(parts: np.ndarray, index: np.ndarray, entries: int) -> np.ndarray:
    """Sum of the parts of each entry, exact by the same split: a matrix product with the assignment."""
    if parts.dtype == object:
        out = np.zeros((entries, parts.shape[1]), object)
        np.add.at(out, index, parts)
        return out
    chosen = (np.arange(entries)[:, None] == index[None, :]).astype(np.float64)
    bits = MANTISSA - max(len(parts), 1).bit_length()
    total = np.zeros((entries, parts.shape[1]), np.int64)
    for i, a in enumerate(limbs(parts, bits)):
        total += (chosen @ a).astype(np.int64) << np.int64(bits * i)
    return total


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, size, vector (bytes of its floats) of the rows whose vector has no null or non-finite component."""
    single = embeddings.schema["embedding"].dataType.elementType.simpleString() == "float"
    label = embeddings.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("embedding")))
            if not batch.num_rows:
                continue
            column = batch.column("embedding")
            offsets = column.offsets.to_numpy().astype(np.int64)
            offsets, flat = offsets - offsets[0], column.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float32 if single else np.float64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])  # a null reads as not a number
            good = bad[offsets[1:]] == bad[offsets[:-1]]
            width = values.itemsize
            vectors = pa.Array.from_buffers(
                pa.binary(), batch.num_rows,
                [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(np.diff(offsets), pa.int64()), vectors],
                ["vec_id", "label", "size", "vector"]).filter(pa.array(good))

    narrow = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
    return narrow.mapInArrow(run, f"vec_id long, label {label}, size long, vector binary")


class Codebooks:
    """entries[part][entry]: integer components. kind: numpy type of the stored vectors. size: their length."""

    def __init__(self, entries: list[list[list[int]]], kind: str, size: int):
        self.entries, self.kind, self.size = entries, kind, size

    def arrays(self) -> list[np.ndarray]:
        out = []
        for part in self.entries:
            most = max((abs(x) for entry in part for x in entry), default=0)
            fits = 4 * max(self.size, 1) * (most + 1) ** 2 < 1 << 62
            out.append(np.array(part, np.int64 if fits else object).reshape(len(part), -1))
        return out

    def sha256(self) -> str:
        """Of all components as decimals, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(x) for part in self.entries for e in part for x in e).encode()).hexdigest()

    def assigned(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(part, its integers, index, squared distance) of the vectors of a batch, all of the codebooks' size."""
        data = b"".join(batch.column("vector").to_pylist())
        values = np.frombuffer(data, self.kind).reshape(batch.num_rows, self.size)
        whole, width = integers(values), self.size // len(self.entries)
        for part, entries in enumerate(self.arrays()):
            own = whole[:, part * width:(part + 1) * width]
            yield part, own, *nearest(own, entries)


def _sums(books: Codebooks):
    """A task's sums and counts per entry, as limbs of 32 bits so that adding them up cannot overflow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = {}, {}
        for batch in batches:
            if batch.num_rows:
                for part, own, index, _ in books.assigned(batch):
                    size = len(books.entries[part])
                    counts[part] = counts.get(part, 0) + np.bincount(index, minlength=size)
                    totals[part] = totals.get(part, 0) + entry_sums(own, index, size).astype(object)
        rows = []
        for part, total in totals.items():
            for entry, count in enumerate(counts[part].tolist()):
                if count:
                    rows.append((part, entry, -1, 0, count))
                    for position, value in enumerate(total[entry].tolist()):
                        place = 0
                        while not -(1 << SUM_BITS) <= value < 1 << SUM_BITS:
                            rows.append((part, entry, position, place, value & ((1 << SUM_BITS) - 1)))
                            value, place = value >> SUM_BITS, place + 1
                        rows.append((part, entry, position, place, value))
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                ["part", "entry", "position", "limb", "total"])

    return run


def refined(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every used entry becomes the componentwise floor of its parts' mean."""
    found = vectors.mapInArrow(_sums(books), SUMS).groupBy("part", "entry", "position", "limb").agg(F.sum("total").alias("total"))
    totals: dict[tuple[int, int, int], int] = {}
    for part, entry, position, limb, total in found.collect():  # at most the codebooks' components, a few limbs each
        key = (part, entry, position)
        totals[key] = totals.get(key, 0) + (int(total) << (SUM_BITS * limb))
    entries = [
        [[totals[part, e, i] // totals[part, e, -1] for i in range(len(old))] if (part, e, -1) in totals else old
         for e, old in enumerate(of_part)]
        for part, of_part in enumerate(books.entries)]
    return Codebooks(entries, books.kind, books.size)


def train(vectors: DataFrame, kind: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of stored vectors, all of which take part in every round.

    They are those of the commonest vector length (ties: the longer one). The first entries are the parts of the
    smallest vec_ids (null ids are left out; rows that share an id are ordered by their bytes). With fewer
    rows there are fewer entries.
    """
    common = vectors.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None or common["size"] % parts or not common["size"]:
        return Codebooks([], kind, -1)
    size, width = common["size"], common["size"] // parts
    same = vectors.where(F.col("size") == size)
    first = same.where("vec_id is not null").orderBy("vec_id", "vector").limit(entries).collect()
    start = [integers(np.frombuffer(bytes(r["vector"]), kind)[None, :])[0].tolist() for r in first]
    if not start:
        return Codebooks([], kind, -1)
    books = Codebooks([[v[p * width:(p + 1) * width] for v in start] for p in range(parts)], kind, size)
    for _ in range(rounds):
        books = refined(same, books)
    return books


def codes(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error. A vector of another length than the codebooks' has a null code and error."""
    label = vectors.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            index = np.zeros((batch.num_rows, len(books.entries)), np.uint8)
            error = np.zeros(batch.num_rows, object)
            for part, _, own, distance in books.assigned(batch):
                index[:, part] = own
                error += distance
            text, step = index.tobytes().hex(), 2 * index.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()),
                 pa.array([min(int(e), LONGEST_LONG) for e in error], pa.int64())],
                ["vec_id", "label", "code", "error"])

    of_size = F.col("size") == books.size
    made = vectors.where(of_size).mapInArrow(run, f"vec_id long, label {label}, code string, error long")
    odd = vectors.where(~of_size).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return made.unionByName(odd)


def compress(embeddings: DataFrame) -> tuple[DataFrame, Codebooks]:
    """Codes of every kept row (vec_id, label, code, error, label_error), and the codebooks.

    embeddings: vec_id, embedding (array of floats or doubles), label; further columns are ignored. Rows with a null
    vector, or null or non-finite components, are dropped; a null vec_id is kept; repeated rows each count and are
    each returned. label_error is the error summed over equal labels, nulls together. Errors above the longest
    long are given as that. An empty table, or no length that falls into equal parts, gives no codebooks
    and null codes. label_error is joined as a table of its own, so that Spark knows its size and sends it to
    the rows only if it is small.
    """
    double = embeddings.schema["embedding"].dataType.elementType.simpleString() != "float"
    vectors = stage(kept_vectors(embeddings), "vectors")
    books = train(vectors, "<f8" if double else "<f4")
    coded = stage(codes(vectors, books), "codes")
    total = F.sum(F.col("error").cast("decimal(28, 0)"))
    sums = coded.groupBy("label").agg(
        F.when(total > LONGEST_LONG, LONGEST_LONG).otherwise(total.cast("long")).alias("label_error"))
    sums = stage(sums.withColumnRenamed("label", "of_label"), "label-errors")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error"), books
