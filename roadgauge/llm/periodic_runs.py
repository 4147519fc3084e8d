"""Runs of repeated word sequences: maximal stretches of period q and at least four periods.

Periods are treated by octave, m <= q < 2m. In an octave a document is cut into overlapping tiles; the overlap is so wide that each
run shows at least its first three periods within one tile, and tiles are solved independently. A
tile is solved at boundaries, one every m words: Z-functions to the right and to the left of a boundary tell, for all
periods of the octave at once, how far the words repeat around it. Only tiles that can hold a run leave
their task: rolling hashes of word blocks show all of them (false ones too, which the Z-functions rule out). What tiles
find is shuffled by document and period, and fragments that touch are stitched, which is exact as a fragment is a
range of places whose word equals the one a period later.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadgauge.llm import common
from roadgauge.session import scratch_dir

REPEATS = 4
LEAST_WORDS = 6
#: Words of a tile besides its overlap, in units of the octave, and at least.
TILE_OCTAVES, TILE_WORDS = 16, 512
#: Words hashed together.
BLOCK_WORDS = 200_000
FACTOR = 0x9E3779B97F4A7C15
FACTOR_INVERSE = pow(FACTOR, -1, 1 << 64)
ROWS = "row long, doc_id long, text string, octave int, start long, ids binary, at binary, periods binary"
PLAIN, TILED = -1, -2
FRAGMENTS = "row long, period long, low long, high long"


def need(period: int) -> int:
    """How many neighbouring places must equal the one a period later."""
    return max((REPEATS - 1) * period, LEAST_WORDS - period)


def z_function(values: list[int], upto: int) -> list[int]:
    """For each place below upto, how many values from there on equal those from the start on. Place 0 has the length."""
    n = len(values)
    z = [0] * min(upto, n)
    if z:
        z[0] = n
    left = right = 0
    for i in range(1, len(z)):
        k = 0 if i >= right else min(right - i, z[i - left])
        if i + k >= right:
            while i + k < n and values[k] == values[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def tile_words(octave: int) -> int:
    return max(TILE_OCTAVES * octave, TILE_WORDS)


def _powers(factor: int, count: int) -> np.ndarray:
    """factor^0, factor^1 ... modulo 2^64."""
    out = np.full(count, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def candidates(ids: np.ndarray, octave: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) where a block of words recurs a period later. Every run of the octave shows at its first boundary.

    A run's first boundary lies within its first m places, so that what remains of its equal places is a block of 2m + 1
    words (5 words for period 1). Blocks are compared by hashes modulo 2^64.
    """
    block = need(octave) - octave + 1
    n = len(ids) - block + 1
    if n <= octave:
        none = np.zeros(0, np.int64)
        return none, none
    with np.errstate(over="ignore"):
        powers, inverse = _powers(FACTOR, len(ids)), _powers(FACTOR_INVERSE, n)
        mixed = ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * powers
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        hashes = (sums[block:] - sums[:-block]) * inverse
    rows = -(-n // octave)
    # a place beyond the end equals no block: its own boundary is taken to be unlike it below
    padded = np.zeros(rows * octave, np.uint64)
    padded[:n] = hashes
    square = padded.reshape(rows, octave)
    at, offset = np.nonzero(square[1:] == square[:-1, :1])
    at, period = at * octave, octave + offset
    inside = at + period < n
    return at[inside], period[inside]


def solve_tile(words: list[int], domain: int, octave: int, at: list[int], periods: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, low, high) of the fragments of a tile: ranges of places in the domain, long enough for a run.

    at, periods: candidates, by boundary. A period that is a multiple of a smaller one of the same words is left out.
    """
    reach: dict[int, int] = {}
    i = 0
    while i < len(at):
        c, open_ = at[i], []
        while i < len(at) and at[i] == c:
            if reach.get(periods[i], -1) <= c:
                open_.append(periods[i])
            i += 1
        if not open_:
            continue
        ahead = z_function(words[c:], 2 * octave)
        before = words[:c][::-1]
        behind = z_function([*before, -1, *words[:c + 2 * octave][::-1]], len(before) + 1 + octave + 1)
        span = min(c + 2 * octave, len(words)) - c
        for q in open_:
            if q >= len(ahead):
                continue
            high = min(c + ahead[q], domain)
            low = c - min(behind[len(before) + 1 + span - q], c)
            reach[q] = max(high, c + 1)
            if high - low >= need(q) and not (
                    c + 2 * q <= high + q and any(q % d == 0 and ahead[d] >= 2 * q - d for d in range(1, q // 2 + 1))):
                yield q, low, high


def _tiles(ids: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
    """(document, octave, start, ids, boundaries, periods) of the tiles that may hold a run.

    ids: words of all documents, each document followed by an id of its own that no word has.
    """
    begins, octave = np.cumsum(sizes + 1) - sizes - 1, 1
    live, now, starts = np.arange(len(sizes)), ids, begins
    while True:
        stay = sizes[live] >= max(REPEATS * octave, LEAST_WORDS)
        if not stay.any():
            return
        if not stay.all():
            now = now[np.repeat(stay, sizes[live] + 1)]
            live = live[stay]
            starts = np.cumsum(sizes[live] + 1) - sizes[live] - 1
        at, period = candidates(now, octave)
        if len(at):
            which = np.searchsorted(starts, at, "right") - 1
            place, core = at - starts[which], tile_words(octave)
            tile = place // core
            # a boundary in the overlap belongs to the tile before, too
            also = (tile > 0) & (place - tile * core < 6 * octave)
            which, place, period, tile = (
                np.concatenate([a, b[also]]) for a, b in ((which, which), (place, place), (period, period), (tile, tile - 1)))
            order = np.lexsort((period, place, tile, which))
            which, place, period, tile = which[order], place[order], period[order], tile[order]
            edges = np.flatnonzero(np.diff(which) | np.diff(tile)) + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(which)]):
                doc, start = live[which[low]], int(tile[low]) * core
                end = min(start + core + 8 * octave, int(sizes[doc]))
                first = int(starts[which[low]])
                yield (int(doc), octave, start, now[first + start:first + end].astype("<i4").tobytes(),
                       (place[low:high] - start).astype("<i4").tobytes(), period[low:high].astype("<i4").tobytes())
        octave *= 2


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and the tiles that may hold runs. A document without such tiles is done."""
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 33
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = [column.split()[0] for column in ROWS.split(", ")]

    def made(docs: list[tuple], lists: list[list[bytes]]) -> pa.RecordBatch:
        nonlocal row
        known: dict[bytes, int] = {}
        flat = []
        for number, words in enumerate(lists):
            flat += [known.setdefault(w, len(known)) for w in words]
            flat.append(-1 - number)
        sizes = np.array([len(words) for words in lists], np.int64)
        tiles = list(_tiles(np.array(flat, np.int64), sizes))
        tiled = {tile[0] for tile in tiles}
        out = [
            (row + i, doc_id, b" ".join(words).decode("utf-8"), TILED if i in tiled else PLAIN, None, None, None, None)
            for i, (doc_id, words) in enumerate(zip(docs, lists))]
        out += [(row + doc, None, None, octave, *rest) for doc, octave, *rest in tiles]
        row += len(docs)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)

    docs, lists, size = [], [], 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
            words = (text or b"").split()
            docs.append(doc_id)
            lists.append(words)
            size += len(words) + 1
            if size >= BLOCK_WORDS:
                yield made(docs, lists)
                docs, lists, size = [], [], 0
    if docs:
        yield made(docs, lists)


def _solve(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    numbers = lambda data: np.frombuffer(data, "<i4").tolist()
    for row, octave, start, ids, at, periods in zip(*(batch.column(i).to_pylist() for i in range(6))):
        domain = tile_words(octave) + 6 * octave
        for q, low, high in solve_tile(numbers(ids), domain, octave, numbers(at), numbers(periods)):
            rows.append((row, q, start + low, start + high))
    if not rows:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, ["row", "period", "low", "high"])
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in zip(*rows)], ["row", "period", "low", "high"])


def stitched(fragments: DataFrame) -> DataFrame:
    """row, start, length, period of the runs: touching fragments of a document and period become one."""
    by_place = Window.partitionBy("row", "period").orderBy("low", "high")
    before = F.max("high").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        fragments.withColumn("fresh", F.coalesce(F.col("low") > before, F.lit(True)).cast("long"))
        .withColumn("island", F.sum("fresh").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "period", "island").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    length = F.col("high") - F.col("low") + F.col("period")
    return (
        islands.select("row", F.col("low").alias("start"), length.alias("length"), "period")
        .where((F.col("length") >= REPEATS * F.col("period")) & (F.col("length") >= LEAST_WORDS))
        .groupBy("row", "start", "length").agg(F.min("period").alias("period")))


def _collapse(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Words that repeat what a run began with go."""
    out = []
    for text, runs in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs").to_pylist()):
        if runs:
            words = text.split(b" ")
            stay = np.ones(len(words), bool)
            for run in runs:
                stay[run["start"] + run["period"]:run["start"] + run["length"]] = False
            text = b" ".join([words[i] for i in np.flatnonzero(stay).tolist()])
        out.append(text.decode("utf-8"))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("runs"), pa.array(out, pa.string())], ["doc_id", "runs", "collapsed_text"])


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period, by start and period) and collapsed_text of every row.

    Words are what lies between ASCII white space. A run is maximal, its period the smallest, its length
    at least four periods and six words. collapsed_text has the words that no run covers after its first period, joined by one space. A
    null or empty text has no runs and an empty collapsed text; repeated rows and null ids are each returned; a table without rows gives
    none. Memory: one block of documents, one tile, and one document's runs.
    """
    runs_type = "array<struct<start: bigint, length: bigint, period: bigint>>"
    path = scratch_dir(docs.sparkSession, "tiles")
    common.id_and_text(docs).mapInArrow(_cut, ROWS).write.option("compression", "zstd").parquet(path)
    cut = docs.sparkSession.read.parquet(path)
    # neighbouring tiles of one long document go to different tasks
    tiles = cut.where("octave > 0").select("row", "octave", "start", "ids", "at", "periods").repartition("row", "octave", "start")
    runs = (
        stitched(common.map_batches(tiles, _solve, FRAGMENTS))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
        .select("row", F.transform("found", lambda r: F.struct(r["start"], r["length"], r["period"])).cast(runs_type).alias("runs")))
    tiled = cut.where(F.col("octave") == TILED).select("row", "doc_id", "text").join(runs, "row", "left").drop("row")
    collapsed = common.map_batches(tiled, _collapse, f"doc_id long, runs {runs_type}, collapsed_text string")
    plain = cut.where(F.col("octave") == PLAIN).select(
        "doc_id", F.lit(None).cast(runs_type).alias("runs"), F.col("text").alias("collapsed_text"))
    return plain.unionByName(collapsed).withColumn("runs", F.coalesce("runs", F.array().cast(runs_type)))
