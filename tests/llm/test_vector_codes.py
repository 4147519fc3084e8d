"""Vector codes against Python integers, and against SQL."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from roadgauge.llm import queries, vector_codes
from tests.conftest import SAMPLE


def brute(rows, kind, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label). Returns sorted (vec_id, code, error, label_error) and the entries."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(4096 * float(kind(x))) if abs(x) < 1e30 else int(float(kind(x))) * 4096 for x in v], label) for i, v, label in kept]
    sizes = [len(v) for _, v, _ in whole]
    size = max(set(sizes), key=lambda n: (sizes.count(n), n), default=0)
    same, width = [w for w in whole if len(w[1]) == size], size // parts
    first = [v for _, v in sorted((i, v) for i, v, _ in same if i is not None)][:entries]
    books = [[v[p * width:(p + 1) * width] for v in first] for p in range(parts)]

    def near(p, v):
        own = v[p * width:(p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(own, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for _, v, _ in same:
                of.setdefault(near(p, v)[1], []).append(v[p * width:(p + 1) * width])
            books[p] = [[sum(x) // len(of[e]) for x in zip(*of[e])] if e in of else c for e, c in enumerate(books[p])]
    out = []
    for i, v, label in whole:
        if len(v) != size:
            out.append((i, label, None, None))
        else:
            best = [near(p, v) for p in range(parts)]
            out.append((i, label, "".join(f"{e:02x}" for _, e in best), min(sum(d for d, _ in best), (1 << 63) - 1)))
    sums = {}
    for _, label, _, error in out:
        sums[label] = None if error is None and sums.get(label) is None else (sums.get(label) or 0) + (error or 0)
    return sorted(((i, c, e, None if sums[label] is None else min(sums[label], (1 << 63) - 1)) for i, label, c, e in out), key=repr), books


def table(spark, rows, kind):
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind)), T.StructField("label", T.IntegerType()),
        T.StructField("code", T.StringType()), T.StructField("size", T.StringType()), T.StructField("error", T.StringType())])
    return spark.createDataFrame([(*r, "c", "s", "e") for r in rows], schema).repartition(3)


def check(spark, rows, spark_kind, kind):
    got, books = vector_codes.compress(table(spark, rows, spark_kind))
    assert got.columns == ["vec_id", "label", "code", "error", "label_error"]
    want, entries = brute(rows, kind)
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got.collect()), key=repr) == want
    if books.entries:
        assert books.entries == entries


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 24).astype(np.float32).tolist(), [0, 1, None][i % 3]) for i in range(60)]
    rows += [(100 + i, rows[0][1], 7) for i in range(40)]  # many equal vectors
    rows += [(3, rows[3][1], 0), (None, rows[4][1], 5), (200, None, 0), (201, [None] * 24, 0), (202, rows[1][1][:23] + [float("nan")], 1)]
    rows += [(203, rows[1][1][:23] + [float("inf")], 1), (204, rows[1][1][:16], 9), (205, [], 9), (206, [-0.0] * 24, 1)]
    check(spark, rows, T.FloatType(), np.float32)


def test_wide_integers(spark):
    """Several limbs, and integers beyond any limb split."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(0, 1, 8) * 10.0 ** rng.integers(0, 5)).tolist(), i % 2) for i in range(50)]
    check(spark, rows, T.DoubleType(), np.float64)
    check(spark, rows + [(60, [1e12] * 8, 0), (61, [-3e15] * 8, 1)], T.DoubleType(), np.float64)


def test_few_and_none(spark):
    check(spark, [(5, [1.0] * 8, None), (4, [2.0] * 8, None)], T.FloatType(), np.float32)
    got, books = vector_codes.compress(table(spark, [], T.FloatType()))
    assert got.count() == 0 and books.entries == []
    got, _ = vector_codes.compress(table(spark, [(1, [1.0] * 9, 3)], T.FloatType()))
    assert [tuple(r) for r in got.collect()] == [(1, 3, None, None, None)]


@pytest.mark.parametrize("bits", [None, 7, 12])
def test_products_are_exact(bits):
    rng = np.random.default_rng(1)
    for top in (1, 1 << 13, 1 << 25, (1 << 28) - 1):
        a, b = rng.integers(-top, top + 1, (50, 8)), rng.integers(-top, top + 1, (16, 8))
        want = a.astype(object) @ b.astype(object).T
        assert (vector_codes.products(a, b, bits).astype(object) == want).all()
        index = rng.integers(0, 16, 50)
        sums = vector_codes.entry_sums(a, index, 16)
        assert all((sums[e] == a[index == e].sum(axis=0)).all() for e in range(16))


def test_sql(spark):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{SAMPLE}/embeddings.parquet'")
    cursor = db.execute(queries.CHECK_SQL["op11_vector_codes"])
    columns = [d[0] for d in cursor.description]
    got = queries.QUERIES["op11_vector_codes"](spark, SAMPLE).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())
