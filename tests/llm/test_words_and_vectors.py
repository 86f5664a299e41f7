"""Spelling variants, nearest neighbours and whitening against brute force, and on odd tables."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import nearest, spelling, whitening

LETTERS = "aábcé"


def odd_texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list(LETTERS), size=7)) for _ in range(12)]
    rows = [(i, " ".join(w for w in words for _ in range(int(rng.integers(1, 40)))).title()) for i in range(40)]
    near = [w[:3] + c + w[k:] for w in words for c in LETTERS for k in (3, 4)]
    rows += [(100, " ".join(near * 2)), (None, "Mississippi missisippi " * 3 + "mississippi " * 50), (None, None), (5, ""), (6, "…, 12"), (7, "aaaaaaa aaaaaaaa aaaaaaaaa " * 2 + "aaaaaaaa " * 30)]
    return rows + rows[:3] + [(201, "mnopqrs " * 300 + "mnopqrt " * 20 + "mnopqut " * 2), (200, ("é" * 200 + " ") * 2 + ("é" * 199 + " ") * 30 + ("x" + "é" * 199 + " ") * 2)]


@pytest.mark.parametrize("long", [spelling.LONG, 8])
def test_spelling(spark, long):
    """Both forms of rotations, on letters that double, ties, repeated rows, null and empty texts, and a clashing column."""
    rows = odd_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("n"))
    got = spelling.variants(docs, long=long).collect()
    want = spelling.brute_force(rows)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum(r["form"] is not None for r in got) > 20 and any(r["root"] not in (r["form"], r["word"]) for r in got)
    assert not spelling.variants(docs.limit(0), long=long).collect()


def test_spelling_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(repr, map(tuple, spelling.op11_spelling_variants(spark, sf_small).collect()))) == sorted(map(repr, spelling.brute_force(rows)))


def test_very_long_words(spark):
    """A run of 20 000 letters costs rows in proportion to it."""
    docs = spark.createDataFrame([(1, ("y" * 20_000 + " ") * 2 + ("y" * 20_001 + " ") * 20)], "doc_id long, text string")
    got = {len(r["word"]): (r["n"], r["n_near"], r["form_n"], len(r["root"])) for r in spelling.variants(docs).collect()}
    assert got == {20_000: (2, 1, 20, 20_001), 20_001: (20, 1, None, 20_001)}


def test_rotation_keys():
    """Words share a hashed rotation exactly where an edit makes them equal."""
    replaced = [i for i, (a, b) in enumerate(zip(spelling.rotation_keys("abcdef", True), spelling.rotation_keys("abxdef", True), strict=True)) if a == b]
    assert replaced == [2]
    assert spelling.rotation_keys("abcdef", True)[3] in spelling.rotation_keys("abcef", False)
    assert len(set(map(bytes, spelling.rotation_keys("aaaaaaa", True)))) == 7


def odd_vectors():
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(200)]
    rows += rows[:30] + [(7, rng.normal(size=5).tolist()) for _ in range(60)]  # repeated rows, and many vectors of one id
    rows += [(20, [3.0, 1.0, 2.0, 3.0, 4.0]), (300, rows[3][1]), (301, rows[3][1]), (40, None), (41, [0.0] * 5), (60, [1.0, None, 2.0, 3.0, 4.0])]
    return rows + [(None, [1.0] * 5), (80, [float("nan")] * 5), (400, [1.0, 2.0]), (401, [2.0, 1.0]), (402, []), (500, [1e200] * 5), (501, [float("inf")] * 5)]


@pytest.mark.parametrize("block_bytes", [nearest.BLOCK_BYTES, 4000])
def test_nearest(spark, block_bytes):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    assert sorted(map(tuple, nearest.nearest(df, block_bytes=block_bytes).collect())) == nearest.brute_force(rows)
    assert not nearest.nearest(df.limit(0)).collect()


def test_nearest_query(spark, sf_small):
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{sf_small}/embeddings.parquet'")
    assert sorted(map(tuple, nearest.op12_nearest(spark, sf_small).collect())) == sorted(c.execute(nearest.ORACLE_SQL).fetchall())


@pytest.mark.parametrize("size", [3, 64, 1500])
def test_tile_bounds(size):
    """Products of steps are exact, the bounds hold, and few pairs need more than the steps."""
    rng = np.random.default_rng(size)
    a, b = rng.normal(size=(40, size)), rng.normal(size=(50, size)) * rng.uniform(0.01, 100, size=(50, 1))
    (qs, q_scale, q_long, q_rest), (cs, c_scale, c_long, c_rest) = nearest.quantize(a), nearest.quantize(b)
    product = nearest.tile_product(qs, cs)
    assert (product == qs.astype(np.int64) @ cs.T.astype(np.int64)).all()
    error = q_rest[:, None] * (c_long + c_rest) + q_long[:, None] * c_rest
    assert (np.abs(a @ b.T - product * q_scale[:, None] * c_scale) <= error).all()
    wide = rng.normal(size=(5000, 64))
    _, exact = nearest.cell(np.arange(100), wide[:100], np.arange(5000), wide, 20)
    assert exact < 0.05 * 100 * 5000


def whitened_by_hand(rows, components=16):
    """(vec_id, component) -> whitened without sign, deviation, explained, by exact sums and an eigendecomposition."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in good], dtype=object)
    points = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, s = len(points), points.sum(axis=0)
    centred = ((n * points - s) / n).astype(float)
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1], w[:, ::-1]
    m = min(components, int((e > 1e-9 * e[0]).sum()))
    y = ((n * x - s) / n).astype(float) @ w[:, :m] / np.sqrt(e[:m])
    deviation = ((n * x - s) ** 2).sum(axis=1)
    return n, {(i, k + 1): (abs(y[j, k]), int(deviation[j]), e[k] / e.sum()) for j, (i, _) in enumerate(good) for k in range(m)}


def same_whitening(rows, got):
    n, want = whitened_by_hand(rows)
    assert {(r["vec_id"], r["component"]) for r in got} == set(want)
    for r in got:
        y, deviation, explained = want[r["vec_id"], r["component"]]
        assert r["n"] == n and r["deviation"] == deviation and r["identity_error"] < 1e-8
        assert abs(abs(r["whitened"]) - y) < 1e-7 * max(1, y) and abs(r["explained"] - explained) < 1e-6 * explained


def test_whitening_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = whitening.op13_whitening(spark, sf_small).collect()
    same_whitening(rows, got)
    assert len({(r["vec_id"], r["component"]) for r in got}) == len(got) == 16 * len(rows)


def test_whitening_odd(spark):
    """Dependent and constant dimensions, scales far apart, repeated points, rows that take no part, other lengths."""
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 4)) * np.array([1000, 1, 3, 10])
    base = np.column_stack([base, base[:, 2] * 0 + 7.0])
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(600 + i, base[0].tolist()) for i in range(100)]
    odd = [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0]), (502, [float("inf")] * 5), (503, []), (504, [1e300] * 5), (505, [1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("component", F.lit(0))
    got = whitening.whiten(df).collect()
    assert max(r["component"] for r in got) == 4
    same_whitening(rows, got)
    assert not whitening.whiten(df.limit(0)).collect()
    assert not whitening.whiten(df.where("vec_id >= 600")).collect()  # equal points have no variance
    two = whitening.whiten(df.where("vec_id in (1, 2)")).collect()
    assert [round(abs(r["whitened"]), 9) for r in two] == [1.0, 1.0]
    repeated = whitening.whiten(spark.createDataFrame([(None, [1.0, 0.0]), (3, [5.0, 0.0]), (3, [5.0, 0.0])], df.select("vec_id", "embedding").schema)).collect()
    assert len(repeated) == 3 and {r["n"] for r in repeated} == {2}


def test_cholesky_qr():
    """Factors of badly conditioned columns, their first shifted, still give an orthogonal Q."""
    rng = np.random.default_rng(2)
    u, _ = np.linalg.qr(rng.normal(size=(500, 8)))
    v, _ = np.linalg.qr(rng.normal(size=(8, 8)))
    x = u * np.logspace(0, -10, 8) @ v.T
    shift = 11 * (500 * 8 + 8 * 9) * np.finfo(float).eps * np.linalg.norm(x) ** 2
    q = x
    for k in range(3):
        q = whitening.solve_right(q, whitening.cholesky(q.T @ q, shift if k == 0 else 0.0))
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-12
