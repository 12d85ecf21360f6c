import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import lsh, maxscore

VECTORS = "vec_id long, embedding array<float>, score double, rank int"


def vectors(seed, n, d=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[n // 2:n // 2 + 60] = x[3]                       # a group of copies
    x[n // 2 + 60:n // 2 + 70] = x[3] * 2              # same direction
    return x


def table(spark, x, extra=()):
    return spark.createDataFrame([(i, [float(v) for v in r], 0.0, 0) for i, r in enumerate(x)] + list(extra), VECTORS)


ODD = [(1000, None, 0.0, 0), (1050, [0.0] * 24, 0.0, 0), (1100, [float("nan")] * 24, 0.0, 0), (1150, [None] * 24, 0.0, 0),
       (1200, [float("inf")] + [0.0] * 23, 0.0, 0), (None, [1.0] * 24, 0.0, 0)]


def test_maxscore_equals_brute_force(spark):
    x = vectors(1, 400)
    t = np.floor(256 * x.astype(float)).astype(np.int64)
    df = maxscore.integer_vectors(table(spark, x, [*ODD, (5, [float(v) for v in x[5]], 0.0, 0)]))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in
           maxscore.search(df, F.col("vec_id") % 50 == 0, shard_rows=90, query_rows=3).collect()}
    ids = np.append(np.arange(400), 1050)
    t = np.vstack([t, np.zeros((1, 24), np.int64)])
    want = {}
    for q in np.flatnonzero(ids % 50 == 0):
        s = t @ t[q]
        order = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        want |= {(int(ids[q]), k + 1): (int(ids[j]), int(s[j])) for k, j in enumerate(order)}
    assert got == want
    assert maxscore.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert maxscore.search(df, F.col("vec_id") < 0).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_top_k_of_a_shard_with_sparse_terms_and_ties(block):
    rng = np.random.default_rng(2)
    p = rng.integers(-3, 4, (200, 9)) * (rng.random((200, 9)) < 0.4)
    ids = rng.permutation(200)
    for q in range(30):
        s = p @ p[q]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:5]
        assert maxscore.top_k(ids, p, int(ids[q]), p[q], 5, block) == [(int(s[i]), int(ids[i])) for i in order]


def test_neighbours(spark):
    x = vectors(3, 600)
    df = table(spark, x, [*ODD, (7, [float(v) for v in x[7]], 0.0, 0)])
    got = lsh.search(df, F.col("vec_id") % 50 == 0, block=64).collect()
    u = x.astype(float)
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    found = total = 0
    for q in range(0, 600, 50):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        s = u @ u[q]
        order = [j for j in np.lexsort((np.arange(600), -s.round(12))) if j != q][:5]
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5] and q not in [v for _, v, _ in own]
        assert all(abs(score - s[v]) < 1e-12 for _, v, score in own)
        found += len({v for _, v, _ in own} & set(order))
        total += 5
    assert found / total >= 0.9
    assert {r["query_id"] for r in got} == set(range(0, 600, 50))
    assert lsh.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_few_vectors_and_copies_only(spark):
    one = [1.0, 2.0, 3.0]
    few = spark.createDataFrame([(0, one, 0.0, 0), (50, one, 0.0, 0), (3, one, 0.0, 0)], VECTORS)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in lsh.search(few, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 3), (0, 2, 50), (50, 1, 0), (50, 2, 3)]


def test_few_distinct_vectors_give_every_place(spark):
    """Eight unlike vectors, each a query: five rows each, exact ones."""
    x = np.random.default_rng(11).standard_normal((9, 64)).astype(np.float32).astype(float)
    rows = [(50 * i, [float(v) for v in x[i]], 0.0, 0) for i in range(8)] + [(7, [float(v) for v in x[8]], 0.0, 0), (9, [1e-20] * 64, 0.0, 0)]
    got = lsh.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0).collect()
    v = np.vstack([x, np.ones(64)])
    ids = np.array([50 * i for i in range(8)] + [7, 9])
    u = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
    hits = 0
    for q in range(8):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 50 * q)
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5] and 50 * q not in [i for _, i, _ in own]
        s = dict(zip(ids.tolist(), u @ u[q]))
        assert all(abs(score - s[i]) < 1e-12 for _, i, score in own)
        hits += len({i for _, i, _ in own} & {int(ids[j]) for j in [j for j in np.argsort(-(u @ u[q])) if j != q][:5]})
    assert len(got) == 40 and hits >= 36


def test_exact_pass_alone_in_blocks(spark):
    """With one probe nearly every query lacks candidates."""
    x = np.random.default_rng(5).standard_normal((90, 24)).astype(np.float32)
    df = table(spark, x)
    classes, _ = lsh.classes_of(df, F.col("vec_id") % 3 == 0, 6)
    nothing = spark.createDataFrame([], "q1 long, q2 long, v1 long, v2 long, score double, first long")
    got = lsh._completed(nothing, classes, 5, rows=20, asking=7).join(
        classes.select(F.col("v1").alias("q1"), F.col("v2").alias("q2"), F.col("ids")[0].alias("q")), ["q1", "q2"]).collect()
    u = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(axis=1, keepdims=True))
    for q in range(0, 90, 3):
        own = sorted(((-r["score"], r["first"]) for r in got if r["q"] == q))
        order = np.lexsort((np.arange(90), -(u @ u[q]).round(12)))[:6]
        assert {i for _, i in own} == set(order.tolist())


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(4).standard_normal((5, 32))
    assert np.allclose(np.linalg.norm(lsh.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(lsh.hadamard(lsh.hadamard(x)), x)


def test_one_id_on_several_vectors_takes_one_place():
    ids = np.array([1, 2, 2, 2, 3, 4, 4, 5])
    p = np.array([[9, 0], [9, 0], [8, 0], [7, 1], [6, 0], [5, 0], [9, 1], [1, 0]])
    for block in (1, 3, 100):
        assert maxscore.top_k(ids, p, 1, p[0], 3, block) == [(81, 2), (81, 4), (54, 3)]
