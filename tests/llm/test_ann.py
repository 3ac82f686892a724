import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemart.llm import ann
from quotemart.llm.ann import Block, longer, ordered, pivots, search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    """All inner products, nearest first, ties to smaller ids."""
    kept = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and any(v) and all(x is not None and np.isfinite(x) for x in v):
            kept[i] = max(kept.get(i, []), [float(np.float32(x)) for x in v])
    out = {}
    for q in kept:
        if q % every == 0:
            scores = sorted((-float(np.dot(v, kept[q])), i) for i, v in kept.items() if i != q and len(v) == len(kept[q]))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / len(w) for q, w in want.items() if w])


def test_footrule_equals_its_definition():
    rng = np.random.default_rng(0)
    block = Block(rng.normal(size=(50, 12)), 9.0, 40, 17, 1)
    query = rng.normal(size=(1, 12))
    mine = ordered(np.column_stack([query, [0.0]]), block.marks, 17)[0]
    theirs = ordered(longer(block.vectors, 9.0), block.marks, 17)
    place = lambda order: {p: k for k, p in enumerate(order)}
    for got, other in zip(block.close(mine), theirs, strict=True):
        a, b = place(mine), place(other)
        footrule = sum(abs(a.get(p, 17) - b.get(p, 17)) for p in a.keys() | b.keys())
        assert 17 * 18 - footrule == 2 * got


def test_pivots_are_axes_of_rotations():
    marks = pivots(10, 25)
    assert marks.shape == (25, 10) and np.allclose(marks[:10] @ marks[:10].T, np.eye(10)) and np.allclose((marks**2).sum(1), 1)


@pytest.mark.parametrize("kind", ["even", "clusters", "lengths"])
def test_recall_and_exact_scores(spark, monkeypatch, kind):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(6000, 32))
    if kind == "clusters":
        vectors = vectors[rng.integers(0, 40, 6000)] + 0.2 * vectors
    if kind != "lengths":
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    got, want = answers(search(spark.createDataFrame(rows, SCHEMA), every=100)), brute(rows, every=100)
    assert recall(got, want) >= 0.95 and got.keys() == want.keys()
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, score in found:
            assert score == pytest.approx(float(np.float32(vectors[i]).astype(float) @ np.float32(vectors[q]).astype(float)), abs=1e-12)


def test_small_and_odd_tables_are_answered_in_full(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k % 3), 1.0, -0.5 * (k % 2)], 1) for k in range(60)]
    rows += [(100, None, 1), (120, [0.0, 0.0, 0.0], 1), (140, [1.0, None, 1.0], 1), (160, [nan, 1.0, 1.0], 1), (180, [1.0, inf, 1.0], 1), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(20, [5.0, 5.0, 5.0], 1), (20, [5.0, 5.0, 5.0], 1), (200, [1.0, 2.0], 1), (201, [2.0, 2.0], 1), (220, [3.0], 1), (240, [], 1)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("vector", F.lit(1)).withColumn("SIZE", F.lit("x"))
    got, want = answers(search(table)), brute(rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    assert len(got[0]) == 20 and [i for i, _ in got[200]] == [201] and 220 not in got
    assert search(table.limit(0)).collect() == []


def test_more_blocks_change_no_full_answer(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=6)], 0) for k in range(300)]
    monkeypatch.setattr(ann, "ROWS", 40)
    monkeypatch.setattr(ann, "QUERIES", 4)
    assert recall(answers(search(spark.createDataFrame(rows, SCHEMA))), brute(rows)) == 1.0


@pytest.mark.parametrize("times", [10, 1000, 1e30])
def test_a_few_long_vectors_leave_the_others_apart(spark, times):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(6000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[[1, 7, 4321]] *= times
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    got, want = answers(search(spark.createDataFrame(rows, SCHEMA), every=100)), brute(rows, every=100)
    assert recall(got, want) >= 0.95 and got.keys() == want.keys()


def test_lengths_of_every_kind(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(6000, 16)) * np.exp(rng.normal(size=(6000, 1)))
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    assert recall(answers(search(spark.createDataFrame(rows, SCHEMA), every=100)), brute(rows, every=100)) >= 0.95


def test_values_whose_squares_exceed_all_doubles(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    table = lambda more: spark.createDataFrame(rows + more, "vec_id long, embedding array<double>, label int")
    huge = [(3001, [1e200] * 32, 0), (3003, [-1.7e308] * 16 + [1.7e308] * 16, 0)]
    got = answers(search(table(huge), every=100))
    for q in range(0, 3000, 100):
        scores = vectors @ vectors[q]
        best = [i for i in np.argsort(-scores) if i != q][:18]
        found = [i for i, _ in got[q]]
        high = {i for i, v, _ in huge if float(np.dot(v, vectors[q])) > 0}
        assert high <= set(found) and len(set(best) & set(found)) >= 15
