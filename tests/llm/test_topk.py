import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import topk

ASKED = "vec_id % 50 = 0"


def brute(rows, k=5):
    """By (query id, own vector): the best (id, score)."""
    valid = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    found = {}
    for q, v in valid:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in valid if (i, w) != (q, v) and len(w) == len(v))
            found.setdefault(q, []).append([(i, -s) for s, i in scored[:k]])
    return {q: sorted(lists) for q, lists in found.items()}


def run(spark, rows, parts=4, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as width", "3 as code", "4 as rank")
    found = {}
    for r in topk.top(df.repartition(parts), F.expr(ASKED), **more).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return found


def same(got, want, k=5):
    got = {q: [(i, s) for _, i, s in sorted(rows)] for q, rows in got.items()}
    assert got == {q: lists[0] for q, lists in want.items() if lists[0]}


@pytest.mark.parametrize("lists", [1, 2, 3, 5])
def test_equals_brute_force(spark, monkeypatch, lists):
    monkeypatch.setattr(topk, "BLOCK", 300)
    monkeypatch.setattr(topk, "BUNDLE", 5)
    pick = np.random.default_rng(lists)
    centres = pick.normal(size=(6, 13))
    vectors = [(centres[pick.integers(6)] + pick.normal(size=13) * 0.4) * pick.choice([0.01, 1, 1]) for _ in range(1500)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    same(run(spark, rows, lists=lists), brute(rows))


def test_hot_vector_ties_and_odd_rows(spark):
    pick = random.Random(2)
    hot = [1.0, -2.0, 0.5]
    rows = [(i, hot) for i in range(600)] + [(i, hot) for i in range(0, 600, 3)]
    rows += [(1000 + i, [float(pick.randint(-2, 2)) for _ in range(3)]) for i in range(300)]
    rows += [(None, hot), (2000, None), (2050, [1.0, None, 1.0]), (2100, [float("nan"), 0.0, 0.0]), (2150, [float("inf"), 0.0, 0.0]),
             (2200, [1e300, 0.0, 0.0]), (2250, [0.0, 0.0, -0.0]), (2300, []), (2301, []), (2350, [1.0, 1.0]), (2351, [3.0, 3.0]), (2400, [1.0])]
    want = brute([r for r in rows if r[0] != 2200])
    got = run(spark, rows)
    same(got, want)
    assert [i for _, i, _ in sorted(got[2300])] == [2301] and 2400 not in got and 2200 not in got


def test_one_id_with_several_vectors(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [2.0, 1.0]), (2, [1.0, 3.0])]
    got = run(spark, rows)
    assert sorted(got[50]) == sorted((n, i, s) for found in brute(rows)[50] for n, (i, s) in enumerate(found, 1))


def test_large_components_are_exact(spark):
    pick = random.Random(3)
    rows = [(i, [float(pick.randint(-10**5, 10**5)) + pick.random() for _ in range(8)]) for i in range(120)]
    same(run(spark, rows), brute(rows))


def test_few_rows(spark):
    rows = [(0, [1.0, 0.5]), (50, [2.0, 0.0]), (3, [0.0, 1.0])]
    same(run(spark, rows), brute(rows))
    assert run(spark, rows[2:]) == {} and run(spark, rows[:1]) == {}
    assert run(spark, rows, parts=1, k=1).keys() == {0, 50}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert topk.top(df.limit(0), F.expr(ASKED)).collect() == []
