import math

import numpy as np
from pyspark.sql import functions as F

from cartwheel.llm import neighbours


def brute(rows, k):
    valid = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    result = {}
    for q, v in valid:
        if q % 20 == 0:
            found = sorted((-float(np.dot(v, w)), i) for i, w in valid if i != q and len(w) == len(v))
            result[q] = [i for _, i in found[:k]]
    return result


def test_recall_on_vectors_of_all_lengths(spark):
    pick = np.random.default_rng(5)
    vectors = pick.normal(size=(3000, 24)) * pick.lognormal(0, 0.4, size=(3000, 1))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as point").repartition(5)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = brute(rows, 20)
    assert got.keys() == want.keys()
    hits = 0
    for q, ranks in got.items():
        assert sorted(ranks) == list(range(1, 21))
        pairs = [ranks[i] for i in sorted(ranks)]
        assert all((-s, i) < (-t, j) for (i, s), (j, t) in zip(pairs, pairs[1:]))
        assert all(abs(s - float(np.dot(vectors[q], vectors[i]))) < 1e-9 for i, s in pairs)
        hits += len({i for i, _ in pairs} & set(want[q]))
    assert hits / (20 * len(want)) > 0.9


def test_odd_vectors_and_copies(spark):
    hot = [1.0, 2.0, -1.0]
    rows = [(i, hot) for i in range(0, 400)] + [(1000 + i, [float(i % 7), 1.0, float(i % 5)]) for i in range(41)]
    rows += [(None, hot), (2000, None), (2020, []), (2040, [0.0, -0.0, 0.0]), (2060, [1.0, None, 2.0]), (2080, [float("nan"), 1.0, 1.0]),
             (2100, [float("inf"), 1.0, 1.0]), (2120, [1.0, 2.0]), (20, hot), (1000, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute([r for r in rows if r[0] != 2120], 20)
    assert got == want


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.5]), (20, [2.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20, 2.0), (0, 2, 3, 0.5), (20, 1, 0, 2.0), (20, 2, 3, 0.0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert neighbours.nearest(df, F.col("vec_id") < 0).collect() == []


def test_rows_sent_to_python_hold_one_vector_and_groups_lose_none(spark, monkeypatch):
    pick = np.random.default_rng(7)
    vectors = pick.normal(size=(1200, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    widest, send = [], type(df).mapInArrow

    def noted(frame, *args, **named):
        binary = [F.max(F.length(name)) for name, kind in frame.dtypes if kind == "binary"]
        if binary:
            widest.extend(x for x in frame.agg(*binary).first() if x)
        return send(frame, *args, **named)

    monkeypatch.setattr(type(df), "mapInArrow", noted)
    monkeypatch.setattr(neighbours, "BLOCK", 40)  # 30 blocks
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    want = brute(rows, 5)
    for groups, held in ((32, 8), (2, 8), (1, 30)):
        monkeypatch.setattr(neighbours, "GROUPS", groups, raising=False)
        monkeypatch.setattr(neighbours, "HELD", held, raising=False)
        got = {}
        for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == want  # a block's candidates are all of its vectors
    assert widest and max(widest) <= 8 * 8
