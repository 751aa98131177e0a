import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import ordering as O


def ranked(values):
    known = sorted((v for v in values if v is not None), reverse=True)
    return [known.index(v) + 1 if v is not None else len(known) + 1 for v in values]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; some are NULL."""
    rng = random.Random(5)
    values = [0.0] * 1000 + [None] * 20 + [round(rng.uniform(-50, 50), 1) for _ in range(1500)] + [1e9]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    return values, df


def test_global_rank(skewed):
    values, df = skewed
    got = {r.id: r.rk for r in O.global_rank(df, "v", "rk").collect()}
    assert [got[i] for i in range(len(values))] == ranked(values)


def test_exact_quantiles(skewed):
    values, df = skewed
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    row = O.exact_quantiles(df, "v", wanted).first()
    known = [v for v in values if v is not None]
    assert list(row) == pytest.approx([np.quantile(known, p) for p in wanted], abs=1e-9)


def test_quantiles_of_many_rows_read_twice_and_stored_nowhere(spark, tmp_path):
    """More rows than a sketch holds: the bracket is narrow, the answer exact."""
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(0, 2, 60_000).round(3), np.full(30_000, 7.25), [np.nan] * 5])
    path = str(tmp_path / "values")
    spark.createDataFrame([(float(v),) for v in values], "v double").repartition(8).write.parquet(path)
    df, known = spark.read.parquet(path), values[~np.isnan(values)]
    got = O.exact_quantiles(df, "v", [0.01, 0.5, 0.75, 0.999])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert list(got.first()) == pytest.approx([np.quantile(known, p) for p in (0.01, 0.5, 0.75, 0.999)], abs=1e-9)
    assert plan.count("Scan parquet") <= 4  # before equal shuffles are reused: two branches and the sketch
    for name, column in (("e", F.col("v")), ("d", F.col("v").cast("decimal(12,3)"))):
        one = O.median(df.select(column.alias(name)).where(f"not isnan({name})"), name).first().q0
        assert one == pytest.approx(np.quantile(known, 0.5), abs=1e-9)


def test_a_quantile_outside_its_bracket_fails(spark, monkeypatch):
    monkeypatch.setattr(O, "SKETCH_SIZE", 200)
    monkeypatch.setattr(O, "RANK_ERROR", 1e-9)  # a bracket of one value, where two are needed
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"))
    with pytest.raises(Exception, match="outside its bracket"):
        O.median(df, "v").collect()


def test_quantiles_per_group(spark):
    rng = random.Random(9)
    data = [(g, rng.gauss(0, 10**i)) for i, g in enumerate("abc") for _ in range(301 + i)]
    df = spark.createDataFrame(data, "g string, v double")
    for r in O.exact_quantiles(df, "v", [0.25, 0.5], ["g"]).collect():
        mine = [v for g, v in data if g == r.g]
        assert [r.q0, r.q1] == pytest.approx([np.quantile(mine, 0.25), np.quantile(mine, 0.5)])


def test_median_of_nothing_is_no_row_or_null(spark):
    got = O.median(spark.createDataFrame([(None,)], "v double"), "v").collect()
    assert [r.q0 for r in got] == [None]


def test_ids_are_gap_free_stable_and_follow_the_taken_ones(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    taken = spark.createDataFrame([(41,)], "nid long")
    first = {r.k: r.nid for r in O.assign_ids(df, "k", "nid", taken).collect()}
    again = {r.k: r.nid for r in O.assign_ids(df.repartition(7), "k", "nid", taken).collect()}
    assert sorted(first.values()) == list(range(42, 1042))
    assert first == again
    assert min(O.assign_ids(df, "k", "nid", taken.where("nid < 0")).collect(), key=lambda r: r.nid).nid == 1


def test_hash_positions_per_group(spark):
    df = spark.range(500).select("id", (F.col("id") % 10 == 0).alias("g"))
    got = O.hash_positions(df, F.md5(F.col("id").cast("string")), "pos", ["g"], size="n").collect()
    for g, n in ((True, 50), (False, 450)):
        assert sorted(r.pos for r in got if r.g == g) == list(range(1, n + 1))
        assert {r.n for r in got if r.g == g} == {n}


def test_top_k_ranked_shares_ranks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 4.0), (4, 9.0)], "id long, v double")
    got = [(r.id, r.rk) for r in O.top_k_ranked(df, 3, "v", "id", "rk").orderBy("rk", "id").collect()]
    assert got == [(4, 1), (1, 2), (2, 2)]


def test_describe(spark):
    df = spark.createDataFrame([(float(i), i * 2) for i in range(10)], "a double, b long")
    a = {r.feature: r for r in O.describe(df, ["a", "b"]).collect()}["a"]
    assert (a["count"], a["mean"], a["min"], a["p25"], a["p50"], a["p75"], a["max"]) == (10, 4.5, 0.0, 2.25, 4.5, 6.75, 9.0)
    assert a["std"] == pytest.approx(np.std(range(10), ddof=1))


def test_no_window_takes_a_whole_table(skewed, capsys):
    """Windows without PARTITION BY see bucket totals only, never table rows."""
    _, df = skewed
    for plan in (O.global_rank(df, "v", "rk"), O.exact_quantiles(df, "v", [0.5]), O.describe(df, ["v"])):
        plan.explain("extended")
        text = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical")[0]
        for line in text.split("\n"):
            if "Window [" in line and "_bucket" not in line and "_total" not in line:
                raise AssertionError(line)
