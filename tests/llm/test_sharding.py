from collections import Counter

import pytest

from cartwheel.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 100, 997])
def test_permutation_is_one_to_one_and_invertible(n):
    assert sorted(sharding.permute(i, n, 7) for i in range(n)) == list(range(n))
    for i in range(n):
        assert sharding.locate(*sharding.place(i, n, 5, 7), n, 5, 7) == i


@pytest.mark.parametrize("n", [1, 2, 6, 500])
def test_rows_get_their_computed_place(spark, n):
    rows = [(i * 3, "x" * (i % 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard_rows(df, ["doc_id", "text"], 24, seed=9).collect()
    assert sorted(r.row_number for r in got) == list(range(n))
    for r in got:
        assert r.doc_id == 3 * r.row_number
        assert (r.shard, r.slot) == sharding.place(r.row_number, n, 24, 9)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min([*counts.values()] if len(counts) == 24 else [0]) <= 1


def test_repeated_rows_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, None)] * 40 + [(1, "a")] * 3 + [(2, None)], "shard long, _range string")
    got = sharding.shard_rows(df.withColumnRenamed("shard", "doc_id"), ["doc_id", "_range"], 4)
    assert got.count() == 44 and len({(r.shard, r.slot) for r in got.collect()}) == 44
    assert sharding.shard_rows(df.limit(0).withColumnRenamed("shard", "doc_id"), ["doc_id"], 4).collect() == []
