"""Nearest neighbours by inner product over a permutation index.

A vector is represented by the order in which it sees a set of pivots, cut
after ``PREFIX``: near vectors see the pivots in similar orders.  Vectors are
kept in blocks, and each block posts them, with the rank, to an inverted file
under each pivot of their prefix.  A query walks through the lists of its own
pivots; the sum of rank differences (footrule distance, pivots outside a
prefix counting as last) follows from the entries met.  The nearest ``SHARE``
of a block by footrule is ranked again by the exact inner product.

A task builds the few blocks of one group from their vectors and then reads the
queries one after another, so that it holds no more of either at larger sizes.

Inner products become distances by one more coordinate, which gives all stored
vectors the same length and is zero for queries.  Equal vectors are one entry
of the index; they come back with their ids at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

PIVOTS = 128
PREFIX = 48
SHARE = 0.25
LEAST = 16  # candidates of a block for each neighbour asked for, at least
BLOCK = 8192  # vectors of the index
GROUPS = 32  # groups of blocks that meet the queries in one place, if there are so many blocks
HELD = 8  # blocks of a group at most, but for one


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def _entries(df: DataFrame, key: str, vector: str, ids: int) -> DataFrame:
    """Rows (point, members): each valid vector once, as bytes, and its
    smallest ``ids`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, set[int]] = {}
            for i, values in zip(batch.column("_id").to_pylist(), batch.column("_vector").to_pylist()):
                point = np.array(values, np.float64) + 0.0  # one zero
                if np.isfinite(point).all() and point.any():
                    found.setdefault(point.astype("<f8").tobytes(), set()).add(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array([sorted(x)[:ids] for x in found.values()], pa.list_(pa.int64()))],
                names=["point", "members"])

    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).cast("long").alias("_id"), v.alias("_vector")).where(
        F.col("_id").isNotNull() & (F.size("_vector") > 0) & ~F.exists("_vector", lambda x: x.isNull()))
    # a vector shared by many rows has a few ids for each batch
    return rows.mapInArrow(run, "point binary, members array<long>").groupBy("point").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))), 1, ids).alias("members"))


def _raise(points: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (points * points).sum(axis=1), 0))
    return np.concatenate([points, rest[:, None]], axis=1)


def _prefixes(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each vector, nearest first (ties: the first)."""
    return np.argsort(-(points @ pivots.T), axis=1, kind="stable")[:, :PREFIX]


class Block:
    """Vectors of one block with their inverted file."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, pivots: np.ndarray, longest: float):
        self.ids, self.points = ids, points
        prefix = _prefixes(_raise(points, longest), pivots)
        flat = prefix.ravel()
        order = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[order], np.arange(len(pivots) + 1))
        spots, ranks = np.divmod(order, prefix.shape[1])
        self.lists = [(spots[a:b], ranks[a:b]) for a, b in zip(ends, ends[1:])]

    def search(self, query: np.ndarray, prefix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the best ``k`` among the share of the block
        that is nearest by footrule; a larger gain is a smaller distance."""
        width = len(prefix)
        gain = np.zeros(len(self.ids))
        for rank, pivot in enumerate(prefix):
            spots, ranks = self.lists[pivot]
            gain[spots] += (2 * width - rank) - ranks - np.abs(ranks - rank)
        keep = min(len(gain), max(int(np.ceil(SHARE * len(gain))), LEAST * k))
        near = np.argpartition(-gain, keep - 1)[:keep]
        scores = self.points[near] @ query
        if len(near) > k:
            edge = np.partition(scores, len(near) - k)[len(near) - k]
            near, scores = near[scores >= edge], scores[scores >= edge]
        best = np.lexsort([self.ids[near], -scores])[:k]
        return self.ids[near[best]], scores[best]


def _merged(found: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of what several blocks have found."""
    ids, scores = (np.concatenate(x) for x in zip(*found))
    best = np.lexsort([ids, -scores])[:k]
    return ids[best], scores[best]


def nearest(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, pivots: int = PIVOTS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row that ``queries``
    holds for, the ``k`` rows found with the largest inner product, itself
    excluded, best first, ties by the smaller id.

    Left out are rows with a NULL id, and vectors that are NULL, empty, zero or
    hold a NULL or non-finite number; of vectors of several lengths, those of
    the most frequent length take part (ties: the shorter).  Equal rows count
    once.  A vector asked for under several ids is searched once.  The index
    is fitted on ``pivots`` vectors, taken in the order of a hash; all vectors
    are indexed.  Fewer than k rows are returned if there are no more.
    """
    spark = df.sparkSession
    sizes = df.groupBy(F.size(vector).alias("n")).agg(F.count("*").alias("rows")).where("n > 0")
    usual = sizes.orderBy(F.col("rows").desc(), "n").first()
    width = usual["n"] if usual else 1
    df = df.where(F.size(vector) == width)
    entries = stored(_entries(df, key, vector, k + 1).withColumn("id", F.element_at("members", 1)), "vectors")
    n = entries.count()
    schema = "query long, id long, score double"
    asked = df.where(queries).select(F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("_vector"))
    asked_points = stored(_entries(asked, "query_id", "_vector", 1).select("point").join(entries, "point").select("id", "point"), "queries")
    blocks = max(1, -(-n // BLOCK))
    groups = max(min(blocks, GROUPS), -(-blocks // HELD))
    rows = entries.select("point").orderBy(F.xxhash64(F.lit("pivots"), "point"), "point").limit(pivots).collect()
    centres = np.array([np.frombuffer(r["point"], "<f8") for r in rows]).reshape(-1, width)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = _matrix(batch.column("point"))
                yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((p * p).sum(axis=1).max()))])], names=["longest"])

    longest = entries.select("point").mapInArrow(lengths, "longest double").agg(F.max("longest")).first()[0] or 1.0
    shared = spark.sparkContext.broadcast((_raise(centres, longest), longest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raised, longest = shared.value
        group, held, whole = None, {}, []  # vectors by block, then the blocks
        for batch in batches:
            columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("group", "asks", "block", "id")]
            changes = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns[:3]], axis=0)) + 1
            for start, end in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
                if start == end:
                    continue
                now, asks, block, ids = (x[start:end] for x in columns)
                points = _matrix(batch.column("point").slice(start, end - start))
                if now[0] != group:
                    group, held, whole = now[0], {}, []
                if not asks[0]:
                    held.setdefault(block[0], []).append((ids, points))
                    continue
                while held:
                    parts = held.pop(next(iter(held)))
                    whole.append(Block(*(np.concatenate(x) for x in zip(*parts)), raised, longest))
                prefixes = _prefixes(points, raised[:, :-1])
                for at in range(0, len(ids), 256):
                    found = [_merged([b.search(q, p, k + 1) for b in whole], k + 1) for q, p in zip(points[at: at + 256], prefixes[at: at + 256])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids[at: at + 256], [len(f[0]) for f in found])),
                         pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))],
                        names=["query", "id", "score"])

    dealt = entries.select("id", "point", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"))
    dealt = dealt.withColumn("group", F.col("block") % groups)
    asking = asked_points.select("id", "point", F.lit(-1).alias("block"), F.lit(True).alias("asks"),
                                 F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    # the vectors of a group come before its queries; more partitions than groups, as several may fall into one
    met = dealt.unionByName(asking).repartition(2 * groups, "group").sortWithinPartitions("group", "asks", "block", "id").mapInArrow(run, schema)

    def first(df: DataFrame, group: str, n: int) -> DataFrame:
        order = Window.partitionBy(group).orderBy(F.col("score").desc(), "id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    # k + 1 vectors hold the k + 1 nearest rows, as each has at least one; then the same for their ids
    best = first(met, "query", k + 1).join(entries.select("id", "members"), "id").select("query", "score", F.explode("members").alias("id"))
    best = first(best, "query", k + 1).groupBy("query").agg(F.collect_list(F.struct("rank", "id", "score")).alias("found"))
    points = _askers(asked, width).join(entries.select("point", F.col("id").alias("query")), "point").select("query_id", "query")
    rows = points.join(best, "query").select("query_id", F.explode("found").alias("f")).select("query_id", "f.id", "f.score").where(
        "id != query_id")
    return first(rows, "query_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _askers(asked: DataFrame, width: int) -> DataFrame:
    """Distinct rows (query_id, point) of the valid queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, points = [], []
            for i, values in zip(batch.column("query_id").to_pylist(), batch.column("_vector").to_pylist()):
                point = np.array(values, np.float64) + 0.0
                if np.isfinite(point).all() and point.any():
                    ids.append(i)
                    points.append(point.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(points, pa.binary())], names=["query_id", "point"])

    whole = F.col("query_id").isNotNull() & ~F.exists("_vector", lambda x: x.isNull())
    return asked.where(whole).mapInArrow(run, "query_id long, point binary").distinct()
