"""Exact top k by inner product in three phases with one threshold for all lists.

The components of the vectors are cut into ``lists`` groups.  Each group is a
list of its own, kept apart from the others: it knows, for a query, the part of
every vector's score that comes from its components.  Scores are sums of one
entry from each list.

1. Each list gives its best entries for each query.  The scores of these few
   vectors are resolved; the k-th best is a safe cutoff, as k vectors reach it.
2. The cutoff goes to all lists with the queries.  A vector that reaches it has
   an entry of at least cutoff / lists in some list, so each list gives all
   entries that large, and no other vector can be in the result.  A vector
   given by all lists has its exact score; these raise the cutoff.
3. Of the others, those whose given entries with less than cutoff / lists for
   each entry not given can still reach the raised cutoff are resolved by
   looking up the missing entries.

Lists are kept in blocks of vectors, queries in bundles; a task works out the
entries of one bundle in one block of one list.  Equal vectors are one entry;
they come back with their ids at the end.  All arithmetic is on integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

LISTS = 2
BLOCK = 4096  # vectors
BUNDLE = 1024  # queries
AT_ONCE = 1 << 20  # entries that a task holds at a time

EXACT = 1 << 53  # integers up to here are exact as doubles
LARGEST = float(1 << 63)


def _edges(width: int, lists: int) -> list[int]:
    return [width * j // lists for j in range(lists + 1)]


def _matrix(data: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(rows, width) if width else np.zeros((rows, 0), np.int64)


def _products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; those that doubles hold exactly go
    through the faster product of doubles."""
    if queries.size and points.size and float(np.abs(queries).max()) * float(np.abs(points).max()) * queries.shape[1] < EXACT:
        return queries.astype(np.float64) @ points.astype(np.float64).T
    return queries @ points.T


def _points(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Rows (id, width, point): floor(scale * component) as 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, widths, points = [], [], []
            for i, values in zip(batch.column("_id").to_pylist(), batch.column("_vector")):
                point = np.floor(values.values.to_numpy() * float(scale))
                width = len(point)
                if np.isfinite(point).all() and (not width or float(np.abs(point).max()) < (LARGEST / width) ** 0.5):
                    ids.append(i)
                    widths.append(width)
                    points.append(point.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(widths, pa.int32()), pa.array(points, pa.binary())],
                                             names=["id", "width", "point"])

    rows = df.select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_vector")).where(
        F.col("_id").isNotNull() & F.col("_vector").isNotNull() & ~F.exists("_vector", lambda x: x.isNull()))
    return rows.mapInArrow(run, "id long, width int, point binary")


def _packed(df: DataFrame, group: str, lists: int) -> DataFrame:
    """Rows (width, group, list, codes, points[, least]) from rows (width,
    group, code, point[, least]): the components of each list side by side."""
    carried = [c for c in ("least",) if c in df.columns]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        width, name = key[0].as_py(), key[1].as_py()
        order = np.argsort(rows.column("code").to_numpy(), kind="stable")
        codes = rows.column("code").to_numpy()[order]
        points = _matrix(b"".join(rows.column("point").to_pylist()), len(codes), width)[order]
        edges = _edges(width, lists)
        out = {"width": pa.array([width] * lists, pa.int32()), group: pa.array([name] * lists, pa.int32()), "list": pa.array(range(lists), pa.int32()),
               "codes": pa.array([codes.tobytes()] * lists, pa.binary()),
               "points": pa.array([points[:, a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())}
        for c in carried:
            out[c] = pa.array([rows.column(c).to_numpy()[order].tobytes()] * lists, pa.binary())
        return pa.table(out)

    extra = "".join(f", {c} binary" for c in carried)
    return df.groupBy("width", group).applyInArrow(run, f"width int, {group} int, list int, codes binary, points binary{extra}")


def _entries_of(met: DataFrame, best: int | None, lists: int) -> DataFrame:
    """Rows (width, list, query, code, part): for every query of a bundle its
    ``best`` largest entries in the block it meets, or all those that are
    large enough for its cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                queries, codes = np.frombuffer(row["queries"], "<i8"), np.frombuffer(row["codes"], "<i8")
                edges = _edges(row["width"], lists)
                own = edges[row["list"] + 1] - edges[row["list"]]
                asked, points = _matrix(row["asked"], len(queries), own), _matrix(row["points"], len(codes), own)
                least = None if best else np.frombuffer(row["least"], "<i8")
                step = max(1, AT_ONCE // len(codes))
                for start in range(0, len(queries), step):
                    parts = _products(asked[start:start + step], points)
                    if best and best < len(codes):
                        spots = np.argpartition(-parts, best - 1, axis=1)[:, :best]
                        q, x = np.repeat(np.arange(len(parts)), best), spots.ravel()
                    elif best:
                        q, x = np.divmod(np.arange(parts.size), len(codes))
                    else:
                        q, x = np.nonzero(parts >= least[start:start + step, None])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(q), row["width"], np.int32)), pa.array(np.full(len(q), row["list"], np.int32)),
                         pa.array(queries[start + q]), pa.array(codes[x]), pa.array(parts[q, x].astype(np.int64))],
                        names=["width", "list", "query", "code", "part"])

    return met.mapInArrow(run, "width int, list int, query long, code long, part long")


def _resolved(pairs: DataFrame, entries: DataFrame, asked: DataFrame, lists: int) -> DataFrame:
    """Rows (width, query, code, score) of pairs (width, query, code, part,
    seen): the entries of the lists that ``seen`` has no bit for are looked up
    and added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = batch.column("part").to_numpy().copy()
            widths, seen = batch.column("width").to_numpy(), batch.column("seen").to_numpy()
            for width in np.unique(widths):
                rows = np.flatnonzero(widths == width)
                q, x = [_matrix(b"".join(batch.column(c).take(pa.array(rows)).to_pylist()), len(rows), int(width)) for c in ("query_point", "point")]
                edges = _edges(int(width), lists)
                for j, (a, b) in enumerate(zip(edges, edges[1:])):
                    lacks = (seen[rows] >> j) & 1 == 0
                    score[rows[lacks]] += (q[lacks, a:b] * x[lacks, a:b]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("width"), batch.column("query"), batch.column("code"), pa.array(score)],
                                             names=["width", "query", "code", "score"])

    wide = pairs.join(entries.select("width", "code", "point"), ["width", "code"]).join(
        asked.select("width", "query", F.col("point").alias("query_point")), ["width", "query"])
    return wide.select("width", "query", "code", "part", "seen", "point", "query_point").mapInArrow(
        run, "width int, query long, code long, score long")


def _cutoff(known: DataFrame, k: int, name: str) -> DataFrame:
    """k-th best score of each query that has so many."""
    order = Window.partitionBy("width", "query").orderBy(F.col("score").desc(), "code")
    return known.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k).select("width", "query", F.col("score").alias(name))


def top(df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256, lists: int = LISTS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row that ``queries`` holds
    for, the ``k`` other rows with the largest inner product of
    floor(scale * component), best first, ties by the smaller id; fewer if
    there are no more.

    Left out are rows with a NULL id and vectors that are NULL, hold a NULL or
    a non-finite number, or are so large that a score need not fit a 64-bit
    integer.  Vectors meet those of their own length; empty ones score zero
    among each other.  Equal rows count once.  An id that comes with several
    vectors is a row for each; a query is not compared with its own row.  Only
    the two named columns and those of ``queries`` are read, so others may have
    any name.  An empty table, or one without queries, gives an empty result.
    """
    every, wanted = (1 << lists) - 1, k + 1  # one more: the query's own row
    rows = stored(_points(df, key, vector, scale).distinct(), "points")
    order = Window.partitionBy("width", "point").orderBy("id")
    # a vector on very many rows: all but its first ids are left out before the shuffle
    held = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= wanted)
    single = held.groupBy("width", "point").agg(F.array_sort(F.collect_list("id")).alias("members"))
    single = stored(single, "distinct")
    sizes = single.groupBy("width").agg(F.count("*").alias("_rows")).select("width", F.expr(f"cast((_rows + {BLOCK - 1}) div {BLOCK} as int)").alias("blocks"))
    dealt = single.join(sizes, "width").withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
    slot = F.row_number().over(Window.partitionBy("width", "block").orderBy("point"))
    entries = stored(dealt.withColumn("code", F.col("block") * F.lit(1 << 32) + slot).select("width", "block", "code", "point", "members"), "entries")
    asked_rows = _points(df.where(queries), key, vector, scale).distinct().join(
        entries.select("width", "point", F.col("code").alias("query")), ["width", "point"])
    asked_rows = stored(asked_rows.select(F.col("id").alias("query_id"), "width", "query", "point"), "asked")
    asked = asked_rows.select("width", "query", "point").distinct()
    slices = stored(_packed(entries.select("width", "block", "code", "point"), "block", lists), "slices")
    asked = stored(asked.withColumn("bundle", F.expr(f"cast(query % greatest(1, {asked.count()} div {BUNDLE}) as int)")), "queries")

    def met(asked: DataFrame) -> DataFrame:
        """Every bundle beside every block of every list."""
        bundles = _packed(asked.withColumnRenamed("query", "code"), "bundle", lists).withColumnsRenamed({"codes": "queries", "points": "asked"})
        spread = bundles.join(sizes, "width").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return slices.join(spread.drop("blocks", "bundle"), ["width", "list", "block"]).drop("block")

    # phase 1
    order = Window.partitionBy("width", "list", "query").orderBy(F.col("part").desc(), "code")
    firsts = _entries_of(met(asked), wanted, lists).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= wanted)
    seeds = firsts.select("width", "query", "code", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("seen")).distinct()
    known = stored(_resolved(seeds, entries, asked, lists), "seeds")
    cutoffs = _cutoff(known, wanted, "cutoff")
    # phase 2
    least = F.coalesce(F.expr(f"-((-cutoff - pmod(-cutoff, {lists}L)) div {lists}L)"), F.lit(-(1 << 63) + 1))
    told = stored(asked.join(cutoffs, ["width", "query"], "left").withColumn("least", least), "told")
    given = _entries_of(met(told.drop("cutoff")), None, lists)
    sums = stored(given.groupBy("width", "query", "code").agg(
        F.sum("part").alias("part"), F.bit_or(F.expr("shiftleft(1L, list)")).alias("seen")), "given")
    whole = sums.where(F.col("seen") == every).select("width", "query", "code", F.col("part").alias("score"))
    known = known.unionByName(whole).distinct()
    raised = _cutoff(known, wanted, "raised")
    # phase 3
    lacking = F.lit(lists) - F.bit_count("seen")
    rest = sums.where(F.col("seen") != every).join(told.select("width", "query", "cutoff"), ["width", "query"]).join(raised, ["width", "query"])
    reach = F.col("part").cast("decimal(38,0)") * lists + lacking * F.col("cutoff").cast("decimal(38,0)")
    rest = rest.where(reach > F.col("raised").cast("decimal(38,0)") * lists).select("width", "query", "code", "part", "seen")
    scored = known.unionByName(_resolved(rest, entries, asked, lists)).distinct()

    candidates = scored.join(entries.select("width", "code", "members"), ["width", "code"])
    order = Window.partitionBy("width", "query").orderBy(F.col("score").desc(), F.element_at("members", 1))
    best = candidates.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= wanted).groupBy("width", "query").agg(
        F.collect_list(F.struct("code", "score", "members")).alias("found"))
    rows = asked_rows.select("query_id", "width", "query").join(best, ["width", "query"]).select(
        "query_id", "width", "query", F.explode("found").alias("f")).select(
        "query_id", "width", "query", "f.code", "f.score", F.explode("f.members").alias("vec_id"))
    rows = rows.where((F.col("vec_id") != F.col("query_id")) | (F.col("code") != F.col("query")))
    order = Window.partitionBy("query_id", "width", "query").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
