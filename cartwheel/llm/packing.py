"""Packing of tokenised texts into sequences of bounded length.

A text longer than a sequence is cut into pieces; the pieces' lengths are
counted, which leaves a histogram with at most ``capacity`` entries whatever
the size of the data.  On the driver, the configuration linear program of that
histogram (as few sequences as possible, each filled by a configuration of
lengths, so that every length is covered as often as it occurs) is solved by
multiplicative weights: lengths that are little covered so far become dear, a
knapsack dynamic program finds the dearest configurations at these prices, and
these are used a bit more.  The fractional solution is rounded down; what is
left over is solved and rounded again, and the last rest goes by best fit.

Pieces of one length are interchangeable: they are numbered on the cluster,
and the n-th piece of a length goes to the n-th place planned for that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import bpe
from cartwheel.llm.common import chunks, stored

ROUNDS = 150  # prices per program
SEEDS = 32  # configurations taken at each price
RATE = 0.3  # by which the logarithm of a price falls when its length is covered once more
PROGRAMS = 4
BUCKETS = 256  # per length

Configuration = tuple[tuple[int, int], ...]  # (length, how often)


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for each room from 0 to ``capacity``, and the position of the
    length to take first there (-1: none)."""
    best, first = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        if n := fits[room]:
            values = best[room - lengths[:n]] + prices[:n]
            k = int(values.argmax())
            best[room], first[room] = values[k], k
    return best, first


def fractional(counts: dict[int, int], capacity: int) -> dict[Configuration, float]:
    """How often to use each configuration, scaled so that nine lengths of ten
    are covered at most once."""
    lengths = np.array(sorted(counts))
    demand = np.array([counts[n] for n in lengths], float)
    # prices start in proportion to length, which is optimal if all sequences can be filled
    weights, covered = np.log(lengths * demand / capacity), np.zeros(len(lengths))
    used: dict[Configuration, float] = {}
    for _ in range(ROUNDS):
        prices = np.exp(weights - RATE * covered - np.log(demand))
        _, first = _knapsack(lengths, prices, capacity)
        step = np.zeros(len(lengths))
        for seed in np.argsort(covered, kind="stable")[:SEEDS]:
            content, room = {int(seed): 1}, capacity - int(lengths[seed])
            while room and first[room] >= 0:
                k = int(first[room])
                content[k] = content.get(k, 0) + 1
                room -= int(lengths[k])
            amount = min(demand[k] / n for k, n in content.items())
            for k, n in content.items():
                step[k] += n * amount / demand[k]
            key = tuple(sorted((int(lengths[k]), n) for k, n in content.items()))
            used[key] = used.get(key, 0.0) + amount
        covered += step
    scale = 1 / np.quantile(covered, 0.9)
    return {c: x * scale for c, x in used.items()}


def best_fit(counts: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Longest first, each into the fullest sequence that has room."""
    rooms: list[int] = []  # sorted, each once
    open_: dict[int, dict[Configuration, int]] = {}

    def put(content: Configuration, room: int, n: int) -> None:
        if room not in open_:
            insort(rooms, room)
            open_[room] = {}
        open_[room][content] = open_[room].get(content, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                content, n = open_[room].popitem()
                took = min(n, left)
                if n > took:
                    open_[room][content] = n - took
                elif not open_[room]:
                    del open_[room], rooms[at]
                put(tuple(sorted({**dict(content), length: dict(content).get(length, 0) + 1}.items())), room - length, took)
                left -= took
            else:
                fit = min(capacity // length, left)
                put(((length, fit),), capacity - fit * length, left // fit)
                left %= fit
    total: dict[Configuration, int] = {}
    for contents in open_.values():
        for content, n in contents.items():
            total[content] = total.get(content, 0) + n
    return total


def solve(counts: dict[int, int], capacity: int) -> dict[Configuration, int]:
    """Number of sequences with each configuration; every piece is in one.  Never
    more sequences than plain best fit, whose plan is taken if it has fewer."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n > capacity or n < 1 for n in left):
        raise ValueError("a piece does not fit into a sequence")
    plan: dict[Configuration, int] = {}

    def take(content: Configuration, n: int) -> None:
        plan[content] = plan.get(content, 0) + n
        for length, k in content:
            left[length] -= n * k
            if not left[length]:
                del left[length]

    if capacity in left:
        take(((capacity, 1),), left[capacity])
    for _ in range(PROGRAMS):
        if len(left) < 2:
            break
        for content, x in sorted(fractional(left, capacity).items(), key=lambda c: (-c[1], c[0])):
            n = min(int(x), *(left.get(length, 0) // k for length, k in content))
            if n:
                take(content, n)
    for content, n in best_fit(left, capacity).items():
        plan[content] = plan.get(content, 0) + n
    plain = best_fit({n: c for n, c in counts.items() if c > 0}, capacity)
    return plan if sum(plan.values()) <= sum(plain.values()) else plain


@dataclass
class Places:
    """Runs of places for the pieces of each length, in the order of ``key``:
    length * 2^48 + rank of the first piece of the run."""

    key: np.ndarray
    each: np.ndarray  # pieces of the length in a sequence
    sequence: np.ndarray  # first sequence
    offset: np.ndarray  # of the first such piece in a sequence


def places(plan: dict[Configuration, int]) -> Places:
    rows, rank, sequence = [], {}, 0
    for content, n in sorted(plan.items()):
        offset = 0
        for length, k in content:
            at = rank.get(length, 0)
            rows.append((length << 48 | at, k, sequence, offset))
            rank[length] = at + k * n
            offset += k * length
        sequence += n
    return Places(*(np.array(c, np.int64) for c in (zip(*sorted(rows)) if rows else ((),) * 4)))


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 0,
           with_ids: bool = False) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32[, ids]): every whole text as
    ids, followed by the id ``end``, cut every ``capacity`` ids.  NULL and empty
    texts consist of the end alone."""
    content = df.sparkSession.sparkContext.broadcast(bpe.load(path))
    schema = df.select(F.col(key), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"),
                       F.lit(0).cast("long").alias("ids_crc32")).schema
    if with_ids:
        schema = schema.add("ids", "array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = bpe.vocabulary(content.value)
        for batch in chunks(batches, text):
            rows = vocab.encode(batch.column(text).to_pylist())
            ends = np.cumsum(rows.lengths)
            of, number, start, length, crc, ids = [], [], [], [], [], []
            for i, (a, b) in enumerate(zip(ends - rows.lengths, ends)):
                own = np.append(rows.values[a:b], end).astype("<u4")
                for k, at in enumerate(range(0, len(own), capacity)):
                    part = own[at: at + capacity]
                    of.append(i)
                    number.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            columns = [batch.column(key).take(pa.array(of, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            columns += [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def ranked(df: DataFrame, length: str, order: list[str], rank: str) -> DataFrame:
    """Adds gap-free numbers from 0 among the rows of each length.

    A length may hold most of the rows, so each is dealt to buckets by a hash
    of the ordering columns; rows that agree in those are interchangeable.
    """
    buckets = max(BUCKETS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    totals = dealt.groupBy(length, "_bucket").agg(F.count("*").alias("_total"))
    before = Window.partitionBy(length).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(length, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(length, "_bucket").orderBy(*order)
    return dealt.join(starts, [length, "_bucket"]).withColumn(
        rank, F.col("_start") + F.row_number().over(inside) - 1).drop("_bucket", "_start")


def pack(parts: DataFrame, order: list[str], capacity: int = 2048) -> DataFrame:
    """The rows of ``parts`` (one per piece, with its ``length``) and each one's
    ``sequence_id`` and ``offset``.  ``parts`` is read twice, so store it first.
    A sequence holds whole pieces without gaps and at most ``capacity`` ids.  An
    empty table gives an empty result."""
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = parts.sparkSession.sparkContext.broadcast(places(solve(histogram, capacity)))
    numbered = ranked(parts, "length", order, "_rank")
    keep = parts.columns
    schema = parts.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_rank"))
            run = np.searchsorted(at.key, length << 48 | rank, "right") - 1
            copy, k = np.divmod(rank - (at.key[run] & (1 << 48) - 1), at.each[run])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(at.sequence[run] + copy), pa.array(at.offset[run] + k * length)],
                names=[*keep, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)


def pack_texts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048) -> DataFrame:
    """Pieces of every whole text with their place in the sequences.  Rows with
    equal keys, NULL keys included, are packed like any others."""
    parts = stored(pieces(df, path, key, text, capacity), "pieces")
    return pack(parts, [key, "piece", "ids_crc32"], capacity)
