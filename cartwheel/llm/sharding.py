"""Sharding by a keyed permutation of global row numbers.

Rows get gap-free numbers 0..n-1 in the order of their key columns.  A Feistel
network permutes the numbers: its domain is a square of side ceil(sqrt(n)),
and a result outside 0..n-1 is fed in again (cycle walking) until it falls
inside, which keeps the mapping one to one.  The permuted number p gives
``shard = p mod shards`` and ``slot = p div shards``, so shard sizes differ by
one row at most, slots have no gaps, and ``place`` computes a row's shard and
slot, ``locate`` the row at a shard and slot, without any table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

ROUNDS = 6
# Round function: two multiply-and-fold steps on numbers below 2^31, whose
# products fit a signed 64-bit integer.
MULTIPLIER = 1_540_483_477
MODULUS = 2_147_483_647


def _round_keys(seed: int) -> list[int]:
    keys, x = [], seed % MODULUS
    for _ in range(ROUNDS):
        x = (x * 48_271 + 11) % MODULUS
        keys.append(x)
    return keys


def _side(n: int) -> int:
    side = int(np.sqrt(n))
    while side * side < n:
        side += 1
    if side > MODULUS:
        raise ValueError("more rows than the round function can number")
    return max(side, 1)


def _mix(x, key):
    """Same arithmetic for integers, numpy arrays and columns."""
    x = ((x + key) % MODULUS) * MULTIPLIER % MODULUS
    return (x + (F.shiftright(x, 16) if isinstance(x, Column) else x >> 16)) * 69_621 % MODULUS


def _pass(x, side: int, keys: Sequence[int]):
    left, right = x // side, x % side
    for key in keys:
        left, right = right, (left + _mix(right, key)) % side
    return left * side + right


def _unpass(x, side: int, keys: Sequence[int]):
    left, right = x // side, x % side
    for key in reversed(keys):
        left, right = (right - _mix(left, key)) % side, left
    return left * side + right


def permute(number: int, n: int, seed: int = 0) -> int:
    """Permuted number of one row."""
    side, keys = _side(n), _round_keys(seed)
    x = _pass(number, side, keys)
    while x >= n:
        x = _pass(x, side, keys)
    return x


def place(number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a global row number."""
    p = permute(number, n, seed)
    return p % shards, p // shards


def locate(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """Global row number at a shard and slot."""
    side, keys = _side(n), _round_keys(seed)
    x = _unpass(slot * shards + shard, side, keys)
    while x >= n:
        x = _unpass(x, side, keys)
    return x


def _walks(n: int, side: int, keys: Sequence[int]) -> int:
    """Most passes that any number needs.  Only the side^2 - n points outside
    (fewer than 2 * sqrt(n) + 1) can prolong a walk, so they alone are tried.
    Some come inside at every step until the longest walk has ended; those that
    stay lie on cycles that no number from inside enters."""
    outside, walks = np.arange(n, side * side, dtype=np.int64), 0
    while True:
        walks += 1
        after = _pass(outside, side, keys)
        after = after[after >= n]
        if len(after) == len(outside):
            return walks
        outside = after


def permuted(df: DataFrame, number: str, n: int, result: str, seed: int = 0) -> DataFrame:
    """Adds the permuted number, by one projection per round."""
    side, keys = _side(n), _round_keys(seed)
    df = df.withColumn(result, F.col(number))
    for walk in range(_walks(n, side, keys)):
        df = df.withColumns({"_left": F.expr(f"`{result}` div {side}"), "_right": F.col(result) % side})
        for key in keys:
            df = df.select(
                *[c for c in df.columns if c not in ("_left", "_right")], F.col("_right").alias("_left"),
                ((F.col("_left") + _mix(F.col("_right"), key)) % side).alias("_right"),
            )
        walked = F.col("_left") * side + F.col("_right")
        df = df.withColumn(result, walked if walk == 0 else F.when(F.col(result) < n, F.col(result)).otherwise(walked))
    return df.drop("_left", "_right")


def numbered(df: DataFrame, keys: Sequence[str], number: str) -> tuple[DataFrame, int]:
    """``keys`` of every row with gap-free numbers from 0 in key order (NULLs
    first), and the count of rows.

    Equal rows are counted before the sort and spread out after it, so that a
    row repeated any number of times is one row in every shuffle.  The counts
    are stored by sorted range; each range starts where the ranges before it
    end.
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    ranges = stored(
        counted.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
        .withColumn("_range", F.spark_partition_id()), "numbered",
    )
    totals = ranges.groupBy("_range").agg(F.sum("_rows").alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, that is per shuffle partition
    starts = totals.withColumn("_start", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    inside = Window.partitionBy("_range").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    first = F.col("_start") + F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")
    spread = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_rows") - 1))
    rows = ranges.join(starts, "_range").withColumn("_first", first).select(*keys, spread.alias(number))
    n = ranges.agg(F.sum("_rows")).first()[0] or 0
    return rows, n


def shard_rows(df: DataFrame, keys: Sequence[str], shards: int, seed: int = 0) -> DataFrame:
    """``keys`` of every row with ``row_number``, ``shard`` and ``slot``.

    The rows of a table that agree in all keys are interchangeable and get as
    many places as there are rows.  NULL keys are values like any other; an
    empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    rows, n = numbered(df.select(*keys), keys, "row_number")
    if not n:
        return rows.select(*keys, "row_number", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    return permuted(rows, "row_number", n, "_place", seed).select(
        *keys, "row_number", (F.col("_place") % shards).cast("int").alias("shard"),
        F.expr(f"_place div {shards}").alias("slot"),
    )
