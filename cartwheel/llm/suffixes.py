"""Exact repeated byte strings by a depth-limited radix sort of suffixes.

Every string of ``depth`` bytes that also starts earlier in the corpus is
found, most significant digit first, and only suffixes that still have an
equal go on to the next digit:

1. The first digit is the string's anchor, the substring of ``digit`` bytes
   with the smallest hash (the leftmost of equals).  Equal strings have equal
   anchors at equal places, so strings that share an anchor in the text travel
   as one row: about one row for every 40 bytes.
2. The second digit is the whole context of such a row.  Among rows with equal
   context all but the earliest are repeated outright.  Anchors that occur in
   one context only are done.
3. What remains are the earliest rows of anchors with several contexts, at the
   borders of repeated passages.  Their strings are sorted one by one by their
   last digit, a hash of all ``depth`` bytes.

Rows are combined within a chunk of text before the first shuffle, so that a
passage found in a third of all documents is one row per chunk.  In the last
pass the contexts of a crowded anchor are dealt to blocks; what its blocks have
not settled meets again string by string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import chunks, joined_texts, stored

DIGIT = 24
BLOCK = 32  # contexts of an anchor compared in one place
SLICE = 1 << 18  # bytes hashed at a time
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse


def _powers(n: int) -> tuple[np.ndarray, ...]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x, np.uint64)])) for x in (BASE, inverse))


def _values() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


class Hasher:
    """Hashes of all substrings of a slice, from one pass over it."""

    def __init__(self, size: int):
        self.up, self.down = _powers(size + 1)
        self.value = _values()

    def sums(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum(self.value[data] * self.up[: len(data)], dtype=np.uint64)])

    def hash(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def anchors(hasher: Hasher, data: np.ndarray, limit: np.ndarray, depth: int, digit: int):
    """data: bytes of a slice; limit[i]: whether a string of ``depth`` bytes that
    starts at i stays in its document.  Returns (anchor, first, last, digest of
    the anchor's digit, digest of all bytes) of the runs of strings that share
    an anchor."""
    n = len(data) - digit + 1
    sums = hasher.sums(data)
    spot = np.arange(n)
    gram = mix((sums[digit:] - sums[:n]) * hasher.down[:n])
    key = (gram & np.uint64(0xFFFFFFFF00000000)) | spot.astype(np.uint64)
    width, have = depth - digit + 1, 1
    least = key
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    starts = np.flatnonzero(limit[: len(least)])
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    first, last = starts[cut], starts[np.append(cut[1:], len(starts)) - 1]
    anchor = at[cut]
    whole = mix(hasher.hash(sums, first, last + depth) + mix((anchor - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)))
    return anchor, first, last, gram[anchor], whole


_HASHERS: dict[int, Hasher] = {}


def hasher(size: int) -> Hasher:
    if size not in _HASHERS:
        _HASHERS.clear()
        _HASHERS[size] = Hasher(size)
    return _HASHERS[size]


def _runs(batch: pa.RecordBatch, depth: int, digit: int) -> tuple[np.ndarray, ...]:
    """(document of the batch, first, last, anchor hash, context hash) of all
    rows of the first pass; places count from the start of the document."""
    data, offsets = joined_texts(batch.column("_text"))
    data, offsets = np.frombuffer(data, np.uint8), np.array(offsets)
    ends = np.repeat(offsets[1:].astype(np.int32 if len(data) < 1 << 31 else np.int64), np.diff(offsets))
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(data), SLICE):
        part = data[at: at + SLICE + depth - 1]
        if len(part) >= depth:
            inside = ends[at: at + SLICE] - np.arange(at, min(at + SLICE, len(data))) >= depth
            _, first, last, gram, whole = anchors(hasher(SLICE + depth), part, inside, depth, digit)
            of = np.searchsorted(offsets, first + at, "right") - 1
            found.append((of, first + at - offsets[of], last + at - offsets[of], gram.view(np.int64), whole.view(np.int64)))
    if not found:
        return (np.zeros(0, np.int64),) * 5
    return tuple(np.concatenate(c) for c in zip(*found))


def _places(column: pa.Array, print_: np.ndarray) -> np.ndarray:
    """Rank of each document of a batch in the order of key and hash of the
    text, equal for equal ones; NULL keys come first."""
    keys = pc.rank(column, null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
    return np.unique(np.stack([keys, print_], axis=1), axis=0, return_inverse=True)[1].reshape(-1)


def _later(order: list[np.ndarray], same: list[np.ndarray], place: list[np.ndarray]) -> np.ndarray:
    """Which rows agree in ``same`` with one that comes before them by ``place``."""
    spots = np.lexsort([*reversed([*same, *place]), *order])
    fresh = np.zeros(len(spots), bool)
    fresh[:1] = True
    for c in same:
        c = c[spots]
        fresh[1:] |= c[1:] != c[:-1]
    head = np.flatnonzero(fresh)
    owner = spots[np.repeat(head, np.diff(np.append(head, len(spots))))]
    late = np.zeros(len(spots), bool)
    for c in place:
        late |= c[spots] != c[owner]
    result = np.zeros(len(spots), bool)
    result[spots] = late
    return result


def repeats(df: DataFrame, key: str, text: str, depth: int = 100, digit: int = DIGIT) -> DataFrame:
    """Rows (_key, _print, first, last): strings that start from first to last
    in the text with this key and hash also start earlier.  A plan over ``df``;
    it stores the second pass when called."""
    docs = _identified(df, key, text)
    kind = docs.schema["_key"].dataType
    empty = "kind int, h long, whole long, _print long, first long, last long"
    schema = T.StructType([T.StructField("_key", kind), *T._parse_datatype_string(empty).fields])

    def rows(column: pa.Array, of: np.ndarray, kind: int, *values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [column.take(pa.array(of)), pa.array(np.full(len(of), kind, np.int32)), *[pa.array(v) for v in values]], names=schema.names)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            prints, column = batch.column("_print").to_numpy(), batch.column("_key")
            of, first, last, gram, whole = _runs(batch, depth, digit)
            place = _places(column, prints)
            late = _later([], [gram, whole], [place[of], first])
            go = ~late
            yield rows(column, of[go], 0, gram[go], whole[go], prints[of[go]], first[go], last[go])
            if late.any():
                # settled rows only pass through the shuffle; neighbours become one
                of, first, last = (x[late] for x in (of, first, last))
                spots = np.lexsort([first, of])
                of, first, last = of[spots], first[spots], last[spots]
                cut = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (first[1:] != last[:-1] + 1)))
                end = np.append(cut[1:], len(of)) - 1
                of = of[cut]
                yield rows(column, of, 1, mix(prints[of].view(np.uint64) + first[cut].astype(np.uint64)).view(np.int64),
                           np.zeros(len(of), np.int64), prints[of], first[cut], last[end])

    # hot anchors have a row for each chunk of text at most
    dealt = docs.mapInArrow(first_pass, schema).repartition("h")
    order = Window.partitionBy("h", "whole").orderBy(F.col("_key").asc_nulls_first(), "_print", "first")
    group = Window.partitionBy("h")
    judged = dealt.withColumn("late", F.rank().over(order) > 1).withColumn(
        "context", F.dense_rank().over(group.orderBy("whole")) - 1).withColumn("contexts", F.max("context").over(group) + 1)
    found = stored(judged.where((F.col("kind") == 1) | F.col("late") | (F.col("contexts") > 1)).select(
        "_key", "_print", "h", "first", "last", ((F.col("kind") == 1) | F.col("late")).alias("settled"),
        F.expr(f"context div {BLOCK}").cast("int").alias("block"), (F.col("contexts") > BLOCK).alias("open")), "repeats")
    settled = found.where("settled").select("_key", "_print", "first", "last")
    asked = found.where("not settled").groupBy("_key", "_print").agg(F.collect_list(F.struct("h", "first", "last", "block", "open")).alias("_asked"))
    # the rows of one text, bounded by its length
    asked = asked.select(F.col("_key").alias("_key2"), F.col("_print").alias("_print2"), "_asked")
    contexts_schema = T.StructType([T.StructField("_key", kind), *T._parse_datatype_string(
        "_print long, h long, first long, last long, block int, open boolean, context binary").fields])

    def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            lists = batch.column("_asked")
            of = pa.array(np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy()))
            h, first, last, block, open_ = (pc.struct_field(lists.flatten(), [k]).to_numpy(zero_copy_only=False) for k in range(5))
            data, offsets = joined_texts(batch.column("_text"))
            base = np.array(offsets)[of.to_numpy()]
            parts = [data[a:b] for a, b in zip((base + first).tolist(), (base + last + depth).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(of), batch.column("_print").take(of), pa.array(h), pa.array(first), pa.array(last),
                 pa.array(block), pa.array(open_), pa.array(parts, pa.binary())], names=contexts_schema.names)

    contexts = docs.join(asked, docs["_key"].eqNullSafe(asked["_key2"]) & (docs["_print"] == asked["_print2"])).select(
        "_key", "_print", "_text", "_asked").mapInArrow(cut_contexts, contexts_schema)

    def last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_blocks(batches):
            h, first, last, prints, block = (batch.column(c).to_numpy() for c in ("h", "first", "last", "_print", "block"))
            data, offsets = joined_texts(batch.column("context"))
            data = np.frombuffer(data, np.uint8)
            count = last - first + 1
            of = np.repeat(np.arange(len(h)), count)
            shift = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.array(offsets)[of] + shift
            table = Hasher(len(data) + 1) if len(data) > 4 * SLICE else hasher(4 * SLICE)
            string = mix(table.hash(table.sums(data), begin, begin + depth)).view(np.int64)
            place = _places(batch.column("_key"), prints)
            late = _later([], [h[of], block[of], string], [place[of], first[of] + shift])
            # other blocks of the same anchor may hold what this one holds for the first time
            open_ = ~late & batch.column("open").to_numpy(zero_copy_only=False)[of]
            if late.any():
                o, at = of[late], (first[of] + shift)[late]
                cut = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (at[1:] != at[:-1] + 1)))
                end = at[np.append(cut[1:], len(o)) - 1]
                o, at = o[cut], at[cut]
                yield rows(batch.column("_key"), o, 1, mix(prints[o].view(np.uint64) + at.astype(np.uint64)).view(np.int64),
                           np.zeros(len(o), np.int64), prints[o], at, end)
            if open_.any():
                o, at = of[open_], (first[of] + shift)[open_]
                yield rows(batch.column("_key"), o, 0, h[o], string[open_], prints[o], at, at)

    strings = contexts.repartition("h", "block").sortWithinPartitions("h", "block").mapInArrow(last_pass, schema)
    judged = strings.withColumn("late", F.rank().over(order) > 1)
    return settled.unionByName(judged.where((F.col("kind") == 1) | F.col("late")).select("_key", "_print", "first", "last"))


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that no block (rows with the same h and block) is in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h, block = (batch.column(c).to_numpy() for c in ("h", "block"))
        other = np.flatnonzero((h != h[-1]) | (block != block[-1]))
        begin = int(other[-1]) + 1 if len(other) else 0
        if held and (begin or (held[-1].column("h")[-1], held[-1].column("block")[-1]) != (batch.column("h")[-1], batch.column("block")[-1])):
            yield pa.concat_batches([*held, batch.slice(0, begin)])
            held = []
        elif begin:
            yield batch.slice(0, begin)
        held.append(batch.slice(begin))
    if held:
        yield pa.concat_batches(held)


def _identified(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_print"), F.col(text).alias("_text"))


RESULT = "spans array<struct<start: long, end: long>>, n_bytes long, n_removed long, kept binary"


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", depth: int = 100, carry: tuple[str, ...] = (),
                    whole_characters: bool = False) -> DataFrame:
    """Per row: key, the columns to ``carry``, ``spans`` (maximal removed runs of
    bytes), ``n_bytes``, ``n_removed`` and ``kept`` (the remaining bytes).

    A byte goes if a string of ``depth`` bytes covers it that also starts
    earlier: under a smaller key (NULL first), under the same key in a text of
    smaller hash, or earlier in the same text.  Rows that agree in key and text
    are one document and fare alike.  NULL texts are empty.  Texts are judged as
    given, not as left by the removal.  With ``whole_characters`` a run shrinks
    to the UTF-8 characters that it holds whole.
    """
    found = repeats(df, key, text, depth)
    spans = found.groupBy("_key", "_print").agg(F.collect_list(F.struct("first", "last")).alias("_runs")).select(
        F.col("_key").alias("_key2"), F.col("_print").alias("_print2"), "_runs")
    kept = [F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)]
    docs = df.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_print"), F.col(text).alias("_text"), *kept)
    joined = docs.join(spans, docs["_key"].eqNullSafe(spans["_key2"]) & (docs["_print"] == spans["_print2"]), "left").drop(
        "_key2", "_print2", "_print")
    fields = [joined.schema[c] for c in ("_key", *[f"_carry{i}" for i in range(len(carry))])]
    schema = T.StructType([*fields, *T._parse_datatype_string(RESULT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            data, offsets = joined_texts(batch.column("_text"))
            runs = batch.column("_runs").to_pylist()
            out: list[list] = [[], [], [], []]
            for i, found in enumerate(runs):
                own = data[offsets[i]: offsets[i + 1]]
                spans, parts, at = [], [], 0
                if found:
                    first, last = np.array(sorted((r["first"], r["last"] + depth) for r in found)).T
                    top = np.maximum.accumulate(last)
                    cut = np.flatnonzero(np.append(True, first[1:] > top[:-1]))
                    for a, b in zip(first[cut].tolist(), top[np.append(cut[1:], len(top)) - 1].tolist()):
                        if whole_characters:
                            while a < b and own[a] & 0xC0 == 0x80:
                                a += 1
                            while b > a and b < len(own) and own[b] & 0xC0 == 0x80:
                                b -= 1
                        if a < b:
                            spans.append({"start": a, "end": b})
                            parts.append(own[at:a])
                            at = b
                parts.append(own[at:])
                left = b"".join(parts)
                for column, value in zip(out, (spans, len(own), len(own) - len(left), left)):
                    column.append(value)
            kinds = [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], *[pa.array(c, k) for c, k in zip(out, kinds)]], names=schema.names)

    named = {"_key": key} | {f"_carry{i}": c for i, c in enumerate(carry)}
    return joined.mapInArrow(run, schema).withColumnsRenamed(named)
