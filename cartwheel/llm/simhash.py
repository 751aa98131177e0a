"""Near-duplicate texts by SimHash and a hierarchical index in Gray order.

Every text gets a 64-bit fingerprint: a bit is set if it is set in more than
half of the hashes of the text's word shingles.  Distinct fingerprints are
linked if they differ in at most ``bits`` bits.

Fingerprints are cut into ``bits + 1`` segments; two that are linked agree in
one of them, so each segment in turn is rotated to the front and serves as a
key.  Under a key the fingerprints are sorted by Gray rank, which puts those
that share long runs of bits side by side.  Runs of neighbours form leaves,
runs of leaves form upper nodes, and every node keeps the bits that all its
members share.  The bits in which the shared patterns of two nodes differ are
differences of all pairs below them; a pair of nodes with more than ``bits``
of them is dropped with everything below.  What remains is compared member by
member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import chunks, stored
from cartwheel.llm.components import components

LEAF = 64  # fingerprints
FANOUT = 32  # leaves of an upper node
STEP = 1 << 14  # shingles whose bits are counted at a time


def fingerprint(text: str | None, words: int = 3) -> int:
    """Fingerprint of one text; 0 for a text without words."""
    if not text:
        return 0
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(parts) - words + 1].tolist()
    ends = ends[words - 1:].tolist()
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), STEP):
        hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts[at: at + STEP], ends[at: at + STEP])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, text: str = "text", result: str = "fingerprint", words: int = 3) -> DataFrame:
    """All columns but the text, and the fingerprint as a signed long."""
    keep = [c for c in df.columns if c not in (text, result)]
    schema = df.select(*keep).withColumn(result, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            made = np.array([fingerprint(t, words) for t in batch.column(text).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(made)], names=[*keep, result])

    return df.select(*keep, text).mapInArrow(run, schema)


def _gray_rank(x: Column) -> Column:
    """Position of a bit pattern in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, shift))
    return x


NODE = "turn int, key long, node long, size int, ones long, zeros long, members array<array<long>>"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Upper nodes of rows sorted by (turn, key, Gray rank).  A node is cut
    where the key changes and where it is full."""
    held: list[np.ndarray] = []
    names = ["turn", "key", "node", "size", "ones", "zeros", "members"]

    def nodes(rows: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero((np.diff(rows[0], prepend=-1) != 0) | (np.diff(rows[1], prepend=-1) != 0))
        run = np.arange(rows.shape[1]) - np.repeat(new, np.diff(np.append(new, rows.shape[1])))
        cut = np.flatnonzero(run % (LEAF * FANOUT) == 0)
        members = [[part[i: i + LEAF] for i in range(0, len(part), LEAF)] for part in np.split(rows[2], cut[1:])]
        columns = [
            pa.array(rows[0][cut], pa.int32()), pa.array(rows[1][cut]), pa.array(rows[2][cut]),
            pa.array(np.diff(np.append(cut, rows.shape[1])), pa.int32()),
            pa.array(np.bitwise_and.reduceat(rows[2], cut)), pa.array(np.bitwise_and.reduceat(~rows[2], cut)),
            pa.array(members, pa.list_(pa.list_(pa.int64()))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("turn", "key", "bits")]))
        rows = np.concatenate(held, axis=1)
        # the last key may go on in the next batch, but whole nodes of it are ready
        last = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1])) if rows.shape[1] else []
        begin = int(last[-1]) + 1 if len(last) else 0
        begin += (rows.shape[1] - begin) // (LEAF * FANOUT) * (LEAF * FANOUT)
        if begin:
            yield nodes(rows[:, :begin])
        held = [rows[:, begin:]]
    if held and held[0].shape[1]:
        yield nodes(np.concatenate(held, axis=1))


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same values as the links (a, b), one for each value
    but one in a component."""
    values, spots = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = spots[: len(a)], spots[len(a):]
    root = np.arange(len(values))
    while True:
        least = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, least)
        np.minimum.at(root, y, least)
        np.minimum.at(root, before[x], least)
        np.minimum.at(root, before[y], least)
        root = root[root]
        if (root == before).all():
            break
    other = np.flatnonzero(root != np.arange(len(values)))
    return values[other], values[root[other]]


def _compare(bits: int):
    def shared(leaves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.array([np.bitwise_and.reduce(x) for x in leaves]), np.array([np.bitwise_and.reduce(~x) for x in leaves])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, seconds = [], []
            turns, sides = batch.column("turn").to_pylist(), [batch.column(c) for c in ("members_a", "members_b")]
            same = batch.column("same").to_pylist()
            for i, turn in enumerate(turns):
                left, right = ([np.array(x, np.int64) for x in side[i].as_py()] for side in sides)
                (ones_a, zeros_a), (ones_b, zeros_b) = shared(left), shared(right)
                apart = np.bitwise_count((ones_a[:, None] & zeros_b) | (zeros_a[:, None] & ones_b))
                found_a, found_b = [], []
                for k, j in zip(*np.nonzero(apart <= bits)):
                    if same[i] and j < k:
                        continue
                    near = np.bitwise_count(left[k][:, None] ^ right[j]) <= bits
                    p, q = np.nonzero(near)
                    use = left[k][p] != right[j][q]
                    found_a.append(left[k][p[use]])
                    found_b.append(right[j][q[use]])
                if found_a and sum(map(len, found_a)):
                    a, b = _spanning(np.concatenate(found_a), np.concatenate(found_b))
                    back = np.uint64(turn)
                    for out, x in ((firsts, a), (seconds, b)):
                        x = x.view(np.uint64)
                        out.append((x >> back | x << (np.uint64(64) - back) if turn else x).view(np.int64))
            if firsts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(firsts)), pa.array(np.concatenate(seconds))], names=["a", "b"])

    return run


def links(distinct: DataFrame, column: str, bits: int) -> DataFrame:
    """Edges (a, b) that connect the same fingerprints as all pairs within
    ``bits`` bits do.  ``distinct`` holds each fingerprint once."""
    size, longer = divmod(64, bits + 1)
    turns, at = [], 0
    for segment in range(bits + 1):
        turns.append((at, size + (segment < longer)))
        at += turns[-1][1]
    x = F.col(column)
    versions = []
    for turn, width in turns:
        rotated = F.shiftleft(x, turn).bitwiseOR(F.shiftrightunsigned(x, 64 - turn)) if turn else x
        versions.append(F.struct(F.lit(turn).alias("turn"), F.shiftrightunsigned(rotated, 64 - width).alias("key"), rotated.alias("bits")))
    rows = distinct.select(F.explode(F.array(*versions)).alias("v")).select("v.*").withColumn("rank", _gray_rank(F.col("bits")))
    nodes = stored(
        rows.repartitionByRange("turn", "key", "rank").sortWithinPartitions("turn", "key", "rank")
        .mapInArrow(_build, NODE), "nodes")
    a, b = ([F.col(c).alias(f"{c}_{side}") for c in ("node", "size", "ones", "zeros", "members")] for side in "ab")
    apart = F.bit_count(F.expr("(ones_a & zeros_b) | (zeros_a & ones_b)"))
    pairs = nodes.select("turn", "key", *a).join(nodes.select("turn", "key", *b), ["turn", "key"]).where(
        (F.col("node_a") <= F.col("node_b")) & (apart <= bits) & ((F.col("node_a") != F.col("node_b")) | (F.col("size_a") > 1)))
    return pairs.select("turn", "members_a", "members_b", (F.col("node_a") == F.col("node_b")).alias("same")).mapInArrow(
        _compare(bits), "a long, b long")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 2,
                    carry: tuple[str, ...] = (), root: str | None = None) -> DataFrame:
    """One row (key, fingerprint, component, columns to ``carry``) per row of ``df``;
    with ``root``, also a fingerprint under that name that stands for the component.

    ``component`` is the smallest key reachable over fingerprints that differ
    in at most ``bits`` bits, itself included.  Texts that are NULL or without
    words have fingerprint zero and are linked like any other.  Rows with a
    NULL key get a fingerprint and the component of the others; a component
    without any key is NULL.  Rows with the same key may lie in different
    components.
    """
    kept = [F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)]
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *kept)
    made = stored(fingerprints(rows, "_text", "_print", words), "fingerprints")
    distinct = made.groupBy("_print").agg(F.min("_key").alias("_least"))
    found = components(links(distinct.select("_print"), "_print", bits), "a", "b")
    rooted = distinct.join(found, distinct["_print"] == found["node"], "left").select(
        "_print", "_least", F.coalesce("root", "_print").alias("_root"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component"))
    named = stored(rooted.join(least, "_root").select(F.col("_print").alias("_own"), "_root", "component"), "named")
    # a fingerprint of many texts is a hot key of this last join, which Spark splits
    return made.join(named, made["_print"] == named["_own"]).select(
        F.col("_key").alias(key), F.col("_print").alias("fingerprint"), "component",
        *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)], *([F.col("_root").alias(root)] if root else []))
