"""Merkle manifest of a table, with proofs made part by part.

Every row is a leaf.  The leaves of a group (a source), in the order of their
keys, make a tree: each run of up to ``FAN`` neighbours becomes the hash of its
members until one node, the subroot, is left.  The subroots in the order of
their groups make one more tree, whose last node is the root.

A node is named by (tree, level, index); the tree of the subroots is ``TOP``.
Proofs are octopus multiproofs: a part of neighbouring leaves works out which
nodes it lacks (the runs it touches, less what its own leaves give), level by
level, gets that union once by a join, derives the inner nodes that its leaves
share, and cuts each leaf's proof out of them.  A proof is the digests of the
other members of each run on the leaf's path, bottom to top, left to right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored
from cartwheel.llm.sharding import numbered

FAN = 16
PART = 4096  # neighbouring leaves that are proved together
TOP = -1
BYTES = 32  # of a digest

NODE = "tree long, level int, index long"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: key, group, leaf, given, number, tree, index, size;
    ``nodes``: tree, level, index, hash; ``groups``: group, tree, size,
    subroot.  ``root`` is NULL for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: bytes | None
    trees: int


def field(column: Column) -> Column:
    """``-`` for NULL, else the count of UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    """Digest of a row; fields cannot run into each other."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256))


def digest(members: bytes) -> bytes:
    """Hash of a run given its members' digests one after another: they are
    hashed as hexadecimal text."""
    return hashlib.sha256(members.hex().encode()).digest()


def above(size: int) -> int:
    """Nodes over ``size`` nodes."""
    return -(-size // FAN)


def _grow(base: DataFrame, largest: int, label: str) -> list[DataFrame]:
    """Stored levels (tree, index, n, hash) over level 0; ``n`` is the count of
    nodes of the tree at that level.  A tree goes on while it has several."""
    levels = [base]
    while largest > 1:
        run = F.array_sort(F.collect_list(F.struct("index", "hash")))
        members = F.concat_ws("", F.transform(run, lambda x: F.lower(F.hex(x["hash"]))))
        up = levels[-1].where("n > 1").groupBy("tree", "n", F.expr(f"index div {FAN}").alias("up")).agg(
            F.unhex(F.sha2(members.cast("binary"), 256)).alias("hash"))
        levels.append(stored(up.select("tree", F.col("up").alias("index"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), "hash"), label))
        largest = above(largest)
    return levels


def _last(levels: Sequence[DataFrame]) -> DataFrame:
    """The one node that is left of every tree."""
    ends = [level.where("n = 1").select("tree", "hash") for level in levels]
    found = ends[0]
    for end in ends[1:]:
        found = found.unionByName(end)
    return found


def build(df: DataFrame, leaf: Column, key: str = "doc_id", group: str = "source", given: Column | None = None) -> Manifest:
    """Manifest of all rows of ``df``.

    ``leaf`` is a row's digest (``leaf_hash``); ``given``, where it is not
    NULL, the digest of the copy that ``prove`` is to hold against the
    manifest in its place.  Only these and the two named columns are read, so
    other columns may have any name.  Groups ascend with NULL first, by UTF-8
    bytes; rows of a group ascend by key with NULL first, ties by leaf and
    given digest.  Repeated rows are leaves of their own.  An empty table has
    no root.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf.alias("leaf"),
                     (F.lit(None).cast("binary") if given is None else given).alias("given"))
    placed, _ = numbered(stored(rows, "leaves"), ["group", "key", "leaf", "given"], "number")
    placed = stored(placed, "numbered")
    spans = placed.groupBy("group").agg(F.min("number").alias("first"), F.count("*").alias("size"))
    spans, trees = numbered(spans, ["first", "group", "size"], "tree")
    spans = stored(spans, "groups")
    if not trees:
        nothing = spark.createDataFrame([], NODE + ", hash binary")
        return Manifest(placed.select("*", F.lit(None).cast("long").alias("tree"), F.lit(None).cast("long").alias("index"),
                                      F.lit(None).cast("long").alias("size")), nothing,
                        spans.select("group", "tree", "size", F.lit(None).cast("binary").alias("subroot")), None, 0)
    # a hot group is split by AQE's skew join, its other side has one row
    held = placed.join(spans.withColumnRenamed("group", "_group"), F.col("group").eqNullSafe(F.col("_group"))).select(
        "key", "group", "leaf", "given", "number", "tree", (F.col("number") - F.col("first")).alias("index"), "size")
    leaves = stored(held, "places")
    largest = spans.agg(F.max("size")).first()[0]
    inner = _grow(leaves.select("tree", "index", F.col("size").alias("n"), F.col("leaf").alias("hash")), largest, "level")
    subroots = stored(_last(inner), "subroots")
    tops = _grow(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("index"),
                                 F.lit(trees).cast("long").alias("n"), "hash"), trees, "top")
    levels = [x.select("tree", F.lit(i).alias("level"), "index", "hash") for part in (inner, tops) for i, x in enumerate(part)]
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    groups = spans.join(subroots, "tree").select("group", "tree", "size", F.col("hash").alias("subroot"))
    return Manifest(leaves, nodes, groups, bytes(_last(tops).first()["hash"]), trees)


def octopus(indices: set[int], size: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """For each level below the last: (level, runs touched, nodes missing), if
    the nodes ``indices`` of level 0 are known."""
    level, known = 0, indices
    while size > 1:
        runs = sorted({i // FAN for i in known})
        missing = [i for r in runs for i in range(FAN * r, min(FAN * r + FAN, size)) if i not in known]
        yield level, runs, missing
        level, known, size = level + 1, set(runs), above(size)


def _by_tree(table: pa.Table) -> dict[int, tuple[int, list[int]]]:
    """Size and rows of each tree."""
    found: dict[int, tuple[int, list[int]]] = {}
    for row, (tree, size) in enumerate(zip(table.column("tree").to_pylist(), table.column("size").to_pylist())):
        found.setdefault(tree, (size, []))[1].append(row)
    return found


def _inner(values: dict[int, bytes], size: int, fetched: dict[int, dict[int, bytes]]) -> tuple[dict[int, bytes], bytes]:
    """Proof up to the last node for every known node of level 0, and that
    last node."""
    steps = []
    for level, runs, missing in octopus(set(values), size):
        values = values | {i: fetched[level][i] for i in missing}
        members = {r: [values[i] for i in range(FAN * r, min(FAN * r + FAN, size))] for r in runs}
        steps.append(members)
        values = {r: digest(b"".join(m)) for r, m in members.items()}
        size = above(size)
    paths: dict[int, bytes] = {0: b""}
    for members in reversed(steps):
        paths = {FAN * r + spot: b"".join(m[:spot] + m[spot + 1:]) + paths[r] for r, m in members.items() for spot in range(len(m))}
    return paths, values[0] if steps else next(iter(values.values()))


def _fold(value: bytes, index: int, size: int, proof: bytes, used: int) -> tuple[bytes, int]:
    while size > 1:
        spot = index % FAN
        others = min(FAN, size - FAN * (index // FAN)) - 1
        before, end = used + spot * BYTES, used + others * BYTES
        value = digest(proof[used:before] + value + proof[before:end])
        index, size, used = index // FAN, above(size), end
    return value, used


def fold(leaf: bytes, index: int, size: int, tree: int, trees: int, proof: bytes) -> bytes:
    """Root that a leaf and its proof lead to; the leaf has place ``index`` of
    ``size`` in group ``tree`` of ``trees``."""
    subroot, used = _fold(leaf, index, size, proof, 0)
    return _fold(subroot, tree, trees, proof, used)[0]


def prove(manifest: Manifest, chosen: Column | None = None) -> DataFrame:
    """Rows (key, leaf, subroot, proof, folded) for all leaves, or for those that
    ``chosen`` (over the columns of ``Manifest.leaves``) holds for.

    ``proof`` is binary, the digests one after another; ``folded`` is the root
    that it leads to from the given digest, or from the leaf where none is
    given.  An empty choice gives no rows."""
    trees = manifest.trees
    leaves = manifest.leaves if chosen is None else manifest.leaves.where(chosen)
    leaves = leaves.withColumn("part", F.expr(f"number div {PART}"))

    def requests(key: tuple, table: pa.Table) -> pa.Table:
        index = table.column("index").to_pylist()
        asked = []
        by_tree = _by_tree(table)
        for tree, (size, held) in by_tree.items():
            asked += [(tree, level, i) for level, _, missing in octopus({index[r] for r in held}, size) for i in missing]
        asked += [(TOP, level, i) for level, _, missing in octopus(set(by_tree), trees) for i in missing]
        columns = list(zip(*asked)) or [(), (), ()]
        return pa.table({"part": pa.array([key[0].as_py()] * len(asked), pa.int64()), "tree": pa.array(columns[0], pa.int64()),
                         "level": pa.array(columns[1], pa.int32()), "index": pa.array(columns[2], pa.int64())})

    def expand(table: pa.Table, nodes: pa.Table) -> pa.Table:
        fetched: dict[int, dict[int, dict[int, bytes]]] = {}
        for tree, level, index, value in zip(*[nodes.column(c).to_pylist() for c in ("tree", "level", "index", "hash")]):
            fetched.setdefault(tree, {}).setdefault(level, {})[index] = value
        index, leaf, given = [table.column(c).to_pylist() for c in ("index", "leaf", "given")]
        by_tree, paths, subroots = _by_tree(table), {}, {}
        for tree, (size, held) in by_tree.items():
            paths[tree], subroots[tree] = _inner({index[r]: leaf[r] for r in held}, size, fetched.get(tree, {}))
            if size == 1:
                paths[tree] = {0: b""}
        tops, _ = _inner(subroots, trees, fetched.get(TOP, {}))
        tops = tops if trees > 1 else {0: b""}
        proofs: list = [None] * len(leaf)
        folded: list = [None] * len(leaf)
        roots: list = [None] * len(leaf)
        for tree, (size, held) in by_tree.items():
            for r in held:
                proofs[r] = paths[tree][index[r]] + tops[tree]
                folded[r] = fold(leaf[r] if given[r] is None else given[r], index[r], size, tree, trees, proofs[r])
                roots[r] = subroots[tree]
        return pa.table({"key": table.column("key"), "leaf": table.column("leaf"), "subroot": pa.array(roots, pa.binary()),
                         "proof": pa.array(proofs, pa.binary()), "folded": pa.array(folded, pa.binary())})

    lacking = leaves.select("part", "tree", "index", "size").groupBy("part").applyInArrow(requests, f"part long, {NODE}")
    fetched = lacking.join(manifest.nodes, ["tree", "level", "index"]).select("part", "tree", "level", "index", "hash")
    kind = manifest.leaves.schema["key"].dataType.simpleString()
    return leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(
        expand, f"key {kind}, leaf binary, subroot binary, proof binary, folded binary")
