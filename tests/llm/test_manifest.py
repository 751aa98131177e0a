import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import manifest

NAMES = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def up(nodes):
    """All levels over the nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 16])) for i in range(0, len(last), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = range(16 * (i // 16), min(16 * (i // 16) + 16, len(level)))
        out += [level[j] for j in run if j != i]
        i //= 16
    return out


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault((row[1] is not None, (row[1] or "").encode()), []).append(row)
    trees = []
    for name in sorted(groups):
        held = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((held, up([leaf_of(r) for r in held])))
    tops = up([levels[-1][0] for _, levels in trees])
    return [(r[0], levels[0][i], levels[-1][0], tops[-1][0], "".join(siblings(levels, i) + siblings(tops, t)))
            for t, (held, levels) in enumerate(trees) for i, r in enumerate(held)]


def run(spark, rows, chosen=None, given=None):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").selectExpr("*", "1 as key", "2 as `index`", "3 as leaf", "4 as part")
    made = manifest.build(df.repartition(5), manifest.leaf_hash(*NAMES_OF()), given=given)
    found = manifest.prove(made, chosen).collect()
    root = made.root.hex() if made.root else None
    return [(r.key, r.leaf.hex(), r.subroot.hex(), root, r.proof.hex()) for r in found], [r.folded.hex() for r in found], made


def NAMES_OF():
    return [F.col(n) for n in NAMES]


def corpus(sizes, seed=1):
    pick, rows = random.Random(seed), []
    for source, n in sizes.items():
        rows += [(len(rows) + i, source, pick.choice(["en", None]), i, f"Text {i} é" if i % 7 else None) for i in range(n)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, "b": 1}, {None: 3, "": 5, "z": 300, "é": 16, "a": 257},
                                   {f"s{i:02}": 1 + i % 3 for i in range(40)}])
def test_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(manifest, "PART", 50)
    rows = corpus(sizes)
    got, folded, made = run(spark, rows)
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert set(folded) == {made.root.hex()}
    assert made.groups.count() == len(sizes)


def test_null_and_repeated_keys(spark):
    rows = [(None, "a", None, None, None), (None, "a", None, None, ""), (3, "a", "en", 1, "x"), (3, "a", "en", 1, "x"), (3, "a", "en", 1, "y"),
            (4, None, None, None, "x" * 100_000), (3, "b", "en", 1, "x")] + [(9, "c", "en", 5, "same")] * 40
    got, folded, made = run(spark, rows)
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert set(folded) == {made.root.hex()}


def test_altered_copies_do_not_lead_to_the_root(spark):
    rows = corpus({"a": 40, "b": 20})
    given = F.when(F.col("doc_id") % 5 == 0, manifest.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.upper("text")))
    got, folded, made = run(spark, rows, given=given)
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    texts = {r[0]: r[4] for r in rows}
    for (key, *_), root in zip(got, folded):
        assert (root == made.root.hex()) == (key % 5 != 0 or texts[key] is None)


def test_some_leaves(spark):
    rows = corpus({"a": 300, "b": 40, "c": 1})
    got, folded, made = run(spark, rows, chosen=F.col("index") % 37 == 0)
    want = {(w[0], w[1]): w for w in brute(rows)}
    assert len(got) == 12 and all(want[g[0], g[1]] == g for g in got)
    assert set(folded) == {made.root.hex()}
    assert run(spark, rows, chosen=F.lit(False))[0] == []


def test_missing_nodes_are_least(spark):
    """No fetched node follows from the known ones and the other fetched ones."""
    pick = random.Random(4)
    for _ in range(30):
        size = pick.randint(2, 600)
        chosen = set(pick.sample(range(size), pick.randint(1, min(size, 40))))
        known, n = chosen, size
        for level, runs, missing in manifest.octopus(chosen, size):
            assert runs == sorted({i // 16 for i in known})
            assert not set(missing) & known
            assert {i for r in runs for i in range(16 * r, min(16 * r + 16, n))} == known | set(missing)
            known, n = set(runs), -(-n // 16)
        assert n == 1


def test_no_rows(spark):
    got, _, made = run(spark, [])
    assert got == [] and made.root is None and made.groups.count() == 0


def test_query_columns(spark):
    from cartwheel.llm import queries

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op11_merkle_manifest(spark, folder).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*NAMES).collect()]
    texts = {r[0]: r[4] for r in rows}
    want = brute(rows)
    assert len(got) == len(rows)
    for key, leaf, subroot, root, proof in want:
        r = got[key]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (leaf, subroot, root, h(proof))
        altered = zlib.crc32(str(key).encode()) % 5 == 0 and texts[key] is not None and any("A" <= c <= "Z" for c in texts[key])
        assert r.verified == (r.folded_root == r.root) == (not altered)
