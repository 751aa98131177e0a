import random

import xxhash

from cartwheel.llm import simhash
from cartwheel.llm.components import components


def brute_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(prints))]


def test_whole_operator_equals_brute_force(spark):
    pick = random.Random(8)
    vocabulary = ["Aé", "b", "C", "d ", "e\x1f", "F\xa0g", "\n", "\x85", "日本", "İ"]
    texts = [None, "", " \t\n", "one", "one two", "ONE two", "x " * 40_000]
    base = [" ".join(pick.choices(vocabulary + [str(i) for i in range(60)], k=150)) for _ in range(60)]
    for t in base:
        words = t.split(" ")
        words[pick.randrange(len(words))] = "changed"
        texts += [t, " ".join(words), t.upper()]
    rows = [(i * 7 % 997, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _print", "2 as component", "3 as node").repartition(4)
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    rows.sort()
    prints = [brute_fingerprint(t) for _, t in rows]
    for (key, _), want, root in zip(rows, prints, brute_components(prints, 2)):
        assert got[key].fingerprint & (1 << 64) - 1 == want
        assert got[key].component == rows[root][0]
    assert len({r.component for r in got.values()}) < len(rows)


def test_crowded_keys_lose_no_link(spark):
    """Thousands of fingerprints under one key, in chains and clusters."""
    pick = random.Random(2)
    prints = {0}
    while len(prints) < 3000:
        near = pick.choice(list(prints)[-50:]) if pick.random() < 0.9 else pick.getrandbits(40)
        for _ in range(pick.randint(1, 3)):
            near ^= 1 << pick.randrange(43)
        prints.add(near)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "p long").repartition(7)
    edges = simhash.links(df, "p", 2)
    found = {r.node: r.root for r in components(edges, "a", "b").collect()}
    want = brute_components(prints, 2)
    assert all(found.get(p, p) == prints[w] for p, w in zip(prints, want))
    assert edges.count() < 20 * len(prints)


def test_tables_without_rows_and_keys(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    rows = simhash.near_duplicates(spark.createDataFrame([(None, "a b"), (None, "a b"), (4, None), (2, "")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component or 0) for r in rows) == [(0, 0), (0, 0), (2, 2), (4, 2)]


def test_components_of_odd_edges(spark):
    edges = spark.createDataFrame([(1, 1), (2, 3), (3, 2), (None, 4), (9, 8), (8, 7), (7, 6), (6, 2)], "x long, y long")
    assert {r.node: r.root for r in components(edges, "x", "y").collect()} == {k: 2 for k in (2, 3, 6, 7, 8, 9)}
    assert components(edges.limit(0), "x", "y").collect() == []
