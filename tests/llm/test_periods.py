import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import periods


def brute(words, least=12):
    """By the definition: all periods at all places."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            left = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            length = x - left + q
            if length >= max(least, 2 * q):
                found.setdefault((left, length), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def online(words, cuts, least=12):
    catchers, done = periods.Catchers(least), 0
    numbers = np.array([hash(w) & 0xFFFF for w in words], np.uint64)
    for cut in [*cuts, len(words)]:
        catchers.append(numbers[done:max(cut, done)])
        done = max(cut, done)
    return catchers.runs()


def pieces(pick, n):
    """Random words with planted repeats of all lengths."""
    out = []
    while len(out) < n:
        part = [pick.randrange(pick.choice([1, 2, 3, 50])) for _ in range(pick.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40]))]
        out += part * pick.choice([1, 1, 2, 3, 7]) + part[: pick.randrange(len(part) + 1)]
    return out[:n]


def test_equals_definition():
    for seed in range(150):
        pick = random.Random(seed)
        words = pieces(pick, pick.choice([11, 12, 13, 30, 100, 400]))
        for least in (12, 2, 7, 20):
            assert periods.runs_of([str(w).encode() for w in words], least) == brute(words, least), (seed, least)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.lists(st.integers(0, 90), max_size=6))
def test_runs_do_not_depend_on_the_appends(words, cuts):
    want = brute(words)
    assert online(words, sorted(min(c, len(words)) for c in cuts)) == want
    assert online(words, range(len(words))) == want


def test_word_by_word():
    for seed in range(25):
        pick = random.Random(seed)
        words = pieces(pick, 250)
        assert online(words, range(250)) == brute(words)
        cuts = sorted(pick.sample(range(250), 5))
        assert online(words, cuts) == brute(words)


def test_extreme_texts():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert periods.runs_of([str(w).encode() for w in b[:800]]) == brute(b[:800])
    assert periods.runs_of([b"x"] * 300_000) == [(0, 300_000, 1)]
    unit = [str(i).encode() for i in range(40_000)]
    assert periods.runs_of(unit * 3 + unit[:7]) == [(0, 120_007, 40_000)]
    assert periods.runs_of([b"x"] * 11) == [] and periods.runs_of([]) == []


def test_equal_names_of_different_windows(monkeypatch):
    monkeypatch.setattr(periods, "_named", lambda left, right: left * np.uint64(0))
    for seed in range(10):
        words = pieces(random.Random(seed), 150)
        assert periods.runs_of([str(w).encode() for w in words]) == brute(words)


def test_names_kept_stay_in_proportion():
    catchers, pick = periods.Catchers(), random.Random(1)
    for _ in range(200):
        catchers.append(np.array([pick.randrange(1000) for _ in range(100)], np.uint64))
    assert sum(map(len, catchers.names)) < 8 * 20_000


def test_rows(spark):
    sep = " \t\n\v\f\r"
    rows = [(1, "a b " * 8 + "c"), (1, "a b " * 8 + "c"), (None, None), (2, ""), (3, " \n "), (4, sep.join(["é x"] * 12)), (5, "no runs here"),
            (6, "w " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as runs", "3 as _text").repartition(3)
    got = sorted(((r.key, r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.n_dropped) for r in periods.periodic_runs(df).collect()), key=str)
    assert got == sorted([
        (1, 17, [(0, 16, 2)], "a b c", 14), (1, 17, [(0, 16, 2)], "a b c", 14), (None, 0, [], "", 0), (2, 0, [], "", 0), (3, 0, [], "", 0),
        (4, 12, [(0, 12, 1)], "é x", 11), (5, 3, [], "no runs here", 0), (6, 50_000, [(0, 50_000, 1)], "w", 49_999)], key=str)
    assert periods.periodic_runs(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    from cartwheel.llm import queries

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for key, text in rows:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 1500:
            runs = periods.runs_of(words)
        else:
            runs = brute(words)
        r = got[key]
        assert r.n_runs == len(runs)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(left).hexdigest()
