import hashlib
import random

import pytest

from cartwheel.llm import suffixes


def brute(rows, depth):
    """Removed runs and kept bytes of each (key, text), in the order of keys."""
    seen, result = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - depth + 1):
            part = data[i: i + depth]
            if part in seen:
                gone[i: i + depth] = b"\1" * depth
            seen.add(part)
        spans, i = [], 0
        while i < len(data):
            j = i
            while j < len(data) and gone[j] == gone[i]:
                j += 1
            spans += [(i, j)] * gone[i]
            i = j
        result[key] = spans, bytes(b for b, g in zip(data, gone) if not g)
    return result


def corpus(pick):
    words = ["".join(pick.choices("abcdeé", k=pick.randint(1, 9))) for _ in range(300)]
    passages = [" ".join(pick.choices(words, k=40)) for _ in range(6)]
    texts = [None, "", "x", "a" * 99, "a" * 100, "a" * 101, "a" * 5000, "ab" * 700, "abc" * 500]
    for _ in range(120):
        text = " ".join(pick.choices(words, k=pick.randint(1, 150)))
        for _ in range(pick.randint(0, 3)):
            p = pick.choice(passages)
            a = pick.randint(0, len(p))
            at = pick.randint(0, len(text))
            text = text[:at] + p[a:] + text[at:]
        texts.append(text)
    texts += [pick.choice(texts[9:]) for _ in range(20)]
    for t in [pick.choice(texts[9:]) for _ in range(20)]:
        at = pick.randint(0, len(t))
        texts.append(t[:at] + "CHANGED" + t[at + 3:])
    pick.shuffle(texts)
    return [(i * 31 % 1009, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("parts", [1, 7])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, parts):
    if parts > 1:
        monkeypatch.setattr(suffixes, "BLOCK", 3)
    rows = corpus(random.Random(parts))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _key", "2 as h", "'x' as first").repartition(parts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000" if parts == 1 else "9")
    try:
        got = {r.doc_id: r for r in suffixes.without_repeats(df, carry=("h",)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(rows, 100)
    assert got.keys() == want.keys()
    for key, (spans, kept) in want.items():
        assert [(s.start, s.end) for s in got[key].spans] == spans, key
        assert hashlib.sha256(bytes(got[key].kept)).digest() == hashlib.sha256(kept).digest()
        assert got[key].n_removed == sum(b - a for a, b in spans) and got[key].h == 2


def test_odd_rows(spark):
    long = "the quick brown fox " * 20
    rows = [(1, long), (1, long), (2, long), (None, "z" * 150), (3, "z" * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_removed) for r in suffixes.without_repeats(df).collect()))
    own = len(long) - 20  # the text repeats itself with a period of 20
    assert got == [(0, 149), (1, own), (1, own), (2, len(long)), (3, 150)]
    assert suffixes.without_repeats(df.limit(0)).collect() == []


def test_runs_shrink_to_whole_characters(spark):
    df = spark.createDataFrame([(1, "aé" * 100 + "tail"), (2, "x" + "é" + "aé" * 50 + "è")], "doc_id long, text string")
    for r in suffixes.without_repeats(df, whole_characters=True).collect():
        bytes(r.kept).decode()
