import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartwheel.llm import packing
from cartwheel.llm.queries import vocabulary_path


def check(plan, counts, capacity):
    held = Counter()
    for content, n in plan.items():
        assert n > 0 and sum(a * k for a, k in content) <= capacity
        for a, k in content:
            held[a] += k * n
    assert held == Counter({a: n for a, n in counts.items() if n})


@pytest.mark.parametrize("kind", ["even", "texts", "large", "few", "thirds", "one"])
def test_plans_hold_every_piece_in_few_sequences(kind):
    pick, capacity = random.Random(1), 512
    counts = {
        "even": lambda: Counter(pick.choices(range(1, 513), k=30_000)),
        "texts": lambda: Counter(min(512, max(2, int(pick.lognormvariate(4.5, 1.1)))) for _ in range(40_000)),
        "large": lambda: Counter(pick.choices(range(200, 400), k=20_000)),
        "few": lambda: Counter(pick.choices(range(1, 513), k=150)),
        "thirds": lambda: Counter({171: 900, 170: 900, 172: 900}),
        "one": lambda: Counter({100: 7}),
    }[kind]()
    plan = packing.solve(counts, capacity)
    check(plan, counts, capacity)
    made, best = sum(plan.values()), sum(packing.best_fit(counts, capacity).values())
    least = -(-sum(a * n for a, n in counts.items()) // capacity)
    assert made <= best
    if kind == "texts":
        assert made <= least * 1.001 + 1


def test_empty_histogram():
    assert packing.solve({}, 16) == {} and len(packing.places({}).key) == 0


def test_texts_are_packed_without_gaps(spark):
    pick = random.Random(6)
    texts = [None, "", "a", "b " * 5000, "word " * 2047, "word " * 2048] + ["the cat " * pick.randint(1, 700) for _ in range(300)]
    texts += ["same text"] * 500
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as length", "2 as _rank", "'x' as offset").repartition(5)
    got = packing.pack_texts(df, vocabulary_path()).collect()
    library = Tokenizer.from_file(vocabulary_path())
    want = Counter()
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at: at + 2048]
            want[key, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:]))
        assert sum(held[-1]) <= 2048
    least = -(-sum(r.length for r in got) // 2048)
    assert len(sequences) <= least * 1.02 + 1
    assert packing.pack_texts(df.limit(0), vocabulary_path()).collect() == []
