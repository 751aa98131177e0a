import random

import pytest
from tokenizers import Tokenizer

from cartwheel.llm import bpe
from cartwheel.llm.queries import vocabulary_path

SAMPLES = ["", " ", "Hello, world's  best!\n\tOK", "don't we'll I'd 3.14 2024", "<|endoftext|>a<|startoftext|>", "ÀÉ é ΣΑΣ İstanbul ŒUVRE",
           "日本語 text 😀😀  x y​z\x1c\x85", "a" * 300, "ababababab" * 9, "<|endoftext", "the" * 50, "\x00\x01\x7f", "aAaA" * 20]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def test_encoding_equals_the_library(spark, library):
    pick = random.Random(5)
    alphabet = list("abcdefghist' .,!0123éßñΣ\n") + ["th", "ing", "er", "the ", "<|endoftext|>"]
    texts = SAMPLES + ["".join(pick.choices(alphabet, k=pick.randint(0, 200))) for _ in range(400)] + [None]
    texts += [chr(c) + "a" + chr(c) + "b" for c in [*range(0x20, 0x560), *range(0x1E00, 0x2100), 0x1C89,
                                                                *range(0x3000, 0x9FFF, 37), 0xFEFF, *range(0x1F300, 0x1F650)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    path = vocabulary_path()
    rows = bpe.decode(bpe.encode(docs, path), path).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == expected, texts[row.doc_id]
        assert row.decoded == library.decode(expected, skip_special_tokens=False)


def merge_letters(vocab, word):
    """One merge after the other: lowest rank first, the leftmost of equals."""
    ids = [vocab.base[c] for c in word]
    while found := [(vocab.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in vocab.merges]:
        _, k = min(found)
        ids[k: k + 2] = [vocab.merges[ids[k], ids[k + 1]][1]]
    return ids


def test_pairs_are_judged_as_merging_does():
    vocab = bpe.vocabulary(bpe.load(vocabulary_path()))
    import numpy as np

    pick = random.Random(3)
    names = {i: bpe._marked(t) for i, t in vocab.names.items() if vocab.lengths[i]}
    firsts = [i for i in names if not vocab.names[i].endswith(bpe.END)]
    pairs = [(pick.choice(firsts), pick.choice(list(names))) for _ in range(20_000)]
    a, b = (np.array(x) for x in zip(*pairs))
    judged = vocab.compatible(a, b)
    for (x, y), good in zip(pairs, judged):
        assert good == (merge_letters(vocab, names[x] + names[y]) == [x, y])
    assert 0 < judged.sum() < len(pairs)


def test_merging_side_by_side_equals_merging_alone():
    vocab = bpe.vocabulary(bpe.load(vocabulary_path()))
    pick = random.Random(4)
    words = ["".join(pick.choices("abeinorst", k=pick.randint(1, 30))) for _ in range(2000)] + ["a" * n for n in range(1, 40)]
    words = [w[:-1] + chr(ord(w[-1]) + bpe.LAST) for w in words]
    assert [list(x) for x in vocab.merge_words(words)] == [merge_letters(vocab, w) for w in words]


def test_decoding_of_odd_lists_and_empty_tables(spark):
    path = vocabulary_path()
    ids = spark.createDataFrame([(1, None), (2, []), (3, [320, -1, 10**6, 49407])], "k long, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode(ids, path).collect()}[1] == ""
    assert {r.k: r.decoded for r in bpe.decode(ids, path).collect()}[3].endswith(" <|endoftext|>")
    empty = spark.createDataFrame([], "doc_id long, text string, ids string")
    assert bpe.encode(empty, path).collect() == []
