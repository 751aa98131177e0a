"""BPE encoding and decoding by speculation and verification.

A word's tokens are first guessed by greedy longest match, which an automaton
over the vocabulary does for many words at once.  A token sequence is the BPE
encoding of its text exactly if every token encodes to itself and every pair
of neighbours is compatible: merging the two tokens' text gives the two tokens
again.  Compatibility of all pairs is tested at once with numpy.  Only words
that fail are merged step by step.

The vocabulary is a file of the tokenizers library with the model BPE and an
end-of-word suffix.  Its pipeline is: special tokens are cut out; NFC; white
space to a blank; lower case; a split by pattern; bytes to letters.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from cartwheel.llm.common import chunks

# Words remembered between chunks.  Beyond that the memory starts anew, which
# changes the speed only.
WORDS_KEPT = 400_000
END = "</w>"
# Characters on which all Unicode versions agree.  A text with any other goes
# through the library's own normaliser and split, whose tables may be older or
# newer than Python's.
COMMON = regex.compile("[\x00-\u0557\u1e00-\u206f\u20a0-\u20bf\u3000-\u9fff\uac00-\ud7a3\U0001f300-\U0001f64f]*+")
# The last letter of a word is moved up by this much, so that "last letter"
# is part of the letter and no token can reach over a word's end.
LAST = 0x1000
NO_MERGE = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves,
    the others, in order, for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def load(path: str) -> str:
    """Content of a vocabulary file, to be handed to the functions below."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _marked(token: str) -> str:
    """A token with its end-of-word suffix folded into the last letter."""
    if token.endswith(END) and len(token) > len(END):
        body = token[: -len(END)]
        return body[:-1] + chr(ord(body[-1]) + LAST)
    return token


@dataclass
class Ragged:
    """Rows of different lengths, one after the other."""

    values: np.ndarray
    lengths: np.ndarray


class Vocabulary:
    """Tables made from a vocabulary file, once per Python process."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or model.get("byte_fallback") or spec["decoder"]:
            raise ValueError("a BPE vocabulary with word ends and without a decoder is needed")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        size = max(self.names) + 1
        self.texts = pa.array([self.names.get(i, "") for i in range(size)], pa.string())
        ids = {_marked(t): i for t, i in model["vocab"].items()}
        self.base = {t: i for t, i in ids.items() if len(t) == 1}
        # the rank of the merge that makes a token, and its halves; letters have rank -1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y = ids[_marked(a)], ids[_marked(b)]
            whole = ids[_marked(a + b)]
            if (x, y) not in self.merges:
                self.merges[x, y] = (rank, whole)
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, x, y
        pairs = sorted((x << 32 | y, rank) for (x, y), (rank, _) in self.merges.items())
        self.pair_keys = np.array([p for p, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        self.made = np.zeros(len(model["merges"]), np.int64)  # token that each merge makes
        for rank, whole in self.merges.values():
            self.made[rank] = whole
        self.lengths = np.zeros(size, np.int64)
        self.automaton = ahocorasick.Automaton()
        for (t, i), merged in zip(ids.items(), self.merge_words(list(ids))):
            # a token that its own text does not encode to can never appear
            if list(merged) == [i]:
                self.automaton.add_word(t, i)
                self.lengths[i] = len(t)
        self.automaton.make_automaton()
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(pattern)
        self.normalizer = Tokenizer.from_str(content).normalizer
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        letters = byte_letters()
        self.letters = str.maketrans({chr(b): letters[b] for b in range(256)})
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.tokens = Ragged(np.zeros(0, np.int32), np.zeros(0, np.int64))

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NO_MERGE`` if there is none."""
        key = a.astype(np.int64) << 32 | b
        spot = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[spot] == key, self.pair_ranks[spot], NO_MERGE)

    def merge_words(self, words: list[str]) -> list[np.ndarray]:
        """Exact merging of many words side by side: each round does the next
        merge of every word that still has one."""
        ids = np.array([self.base[c] for w in words for c in w], np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.append(self.pair_rank(ids[:-1], ids[1:]), NO_MERGE)
        rank[np.flatnonzero(np.diff(owner))] = NO_MERGE
        done = []
        while len(ids):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(ids)))
            open_ = np.repeat(least < NO_MERGE, sizes)
            if not open_.all():
                done.append((owner[~open_], ids[~open_]))
                ids, owner, rank = ids[open_], owner[open_], rank[open_]
                sizes, least = sizes[least < NO_MERGE], least[least < NO_MERGE]
                if not len(ids):
                    break
            hit = rank == np.repeat(least, sizes)
            if (hit[1:] & hit[:-1]).any():  # as in "aaa": every second one, from the left
                spots = np.flatnonzero(hit)
                run = np.flatnonzero(np.diff(spots, prepend=-2) > 1)
                place = np.arange(len(spots)) - np.repeat(run, np.diff(np.append(run, len(spots))))
                hit[spots[place % 2 == 1]] = False
            spots = np.flatnonzero(hit)
            ids[spots] = self.made[rank[spots]]
            keep = np.ones(len(ids), bool)
            keep[spots + 1] = False
            ids, owner, rank, hit = ids[keep], owner[keep], rank[keep], hit[keep]
            fresh = np.flatnonzero(hit)
            fresh = np.union1d(fresh, np.maximum(fresh - 1, 0))
            fresh = fresh[fresh + 1 < len(ids)]
            new = self.pair_rank(ids[fresh], ids[fresh + 1])
            rank[fresh] = np.where(owner[fresh] == owner[fresh + 1], new, NO_MERGE)
            rank[-1] = NO_MERGE
        owner, ids = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(owner, kind="stable")
        return np.split(ids[order].astype(np.int32), np.cumsum(np.bincount(owner, minlength=len(words)))[:-1])

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays two tokens when merged together.

        Both tokens are taken apart again, the later merge first.  If letters
        on both sides of the border could have been merged before the step
        that is being undone, the border would have been crossed.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        good, open_ = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)
        strict = np.ones(len(a), bool)  # an equal rank further right waits for the left one
        while len(open_):
            x, y = a[open_], b[open_]
            rank, lim = self.pair_rank(x, y), limit[open_]
            crossed = np.where(strict[open_], rank < lim, rank <= lim) & (rank < NO_MERGE)
            good[open_[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            done = crossed | ((rx < 0) & (ry < 0))
            go = ~done
            open_, x, y, rx, ry = open_[go], x[go], y[go], rx[go], ry[go]
            # merges go by rank, equal ranks from the left: the last one done is undone first
            of_left = rx > ry
            a[open_] = np.where(of_left, self.right[x], x)
            b[open_] = np.where(of_left, y, self.left[y])
            limit[open_] = np.where(of_left, rx, ry)
            strict[open_] = of_left
        return good

    def tokens_of(self, words: list[str]) -> Ragged:
        """Token ids of words in letters, last letters marked."""
        joined = "".join(words)
        if not joined:
            return Ragged(np.zeros(0, np.int32), np.zeros(len(words), np.int64))
        ids = np.fromiter((i for _, i in self.automaton.iter_long(joined)), np.int32)
        ends = np.cumsum(self.lengths[ids])
        word_ends = np.cumsum([len(w) for w in words])
        count = np.searchsorted(ends, word_ends, "right")
        if ends[-1] != len(joined):
            raise ValueError("the vocabulary lacks a letter")
        lengths = np.diff(count, prepend=0)
        owner = np.repeat(np.arange(len(words)), lengths)
        bad = np.zeros(len(words), bool)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(ids[inner].astype(np.int64) << 32 | ids[inner + 1], return_inverse=True)
        fits = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        bad[owner[inner[~fits[back]]]] = True
        failed = np.flatnonzero(bad)
        if not len(failed):
            return Ragged(ids, lengths)
        exact = self.merge_words([words[k] for k in failed])
        pieces, at, starts = [], 0, np.concatenate([[0], count])
        for k, mended in zip(failed, exact):
            pieces += [ids[at: starts[k]], mended]
            at = starts[k + 1]
            lengths[k] = len(mended)
        return Ragged(np.concatenate([*pieces, ids[at:]]), lengths)

    def words(self, text: str) -> list[str]:
        """Pieces of one text between special tokens."""
        if not text.isascii():
            if not COMMON.fullmatch(text):
                return [w for w, _ in self.split.pre_tokenize_str(self.normalizer.normalize_str(text))]
            # a letter is lowered without regard to its neighbours
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.word.findall(text.lower())

    def encode(self, texts: list[str | None]) -> Ragged:
        if len(self.index) > WORDS_KEPT:
            self.reset()
        index, fresh, rows, counts = self.index, [], [], []
        special = len(self.names)  # a special token is a word of its own
        for text in texts:
            words: list = []
            if text:
                if self.cut and "<|" in text:
                    parts, at = [], 0
                    for m in self.cut.finditer(text):
                        words += [*self.words(text[at: m.start()]), (self.special[m[0]],)]
                        at = m.end()
                    words += self.words(text[at:])
                else:
                    words = self.words(text)
            known = [index.get(w, -1) for w in words]
            if -1 in known:
                for k, (i, w) in enumerate(zip(known, words)):
                    if i < 0:
                        known[k] = index.setdefault(w, len(index))
                        if known[k] == len(self.tokens.lengths) + len(fresh):
                            fresh.append(w)
            rows.append(np.array(known, np.int64))
            counts.append(len(known))
        if fresh:
            plain = [w for w in fresh if isinstance(w, str)]
            made = self.tokens_of([self._letters(w) for w in plain])
            if len(plain) < len(fresh):
                made = self._with_special(fresh, made)
            self.tokens = Ragged(np.concatenate([self.tokens.values, made.values]),
                                 np.concatenate([self.tokens.lengths, made.lengths]))
        starts = np.concatenate([[0], np.cumsum(self.tokens.lengths)])
        word = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        size = self.tokens.lengths[word]
        ends = np.cumsum(size)
        spots = np.repeat(starts[word] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        ends = np.concatenate([[0], ends])
        bounds = ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return Ragged(self.tokens.values[spots], np.diff(bounds))

    def _letters(self, word: str) -> str:
        word = word.encode().decode("latin-1").translate(self.letters)
        return word[:-1] + chr(ord(word[-1]) + LAST)

    @staticmethod
    def _with_special(fresh: list, made: Ragged) -> Ragged:
        pieces, lengths, parts = [], [], iter(np.split(made.values, np.cumsum(made.lengths)[:-1]))
        for w in fresh:
            pieces.append(next(parts) if isinstance(w, str) else np.array(w, np.int32))
            lengths.append(len(pieces[-1]))
        return Ragged(np.concatenate(pieces), np.array(lengths, np.int64))


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(content: str) -> Vocabulary:
    if content not in _LOADED:
        _LOADED.clear()
        _LOADED[content] = Vocabulary(content)
    return _LOADED[content]


def _with_column(batch: pa.RecordBatch, keep: list[str], name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], values], names=[*keep, name])


def _list_array(rows: Ragged, kind: pa.DataType = pa.int32()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rows.lengths)]), pa.int32()), pa.array(rows.values, kind))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns but the text, and ``ids`` (array of int).

    NULL and empty texts have no ids.  Special tokens written out in a text
    become their ids; none are added.  A text is held whole by one task.
    """
    content = df.sparkSession.sparkContext.broadcast(load(path))
    keep = [c for c in df.columns if c not in (text, ids)]
    schema = df.select(*keep).withColumn(ids, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(content.value)
        for batch in chunks(batches, text):
            rows = vocab.encode(batch.column(text).to_pylist())
            yield _with_column(batch, keep, ids, _list_array(rows))

    return df.select(*keep, text).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and the decoded text: the tokens' names joined by blanks, as
    the library does without a decoder.  Ids outside the vocabulary are left
    out; NULL and empty lists give an empty text."""
    content = df.sparkSession.sparkContext.broadcast(load(path))
    keep = [c for c in df.columns if c != text]
    schema = df.select(*keep).withColumn(text, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(content.value)
        names, size = vocab.texts, len(vocab.texts)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                lists = part.column(ids)
                flat = lists.flatten()
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                known = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, size)), False)
                spots = known.to_numpy(zero_copy_only=False)
                if not spots.all():
                    owner = np.repeat(np.arange(len(lengths)), lengths)
                    lengths = np.bincount(owner[spots], minlength=len(lengths))
                    flat = flat.filter(known)
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), names.take(flat))
                yield _with_column(part, keep, text, pc.binary_join(tokens, " "))

    return df.select(*keep).mapInArrow(run, schema)
