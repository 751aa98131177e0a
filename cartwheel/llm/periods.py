"""Periodic runs of words, found while a text grows.

A run is a stretch whose words repeat with a smallest period q, at least twice,
that no neighbouring word continues.  ``Catchers`` finds them online: words are
appended, and every square (two equal halves) that an appended word completes
is caught and merged with its neighbours into a run.

For the periods from 2b to 4b - 1, b a power of two, every completed block of b
words (aligned to b) is a catcher.  A stretch in which each word equals the one
q words later, for q words or more, covers such a block, so the block's words
come again q words after it.  Each appended word ends one window of b words
per b, which is compared with the two blocks it can repeat.  Windows are
compared by names made by doubling (the name of 2b words from the names of its
halves); what agrees is then compared word by word to both sides, so equal
names of different windows do no harm.  Periods below 8 have a catcher at
every place, of up to four words.

Stretches that still agree at the last word stay open and go on with the next
words.  A period that is a multiple of a known one inside the same run is
passed over, so texts of one repeated word do not make quadratic work.  All
words of an ``append`` are compared at once; the runs do not depend on how the
words are cut into appends.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import chunks

SHORT = 8  # periods below have catchers at every place
FIRST = 4  # words of the smallest aligned block
SLICE = 1 << 16  # words that are appended at once, at least

_ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    mixed = left * _ODD[0] + (right ^ (right >> np.uint64(31))) * _ODD[1]
    return mixed ^ (mixed >> np.uint64(29))


class Catchers:
    """Runs of at least ``least`` words and two periods in the words appended."""

    def __init__(self, least: int = 12):
        self.least = least
        self.words = np.empty(0, np.uint64)
        self.names: list[np.ndarray] = []  # by level: names of windows of 2 ** level words ...
        self.bases: list[int] = []  # ... from this start on
        self.stretches: list[list[int]] = []  # [left, right, period]: words left..right-1 equal those a period later
        self.open: dict[int, list[int]] = {}

    def _need(self, period: int) -> int:
        return max(self.least - period, period)

    def append(self, words: np.ndarray) -> None:
        """Numbers of the next words; equal words have equal numbers."""
        if not len(words):
            return
        old = len(self.words)
        self.words = np.concatenate([self.words, words.astype(np.uint64)])
        self._go_on()
        self._name(old)
        for period in range(1, min(SHORT, len(self.words))):
            self._catch_short(period, old)
        level, block = FIRST.bit_length() - 1, FIRST
        while 3 * block <= len(self.words):
            self._catch(level, block, old)
            level, block = level + 1, 2 * block
        self._forget()

    def _go_on(self) -> None:
        """Open stretches advance over the new words."""
        for period, stretch in list(self.open.items()):
            stretch[1] = self._forward(stretch[1], period)
            if stretch[1] < len(self.words) - period:
                del self.open[period]
                if stretch[1] - stretch[0] >= period:
                    self.stretches.append(stretch)

    def _name(self, old: int) -> None:
        """Names of the windows that the new words complete."""
        n = len(self.words)
        if not self.names:
            self.names, self.bases = [np.empty(0, np.uint64)], [0]
        self.names[0] = np.concatenate([self.names[0], self.words[old:]])
        level, block = 1, 2
        while block <= n:
            if level == len(self.names):
                self.names.append(np.empty(0, np.uint64))
                self.bases.append(0)
            half, base = self.names[level - 1], self.bases[level - 1]
            start, end = self.bases[level] + len(self.names[level]), n - block + 1
            left = half[start - base:end - base]
            right = half[start - base + block // 2:end - base + block // 2]
            new = _named(left, right)
            self.names[level] = np.concatenate([self.names[level], new]) if len(self.names[level]) else new
            level, block = level + 1, 2 * block

    def _forget(self) -> None:
        """Only the blocks that later windows can meet are kept."""
        n = len(self.words)
        for level, base in enumerate(self.bases):
            block = 1 << level
            keep = max(base, n - 6 * max(block, 2 * SHORT))
            if keep > base:
                self.names[level] = self.names[level][keep - base:].copy()
                self.bases[level] = keep

    def _catch_short(self, period: int, old: int) -> None:
        level = min(FIRST, self._need(period)).bit_length() - 1
        block = 1 << level
        start = max(0, old - block + 1 - period)
        end = len(self.words) - block + 1 - period
        if end <= start:
            return
        names, base = self.names[level], self.bases[level]
        found = np.flatnonzero(names[start - base:end - base] == names[start - base + period:end - base + period])
        if len(found):
            self._merge(found + start, np.full(len(found), period), block)

    def _catch(self, level: int, block: int, old: int) -> None:
        """Windows that the new words complete against the two blocks that lie
        two to four blocks before them."""
        names, base = self.names[level], self.bases[level]
        start, end = max(2 * block, old - block + 1), len(self.words) - block + 1
        if end <= start:
            return
        first = start >> level
        aligned = np.arange(first - 3, ((end - 1) >> level) - 1) * block  # blocks three before the first window's, to two before the last's
        known = names[np.maximum(aligned, 0) - base]
        at = (np.arange(start, end) >> level) - first
        window = names[start - base:end - base]
        for back in (1, 0):  # the nearer block has the shorter period
            hit = np.flatnonzero(window == known[at + back])
            if len(hit):
                block_start = aligned[at[hit] + back]
                real = block_start >= 0
                if real.any():
                    s, q = block_start[real], hit[real] + start - block_start[real]
                    order = np.lexsort([s, q])
                    self._merge(s[order], q[order], block)

    def _merge(self, starts: np.ndarray, periods: np.ndarray, block: int) -> None:
        """Repeats (block at start, again a period later), by period and start,
        become stretches."""
        for left, right, period in [*self.stretches, *self.open.values()]:
            if period < periods[-1]:
                known = (periods % period == 0) & (periods > period) & (starts >= left) & (starts + periods + block <= right + period)
                if known.any():
                    starts, periods = starts[~known], periods[~known]
                    if not len(starts):
                        return
        last, reached = 0, 0
        for start, period in zip(starts.tolist(), periods.tolist()):
            if period != last:
                last, reached = period, self.open[period][1] if period in self.open else 0
            if start < reached:
                continue
            right = self._forward(start, period)
            reached = right
            if right == start:  # another window of the same name
                continue
            stretch = [self._backward(start, period), right, period]
            if right == len(self.words) - period:
                self.open[period] = stretch
            elif right - stretch[0] >= period:
                self.stretches.append(stretch)

    def _forward(self, at: int, period: int) -> int:
        """First place from ``at`` on whose word differs from that a period on."""
        end, step = len(self.words) - period, 64
        while at < end:
            stop = min(end, at + step)
            differ = self.words[at:stop] != self.words[at + period:stop + period]
            first = int(differ.argmax())
            if differ[first]:
                return at + first
            at, step = stop, 2 * step
        return end

    def _backward(self, at: int, period: int) -> int:
        """First place of the stretch that goes on to ``at``."""
        step = 64
        while at:
            stop = max(0, at - step)
            differ = (self.words[stop:at] != self.words[stop + period:at + period])[::-1]
            first = int(differ.argmax())
            if differ[first]:
                return at - first
            at, step = stop, 2 * step
        return 0

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run so far, by start, then period."""
        least: dict[tuple[int, int], int] = {}
        for left, right, period in [*self.stretches, *self.open.values()]:
            if right - left >= self._need(period):
                place = left, right + period - left
                least[place] = min(period, least.get(place, period))
        return sorted((start, length, period) for (start, length), period in least.items())


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    return text.split()


def runs_of(words: Sequence[bytes], least: int = 12) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a list of words."""
    if len(words) < max(least, 2):
        return []
    ids: dict[bytes, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return []
    catchers, done = Catchers(least), 0
    while done < len(words):
        more = max(SLICE, done)  # each append doubles a long text at most
        catchers.append(numbers[done:done + more])
        done += more
    return catchers.runs()


def dropped(runs: Sequence[tuple[int, int, int]], n: int) -> np.ndarray:
    """Marks the words that lie in a run after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) > 0


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """Rows (key, n_words, runs, collapsed, n_dropped), one for each row of
    ``df``: runs of at least ``least`` words and two periods as
    array<struct<start, length, period>>, by start, then period; the words
    left when each run keeps its first period only, joined by one space.

    A NULL text and a text without words have no runs and an empty result.
    Keys are only passed on: NULL, repeated and tied keys are rows like any
    other.  No other column is read, so extra columns may have any name; an
    empty table gives an empty result.  A text is worked on whole, by one
    task, in memory in proportion to it; nothing is shuffled.
    """
    kind = df.schema[key].dataType.simpleString()
    row = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            counts, offsets, flat, left, gone = [], [0], [], [], []
            for value in batch.column("_text").to_pylist():
                words = words_of(value or b"")
                found = runs_of(words, least)
                counts.append(len(words))
                if found:
                    drop = dropped(found, len(words))
                    gone.append(int(drop.sum()))
                    words = [words[i] for i in np.flatnonzero(~drop)]
                    flat += found
                else:
                    gone.append(0)
                left.append(b" ".join(words))
                offsets.append(len(flat))
            table = np.array(flat, np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(3)], fields=list(row))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                 pa.array(left, pa.binary()).cast(pa.string()), pa.array(gone, pa.int64())],
                names=["key", "n_words", "runs", "collapsed", "n_dropped"])

    rows = df.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text"))
    return rows.mapInArrow(
        work, f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string, n_dropped long")
