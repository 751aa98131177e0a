"""Language identification as inference of a mixture.

A text is cut into short segments.  Each language gives every segment a
likelihood by its letter trigrams (bytes of the lowered text, everything but
letters read as one blank).  Expectation-maximisation estimates the share of
each language in the text.  Sets of the most frequent 1, 2, .. languages are
fitted in turn, and the set with the best likelihood, less a penalty for each
language that grows with the logarithm of the text's length, is chosen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import chunks

BUCKETS = 1 << 16
SEGMENT = 48  # trigrams
SMOOTHING = 0.2
ROUNDS = 12
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
# ASCII other than lower-case letters becomes a blank; bytes of other letters stay.
_BLANK = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


@dataclass
class Model:
    languages: list[str]
    likelihood: np.ndarray  # log-likelihood of each trigram bucket by language; blanks give 0


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts and the offsets of each text's trigrams;
    runs of blanks count as bucket 0."""
    parts = [b" " + t.lower().encode("utf-8", "surrogatepass") + b"  " if t else b"   " for t in texts]
    data = _BLANK[np.frombuffer(b"".join(parts), np.uint8)].astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    mixed = (data[:-2] * 0x9E3779B1 ^ data[1:-1] * 0x85EBCA77 ^ data[2:] * 0xC2B2AE3D) * np.uint32(0x27D4EB2F) >> np.uint32(16)
    bucket = np.maximum(mixed, 1).astype(np.int32)
    bucket[(data[1:-1] == 32)] = 0  # a trigram is named by its middle letter
    return np.concatenate([bucket, [0, 0]]).astype(np.int32), starts


def count_trigrams(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Rows (lang, bucket, n): added up in each chunk, then over all chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            bucket, starts = trigrams(batch.column(text).to_pylist())
            names, of = np.unique(np.array(batch.column(lang).to_pylist(), object).astype(str), return_inverse=True)
            for k, name in enumerate(names):
                counts = np.zeros(BUCKETS, np.int64)
                for i in np.flatnonzero(of == k):
                    counts += np.bincount(bucket[starts[i]: starts[i + 1]], minlength=BUCKETS) if starts[i + 1] - starts[i] > 4096 else 0
                short = [bucket[starts[i]: starts[i + 1]] for i in np.flatnonzero(of == k) if starts[i + 1] - starts[i] <= 4096]
                if short:
                    counts += np.bincount(np.concatenate(short), minlength=BUCKETS)
                counts[0] = 0
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(name)] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used])], names=["lang", "bucket", "n"])

    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram likelihoods of each non-NULL ``lang`` from all its texts.  The
    driver gets at most one count for each language and bucket."""
    counts = count_trigrams(df, text, lang).toPandas()
    languages = sorted(counts.lang.unique())
    table = np.zeros((BUCKETS, len(languages)))
    spot = {name: k for k, name in enumerate(languages)}
    table[counts.bucket, counts.lang.map(spot).to_numpy(np.int64)] = counts.n
    used = max(int((table.sum(axis=1) > 0).sum()), 1)
    log = np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * used))
    log[0] = 0
    return Model(languages, log.astype(np.float32))


def _maximise(like: np.ndarray, owner: np.ndarray, texts: int, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages for each text, and the log-likelihood."""
    size = np.maximum(np.bincount(owner, minlength=texts), 1)
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    top = like.max(axis=1, keepdims=True)
    held = np.exp(np.maximum(like - top, -60))
    for _ in range(rounds):
        parts = held * shares[owner]
        parts /= np.maximum(parts.sum(axis=1, keepdims=True), 1e-300)
        shares = np.stack([np.bincount(owner, parts[:, k], texts) for k in range(like.shape[1])], axis=1) / size[:, None]
    total = np.log(np.maximum((held * shares[owner]).sum(axis=1), 1e-300)) + top[:, 0]
    return shares, np.bincount(owner, total, texts)


def infer(model: Model, texts: list[str | None], most: int = 4) -> np.ndarray:
    """Shares of the chosen languages for each text."""
    bucket, starts = trigrams(texts)
    lengths = np.diff(starts)
    pieces = (lengths + SEGMENT - 1) // SEGMENT
    owner = np.repeat(np.arange(len(texts)), pieces)
    first = np.cumsum(pieces) - pieces
    cuts = starts[owner] + (np.arange(len(owner)) - first[owner]) * SEGMENT
    like = np.stack([np.add.reduceat(model.likelihood[:, k][bucket], cuts, dtype=np.float64) for k in range(len(model.languages))], axis=1)
    n, wide = len(texts), len(model.languages)
    best, _ = _maximise(like, owner, n, np.ones((n, wide)), ROUNDS)
    order = np.argsort(-best, axis=1, kind="stable")
    penalty = np.log(np.maximum(lengths, 2)) * 2
    chosen, value = None, None
    for k in range(1, min(most, wide) + 1):
        allowed = np.zeros((n, wide))
        np.put_along_axis(allowed, order[:, :k], 1.0, axis=1)
        shares, likelihood = _maximise(like, owner, n, allowed, ROUNDS if k > 1 else 1)
        now = likelihood - penalty * k
        if chosen is None:
            chosen, value = shares, now
        else:
            better = now > value
            chosen[better], value[better] = shares[better], now[better]
    return chosen


def predict(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", share: str = "score", most: int = 4) -> DataFrame:
    """All columns, the language with the largest share of the text (ties: the
    first name) and that share.

    ``und`` with 0.0 for NULL texts, texts without a letter and models without
    a language.  ``most`` bounds the languages of one text.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c not in (lang, share)]
    schema = df.select(*keep).withColumn(lang, F.lit("")).withColumn(share, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in chunks(batches, text):
            texts = batch.column(text).to_pylist()
            spoken = [bool(t and LETTER.search(t)) and bool(model.languages) for t in texts]
            names, parts = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if any(spoken):
                shares = infer(model, texts, most)
                for i, top in enumerate(shares.argmax(axis=1)):
                    if spoken[i]:
                        names[i], parts[i] = model.languages[top], float(min(shares[i, top], 1.0))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(names, pa.string()), pa.array(parts, pa.float64())], names=[*keep, lang, share])

    return df.select(*keep).mapInArrow(run, schema)
