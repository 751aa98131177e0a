"""Toxicity by non-negative positive-unlabelled learning.

Only texts confirmed as toxic count as positive; all others are unlabelled, and
a known share of those (``left``) is toxic too.  The risk of calling a text
harmless is therefore taken from unlabelled text and corrected by that share:

    prior * mean_P loss(+f) + (1 - prior) / (1 - left) * max(0, mean_U loss(-f) - left * mean_P loss(-f))

with the logistic loss and the class prior of all texts; the share left is
smaller than the prior where confirmed texts were taken out of the unlabelled.
Where the second part is negative, its gradient is turned round, which keeps a
flexible model from driving it below zero.

Features are words and beginnings of words, hashed.  Those clearly more
frequent in positive than in harmless texts are kept, the latter estimated by
taking the toxic share out of the unlabelled; a feature's value is the logarithm
of its count times its log-odds, divided by the square root of the text's
length in words.  A text's score is the sigmoid of a linear function of these.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import chunks

BUCKETS = 1 << 20
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6, 7)
LEAST_ODDS = 0.5
LEAST_ERRORS = 2.5  # standard errors by which log-odds must exceed zero
SCALE = 5.0
WORDS_KEPT = 100_000  # words remembered by a task; beyond that it starts anew


@dataclass
class Model:
    columns: np.ndarray  # column of each bucket, -1 if it has none
    weights: np.ndarray  # one for each column, log-odds included
    bias: float


def buckets(word: str) -> list[int]:
    """Buckets of a word: itself and its beginnings."""
    found = [zlib.crc32(word.encode()) % BUCKETS]
    return found + [zlib.crc32(b"%d " % n + word[:n].encode()) % BUCKETS for n in PREFIXES if len(word) > n]


def _counted(text: str | None) -> tuple[Counter, float]:
    """Words with their counts, and the norm of the text."""
    words = WORD.findall(text.lower()) if text else []
    return Counter(words), float(np.sqrt(len(words) + 1))


def _features(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Rows (kind, spots, counts, norm, place) of a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            spots, counts, norms, places = [], [], [], []
            for t in batch.column(text).to_pylist():
                words, norm = _counted(t)
                total: Counter = Counter()
                for word, n in words.items():
                    for b in buckets(word):
                        total[b] += n
                order = sorted(total)
                spots.append(order)
                counts.append([total[b] for b in order])
                norms.append(norm)
                places.append(zlib.crc32(t.encode()) << 31 | len(t))
            yield pa.RecordBatch.from_arrays(
                [batch.column(kind), pa.array(spots, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
                 pa.array(norms, pa.float64()), pa.array(places, pa.int64())], names=["kind", "spots", "counts", "norm", "place"])

    return df.select(F.col(text), F.col(kind).cast("int")).mapInArrow(run, "kind int, spots array<int>, counts array<int>, norm double, place long")


@dataclass
class Sample:
    """Texts as rows of a sparse matrix."""

    spots: np.ndarray
    counts: np.ndarray
    sizes: np.ndarray
    norms: np.ndarray


def slopes(f: np.ndarray, k: int, prior: float, left: float) -> np.ndarray:
    """Derivatives by ``f`` of what a step lowers, the first ``k`` being
    positive: the corrected risk, or, where its second part is negative, that
    part turned round."""
    up = 1 / (1 + np.exp(-np.clip(f, -50, 50)))  # derivative of loss(-f); that of loss(+f) is up - 1
    corrected = np.logaddexp(0, f[k:]).mean() - left * np.logaddexp(0, f[:k]).mean()
    turned = (1 if corrected >= 0 else -1) * (1 - prior) / (1 - left)
    of_positive = prior * (up[:k] - 1) * (corrected >= 0) - turned * left * up[:k]
    return np.concatenate([of_positive / k, turned * up[k:] / (len(f) - k)])


def train(positive: Sample, unlabelled: Sample, prior: float, left: float, min_texts: int = 10, epochs: int = 50, batch: int = 512,
          rate: float = 0.02, decay: float = 1e-2, seed: int = 3) -> Model:
    """Fit by Adam on mixed batches; ``left`` is the share of toxic texts among
    the unlabelled.  Features in fewer than ``min_texts``
    sampled texts are left out.  Without positive or unlabelled texts, or
    without features, the model says the prior for every text."""
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    left = min(max(left, 0.0), prior)
    b = np.array([np.log(prior / (1 - prior)), 0.0, 0.0])
    none = Model(np.full(BUCKETS, -1, np.int32), np.zeros(0), float(b[0]))
    n_p, n_u = len(positive.sizes), len(unlabelled.sizes)
    if not n_p or not n_u:
        return none
    seen_p, seen_u = (np.bincount(s.spots, minlength=BUCKETS) for s in (positive, unlabelled))
    # harmless texts that hold a feature: unlabelled ones without the toxic share of them
    harmless = np.maximum(seen_u - left * n_u * seen_p / n_p, 0)
    odds = np.log((seen_p + 1) / (n_p + 2)) - np.log((harmless + 1) / ((1 - left) * n_u + 2))
    error = np.sqrt(1 / (seen_p + 1) + 1 / (harmless + 1))
    kept = np.flatnonzero((odds > LEAST_ODDS) & (odds > LEAST_ERRORS * error) & (seen_p + seen_u >= min_texts))
    if not len(kept):
        return none
    columns = none.columns.copy()
    columns[kept] = np.arange(len(kept))

    def rows(s: Sample) -> tuple[list[np.ndarray], list[np.ndarray]]:
        owner = np.repeat(np.arange(len(s.sizes)), s.sizes)
        use = columns[s.spots] >= 0
        owner, spots = owner[use], s.spots[use]
        values = np.log1p(s.counts[use]) * odds[spots] * SCALE / s.norms[owner]
        ends = np.cumsum(np.bincount(owner, minlength=len(s.sizes)))[:-1]
        return np.split(columns[spots], ends), np.split(values, ends)

    (spots_p, values_p), (spots_u, values_u) = rows(positive), rows(unlabelled)
    pick = np.random.default_rng(seed)
    w, m, v = (np.zeros(len(kept)) for _ in range(3))
    k = min(max(batch // 8, int(batch * n_p / (n_p + n_u))), n_p)
    step = 0
    for _ in range(epochs):
        order = pick.permutation(n_u)
        for start in range(0, n_u, batch - k):
            us, ps = order[start: start + batch - k], pick.choice(n_p, k, replace=False)
            parts = [*[spots_p[i] for i in ps], *[spots_u[i] for i in us]]
            flat = np.concatenate(parts)
            x = np.concatenate([*[values_p[i] for i in ps], *[values_u[i] for i in us]])
            owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            f = b[0] + np.bincount(owner, w[flat] * x, minlength=len(parts))
            slope = slopes(f, k, prior, left)
            step += 1
            for value, mean, square, gradient in (
                (w, m, v, np.bincount(flat, slope[owner] * x, minlength=len(kept)) + decay * prior * w),
                (b[:1], b[1:2], b[2:], slope.sum(keepdims=True)),
            ):
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient**2 - square)
                value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(columns, w * odds[kept] * SCALE, float(b[0]))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_positive: int = 2500, max_unlabelled: int = 5000) -> Model:
    """Model from the texts whose ``label`` is 1 and texts without regard to
    a label.

    The fit uses a sample of at most ``max_positive`` and ``max_unlabelled``
    texts, each taken in the order of a hash of the key; the prior is the share
    of ones among all non-NULL labels.  Unlabelled texts are drawn from all but
    the sampled positive ones; the toxic share left there is that of the prior
    less these, by a count of the keys (a sketch, 1 % error).  Only hashed
    features of the sample reach the driver.  NULL keys and texts are not
    sampled; of several texts of one key the smallest is.
    """
    known = labels.select(F.col(key), F.col(label).cast("int").alias("_toxic")).dropna()
    prior = known.agg(F.avg("_toxic")).first()[0] or 0.0
    order = F.xxhash64(F.lit("sample"), key)
    toxic = known.where("_toxic = 1").select(key).distinct()
    positive = toxic.orderBy(order, key).limit(max_positive).withColumn("_kind", F.lit(1))
    order = F.xxhash64(F.lit("unlabelled"), key)
    others = docs.select(key).dropna().distinct().orderBy(order, key).limit(max_unlabelled + max_positive)
    unlabelled = others.join(positive, key, "left_anti").orderBy(order, key).limit(max_unlabelled).withColumn("_kind", F.lit(0))
    # the limits above bound the size of the sample
    found = docs.where(F.col(text).isNotNull()).select(key, text).join(F.broadcast(positive.unionByName(unlabelled)), key)
    sample = found.groupBy(key, "_kind").agg(F.min(text).alias(text))
    table = _features(sample, text, "_kind").toArrow().combine_chunks()
    kinds, places = table["kind"].to_numpy(), table["place"].to_numpy()

    def side(kind: int) -> Sample:
        own = table.take(np.lexsort([places, kinds])[np.sort(kinds) == kind])
        flat = [pc.list_flatten(own[c]).to_numpy() for c in ("spots", "counts")]
        return Sample(*flat, pc.list_value_length(own["spots"]).to_numpy(), own["norm"].to_numpy())

    every, taken = docs.agg(F.approx_count_distinct(key, 0.01)).first()[0], int((kinds == 1).sum())
    left = (prior * every - taken) / (every - taken) if every > taken else 0.0
    return train(side(1), side(0), prior, left)


def score(df: DataFrame, model: Model, text: str = "text", result: str = "score") -> DataFrame:
    """All columns and the score (0 to 1) of every whole text; NULL and empty
    texts get the score of a text without words."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c != result]
    schema = df.select(*keep).withColumn(result, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        columns: dict[str, tuple[int, ...]] = {}
        for batch in chunks(batches, text):
            scores = []
            for t in batch.column(text).to_pylist():
                if len(columns) > WORDS_KEPT:
                    columns.clear()
                words, norm = _counted(t)
                counts: dict[int, int] = {}
                for word, n in words.items():
                    own = columns.get(word)
                    if own is None:
                        found = (int(model.columns[b]) for b in buckets(word))
                        own = columns[word] = tuple(c for c in found if c >= 0)
                    for c in own:
                        counts[c] = counts.get(c, 0) + n
                spots, sizes = np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.float64, len(counts))
                value = model.bias + float((model.weights[spots] * np.log1p(sizes)).sum()) / norm
                scores.append(float(1 / (1 + np.exp(-np.clip(value, -500, 500)))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(scores, pa.float64())], names=[*keep, result])

    return df.select(*keep).mapInArrow(run, schema)
