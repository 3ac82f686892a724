"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

A document becomes a sparse vector: a bucket for each distinct lower-case word or run of signs, with
the logarithm of its count, one bucket for the range each statistic of its structure falls into, and
one for the length its metadata states. The score is the logistic function of a bias, a weight for
each bucket and a product of low-rank vectors for each pair of buckets; the pairs' sum is taken in
linear time as half the difference between the square of the sum and the sum of squares.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemart.llm.common import fresh
from quotemart.llm.labelled import sample

# At most so many labelled documents are learnt from.
ROWS = 8_000
# Documents are good from this score on.
GOOD = 0.5
BUCKETS, RANK = 1 << 15, 8
# Ranges of a statistic, and the statistics.
RANGES = 12
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
STATISTICS = (
    "upper", "signs", "digits", "foreign", "space", "bars", "word_length", "distinct", "commonest", "echoes", "one_sign", "long_words",
    "short_words", "words", "line_length", "same_lines", "stops", "stated",
)
# Character classes of bytes: 0 other, 1 upper, 2 lower, 3 digit, 4 white space, 5 sign, 6 beyond ASCII, 7 bar.
CLASSES = bytes(
    7 if c == 124 else 6 if c > 127 else 1 if 65 <= c <= 90 else 2 if 97 <= c <= 122 else 3 if 48 <= c <= 57
    else 4 if c in (9, 10, 11, 12, 13, 32) else 5 if 33 <= c <= 126 else 0 for c in range(256)
)


def statistics(text: str, tokens: list[str], counts: Counter, stated: int | None) -> list[float]:
    """The structure statistics, each from 0 to 1, and the stated length on the same scale."""
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(np.frombuffer(raw.translate(CLASSES), dtype=np.uint8), minlength=8) if raw else np.zeros(8)
    size, n = max(len(raw), 1), max(len(tokens), 1)
    letters = max(kinds[1] + kinds[2], 1)
    words = [t for t in counts if t[0].isalnum()]
    n_words = max(sum(counts[w] for w in words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        kinds[1] / letters,
        kinds[5] / size * 2,
        kinds[3] / size * 4,
        kinds[6] / size * 4,
        kinds[4] / size * 2,
        kinds[7] / size * 8,
        sum(len(w) * counts[w] for w in words) / n_words / 16,
        len(counts) / n,
        max(counts.values(), default=0) / n * 2,
        sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / n,
        sum(v for t, v in counts.items() if len(t) > 1 and not t[0].isalnum()) / n * 2,
        sum(counts[w] for w in words if len(w) > 9) / n_words,
        sum(counts[w] for w in words if len(w) < 4) / n_words,
        np.log1p(n_words) / 12,
        np.log1p(len(text) / max(len(lines), 1)) / 12,
        1 - len(set(lines)) / max(len(lines), 1),
        (counts["."] + counts["?"] + counts["!"]) / n * 4,
        0.0 if stated is None or not stated >= 0 else np.log1p(stated) / 14,
    ]


def features(text: str | None, stated: int | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a document; null counts as the empty text."""
    text = text or ""
    tokens = TOKEN.findall(text.lower())
    counts = Counter(tokens)
    crc = zlib.crc32
    words = np.fromiter((crc(t.encode("utf-8", "surrogatepass")) for t in counts), dtype=np.int64, count=len(counts)) % buckets
    values = np.log1p(np.fromiter(counts.values(), dtype=np.float32, count=len(counts)))
    values /= max(float(np.sqrt((values**2).sum())), 1.0)
    found = statistics(text, tokens, counts, stated)
    ranges = [buckets + k * RANGES + min(int(x * RANGES), RANGES - 1) for k, x in enumerate(found)]
    values = np.concatenate([values, np.full(len(ranges), 0.5, dtype=np.float32)])
    return np.concatenate([words, np.array(ranges)]).astype(np.int32), values


@dataclass
class Machine:
    """Bias, weights and low-rank vectors."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    buckets: int

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the sums of the vectors, of documents whose features start at ``starts``."""
        scaled = self.factors[index] * value[:, None]
        sums = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat(scaled**2, starts)
        linear = np.add.reduceat(self.weights[index] * value, starts)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(1), sums

    def score(self, texts: list, stated: list) -> np.ndarray:
        """Probabilities of label 1."""
        out = np.empty(len(texts))
        for k, (text, n) in enumerate(zip(texts, stated, strict=True)):
            index, value = features(text, n, self.buckets)
            out[k] = self.raw(index, value, np.zeros(1, dtype=np.int64))[0][0]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(texts: list, stated: list, labels: np.ndarray, buckets: int = BUCKETS, rank: int = RANK, epochs: int = 8, seed: int = 7) -> Machine:
    """Learn a machine by stochastic gradients with step sizes of their own for each parameter.

    Without rows, or with one label only, the bias alone tells the smoothed share of label 1.
    """
    size = buckets + len(STATISTICS) * RANGES
    rng = np.random.default_rng(seed)
    share = (float(labels.sum()) + 1) / (len(labels) + 2)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size, dtype=np.float32), rng.normal(0, 0.05, (size, rank)).astype(np.float32), buckets)
    if len(set(labels.tolist())) < 2:
        machine.factors[:] = 0
        return machine
    found = [features(t, n, buckets) for t, n in zip(texts, stated, strict=True)]
    past_w, past_f, past_b = np.full(size, 1e-6, np.float32), np.full((size, rank), 1e-6, np.float32), 1e-6
    rate, decay, batch = 0.08, 2e-4, 32
    for _ in range(epochs):
        order = rng.permutation(len(found))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sizes = np.array([len(found[r][0]) for r in rows])
            index = np.concatenate([found[r][0] for r in rows])
            value = np.concatenate([found[r][1] for r in rows])
            which = np.repeat(np.arange(len(rows)), sizes)
            raw, sums = machine.raw(index, value, np.cumsum(sizes) - sizes)
            wrong = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[rows]).astype(np.float32)
            step = wrong[which] * value
            unique, place = np.unique(index, return_inverse=True)
            grad_w = np.bincount(place, step, len(unique)).astype(np.float32) + decay * machine.weights[unique]
            each = step[:, None] * (sums[which] - machine.factors[index] * value[:, None])
            grad_f = np.stack([np.bincount(place, each[:, f], len(unique)) for f in range(rank)], 1).astype(np.float32)
            grad_f += decay * machine.factors[unique]
            past_w[unique] += grad_w**2
            past_f[unique] += grad_f**2
            past_b += float(wrong.sum()) ** 2
            machine.weights[unique] -= rate * grad_w / np.sqrt(past_w[unique])
            machine.factors[unique] -= rate / 4 * grad_f / np.sqrt(past_f[unique])
            machine.bias -= rate * float(wrong.sum()) / past_b**0.5
    return machine


def train(
    docs: DataFrame, labels: DataFrame, allowed: Column, text: str = "text", stated: str = "n_chars", label: str = "quality",
    doc_id: str = "doc_id", rows: int = ROWS,
) -> Machine:
    """Fit a machine in one task on a sample of at most ``rows`` labelled documents; no rows give an even score."""
    given = sample(docs, labels, label, rows, allowed, [text, stated], doc_id)

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([text, stated, "label"], na_position="first")
        known = [None if pd.isna(n) else int(n) for n in frame[stated]]
        machine = fit(frame[text].tolist(), known, frame["label"].to_numpy(np.float64))
        return pd.DataFrame({"bias": [machine.bias], "weights": [machine.weights.tobytes()], "factors": [machine.factors.tobytes()]})

    found = given.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(learn, "bias double, weights binary, factors binary").collect()
    if not found:
        return fit([], [], np.zeros(0))
    weights, factors = (np.frombuffer(bytes(x), dtype=np.float32) for x in (found[0].weights, found[0].factors))
    return Machine(found[0].bias, weights, factors.reshape(len(weights), RANK), BUCKETS)


def score(text: Column, stated: Column, machine: Machine) -> Column:
    """Probability that a text is good, from 0 to 1, for null and empty texts too."""

    @F.pandas_udf("double")
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lengths in batches:
            yield pd.Series(machine.score(texts.tolist(), [None if pd.isna(n) else int(n) for n in lengths]))

    return of(text, stated.cast("long"))


def scored(docs: DataFrame, machine: Machine, text: str = "text", stated: str = "n_chars", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score) for every document row.

    Null and empty texts get the score of the empty text, a null length counts as none stated.
    Repeated rows give repeated rows, an empty table none; other columns play no part.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), score(F.col(text), F.col(stated), machine).alias("score"))


def keep_good(docs: DataFrame, machine: Machine, least: float = GOOD, text: str = "text", stated: str = "n_chars") -> DataFrame:
    """The documents with a score of at least ``least``, all columns as they came."""
    name = fresh(docs, "score")
    rated = docs.withColumn(name, score(F.col(text), F.col(stated), machine))
    return rated.where(F.col(name) >= least).select(*docs.columns)
