"""Languages of a text as a mixture, estimated by expectation-maximisation.

Each language has a model of letter triples, counted over all learnt texts. A document is a run of
segments of a few words, and each segment is said to come from one of the languages: the likelihoods
of its triples under every language are known, the proportions of the languages are not.
Expectation-maximisation finds them. The set of languages is chosen by penalised likelihood: a
language more must raise the log likelihood by more than a penalty that grows with the number of
segments. The prediction is the language with the largest proportion, its score that proportion.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemart.llm.common import slices

UNKNOWN = "und"
BUCKETS = 1 << 15
# Letters of a segment, about; steps of the estimation; the penalty of a language more, in units of log(segments + 1).
SEGMENT, STEPS, PENALTY = 40, 12, 3.0
# Weight of the triple counts' prior, in triples.
PRIOR = 0.5
# Letters: ASCII letters, and bytes beyond ASCII of letters; other bytes end a word.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def letters_only(text: str) -> str:
    """Lower-case letters with single spaces for all else."""
    if text.isascii():
        return text.lower()
    return "".join([c if c.isalpha() or c.isascii() else " " for c in text.lower()])


def triples(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all triples of the texts, and the text each belongs to; triples of no letter are left out."""
    raw = [f" {letters_only(t or '')} ".encode("utf-8", "replace").translate(FOLDED) for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    b = np.frombuffer(b"".join(raw), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    keep = (b != 32) | np.append(True, b[:-1] != 32)
    b, owner = b[keep].astype(np.uint32), owner[keep]
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    # Texts are parted by a space, so a triple around a letter lies in one text.
    inside = b[1:-1] != 32
    code = code[inside] * np.uint32(2654435761)
    return (code >> np.uint32(17)).astype(np.int64), owner[1:-1][inside]


@dataclass
class Model:
    """Languages by name, and the log likelihood of each bucket under each of them."""

    names: list[str]
    table: np.ndarray


def counts(docs: DataFrame, allowed: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all texts that may be learnt from and have a language; a task sends each pair once."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for frame in frames:
            for name, part in frame.groupby("lang", sort=False):
                texts = part["text"].tolist()
                into = total.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                for a, b in slices([len(t or "") for t in texts]):
                    into += np.bincount(triples(texts[a:b])[0], minlength=BUCKETS)
        for name, into in total.items():
            kept = np.flatnonzero(into)
            yield pd.DataFrame({"lang": name, "bucket": kept, "n": into[kept]})

    rows = docs.where(allowed & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, allowed: Column, text: str = "text", lang: str = "lang") -> Model:
    """Learn the languages from all allowed texts; the driver gets at most one count for each language and bucket."""
    rows = counts(docs, allowed, text, lang).toPandas()
    names = sorted(set(rows["lang"]))
    place = {name: k for k, name in enumerate(names)}
    table = np.zeros((BUCKETS, len(names)))
    table[rows["bucket"].to_numpy(np.int64), rows["lang"].map(place).to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    overall = (table.sum(1, keepdims=True) + 1) / (table.sum() + BUCKETS)
    smooth = PRIOR * BUCKETS
    return Model(names, np.log((table + smooth * overall) / (table.sum(0) + smooth)).astype(np.float32))


def estimate(likely: np.ndarray, owner: np.ndarray, starts: np.ndarray, active: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihoods of documents whose segments, in order, have the given log likelihoods.

    ``active`` tells for each document which languages may be in the mixture.
    """
    peak = likely.max(1, keepdims=True)
    scaled = np.exp(likely - peak)
    share = active / active.sum(1, keepdims=True)
    sizes = np.diff(np.append(starts, len(owner)))[:, None]
    for _ in range(steps):
        joint = scaled * share[owner]
        joint /= np.maximum(joint.sum(1, keepdims=True), 1e-300)
        share = np.add.reduceat(joint, starts) / sizes
    total = np.maximum((scaled * share[owner]).sum(1), 1e-300)
    return share, np.add.reduceat(np.log(total) + peak[:, 0], starts)


def mixtures(texts: list[str | None], model: Model) -> np.ndarray:
    """Proportions of the languages in each text; all zero where there is no letter."""
    out = np.zeros((len(texts), len(model.names)))
    bucket, owner = triples(texts)
    if not len(bucket) or not model.names:
        return out
    # Segments: so many triples of a text each, the rest of a text joins its last segment.
    some, first, sizes = np.unique(owner, return_index=True, return_counts=True)
    segments = np.maximum(sizes // SEGMENT, 1)
    of = np.repeat(np.arange(len(some)), segments)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(segments) - segments, segments)
    likely = np.add.reduceat(model.table[bucket], first[of] + nth * SEGMENT).astype(np.float64)
    starts = np.cumsum(segments) - segments
    languages = len(model.names)
    share, best = estimate(likely, of, starts, np.ones((len(some), languages)))
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    penalty = PENALTY * np.log(segments + 1)
    best = best - penalty * languages
    chosen = share
    for size in range(1, languages):
        with_, value = estimate(likely, of, starts, (rank < size).astype(np.float64))
        value = value - penalty * size
        better = value > best
        chosen = np.where(better[:, None], with_, chosen)
        best = np.where(better, value, best)
    out[some] = chosen
    return out


def predict(text: Column, model: Model) -> Column:
    """``struct<lang_pred:string,score:double,languages:array<string>>``: the main language, its share, and all chosen by share.

    Null texts and texts without a letter are ``und`` with score 0 and no languages, and so is every
    text if nothing was learnt.
    """

    @F.pandas_udf("lang_pred string, score double, languages array<string>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = model.names
        for texts in batches:
            rows = texts.tolist()
            parts = [mixtures(rows[a:b], model) for a, b in slices([len(t or "") for t in rows])]
            share = np.concatenate([np.zeros((0, len(names))), *parts])
            known = share.sum(1) > 0 if len(names) else np.zeros(len(rows), dtype=bool)
            main = share.argmax(1) if len(names) else None
            yield pd.DataFrame(
                {
                    "lang_pred": [names[main[k]] if known[k] else UNKNOWN for k in range(len(rows))],
                    "score": [float(min(share[k, main[k]], 1.0)) if known[k] else 0.0 for k in range(len(rows))],
                    "languages": [[names[j] for j in np.argsort(-share[k], kind="stable") if share[k, j] > 0.01] if known[k] else [] for k in range(len(rows))],
                }
            )

    return of(text)


def predicted(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score, languages) for every document row.

    Repeated rows give repeated rows, an empty table none; ids may be null, other columns play no part.
    """
    found = docs.select(F.col(doc_id).alias("doc_id"), predict(F.col(text), model).alias("found"))
    return found.select("doc_id", "found.lang_pred", "found.score", "found.languages")
