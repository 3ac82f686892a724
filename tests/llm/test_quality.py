import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemart.llm import quality
from quotemart.llm.common import fold
from quotemart.llm.quality import Machine, features, fit

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=300, seed=4):
    rng = random.Random(seed)
    syllables = ["the", "re", "an", "ing", "ti", "on", "ble", "ea", "sh", "ou"]
    say = lambda k: ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(k)]
    out = []
    for k in range(n):
        words = say(rng.randint(20, 60))
        if k % 3 == 0:
            words = [[w.upper() + "!!" for w in words], [w + "$$$" for w in words], [w for w in words[:6] for _ in range(9)]][k // 3 % 3]
        out.append((k, " ".join(words).capitalize() + ".", int(k % 3 != 0)))
    return out


def test_pairs_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(0)
    machine = Machine(0.3, rng.normal(size=30), rng.normal(size=(30, 4)), 30)
    for size in (1, 2, 7):
        index, value = rng.integers(0, 30, size), rng.normal(size=size)
        want = 0.3 + (machine.weights[index] * value).sum()
        for i in range(size):
            for j in range(i):
                want += machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j]
        assert machine.raw(index, value, np.zeros(1, dtype=np.int64))[0][0] == pytest.approx(want)


def test_features_are_bounded_and_the_same_for_null_and_empty():
    for text in ("", None, "a", "| | |", "X" * 100_000, "日本 été\n\n", "1 1 1 1", "__ --"):
        index, value = features(text, None)
        assert len(index) == len(value) and (index >= 0).all() and np.isfinite(value).all()
        assert index.max() < quality.BUCKETS + len(quality.STATISTICS) * quality.RANGES
    assert all((a == b).all() for a, b in zip(features("", 5), features(None, 5), strict=True))
    assert not (features("a b", 3)[0] == features("a b", 3_000_000)[0]).all()


def test_a_machine_learns_interactions():
    rng = np.random.default_rng(1)
    texts = [f"{'x' if a else 'y'} {'p' if b else 'q'}" for a, b in rng.integers(0, 2, (600, 2))]
    labels = np.array([float(("x" in t) != ("p" in t)) for t in texts])
    machine = fit(texts, [None] * 600, labels, buckets=1 << 10, epochs=60)
    assert ((machine.score(texts, [None] * 600) >= 0.5) == labels).mean() > 0.95
    only = fit(texts, [None] * 600, np.ones(600))
    assert (only.score(texts[:3], [None] * 3) > 0.9).all() and fit([], [], np.zeros(0)).score([""], [None])[0] == 0.5


def test_held_out_documents_are_told_apart(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, None, "s", len(t)) for k, t, _ in rows], DOCS).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(k, y, 0) for k, _, y in rows] + [(None, 1, 1), (3, None, 1)], LABELS)
    machine = quality.train(docs, labels, fold(F.col("doc_id"), 3) != 1)
    scores = {r.doc_id: r.score for r in quality.scored(docs, machine).collect()}
    held = [(scores[k] >= 0.5) == y for k, _, y in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sum(held) >= 0.95 * len(held) and len(held) > 60
    kept = quality.keep_good(docs, machine)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, s in scores.items() if s >= 0.5}


def test_the_sample_is_bounded_and_takes_one_row_of_an_id(spark):
    rows = [(k % 40, f"t{k}", None, None, k) for k in range(200)] + [(None, "n", None, None, None)] * 50
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)] * 3, LABELS)
    got = quality.sample(docs, labels, "quality", 15, F.lit(True), ["text", "n_chars"])
    assert got.count() == 15 and got.columns == ["text", "n_chars", "label"]


def test_odd_rows_and_empty_tables(spark):
    odd = [(None, None, None, None, None), (1, "", None, None, -5), (1, "", None, None, -5), (2, "!" * 50_000, None, None, 2**62), (3, "a " * 60_000, None, None, 0)]
    docs, labels = spark.createDataFrame(odd, DOCS), spark.createDataFrame([], LABELS)
    machine = quality.train(docs, labels, F.lit(True))
    got = quality.scored(docs, machine).collect()
    assert len(got) == 5 and all(r.score == 0.5 for r in got)
    assert quality.scored(docs.limit(0), machine).collect() == []
