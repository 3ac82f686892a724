import random

import numpy as np
from pyspark.sql import functions as F

from quotemart.llm import language
from quotemart.llm.language import estimate, mixtures, triples

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"aa": "the ing and tion er ou".split(), "bb": "sch ung keit ein ü ß".split(), "cc": "ción os ado ll ñ que".split()}


def say(lang, n, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def learnt(spark):
    rng = random.Random(1)
    rows = [(k, say(lang, 60, rng), lang, None, None) for k, lang in enumerate(list(SYLLABLES) * 20)]
    rows += [(100, None, "aa", None, None), (101, "never learnt", None, None, None), (102, "", "bb", None, None)]
    return language.train(spark.createDataFrame(rows, DOCS), F.lit(True))


def test_triples_equal_a_loop():
    texts = ["Ab, c1d", None, "", "Ünï—x", " a ", "1 2", "été été"]
    bucket, owner = triples(texts)
    want = []
    for k, text in enumerate(texts):
        raw = language.letters_only(text or "").encode().translate(language.FOLDED)
        for word in raw.split():
            padded = b" " + word + b" "
            want += [(((padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]) * 2654435761 & 0xFFFFFFFF) >> 17, k) for i in range(len(padded) - 2)]
    assert sorted(zip(bucket.tolist(), owner.tolist(), strict=True)) == sorted(want)


def test_estimate_equals_a_loop():
    rng = np.random.default_rng(0)
    likely = rng.normal(0, 3, (7, 3))
    share, value = estimate(likely, np.array([0] * 4 + [1] * 3), np.array([0, 4]), np.array([[1.0, 1, 1], [1, 0, 1]]), 30)
    for rows, active, got, total in ((likely[:4], [1, 1, 1], share[0], value[0]), (likely[4:], [1, 0, 1], share[1], value[1])):
        p = np.array(active) / sum(active)
        for _ in range(30):
            joint = np.exp(rows) * p
            p = (joint / joint.sum(1, keepdims=True)).mean(0)
        assert np.allclose(p, got) and np.isclose(np.log((np.exp(rows) * p).sum(1)).sum(), total)


def test_mixtures_have_the_languages_and_their_shares(spark):
    model, rng = learnt(spark), random.Random(2)
    one = mixtures([say(lang, 50, rng) for lang in SYLLABLES], model)
    assert (one.argmax(1) == [0, 1, 2]).all() and (one.max(1) == 1).all()
    two = mixtures([say("aa", 150, rng) + " " + say("cc", 50, rng)], model)[0]
    assert two[1] == 0 and abs(two[0] / two[2] - 3) < 1.5 and np.isclose(two.sum(), 1)


def test_predictions_of_odd_rows(spark):
    model, rng = learnt(spark), random.Random(3)
    rows = [(0, say("bb", 30, rng), "aa", None, None), (1, None, "aa", None, None), (2, "", None, None, None), (3, "12 !? 3", None, None, None),
            (None, say("cc", 3, rng), None, None, None), (5, say("aa", 30_000, rng), None, None, None), (6, "日本", None, None, None)]
    docs = spark.createDataFrame([*rows, rows[0]], DOCS).withColumn("score", F.lit("x"))
    got = sorted(((r.doc_id, r.lang_pred, list(r.languages), 0 < r.score <= 1) for r in language.predicted(docs, model).collect()), key=repr)
    assert [g for g in got if g[0] == 0] == [(0, "bb", ["bb"], True)] * 2
    assert [g[1:] for g in got if g[0] in (1, 2, 3)] == [("und", [], False)] * 3
    assert [g[1] for g in got if g[0] is None] == ["cc"] and [g[1] for g in got if g[0] == 5] == ["aa"] and [g[1] for g in got if g[0] == 6] != ["und"]
    none = language.train(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language.predicted(docs, none).collect()} == {"und"}
    assert language.predicted(docs.limit(0), model).collect() == []


def test_many_small_slices_change_nothing(spark, monkeypatch):
    model, rng = learnt(spark), random.Random(4)
    texts = [say(rng.choice(list(SYLLABLES)), rng.randint(0, 80), rng) for _ in range(40)]
    assert np.allclose(mixtures(texts, model), np.concatenate([mixtures([t], model) for t in texts]))


def test_any_number_of_languages_is_tried():
    # Seven languages with buckets of their own, a text with even shares of five of them.
    texts = [" ".join([f"{c}" * 60] * 12) for c in "abcdefg"]
    names = list("abcdefg")
    table = np.full((language.BUCKETS, 7), -12.0)
    for k, text in enumerate(texts):
        table[np.unique(triples([text])[0]), k] = -1.0
    # The other two say nearly as much of each, so that they keep a trace of a share in the set of all.
    table[:, 5:] = -1.5
    share = mixtures([" ".join(texts[:5])], language.Model(names, table.astype(np.float32)))[0]
    assert (share[:5] > 0.1).all() and (share[5:] == 0).all()
