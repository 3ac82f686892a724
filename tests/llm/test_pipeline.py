import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_decontaminate import brute as hits
from test_simhash import brute_classes, brute_print

import corpus_pipeline
from quotemart.llm.pieces import Vocabulary, decode_ids

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    syllables = ["the", "re", "an", "ing", "ti", "on", "ble", "ea", "sh", "ou", "er"]
    say = lambda n: " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))
    items = [(k, say(25)) for k in range(5)]
    rows, labels = [], []
    for k in range(400):
        kind = ["plain", "toxic", "junk", "copy", "leak"][k % 5]
        text = say(rng.randint(30, 70))
        if kind == "toxic":
            words = text.split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "worthless", "scum"] + ["1diot"] * (k % 2)))
            text = " ".join(words)
        if kind == "junk":
            text = " ".join(w.upper() + "!!" for w in text.split())
        if kind == "copy":
            text = rows[k - 3][1].lower() if k % 2 else rows[rng.randrange(0, k // 5) * 5][1]
        if kind == "leak":
            text += " " + " ".join(items[k % 4][1].split()[3:18]) + " " + say(5)
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        if k % 2 or kind != "copy":
            labels.append((k, int(kind != "junk"), int(kind == "toxic" or (kind == "copy" and "idiot" in text))))
    rows += [(None, None, None, None, None), (900, "", None, None, None), (901, "x" * 40_000, None, None, None), rows[0]]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_each_stage_works_on_what_is_left(spark, tables, folder):
    path, rows, items = tables
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != "encoding":
            assert out.columns == docs.columns
        target = folder(name)
        out.write.parquet(target)
        docs = spark.read.schema(out.schema).parquet(target)
        kept[name] = [tuple(r) for r in docs.collect()]
    ids = {name: {r[0] for r in found} for name, found in kept.items()}
    toxic = {k for k in range(400) if k % 5 == 1}
    plain = {k for k in range(400) if k % 5 == 0}
    assert len(ids["toxicity"] & toxic) <= 4 and plain <= ids["toxicity"] and {None, 900, 901} <= ids["toxicity"]
    assert len([k for k in ids["quality"] if k is not None and k < 400 and k % 5 == 2]) <= 4 and len(plain - ids["quality"]) <= 2
    before = [(r[0], brute_print(r[1])) for r in kept["quality"]]
    assert sorted(map(str, ids["near_copies"])) == sorted({str(c) for c in brute_classes(before)}) and len(kept["near_copies"]) == len(set(brute_classes(before)))
    clean = {d for d, _, n, _ in hits([(r[0], r[1]) for r in kept["near_copies"]], items) if not n}
    assert ids["decontamination"] == clean and not {k for k in clean if k is not None and k < 400 and k % 5 == 4}
    vocabulary, texts = Vocabulary.load(), {r[0]: r[1] for r in kept["decontamination"]}
    assert ids["encoding"] == clean
    for doc_id, found, n, lossless in kept["encoding"]:
        assert lossless and n == len(found or []) and (found is None) == (texts[doc_id] is None)
        assert found is None or decode_ids(np.array(found, dtype=np.int64), vocabulary.pieces, vocabulary.prefix) == texts[doc_id]


def test_run_gives_the_last_stage(spark, tables):
    path, rows, _ = tables
    got = corpus_pipeline.run(spark, path)
    assert got.columns == ["doc_id", "ids", "n_tokens", "lossless"]
    assert 50 < got.count() < len(rows) and got.where(~F.col("lossless")).count() == 0


def test_empty_tables_run(spark, folder):
    path = folder("none")
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []
