import hashlib
import random
import re

from pyspark.sql import functions as F

from quotemart.llm import decontaminate

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, width=10):
    out = []
    for doc_id, text in docs:
        found, hit, ids = words(text), set(), set()
        for item_id, item in items:
            wanted = words(item)
            n = min(len(wanted), width)
            for s in range(len(wanted) - n + 1 if n else 0):
                for p in range(len(found) - n + 1):
                    if found[p : p + n] == wanted[s : s + n]:
                        hit |= set(range(p, p + n))
                        ids |= {str(item_id)} - {"None"}
        out.append((doc_id, len(found), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(5)
    vocabulary = ["the", "of", "a", "to", "Été", "été", "ÉTÉ", "x1", "2"] + [f"w{k}" for k in range(40)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(k, say(rng.choice([3, 9, 10, 11, 25, 60]))) for k in range(20)]
    items += [(50, "the"), (51, "of of"), (52, ""), (53, None), (54, "!!! ..."), (5, items[3][1]), (None, say(12)), (60, "lone " * 14)]
    items += [(61, " ".join(["a b"] * 12)), (62, items[7][1].upper())]
    docs = []
    for k in range(60):
        parts = [say(rng.randint(0, 80))]
        for _, text in rng.sample(items, 2):
            found = (text or "").split()
            cut = rng.randint(0, max(len(found) - 9, 0))
            parts += [" -- ".join(found[cut : cut + rng.randint(8, 30)]).title() if k % 3 else " ".join(found), say(rng.randint(0, 20))]
        docs.append((k, "\n".join(parts)))
    docs += [(100, None), (101, ""), (102, "?"), (103, "the"), (104, "THE the"), (None, items[0][1]), docs[3], docs[3], (105, "a b " * 9000)]
    return docs, items


def test_contamination_equals_brute_force(spark):
    docs, items = fixture()
    got = decontaminate.contamination(
        spark.createDataFrame([(a, b, None, None, 1) for a, b in docs], DOCS).withColumn("term", F.lit(1)),
        spark.createDataFrame(items, ITEMS).withColumn("word", F.lit("x")),
    )
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=repr) == brute(docs, items)


def test_large_tables_take_shuffled_joins(spark, monkeypatch):
    docs, items = fixture()
    monkeypatch.setattr(decontaminate, "SMALL", -1)
    got = decontaminate.contamination(spark.createDataFrame([(a, b, None, None, 1) for a, b in docs[:30]], DOCS), spark.createDataFrame(items, ITEMS))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=repr) == brute(docs[:30], items)


def test_other_width(spark):
    docs, items = fixture()
    got = decontaminate.contamination(
        spark.createDataFrame([(a, b, None, None, 1) for a, b in docs[:40]], DOCS), spark.createDataFrame(items, ITEMS), width=4
    )
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=repr) == brute(docs[:40], items, 4)


def test_proximity_finds_words_pushed_apart(spark):
    item = "alpha beta gamma delta epsilon"
    docs = [(0, f"x {item} y"), (1, "alpha beta um gamma delta epsilon"), (2, "alpha um um um beta gamma delta epsilon"), (3, "alpha beta")]
    found = {}
    for slop in (0, 1, 3):
        got = decontaminate.contamination(
            spark.createDataFrame([(a, b, None, None, 1) for a, b in docs], DOCS), spark.createDataFrame([(9, item)], ITEMS), slop=slop
        )
        found[slop] = sorted(r.doc_id for r in got.where("n_hit > 0").collect())
    assert found == {0: [0], 1: [0, 1], 3: [0, 1, 2]}


def test_drop_contaminated_keeps_the_rest_as_it_came(spark):
    docs, items = fixture()
    table = spark.createDataFrame([(a, b, "en", None, 1) for a, b in docs], DOCS).withColumn("row", F.lit("r")).withColumn("n_hit", F.lit(0))
    kept = decontaminate.drop_contaminated(table, spark.createDataFrame(items, ITEMS))
    assert kept.columns == table.columns
    clean = [d for d, _, n, _ in brute(docs, items) if not n]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr) and clean


def test_empty_tables(spark):
    docs, items = fixture()
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(a, b, None, None, 1) for a, b in docs[:4]], DOCS)
    assert decontaminate.contamination(none, spark.createDataFrame(items, ITEMS)).collect() == []
    got = decontaminate.contamination(some, spark.createDataFrame([], ITEMS)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in got) == [(a, len(words(b)), 0) for a, b in docs[:4]]


def test_query_digests(spark, tmp_path):
    from quotemart.llm.queries import QUERIES

    docs, items = fixture()
    spark.createDataFrame([(a, b, None, None, 1) for a, b in docs], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op3_benchmark_decontamination"](spark, str(tmp_path)).collect()
    want = [(d, w, n, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), n > 0) for d, w, n, i in brute(docs, items)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
