import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quotemart.llm import merkle, sql
from quotemart.llm.queries import op12_merkle_manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grown(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    steps = []
    for level in levels[:-1]:
        a = i - i % 3
        steps.append(("".join(level[a:i]), "".join(level[i + 1 : a + 3])))
        i //= 3
    return steps


def brute(rows):
    by = {}
    for row in rows:
        bare = dict(row)
        crc = zlib.crc32(("" if row["doc_id"] is None else str(row["doc_id"])).encode())
        if bare["text"] is not None and crc % 2 == 0:
            bare["text"] = bare["text"].replace("\n", "")
        leaf, other = (h(*(framed(r[c]) for c in FIELDS)) for r in (row, bare))
        by.setdefault(row["source"], []).append((row["doc_id"], leaf, other))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for held in by.values():
        held.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: grown([leaf for _, leaf, _ in by[s]]) for s in names}
    top = grown([trees[s][-1][0] for s in names]) if names else []
    out = []
    for k, s in enumerate(names):
        for i, (doc, leaf, other) in enumerate(by[s]):
            steps, back = path(trees[s], i) + path(top, k), other
            for before, after in steps:
                back = h(before, back, after)
            root = top[-1][0]
            out.append((doc, leaf, trees[s][-1][0], root, h(*(b + a for b, a in steps)), back, back == root))
    return out


def given(sizes=(1, 2, 3, 4, 9, 10, 28, 100)):
    rng = random.Random(4)
    names = [None, "", "a", "b", "ä", "Z", "zz", "\U0001f600"]
    rows, i = [], 0
    for name, size in zip(names, sizes, strict=False):
        for _ in range(size):
            i += 1
            text = rng.choice([None, "", "one\ntwo", "Äpfel\n\n" * 3, "plain", "x" * 50_000])
            rows.append((i * 37 % 1009, text, rng.choice([None, "en"]), name, rng.choice([None, 3])))
    return rows + [rows[7], rows[7], (None, "no id\n", None, "b", None)]


def saved(spark, folder, rows, schema=DOCS):
    where = folder("tables")
    spark.createDataFrame(rows, schema).withColumn("tree", F.lit(1)).withColumn("RANK", F.lit("x")).write.parquet(f"{where}/documents.parquet")
    return where


def as_dicts(rows):
    return [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r, strict=True)) for r in rows]


def test_query_equals_brute_force_and_sql(spark, folder):
    rows = given()
    where = saved(spark, folder, rows)
    got = sorted((tuple(r) for r in op12_merkle_manifest(spark, where).collect()), key=repr)
    assert got == sorted(brute(as_dicts(rows)), key=repr)
    assert {r[-1] for r in got} == {True, False}
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{where}/documents.parquet/*.parquet'")
    assert sorted((tuple(r) for r in duck.sql(sql.MANIFEST).fetchall()), key=repr) == got


@pytest.mark.parametrize("rows", [[], [(5, "a\nb", None, None, 1)], [(5, "a", None, "s", 1)] * 7], ids=["none", "one", "alike"])
def test_few_rows(spark, folder, rows):
    got = sorted((tuple(r) for r in op12_merkle_manifest(spark, saved(spark, folder, rows)).collect()), key=repr)
    assert got == sorted(brute(as_dicts(rows)), key=repr)


def test_leaves_asked_for_are_those_proven(spark):
    held = merkle.manifest(spark.createDataFrame(given(), DOCS))
    wanted = held.leaves.where("rank % 5 = 2").select("tree", "rank")
    some = {(r.tree, r.rank): r for r in merkle.proofs(held, wanted).collect()}
    every = {(r.tree, r.rank): r for r in merkle.proofs(held).collect()}
    assert set(some) == {tuple(r) for r in wanted.collect()} and len(every) == held.leaves.count()
    assert all(every[k] == r for k, r in some.items())
    leaves = {(r.tree, r.rank): r.leaf for r in held.leaves.collect()}
    assert all(leaves[k] == r.digest for k, r in every.items())


def test_equal_subtrees_share_records(spark):
    held = merkle.manifest(spark.createDataFrame([(5, "a", None, "s", 1)] * 27, DOCS))
    assert [level.select("digest").distinct().count() for level in held.sources.levels] == [1, 1, 1]


def test_ranks_count_over_parts(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        where = folder("rows")
        table = spark.range(500).select(F.when(F.col("id") % 3 > 0, "big").otherwise(F.col("id").cast("string")).alias("tree"), (F.col("id") * 7 % 500).alias("k"), "id")
        table.write.parquet(where)
        got = merkle.ranked(spark.read.parquet(where), "tree", ["k", "id"], "test").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by = {}
    for r in sorted(got, key=lambda r: (r.tree, r.k, r.id)):
        by.setdefault(r.tree, []).append(r)
    assert all(r.rank == i and r.n == len(rs) for rs in by.values() for i, r in enumerate(rs)) and len(by["big"]) == 333
