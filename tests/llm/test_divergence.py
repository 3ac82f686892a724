import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemart.llm import divergence, sql

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, ranks=200):
    counts, docs, groups = {}, {}, set()
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        groups.add((lang, source))
        found = WORD.findall((r[1] or "").translate(LOWER))
        for w in found:
            counts[lang, source, w] = counts.get((lang, source, w), 0) + 1
        for w in set(found):
            docs[lang, w] = docs.get((lang, w), 0) + 1
    out = []
    for lang, source in groups:
        kept = [w for (x, w), n in docs.items() if x == lang and n >= 3]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(names):
            c = {w: sum(counts.get((lang, s, w), 0) for s in names) for w in kept}
            total = sum(c.values()) + len(kept)
            return {w: 1 + 10**9 * (n + 1) // total for w, n in c.items()}

        p, q = shares([source]), shares(sources)
        pairs = []
        for other in sources:
            if other != source:
                o = shares([other])
                pairs.append((sum((p[w] - o[w]) ** 2 // o[w] for w in kept), other))
        terms = [((p[w] - q[w]) ** 2 // q[w], w) for w in kept if counts.get((lang, source, w), 0) > 0 and p[w] > q[w]]
        for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])]
    return sorted(out)


def given():
    rng = random.Random(9)
    vocabulary = [f"wort{chr(97 + k % 26)}{'x' * (k // 26)}" for k in range(150)] + ["ÄRGER", "Niño", "don't", "a-b", "naïve", "日本", " z"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = []
    for k in range(200):
        source = rng.choice([None, "", "s1", "s2", "s3", "ü"]) if k % 3 else "hot"
        text = " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 80)))
        rows.append((k, rng.choice([text, text.upper()]), rng.choice([None, "en", "de"]), source, None))
    rows += [(300, None, "en", "silent", None), (301, "once only", "fr", "a", None), (302, "12 34 !!", "fr", "b", None), (303, "q" * 200_000 + " tail", "en", "s1", None)]
    return rows + [rows[1], rows[1], rows[1], (400, "one", "single", "x", None), (401, "one", "single", "x", None), (402, "one one", "single", "x", None)]


def test_rows_equal_brute_force_and_sql(spark):
    rows = given()
    docs = spark.createDataFrame(rows, DOCS).withColumn("term", F.lit(1)).withColumn("NUMBER", F.lit("x")).repartition(5)
    got = divergence.audited(docs)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    found = sorted(tuple(r) for r in got.collect())
    assert found == brute(rows)
    assert any(r[:3] == ("fr", "b", "pair") and r[4] == 0 for r in found)
    duck = duckdb.connect()
    duck.register("documents", spark.createDataFrame(rows, DOCS).toPandas())
    assert sorted(tuple(r) for r in duck.sql(sql.DIVERGENCE).fetchall()) == found


def test_ranks_end_where_asked(spark):
    rows = given()
    found = sorted(tuple(r) for r in divergence.audited(spark.createDataFrame(rows, DOCS), 5).collect())
    assert found == brute(rows, 5)


@pytest.mark.parametrize("rows,width,panel", [(1, 3, 1024), (50, 6, 4), (300, 2, 7)])
def test_products_are_the_joint_tables(monkeypatch, rows, width, panel):
    monkeypatch.setattr(divergence, "PANEL", panel)
    counts = np.random.default_rng(rows).poisson(1.5, (rows, width)).astype(np.int64)
    want = {}
    for row in counts.tolist():
        for g in range(width):
            for o in range(g + 1, width):
                want[g, row[g], o, row[o]] = want.get((g, row[g], o, row[o]), 0) + 1
    got = {tuple(r[:4]): r[4] for r in divergence.product(counts).itertuples(index=False)}
    assert got == want


def test_tables_of_blocks_add_up(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 40)
    rows = given()
    assert sorted(tuple(r) for r in divergence.audited(spark.createDataFrame(rows, DOCS)).collect()) == brute(rows)


def test_shares_of_counts_beyond_a_long(spark):
    n = 12_345_678_901_234
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(10 * n), F.lit(7)).alias("p"), divergence.share(F.lit(0), F.lit(5), F.lit(3)).alias("q")).first()
    assert row.p == 1 + 10**9 * (n + 1) // (10 * n + 7) and row.q == 1 + 10**9 // 8


def test_empty_table(spark):
    assert divergence.audited(spark.createDataFrame([], DOCS)).collect() == []
