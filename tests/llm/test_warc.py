import gzip
import hashlib
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quotemart.llm import warc
from quotemart.llm.warc import Reader, Window, archived, member, read, record, records, write

PAGES = "page_id long, url string, html string"


def row(**given):
    base = {"record_type": "response", "record_id": "urn:uuid:1", "target_uri": "http://a/", "date": None, "refers_to": None,
            "payload_digest": hashlib.sha1(b"x").hexdigest(), "http_length": None, "headers": [("X-Page-Id", "1")], "payload": b"x"}
    return base | given


class Source(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def found(raw, wanted=lambda r: True, payload=True):
    return list(records(Window(Source(raw)), wanted, payload))


@pytest.mark.parametrize("pack", ["own", "plain", "gzip"])
def test_records_come_back_from_any_archive(pack):
    payloads = [b"x", b"", b"\r\n\r\n" * 900, bytes(range(256)) * 9000, b"last"]
    content = [record(row(record_id=f"urn:uuid:{k}", payload=p)) for k, p in enumerate(payloads)]
    raw = b"".join({"own": member, "plain": bytes, "gzip": gzip.compress}[pack](c) for c in content)
    got = found(raw)
    assert [r["payload"] for r in got] == payloads and [r["record_id"] for r in got] == [f"urn:uuid:{k}" for k in range(5)]
    assert [r["http_length"] for r in got] == [len(p) for p in payloads]
    got = found(raw, lambda r: r["record_id"] in ("urn:uuid:1", "urn:uuid:4"), payload=False)
    assert [(r["record_id"], r["payload"], r["http_length"]) for r in got] == [("urn:uuid:1", None, 0), ("urn:uuid:4", None, 4)]


def test_own_archives_are_gzip_files():
    content = [record(row(payload=b"a" * n)) for n in (0, 5, 70_000)]
    assert gzip.decompress(b"".join(map(member, content))) == b"".join(content)


def test_unwanted_payloads_are_not_inflated(monkeypatch):
    inflated = []
    more = warc.Inflater.more
    monkeypatch.setattr(warc.Inflater, "more", lambda self, least: inflated.append(least) or more(self, least))
    monkeypatch.setattr(warc.Inflater, "finish", lambda self: 1 / 0)
    raw = b"".join(member(record(row(record_id=f"urn:uuid:{k}", payload=bytes(500_000)))) for k in range(4))
    assert len(found(raw, lambda r: r["record_id"] == "urn:uuid:3")) == 1
    assert sorted(inflated)[-2] <= 4096 < sorted(inflated)[-1]


def test_odd_header_values_and_cut_archives():
    got = found(member(record(row(target_uri="http://a/\r\nWARC-Type: x", headers=[("X-Page-Id", None), ("X-B", "é")]))))
    assert got[0]["record_type"] == "response" and got[0]["target_uri"] == "http://a/%0D%0AWARC-Type: x" and dict(got[0]["headers"])["X-B"] == "é"
    whole = member(record(row(payload=b"q" * 5000)))
    assert found(b"") == [] and len(found(whole + whole[:30])) == 1


def test_predicates_are_taken_by_the_reader():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

    reader = Reader(None, {"path": "x"})
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), In(("target_uri",), ("a", "b")), StringContains(("target_uri",), "a"),
                                    IsNotNull(("refers_to",)), GreaterThan(("http_length",), 3), EqualTo(("headers", "x"), "y")]))
    assert [type(f).__name__ for f in left] == ["StringContains", "GreaterThan", "EqualTo"]
    ok = {"record_type": "revisit", "target_uri": "b", "refers_to": "r"}
    assert reader.wanted(ok) and not reader.wanted(ok | {"refers_to": None}) and not reader.wanted(ok | {"target_uri": "c"})


def test_files_are_planned_together(spark, folder):
    path = folder("warc")
    rows = spark.range(40).select(
        F.lit("response").alias("record_type"), F.concat(F.lit("urn:uuid:"), F.col("id").cast("string")).alias("record_id"), F.lit("u").alias("target_uri"),
        F.lit(None).cast("string").alias("date"), F.lit(None).cast("string").alias("refers_to"), F.lit(None).cast("string").alias("payload_digest"),
        F.lit(None).cast("long").alias("http_length"), F.create_map(F.lit("a"), F.lit("b")).alias("headers"),
        F.encode(F.repeat(F.col("id").cast("string"), 50), "utf-8").alias("payload"),
    )
    write(rows.repartition(5), path)
    assert len(Reader(None, {"path": path}).partitions()) == 1 and len(Reader(None, {"path": path, "partitionbytes": "1"}).partitions()) == 5
    assert len(Reader(None, {"path": folder("none")}).partitions()) == 1
    got = read(spark, path).where("record_id = 'urn:uuid:7'")
    assert [bytes(r.payload) for r in got.collect()] == [b"7" * 50]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "record_id" in plan
    assert read(spark, path, payload=False).where("target_uri = 'u' AND record_type IN ('response', 'x')").count() == 40
    write(rows.limit(0), path)
    assert read(spark, path).count() == 40


def test_pages_are_archived_once(spark):
    long, other = "é" * 600, "y" * 1000
    rows = [(k, f"http://a/{k}", long) for k in range(5)] + [(k, None, other) for k in (9, 7, 7)] + [(20, "u", "short"), (21, "u", "short"), (22, "u", "z" * 999)]
    rows += [(30, "u", None), (31, "u", ""), (None, "u", long), (None, None, "w" * 2000), (40, "a\nb", "v" * 300_000), (50, "u", "t" * 1000), (50, "u", "t" * 1000)]
    docs = spark.createDataFrame(rows, PAGES).withColumn("row", F.lit(1)).withColumn("PAYLOAD", F.lit("x"))
    got = archived(docs).collect()
    want, groups = [], Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        kept = max((q if q is not None else -1) for q, _, x in rows if (x or "") == (h or ""))
        kept = None if kept == -1 else kept
        revisit = len(raw) >= 1000 and (p != kept or groups[raw, p] > 0)
        groups[raw, p] += 1
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert archived(docs.limit(0)).collect() == []


def test_ids_of_any_text_come_back(spark):
    ids = [" a ", "a", "b\nc", "b%0Ac", "100%", "x+y z", "Ä: ü", "", "\t", "c\r\nX-Evil: 1"]
    rows = [(i, f"http://x/{k}", f"page {k % 3} " * 300) for k, i in enumerate(ids)] + [(None, None, "small")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string").repartition(4)
    got = {r.page_id: r for r in warc.archived(pages).collect()}
    assert set(got) == {*ids, None}
    best = {k: max(ids[k::3], key=lambda i: i.encode()) for k in range(3)}
    for k, i in enumerate(ids):
        keeps = best[k % 3]
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if i == keeps else ("revisit", keeps))


def test_rows_that_come_in_another_order_each_time_keep_one_payload(spark):
    pages = spark.range(40).select((F.col("id") % 2).alias("page_id"), F.lit("u").alias("url"), F.lit("same text " * 200).alias("html"))
    got = warc.archived(pages.orderBy(F.rand()).repartition(5)).groupBy("record_type").count().collect()
    assert sorted(tuple(r) for r in got) == [("response", 1), ("revisit", 39)]
