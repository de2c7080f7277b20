import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerflow.llm import warc


def brute(rows, least=1000):
    """Rows of (page_id, url, html) -> the expected result."""
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        ids = [x for x in groups[p] if x is not None]
        keeper = max(ids) if len(p) >= least and len(groups[p]) > 1 and ids else i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if keeper == i else "revisit", None if keeper == i else keeper))
    return Counter(out)


def result(df):
    return Counter(tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
SCHEMA = "page_id long, url string, html string"


def hard_pages():
    rows = [(i, f"http://a/{i}", f"<p>page {i} äöü €</p>\r\n\r\n" * (1 + i % 40)) for i in range(120)]
    rows += [(200 + i, None, "same" * 400) for i in range(60)] + [(400 + i, "u\r\nWARC-Type: x", "small") for i in range(5)]
    rows += [(500, "", None), (501, None, ""), (None, "x", "nobody"), (7, "again", rows[7][2])]
    rows += [(600, "m", "WARC/1.0\r\n"), (601, "m", "a" + FAKE * 3 + "WARC/1.0\r\n\r\nb"), (602, "m", FAKE), (603, "m", FAKE[:-4] + "x" * 1200)]
    rows += [(604, "m", FAKE[:-4] + "x" * 1200), (605, "m", "WARC/1.0\r\nContent-Length: 99999999999999999999\r\n\r\n"), (606, "m", "\r\n\r\n" * 9)]
    return rows


def test_round_trip_with_magic_in_payloads(spark):
    rows = hard_pages()
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(warc.round_trip(df.repartition(3))) == brute(rows)


def test_records_cross_read_splits(spark):
    rows = hard_pages() + [(700 + i, "long", (FAKE + "y" * 300) * 40) for i in range(8)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert result(warc.round_trip(spark.createDataFrame(rows, SCHEMA).coalesce(2))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_and_clashing_columns(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "u", "h"), (2, None, None)], SCHEMA).withColumn("payload", F.lit(1)).withColumn("file", F.lit("f"))
    assert result(warc.round_trip(df)) == brute([(1, "u", "h"), (2, None, None)])


def test_one_page_id_with_different_payloads(spark):
    a, b, c = "a" * 1500, "b" * 2500, "c" * 1200
    rows = [(1, "u", a), (2, "u", a), (2, "u", b), (3, "u", c), (2, "u", c), (1, "u", c)]
    got = result(warc.round_trip(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows)
    assert (1, 1500, hashlib.sha1(a.encode()).hexdigest(), "revisit", 2) in got
