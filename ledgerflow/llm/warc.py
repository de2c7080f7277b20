"""WARC archives: writing, and reading back by boundary-chain verification.

Writing: one record a page; of equal payloads of at least ``MIN_REVISIT`` bytes
the page with the largest id keeps the payload, the others become ``revisit``
records that point to it.  Spark's text writer lays the records down, ending
each with the two line breaks that end a WARC record.

Reading: Spark's text reader cuts the archives at every ``WARC/1.0`` line in
parallel splits, also where a payload merely contains one.  Each piece is a
candidate record whose declared length names the offset of its successor.
Within a split the chain is followed at once to the first offset beyond it;
across splits pointer jumping (the exits squared in each round, so a file of
``n`` splits takes log2 n rounds) finds the offsets reachable from the start of
each file.  Only records on that chain are kept, and a candidate inside a
payload is handed back to the record that holds it.

Defined cases: null html is an empty payload; null url gives no target header;
line breaks in a url are percent-encoded; repeated rows are records of their
own (rows with the id of their group's response are all responses; a revisit means
the response of that id with its own digest); an empty table gives no rows; other columns are ignored.  A null page id is kept as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged
from ledgerflow.sources.scratch import scratch_path

# fixed values: the WARC 1.0 format
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

MIN_REVISIT = 1000
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def _name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _declared(head: Column, name: str) -> Column:
    """The value of a header, null where it is absent."""
    found = F.regexp_extract(head, rf"(?:^|\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT) -> None:
    """Write every row of ``pages`` (page_id, url, html) as a record under ``path``.

    Groups of equal payloads are found on narrow rows; only groups of two or
    more are joined back.  A hot group is split by the adaptive skew join.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"))
    keepers = (rows.filter(F.col("payload_bytes") >= min_revisit)
               .groupBy("payload_digest", "payload_bytes")
               .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    keepers = staged(keepers, "keepers")
    joined = rows.join(keepers, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    block = F.when(revisit, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("payload")))
    url = F.col("url")
    for raw, safe in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        url = F.replace(url, F.lit(raw), F.lit(safe))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _name(F.col("page_id"))),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Refers-To", F.when(revisit, _name(F.col("keeper")))),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block)
    joined.select(record.alias("value")).write.option("lineSep", END).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic line, with the byte offset that each
    piece has in its file (of its first byte after the magic).

    The reader's splits give rows in file order; lengths summed within a split
    and over the splits before it are the offsets, whatever the splits were.
    """
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.octet_length("value").cast("long").alias("nbytes"))
            .withColumn("turn", F.monotonically_increasing_id()))


def _with_offsets(rows: DataFrame) -> DataFrame:
    """``offset`` of every row; windows hold one split, or one row a split."""
    step = F.col("nbytes") + len(MAGIC)
    before = lambda *by: F.coalesce(F.sum(step).over(
        Window.partitionBy(*by).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = rows.groupBy("file", "block").agg(F.sum(step).alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return (rows.withColumn("local", before("file", "block")).join(splits, ["file", "block"])
            .withColumn("offset", F.col("base") + F.col("local")).drop("base", "local", "turn"))


def _parsed(rows: DataFrame) -> DataFrame:
    """Header fields of each candidate, and the payload where the piece is complete."""
    head = F.substring_index("value", END, 1)
    rows = rows.withColumn("head", head)
    need = F.octet_length("head") + len(END) + _declared(F.col("head"), "Content-Length").try_cast("long") + len(END)
    skip = F.char_length("head") + len(END) + len(HTTP_HEAD)
    payload = F.substr(F.col("value"), skip + 1, F.greatest(F.char_length("value") - skip - len(END), F.lit(0)))
    rows = rows.withColumn("need", need.cast("long")).withColumn(
        "payload", F.when(F.col("need") == F.col("nbytes"), payload))
    page = lambda name: F.regexp_extract(F.coalesce(_declared(F.col("head"), name), F.lit("")), r"<urn:page:(-?\d+)>", 1).try_cast("long")
    return rows.select(
        *[c for c in rows.columns if c not in ("value", "head", "payload")],
        page("WARC-Record-ID").alias("page_id"), _declared(F.col("head"), "WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        F.substring_index(_declared(F.col("head"), "WARC-Payload-Digest"), ":", -1).alias("declared"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1(F.col("payload").cast("binary")).alias("payload_digest"))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split, the first offset of its chain beyond the split."""
    pdf = pdf.sort_values("offset", ascending=False)
    out: dict[int, int] = {}
    for at, nxt in zip(pdf["offset"].tolist(), pdf["successor"].tolist()):
        out[at] = out.get(nxt, nxt)
    return pd.DataFrame({"file": pdf["file"], "block": pdf["block"], "offset": list(out), "exit": list(out.values())})


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split that a chain from one of its entries reaches."""
    pdf = pdf.sort_values("offset")
    alive = set(pdf.loc[pdf["entry"], "offset"].tolist())
    kept = []
    for at, nxt in zip(pdf["offset"].tolist(), pdf["successor"].tolist()):
        kept.append(at in alive)
        if kept[-1]:
            alive.add(nxt)
    return pdf[kept][["file", "offset"]]


def reachable(candidates: DataFrame) -> DataFrame:
    """``(file, block, offset, successor)`` -> the ``(file, offset)`` on the chain
    from offset 0 of each file, by pointer jumping over the exits of splits."""
    links = candidates.select("file", "block", "offset", "successor")
    exits = staged(links.groupBy("file", "block").applyInPandas(_exits, "file string, block long, offset long, exit long"), "exits")
    # only the start and offsets that some chain leaves for can be entries
    targets = exits.select("file", F.col("exit").alias("offset")).distinct()
    jump = exits.select("file", "offset", "exit").join(targets, ["file", "offset"], "left_semi").unionByName(
        exits.select("file", "offset", "exit").filter("offset = 0")).distinct()
    jump = staged(jump, "jump")
    entries = staged(jump.filter("offset = 0").select("file", "offset"), "entries")
    known = entries.count()
    while True:
        ahead = entries.join(jump, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        entries = staged(entries.unionByName(ahead).distinct(), "entries")
        grown = entries.count()
        if grown == known:
            break
        known = grown
        twice = jump.withColumnRenamed("exit", "via").join(
            jump.select("file", F.col("offset").alias("via"), F.col("exit").alias("exit2")), ["file", "via"], "left")
        jump = staged(twice.select("file", "offset", F.coalesce("exit2", "via").alias("exit")), "jump")
    marked = links.join(entries.withColumn("entry", F.lit(True)), ["file", "offset"], "left")
    marked = marked.withColumn("entry", F.coalesce("entry", F.lit(False)))
    return marked.groupBy("file", "block").applyInPandas(_follow, "file string, offset long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``page_id, payload_bytes, payload_digest, record_type, refers_to``:
    the records of all archives under ``path``, revisits resolved."""
    found = staged(_with_offsets(_parsed(pieces(spark, path)))
                   .withColumn("offset", F.col("offset") - len(MAGIC)), "pieces")
    candidates = found.filter(F.col("need").isNotNull() & (F.col("offset") >= 0)).withColumn(
        "successor", F.col("offset") + len(MAGIC) + F.col("need"))
    records = staged(candidates.join(reachable(candidates), ["file", "offset"], "left_semi"), "records")

    # payloads that hold a magic line: put their pieces together again
    cut = staged(records.filter(F.col("need") != F.col("nbytes")).select(
        F.col("file").alias("in_file"), F.col("offset").alias("start"), F.col("successor").alias("stop")), "cut")
    again = pieces(spark, path).join(cut.select(F.col("in_file").alias("file")).distinct(), "file", "left_semi")
    again = _with_offsets(again).withColumn("offset", F.col("offset") - len(MAGIC))
    inside = (F.col("file") == F.col("in_file")) & F.col("offset").between(F.col("start"), F.col("stop") - 1)
    parts = again.join(cut, inside).select("file", "start", "offset", "value")
    whole = parts.groupBy("file", "start").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))), lambda p: p["value"]), MAGIC).alias("value"))
    whole = _parsed(whole.withColumn("nbytes", F.octet_length("value").cast("long"))).select(
        "file", F.col("start").alias("offset"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    records = records.join(whole, ["file", "offset"], "left").select(
        "page_id", "record_type", "refers_to", "declared", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "_digest").alias("payload_digest"))

    # a revisit has the payload of the response it points to: that of its id and digest
    revisits = records.filter("record_type = 'revisit'").select(
        "page_id", "record_type", "refers_to", F.col("declared").alias("payload_digest"))
    responses = records.filter("record_type = 'response'")
    wanted = revisits.select(F.col("refers_to").alias("page_id"), "payload_digest").distinct()
    origin = (responses.join(wanted, ["page_id", "payload_digest"], "left_semi")
              .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(*columns).unionByName(revisits.join(origin, ["refers_to", "payload_digest"], "left").select(*columns))


def round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_revisit)
    return read_archives(spark, path)
