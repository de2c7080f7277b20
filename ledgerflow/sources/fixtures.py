"""Dirty inputs derived from the driver tables (see FIXTURES.md section C).

The reference ships no raw CSVs, so its dirty customer / payment inputs are
re-created from ``customer`` and ``orders`` with integer rules on the keys.
All rules are narrow projections (plus one ``unionByName``), so the fixtures
scale with the tables and add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.columns import epoch_seconds

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table ``name`` from ``sf_dir`` (one Parquet file per table)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def dirty_customer(customer: DataFrame) -> DataFrame:
    """FIXTURES C1: customer rows as a dirty CSV would give them after
    ``inferSchema`` (fea_2 is text because of bad cells).  Every 10th key is
    present twice (``copy`` 0 and 1; the copy differs in ``fea_5``)."""
    base = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    rows = base.withColumn("copy", F.lit(0)).unionByName(
        base.filter(F.col("c_custkey") % 10 == 0).withColumn("copy", F.lit(1)))
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    return rows.select(
        (k % 5 == 0).cast("int").alias("label"),
        k.alias("id"),
        F.col("c_nationkey").cast("int").alias("fea_1"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when(k % 11 == 0, F.lit("bad"))
         .otherwise(bal.cast("string")).alias("fea_2"),
        _null_when(k % 19 == 0, (k % 3 + 1).cast("double")).alias("fea_3"),
        (bal * 150).alias("fea_4"),
        (k % 7 + F.col("copy")).cast("int").alias("fea_5"),
        (F.col("c_nationkey") % 5).cast("int").alias("fea_6"),
        F.when(k % 17 == 0, F.lit(-1)).otherwise(k % 10 + 1).cast("int").alias("fea_7"),
        F.when(k % 23 == 0, F.lit(-1)).otherwise(k % 52 + 64).cast("int").alias("fea_8"),
        F.length("c_mktsegment").cast("int").alias("fea_9"),
        _null_when(k % 20 == 3, bal / 100).alias("fea_10"),
        _null_when(k % 13 == 0, bal).alias("fea_11"),
        F.col("copy").cast("int").alias("copy"),
    )


def dirty_payment(orders: DataFrame) -> DataFrame:
    """FIXTURES C2: one payment row per order, keyed by the customer, so ids
    repeat naturally; ``ord`` (the order key) is the deterministic tie-break."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    day = F.col("o_orderdate")
    balance = F.when(k % 37 == 0, (price - 50000) * 10).otherwise(price - 50000)
    return orders.select(
        F.col("o_custkey").alias("id"),
        k.alias("ord"),
        (k % 4).cast("int").alias("OVD_t1"),
        _null_when(k % 29 == 0, k % 3).cast("int").alias("OVD_t2"),
        (k % 2).cast("int").alias("OVD_t3"),
        (k % 4 + k % 3 + k % 2).cast("int").alias("OVD_sum"),
        (k % 12).cast("int").alias("pay_normal"),
        (k % 25 + 1).cast("int").alias("prod_code"),
        F.when(k % 11 == 0, F.lit("n/a")).otherwise(price.cast("string")).alias("prod_limit"),
        F.when(k % 13 == 0, F.date_format(day, "yyyy-MM-dd"))
         .otherwise(F.date_format(day, "dd/MM/yyyy")).alias("update_date"),
        balance.cast("string").alias("new_balance"),
        _null_when(k % 9 == 0, price.cast("string")).alias("highest_balance"),
        _null_when(k % 31 == 0, F.date_format(F.date_add(F.to_date(day), 7), "dd/MM/yyyy")).alias("report_date"),
    )


def run_docs(events: DataFrame) -> DataFrame:
    """FIXTURES C3: one JSON run document per event, ``(path, doc_seq, value)``.

    * ``event_id % 4 == 0``: an object document of the ingest/transform shape
      (``records`` is a string instead of an object when ``% 12 == 0``);
    * otherwise a list of verify results: the first item always, a load
      result second when ``% 4 == 3``, a bare number second when
      ``% 4 == 2`` and ``% 7 == 0`` (a non-object item);
    * every 50th document is cut short (malformed JSON).
    """
    k = F.col("event_id")
    etype = F.col("event_type")
    start = epoch_seconds("ts")
    path = F.concat(F.lit("metadata/"), etype, F.lit("/"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".json"))

    head = F.to_json(F.struct(
        F.when(k % 8 == 0, F.lit("ingest")).otherwise(F.lit("transform")).alias("step"),
        start.alias("start_time"),
        (start + F.col("value")).alias("end_time"),
        F.col("value").alias("duration_sec"),
    ))
    records = F.when(k % 12 == 0, F.lit('"n/a"')).otherwise(
        F.to_json(F.struct(F.col("user_id").alias("customer"), k.alias("payment"))))
    obj_doc = F.concat(F.expr("substr(_head, 1, length(_head) - 1)"), F.lit(',"records":'), records, F.lit("}"))

    failed = etype == "error"
    item_path = (F.when(k % 3 == 0, F.lit(""))
                  .when(k % 5 == 0, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("out/"), etype, F.lit("/"), k.cast("string"))))
    verify_item = F.to_json(F.struct(
        etype.alias("format"),
        item_path.alias("path"),
        (etype == "purchase").alias("is_table"),
        F.when(failed, F.lit("failed")).when(k % 9 == 1, F.lit("warning")).otherwise(F.lit("success")).alias("status"),
        _null_when(failed, F.col("user_id") * 5).alias("row_count"),
        F.when(failed, F.concat(F.lit("boom "), k.cast("string"))).alias("error"),
        (F.col("value") * 10).alias("duration_sec"),
    ))
    load_item = F.to_json(F.struct(
        F.lit("load").alias("step"),
        F.lit("payment_clean").alias("table"),
        F.concat(F.lit("warehouse/"), k.cast("string")).alias("path"),
        F.lit("success").alias("status"),
        k.alias("row_count"),
        F.col("value").alias("duration_sec"),
    ))
    second = (F.when(k % 4 == 3, F.concat(F.lit(","), load_item))
               .when((k % 4 == 2) & (k % 7 == 0), F.lit(",42"))
               .otherwise(F.lit("")))
    list_doc = F.concat(F.lit("["), verify_item, second, F.lit("]"))
    doc = F.when(k % 4 == 0, F.col("_obj")).otherwise(list_doc)
    return (events
            .withColumn("_head", head)
            .withColumn("_obj", obj_doc)
            .select(path.alias("path"), k.alias("doc_seq"),
                    F.when(k % 50 == 0, F.substring(doc, 1, 20)).otherwise(doc).alias("value")))


def scored(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """FIXTURES C4: ``labels`` join ``documents`` -> (doc_id, label, score, prediction);
    every 29th id is predicted to be of a class that no label has."""
    docs = documents.select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").cast("int").alias("label"),
        (F.col("n_chars") / F.lit(20000.0)).alias("score"),
        F.when(F.col("doc_id") % 29 == 0, F.lit(2))
         .otherwise(((F.col("n_chars") / F.lit(20000.0)) >= F.lit(0.05)).cast("int")).alias("prediction"),
    )


def embedding_matrix(embeddings: DataFrame, dims: int = 64) -> DataFrame:
    """FIXTURES C5b: binary label (``label = 0`` is the minority) and the
    first ``dims`` embedding components as double columns ``x0..``."""
    return embeddings.select(
        F.col("vec_id").alias("id"),
        (F.col("label") == 0).cast("int").alias("label"),
        *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(dims)],
    )


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def zero_byte_file(spark: SparkSession, path: str) -> None:
    """A file that holds nothing at all."""
    file, system = _file_system(spark, path)
    system.create(file).close()


def cut_short(spark: SparkSession, folder: str, suffix: str = ".gz") -> None:
    """Every file of ``folder`` with the suffix loses its second half, as a broken copy would."""
    place, system = _file_system(spark, folder)
    for status in system.listStatus(place):
        if status.getPath().getName().endswith(suffix):
            source = system.open(status.getPath())
            held = source.readNBytes(int(status.getLen() // 2))
            source.close()
            out = system.create(status.getPath(), True)
            out.write(held)
            out.close()
