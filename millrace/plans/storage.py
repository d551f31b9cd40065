"""Source, sink and table-layout queries: write, change, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators.distribution import session_parts
from millrace.plans.registry import query
from millrace.session import work_dir
from millrace.sources import layout as ly
from millrace.sources import packing as pk
from millrace.sources import records as rc
from millrace.sources.tables import load, table_path


def _new(spark, label):
    """A table name nobody uses and a folder for it."""
    return f"{label}_{uuid.uuid4().hex[:12]}", work_dir(spark, label)


def _managed(spark, label):
    """A table whose files the catalog owns, in a database on the shared folder."""
    name, path = _new(spark, label)
    spark.sql(f"CREATE DATABASE db_{name} LOCATION '{path}'")
    return f"db_{name}.{name}"


def _orders(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query(
    "src_datagen",
    """SELECT o_orderkey, o_orderkey + 1 AS f_sequence, 1 AS in_range, CAST(10 AS BIGINT) AS text_length FROM orders""",
)
def src_datagen(spark, sf):
    """As many generated rows as orders, met with them by sequence number."""
    orders = load(spark, sf, "orders").select("o_orderkey")
    made = rc.generate(
        spark,
        orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(-1))).first()[0] + 1,
        {"f_sequence": ("sequence", 1), "f_random": ("int", 1, 1000), "f_random_str": ("text", 10)},
    )
    return orders.join(made, F.col("o_orderkey") + 1 == F.col("f_sequence")).select(
        "o_orderkey",
        "f_sequence",
        F.col("f_random").between(1, 1000).cast("int").alias("in_range"),
        F.length("f_random_str").cast("long").alias("text_length"),
    )


@query(
    "src_offset_range",
    "SELECT event_id, event_id // 4 AS log_offset FROM events WHERE event_id % 4 = 0 AND event_id // 4 >= 10",
)
def src_offset_range(spark, sf):
    """Events as a log of four partitions; partition 0 from offset 10 on."""
    log = load(spark, sf, "events").select(
        "event_id",
        (F.col("event_id") % 4).alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"),
    )
    return rc.offset_range(log, 0, 10).select("event_id", F.col("offset").alias("log_offset"))


@query(
    "sink_stamp",
    "SELECT event_id, (epoch_us(ts) // 1000) || ',' || event_type AS record FROM events",
)
def sink_stamp(spark, sf):
    return load(spark, sf, "events").select("event_id", rc.stamped(F.col("ts"), F.col("event_type")).alias("record"))


@query(
    "sink_keyed_records",
    """SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type FROM events""",
)
def sink_keyed_records(spark, sf):
    """Rows to keyed JSON records and back."""
    events = load(spark, sf, "events").select("user_id", "event_id", "event_type")
    records = rc.keyed_records(events, "user_id")
    fields = F.from_json("value", "event_id bigint, event_type string").alias("row")
    return records.select("key", fields).select("key", "row.event_id", "row.event_type")


@query("io_gzip_roundtrip", "SELECT o_orderkey || '|' || o_orderstatus AS line FROM orders")
def io_gzip_roundtrip(spark, sf):
    _, path = _new(spark, "gzip")
    rows = load(spark, sf, "orders").select(F.concat_ws("|", "o_orderkey", "o_orderstatus").alias("line"))
    rc.write_text(rows, path, "gzip")
    return rc.read_gzip_lines(spark, path, parts=session_parts(spark)).select(F.col("value").alias("line"))


@query("ddl_ctas", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def ddl_ctas(spark, sf):
    table, path = _new(spark, "ctas")
    finished = _orders(spark, sf).where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    ly.create_as(finished, table, path, comment="finished orders", layer="mart")
    return spark.table(table)


@query(
    "ddl_like",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0""",
)
def ddl_like(spark, sf):
    """A table made LIKE another starts empty and takes rows of its layout."""
    customers = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    table, path = _new(spark, "first")
    copy, copy_path = _new(spark, "second")
    ly.create_as(customers.where("c_acctbal <= 0"), table, path)
    ly.create_like(spark, copy, table, copy_path)
    customers.where("c_acctbal > 0").write.insertInto(copy)
    return spark.table(copy).drop("c_acctbal")


@query(
    "ddl_view",
    "SELECT o_custkey AS customer, count(*) AS order_count FROM orders GROUP BY o_custkey",
)
def ddl_view(spark, sf):
    load(spark, sf, "orders").createOrReplaceTempView("view_orders")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY VIEW orders_per_customer (customer COMMENT 'key', order_count) AS"
        " SELECT o_custkey, count(*) FROM view_orders GROUP BY o_custkey"
    )
    return spark.table("orders_per_customer")


@query("ins_dynamic_partition", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def ins_dynamic_partition(spark, sf):
    table, path = _new(spark, "dynamic")
    orders = _orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus")
    ly.write_partitioned(orders.where("o_orderstatus = 'F'"), table, path, ["o_orderstatus"])
    ly.insert_dynamic(orders.where("o_orderstatus <> 'F'"), table)
    return spark.table(table)


@query(
    "ins_overwrite_partition",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus
       FROM orders""",
)
def ins_overwrite_partition(spark, sf):
    table, path = _new(spark, "overwrite")
    orders = _orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus")
    ly.write_partitioned(orders, table, path, ["o_orderstatus"])
    dearer = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    ly.overwrite_partition(dearer, table, {"o_orderstatus": "F"})
    return spark.table(table)


@query(
    "ins_overwrite_touched",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END::DOUBLE AS o_totalprice, o_orderstatus
       FROM orders""",
)
def ins_overwrite_touched(spark, sf):
    """DataFrame form: only the partitions present in the new rows are replaced."""
    _, path = _new(spark, "touched")
    orders = _orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus")
    ly.compact(orders, "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    free = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    ly.overwrite_touched(free, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query(
    "ddl_bucketed_join",
    """SELECT o_orderkey, l_linenumber, o_orderstatus FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def ddl_bucketed_join(spark, sf):
    """Both tables bucketed by the order key: the join reads them without a shuffle."""
    orders_table, orders_path = _new(spark, "bucket_orders")
    lines_table, lines_path = _new(spark, "bucket_lines")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    # both tables need the same number, so the larger one decides
    buckets = ly.buckets_for(lines.count())
    ly.write_bucketed(orders, orders_table, orders_path, buckets, ["o_orderkey"])
    ly.write_bucketed(lines, lines_table, lines_path, buckets, ["o_orderkey"])
    return (
        spark.table(orders_table)
        .hint("merge")
        .join(spark.table(lines_table), "o_orderkey")
        .select("o_orderkey", "l_linenumber", "o_orderstatus")
    )


@query(
    "layout_skew_isolate",
    """SELECT event_id, event_type, CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE '__rest' END AS hot FROM events""",
)
def layout_skew_isolate(spark, sf):
    _, path = _new(spark, "skewed")
    events = load(spark, sf, "events").select("event_id", "event_type")
    marked = ly.isolate_skew(events, "event_type", ["view", "click"])
    ly.compact(marked, "hot").write.partitionBy("hot").parquet(path)
    return spark.read.parquet(path)


@query(
    "load_files",
    "SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer",
)
def load_files(spark, sf):
    """LOAD ... OVERWRITE, then the same file loaded once more."""
    table, path = _new(spark, "load")
    spark.sql(f"CREATE TABLE {table} (c_custkey BIGINT, c_name STRING) USING parquet LOCATION '{path}'")
    source = table_path(sf, "customer")
    ly.load_files(spark, source, table, overwrite=True)
    ly.load_files(spark, source, table)
    return spark.table(table)


@query("export_directory", "SELECT s_suppkey, s_name FROM supplier")
def export_directory(spark, sf):
    _, path = _new(spark, "export")
    ly.export(load(spark, sf, "supplier").select("s_suppkey", "s_name"), path)
    return spark.read.parquet(path)


@query("ddl_truncate_partition", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O'")
def ddl_truncate_partition(spark, sf):
    table = _managed(spark, "truncate")
    ly.write_partitioned(_orders(spark, sf).select("o_orderkey", "o_orderstatus"), table, None, ["o_orderstatus"])
    ly.truncate_partition(spark, table, {"o_orderstatus": "O"})
    return spark.table(table)


@query("ddl_repair", "SELECT o_orderkey, o_orderstatus FROM orders")
def ddl_repair(spark, sf):
    """Folders appear behind the catalog's back; one is added by hand, the rest are found."""
    table, path = _new(spark, "repair")
    spark.sql(
        f"CREATE TABLE {table} (o_orderkey BIGINT, o_orderstatus STRING) USING parquet"
        f" PARTITIONED BY (o_orderstatus) LOCATION '{path}'"
    )
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    ly.compact(orders, "o_orderstatus").write.mode("append").partitionBy("o_orderstatus").parquet(path)
    ly.add_partition(spark, table, {"o_orderstatus": "F"}, f"{path}/o_orderstatus=F")
    ly.repair(spark, table)
    return spark.table(table)


@query("compact_files", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def compact_files(spark, sf):
    """A table of many small files, packed into files of about the same measured size."""
    _, path = _new(spark, "small")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    orders.repartition(40, "o_orderkey").write.parquet(path)
    packed = work_dir(spark, "packed")
    total = pk.file_sizes(spark, path).agg(F.sum("bytes")).first()[0]
    pk.pack_files(spark, path, packed, target_bytes=max(total // 4, 1))
    return pk.read_packed(spark, packed).select("o_orderkey", "o_custkey", "o_totalprice")
