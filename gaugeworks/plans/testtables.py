"""The star schema as it is found in the test tables, and dirty rows made from them.

Facts are orders: the priority is the indicator, the customer's nation the place, the
total price the value. The tables are clean, so dirty rows are whole orders spoiled by
a rule on the order key; every order stays in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.schemas import SOURCE_COLUMNS

# Where a derived wide row comes from: order key and copy number.
WIDE_ORDER = ["_key", "_copy"]
ORIGIN = "_origin"


# Schemas of the test tables, so that no read has to look them up first.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def fact(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return placed.select(
        F.col("o_orderkey").alias("unique_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("indicator_id"),
        F.col("c_nationkey").alias("geo_join_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("time_period"),
        F.to_date("o_orderdate").alias("start_date"),
        F.col("o_totalprice").alias("data_value"),
        F.col("o_orderstatus").alias("message"),
    )


def geographic(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return named.select(
        F.col("n_nationkey").alias("geo_join_id"),
        F.col("r_name").alias("geo_type_name"),
        F.col("n_name").alias("geo_place_name"),
    )


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with their place name."""
    names = geographic(spark, folder).select("geo_join_id", "geo_place_name")
    return fact(spark, folder).join(names, "geo_join_id")


def wide_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Wide text rows, spoiled by rule, some repeated with another value."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    orders = orders.select("*", F.col("_metadata.file_name").alias(ORIGIN))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        geographic(spark, folder), F.col("c_nationkey") == F.col("geo_join_id")
    )
    spoiled = joined.selectExpr(
        "o_orderkey AS _key",
        ORIGIN,
        "string(o_orderkey) AS unique_id",
        "CASE WHEN o_orderkey % 29 = 0 THEN '12.0' ELSE substring(o_orderpriority, 1, 1) END AS indicator_id",
        "CASE WHEN o_orderkey % 22 = 0 THEN '   ' WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS name",
        "o_orderstatus AS measure",
        "c_mktsegment AS measure_info",
        "geo_type_name",
        "string(geo_join_id) AS geo_join_id",
        "geo_place_name",
        "date_format(o_orderdate, 'yyyy-MM') AS time_period",
        "CASE WHEN o_orderkey % 17 = 0 THEN '2020-02-30' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS start_date",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'abc' WHEN o_orderkey % 31 = 0 THEN ' ' ELSE string(o_totalprice) END"
        " AS data_value",
        "CASE WHEN o_orderstatus = 'P' THEN 'pending' END AS message",
    )
    # A tab and a space before, a no-break space and a space after.
    padded = [
        f"CASE WHEN _key % 19 = 0 THEN concat('\t ', {c}, '\u00a0 ') ELSE {c} END AS {c}" for c in SOURCE_COLUMNS
    ]
    rows = spoiled.selectExpr("_key", ORIGIN, *padded, "0 AS _copy")
    unchanged = [c for c in SOURCE_COLUMNS if c != "data_value"]
    copies = rows.filter("_key % 23 = 0").selectExpr("_key", ORIGIN, *unchanged, "'0' AS data_value", "1 AS _copy")
    return rows.unionByName(copies)


def date_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every order date as a text whose form depends on the order key."""
    patterns = [
        "yyyy-MM-dd",
        "yyyy/M/d",
        "M/d/yyyy",
        "yyyyMMdd",
        "MMM d, yyyy",
        "yyyy-MM-dd'T'23:30:00'Z'",
        "yyyy-MM",
        "yyyy",
        "'2020-02-30'",
        "'Winter' yyyy",
        "d/M/yyyy",
        "MM/dd/yyyy '12:00:00 AM'",
    ]
    chosen = F.lit(None).cast("string")
    for i, pattern in enumerate(patterns):
        form = F.date_format("o_orderdate", pattern)
        chosen = F.when(F.col("o_orderkey") % len(patterns) == i, form).otherwise(chosen)
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice", chosen.alias("date_text"))


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Each order as a run: started on the order date, ended with its last shipment.

    Lines are its records, returned lines the rejected ones; an order of one line and
    status ``P`` has not ended.
    """
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    empty = F.lit(None).cast("bigint")
    ended = lines.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("end"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("l_returnflag") == "R").alias("rejected"),
    )
    run_id, source = F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("source_file")
    started = orders.select(
        run_id,
        source,
        F.col("o_orderdate").alias("event_timestamp"),
        F.lit("STARTED").alias("status"),
        *[empty.alias(f"{c}_records") for c in ("total", "valid", "rejected", "inserted", "skipped")],
        F.lit(None).cast("string").alias("error_message"),
    )
    valid = F.col("total") - F.col("rejected")
    failed = valid == 0
    finished = orders.join(ended, F.col("o_orderkey") == F.col("l_orderkey")).filter(
        ~((F.col("total") == 1) & (F.col("o_orderstatus") == "P"))
    )
    return started.unionByName(
        finished.select(
            run_id,
            source,
            F.greatest("end", "o_orderdate").alias("event_timestamp"),
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.col("total").alias("total_records"),
            valid.alias("valid_records"),
            F.col("rejected").alias("rejected_records"),
            valid.alias("inserted_records"),
            F.lit(0).cast("bigint").alias("skipped_records"),
            F.when(failed, F.lit("no valid record")).alias("error_message"),
        )
    )
