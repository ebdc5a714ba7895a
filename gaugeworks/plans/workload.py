"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.calendar import add_season, season_name, split_date
from gaugeworks.functions.parse import parse_date, parse_number
from gaugeworks.functions.text import clean_columns, null_tokens
from gaugeworks.operators import audit, dedupe, distribution, features, joins, load, mapping, profiles, quantiles, rejects, stats
from gaugeworks.operators.runs import latest_runs
from gaugeworks.operators.validate import REASON, rejected_rows, tag_records, valid_rows
from gaugeworks.plans import testtables as data
from gaugeworks.plans.ingest import run_ingest
from gaugeworks.plans.profiled import run_profiled, update_profiles
from gaugeworks.schemas import FILE_NAME, SOURCE_COLUMNS
from gaugeworks.session import scratch_path, settle
from gaugeworks.sources.files import normalize_headers, read_source, write_csv
from gaugeworks.sources.keyindex import KeyIndex, rebuild
from gaugeworks.sources.spec import SourceSpec
from gaugeworks.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The indicator the single-indicator queries look at: orders of the first priority.
URGENT = 1
PLACE, VALUE = "geo_place_name", "data_value"


def query(function: Query) -> Query:
    """Register under the function's name; a trailing ``_`` only avoids a clash."""
    QUERIES[function.__name__.removesuffix("_")] = function
    return function


def text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def rounded(name: str, digits: int = 4) -> Column:
    return F.round(F.col(name), digits).alias(name)


# --- sources, sinks and projections -------------------------------------------------


@query
def scan_fact(spark: SparkSession, folder: str) -> DataFrame:
    orders = data.table(spark, folder, "orders")
    return orders.withColumn("o_orderdate", F.to_date("o_orderdate").cast("string"))


@query
def filter_indicator(spark: SparkSession, folder: str) -> DataFrame:
    rows = joins.for_indicator(data.fact(spark, folder), URGENT)
    return rows.select("unique_id", "indicator_id", "geo_join_id", text("start_date"), "data_value")


@query
def map_columns(spark: SparkSession, folder: str) -> DataFrame:
    names = {"o_orderkey": "unique_id", "o_totalprice": "data_value", "o_orderpriority": "name", "o_note": "message"}
    return mapping.map_columns(data.table(spark, folder, "orders"), names)


@query
def normalize_headers_(spark: SparkSession, folder: str) -> DataFrame:
    headers = [" Cust Key", "Customer  Name ", "Nation-Key", "ACCT Bal", "Mkt_Segment"]
    return normalize_headers(data.table(spark, folder, "customer").toDF(*headers))


@query
def fact_projection(spark: SparkSession, folder: str) -> DataFrame:
    pending = F.col("message") == "P"
    rows = data.fact(spark, folder).withColumn("unique_id", F.when(~pending, F.col("unique_id")))
    facts = load.fact_projection(rows, "run-1")
    return facts.withColumn("start_date", text("start_date"))


def _order_texts(spark: SparkSession, folder: str) -> DataFrame:
    return data.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Unique ID"),
        F.col("o_orderpriority").alias("Name"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Start_Date"),
        F.col("o_totalprice").alias("Data Value"),
    )


def _order_values(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("unique_id").cast("bigint").alias("unique_id"),
        "name",
        parse_date(F.col("start_date")).cast("string").alias("start_date"),
        parse_number(F.col("data_value")).alias("data_value"),
    )


@query
def src_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    write_csv(_order_texts(spark, folder), path)
    columns = ("unique_id", "name", "start_date", "data_value")
    return _order_values(read_source(spark, SourceSpec(path=path, mapping={c: c for c in columns})))


@query
def src_csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Two files of one source whose headers differ in order and case."""
    path, rows = scratch_path(spark, "orders-headers"), _order_texts(spark, folder)
    turned = rows.select(*[F.col(c).alias(c.upper()) for c in reversed(rows.columns)])
    write_csv(rows.filter(F.col("Unique ID") % 2 == 0), f"{path}/even")
    write_csv(turned.filter(F.col("UNIQUE ID") % 2 == 1), f"{path}/odd")
    columns = ("unique_id", "name", "start_date", "data_value")
    return _order_values(read_source(spark, SourceSpec(path=f"{path}/*", mapping={c: c for c in columns})))


@query
def src_csv_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Names with line breaks, quotes and delimiters, read in splits."""
    path = scratch_path(spark, "orders-breaks")
    mark = F.when(F.col("Unique ID") % 3 == 0, F.lit('\n"a",\r\n\n')).otherwise(F.lit(", b"))
    write_csv(_order_texts(spark, folder).withColumn("Name", F.concat("Name", mark, F.lit("."))), path)
    columns = ("unique_id", "name", "start_date", "data_value")
    return _order_values(read_source(spark, SourceSpec(path=path, mapping={c: c for c in columns}, quoted_breaks=True)))


@query
def src_json(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-json")
    _order_texts(spark, folder).write.json(path)
    names = {"Unique ID": "unique_id", "Name": "name", "Start_Date": "start_date", "Data Value": "data_value"}
    return _order_values(read_source(spark, SourceSpec(path=path, format="json", mapping=names)))


@query
def sink_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "split-csv")
    write_csv(split_date(data.fact(spark, folder)), path)
    schema = (
        "unique_id bigint, indicator_id int, geo_join_id int, time_period string, start_date string, "
        "data_value double, message string, year int, month int, day int"
    )
    return spark.read.option("header", True).schema(schema).csv(path)


@query
def inject_bad_row(spark: SparkSession, folder: str) -> DataFrame:
    rows = data.table(spark, folder, "orders").select("o_orderkey", F.col("o_orderpriority").alias("name"))
    return mapping.inject_bad_row(rows, ["o_orderkey"])


# --- cleaning and validation --------------------------------------------------------


def _date_texts(spark: SparkSession, folder: str) -> DataFrame:
    return settle(data.date_texts(spark, folder), "date-texts")


def _tagged(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Tagged wide rows, staged as a load does before it splits them; only ``columns`` if any are named."""
    tagged = tag_records(data.wide_rows(spark, folder))
    return settle(tagged.select(*columns) if columns else tagged, "tagged")


@query
def null_tokens_(spark: SparkSession, folder: str) -> DataFrame:
    tokens = ["NA", "n/a", "NULL", "  NA ", "nan", "#N/A", "-1.#IND", "<NA>", "none", "None", "NaT"]
    choice = F.element_at(F.array(*[F.lit(t) for t in tokens]), (F.col("o_orderkey") % 22 + 1).cast("int"))
    told = F.when(F.col("o_orderkey") % 22 < len(tokens), choice).otherwise(F.col("o_orderpriority"))
    return data.table(spark, folder, "orders").select("o_orderkey", null_tokens(told).alias("token"))


@query
def clean_values(spark: SparkSession, folder: str) -> DataFrame:
    kind, name = F.col("o_orderkey") % 5, F.col("o_orderpriority")
    padded = (
        F.when(kind == 0, F.concat(F.lit("\t "), name, F.lit("\u00a0 ")))
        .when(kind == 1, F.concat(F.lit("\u3000"), name, F.lit("\n")))
        .when(kind == 2, F.lit("\u00a0\t"))
        .when(kind == 3, F.lit(""))
        .otherwise(name)
    )
    rows = data.table(spark, folder, "orders").select(
        "o_orderkey",
        padded.alias("name"),
        F.when(kind == 4, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("data_value"),
    )
    return clean_columns(rows)


@query
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    return _date_texts(spark, folder).select(
        "o_orderkey", "date_text", parse_date(F.col("date_text")).cast("string").alias("start_date")
    )


@query
def parse_date_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates written in forms with short years, names, dots, months alone and compact times."""
    patterns = ["MM/dd/yy", "dd-MMM-yyyy", "MMM yyyy", "MM/yyyy", "MM.dd.yyyy", "yyyyMMdd'T'HHmmss", "MMMM d, yyyy", "ddMMMyyyy", "yyyy-MMM-dd", "'Mon' MMM d yyyy"]
    chosen = F.lit(None).cast("string")
    for i, pattern in enumerate(patterns):
        chosen = F.when(F.col("o_orderkey") % len(patterns) == i, F.date_format("o_orderdate", pattern)).otherwise(chosen)
    rows = settle(data.table(spark, folder, "orders").select("o_orderkey", chosen.alias("date_text")), "date-forms")
    return rows.select("o_orderkey", "date_text", parse_date(F.col("date_text")).cast("string").alias("start_date"))


@query
def coerce_dropna(spark: SparkSession, folder: str) -> DataFrame:
    rows = _date_texts(spark, folder).select(
        "o_orderkey",
        F.col("date_text").alias("start_date"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("12.5f")).otherwise(F.col("o_totalprice").cast("string")).alias(VALUE),
        F.when(F.col("o_orderkey") % 5 != 0, F.lit("somewhere")).alias(PLACE),
    )
    return features.coerce_and_drop(rows).withColumn("start_date", text("start_date"))


@query
def validate_split(spark: SparkSession, folder: str) -> DataFrame:
    tagged = _tagged(spark, folder)
    columns = ["_key", "_copy", "unique_id", "indicator_id", "geo_join_id", "start_date", "data_value"]
    names = {"_key": "order_key", "_copy": "copy_number"}
    valid = valid_rows(tagged).select(
        "_key", "_copy", text("unique_id"), text("indicator_id"), text("geo_join_id"), text("start_date"), "data_value"
    )
    rejected = rejected_rows(tagged).withColumn("data_value", F.lit(None).cast("double")).select(*columns)
    both = valid.withColumn("outcome", F.lit("valid")).unionByName(rejected.withColumn("outcome", F.lit("rejected")))
    return both.withColumnsRenamed(names)


@query
def reject_reason(spark: SparkSession, folder: str) -> DataFrame:
    tagged = tag_records(data.wide_rows(spark, folder))
    return tagged.select(F.col("_key").alias("order_key"), F.col("_copy").alias("copy_number"), REASON)


@query
def default_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Reasons under a configuration whose rule lists are empty or missing: the defaults hold."""
    spec = SourceSpec.from_config({"data_source": {"path": folder}, "validation": {"required_fields": [], "numeric_fields": None}})
    tagged = tag_records(data.wide_rows(spark, folder), spec.rules, spec.null_tokens)
    return tagged.filter(REASON + " IS NOT NULL").groupBy(REASON).agg(F.count(F.lit(1)).alias("reject_count"))


@query
def default_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows that name no reason: the reason stored, and the one reported."""
    named = F.when(F.col("_key") % 2 == 0, F.col(REASON)).alias(REASON)
    rows = rejected_rows(_tagged(spark, folder)).withColumn(REASON, named).withColumnRenamed(data.ORIGIN, FILE_NAME)
    stored = rejects.reject_rows(rows, "run-1", data.WIDE_ORDER).groupBy(REASON).agg(F.count(F.lit(1)).alias("reject_count"))
    told = rejects.reject_summary(rows, data.WIDE_ORDER).select(REASON, "reject_count")
    return stored.withColumn("place", F.lit("stored")).unionByName(told.withColumn("place", F.lit("reported")))


@query
def reject_summary(spark: SparkSession, folder: str) -> DataFrame:
    tagged = _tagged(spark, folder, REASON, *data.WIDE_ORDER)
    return rejects.reject_summary(rejected_rows(tagged), data.WIDE_ORDER)


@query
def reject_samples(spark: SparkSession, folder: str) -> DataFrame:
    tagged = _tagged(spark, folder, REASON, *data.WIDE_ORDER, *rejects.SAMPLE_FIELDS)
    return rejects.reject_samples(rejected_rows(tagged), data.WIDE_ORDER)


@query
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rejects.run_metrics(tag_records(data.wide_rows(spark, folder)))


@query
def reject_rows(spark: SparkSession, folder: str) -> DataFrame:
    rejected = rejected_rows(_tagged(spark, folder))
    rows = rejects.reject_rows(rejected.withColumnRenamed(data.ORIGIN, FILE_NAME), "run-1", data.WIDE_ORDER)
    fields = ["unique_id", "indicator_id", "name", "geo_place_name", "start_date", "message"]
    return rows.select(
        "run_id",
        REASON,
        "source_file",
        *[F.get_json_object("raw_record", f"$.{c}").alias(c) for c in fields],
        F.get_json_object("raw_record", "$.error_reason").isNull().alias("reason_removed"),
    )


@query
def run_log_latest(spark: SparkSession, folder: str) -> DataFrame:
    runs = latest_runs(data.run_events(spark, folder))
    day = "yyyy-MM-dd HH:mm:ss"
    return runs.select(
        "run_id",
        "source_file",
        F.date_format("start_timestamp", day).alias("start_timestamp"),
        F.date_format("end_timestamp", day).alias("end_timestamp"),
        *[text(f"{c}_records") for c in ("total", "valid", "rejected", "inserted", "skipped")],
        "status",
        "error_message",
    )


# --- duplicates and keyed loads -----------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query
def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    first = dedupe.dedupe_first(data.table(spark, folder, "lineitem"), LINE_KEYS, LINE_ORDER)
    return first.withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))


@query
def count_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.count_duplicates(data.table(spark, folder, "lineitem"), LINE_KEYS)


@query
def extract_dimension(spark: SparkSession, folder: str) -> DataFrame:
    valid = valid_rows(_tagged(spark, folder))
    return load.extract_dimension(valid, load.INDICATOR_MAP, "indicator_id", data.WIDE_ORDER)


@query
def append_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders are stored already; the batch is every order, once as it is and
    once more with another value."""
    facts = data.fact(spark, folder)
    batch = facts.withColumn("_copy", F.lit(0)).unionByName(
        facts.withColumns({"_copy": F.lit(1), "data_value": F.lit(0.0)})
    )
    stored = facts.filter(F.col("message") == "F")
    fresh = load.new_rows(batch, stored, "unique_id", ["_copy"])
    return fresh.withColumn("start_date", text("start_date"))


@query
def append_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The same append as a batch too large to send its keys to all tasks, against stored keys in buckets."""
    facts = settle(data.fact(spark, folder), "facts")
    batch = facts.withColumn("_copy", F.lit(0)).unionByName(
        facts.withColumns({"_copy": F.lit(1), "data_value": F.lit(0.0)})
    )
    index = KeyIndex(scratch_path(spark, "keys"), 8, kind="bigint")
    for status in ("F", "O"):
        index.write(facts.filter((F.col("message") == status) & (F.col("unique_id") % 3 > 0)), status)
    existing = facts.filter((F.col("message") == "F") & (F.col("unique_id") % 3 == 0))
    with index.as_wide(spark):
        fresh = load.new_rows(batch, existing, "unique_id", ["_copy"], None, 2_000_000, index.read(spark, ["F"]))
        return settle(fresh, "fresh").withColumn("start_date", text("start_date"))


@query
def ingest_measurements(spark: SparkSession, folder: str) -> DataFrame:
    """The whole load from CSV files, read back from the warehouse."""
    return _ingested(spark, folder, "measurements").select(
        "unique_id",
        "indicator_id",
        "geo_join_id",
        "time_period",
        text("start_date"),
        "data_value",
        "message",
        "run_id",
        F.col("load_timestamp").isNotNull().alias("has_load_time"),
    )


@query
def ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rows = _ingested(spark, folder, "ingestion_rejects")
    return rows.groupBy("run_id", REASON).agg(
        F.count(F.lit(1)).alias("reject_count"), F.count_distinct("reject_id").alias("distinct_ids")
    )


@query
def ingest_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of even keys loaded, then all orders with other values and renamed places: facts and both dimensions."""
    home = scratch_path(spark, "reload")
    names = data.geographic(spark, folder)
    facts = data.fact(spark, folder).join(names, "geo_join_id").withColumn("start_date", text("start_date"))
    rows = facts.withColumns({"name": F.concat(F.lit("kind "), "indicator_id"), "measure": F.lit("m"), "measure_info": F.lit("i")})
    later = rows.withColumns({"data_value": F.lit(1.5), "geo_place_name": F.lit("renamed")})
    first = (F.col("unique_id") % 2 == 0) & (F.col("indicator_id") < 5)
    for run, part in (("run-1", rows.filter(first)), ("run-2", later)):
        write_csv(part.select(*SOURCE_COLUMNS), f"{home}/{run}")
        run_ingest(spark, SourceSpec(path=f"{home}/{run}"), f"{home}/tables", run)
    return _loaded(spark, f"{home}/tables")


@query
def ingest_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Loads without an index, after a rebuild, and with what the loads since have added to it."""
    home = scratch_path(spark, "indexed")
    names = data.geographic(spark, folder)
    facts = data.fact(spark, folder).join(names, "geo_join_id").withColumn("start_date", text("start_date"))
    rows = facts.withColumns({"name": F.concat(F.lit("kind "), "indicator_id"), "measure": F.lit("m"), "measure_info": F.lit("i")})
    later = rows.withColumns({"data_value": F.lit(1.5), "geo_place_name": F.lit("renamed")})
    third = F.col("unique_id") % 3
    for run, part in (("run-1", rows.filter(third == 0)), ("run-2", rows.filter(third < 2)), ("run-3", later)):
        write_csv(part.select(*SOURCE_COLUMNS), f"{home}/{run}")
        run_ingest(spark, SourceSpec(path=f"{home}/{run}"), f"{home}/tables", run)
        if run == "run-1":
            rebuild(spark, f"{home}/tables", 8)
    return _loaded(spark, f"{home}/tables").filter("kind = 'fact'")


def _loaded(spark: SparkSession, warehouse: str) -> DataFrame:
    measured, kinds, places = (read_table(spark, warehouse, t) for t in ("measurements", "indicators", "geographic"))
    return (
        measured.select(F.lit("fact").alias("kind"), text("unique_id").alias("id"), "data_value", "run_id")
        .unionByName(kinds.select(F.lit("indicator").alias("kind"), text("indicator_id").alias("id"), F.lit(None).cast("double").alias("data_value"), F.col("name").alias("run_id")))
        .unionByName(places.select(F.lit("place").alias("kind"), text("geo_join_id").alias("id"), F.lit(None).cast("double").alias("data_value"), F.col("geo_place_name").alias("run_id")))
        .withColumnRenamed("run_id", "label")
    )


def _ingested(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Wide rows to CSV, sorted so that file order is key order, then one load."""
    home = scratch_path(spark, "home")
    wide = data.wide_rows(spark, folder).repartitionByRange(*data.WIDE_ORDER).sortWithinPartitions(*data.WIDE_ORDER)
    write_csv(wide.select(*SOURCE_COLUMNS), f"{home}/in")
    run_ingest(spark, SourceSpec(path=f"{home}/in", multiline=False), f"{home}/tables", "run-1")
    return read_table(spark, f"{home}/tables", table)


# --- joins and audits ---------------------------------------------------------------


def _some_places(spark: SparkSession, folder: str) -> DataFrame:
    """Places without those of Africa, so that some facts have none."""
    return data.geographic(spark, folder).filter(F.col("geo_type_name") != "AFRICA")


@query
def join_geo_left(spark: SparkSession, folder: str) -> DataFrame:
    joined = joins.join_geographic(data.fact(spark, folder), _some_places(spark, folder))
    return joined.select("unique_id", "indicator_id", "geo_join_id", PLACE, text("start_date"), VALUE)


@query
def join_indicator_inner(spark: SparkSession, folder: str) -> DataFrame:
    named = data.table(spark, folder, "orders").filter(F.col("o_orderpriority") != "5-LOW")
    names = settle(
        named.select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("indicator_id"), F.col("o_orderpriority").alias("name")
        ).distinct(),
        "indicators",
    )
    joined = joins.join_indicators(data.fact(spark, folder), names)
    return joined.withColumn("start_date", text("start_date"))


@query
def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return audit.pk_violations(data.table(spark, folder, "lineitem"), LINE_KEYS)


@query
def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    customers = data.table(spark, folder, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    return audit.fk_orphans(data.table(spark, folder, "orders"), "o_custkey", customers, "c_custkey")


@query
def not_null_violations(spark: SparkSession, folder: str) -> DataFrame:
    joined = joins.join_geographic(data.fact(spark, folder), _some_places(spark, folder))
    return audit.not_null_violations(joined, [PLACE, VALUE, "start_date"])


@query
def dimension_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    customers = data.table(spark, folder, "customer")
    return audit.dimension_conflicts(customers, "c_nationkey", ["c_mktsegment"])


@query
def table_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Primary keys, foreign keys and NOT NULL of four tables that have lost and repeated some keys."""
    orders, customers = data.table(spark, folder, "orders"), data.table(spark, folder, "customer")
    nations, regions = data.table(spark, folder, "nation"), data.table(spark, folder, "region")
    key = F.col("o_orderkey")
    orders = orders.withColumns({
        "o_custkey": F.when(key % 19 != 0, F.col("o_custkey")),
        "o_orderkey": F.when(key % 50 != 0, F.when(key % 31 == 0, key - 1).otherwise(key)),
        "o_orderpriority": F.when(key % 3 != 0, F.col("o_orderpriority")),
    })
    tables = {"orders": orders, "customer": customers.filter("c_custkey % 7 > 0"), "nation": nations, "region": regions.filter("r_regionkey < 4")}
    foreign = [("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey")]
    keys = {"orders": "o_orderkey", "customer": "c_name", "nation": "n_regionkey"}
    return audit.audit_tables(tables, keys, foreign, {"orders": ["o_custkey", "o_orderpriority"], "nation": ["n_name"]})


# --- statistics and features --------------------------------------------------------


@query
def group_mean(spark: SparkSession, folder: str) -> DataFrame:
    return stats.group_mean(data.places(spark, folder)).select(PLACE, rounded("mean_value"))


@query
def top_groups(spark: SparkSession, folder: str) -> DataFrame:
    """The places with the highest mean value of one indicator."""
    rows = joins.join_geographic(joins.for_indicator(data.fact(spark, folder), URGENT), data.geographic(spark, folder))
    return stats.top_groups(rows.dropna(subset=["start_date", VALUE, PLACE])).select(PLACE, rounded("mean_value"))


@query
def group_deviation(spark: SparkSession, folder: str) -> DataFrame:
    return features.group_deviation(data.places(spark, folder)).select(
        "unique_id", PLACE, rounded("location_avg_pollution"), rounded("pollution_deviation")
    )


@query
def season_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = add_season(data.fact(spark, folder))
    return rows.select("unique_id", "month", "season_idx", season_name(F.col("season_idx")).alias("season"))


@query
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    return split_date(data.fact(spark, folder)).select("unique_id", text("start_date"), "year", "month", "day")


@query
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows = data.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias(VALUE)
    )
    return features.one_hot(rows)


@query
def one_hot_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' names as categories: as many as there are customers."""
    customers = data.table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    encoded = features.one_hot_sparse(customers, "c_name")
    held = F.col("c_name_vector")
    return encoded.select(
        "c_custkey", "c_nationkey", held["size"].alias("size"), F.get(held["indices"], F.lit(0)).alias("place"), F.get(held["values"], F.lit(0)).alias("value")
    )


@query
def season_corr(spark: SparkSession, folder: str) -> DataFrame:
    return stats.correlation(add_season(data.fact(spark, folder))).select(rounded("correlation", 6))


@query
def season_corr_constant(spark: SparkSession, folder: str) -> DataFrame:
    """Events all lie in one month, so that the season is constant."""
    events = data.table(spark, folder, "events").select("ts", F.col("value").alias(VALUE))
    return stats.correlation(add_season(events, "ts")).select(rounded("correlation", 6))


@query
def season_boxplot(spark: SparkSession, folder: str) -> DataFrame:
    boxes = quantiles.box_summary(add_season(data.fact(spark, folder)))
    numbers = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    season = season_name(F.col("season_idx")).alias("season")
    return boxes.select("season_idx", season, "n", *[rounded(c) for c in numbers], "outliers")


def _in_loads(rows: DataFrame) -> DataFrame:
    """Facts with their load, one of seven, and a value far from zero."""
    return add_season(rows).withColumns({"load": F.col("unique_id") % 7, "far_value": F.col("data_value") + F.lit(1e8)})


@query
def merged_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Moments by indicator, merged from a profile per load."""
    rows = _in_loads(data.fact(spark, folder))
    parts = settle(profiles.profile(rows, ["load", "indicator_id"], "far_value", "month"), "profiles")
    merged = profiles.merge_profiles(parts, ["indicator_id"])
    sd, r = profiles.deviation().alias("deviation"), profiles.correlation().alias("correlation")
    return merged.select("indicator_id", "n", "mean", "low", "high", sd, r).select(
        "indicator_id", "n", rounded("mean", 3), rounded("low", 2), rounded("high", 2), rounded("deviation", 3), rounded("correlation", 6)
    )


@query
def sketch_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles by season from sketches per load, and whether their true rank is near enough."""
    rows = settle(_in_loads(data.fact(spark, folder)).select("load", "season_idx", "data_value"), "seasons")
    merged = profiles.merge_profiles(profiles.profile(rows, ["load", "season_idx"], "data_value"), ["season_idx"])
    found = settle(profiles.sketch_quantiles(merged, ["season_idx"], [0.05, 0.25, 0.5, 0.75, 0.95]), "quantiles")
    ranks = rows.join(found, "season_idx").groupBy("season_idx", "probability").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("data_value") < F.col("quantile")).cast("double")).alias("under"),
        F.avg((F.col("data_value") <= F.col("quantile")).cast("double")).alias("upto"),
    )
    wanted, error = F.col("probability"), profiles.RANK_ERROR
    return ranks.select("season_idx", "probability", "n", wanted.between(F.col("under") - error, F.col("upto") + error).alias("is_near"))


@query
def ingest_profiled(spark: SparkSession, folder: str) -> DataFrame:
    """Sums and spread by place of one indicator after two loads, each profiled when it came."""
    home = scratch_path(spark, "profiled")
    facts = data.fact(spark, folder).join(data.geographic(spark, folder), "geo_join_id").withColumn("start_date", text("start_date"))
    rows = facts.withColumns({"name": F.lit("n"), "measure": F.lit("m"), "measure_info": F.lit("i")})
    for run in (0, 1):
        write_csv(rows.filter(F.col("unique_id") % 2 == run).select(*SOURCE_COLUMNS), f"{home}/run-{run}")
        run_ingest(spark, SourceSpec(path=f"{home}/run-{run}"), f"{home}/tables", f"run-{run}")
        update_profiles(spark, f"{home}/tables")
    found = run_profiled(spark, f"{home}/tables", URGENT).place_profile
    deviation = F.round(F.sqrt(F.try_divide(F.col("group_variance") * F.col("group_count"), F.col("group_count") - 1)), 4).alias("deviation")
    total = F.round(F.col("group_mean") * F.col("group_count"), 2).alias("group_sum")
    return found.select(PLACE, "group_count", total, rounded("group_min"), rounded("group_max"), deviation)


@query
def price_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles by narrowing ranges over several rounds, as it happens on tables of any size."""
    lines = data.table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    found = quantiles.group_quantiles(lines, "l_returnflag", "l_extendedprice", [0.1, 0.5, 0.99], cells=16, rank_limit=100)
    return found.withColumn("quantile", rounded("quantile"))


def _deviations(spark: SparkSession, folder: str) -> tuple[DataFrame, distribution.Spread]:
    rows = data.places(spark, folder).select(PLACE, VALUE)
    profile = features.group_profile(rows, PLACE, VALUE)
    return features.group_deviation(rows, profile=profile), distribution.deviation_spread(profile)


@query
def deviation_histogram(spark: SparkSession, folder: str) -> DataFrame:
    deviations, spread = _deviations(spark, folder)
    bins = distribution.histogram(deviations, "pollution_deviation", spread=spread)
    return bins.select("bin", rounded("bin_start"), rounded("bin_end"), "bin_count")


@query
def deviation_kde(spark: SparkSession, folder: str) -> DataFrame:
    deviations, spread = _deviations(spark, folder)
    density = distribution.kernel_density(deviations, "pollution_deviation", spread=spread, resolution=None)
    return density.select("point", rounded("x"), rounded("density"))


@query
def deviation_kde_binned(spark: SparkSession, folder: str) -> DataFrame:
    deviations, spread = _deviations(spark, folder)
    density = distribution.kernel_density(deviations, "pollution_deviation", spread=spread)
    return density.select("point", rounded("x"), rounded("density"))
