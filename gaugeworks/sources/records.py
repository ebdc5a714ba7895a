"""CSV files whose quoted fields hold line breaks, read in splits.

A line does not tell whether it starts inside a quoted field: that depends on all quotes
before it in its file. So each chunk of 2,048 lines of a split counts its quotes, a prefix
over the chunks of a split and over the splits of a file gives the state in which each one
starts, and then lines are put together to records in parallel. Lines are shuffled by chunk,
so that no task has to sort a whole split; only those that do not make a record by themselves
are shuffled by record.

Holds for files in UTF-8 that quote as RFC 4180 says: a field with a quote in it is quoted
and the quote doubled. Lines end with LF or CRLF; breaks inside quotes stay as
they are (``multiline`` turns CRLF into LF there). A file
that ends inside a quoted field is an error. Blank records are skipped. A record is placed
where its first line is, so that the order of rows is that of the file.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from gaugeworks.operators.mapping import normalize_name
from gaugeworks.schemas import BLOCK, FILE, FILE_NAME, LINEAGE, MALFORMED, ROW
from gaugeworks.session import settle, shuffle_width
from gaugeworks.sources.spec import SourceSpec

#: Lines of a chunk, as a power of two; with its marks a chunk stays below the 4,096 rows that a window holds in plain memory.
CHUNK_BITS = 11
_PLACE, _CHUNK = [FILE, BLOCK], "_chunk"


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Files scanned twice are cut alike, and rows numbered alike, though executors come or go in between."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    default = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
    spark.conf.set(key, before or str(default))
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def _earlier_splits() -> WindowSpec:
    return Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def _earlier_chunks() -> WindowSpec:
    return Window.partitionBy(*_PLACE).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def _states(chunks: DataFrame) -> DataFrame:
    """``chunks`` with the number of quotes before each one in its file, over those of its split and then over earlier splits."""
    blocks = chunks.groupBy(*_PLACE).agg(F.sum("quotes").alias("quotes"))
    open_files = blocks.groupBy(FILE).agg(F.sum("quotes").alias("n")).where("n % 2 = 1").select(FILE).head(1)
    if open_files:
        raise ValueError(f"{open_files[0][0]} ends inside a quoted field")
    so_far = F.sum("quotes")
    before = F.coalesce(so_far.over(_earlier_splits()), F.lit(0))
    blocks = blocks.select(*_PLACE, before.alias("quotes_before"))
    in_split = F.coalesce(so_far.over(_earlier_chunks()), F.lit(0))
    return chunks.withColumn("in_split", in_split).join(blocks, _PLACE).withColumn("quotes_before", F.col("quotes_before") + F.col("in_split")).drop("in_split")


def _told(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """Lines with their place, whether each is a record ``alone``, and the ``first`` line of its record if that is in its chunk.

    Lines are shuffled without their place. Each chunk (of each split in it) sends a mark to its
    first line, which sets the quotes so far to those before it in its file and brings the place.
    """
    by_row = Window.partitionBy(_CHUNK).orderBy(ROW)
    ended = F.lag(F.col("quotes_before") + F.col("quotes")).over(by_row)
    marks = _states(chunks).select(
        _CHUNK, ROW, F.lit(None).cast("string").alias("line"), (F.col("quotes_before") - F.coalesce(ended, F.lit(0))).alias("quotes"),
        F.struct(FILE, BLOCK, FILE_NAME, F.col(ROW).alias("since")).alias("place"),
    )
    rows = lines.select(_CHUNK, ROW, "line", "quotes", F.lit(None).cast(marks.schema["place"].dataType).alias("place")).unionByName(marks)
    # One sort serves all windows, over rows that do not have their place yet.
    so_far = by_row.orderBy(ROW, "is_line").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("is_line", F.col("line").isNotNull()).withColumn("after", F.sum("quotes").over(so_far))
    rows = rows.withColumn("starts", F.col("is_line") & ((F.col("after") - F.col("quotes")) % 2 == 0))
    rows = rows.withColumns({
        "first": F.last(F.when(F.col("starts"), F.col(ROW)), ignorenulls=True).over(so_far),
        "place": F.last("place", ignorenulls=True).over(so_far),
    })
    first = F.when(F.col("first") >= F.col("place.since"), F.col("first"))  # else it is of another split
    alone = F.col("starts") & (F.col("after") % 2 == 0)
    return rows.where("is_line").select("line", "place.*", ROW, _CHUNK, alone.alias("alone"), first.alias("first")).drop("since")


def _origins(told: DataFrame) -> DataFrame:
    """Per chunk the first line of the record that is open where the chunk starts."""
    ends = settle(told.groupBy(*_PLACE, _CHUNK).agg(F.max("first").alias("last")), "ends")
    last = F.last("last", ignorenulls=True)
    # Row numbers grow within a split, not from one split of a file to the next.
    blocks = ends.groupBy(*_PLACE).agg(F.max("last").alias("last")).select(*_PLACE, last.over(_earlier_splits()).alias("before"))
    origins = ends.withColumn("in_split", last.over(_earlier_chunks())).join(blocks, _PLACE)
    return settle(origins.select(*_PLACE, _CHUNK, F.coalesce("in_split", "before").alias("origin")), "origins")


def lines_of_records(lines: DataFrame) -> DataFrame:
    """Lines with their place and the row number of the first line of their record, its ``origin``; whether they are a record ``alone``."""
    spark = lines.sparkSession
    lines = lines.withColumn(_CHUNK, F.shiftright(ROW, CHUNK_BITS))
    with _same_splits(spark):
        sums = [F.sum("quotes").alias("quotes"), F.count(F.lit(1)).alias("lines"), F.min(ROW).alias(ROW)]
        chunks = settle(lines.groupBy(*_PLACE, FILE_NAME, _CHUNK).agg(*sums), "chunks")
        with shuffle_width(spark, chunks.agg(F.sum("lines")).first()[0] or 0):
            told = settle(_told(lines, chunks), "lines")
    inner = told.where(F.col("first").isNotNull()).withColumn("origin", F.col("first"))
    # Lines before the first record of a chunk belong to the last record of an earlier one.
    outer = told.where(F.col("first").isNull()).join(_origins(told), [*_PLACE, _CHUNK])
    return inner.unionByName(outer).drop("first", _CHUNK)


def records(lines: DataFrame) -> DataFrame:
    """(record, file, block, file name, row) of ``lines_of_records``."""
    place = F.when(F.col(ROW) == F.col("origin"), F.struct(FILE, BLOCK, FILE_NAME))
    pieces = lines.where(~F.col("alone")).select("origin", place.alias("place"), F.struct(BLOCK, ROW, "line").alias("piece"))
    joined = pieces.groupBy("origin").agg(F.array_sort(F.collect_list("piece")).alias("pieces"), F.first("place", ignorenulls=True).alias("place"))
    made = joined.select(F.array_join(F.col("pieces.line"), "\n").alias("record"), "place.*", F.col("origin").alias(ROW))
    whole = lines.where("alone").select(F.col("line").alias("record"), FILE, BLOCK, FILE_NAME, ROW).unionByName(made)
    return whole.withColumn("record", _bare("record")).where(F.trim("record") != "")


def _bare(name: str) -> Column:
    return F.regexp_replace(name, r"\r$", "")


def _headers(lines: DataFrame) -> DataFrame:
    """Per file its first record that is not blank, and where it is."""
    # Only a record of one line can be blank: others have quotes. Numbers alone are compared, so that no text is sorted.
    begins = lines.where((F.col(ROW) == F.col("origin")) & (F.trim(_bare("line")) != ""))
    splits = begins.groupBy(*_PLACE).agg(F.min(ROW).alias(ROW))
    tops = settle(splits.groupBy(FILE).agg(F.min(F.struct(BLOCK, ROW)).alias("top")).select(F.col(f"top.{ROW}").alias("origin")), "tops")
    firsts = records(lines.join(tops, "origin", "left_semi"))
    return settle(firsts.select(FILE, F.col("record").alias("header"), F.col(BLOCK).alias("top_block"), F.col(ROW).alias("top_row")), "headers")


def _header(text: str, spec: SourceSpec) -> list[str]:
    fields = next(csv.reader(io.StringIO(text.lstrip("\ufeff"), newline=""), delimiter=spec.delimiter), [])
    names = [normalize_name(n) for n in fields]
    if len(set(names)) < len(names):
        raise ValueError(f"headers are equal after normalization: {names}")
    if not set(names) & {normalize_name(n) for n in spec.mapping}:
        raise ValueError(f"a header of {spec.path} has none of the columns of {spec.name}: {names}")
    return names


def scan_records(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """As ``scan_source``, for files with line breaks in quoted fields that are to be read by many tasks.

    The driver sees each different header once. Files may differ in their headers.
    """
    if spec.encoding.lower().replace("-", "") != "utf8":
        raise ValueError(f"quoted breaks are read in UTF-8 only, not in {spec.encoding}")
    lines = spark.read.option("lineSep", "\n").text(spec.path).select(
        F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_name").alias(FILE_NAME),
        F.monotonically_increasing_id().alias(ROW),
    )
    lines = lines_of_records(lines)
    rows = records(lines)
    if spec.has_header:
        firsts = _headers(lines)
        layouts = {r[0]: _header(r[0], spec) for r in firsts.select("header").distinct().collect()}
        rows = rows.join(firsts, FILE).where((F.col(BLOCK) != F.col("top_block")) | (F.col(ROW) != F.col("top_row")))
    else:
        layouts = {None: [normalize_name(n) for n in spec.mapping]}
        rows = rows.withColumn("header", F.lit(None).cast("string"))

    # Two more fields than the widest header: the first surplus one, and one that is never read.
    width = max(map(len, layouts.values()), default=0) + 2
    fields = ", ".join(f"c{i} string" for i in range(width))
    options = {"sep": spec.delimiter, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    padded = F.concat("record", F.lit(spec.delimiter * 2))  # else every ordinary row would count as malformed
    cells = rows.withColumn("cells", F.from_csv(padded, fields, options))

    def of_layout(place: dict[str | None, int]) -> Column:
        told = [F.when(F.col("header").eqNullSafe(F.lit(h)), F.col(f"cells.c{i}")) for h, i in place.items()]
        return F.coalesce(*told, F.lit(None).cast("string"))

    targets = []
    for source, target in spec.mapping.items():
        name = normalize_name(source)
        targets.append(of_layout({h: names.index(name) for h, names in layouts.items() if name in names}).alias(target))
    surplus = of_layout({h: len(names) for h, names in layouts.items()}).alias(MALFORMED)
    return cells.select(*targets, surplus, *LINEAGE)
