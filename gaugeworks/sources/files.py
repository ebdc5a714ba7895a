"""Reading delimited and JSON files as text columns with their file order."""

from __future__ import annotations

import csv
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.text import null_tokens
from gaugeworks.operators.mapping import map_columns, normalize_name
from gaugeworks.schemas import BLOCK, FILE, FILE_NAME, LINEAGE, MALFORMED, ROW
from gaugeworks.sources.records import scan_records
from gaugeworks.sources.spec import SourceSpec

_PAD = "_pad"
# Without it a stream ignores files older than a week before the newest one.
ANY_AGE = "36500d"


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip and lower every column name and turn each space into ``_``."""
    names = [normalize_name(c) for c in df.columns]
    repeated = [name for name, count in Counter(names).items() if count > 1]
    if repeated:
        raise ValueError(f"headers are equal after normalization: {repeated}")
    return df.toDF(*names)


def with_file_place(df: DataFrame) -> DataFrame:
    """Add the file and block of each scanned row."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_name").alias(FILE_NAME),
    )


def with_file_order(df: DataFrame) -> DataFrame:
    """Add the lineage columns; call right on the scan, before any shuffle.

    Within one file block the row number grows; the file path and the block offset
    order the rest, whatever order the blocks are scheduled in.
    """
    return with_file_place(df).withColumn(ROW, F.monotonically_increasing_id())


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _csv_options(spec: SourceSpec) -> dict[str, object]:
    return {
        "header": spec.has_header,
        "sep": spec.delimiter,
        "encoding": spec.encoding,
        "multiLine": spec.multiline,
        "escape": '"',
        "mode": "PERMISSIVE",
    }


def _csv_reader(reader, spec: SourceSpec, names: list[str]):
    """``_pad`` is declared and never read: with one column pruned, the parser selects
    fields by position and every row has the expected width. Without it each ordinary
    row would count as malformed and raise inside the parser."""
    return reader.options(**_csv_options(spec)).schema(_text_schema([*names, MALFORMED, _PAD]))


def _json_reader(reader, spec: SourceSpec):
    """With the schema declared from the mapping there is no inference pass. Field
    names are matched as they are in the file; a record that is not JSON has its text
    in ``_extra``."""
    options = {"multiLine": spec.multiline, "encoding": spec.encoding, "columnNameOfCorruptRecord": MALFORMED}
    return reader.options(**options).schema(_text_schema([*spec.mapping, MALFORMED]))


def csv_columns(spark: SparkSession, spec: SourceSpec) -> list[str]:
    """Column names from the header line, or from the mapping when there is none."""
    if not spec.has_header:
        return list(spec.mapping)
    names = spark.read.options(**_csv_options(spec)).csv(spec.path).columns
    if not names:
        raise ValueError(f"no columns to read in {spec.path}")
    return names


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    """The first line of one file, through the file system and codec it is stored with."""
    context = spark.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
    try:
        return lines.readLine() or ""
    finally:
        lines.close()


def headers(spark: SparkSession, spec: SourceSpec) -> dict[tuple[str, ...], list[str]]:
    """Files of a CSV source by their header, as column names in file order.

    One line of each file is read, by a few threads. A file whose header shares no column
    with the mapping is an error, since its rows could only be read as something else.
    """
    files = spark.read.text(spec.path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file, spec.encoding), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        names = tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=spec.delimiter), []))
        if names:  # an empty file has no rows either
            if not {normalize_name(n) for n in names} & {normalize_name(n) for n in spec.mapping}:
                raise ValueError(f"header of {file} has none of the columns of {spec.name}: {list(names)}")
            found.setdefault(names, []).append(file)
    return found


def _scan(spark: SparkSession, reader, spec: SourceSpec) -> DataFrame:
    if spec.format == "csv":
        return _csv_reader(reader, spec, csv_columns(spark, spec)).csv(spec.path).drop(_PAD)
    return _json_reader(reader, spec).json(spec.path)


def _named(rows: DataFrame, spec: SourceSpec, lineage: list[str]) -> DataFrame:
    mapping = {normalize_name(source): target for source, target in spec.mapping.items()}
    return map_columns(normalize_headers(rows), mapping, keep=[MALFORMED, *lineage])


def scan_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Scan, normalize headers, map columns; every value is text as in the file.

    A row with too many fields has its first surplus field in ``_extra``; a short row
    is filled with NULL. CSV files may differ in their headers: those with equal ones
    are scanned together and the scans are united by target column.
    """
    if spec.format == "csv" and spec.quoted_breaks:
        return scan_records(spark, spec)
    groups = headers(spark, spec) if spec.format == "csv" and spec.has_header else {}
    if len({tuple(map(normalize_name, names)) for names in groups}) <= 1:
        return _named(with_file_order(_scan(spark, spark.read, spec)), spec, LINEAGE)
    scans = []
    for names, files in sorted(groups.items()):
        rows = _csv_reader(spark.read, spec, list(names)).csv(files).drop(_PAD)
        scans.append(_named(with_file_order(rows), spec, LINEAGE))
    return reduce(DataFrame.unionByName, scans)


def stream_source(spark: SparkSession, spec: SourceSpec, files_per_batch: int | None = None) -> DataFrame:
    """The same rows as a stream of newly arrived files, without the row number."""
    if spec.quoted_breaks:
        raise ValueError("a stream reads line breaks in quotes with multiline only")
    reader = spark.readStream.option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = [name for name in LINEAGE if name != ROW]
    return _named(with_file_place(_scan(spark, reader, spec)), spec, place)


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The scanned source with its missing-value tokens as NULL."""
    rows = scan_source(spark, spec)
    if not spec.null_tokens:
        return rows
    named = [null_tokens(F.col(c), spec.null_tokens).alias(c) for c in spec.mapping.values()]
    return rows.select(*named, MALFORMED, *LINEAGE)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Export with a header and no index: a folder of part files.

    ``single_file`` sends all rows through one task; use it for small results only.
    """
    rows = df.coalesce(1) if single_file else df
    rows.write.option("header", True).option("escape", '"').mode("overwrite").csv(path)
