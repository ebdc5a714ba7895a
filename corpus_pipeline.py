"""A training corpus from the documents: four stages, each over all that the one before it kept.

Low-quality documents go, then those in no known language, then all but one document of
each group of near copies; what is left is packed into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import language, ngram_join, packing, quality
from gaugeworks.llm.queries import WORD_BPE, ship
from gaugeworks.session import settle


#: Words of 64 rows of which some go, up to which their list goes to all tasks: 16 bytes each.
SHORT = 1_000_000


def _rows_kept(docs: DataFrame, decide) -> DataFrame:
    """The rows of ``docs`` for which ``decide`` keeps the row: it gets (row, text and evidence) and returns kept row names.

    Rows are named by their place, so that repeated ids are decided one by one. The rows
    that go are marked in words of 64 neighbours. The list of words is sent to all tasks
    while it is short, so that no text is shuffled, even if most rows go; a longer one is
    joined by a shuffle.
    """
    named = docs.withColumn("__row", F.monotonically_increasing_id())
    kept = settle(decide(named).select("__row"), "kept")
    gone = named.select("__row").join(kept, "__row", "left_anti")
    bit = F.expr("shiftleft(1L, cast(__row & 63 as int))")
    words = settle(gone.groupBy(F.shiftright("__row", 6).alias("__word")).agg(F.bit_or(bit).alias("__gone")), "gone")
    short = words.count() <= SHORT
    marked = named.withColumn("__word", F.shiftright("__row", 6)).join(F.broadcast(words) if short else words, "__word", "left")
    here = F.expr("getbit(__gone, cast(__row & 63 as int))")
    return marked.where(F.col("__gone").isNull() | (here == 0)).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality classifier keeps."""
    return quality.keep_good(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages that documents declare; a document's source stands for its host."""

    def decide(rows: DataFrame) -> DataFrame:
        evidence = rows.select(
            F.col("__row").alias("id"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
            F.lit(None).cast("string").alias("domain"), F.col("source").alias("host"),
        )
        found = language.identify(evidence, language.fit_text(docs))
        return found.where(F.col("lang") != language.UNKNOWN).withColumnRenamed("id", "__row")

    return _rows_kept(docs, decide)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""

    def decide(rows: DataFrame) -> DataFrame:
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
        found = ngram_join.ngram_join(rows, "__row")
        groups = found.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(F.min(order).alias("first"))
        return groups.select(F.col("first.__row").alias("__row"))

    return _rows_kept(docs, decide)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: where each piece of each document lies."""
    return packing.pack(packing.pieces(docs, WORD_BPE))


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("best-fit packing", packing_stage),
]

#: Classifiers, joins and packing are not SQL: each stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = {"pipeline": run}
