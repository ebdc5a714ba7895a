"""SimHash fingerprints in DataFrame functions alone, and a search within a Hamming radius.

Terms are runs of three words, lower-cased, and the shorter runs at a text's end; a term
weighs as often as it occurs. Each of the 64 bits of a term's hash votes for or against
that bit. Votes are counted two to a long, bit j with bit j + 32, so that 32 plain sums
per text are grouped before the shuffle and hold for four billion terms.

For the search, 64 bits are cut into blocks; whatever ``radius`` bits differ, some choice
of ``match`` blocks is equal. Each choice is one table of fingerprints, keyed by those
blocks, and pairs with equal keys are kept if they lie within the radius. Equal
fingerprints are one row there.

Defined results: a null text counts as empty; a text without words has the fingerprint 0
and is as like to another such text as can be; rows that share an id are documents of
their own, ordered by text; null ids come first; the document after the last is the first,
which may be itself; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import settle

BITS = 64
#: Documents that are ordered together, on average.
BUCKET_ROWS = 1_000
#: Rows up to which a list goes to all tasks or is ordered in one.
SHORT = 100_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), "")


def terms(words: Column) -> Column:
    """Array of three-word runs, the last two of them shorter."""
    most = F.greatest(F.size(words), F.lit(1))
    return F.arrays_zip(words.alias("x"), F.slice(words, 2, most).alias("y"), F.slice(words, 3, most).alias("z"))


def fingerprints(df: DataFrame, keys: list[str], text_column: str) -> DataFrame:
    """``keys`` and the fingerprint of every row of ``df`` as a long; keys are unique."""
    split = df.select(*keys, words_of(F.col(text_column)).alias("words"))
    hashed = split.select(*keys, F.explode_outer(terms(F.col("words"))).alias("term")).select(*keys, F.xxhash64("term").alias("h"), F.col("term").isNotNull().alias("real"))
    pair = F.lit(0x0000_0001_0000_0001)
    votes = [F.sum(F.when(F.col("real"), F.shiftrightunsigned("h", j).bitwiseAND(pair)).otherwise(0)).alias(f"v{j}") for j in range(32)]
    summed = hashed.groupBy(*keys).agg(F.count("*").alias("n"), *votes)
    bits = []
    for j in range(32):
        for shift, count in ((j, F.col(f"v{j}").bitwiseAND(F.lit(0xFFFF_FFFF))), (j + 32, F.shiftrightunsigned(f"v{j}", 32))):
            bits.append(F.when(2 * count > F.col("n"), F.shiftleft(F.lit(1).cast("long"), shift)).otherwise(F.lit(0).cast("long")))
    value = bits[0]
    for bit in bits[1:]:
        value = value.bitwiseOR(bit)
    return summed.select(*keys, value.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the share of equal bits stands for, from 0 to 1."""
    return F.greatest(F.lit(0.0), F.cos(F.bit_count(a.bitwiseXOR(b)) * F.lit(math.pi / BITS)))


def _successors(values: DataFrame) -> DataFrame:
    """(v, next) of distinct whole numbers v >= -1; the last one's next is null.

    Numbers are ordered in groups of a thousand, and the groups in the same way, until few are left.
    """
    if values.count() <= SHORT:
        return values.select("v", F.lead("v").over(Window.orderBy("v")).alias("next"))
    group = values.withColumn("g", F.floor(F.col("v") / 1000).cast("long"))
    within = group.select("v", "g", F.lead("v").over(Window.partitionBy("g").orderBy("v")).alias("next"))
    least = group.groupBy("g").agg(F.min("v").alias("least"))
    following = _successors(settle(least.select(F.col("g").alias("v")), "order")).join(least.withColumnRenamed("g", "next"), "next")
    return within.join(following.select(F.col("v").alias("g"), "least"), "g", "left").select("v", F.coalesce("next", "least").alias("next"))


def _in_order(df: DataFrame) -> DataFrame:
    """(bucket, rn, id, text, following, next_bucket, next_rn) of all (id, text); one shuffle of the texts."""
    low, high, n = df.agg(F.min("id"), F.max("id"), F.count("*")).first()
    low = low or 0
    width = max(1, ((high or 0) - low + 1) * BUCKET_ROWS // max(1, n))
    above = F.col("id").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")  # a long could overflow
    bucket = F.coalesce(F.floor(above / F.lit(width).cast("decimal(20,0)")).cast("long"), F.lit(-1).cast("long"))
    placed = df.withColumn("bucket", bucket)

    # The first text of each bucket: of few documents, found by id.
    heads = settle(placed.groupBy("bucket").agg(F.min("id").alias("id")), "heads")
    n_heads = heads.count()
    head_ids = F.broadcast(heads) if n_heads <= SHORT else heads
    first = placed.alias("d").join(head_ids.alias("h"), (F.col("d.bucket") == F.col("h.bucket")) & F.col("d.id").eqNullSafe(F.col("h.id")))
    first = first.groupBy(F.col("d.bucket").alias("next")).agg(F.min("d.text").alias("head"))
    order = settle(_successors(heads.select(F.col("bucket").alias("v"))), "order")
    start = order.agg(F.min("v")).first()[0]
    tails = order.select(F.col("v").alias("bucket"), F.coalesce("next", F.lit(start)).alias("next")).join(first, "next")
    tails = settle(tails, "tails")

    in_bucket = Window.partitionBy("bucket").orderBy("id", "text")
    ordered = placed.select("bucket", F.row_number().over(in_bucket).alias("rn"), "id", "text", F.lead("text").over(in_bucket).alias("following"))
    whole = ordered.join(tails, "bucket")
    last = F.col("following").isNull()
    return whole.select(
        "bucket", "rn", "id", "text",
        F.coalesce("following", "head").alias("following"),
        F.when(last, F.col("next")).otherwise(F.col("bucket")).alias("next_bucket"),
        F.when(last, F.lit(1)).otherwise(F.col("rn") + 1).alias("next_rn"),
    )


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), BITS // 4, "0"))


def with_edits(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its text with the second half taken from the next document, and their likeness."""
    source = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ordered = _in_order(source)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("following", F.lit(1), half))
    docs = ordered.select("bucket", "rn", "id", "next_bucket", "next_rn", "text", edited.alias("edited"))
    versions = docs.select("bucket", "rn", F.explode(F.array(*(F.struct(F.lit(k).alias("version"), F.col(c).alias("text")) for k, c in enumerate(("text", "edited"))))).alias("t"))
    prints = fingerprints(versions.select("bucket", "rn", "t.version", "t.text"), ["bucket", "rn", "version"], "text")
    own = prints.where("version = 0").select("bucket", "rn", F.col("fingerprint").alias("f"))
    changed = prints.where("version = 1").select("bucket", "rn", F.col("fingerprint").alias("e"))
    after = own.select(F.col("bucket").alias("next_bucket"), F.col("rn").alias("next_rn"), F.col("f").alias("g"))
    facts = docs.select("bucket", "rn", "id", "next_bucket", "next_rn", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    joined = facts.join(own, ["bucket", "rn"]).join(changed, ["bucket", "rn"]).join(after, ["next_bucket", "next_rn"])
    return joined.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256",
        as_text(F.col("f")).alias("fingerprint"), as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("g")).alias("near_next"),
        F.col("f").alias("fingerprint_bits"),
    )


def within_radius(queries: DataFrame, rows: DataFrame, radius: int = 3, match: int = 3) -> DataFrame:
    """(q, f, distance) of all distinct fingerprints q of ``queries`` and f of ``rows`` within ``radius`` bits.

    Both have a long column ``fingerprint``. The tables are C(radius + match, match) in number.
    """
    blocks = radius + match
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << BITS) - 1 >> (BITS - (b - a))) << a for a, b in chosen) for chosen in itertools.combinations(itertools.pairwise(edges), match)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    tables = F.array(*(F.struct(F.lit(i).alias("table"), F.lit(m).alias("mask")) for i, m in enumerate(signed)))

    def keyed(df: DataFrame, name: str) -> DataFrame:
        distinct = df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        return distinct.select(name, F.explode(tables).alias("t")).select(name, "t.table", F.col(name).bitwiseAND(F.col("t.mask")).alias("key"))

    pairs = keyed(queries, "q").join(keyed(rows, "f"), ["table", "key"])
    distance = F.bit_count(F.col("q").bitwiseXOR(F.col("f")))
    return pairs.where(distance <= radius).select("q", "f", distance.alias("distance")).distinct()


def with_near_documents(prints: DataFrame, every: int = 50, radius: int = 3, id_column: str = "doc_id") -> DataFrame:
    """``prints`` with ``near_docs``: for ids divisible by ``every``, how many other documents lie within ``radius`` bits."""
    prints = settle(prints, "prints")
    asked = F.col(id_column) % every == 0
    rows = prints.select(F.col("fingerprint_bits").alias("fingerprint"))
    copies = rows.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    found = within_radius(prints.where(asked).select(F.col("fingerprint_bits").alias("fingerprint")), rows, radius)
    near = found.join(copies, found["f"] == copies["fingerprint"]).groupBy("q").agg(F.sum("copies").alias("all"))
    joined = prints.join(near, prints["fingerprint_bits"] == near["q"], "left")
    return joined.select(*(prints[c] for c in prints.columns if c != "fingerprint_bits"), F.when(asked, F.col("all") - 1).alias("near_docs"))
