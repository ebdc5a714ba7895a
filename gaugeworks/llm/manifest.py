"""Merkle manifest of a dataset, with nested-interval labels.

Leaves are ranked within their part (a language, say), and every node carries the interval
``[lo, hi)`` of leaf ranks below it. ``ARITY`` consecutive nodes, fewer at the end, become
the digest of their digests put together, until one node of the part is left; the parts'
last nodes, in order of the parts, are the leaves of one more tree.

Levels are bucketed: ``HEIGHT`` of them form a band, and the nodes of a band below one node
of its top lie in one row, at most ``ARITY ** HEIGHT`` at its bottom. Upwards, each band is
one grouping of the tops of the band below, so a part of any size takes a handful of
shuffles of digests, never of texts. Downwards, each band is joined with the rows that hold
its tops, by containment of intervals, so that a node's ancestors up to the root arrive with
one row per bucket. Siblings of a node are what its own interval leaves of its parent's.

Ranks come from one range partitioning by part, order and row, so that neither a part with
most of the rows nor a repeated id meets in one task.

Defined results: a null part is a part of its own and comes first; rows in equal order are
ranked by leaf digest, and equal ones are all kept; null order values come first; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import settle

ARITY = 2
#: Levels of a band: a row of it holds up to 1,024 nodes of its lowest level.
HEIGHT = 10
WIDTH = ARITY**HEIGHT
#: monotonically_increasing_id puts the partition above this bit, the place in it below.
_PLACE_BITS = 33


def joined_digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, ``:``, the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return joined_digest(*map(field, values))


def _part_key(part: Column) -> Column:
    """The part as a text that is never null and sorts as the part does, null first."""
    return F.coalesce(F.concat(F.lit("="), part.cast("string")), F.lit(""))


def ranked(df: DataFrame, part: str, order: list[str]) -> DataFrame:
    """``df`` with ``lo``, each row's rank from 0 within its part, and ``n``, the rows of the part.

    One range partitioning; a row's rank is its place in its partition, less the rows of
    other parts before it, plus the rows of its part in earlier partitions.
    """
    dealt = df.withColumn("__row", F.monotonically_increasing_id())
    keys = [part, *order, "__row"]
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__row")
    placed = settle(dealt.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("__slice", F.shiftright("__at", _PLACE_BITS))
    slices = placed.groupBy("__slice", part).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    before = Window.partitionBy(part).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        "__slice", part, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(Window.partitionBy(part)).alias("n"),
    )
    joined = placed.join(settle(slices, "slices"), ["__slice", part])
    return joined.select(*df.columns, (F.col("__at") + F.col("__shift")).alias("lo"), "n")


def _parents(level: Column) -> Column:
    """The nodes above those of ``level``, all of one bucket and in order."""

    def parent(i: Column) -> Column:
        children = F.slice(level, i * ARITY + 1, F.lit(ARITY))
        digests = F.transform(children, lambda c: c["digest"])
        return F.struct(
            F.element_at(children, 1)["lo"].alias("lo"), F.element_at(children, -1)["hi"].alias("hi"),
            F.sha2(F.array_join(digests, ""), 256).alias("digest"),
        )

    last = F.floor((F.size(level) - 1) / ARITY).cast("int")
    return F.transform(F.sequence(F.lit(0), last), parent)


def _band(nodes: DataFrame, unit: int) -> DataFrame:
    """One row per bucket of a band whose lowest nodes cover ``unit`` leaves: (part, n, lo, hi, held, levels, top).

    ``nodes`` has (part, n, lo, hi, digest, held). ``levels`` holds the bucket's nodes level
    by level, lowest first; ``held`` is of the lowest ones. A part of one bucket ends where
    one node is left.
    """
    bucket = F.expr(f"lo div {unit * WIDTH}L").alias("bucket")
    rows = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", "held")))
    grouped = nodes.groupBy("part", "n", bucket).agg(rows.alias("rows"))
    steps = reduce(Column.__add__, (F.when(F.col("n") > unit * ARITY**k, 1).otherwise(0) for k in range(HEIGHT)))
    lowest = F.transform("rows", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest")))
    grow = F.aggregate(
        F.sequence(F.lit(1), F.col("steps")), F.array("lowest"), lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1))))
    )
    grown = (
        grouped.withColumn("lowest", lowest)
        .withColumn("steps", steps)
        .withColumn("levels", F.when(F.col("steps") > 0, grow).otherwise(F.array("lowest")))
        .withColumn("top", F.element_at(F.element_at("levels", -1), 1))
    )
    held = F.transform("rows", lambda x: x["held"]).alias("held")
    return grown.select("part", "n", F.col("top.lo").alias("lo"), F.col("top.hi").alias("hi"), held, "levels", F.col("top.digest").alias("top"))


@dataclass(frozen=True)
class Tree:
    """The bands of the trees of all parts, lowest first."""

    bands: list[DataFrame]

    @property
    def roots(self) -> DataFrame:
        """(part, digest): the last node of every part."""
        done = [b.where(F.col("n") <= WIDTH ** (k + 1)).select("part", F.col("top").alias("digest")) for k, b in enumerate(self.bands)]
        return reduce(DataFrame.unionByName, done)

    def nodes(self) -> DataFrame:
        """(part, level, lo, hi, digest) of every node, each once; leaves have level 0."""
        found = []
        for k, band in enumerate(self.bands):
            levels = band.select("part", F.posexplode("levels").alias("step", "nodes"))
            levels = levels.where(F.col("step") > 0) if k else levels  # its lowest level is the highest of the band below
            found.append(levels.select("part", (F.col("step") + k * HEIGHT).alias("level"), F.inline("nodes")))
        return reduce(DataFrame.unionByName, found)

    def paths(self, above: DataFrame) -> DataFrame:
        """(part, lo, held, path, *facts) of every leaf: siblings to the left and right, level by level up to the root.

        ``above`` has one row per part, (part, path, *facts): the way from the part's last node on.
        """
        facts = [c for c in above.columns if c not in ("part", "path")]
        ends = above.withColumn("lo", F.lit(0).cast("long"))
        rows = None
        for k in reversed(range(len(self.bands))):
            band = self.bands[k]
            over = ends
            if rows is not None:
                here = band.where(F.col("n") <= WIDTH ** (k + 1)).select("part")
                over = rows.select("part", "lo", "path", *facts).unionByName(ends.join(here, "part", "left_semi").select("part", "lo", "path", *facts))
            met = band.join(over.select("part", "lo", F.col("path").alias("rest"), *facts), ["part", "lo"])
            leaves = met.select("part", F.explode(_bucket_paths()).alias("leaf"), "rest", *facts)
            rows = leaves.select("part", "leaf.lo", "leaf.held", F.concat("leaf.path", "rest").alias("path"), *facts)
        return rows


def _bucket_paths() -> Column:
    """For each lowest node of a bucket (lo, held, path), the path within the bucket."""

    def siblings(node: Column, i: Column, step: Column) -> Column:
        parent = F.floor(i / F.pow(F.lit(ARITY), step + 1)).cast("int")
        covered = F.slice(F.element_at("levels", step + 1), parent * ARITY + 1, F.lit(ARITY))
        # What the node's own interval leaves of its parent's.
        before = F.filter(covered, lambda c: c["hi"] <= node["lo"])
        after = F.filter(covered, lambda c: c["lo"] > node["lo"])
        return F.struct(*(F.array_join(F.transform(s, lambda c: c["digest"]), "").alias(name) for s, name in ((before, "left"), (after, "right"))))

    def leaf(node: Column, i: Column) -> Column:
        steps = F.when(F.size("levels") > 1, F.sequence(F.lit(0), F.size("levels") - 2)).otherwise(F.array().cast("array<int>"))
        path = F.transform(steps, lambda step: siblings(node, i, step))
        return F.struct(node["lo"].alias("lo"), F.element_at("held", i + 1).alias("held"), path.alias("path"))

    return F.transform(F.element_at("levels", 1), leaf)


def _build(leaves: DataFrame) -> Tree:
    """The trees over ``leaves``, which have (part, n, lo, digest, held)."""
    nodes, bands, unit = leaves.withColumn("hi", F.col("lo") + 1), [], 1
    while True:
        band = settle(_band(nodes, unit), "band")
        bands.append(band)
        unit *= WIDTH
        if (band.agg(F.max("n")).first()[0] or 0) <= unit:
            return Tree(bands)
        wide = band.where(F.col("n") > unit)
        nodes = wide.select("part", "n", "lo", "hi", F.col("top").alias("digest"), F.lit(None).cast(leaves.schema["held"].dataType).alias("held"))


@dataclass(frozen=True)
class Manifest:
    """``parts``: the trees over rows; ``whole``: the tree over the parts' last nodes."""

    parts: Tree
    whole: Tree

    def nodes(self) -> DataFrame:
        """(tree, part, level, lo, hi, digest); ``tree`` is ``part`` or ``whole``, whose leaves are the parts."""
        of = lambda tree, name: tree.nodes().select(F.lit(name).alias("tree"), "*")
        return of(self.parts, "part").unionByName(of(self.whole, "whole"))

    def proofs(self) -> DataFrame:
        """(part, lo, held, path, subroot, root) of every row: ``path`` leads from its leaf to the root."""
        root = F.col("root")
        ends = self.whole.roots.select("part", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
        parts = self.whole.paths(ends).select(F.col("held.part").alias("part"), "path", F.col("held.digest").alias("subroot"), root)
        return self.parts.paths(settle(parts, "parts"))


def build(df: DataFrame, part: Column, order: list[str], held: list[str]) -> Manifest:
    """The manifest over the rows of ``df``, whose column ``leaf`` is each one's digest.

    ``order`` ranks the rows of a part; columns ``held`` come back with the proofs.
    """
    keep = F.struct(*held).alias("held")
    leaves = df.select(_part_key(part).alias("part"), *(F.col(c).alias(f"__order{i}") for i, c in enumerate(order)), F.col("leaf").alias("digest"), keep)
    leaves = settle(leaves, "leaves")  # else the texts are read twice, once to find the ranges
    rows = ranked(leaves, "part", [*(f"__order{i}" for i in range(len(order))), "digest"])
    trees = _build(rows.select("part", "n", "lo", "digest", "held"))
    tops = trees.roots.select(F.lit("").alias("part"), F.col("part").alias("name"), "digest")
    tops = ranked(tops, "part", ["name"])
    held_part = F.struct(F.col("name").alias("part"), "digest").alias("held")
    return Manifest(trees, _build(tops.select("part", "n", "lo", "digest", held_part)))


def path_digest(path: Column) -> Column:
    """The digest of the siblings of a path, from the leaf up."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` lead to."""
    return F.aggregate(path, leaf, lambda node, s: joined_digest(s["left"], node, s["right"]))
