"""Merkle manifest of a dataset: a content-addressed tree over its rows, and proofs read from it by descent.

Every row is a leaf, the digest of its fields. The leaves of a source, in the order of their ids, are combined
three by three into nodes, these again, until one is left; the digests of the sources are combined the same way
into the root. What is stored is one record for each node: its digest and the digests of its children.

A proof is found by descent. It starts with the root; at every level the nodes that are still on the way to a
wanted leaf meet the records by digest, open into their children, and each child takes along its siblings, the
ones it was not. Which child leads on follows from the digits of the leaf's rank in base three. What was gathered
on the way down, reversed, is the path from leaf to root.

At scale: texts are digested where they are read and never move. Ranks come from a range partitioning of narrow
rows by source and id, split further by place so that copies of one row spread, and from offsets of one row for each (partition,
source); no window holds a source. A level is a group-by of three rows each, so a hot source is no hot task.
All leaves of a node share one row on the way down, so a level carries a third of the rows of the next, and the last
step, where each leaf meets its node, is the only one with as many rows as there are leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapgrid.session import materialize

#: Children of a node, and bytes of a digest.
FAN = 3
WIDTH = 32
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Every so many levels of a descent what is on the way is written down.
STORED = 4
PATH = "array<struct<digit:int,others:binary>>"


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def combined(hex_digests: Column) -> Column:
    """The digest of digests that stand one after another as hexadecimal text."""
    return F.sha2(hex_digests, 256)


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of a row: for each field its length in bytes, a colon and its text, or a dash if it is null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: (tree, rank, leaf, extra columns), ``trees``: (tree, source, n, subroot), ``nodes``: for each level
    from the lowest a table (tree, level, rank, digest, children), ``tops``: the same over the trees. ``root`` is a
    table of one row, or of none for an empty dataset."""

    leaves: DataFrame
    trees: DataFrame
    nodes: list[DataFrame]
    tops: list[DataFrame]
    root: DataFrame


def _levels(leaves: int) -> int:
    """How often that many nodes can be combined until one is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def _grown(leaves: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The nodes over ``leaves`` (tree, rank, digest, n) by level, and the root of every tree (tree, digest).

    ``n`` is the number of nodes of the tree at a level. Each level is written once and read by the next.
    """
    roots = leaves.filter("n = 1").select("tree", "digest")
    nodes = []
    below = leaves.filter("n > 1")
    for level in range(1, _levels(most) + 1):
        members = F.sort_array(F.collect_list(F.struct("rank", "digest")))  # FAN at most
        runs = below.groupBy("tree", F.expr(f"rank div {FAN}").alias("up")).agg(
            F.array_join(F.transform(members, lambda m: hex_of(m["digest"])), "").alias("_hex"), F.max("n").alias("n")
        )
        built = runs.select(
            "tree", F.lit(level).alias("level"), F.col("up").alias("rank"), F.unhex(combined(F.col("_hex"))).alias("digest"),
            F.unhex("_hex").alias("children"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
        )
        built = materialize(built, f"{name}-level{level}")
        nodes.append(built.drop("n"))
        roots = roots.unionByName(built.filter("n = 1").select("tree", "digest"))
        below = built.filter("n > 1").select("tree", "rank", "digest", "n")
    return nodes, roots


def _ranked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with ``tree`` (the place of their source) and ``rank`` in it, and (tree, source, n) of all sources.

    Rows are ordered by source, id, leaf; nulls first.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["source", "doc_id", "leaf", "_place"]
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_place")
    ordered = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "manifest-order")
    part, at = F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_in")
    cut = ordered.select("*", part, at)
    # At most one row for each partition and each source.
    edges = materialize(
        cut.groupBy("_part", "source").agg(F.min("_in").alias("_first"), F.count(F.lit(1)).alias("_n")), "manifest-edges"
    )
    sources = edges.groupBy("source").agg(
        F.min(F.struct("_part", "_first")).alias("_start"), F.sum("_n").alias("n")
    )
    # Sources are numbered by where they start: within a partition, plus the sources that start in earlier ones.
    begun = sources.select("source", "n", F.col("_start._part").alias("_part"), F.col("_start._first").alias("_first"))
    base = begun.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    base = base.select("_part", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_first"))
    trees = begun.join(base, "_part").select("source", "n", (F.col("_base") + inside - 1).alias("tree"))
    trees = materialize(trees, "manifest-trees")
    along = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.select(
        "_part", "source", (F.coalesce(F.sum("_n").over(along), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    known = offsets.alias("o").join(trees.alias("t"), F.expr("o.source <=> t.source")).select("_part", "o.source", "_shift", "tree", "n")
    ranked = cut.alias("c").join(known.alias("k"), F.expr("c._part = k._part and c.source <=> k.source"))
    own = [F.col(f"c.`{c}`") for c in rows.columns if c != "source"]
    return ranked.select("tree", (F.col("_in") + F.col("_shift")).alias("rank"), "n", *own), trees


def manifest(rows: DataFrame) -> Manifest:
    """The tree over ``rows``: ``source``, ``doc_id``, ``leaf`` (hexadecimal) and columns to carry along.

    Null sources are a source, the first; null ids come first in theirs. Rows of one id stand in the order of their
    digests; repeated rows are leaves of their own. No rows give no root. Every table is stored in the shared folder.
    """
    ranked, trees = _ranked(rows)
    leaves = materialize(ranked.withColumn("leaf", F.unhex("leaf")), "manifest-leaves")
    count, most = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    nodes, subroots = _grown(leaves.select("tree", "rank", F.col("leaf").alias("digest"), "n"), most or 0, "manifest")
    trees = materialize(trees.join(subroots.withColumnRenamed("digest", "subroot"), "tree"), "manifest-subroots")
    over = trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("subroot").alias("digest"))
    tops, root = _grown(over.withColumn("n", F.lit(count).cast("long")), count, "manifest-top")
    return Manifest(leaves.drop("n"), trees, nodes, tops, materialize(root.select(F.col("digest").alias("root")), "manifest-root"))


def _child(children: Column, digit: Column) -> Column:
    return F.substring(children, digit * WIDTH + 1, F.lit(WIDTH))


def _others(children: Column, digit: Column) -> Column:
    """All children but one."""
    return F.concat(
        F.substring(children, F.lit(1), digit * WIDTH),
        F.substring(children, (digit + 1) * WIDTH + 1, F.lit(FAN * WIDTH)),
    )


def _met(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """The nodes with ``_children``, or null where the records do not know the digest."""
    known = records.select(F.col("digest").alias("_digest"), F.col("children").alias("_children")).distinct()
    return frontier.join(known, F.col("digest") == F.col("_digest"), "left")


def _opened(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """One level down: nodes that the records know open into their children, others stay as they are."""
    met = _met(frontier, records)
    last = F.coalesce(F.expr(f"length(_children) div {WIDTH}").cast("int"), F.lit(1)) - 1
    each = met.select("*", F.explode(F.sequence(F.lit(0), last)).alias("_digit"))
    digit, children = F.col("_digit"), F.col("_children")
    stays = children.isNull()
    step = F.struct(digit.alias("digit"), _others(children, digit).alias("others"))
    return each.select(
        *[c for c in frontier.columns if c not in ("rank", "digest", "path")],
        F.when(stays, F.col("rank")).otherwise(F.col("rank") * FAN + digit).alias("rank"),
        F.when(stays, F.col("digest")).otherwise(_child(children, digit)).alias("digest"),
        F.when(stays, F.col("path")).otherwise(F.concat("path", F.array(step))).alias("path"),
    )


def _wanted(frontier: DataFrame, leaves: DataFrame, level: int) -> DataFrame:
    """The nodes of a level that have a wanted leaf below them."""
    up = leaves.select("tree", F.expr(f"rank div {FAN**level}").alias("rank")).distinct()
    return frontier.join(up, ["tree", "rank"], "left_semi")


def proofs(m: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``path``: from leaf to root, at each level which child the way comes
    from (``digit``) and the digests of the others, one after another.

    ``leaves`` (tree, rank, leaf, ...) asks for some of them; nodes without any below them are not opened.
    """
    at_root = m.root.select(
        F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("rank"), F.col("root").alias("digest"),
        F.array().cast(PATH).alias("path"), "root",
    )
    frontier = at_root
    for records in reversed(m.tops):
        frontier = _opened(frontier, records)
    # A subroot's place among its siblings is the number of its tree.
    at_subroot = F.lit(0).cast("long").alias("rank")
    frontier = frontier.select(F.col("rank").alias("tree"), at_subroot, "digest", "path", "root", F.col("digest").alias("subroot"))
    for level in range(len(m.nodes), 1, -1):
        frontier = _opened(frontier, m.nodes[level - 1])
        if leaves is not None:
            frontier = _wanted(frontier, leaves, level - 1)
        if level % STORED == 0:
            frontier = materialize(frontier, "manifest-descent")  # a plan of bounded depth
    # The leaves themselves meet the nodes of the lowest level.
    met = _met(frontier, m.nodes[0]) if m.nodes else frontier.withColumn("_children", F.lit(None).cast("binary"))
    parents = met.select(
        "tree", F.col("rank").alias("_up"), "path", "root", "subroot", F.col("_children").alias("children")
    )
    asked = m.leaves if leaves is None else leaves
    met = asked.withColumn("_up", F.expr(f"rank div {FAN}")).join(parents, ["tree", "_up"])
    digit = F.expr(f"cast(rank % {FAN} as int)")
    step = F.struct(digit.alias("digit"), _others(F.col("children"), digit).alias("others"))
    down = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(step)))
    return met.select(*asked.columns, "subroot", "root", F.reverse(down).alias("path"))


def siblings(path: Column) -> Column:
    """The digests of a path's siblings as hexadecimal text, level by level."""
    return F.array_join(F.transform(path, lambda s: hex_of(s["others"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hexadecimal) has by its path; a leaf that is a tree of its own needs no siblings."""

    def up(digest: Column, step: Column) -> Column:
        others = hex_of(step["others"])
        before = step["digit"] * 2 * WIDTH
        return combined(
            F.concat(F.substring(others, F.lit(1), before), digest, F.substring(others, before + 1, F.lit(2 * FAN * WIDTH)))
        )

    return F.aggregate(path, leaf, up)
