"""Operator 12: Merkle manifest of a dataset by nested-struct rollups.

A row's leaf is a hash of its columns.  The leaves of a group (``lang``) are
ranked by ``doc_id``; consecutive pairs are hashed level by level into the
group's subroot, and the subroots in the same way into the root.

The rank's low ``BITS`` binary digits are columns that are grouped away one
by one inside a block of at most 2^BITS nodes, each time nesting the child
structs in their parent; one shuffle by block serves all of them.  The block
roots are the nodes of the next tier.  On the way down a block meets the path
above it in one grouping by block (one row of each), and a transform over the
nested struct followed by an explode gives every child its path: no joins.

Defined cases: a null column counts as ``-``; a null ``doc_id`` ranks first;
rows that repeat a ``doc_id`` rank by their leaf, and rows equal in all five
columns are leaves of their own side by side; a null ``lang`` is a group; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import cut, positions, tasks

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 6
_PATH = "array<struct<sibling:string,left:boolean>>"


def leaf_hash(**replaced: Column) -> Column:
    """Hash of a row's columns, each ``-`` or its UTF-8 length, a colon and its value."""
    def coded(name):
        value = replaced.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[coded(c) for c in COLUMNS]), 256)


def _nodes_left(level: int) -> Column:
    """Number of a group's nodes at ``level`` of the tier."""
    return F.ceil(F.col("total") / F.lit(float(1 << level)))


def _roll(nodes: DataFrame) -> DataFrame:
    """``grp, pos, total, node`` -> one row per block: ``grp, pos, total, tree``.

    ``node`` is a struct that leads with its hash ``h``; ``tree`` holds ``h``,
    whether the level was hashed, and its children, ``BITS`` levels deep.
    """
    digits = [f"d{i}" for i in range(BITS)]
    level = nodes.select(
        "grp", F.shiftright("pos", BITS).alias("pos"), "total", "node",
        *[F.shiftright("pos", i).bitwiseAND(F.lit(1)).cast("int").alias(d)
          for i, d in enumerate(digits)]).repartition("grp", "pos")
    for i, digit in enumerate(digits):
        level = level.groupBy("grp", "pos", "total", *digits[i + 1:]).agg(
            F.sort_array(F.collect_list(F.struct(F.col(digit).alias("digit"), "node"))).alias("kids"))
        hashed = _nodes_left(i) > 1
        joined = F.array_join(F.transform("kids", lambda k: k["node"]["h"]), "")
        level = level.withColumn("node", F.struct(
            F.when(hashed, F.sha2(joined, 256)).otherwise(joined).alias("h"),
            hashed.alias("hashed"),
            F.transform("kids", lambda k: k["node"]).alias("kids"))).drop("kids")
    return level.withColumnRenamed("node", "tree")


def _expand(items: Column) -> Column:
    """One level down: each child with the path above it, its sibling in front."""
    def children(item):
        node = item["node"]

        def child(kid, i):
            step = F.struct(F.when(F.size(node["kids"]) > 1, F.get(node["kids"], 1 - i)["h"])
                            .alias("sibling"), (i == 1).alias("left"))
            path = F.when(node["hashed"], F.concat(F.array(step), item["path"])).otherwise(item["path"])
            return F.struct(kid.alias("node"), path.alias("path"))
        return F.transform(node["kids"], child)
    return F.flatten(F.transform(items, children))


def _emit(tier: DataFrame, above: DataFrame | None) -> DataFrame:
    """``grp, node, path, subroot, root`` of every node that a tier's blocks were made of.

    ``above``: ``grp, pos, path, subroot, root`` of every block; without it
    the blocks are roots.
    """
    if above is None:
        met = tier.select("grp", "tree", F.array().cast(_PATH).alias("path"),
                          F.lit(None).cast("string").alias("subroot"), F.col("tree.h").alias("root"))
    else:
        up = above.select("grp", "pos", F.struct("path", "subroot", "root").alias("up"))
        met = (tier.select("grp", "pos", "tree").unionByName(up, allowMissingColumns=True)
               .groupBy("grp", "pos")
               .agg(F.any_value("tree", True).alias("tree"), F.any_value("up", True).alias("up"))
               .select("grp", "tree", "up.*"))
    first = F.array(F.struct(F.col("tree").alias("node"), "path"))
    leaves = reduce(lambda items, _: _expand(items), range(BITS), first)
    return (met.select("grp", "subroot", "root", F.explode(leaves).alias("item"))
            .select("grp", "item.node", "item.path", "subroot", "root"))


def _in_few(df: DataFrame, n: int) -> DataFrame:
    """``df`` made of ``n`` nodes, in no more partitions than these or the cores ask for.

    Every partition is a file of a checkpoint or of the result, empty or not.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, tasks(n)))


def _tiers(nodes: DataFrame, most: int, n: int) -> list[DataFrame]:
    """Blocks of nodes, blocks of their roots, and so on, until a group is one block.

    ``nodes`` are ``n``, of which one group has ``most``.
    """
    tiers = [cut(_in_few(_roll(nodes), n))]
    while most > 1 << BITS:
        most = -(-most // (1 << BITS))
        # a block's root carries its place: on the way down it names the block
        tiers.append(cut(_in_few(_roll(tiers[-1].select(
            "grp", "pos", _nodes_left(BITS).cast("long").alias("total"),
            F.struct(F.col("tree.h").alias("h"), F.col("pos").alias("pos")).alias("node"))), n)))
    return tiers


def _descend(tiers: list[DataFrame], above: DataFrame | None) -> DataFrame:
    for tier in reversed(tiers[1:]):
        above = _emit(tier, above).select("grp", F.col("node.pos").alias("pos"), "path",
                                          "subroot", "root")
    return _emit(tiers[0], above)


def _sizes(ranked: DataFrame) -> tuple[int, int]:
    """Rows of the largest group, and of all groups."""
    most, n = ranked.agg(F.max("_total"), F.count(F.lit(1))).first()
    return int(most or 0), n


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, changed_leaf, subroot, root, path`` of every row.

    ``path`` lists the steps from the leaf to the root: the sibling's hash
    (null for a node without one) and whether it stands on the left.
    ``tampered`` is another leaf of the row, kept beside the true one.
    """
    changed = tampered if tampered is not None else F.lit(None).cast("string")
    leaves = docs.select("doc_id", "lang", leaf_hash().alias("leaf"), changed.alias("changed"),
                         F.monotonically_increasing_id().alias("tie"))
    # rows equal in all columns may be many: the last order column spreads them
    ranked = positions(leaves, [F.col(c) for c in ("lang", "doc_id", "leaf", "tie")], within="lang")
    most, n = _sizes(ranked)
    tiers = _tiers(ranked.select(
        F.col("lang").alias("grp"), F.col("_pos").alias("pos"), F.col("_total").alias("total"),
        F.struct(F.col("leaf").alias("h"), "doc_id", "changed").alias("node")), most, n)

    subroots = tiers[-1].select(F.col("grp").alias("lang"), F.col("tree.h").alias("h"))
    ordered = positions(subroots, [F.col("lang")])
    top = _tiers(ordered.select(
        F.lit(0).alias("grp"), F.col("_pos").alias("pos"), F.col("_total").alias("total"),
        F.struct("h", "lang").alias("node")), *_sizes(ordered))
    above = _descend(top, None).select(F.col("node.lang").alias("grp"), F.lit(0).cast("long").alias("pos"),
                                       "path", F.col("node.h").alias("subroot"), "root")
    return _in_few(_descend(tiers, above), n).select(
        "node.doc_id", F.col("node.h").alias("leaf"), F.col("node.changed").alias("changed_leaf"),
        "subroot", "root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    def step(h, p):
        both = F.when(p["sibling"].isNull(), h).when(p["left"], F.concat(p["sibling"], h)) \
                .otherwise(F.concat(h, p["sibling"]))
        return F.sha2(both, 256)
    return F.aggregate(path, leaf, step)
