"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards with weights.  A row descends it: at every node each child draws
-ln(u) / weight with u hashed from the row's key and the child's path, and the lowest draw wins, so a child
gets rows in proportion to its weight.  A draw depends on no other child.  When a weight changes, rows only
move into or out of the changed child, and below it only where weights changed too; all other subtrees
keep their rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

#: Shards of a region and of a rack in the tree of a given number of shards.
REGION, RACK = 8, 4
#: Hexadecimal digits of the hash that make u.
DIGITS = 12

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]


def tree_of(shards: int, base: int = 24) -> Tree:
    """The tree of ``shards`` shards of weight 1: the first ``base`` in regions of REGION and racks of RACK.

    Every further shard opens a region of its own, so what it draws goes to it alone and no other subtree's
    weight changes: one more shard takes rows only into itself.
    """
    tree: Tree = {}
    for s in range(shards):
        region, rack = (f"r{s // REGION}", f"k{s // RACK}") if s < base else (f"r+{s}", f"k+{s}")
        tree.setdefault(region, {}).setdefault(rack, {})[s] = 1.0
    return tree


def weight(node) -> float:
    return math.fsum(map(weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, path: str, w: float) -> Column:
    """An exponential draw of rate ``w``, from the first DIGITS digits of md5(path|key)."""
    u = F.conv(F.substring(F.md5(F.concat(F.lit(path + "|"), key).cast("binary")), 1, DIGITS), 16, 10).cast("double")
    return -F.log((u + 0.5) / float(16 ** DIGITS)) / w


def descend(rows: DataFrame, key: Column, tree: Tree, out: str) -> DataFrame:
    """Add the column ``out``: the shard that each row's key is led to.  Children without weight get nothing."""
    if not weight(tree) > 0:
        raise ValueError("A tree has at least one shard of positive weight.")
    nodes = {"": tree}
    rows = rows.withColumn(out, F.lit(""))
    while nodes:  # a column a level, so that each draw is taken once
        path, below = None, {}
        for name, node in nodes.items():
            children = {f"{name}/{c}": child for c, child in node.items() if weight(child) > 0}
            drawn = [F.struct(_draw(key, c, weight(child)).alias("draw"), F.lit(c).alias("path")) for c, child in children.items()]
            led = F.least(*drawn)["path"] if len(drawn) > 1 else F.lit(next(iter(children)))
            path = F.when(F.col(out) == name, led) if path is None else path.when(F.col(out) == name, led)
            below |= {c: child for c, child in children.items() if isinstance(child, dict)}
        rows, nodes = rows.withColumn(out, path), below
    return rows.withColumn(out, F.substring_index(out, "/", -1).cast("int"))


def assign(docs: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text",
           keep_columns: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (and the table's own columns behind, if asked).

    The law is ``key``: id and tree decide.  ``size`` is the text's UTF-8 bytes plus 8; a NULL text counts
    as empty.  Rows with equal ids, a NULL id among them, go to one shard, each to its own slot.  Slots
    run gapless from 0 in every shard by id (NULL first), then checksum and size.  A row's slot is its
    rank in its block, a range of ids, plus the rows of the shard in the blocks before, so no task ever holds a
    shard, nor all rows of one id.  An empty table gives no rows.  Columns of the table that clash with a
    result's name go; names that begin with an underscore are kept for inner use and go too.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    results = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    kept = [F.col(c) for c in docs.columns if c not in results and c[:1] != "_"] if keep_columns else []
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + F.lit(8).cast("long")).alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"), key.alias("_key"),
                       F.monotonically_increasing_id().alias("_row"), *kept)
    rows = descend(rows, F.col("_key"), tree, "shard")
    rows = descend(rows, F.col("_key"), grown, "grown_shard") if grown else rows.withColumn("grown_shard", F.lit(None).cast("int"))
    rows = checkpoint(rows.drop("_key"), "shard-rows")
    order = ["doc_id", "text_crc32", "size", "_row"]
    rows = checkpoint(rows.repartitionByRange(*order).withColumn("_block", F.spark_partition_id()), "shard-blocks")
    counts = rows.groupBy("shard", "_block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order)) - 1
    return (rows.withColumn("_rank", rank).join(starts, ["shard", "_block"])
            .withColumn("slot", F.col("_start") + F.col("_rank")).select(*results, *kept))


def write_shards(docs: DataFrame, path: str, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write whole rows as Parquet in one folder a shard, in files cut by slot; returns what was written."""
    placed = assign(docs, tree, None, id_col, text_col, keep_columns=True).drop("grown_shard")
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
    return docs.sparkSession.read.parquet(path)
