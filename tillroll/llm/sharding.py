"""Sharding by a weighted hash tree: region, rack and shard are drawn level by level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import ranking

# Regions of racks of shards; a number is a shard's weight. Shards are numbered in the order they stand here.
Tree = Sequence[Sequence[Sequence[float]]]

SHARDS = 16
TREE: Tree = ((((1.0,) * 2,) * 2),) * 4  # 4 regions of 2 racks of 2 shards, of one weight
# One more shard comes as a region of its own: no other subtree's weight changes, so rows move only into it.
GROWN: Tree = (*TREE, ((1.0,),))

ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
DRAWN = 1 << 52  # a draw has 52 bits, all of which a double holds


def draw(key: Column, path: Column) -> Column:
    """A number between 0 and 1, never either, that depends on the key and a node's path alone."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", key, path).cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(DRAWN)


def chosen(key: Column, above: Column, weights: Column, most: int) -> Column:
    """Number of the child that wins the weighted draw below the node ``above``.

    Child j draws -ln(u) / weight and the least wins, which child j does with probability weight / sum of
    weights. A child's draw depends on no other child: if one weight rises, keys move only to that child, if it falls,
    only away from it. Children of weight 0 never win; ties go to the first.
    """
    races = [
        F.struct(
            F.when(
                F.get(weights, F.lit(j)) > 0,
                -F.log(draw(key, F.concat_ws(".", above, F.lit(str(j))))) / F.get(weights, F.lit(j)),
            ).otherwise(float("inf")).alias("time"),
            F.lit(j).alias("child"),
        )
        for j in range(most)
    ]
    return F.array_min(F.array(*races))["child"]


def literal(values) -> Column:
    return F.array(*[literal(v) if isinstance(v, (list, tuple)) else F.lit(float(v)) for v in values])


def with_shard(rows: DataFrame, key: str, tree: Tree, out: str) -> DataFrame:
    """Adds the shard (int) that the text in column ``key`` falls into; it draws its way down level by level.

    A node weighs as much as its shards together. If the weight of a shard changes, so do those of its rack and its
    region, and keys move only into or out of these (with them, among the racks and shards there).
    """
    if not any(w > 0 for region in tree for rack in region for w in rack):
        raise ValueError("the tree has no shard with a weight")
    racks = [[sum(rack) for rack in region] for region in tree]
    firsts, n = [], 0
    for region in tree:
        firsts.append([])
        for rack in region:
            firsts[-1].append(n)
            n += len(rack)
    root = F.lit("r")
    region, rack = F.col(f"{out}_region"), F.col(f"{out}_rack")
    below_region = F.concat_ws(".", root, region.cast("string"))
    below_rack = F.concat_ws(".", root, region.cast("string"), rack.cast("string"))
    most = max(map(len, tree)), max(len(k) for r in tree for k in r)
    shard = chosen(F.col(key), below_rack, F.get(F.get(literal(tree), region), rack), most[1])
    return (
        rows.withColumn(f"{out}_region", chosen(F.col(key), root, literal([sum(r) for r in racks]), len(tree)))
        .withColumn(f"{out}_rack", chosen(F.col(key), below_region, F.get(literal(racks), region), most[0]))
        .withColumn(out, (F.get(F.get(literal(firsts), region), rack).cast("int") + shard).cast("int"))
        .drop(f"{out}_region", f"{out}_rack")
    )


def sharded(docs: DataFrame, tree: Tree = TREE, grown: Tree | None = GROWN) -> DataFrame:
    """Every row of ``docs`` with its shard: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is "key": doc_id and the tree alone decide on the shard, so rows of one doc_id stay together and
    texts play no part. grown_shard is the shard in the tree ``grown`` (missing without one). size is the bytes of the text
    and one more, text_crc32 its unsigned CRC (0 for a missing or empty text). slot numbers the rows of a
    shard from 0 without gaps, in the order of a hash of doc_id, doc_id, size, CRC and text hash; rows that
    agree in all of these are alike. They are numbered in slices of the whole order, so neither a shard nor a
    repeated doc_id is one task. A missing doc_id has the empty key. Other columns are left out; an empty table gives
    an empty result.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.col("text").cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        key.alias("key"),
        F.md5(key.cast("binary")).alias("key_hash"),
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("place"),  # only cuts runs of equal rows
    )
    rows = with_shard(rows, "key", tree, "shard")
    rows = rows.withColumn("grown_shard", F.lit(None).cast("int")) if grown is None else with_shard(rows, "key", grown, "grown_shard")
    order = [F.col(c) for c in ("key_hash", "doc_id", "size", "text_crc32", "text_hash", "place")]
    numbered = ranking.row_number(rows, order, "position", within=["shard"])
    return numbered.withColumn("slot", F.col("position") - 1).select("doc_id", *ADDED)
