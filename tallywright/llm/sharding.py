"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each node every child draws ``-ln(u) / weight`` with u hashed from the
seed, the child's name and the row's key; the least draw wins. A child whose weight is unchanged keeps its draw, so a
row moves only into a child that got heavier or out of one that got lighter, and nothing moves in other subtrees.
A subtree is added or removed whole for that to hold down to the shard; ``grown`` opens a new region for an added shard.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import gapless, hex_draw

Node = dict[str, "Node | float"]


def tree(shards: int, racks: int = 2, per_rack: int = 2) -> Node:
    """Regions of ``racks`` racks of ``per_rack`` shards of weight 1, the last ones maybe smaller."""
    root: Node = {}
    for shard in range(shards):
        rack = shard // per_rack
        root.setdefault(f"region{rack // racks}", {}).setdefault(f"rack{rack}", {})[str(shard)] = 1.0
    return root


def grown(shards: int, racks: int = 2, per_rack: int = 2) -> Node:
    """``tree(shards)`` and one shard more, alone in a region of its own, so that rows move into it only."""
    rack, region = -(-shards // per_rack), -(-shards // (racks * per_rack))
    return {**tree(shards, racks, per_rack), f"region{region}": {f"rack{rack}": {str(shards): 1.0}}}


def weight(node: Node | float) -> float:
    return sum(map(weight, node.values())) if isinstance(node, dict) else float(node)


def levels(root: Node) -> list[dict[str, list[tuple[str, float]]]]:
    """Per level, the children and weights of each node, by its name."""
    out, nodes = [], {"": root}
    while nodes:
        out.append({name: [(child, weight(below)) for child, below in node.items() if weight(below) > 0] for name, node in nodes.items()})
        nodes = {child: below for node in nodes.values() for child, below in node.items() if isinstance(below, dict) and weight(below) > 0}
    return out


def place(key: Column, root: Node, seed: int = 0) -> Column:
    """The leaf that ``key`` comes to, as an integer. A null key is drawn for like an empty one."""
    def least(children: Column, node: Column) -> Column:
        draw = lambda c: -F.log((hex_draw(seed, c["child"], key) + 1) / F.lit(float(2**52))) / c["weight"]
        return F.array_min(F.transform(F.element_at(children, node), lambda c: F.struct(draw(c).alias("draw"), c["child"].alias("child"))))["child"]

    at = F.lit("")
    for level in levels(root):
        children = F.create_map(*[
            x for name, below in level.items()
            for x in (F.lit(name), F.array(*[F.struct(F.lit(c).alias("child"), F.lit(w).alias("weight")) for c, w in below]))
        ])
        # a one-element array binds the node to a lambda variable, so that it is found once
        at = F.transform(F.array(at), partial(least, children))[0]
    return at.cast("int")


def shard(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """Every row of ``docs`` in a shard from 0 to ``shards`` - 1 by its doc_id, under the law ``key``.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot (gapless from 0 in its shard)
    and grown_shard (with one shard more). A null text is empty and a null doc_id a key like any other; repeated rows
    share a shard and have slots of their own; ties of slots go by doc_id, size and checksum. An empty table gives
    no rows. Other columns go.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), place(F.col("doc_id"), tree(shards), seed).alias("shard"), place(F.col("doc_id"), grown(shards), seed).alias("grown_shard"),
    )
    out = gapless(rows, ["shard"], [F.col("doc_id"), F.col("size"), F.col("text_crc32")], "slot", F.xxhash64("doc_id", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
