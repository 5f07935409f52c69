"""A Merkle manifest of a table: incremental witnesses.

Leaves are appended in order to a list of open subtrees. A leaf's witness, the siblings on its way up, is attached when
its subtree is opened and grows whenever a later sibling is complete. A table is appended in aligned blocks by many
tasks at once; the roots of the blocks are appends to the level above, in blocks again, until one root is left for each
group. The roots of the groups are the appends of a last tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import stored

#: Leaves of a block: a power of two, so that blocks are whole subtrees. A task holds one block and its witnesses.
BLOCK = 1 << 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A step of a witness: on which side of the node its sibling is, and the sibling's digest; empty where there is none.
LEFT, RIGHT, ALONE = "<", ">", ""
ROOTS = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("leaf", pa.string())])
WITNESSED = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("leaf", pa.string()), ("carried", pa.string()), ("witness", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())])
#: Makes rows of a block's rows, nodes, witnesses and root.
Emit = Callable[[list[dict], list[dict], list[list[str]], str], list[dict]]


def digest(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """The digest of a row: each value ``-`` if null, else its length in UTF-8 bytes, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(node: Column, witness: Column) -> Column:
    """The root that ``node`` and its ``witness`` lead to."""
    def up(below: Column, step: Column) -> Column:
        other = F.substring(step, 2, 64)
        return F.sha2(F.when(step.startswith(LEFT), F.concat(other, below)).when(step.startswith(RIGHT), F.concat(below, other)).otherwise(below), 256)

    return F.aggregate(witness, node, up)


def proof(witness: Column) -> Column:
    """The digest of all siblings of a witness, from leaf to root."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: F.substring(step, 2, 64)), ""), 256)


class Subtrees:
    """Open subtrees of a block, widest first: (height, root, first leaf), and the witnesses of its leaves."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int]] = []
        self.witnesses: list[list[str]] = []

    def append(self, node: str) -> None:
        self.open.append((0, node, len(self.witnesses)))
        self.witnesses.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join()

    def _extend(self, first: int, last: int, step: str) -> None:
        for witness in self.witnesses[first:last]:
            witness.append(step)

    def _join(self) -> None:
        _, right, middle = self.open.pop()
        height, left, first = self.open.pop()
        self._extend(first, middle, RIGHT + right)
        self._extend(middle, len(self.witnesses), LEFT + left)
        self.open.append((height + 1, digest(left, right), first))

    def _lift(self) -> None:
        """The last subtree has no sibling at its height."""
        height, node, first = self.open.pop()
        self._extend(first, len(self.witnesses), ALONE)
        self.open.append((height + 1, digest(node), first))

    def close(self, height: int | None) -> str:
        """The root of all leaves, at ``height``, or as soon as one node is left."""
        while len(self.open) > 1:
            if self.open[-1][0] == self.open[-2][0]:
                self._join()
            else:
                self._lift()
        while height is not None and self.open[-1][0] < height:
            self._lift()
        return self.open[-1][1]


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (grp, leaf, ...) with n, the nodes of their group, and pos from 0 in it, by ``order``.

    Rows are dealt to ranges of group and order; a row's place is its place in its range plus the group's rows in the
    ranges before, so only counts of groups and ranges meet. Rows equal in all columns are interchangeable and spread by
    their numbers in the files, so that no range must hold them all.
    """
    by = ["grp", *order, "leaf", "spread"]
    ranged = nodes.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("spread")
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "ordered")  # ascends with range and place
    part = F.shiftright("at", 33)
    counts = ranged.groupBy("grp", part.alias("part")).agg(F.count(F.lit(1)).alias("own"), F.min("at").alias("first"))
    by_group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("own").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("grp").alias("grp_"), F.col("part").alias("part_"), (F.col("first") - before).alias("shift"), F.sum("own").over(by_group).alias("n"))
    counts = stored(counts, "ranges")
    placed = ranged.join(counts, F.col("grp").eqNullSafe(F.col("grp_")) & (part == F.col("part_")))
    return placed.withColumn("pos", F.col("at") - F.col("shift")).drop("at", "grp_", "part_", "shift")


def appended(batches: Iterator[pa.RecordBatch], emit: Emit, size: int) -> Iterator[pa.RecordBatch]:
    """What ``emit`` makes of the rows and subtrees of each block; rows come in order of grp, block and pos."""
    block: tuple | None = None
    rows: list[dict] = []

    def done() -> list[dict]:
        trees = Subtrees()
        nodes = [r for r in rows if r["pos"] >= 0]
        for r in nodes:
            trees.append(r["leaf"])
        root = trees.close(size.bit_length() - 1 if nodes[0]["n"] > size else None)
        return emit(rows, nodes, trees.witnesses, root)

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if block != (row["grp"], row["block"]):
                out.extend(done() if rows else [])
                block, rows = (row["grp"], row["block"]), []
            rows.append(row)
        if out:
            yield from pa.Table.from_pylist(out).to_batches()
    if rows:
        yield from pa.Table.from_pylist(done()).to_batches()


def blocks(nodes: DataFrame, size: int) -> DataFrame:
    """``nodes`` with the number of their block, the blocks each in one partition and in order."""
    nodes = nodes.withColumn("block", F.expr(f"if(pos < 0, -1 - pos, pos div {size})"))
    return nodes.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def block_roots(nodes: DataFrame, size: int) -> DataFrame:
    """(grp, pos, n, leaf): the roots of the blocks of ``nodes`` (grp, pos, n, leaf), which are nodes of the next level."""
    def roots(rows: list[dict], nodes: list[dict], witnesses: list[list[str]], root: str) -> list[dict]:
        return [{"grp": rows[0]["grp"], "pos": rows[0]["block"], "n": -(-nodes[0]["n"] // size), "leaf": root}]

    return blocks(nodes.select("grp", "pos", "n", "leaf"), size).mapInArrow(lambda b: _typed(appended(b, roots, size), ROOTS), "grp string, pos long, n long, leaf string")


def _typed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch[f.name].cast(f.type) for f in schema], schema=schema)


def witnessed(nodes: DataFrame, above: DataFrame, size: int) -> DataFrame:
    """``nodes`` (grp, pos, n, leaf, carried) with their witnesses, from those of their blocks' roots: ``above`` (grp,
    pos, witness, subroot, root). The row of a block's root goes before its nodes, so no witness is shuffled for a node."""
    def extended(rows: list[dict], nodes: list[dict], witnesses: list[list[str]], _: str) -> list[dict]:
        head = rows[0]
        return [
            {"grp": r["grp"], "pos": r["pos"], "leaf": r["leaf"], "carried": r["carried"], "witness": own + head["witness"], "subroot": head["subroot"], "root": head["root"]}
            for r, own in zip(nodes, witnesses, strict=True)
        ]

    own = nodes.select("grp", "pos", "n", "leaf", "carried")
    heads = above.select("grp", (-1 - F.col("pos")).alias("pos"), "witness", "subroot", "root")
    rows = blocks(own.unionByName(heads, allowMissingColumns=True), size)
    schema = "grp string, pos long, leaf string, carried string, witness array<string>, subroot string, root string"
    return rows.mapInArrow(lambda b: _typed(appended(b, extended, size), WITNESSED), schema)


def ascended(nodes: DataFrame, size: int) -> list[DataFrame]:
    """``nodes`` and the levels of block roots above them; the last one has one node for each group."""
    levels = [nodes]
    while True:
        levels.append(stored(block_roots(levels[-1], size), "roots"))
        if levels[-1].where("n > 1").isEmpty():
            return levels


def descended(levels: list[DataFrame], tops: DataFrame, size: int) -> DataFrame:
    """The first level's nodes with their witnesses, from those of the groups: ``tops`` (grp, witness, subroot, root)."""
    above = tops.withColumn("pos", F.lit(0).cast("long"))
    for k, level in enumerate(reversed(levels[:-1]), 2 - len(levels)):
        above = witnessed(level if "carried" in level.columns else level.withColumn("carried", F.lit(None).cast("string")), above, size)
        if k < 0:
            above = stored(above, "witnesses")
    return above


def manifest(rows: DataFrame, group: str = "lang", order: list[str] | None = None, carry: str | None = None, size: int = BLOCK) -> DataFrame:
    """The Merkle tree of ``rows`` (leaf, ``group``, ``order``...) with a witness for each row.

    Each group's leaves ascend by ``order`` (doc_id by default); while several nodes remain, every two consecutive ones
    become the digest of both, and a last one the digest of itself. The roots of the groups, in order of the group's
    text with null first, form the last tree in the same way. Returns ``grp``, leaf, carried (the column ``carry`` as
    text), pos in the group, witness (the steps from leaf to root, see ``fold``), subroot and root for each row.
    ``size``, a power of two, is the number of nodes that one task appends at a time; it changes no result. Nulls
    of ``order`` come first; rows that tie in it ascend by leaf; an empty table gives no rows. Other columns go.
    """
    order = order or ["doc_id"]
    carried = F.col(carry) if carry else F.lit(None)
    own = rows.select(F.col(group).cast("string").alias("grp"), F.col("leaf"), carried.cast("string").alias("carried"), *[F.col(c).alias(f"by_{k}") for k, c in enumerate(order)])
    levels = ascended(numbered(own, [f"by_{k}" for k in range(len(order))]), size)
    # the tree of the groups: all in one group of their own, each carrying its name
    groups = levels[-1].select(F.lit("").alias("grp"), "leaf", F.col("grp").alias("carried"))
    upper = ascended(numbered(groups, ["carried"]), size)
    top = upper[-1].select("grp", F.array().cast("array<string>").alias("witness"), F.col("leaf").alias("subroot"), F.col("leaf").alias("root"))
    tops = descended(upper, top, size).select(F.col("carried").alias("grp"), "witness", F.col("leaf").alias("subroot"), "root")
    return descended(levels, stored(tops, "tops"), size)
