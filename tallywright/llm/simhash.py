"""SimHash near-duplicates, with candidates discarded by a pivot distance table.

Fingerprints meet where they agree on chosen bits: all choices of BLOCKS - bits of BLOCKS blocks, on some of which two
fingerprints within ``bits`` bits always agree. Where they meet, each carries its Hamming distances to reference
fingerprints; a pair whose distances to any reference differ by more than ``bits`` can't link and is discarded before
it is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import id_and_text, stored
from tallywright.llm.hashing import mix

SEED = 42
BLOCKS = 7
PIVOTS = 16
#: A meeting of more fingerprints is split by their distance to the first reference, and further by hash.
MEETING = 2_000
#: Reference fingerprints, drawn at random once, from a fixed seed.
REFERENCES = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def block_masks(bits: int) -> list[int]:
    """Masks of each choice of BLOCKS - bits blocks of the 64 bits."""
    edges = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, BLOCKS - bits)]


def fingerprint(text: str, shingle: int) -> int:
    """The bits set in over half of the XXH64 hashes of the text's shingles, repeats included. No words: 0."""
    parts = text.encode().lower().split()  # bytes: A-Z only, and white space \x20 \x09-\x0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(1, len(parts) - shingle + 1)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    digest, starts = xxhash.xxh64_intdigest, (ends - sizes)[:n].tolist()
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, ends[-n:].tolist(), strict=True)], np.uint64, n)
    votes = np.zeros(64, np.int64)
    for k in range(0, n, 4096):
        votes += np.unpackbits(hashes[k : k + 4096, None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, carry: str | None = None) -> DataFrame:
    """(doc_id, carried, print): the SimHash of each whole text, as a signed long."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py(), shingle) for x in batch["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["carried"], pa.array(prints)], ["doc_id", "carried", "print"])

    return id_and_text(docs, carry).mapInArrow(of, "doc_id long, carried string, print long")


def distances(prints: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints ^ other).astype(np.int32)


def linked(left: np.ndarray, right: np.ndarray | None, bits: int) -> list[int]:
    """Which fingerprints the links within ``left``, or between it and ``right``, connect: a place for each of left,
    then right, equal for connected ones. Rows of the pivot table are compared before fingerprints are.
    """
    other = left if right is None else right
    own_table, table = (distances(x[:, None], REFERENCES) for x in (left, other))
    shift = 0 if right is None else len(left)
    root = list(range(len(left) + (0 if right is None else len(right))))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(left)):
        near = np.arange(i + 1 if right is None else 0, len(other))
        for k in range(PIVOTS):  # the largest difference of coordinates is a lower bound of the distance
            near = near[np.abs(table[near, k] - own_table[i, k]) <= bits]
            if not len(near):
                break
        near = near[distances(other[near], left[i]) <= bits]
        for j in near.tolist():
            x, y = find(i), find(j + shift)
            root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(root))]


def meetings(prints: DataFrame, bits: int) -> DataFrame:
    """(key, near, node): where each fingerprint meets others, and its distance to the first reference."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.array(block_masks(bits), np.uint64)
        for batch in batches:
            for first in range(0, len(batch), 1_000):
                part = batch.slice(first, 1_000)
                words = part["node"].to_numpy().view(np.uint64)
                keys = words[:, None] & masks
                n = keys.shape[1]
                keys = mix(keys ^ mix(np.arange(1, n + 1, dtype=np.uint64))).view(np.int64)  # of the way and the bits
                near = distances(words, REFERENCES[0])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(near, n)), pa.array(np.repeat(part["node"].to_numpy(), n))], ["key", "near", "node"])

    return prints.mapInArrow(meet, "key long, near int, node long")


def links(prints: DataFrame, bits: int) -> DataFrame:
    """(a, b): pairs of the fingerprints of ``prints`` (node) that connect all that meet within ``bits`` bits.

    A group gives one pair for each node that it connects, with the least node of its part, so that pairs of different
    meetings are mostly the same ones.

    Those that meet are compared within one group; large meetings are split first by the distance to the first
    reference, whose values further apart than ``bits`` can't link, and by a hash of the node, and every two parts
    that may link form a group. So a group never exceeds about twice MEETING.
    """
    met = meetings(prints, bits)
    # numbers of members: of each meeting, and of each of its distances
    sizes = met.groupBy("key", "near").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.groupBy("key").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("near", "n"))).alias("by_near")).where("total > 1")
    # Spark sizes both sides as if each fingerprint met once, and would broadcast what is many times as large
    met = met.hint("merge").join(total, "key").withColumn("by_near", F.when(F.col("total") > MEETING, F.col("by_near")))
    parts = lambda near: F.ceil(F.coalesce(F.element_at("by_near", near), F.lit(0)) / F.lit(MEETING)).cast("int")
    own = F.struct(F.col("near").alias("near"), F.pmod(F.xxhash64("node"), parts(F.col("near"))).cast("int").alias("part"))
    near_parts = F.flatten(F.transform(
        F.sequence(F.col("near") - bits, F.col("near") + bits),
        lambda d: F.when(parts(d) > 0, F.transform(F.sequence(F.lit(0), parts(d) - 1), lambda p: F.struct(d.alias("near"), p.alias("part")))).otherwise(F.array().cast("array<struct<near:int,part:int>>")),
    ))
    one = F.array(F.struct(F.lit(-1).alias("near"), F.lit(0).alias("part")))
    met = met.withColumn("own", F.when(F.col("by_near").isNull(), one[0]).otherwise(own))
    met = met.withColumn("other", F.explode(F.when(F.col("by_near").isNull(), one).otherwise(near_parts)))
    met = met.select("key", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "node", (F.col("own") > F.col("other")).alias("right"))
    groups = met.groupBy("key", "first", "second").agg(F.collect_list(F.struct("node", "right")).alias("members"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, a, b = batch["members"], [], []
            ends = lists.offsets.to_numpy()
            nodes, right = lists.values.field("node").to_numpy(), lists.values.field("right").to_numpy(zero_copy_only=False)
            words = nodes.view(np.uint64)
            for alone, x, y in zip(batch["alone"].to_pylist(), ends, ends[1:], strict=False):
                order = np.arange(x, y) if alone else np.concatenate((x + np.flatnonzero(~right[x:y]), x + np.flatnonzero(right[x:y])))
                cut = y - x if alone else int((~right[x:y]).sum())
                place = np.array(linked(words[order[:cut]], None if alone else words[order[cut:]], bits))
                own, low = nodes[order], np.full(y - x, np.iinfo(np.int64).max)
                np.minimum.at(low, place, own)
                joined = own != low[place]
                a.extend(low[place][joined].tolist())
                b.extend(own[joined].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    groups = groups.select((F.col("first") == F.col("second")).alias("alone"), "members")
    return groups.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches; ``edges`` (a, b) of longs.

    First every node is tied to its smallest neighbour only, and its other smaller neighbours to that one, which leaves
    few links of a dense group. Each round then points every node at the smallest one among its neighbours' and then at
    that one's own, and stops when nothing changes. Rounds are written to the shared folder, so that lost executors cost one round.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tied = edges.withColumn("low", F.min("a").over(Window.partitionBy("b")))
    edges = tied.select(F.col("low").alias("a"), "b").union(tied.where("a <> low").select("low", "a")).distinct()
    both = stored(edges.union(edges.select("b", "a")).distinct(), "links")
    state = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    while True:
        around = both.join(state.select(F.col("node").alias("b"), F.col("root").alias("seen")), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        nearer = state.join(around.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "seen").alias("low"))
        # hooks the old root too, so that trees merge at once
        hooks = nearer.where("low < root").groupBy(F.col("root").alias("node")).agg(F.min("low").alias("hook"))
        nearer = nearer.join(hooks, "node", "left").select("node", "root", F.least("low", "hook").alias("low"))
        jump = nearer.select(F.col("node").alias("low"), F.col("low").alias("far"))
        after = stored(nearer.join(jump, "low").select("node", "root", F.least("low", "far").alias("new")), "roots")
        if after.where("new <> root").isEmpty():
            return after.select("node", F.col("new").alias("root"))
        state = after.select("node", F.col("new").alias("root"))


def named_groups(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``classes`` (node, first, ...) with root and component_id, the least ``first`` of the root's classes.

    Nodes are no doc_ids: a component's name is null only if no class of it has an id.
    """
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(names, "root")


def groups(docs: DataFrame, words: int = 4, bits: int = 4, carry: str | None = None) -> DataFrame:
    """(doc_id, carried, print, root, component_id) of each row; see ``near_duplicates``.

    ``carried`` is the column ``carry`` as text. Rows of one ``root`` form a group, with or without doc_ids.
    Each distinct fingerprint is compared once, whatever its copies.
    """
    prints = stored(fingerprints(docs, words, carry), "fingerprints")
    distinct = stored(prints.groupBy(F.col("print").alias("node")).agg(F.min("doc_id").alias("first")), "classes")
    roots = components(stored(links(distinct.select("node"), bits), "links"))
    return prints.join(named_groups(distinct, roots).select(F.col("node").alias("print"), "root", "component_id"), "print")


def near_duplicates(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """Groups of documents that links between 64-bit SimHash fingerprints connect; no link is missed.

    Shingles are ``words`` words of the text, A-Z lower-cased, repeats included; a shorter text is one shingle, a text
    without words (a null one too) has fingerprint zero. Fingerprints link at ``bits`` or fewer differing bits. Returns
    doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id of the group) for each row. A null doc_id
    stays null and isn't a component's name unless no other is there; rows that repeat a doc_id are judged by their own
    texts, those that repeat a text are copies; an empty table gives no rows. Other columns go.
    """
    out = groups(docs, words, bits)
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
