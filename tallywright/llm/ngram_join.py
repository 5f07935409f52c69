"""Similarity join on sets of word n-grams: rare-first prefixes with length, positional and suffix filters.

All sets list their n-grams in one order, rare ones first. Sets of n and m n-grams that share enough of them share one
among the first few of either, so only those prefixes meet. Where two meet first, their places bound what they can
share (positions), and so do their numbers (lengths). What is left of a pair is bounded by counts of n-grams in ranges
of hashes (suffixes), and the pairs that pass all bounds are verified on their texts, once each.

What is asked for is components, so a pair that is connected already needs no look: n-grams that few sets share give
all their pairs at once; where many meet, each is first compared with the least edited one of them, and then only pairs
of different components are left, which are compared in blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import id_and_text, stored
from tallywright.llm.hashing import BASES, prefix_sums, ranges, slices, word_bounds, word_hashes
from tallywright.llm.simhash import components

#: Occurrences of n-grams are counted in so many cells by hash, over all documents: what makes an n-gram rare. The
#: counts settle the order only, so cells that n-grams share cost time, never a pair.
CELLS = 1 << 20
CHUNK = 1 << 12
#: Sets met by no more than so many others at an n-gram give all their pairs at once.
FEW = 16
#: Rows of a block where many meet.
BLOCK = 1_000
#: Candidates of a set that are verified in each round; the last round takes all that are left.
ROUNDS = (4, 32, None)
#: Texts that a task has seen; their copies give no prefixes of their own.
SEEN = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, two names of each row's words, row and hash of each distinct n-gram), rows and hashes ascending.

    A-Z are lower-cased; a text of fewer words is one n-gram, a text without words has none.
    """
    for first, data, offsets in slices(texts):
        data = LOWER[data]
        starts, ends, heads = word_bounds(data, offsets)
        hashes, counts = word_hashes(data, starts, ends), np.diff(heads)
        names = np.stack([ranges(prefix_sums(hashes, b), b, heads[:-1], heads[1:]).view(np.int64) for b in (BASES[2], BASES[1])])
        n = np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)
        row = np.repeat(np.arange(len(counts)), n)
        begin = heads[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        shingle = ranges(prefix_sums(hashes, BASES[1]), BASES[1], begin, np.minimum(begin + words, heads[row + 1]))
        order = np.lexsort((shingle, row))
        row, shingle = row[order], shingle[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
        yield first, names, row[new], shingle[new]


def cell_of(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(CELLS - 1)).astype(np.int64)


def shingled(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, mark, name, more, n) of each row of ``docs`` (doc_id, mark, text): its words by two hashes and its number
    of n-grams; and from each task (chunk, cells): its counts of n-grams by cell."""
    fields = {"doc_id": pa.int64(), "mark": pa.string(), "name": pa.int64(), "more": pa.int64(), "n": pa.int64(), "chunk": pa.int32(), "cells": pa.binary()}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.uint32)
        for batch in batches:
            found = []
            for _, names, row, shingle in shingle_sets(batch["text"], words):
                counts += np.bincount(cell_of(shingle), minlength=CELLS).astype(np.uint32)
                found.append(np.vstack((names, np.bincount(row, minlength=names.shape[1]))))
            found = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
            none = [pa.nulls(len(batch), fields[c]) for c in ("chunk", "cells")]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], *map(pa.array, found), *none], list(fields))
        chunks = counts.reshape(-1, CHUNK)
        some = np.flatnonzero(chunks.any(axis=1))
        if len(some):
            none = [pa.nulls(len(some), fields[c]) for c in ("doc_id", "mark", "name", "more", "n")]
            cells = [pa.array(some.astype(np.int32)), pa.array([zlib.compress(chunks[k].tobytes(), 1) for k in some], pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *cells], list(fields))

    return docs.mapInArrow(of, "doc_id long, mark string, name long, more long, n long, chunk int, cells binary")


def rarity(counts: DataFrame) -> np.ndarray:
    """How frequent the n-grams of each cell are over all documents, in steps of a quarter of a power of two: CELLS bytes."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, cells in zip(batch["chunk"].to_pylist(), batch["cells"].to_pylist(), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(cells), np.uint32).astype(np.int64)
        steps = [np.round(4 * np.log2(1 + x)).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(steps, pa.binary())], ["chunk", "steps"])

    out = np.zeros((CELLS // CHUNK, CHUNK), np.uint8)
    for r in counts.repartition("chunk").mapInArrow(summed, "chunk int, steps binary").collect():
        out[r["chunk"]] = np.frombuffer(r["steps"], np.uint8)
    return out.ravel()


def prefixes(docs: DataFrame, words: int, millionths: int, rare: np.ndarray) -> DataFrame:
    """(key, node, n, pos): the first n - ceil(s n) + 1 n-grams of each text of n, and their places from 0."""
    def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, names, row, shingle in shingle_sets(batch["text"], words):
                fresh = np.zeros(names.shape[1], bool)
                for k, name in enumerate(names[0].tolist()):
                    fresh[k] = name not in seen
                    seen.add(name)
                if len(seen) > SEEN:
                    seen.clear()
                n = np.bincount(row, minlength=names.shape[1])
                own = fresh[row]
                row, shingle = row[own], shingle[own]
                order = np.lexsort((shingle, rare[cell_of(shingle)], row))
                row, shingle = row[order], shingle[order]
                own_n = np.where(fresh, n, 0)
                place = np.arange(len(row)) - (np.cumsum(own_n) - own_n)[row]
                take = place <= (n + -n * millionths // 1_000_000)[row]  # n - ceil(s n)
                row = row[take]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle[take].view(np.int64)), pa.array(names[0][row]), pa.array(n[row].astype(np.int32)), pa.array(place[take].astype(np.int32))], ["key", "node", "n", "pos"],
                )

    return docs.select("text").mapInArrow(first_ones, "key long, node long, n int, pos int")


def may_share(n: Column, i: Column, m: Column, j: Column, millionths: int) -> Column:
    """Length and positional filter for sets of n and m that first meet at places i and j."""
    most = F.least(n - i, m - j).cast("long")
    return most * (1_000_000 + millionths) >= (n + m).cast("long") * millionths


def meetings(docs: DataFrame, words: int, millionths: int, rare: np.ndarray) -> DataFrame:
    """(key, node, n, pos, size, center): prefixes that meet others, how many meet, and the least edited one of them:
    the one with the fewest rarer n-grams."""
    by_key = Window.partitionBy("key")
    met = prefixes(docs, words, millionths, rare).withColumns({
        "low": F.min("node").over(by_key), "high": F.max("node").over(by_key), "size": F.count(F.lit(1)).over(by_key),
        "least": F.min("n").over(by_key), "center": F.min(F.struct("pos", "n", "node")).over(by_key),
    })
    # the shortest that it may link with, at the best place
    shortest = F.greatest("least", F.ceil(F.col("n").cast("long") * millionths / 1_000_000).cast("int"))
    met = met.where("low < high").where(may_share(F.col("n"), F.col("pos"), shortest, F.lit(0), millionths))
    return met.dropDuplicates(["key", "node"]).select("key", "node", "n", "pos", "size", "center")


def few_pairs(met: DataFrame, millionths: int) -> DataFrame:
    """(a, b): all pairs of nodes that may link, of keys that few share."""
    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["met"]
            group = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            node, n, pos = (lists.flatten().field(c).to_numpy() for c in ("node", "n", "pos"))
            n, pos = n.astype(np.int64), pos.astype(np.int64)
            found = [np.zeros((2, 0), np.int64)]
            for d in range(1, FEW):
                x = np.flatnonzero(group[:-d] == group[d:])
                y = x + d
                x, y = (z[np.minimum(n[x] - pos[x], n[y] - pos[y]) * (1_000_000 + millionths) >= (n[x] + n[y]) * millionths] for z in (x, y))
                found.append(np.stack((np.minimum(node[x], node[y]), np.maximum(node[x], node[y]))))
            found = np.unique(np.concatenate(found, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    groups = met.where(F.col("size") <= FEW).groupBy("key").agg(F.collect_list(F.struct("node", "n", "pos")).alias("met"))
    return groups.select("met").mapInArrow(paired, "a long, b long")


def star_pairs(met: DataFrame, millionths: int) -> DataFrame:
    """(a, b): each node with the least edited one, of keys that many share."""
    c = F.col("center")
    many = met.where(F.col("size") > FEW).where((F.col("node") != c["node"]) & may_share(F.col("n"), F.col("pos"), c["n"], c["pos"], millionths))
    return many.select(F.least("node", c["node"]).alias("a"), F.greatest("node", c["node"]).alias("b"))


def sketch(shingles: np.ndarray) -> bytes:
    """Counts of a set's n-grams in ranges of hashes, about four for each range, at most 255."""
    size = 1 << max(4, (len(shingles) // 4).bit_length())
    return np.minimum(np.bincount((shingles >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64), minlength=size), 255).astype(np.uint8).tobytes()


def most_common(own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most how many n-grams a set shares with each of others (none said: as many as the smaller has), and how many they have together, from sketches."""
    if len(own) < others.shape[1]:
        full = (others == 255).any(axis=1)
        others = others.reshape(len(others), len(own), -1).sum(axis=2, dtype=np.int64)
    else:
        full = (others == 255).any(axis=1)
        own_full = bool((own == 255).any())
        full |= own_full
        own = own.reshape(others.shape[1], -1).sum(axis=1, dtype=np.int64)
    both = own.sum(dtype=np.int64) + others.sum(axis=1, dtype=np.int64)
    most = np.minimum(own.astype(np.int64), others.astype(np.int64)).sum(axis=1)
    return np.where(full | bool((own == 255).any()), both, most), both


def likely(pairs: DataFrame, chosen: DataFrame, millionths: int) -> DataFrame:
    """(a, b): those of ``pairs`` of nodes, now by id, whose sketches don't rule them out."""
    side = lambda x: chosen.select(F.col("node").alias(x), F.col("id").alias(f"{x}_id"), F.col("sketch").alias(f"{x}_sketch"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(x, np.uint8) for x in batch[c].to_pylist()] for c in ("a_sketch", "b_sketch"))
            take = np.zeros(len(batch), bool)
            for k, (x, y) in enumerate(zip(left, right, strict=True)):
                most, both = most_common(x, y[None, :])
                take[k] = most[0] * (1_000_000 + millionths) >= both[0] * millionths
            take = pa.array(np.flatnonzero(take))
            yield pa.RecordBatch.from_arrays([batch["a_id"].take(take), batch["b_id"].take(take)], ["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a_id", "b_id", "a_sketch", "b_sketch").mapInArrow(kept, "a long, b long")


def verified(pairs: DataFrame, chosen: DataFrame, words: int, millionths: int) -> DataFrame:
    """(a, b): those of ``pairs`` of ids whose sets are alike enough."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c in ("left", "right"):
                sets: list[np.ndarray] = []
                for _, names, row, shingle in shingle_sets(batch[c], words):
                    sets.extend(np.split(shingle, np.searchsorted(row, np.arange(1, names.shape[1]))))
                sides.append(sets)
            common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides, strict=True)], np.int64)
            every = np.array([len(x) + len(y) for x, y in zip(*sides, strict=True)], np.int64) - common
            take = pa.array(np.flatnonzero(common * 1_000_000 >= every * millionths))
            yield pa.RecordBatch.from_arrays([batch["a"].take(take), batch["b"].take(take)], ["a", "b"])

    left, right = (chosen.select(F.col("id").alias(x), F.col("text").alias(name)) for x, name in (("a", "left"), ("b", "right")))
    return pairs.join(left, "a").join(right, "b").mapInArrow(kept, "a long, b long")


def open_rows(many: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, id, n, pos, root, size): rows of ``many`` (key, id, n, pos) whose key meets different components."""
    rooted = many.join(roots, many["id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "id")) if roots else many.withColumn("root", F.col("id"))
    by_key = Window.partitionBy("key")
    rooted = rooted.withColumns({"low": F.min("root").over(by_key), "high": F.max("root").over(by_key), "size": F.count(F.lit(1)).over(by_key)})
    return rooted.where("low < high").select("key", "id", "n", "pos", "root", "size")


def block_pairs(rows: DataFrame, chosen: DataFrame, millionths: int, most_of: int | None) -> DataFrame:
    """(a, b): pairs of different components that lengths, places and sketches don't rule out; the ``most_of`` likeliest of each row in each block.

    Rows of a key are dealt to parts of about BLOCK; every two parts form a block, so no key is one task.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for alone, members in zip(batch["alone"].to_pylist(), batch["members"], strict=True):
                own = members.values
                ids, root, n, pos = (own.field(c).to_numpy().astype(np.int64) for c in ("id", "root", "n", "pos"))
                right = own.field("right").to_numpy(zero_copy_only=False)
                sketches = [np.frombuffer(x, np.uint8) for x in own.field("sketch").to_pylist()]
                sizes = np.array([len(x) for x in sketches])
                stacks = {s: (np.flatnonzero(sizes == s), np.stack([sketches[k] for k in np.flatnonzero(sizes == s)])) for s in np.unique(sizes)}
                found: list[tuple[int, int]] = []
                for x in range(len(ids)) if alone else np.flatnonzero(~right).tolist():
                    fits = np.minimum(n[x] - pos[x], n - pos) * (1_000_000 + millionths) >= (n[x] + n) * millionths
                    fits &= (root != root[x]) & (ids != ids[x] if alone and most_of else np.arange(len(ids)) > x if alone else right)
                    near: list[tuple[float, int]] = []
                    for at, stack in stacks.values():
                        pick = np.flatnonzero(fits[at])
                        if len(pick):
                            most, both = most_common(sketches[x], stack[pick])
                            good = np.flatnonzero(most * (1_000_000 + millionths) >= both * millionths)
                            near.extend(zip((-most[good] / both[good]).tolist(), ids[at[pick[good]]].tolist(), strict=True))
                    if most_of and len(near) > most_of:
                        near = sorted(near)[:most_of]
                    found.extend((min(ids[x], y), max(ids[x], y)) for _, y in near)
                pairs = np.array(sorted(set(found)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.join(chosen.select("id", "sketch"), "id")
    rows = rows.groupBy("key", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second")).agg(
        F.collect_list(F.struct("id", "root", "n", "pos", "sketch", (F.col("own") > F.col("other")).alias("right"))).alias("members"))
    return rows.select((F.col("first") == F.col("second")).alias("alone"), "members").mapInArrow(compare, "a long, b long").distinct()


def join(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """Components of the documents that share enough ``words``-word n-grams: Jaccard similarity of ``similarity`` (to six digits) or more.

    A-Z are lower-cased and each n-gram counts once; a text of fewer words is one n-gram. Returns doc_id, n_shingles and
    component_id (the smallest doc_id of the component) for each row; no link is left out. A text without words (a null
    one too) links with nothing and is named by its own doc_id. Copies are one node. A null doc_id stays null and names
    a component only if no other is there; rows that repeat a doc_id are judged by their own texts. n-grams are told
    apart by 64-bit hashes, texts by 128 bits. An empty table gives no rows. Other columns go.
    """
    millionths = round(similarity * 1_000_000)
    texts = id_and_text(docs).select("doc_id", F.md5(F.col("text").cast("binary")).alias("mark"), "text")
    seen = stored(shingled(texts, words), "shingled")
    rows = seen.where("chunk is null").select("doc_id", "mark", "name", "more", "n")
    rare = rarity(seen.where("chunk is not null").select("chunk", "cells"))
    classes = rows.where("n > 0").groupBy("name", "more").agg(F.min("doc_id").alias("first"), F.max(F.struct("doc_id", "mark")).alias("shown"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    met = stored(meetings(texts, words, millionths, rare), "met")
    pairs = stored(few_pairs(met, millionths).union(star_pairs(met, millionths)).distinct(), "pairs")
    many = met.where(F.col("size") > FEW).select("key", "node", "n", "pos")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(many.select("node")).distinct()
    wanted = classes.join(wanted, F.col("name") == F.col("node")).select("id", "node", F.col("shown.doc_id").alias("shown_id"), F.col("shown.mark").alias("shown_mark"))
    shown = texts.dropDuplicates(["doc_id", "mark"]) if rows.groupBy("doc_id", "mark").count().where("count > 1").count() else texts
    shown = shown.join(wanted, F.col("doc_id").eqNullSafe(F.col("shown_id")) & (F.col("mark") == F.col("shown_mark"))).select("id", "node", "text")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            for _, names, row, shingle in shingle_sets(batch["text"], words):
                out.extend(sketch(x) for x in np.split(shingle, np.searchsorted(row, np.arange(1, names.shape[1]))))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["node"], batch["text"], pa.array(out, pa.binary())], ["id", "node", "text", "sketch"])

    chosen = stored(shown.mapInArrow(sketched, "id long, node long, text string, sketch binary"), "chosen")
    links = stored(verified(stored(likely(pairs, chosen, millionths), "likely"), chosen, words, millionths), "links")
    roots = components(links)
    many = stored(many.join(chosen.select("node", "id"), "node").select("key", "id", "n", "pos"), "many")
    for most_of in ROUNDS:
        rows_left = stored(open_rows(many, roots), "open")
        if rows_left.isEmpty():
            break
        found = stored(block_pairs(rows_left, chosen, millionths, most_of), "candidates")
        if found.isEmpty():
            break
        links = links.union(stored(verified(found, chosen, words, millionths), "links"))
        roots = components(links)
    rooted = classes.join(roots, classes["id"] == roots["node"], "left").select("name", "more", "first", F.coalesce("root", "id").alias("root"))
    names = rooted.join(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("name", "more", "component_id")
    out = rows.join(names, ["name", "more"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
