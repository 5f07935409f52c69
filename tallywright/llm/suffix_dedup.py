"""Removal of repeated byte strings by a sparse suffix array.

Every string of ``length`` bytes has an anchor: the place of the least hash of GRAM bytes in its first
``length - CORE + 1`` places, the leftmost of equal ones. Equal strings have their anchor at the same place inside and
share the CORE bytes from there, so the suffixes at anchors, one in about ``length / 3`` bytes, stand for all. Suffixes
whose core occurs once are settled at once, and so are cores whose surroundings (all strings of the anchor, joined) are
the same wherever they occur. For the others the distinct surroundings are range-partitioned by the leading bytes of
their suffix, with splitters that Spark samples; a core never spans two ranges. A bucket sorts the suffixes at all of
its strings' starts by multikey quicksort over tokens of TOKEN bytes, named by 64-bit hashes: suffixes that tie on a
token go on to the next, and those that tie on all are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import id_and_text, stored
from tallywright.llm.hashing import BASES, byte_sums, mix, ranges, runs, slices, windows

GRAM, CORE, TOKEN, LEAD = 8, 100, 100, 16
#: A core with more distinct surroundings isn't sorted in one bucket: its strings are counted by their names instead.
MOST_IN_BUCKET = 1_000
ANCHOR = "core long, around long, doc long, low int, n int, place int"


def least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each window of ``size`` values, by doubling."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (size - width)], values[size - width :])


def anchor_rows(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first start, starts, anchor, core, around) of each anchor; starts are places of its strings in ``data``."""
    ends = offsets[1:] - length + 1
    rows = np.flatnonzero(ends > offsets[:-1])
    if not len(rows):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    sums, more = byte_sums(data, BASES[1]), byte_sums(data, BASES[2])
    gram = windows(sums, BASES[1], GRAM)
    place = least((gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64), length - CORE + 1) & np.uint64(2**32 - 1)
    sizes = ends[rows] - offsets[rows]
    row = np.repeat(rows, sizes)
    start = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + offsets[row]
    at = place[start].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]))))
    n = np.diff(np.append(new, len(start)))
    low, anchor = start[new], at[new]
    around = mix(ranges(more, BASES[2], low, low + n - 1 + length) ^ (anchor - low).astype(np.uint64))
    return row[new], low, n, anchor, ranges(sums, BASES[1], anchor, anchor + CORE), around


def anchors(docs: DataFrame, length: int) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc"].to_numpy()
            for first, data, offsets in slices(batch["text"]):
                row, low, n, anchor, core, around = anchor_rows(data, offsets, length)
                low_in = (low - offsets[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(core.view(np.int64)), pa.array(around.view(np.int64)), pa.array(ids[first + row]),
                    pa.array(low_in), pa.array(n.astype(np.int32)), pa.array((anchor - low).astype(np.int32)),
                ], ["core", "around", "doc", "low", "n", "place"])

    return docs.mapInArrow(found, ANCHOR)


def surroundings(texts: DataFrame, length: int) -> DataFrame:
    """(core, around, n, place, lead, bytes): the strings of each listed anchor, joined; ``lead`` begins its suffix."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                raw, out = batch["text"][k].as_py().encode(), []
                for x in batch["listed"][k].as_py():
                    own = raw[x["low"] : x["low"] + x["n"] - 1 + length]
                    out.append((x["core"], x["around"], x["n"], x["place"], own[x["place"] : x["place"] + LEAD], own))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["core", "around", "n", "place", "lead", "bytes"])

    return texts.mapInArrow(cut, "core long, around long, n int, place int, lead binary, bytes binary")


def expanded(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, distance to the anchor, place in the bytes) of each string of a batch of surroundings."""
    n, place = batch["n"].to_numpy().astype(np.int64), batch["place"].to_numpy()
    row = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    heads = np.cumsum(n - 1 + length) - (n - 1 + length)
    return row, start, place[row] - start, heads[row] + start


def joined_bytes(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch["bytes"].to_pylist()), np.uint8)


def multikey_quicksort(group: np.ndarray, at: np.ndarray, sums: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes at ``at`` equal another of their group over ``length`` bytes.

    Suffixes are sorted by one token at a time; only those that tie with a neighbour are sorted by the next.
    """
    active = np.arange(len(at))
    for token in range(0, length, TOKEN):
        if not len(active):
            break
        name = ranges(sums, BASES[1], at[active] + token, at[active] + min(token + TOKEN, length))
        order = np.lexsort((name, group[active]))
        active, name = active[order], name[order]
        same = (group[active][1:] == group[active][:-1]) & (name[1:] == name[:-1])
        tie = np.concatenate((same, [False])) | np.concatenate(([False], same))
        label = np.cumsum(np.concatenate(([True], ~same)))  # neighbours that tie form the next group
        active, label = active[tie], label[tie]
        group = group.copy()
        group[active] = label
    equal = np.zeros(len(at), bool)
    equal[active] = True
    return equal


def run_rows(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, equal: np.ndarray) -> pa.RecordBatch:
    """(core, around, skip, n): the runs of equal starts of each anchor."""
    first = np.concatenate(([True], row[1:] != row[:-1]))
    a, b = runs(equal)
    cuts = np.flatnonzero(first)  # a run ends where the next anchor begins
    parts = [np.unique(np.concatenate(([x], cuts[np.searchsorted(cuts, x, "right") : np.searchsorted(cuts, y)], [y]))) for x, y in zip(a, b, strict=True)]
    x = np.concatenate([p[:-1] for p in parts]) if parts else np.zeros(0, np.int64)
    y = np.concatenate([p[1:] for p in parts]) if parts else np.zeros(0, np.int64)
    take = pa.array(row[x])
    return pa.RecordBatch.from_arrays(
        [batch["core"].take(take), batch["around"].take(take), pa.array(start[x].astype(np.int32)), pa.array((y - x).astype(np.int32))], ["core", "around", "skip", "n"],
    )


def sorted_buckets(rows: DataFrame, length: int) -> DataFrame:
    """(core, around, skip, n): equal strings among surroundings of the same core, bucket by bucket.

    Rows come in the order of their core; a core's rows, at most MOST_IN_BUCKET, are gathered across batches.
    """
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, start, distance, at = expanded(batch, length)
        core = batch["core"].to_numpy()
        group = np.cumsum(np.concatenate(([0], core[1:] != core[:-1])))[row] * np.int64(2 * length) + distance
        return run_rows(batch, row, start, multikey_quicksort(group, at, byte_sums(joined_bytes(batch), BASES[1]), length))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            for first in range(0, len(batch), 1_000):
                part = batch.slice(first, 1_000)
                part = pa.Table.from_batches([rest, part]).combine_chunks().to_batches()[0] if rest is not None and len(rest) else part
                core = part["core"].to_numpy()
                whole = int(np.flatnonzero(core != core[-1])[-1]) + 1 if (core != core[-1]).any() else 0
                if whole:
                    yield one(part.slice(0, whole))
                rest = part.slice(whole)
        if rest is not None and len(rest):
            yield one(rest)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, "lead", "core").sortWithinPartitions("lead", "core").mapInArrow(each, "core long, around long, skip int, n int")


def counted_names(rows: DataFrame, length: int) -> DataFrame:
    """(core, around, skip, n): the same for cores of too many surroundings, by counting named strings map-side."""
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 1_000):
                part = batch.slice(first, 1_000)
                row, start, distance, at = expanded(part, length)
                data = joined_bytes(part)
                names = [mix(ranges(byte_sums(data, b), b, at, at + length) + distance.astype(np.uint64)) for b in BASES[1:]]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part["core"].take(take), part["around"].take(take), pa.array(start.astype(np.int32)), *[pa.array(x.view(np.int64)) for x in names]],
                    ["core", "around", "skip", "name", "name2"],
                )

    strings = rows.mapInArrow(named, "core long, around long, skip int, name long, name2 long")
    again = strings.groupBy("core", "name", "name2").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    return strings.join(again, ["core", "name", "name2"]).select("core", "around", "skip", F.lit(1).alias("n"))


def cut_bytes(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(batch["text"], batch["runs"], strict=True):
                raw = text.as_buffer().to_pybytes()
                if not own.is_valid:
                    out.append((len(raw), 0, 0, raw))
                    continue
                first, n = own.values.field("first").to_numpy(), own.values.field("n").to_numpy()
                steps = np.zeros(len(raw) + 1, np.int64)
                np.add.at(steps, first, 1)
                np.add.at(steps, first + n - 1 + length, -1)
                gone = np.cumsum(steps[:-1]) > 0
                out.append((len(raw), int(gone.sum()), len(runs(gone)[0]), np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return cut


def dedup(docs: DataFrame, length: int = 400) -> DataFrame:
    """Removes every byte covered by a string of ``length`` bytes that also starts anywhere else in ``docs``.

    Strings lie within a document, may overlap, and are judged on the input. Returns doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs) and kept (the other bytes joined, as binary, since a cut may split a character) for
    each row. Null and empty texts, and texts shorter than ``length``, lose nothing. Rows are told apart by a hash
    of doc_id and text, so that rows with the same doc_id, or none, are texts of their own; equal rows repeat each
    other. An empty table gives no rows. Other columns go.
    """
    docs = id_and_text(docs).select("doc_id", F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "text").alias("doc"), "text")
    every = anchors(docs, length)
    cores = every.groupBy("core").agg(F.count(F.lit(1)).alias("times"), (F.min("around") < F.max("around")).alias("mixed")).where("times > 1").drop("times")
    shared = stored(every.join(stored(cores, "cores"), "core"), "suffixes")
    mixed = shared.where("mixed")
    classes = mixed.groupBy("core", "around").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc", "low", "n", "place")).alias("at"))
    many = classes.groupBy("core").agg((F.count(F.lit(1)) > MOST_IN_BUCKET).alias("many"))
    classes = stored(classes.join(many, "core"), "surroundings")

    def of(many: bool) -> DataFrame:
        listed = classes.where(F.col("many") == many).groupBy(F.col("at.doc").alias("doc")).agg(F.collect_list(F.struct("core", "around", "at.low", "at.n", "at.place")).alias("listed"))
        return surroundings(docs.join(listed, "doc"), length)

    equal = sorted_buckets(of(False), length)
    if not classes.where("many").isEmpty():
        equal = equal.union(counted_names(of(True), length))
    often = classes.where("times > 1").select("core", "around", F.lit(0).alias("skip"), F.col("at.n").alias("n"))
    found = mixed.drop("n").join(equal.union(often), ["core", "around"]).select("doc", (F.col("low") + F.col("skip")).alias("first"), "n")
    found = found.union(shared.where("not mixed").select("doc", F.col("low").alias("first"), "n"))
    own = found.groupBy("doc").agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    return docs.join(own, "doc", "left").mapInArrow(cut_bytes(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
