"""Best-fit-decreasing packing of tokenized documents into sequences of fixed length."""

from __future__ import annotations

import json
import zlib
from base64 import b64decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import gapless, id_and_text, stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_models: dict[tuple, object] = {}


def added_tokens() -> dict[str, int]:
    """Text and id of the tokens that ``byte_bpe_50k.json`` adds to its vocabulary and finds inside of texts."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}


def model(ranks: str | None, pattern: str | None, added: dict[str, int] | None = None):
    """The byte-level BPE of a rank file; by default the public 50k one. Loaded once by each worker."""
    import public_tokenizers
    import tiktoken

    key = (ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN, tuple((added or {}).items()))
    if key not in _models:
        with open(key[0], "rb") as lines:
            known = {b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _models[key] = tiktoken.Encoding("pieces", pat_str=key[1], mergeable_ranks=known, special_tokens=dict(key[2]))
    return _models[key]


def pieces(docs: DataFrame, capacity: int, ranks: str | None = None, pattern: str | None = None, end_id: int = 0, added: dict[str, int] | None = None) -> DataFrame:
    """Token pieces of at most ``capacity`` ids of each document, ``end_id`` after its last one.

    A longer document is cut so that all pieces but the first are full. ``ranks`` and ``pattern`` name a vocabulary in
    the rank format; the default gives the ids of ``byte_bpe_50k.json``, which is the same vocabulary, in a third of
    the time. ``added`` names strings that are one token wherever a text has them, as ``added_tokens`` gives them;
    without it they are ordinary text.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = model(ranks, pattern, added), int(end_id).to_bytes(4, "little")
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                out: list[tuple] = []
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    ids = bpe.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes() + end
                    n = len(ids) // 4
                    head = n - (n - 1) // capacity * capacity
                    at = [0, *range(head, n, capacity), n]
                    out += [(doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(at, at[1:], strict=False))]
                columns = zip(*out, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return id_and_text(docs).mapInArrow(cut, PIECES)


class OpenBins:
    """Open bins by remaining capacity: a segment tree finds the least capacity that is enough in logarithmic time.

    Bins with the same capacity left are kept as runs of numbers, so the tree's size depends on the capacity alone.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = np.zeros(2 * self.leaves, bool)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.leaves)]

    def _set(self, room: int) -> None:
        node = room + self.leaves
        self.filled[node] = bool(self.runs[room])
        while node > 1:
            node //= 2
            self.filled[node] = self.filled[2 * node] or self.filled[2 * node + 1]

    def put(self, room: int, first: int, count: int) -> None:
        if count and room:
            self.runs[room].append((first, count))
            self._set(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._set(room)
        return run

    def tightest(self, length: int) -> int:
        """The least room >= length of any open bin, 0 if there is none."""
        node = length + self.leaves
        if self.filled[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.filled[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return 0


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` items: (length, first item, items, items a bin, first bin, offset).

    Item ``first + i`` of a length goes to bin ``first bin + i // per`` at ``offset + i % per * length``. Items of a
    length are placed in runs, as after the first one best fit treats the next bins of the same room alike.
    """
    bins, opened, out = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        placed, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room:
                first, count = bins.take(room)
            else:
                room, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            per = room // length
            full = min(count, left // per)
            if full:
                out.append((length, placed, full * per, per, first, capacity - room))
                bins.put(room - per * length, first, full)
                placed, left, first, count = placed + full * per, left - full * per, first + full, count - full
            if left and count:  # the last bin gets fewer than it could
                out.append((length, placed, left, per, first, capacity - room))
                bins.put(room - left * length, first, 1)
                placed, left, first, count = placed + left, 0, first + 1, count - 1
            bins.put(room, first, count)
    return out


def pack(docs: DataFrame, capacity: int = 2048, **vocabulary: str | int | dict[str, int] | None) -> DataFrame:
    """Packs the tokens of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Best-fit decreasing sees lengths alone: the driver gets the count of each length, at most ``capacity`` numbers
    whatever the input, and places runs of equal pieces; Spark numbers the pieces of each length and looks up their
    runs. Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset. Null and empty texts are one piece
    of the end id; null doc_ids and repeated rows are packed as documents of their own; ties of length go by doc_id,
    piece and checksum. An empty table gives no rows. Other columns go.
    """
    cut = stored(pieces(docs, capacity, **vocabulary), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = docs.sparkSession
    runs = spark.createDataFrame(plan(counts, capacity), "length long, first long, items long, per long, bin long, at long")
    ranked = gapless(cut, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "rank", F.xxhash64("doc_id", "piece"))
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("items"))
    found = ranked.alias("p").join(F.broadcast(runs).alias("r"), (F.col("p.length") == F.col("r.length")) & inside)
    place = F.col("rank") - F.col("first")
    return found.select(
        "doc_id", "piece", "start", "p.length", "ids_crc32", (F.col("bin") + F.floor(place / F.col("per"))).alias("sequence_id"),
        (F.col("at") + place % F.col("per") * F.col("p.length")).alias("offset"),
    )
