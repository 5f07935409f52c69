"""Removal of passages of words that a document with a smaller doc_id has too, by difference-cover anchors.

Windows of ``anchor`` words are hashed only where their place in the document, modulo a period, lies in a difference
cover. Two equal passages of ``window = anchor + period - 1`` words share an anchor at the same place inside, whatever
their own places, since every difference modulo the period is one of two members of the cover. So every window of a
match contains a shared anchor: only windows around shared anchors are compared whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import gapless, id_and_text, stored
from tallywright.llm.hashing import BASES, prefix_sums, runs, slices, windows, word_bounds, word_hashes

#: Perfect difference sets by period.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Documents whose doc_id hashes to 0 modulo this show which keys are frequent.
SHOWN = 32
#: A key is frequent if more than one in so many of the shown documents, and at least so many of them, have it.
FREQUENT_ONE_IN, FREQUENT_LEAST = 500, 25
#: Stands for a null doc_id while documents are compared: it comes before all others.
NULL_ID = -(2**63)

Keep = Callable[[np.ndarray], np.ndarray]


def best_period(window: int) -> int:
    """The longest period whose anchors still have as many words as the period, or the shortest one."""
    return max([p for p in COVERS if window - p + 1 >= p] or [3])


def parted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc, text) with ``part``, which tells the different texts of a doc_id apart: 0 where it has one row."""
    ids = docs.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc")
    ids = stored(ids, "repeated")
    if ids.isEmpty():
        return docs.withColumn("part", F.lit(0).cast("long"))
    marked = docs.withColumn("mark", F.xxhash64("text"))
    several = marked.select("doc", "mark").join(ids, "doc", "left_semi").distinct()
    numbered = stored(gapless(several, ["doc"], [F.col("mark")], "part", F.col("mark")), "parts")
    return marked.join(numbered, ["doc", "mark"], "left").select("doc", "text", F.coalesce("part", F.lit(0)).alias("part"))


def parts_of(batch: pa.RecordBatch) -> np.ndarray:
    """What is added to the places of each row's words: its part in the upper half."""
    return batch["part"].to_numpy() << 32 if "part" in batch.schema.names else np.zeros(len(batch), np.int64)


def places(found: DataFrame, name: str) -> DataFrame:
    """(doc, part, ``name``): the places of (doc, at) as one list for each text; the upper half of ``at`` is the part."""
    place = F.col("at").bitwiseAND(F.lit(2**32 - 1)).cast("int")
    return found.groupBy("doc", F.shiftright("at", 32).alias("part")).agg(F.collect_list(place).alias(name))


def anchors(docs: DataFrame, window: int, keep: Keep | None = None) -> DataFrame:
    """(key, doc, at): the hashed anchors of each document, those that ``keep`` tells by their keys; see ``places``."""
    period = best_period(window)
    size, members = window - period + 1, np.array(COVERS[period])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_of, parts = batch["doc"].to_numpy(), parts_of(batch)
            for first, data, offsets in slices(batch["text"]):
                starts, ends, heads = word_bounds(data, offsets)
                key = windows(prefix_sums(word_hashes(data, starts, ends), BASES[1]), BASES[1], size).view(np.int64)
                row = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
                at = np.arange(len(row)) - heads[row]
                n = len(key)
                take = np.isin(at[:n] % period, members) & (row[:n] == row[size - 1 :][:n])
                if keep:
                    take &= keep(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[take]), pa.array(docs_of[first + row[:n][take]]), pa.array(at[:n][take] + parts[first + row[:n][take]])], ["key", "doc", "at"],
                )

    return docs.mapInArrow(hashed, "key long, doc long, at long")


def frequent_keys(docs: DataFrame, window: int) -> np.ndarray:
    """Keys that many documents share, told from a part of them; at most FREQUENT_ONE_IN times a document's anchors."""
    shown = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SHOWN)) == 0)
    least = max(FREQUENT_LEAST, shown.count() // FREQUENT_ONE_IN)
    counts = anchors(shown, window).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([r["key"] for r in counts.select("key").collect()], np.int64))


def shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """(doc, part, anchors): places of the anchors that other documents have too.

    Rare keys meet in one shuffle. A frequent key would meet in one task: its smallest and largest document are found
    by a map-side aggregation instead, and the keys that two documents share, no more than frequent_keys allows, go to
    the tasks that hash the documents.
    """
    frequent = frequent_keys(docs, window)
    by_key = Window.partitionBy("key")
    rare = anchors(docs, window, (lambda key: ~np.isin(key, frequent)) if len(frequent) else None)
    rare = rare.withColumns({"low": F.min("doc").over(by_key), "high": F.max("doc").over(by_key)})
    found = rare.where("low < high").select("doc", "at")
    if len(frequent):
        often = anchors(docs, window, lambda key: np.isin(key, frequent))
        spread = often.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key")
        shared = np.sort(np.array([r["key"] for r in spread.collect()], np.int64))
        found = found.union(anchors(docs, window, lambda key: np.isin(key, shared)).select("doc", "at"))
    return places(found, "anchors")


def whole_windows(texts: DataFrame, window: int) -> DataFrame:
    """(key, doc, at): windows of ``window`` words that contain an anchor of ``anchors``."""
    back = best_period(window)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_of, parts, lists = batch["doc"].to_numpy(), parts_of(batch), batch["anchors"]
            for first, data, offsets in slices(batch["text"]):
                starts, ends, heads = word_bounds(data, offsets)
                key = windows(prefix_sums(word_hashes(data, starts, ends), BASES[2]), BASES[2], window).view(np.int64)
                row = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
                n = len(key)
                near = lists.slice(first, len(heads) - 1)
                x = near.flatten().to_numpy() + np.repeat(heads[:-1], pa.compute.list_value_length(near).to_numpy())
                steps = np.zeros(len(row) + 1, np.int64)  # an anchor at x lies in the windows from x - back + 1 to x
                np.add.at(steps, np.maximum(x - back + 1, heads[row[x]]), 1)
                np.add.at(steps, x + 1, -1)
                take = (np.cumsum(steps)[:n] > 0) & (row[:n] == row[window - 1 :][:n])
                at = (np.arange(n) - heads[row[:n]])[take]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[take]), pa.array(docs_of[first + row[:n][take]]), pa.array(at + parts[first + row[:n][take]])], ["key", "doc", "at"],
                )

    return texts.mapInArrow(hashed, "key long, doc long, at long")


def cut_words(window: int, spacing: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            lists = batch["starts"]
            for first, data, offsets in slices(batch["text"]):
                for k in range(len(offsets) - 1):
                    own = data[offsets[k] : offsets[k + 1]]
                    raw, begins = own.tobytes(), lists[first + k]
                    if not begins.is_valid:
                        words = raw.split()
                        n_words.append(len(words))
                        n_removed.append(0)
                        kept.append(raw if spacing else b" ".join(words))
                        continue
                    begin, end, _ = word_bounds(own, np.array([0, len(own)]))
                    n = len(begin)
                    steps = np.zeros(n + 1, np.int64)
                    x = begins.values.to_numpy()
                    np.add.at(steps, x, 1)
                    np.add.at(steps, x + window, -1)
                    gone = np.cumsum(steps[:n]) > 0
                    n_words.append(n)
                    n_removed.append(int(gone.sum()))
                    if spacing:  # from each removed run's first byte to the next kept word
                        a, b = runs(gone)
                        stay = np.ones(len(own), bool)
                        for i, j in zip(begin[a], np.append(begin, len(own))[b], strict=True):
                            stay[i:j] = False
                        kept.append(own[stay].tobytes())
                    else:
                        kept.append(b" ".join([raw[i:j] for i, j in zip(begin[~gone].tolist(), end[~gone].tolist(), strict=True)]))
            text = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["mark"], text, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], ["doc", "mark", "text", "n_words", "n_removed"])

    return cut


def dedup(docs: DataFrame, window: int = 13, spacing: bool = False) -> DataFrame:
    """Removes each word covered by a window of ``window`` words that a document with a smaller doc_id has too.

    Windows are judged on the input. Returns doc_id, text (the kept words joined by one blank, or with ``spacing``
    the text without the removed words and the white space after them), n_words, n_removed and mark (the hash of the
    text before) for each row. A null
    text has no words, a null doc_id comes before all others; a text shorter than the window keeps all its words, and
    so do rows that repeat a doc_id among themselves, each with places of its own. An empty table gives no rows. Other columns go.
    """
    docs = id_and_text(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "text")
    docs = parted(docs)
    shared = stored(shared_anchors(docs, window), "anchors")
    # one shuffle of the texts serves both joins by doc
    whole = whole_windows(docs.join(shared, ["doc", "part"]), window)
    first = whole.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key", "low")
    again = places(whole.join(first, "key").where("doc > low").select("doc", "at"), "starts")
    out = docs.join(again, ["doc", "part"], "left").withColumn("mark", F.xxhash64("text")).mapInArrow(cut_words(window, spacing), "doc long, mark long, text string, n_words long, n_removed long")
    return out.select(F.nullif("doc", F.lit(NULL_ID)).alias("doc_id"), "mark", "text", "n_words", "n_removed")
