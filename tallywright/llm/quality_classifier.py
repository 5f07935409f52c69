"""Quality classifier by importance resampling over hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import id_and_text, stored
from tallywright.llm.hashing import BASES, mix, prefix_sums, slices, windows, word_bounds, word_hashes

#: n-grams of a kind share so many buckets; the kinds are words, pairs of words and three bytes.
BITS, KINDS = 14, 3
BUCKETS = KINDS << BITS
#: At most so many labelled rows are used, those with the least hash of their doc_id: half fit, half set the cut.
MOST_LABELS = 20_000
#: Rejecting a good document counts as much as keeping so many bad ones when the cut is set.
GOOD_COSTS = 10
#: The target model is mixed with so much of the raw one, so that n-grams which a small sample lacks don't weigh too much.
PRIOR = 0.05
#: Share of the Gumbel noise in the sampling key; 1 samples in proportion to the weights, 0 takes the heaviest.
NOISE = 1.0
#: Added to the shares of toxic and of clean documents that have an n-gram, besides two clean documents.
TOXIC_PRIOR = 0.005
NULL_ID = -(2**63)


def n_grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, one kind after another. Pairs of equal words share the first bucket of pairs."""
    bucket = lambda h, kind: (h >> np.uint64(64 - BITS)).astype(np.int64) + (kind << BITS)
    starts, ends, heads = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(len(heads) - 1), np.diff(heads))
    yield row, bucket(words, 0)
    same = row[:-1] == row[1:]
    pairs = bucket(windows(prefix_sums(words, BASES[1]), BASES[1], 2), 1)
    yield row[:-1][same], np.where(words[:-1] == words[1:], 1 << BITS, pairs)[same]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    same = row[:-2] == row[2:]
    wide = data.astype(np.uint64)
    yield row[:-2][same], bucket(mix(wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)), 2)[same]


def gumbel(ids: np.ndarray, seed: int) -> np.ndarray:
    drawn = mix(ids.view(np.uint64) ^ mix(np.full(len(ids), seed + 1, np.uint64)))
    return -np.log(-np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53))


def model(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket, the log of its share in the target texts over its share in all texts, one added to each count,
    the target model mixed with PRIOR of the raw one; and the log of the share of toxic documents that have it over
    that of clean ones (all 0 if one of them is missing).

    ``docs`` (doc, text, role, side): all documents count as raw text, those of role ``fit`` as target; those of side
    ``fit toxic`` and ``fit clean`` tell toxic from clean. The driver gets BUCKETS rows.
    """
    def is_(column: pa.Array, value: str) -> np.ndarray:
        return pa.compute.fill_null(pa.compute.equal(column, value), False).to_numpy(zero_copy_only=False)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, toxic, clean = np.zeros((4, BUCKETS + 1), np.int64)  # the last place counts documents
        for batch in batches:
            fit, sides = is_(batch["role"], "fit"), [(n, is_(batch["side"], side)) for n, side in ((toxic, "fit toxic"), (clean, "fit clean"))]
            for n, own in sides:
                n[-1] += own.sum()
            for first, data, offsets in slices(batch["text"]):
                for row, bucket in n_grams(data, offsets):
                    raw += np.bincount(bucket, minlength=BUCKETS + 1)
                    target += np.bincount(bucket[fit[first + row]], minlength=BUCKETS + 1)
                    for n, own in sides:
                        has = own[first + row]
                        n += np.bincount(np.unique(row[has] * BUCKETS + bucket[has]) % BUCKETS, minlength=BUCKETS + 1)
        some = np.flatnonzero(raw + toxic + clean)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, raw[some], target[some], toxic[some], clean[some])], ["bucket", *names])

    names = ("raw", "target", "toxic", "clean")
    sums = docs.mapInArrow(counted, "bucket long, raw long, target long, toxic long, clean long").groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names])
    counts = np.zeros((4, BUCKETS + 1))
    for r in sums.collect():
        counts[:, r["bucket"]] += [r[c] for c in names]
    shares = (counts[:2, :BUCKETS] + 1).reshape(2, KINDS, -1)
    shares /= shares.sum(axis=2, keepdims=True)
    toxic, clean = counts[2:, -1]
    ratios = np.zeros(BUCKETS)
    if toxic and clean:
        prior = TOXIC_PRIOR + 2 / clean
        ratios = np.log(counts[2, :BUCKETS] / toxic + prior) - np.log(counts[3, :BUCKETS] / clean + prior)
    return np.log((1 - PRIOR) * shares[1] / shares[0] + PRIOR).ravel(), ratios


def weigh(docs: DataFrame, ratios: np.ndarray, toxic_ratios: np.ndarray, seed: int) -> DataFrame:
    """(doc, carried, role, side, log_weight, toxicity, key, place): the log importance weight, the log ratio of the most toxic
    n-gram (at least 0), the Gumbel key, and the key's place in the order of 64-bit integers."""
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, toxicity = np.zeros(len(batch)), np.zeros(len(batch))
            for first, data, offsets in slices(batch["text"]):
                for row, bucket in n_grams(data, offsets):
                    weight[first : first + len(offsets) - 1] += np.bincount(row, ratios[bucket], len(offsets) - 1)
                    heads = np.flatnonzero(np.diff(row, prepend=-1))
                    if len(heads):
                        at = first + row[heads]
                        toxicity[at] = np.maximum(toxicity[at], np.maximum.reduceat(toxic_ratios[bucket], heads))
            weight = np.round(weight, 9)
            key = weight + NOISE * gumbel(batch["doc"].to_numpy(), seed)
            place = key.view(np.int64)
            place = np.where(place < 0, place ^ np.int64(2**63 - 1), place)
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["carried"], batch["role"], batch["side"], pa.array(weight), pa.array(np.round(toxicity, 9)), pa.array(key), pa.array(place)], ["doc", "carried", "role", "side", "log_weight", "toxicity", "key", "place"])

    return docs.mapInArrow(weighed, "doc long, carried string, role string, side string, log_weight double, toxicity double, key double, place long")


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The middle of the range of cuts that cost least; no bad documents: below all good ones; none at all: 0."""
    if not len(good) and not len(bad):
        return 0.0
    at = np.unique(np.concatenate((good, bad)))
    edges = np.concatenate(([at[0] - 1], (at[1:] + at[:-1]) / 2, [at[-1] + 1]))
    cost = GOOD_COSTS * np.searchsorted(np.sort(good), edges) + len(bad) - np.searchsorted(np.sort(bad), edges)
    return float(edges[cost == cost.min()].mean())


def kth_place(weights: DataFrame, k: int) -> int:
    """The k-th largest ``place``: 16 bits are settled by each of four counts, of at most 65,536 rows."""
    settled, left = 0, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftright(F.col("place"), shift)
        rows = weights if shift == 48 else weights.where(F.shiftright(F.col("place"), shift + 16) == settled)
        for r in sorted(rows.groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["d"]):
            if left <= r["n"]:
                settled = r["d"]
                break
            left -= r["n"]
    return settled


def classify(docs: DataFrame, labels: DataFrame, seed: int = 0, carry: str | None = None) -> DataFrame:
    """Which documents to keep: a Gumbel top-k sample by the importance of target text over raw text.

    The weight of a text is the ratio of its likelihoods under two generative models of hashed n-grams, of good texts
    (quality 1, not toxic) and of all texts. A few toxic words hardly move that sum, so a text is also judged by its most
    toxic n-gram, by the shares of toxic and clean labelled documents that have it; it is left out above the cut that
    suits the held-out labels best. k is the number of the other texts whose log weight reaches the cut that suits the
    held-out labels best (quality 0 and toxic ones are bad), so that what the labels call bad is left out whatever the
    corpus's size; those k are drawn without replacement in proportion to their weights, which differ by less than the
    noise near the cut only. Without toxic labels on both sides of the split nothing
    is left out as toxic. Returns doc_id, log_weight, key and kept for each row. Null and empty texts have log
    weight 0; a null doc_id draws noise like an id, repeated rows draw the same, and ties at the last place are all
    kept; labels with a null are not used; without labels what weighs 0 or more is kept. An empty table gives no rows.
    Other columns go but ``carry``, if named.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc"), ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"), "quality", (F.coalesce("toxic", F.lit(0)) == 1).alias("toxic")).dropna().dropDuplicates(["doc"])
    usable = usable.orderBy(F.xxhash64("doc"), "doc").limit(MOST_LABELS)
    held = F.pmod(F.xxhash64("doc", F.lit("held")), F.lit(2)) == 0
    role = F.when(held & F.col("good"), "good").when(held & ((F.col("quality") == 0) | F.col("toxic")), "bad").when(~held & F.col("good"), "fit")
    side = F.concat(F.when(held, "held ").otherwise("fit "), F.when(F.col("toxic"), "toxic").otherwise("clean"))
    docs = id_and_text(docs, carry).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "carried", "text")
    docs = docs.join(F.broadcast(usable.select("doc", role.alias("role"), side.alias("side"))), "doc", "left")  # MOST_LABELS short rows at most
    weights = stored(weigh(docs, *model(docs), seed), "weights")
    seen = weights.where("role in ('good', 'bad')").select("role", "log_weight").collect()
    cut = best_cut(*[np.array([r["log_weight"] for r in seen if r["role"] == role]) for role in ("good", "bad")])
    sides = weights.where("side in ('held toxic', 'held clean')").select("side", "toxicity").collect()
    toxic, clean = (np.array([r["toxicity"] for r in sides if r["side"] == side]) for side in ("held toxic", "held clean"))
    fits = F.col("toxicity") <= -best_cut(-clean, -toxic) if len(toxic) else F.lit(True)
    k = weights.where((F.col("log_weight") >= cut) & fits).count()
    last = kth_place(weights.where(fits), k) if k else 0
    kept = fits & (F.col("place") >= last) if k else F.lit(False)
    carried = [F.col("carried").alias(carry)] if carry else []
    return weights.select(F.nullif("doc", F.lit(NULL_ID)).alias("doc_id"), *carried, "log_weight", "key", kept.alias("kept"))
