"""Fingerprints by consistent weighted sampling of word shingles.

Each term (a hashed shingle, weighted by how often it occurs) has, for each of SAMPLES samples, r and c drawn from
Gamma(2, 1) and b from [0, 1). A term of weight w gets t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r; the
term with the least a is the sample. Two texts have the same sample with the probability of their generalised Jaccard
similarity, the sum of least over the sum of largest weights.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import id_and_text
from tallywright.llm.hashing import BASES, mix, prefix_sums, ranges, slices, word_bounds, word_hashes

SHINGLE = 5
SAMPLES = 128
#: Documents fingerprinted at once, and terms drawn for at once.
CHUNK, TERMS_AT_ONCE = 128, 256
NULL_ID = -(2**63)
#: What tells the numbers of the samples apart, drawn once from a fixed seed; odd.
OF_SAMPLE = np.random.Generator(np.random.PCG64(20240911)).integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Gamma(2, 1) is drawn by its quantiles, this many at equal steps.
QUANTILES = 1 << 16


def gamma_quantiles() -> np.ndarray:
    """The middle of each of QUANTILES equal shares of Gamma(2, 1), by bisection of 1 - e^-x (1 + x)."""
    share = (np.arange(QUANTILES) + 0.5) / QUANTILES
    low, high = np.zeros(QUANTILES), np.full(QUANTILES, 40.0)
    for _ in range(48):
        middle = (low + high) / 2
        below = 1 - np.exp(-middle) * (1 + middle) < share
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


GAMMA = gamma_quantiles().astype(np.float32)
LOG_GAMMA = np.log(gamma_quantiles()).astype(np.float32)


def draws(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ln c, r, b) for each of ``terms`` (64-bit hashes) and sample: c and r from Gamma(2, 1), b from [0, 1).

    Every draw comes from a hash of the whole term and the number of the sample, so that no two terms share theirs: 16
    bits of it for c, 16 for r and 32 for b.
    """
    h = terms[:, None] * OF_SAMPLE
    h ^= h >> np.uint64(32)
    h *= ODD
    h ^= h >> np.uint64(29)
    last = np.uint64(QUANTILES - 1)
    b = (h >> np.uint64(32)).astype(np.float32)
    b *= np.float32(2.0**-32)
    return np.take(LOG_GAMMA, (h & last).view(np.int64)), np.take(GAMMA, (h >> np.uint64(16) & last).view(np.int64)), b


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight) of each different shingle of each text, by text and term."""
    found = []
    for first, data, offsets in slices(pa.array(texts, pa.large_string())):
        starts, ends, heads = word_bounds(data, offsets)
        sums = prefix_sums(word_hashes(data, starts, ends), BASES[1])
        counts = np.diff(heads)
        n = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
        row = np.repeat(np.arange(len(counts)), n)
        begin = heads[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        term = ranges(sums, BASES[1], begin, np.minimum(begin + SHINGLE, heads[row + 1]))
        order = np.lexsort((term, row))
        row, term = row[order], term[order]
        new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])))) if len(row) else np.zeros(0, np.int64)
        found.append((first + row[new], term[new], np.diff(np.append(new, len(row)))))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))


def signatures(texts: list[str]) -> np.ndarray:
    """SAMPLES 16-bit values of each text; all zero without words.

    A sample is told by its ln a, which the term, t and the sample's number decide; 16 hashed bits of it are kept. The
    terms of all texts are drawn for once each, TERMS_AT_ONCE at a time, so memory doesn't grow with a text.
    """
    rows, terms, weights = shingles(texts)
    low = np.full((len(texts), SAMPLES), np.inf, np.float32)
    every, which = np.unique(terms, return_inverse=True)
    order = np.argsort(which, kind="stable")  # by term, texts ascending for each
    edges = np.searchsorted(which[order], np.arange(0, len(every) + TERMS_AT_ONCE, TERMS_AT_ONCE))
    for k, (x, y) in enumerate(zip(edges, edges[1:], strict=False)):
        own = order[x:y]
        own = own[np.argsort(rows[own], kind="stable")]
        first = k * TERMS_AT_ONCE
        ln_c, r, b = draws(every[first : first + TERMS_AT_ONCE])
        at, weight = which[own] - first, weights[own]
        values = np.take(ln_c - r * (1 - b), at, axis=0)  # t = 0 for a weight of 1
        more = np.flatnonzero(weight > 1)
        if len(more):
            z = at[more]
            t = np.floor(np.log(weight[more].astype(np.float32))[:, None] / r[z] + b[z])
            values[more] = ln_c[z] - r[z] * (t + 1 - b[z])
        heads = np.flatnonzero(np.diff(rows[own], prepend=-1))
        text = rows[own][heads]
        low[text] = np.minimum(low[text], np.minimum.reduceat(values, heads, axis=0))
    out = (mix(low.view(np.uint32).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    out[np.isinf(low)] = 0
    return out


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame) -> DataFrame:
    """(part, carried, doc, text): runs of consecutive documents, and after each run the document that follows it.

    Parts are ranges of doc_id of about equal size, as many as shuffles have partitions, which later stream through their
    tasks; the driver gets their bounds and largest ids, however many documents there are.
    """
    ids = docs.select("doc")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.unique(np.array(ids.approxQuantile("doc", [k / parts for k in range(1, parts)], 0.02 / parts), np.int64)) if parts > 1 else np.zeros(0, np.int64)

    def part_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.searchsorted(bounds, batch["doc"].to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), batch["doc"]], ["part", "doc"])

    tops = {r["part"]: r["top"] for r in ids.mapInArrow(part_of, "part int, doc long").groupBy("part").agg(F.max("doc").alias("top")).collect()}
    order = sorted(tops)
    # what follows a part, descending, is the top of the part below it; what follows the last part is the first's top
    follows = dict(zip(order, [order[-1], *order[:-1]], strict=True)) if order else {}
    needed = {tops[below]: part for part, below in follows.items()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch["doc"].to_numpy()
            part = np.searchsorted(bounds, doc, "right").astype(np.int32)
            more = np.flatnonzero(np.isin(doc, list(needed)))
            take = pa.array(np.concatenate((np.arange(len(doc)), more)))
            parts = np.concatenate((part, np.array([needed[x] for x in doc[more].tolist()], np.int32)))
            carried = np.repeat([0, 1], [len(doc), len(more)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(carried), batch["doc"].take(take), batch["text"].take(take)], ["part", "carried", "doc", "text"])

    return docs.mapInArrow(deal, "part int, carried int, doc long, text string")


def with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
    """(doc, text, next text) of each document of runs in order."""
    held: tuple[int, int, str] | None = None
    for batch in batches:
        for part, carried, doc, text in zip(*(batch[c].to_pylist() for c in ("part", "carried", "doc", "text")), strict=True):
            if held and held[0] == part:
                yield held[1], held[2], text
                held = None
            if not carried:
                held = (part, doc, text)


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def one(chunk: list[tuple[int, str, str]]) -> pa.RecordBatch:
        ids, texts, following = zip(*chunk, strict=True)
        edits = [edited(a, b) for a, b in zip(texts, following, strict=True)]
        seen = {x: k for k, x in enumerate(dict.fromkeys((*texts, *edits, *following)))}
        prints = signatures(list(seen))
        own, edit, after = (prints[[seen[x] for x in group]] for group in (texts, edits, following))
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(x) for x in texts], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits]),
            pa.array([x.astype(">u2").tobytes().hex() for x in own]), pa.array([x.astype(">u2").tobytes().hex() for x in edit]),
            pa.array((own == edit).mean(axis=1)), pa.array((own == after).mean(axis=1)),
        ], ["doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    chunk: list[tuple[int, str, str]] = []
    for row in with_next(batches):
        chunk.append(row)
        if len(chunk) == CHUNK:
            yield one(chunk)
            chunk = []
    if chunk:
        yield one(chunk)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit, by consistent weighted sampling of five-word shingles.

    The edit replaces the last half of a text by the beginning of the next document's, in descending doc_id (after the
    last: the first). Each sample is drawn for the whole hash of a shingle, so unlike texts stay unlike however long they
    are. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (SAMPLES times 4 hex
    digits), near_edited and near_next (shares of equal samples). A null text is empty; a text of fewer words is one
    shingle; texts without words have fingerprint zero and are alike. A null doc_id comes last; rows with the same
    doc_id follow each other by descending text. A lone document is its own next; an empty table gives no rows. Other
    columns go.
    """
    docs = id_and_text(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "text")
    rows = in_order(docs).repartition("part").sortWithinPartitions("part", "carried", F.desc("doc"), F.desc("text"))
    out = rows.mapInArrow(compared, "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.select(F.nullif("doc", F.lit(NULL_ID)).alias("doc_id"), *out.columns[1:])
