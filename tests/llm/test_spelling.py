"""Spelling variants against all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import spelling

RESULT = ("word", "form", "root", "n", "n_near", "form_n")


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_hand(texts: list[tuple[int | None, str | None]]) -> set[tuple]:
    counts: Counter = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    around = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and near(w, v)] for w in counts}
    form = {w: best for w in counts if around[w] and counts[best := min(around[w], key=lambda v: (-counts[v], v))] >= 10 * counts[w]}
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(around[w]), counts[form[w]] if w in form else None))
    return out


def found(spark, texts: list, **options: int) -> set[tuple]:
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "cell", "length", "kind", "piece")}).repartition(3)
    return {tuple(r[c] for c in RESULT) for r in spelling.variants(docs, **options).collect()}


def odd_words() -> list[tuple[int | None, str | None]]:
    rng = np.random.default_rng(3)
    few = ["".join(rng.choice(list("abé"), int(rng.integers(7, 10)))) for _ in range(500)]  # many anagrams
    chain = "variants " * 2_000 + "variantz " * 150 + "variantzz " * 9 + "variantzza " * 2 + "wariants " * 2 + "VARIANTE variante"
    texts = [(k, " ".join(rng.choice(few, 60))) for k in range(60)]
    return [*texts, (None, None), (None, "naïvetés naïvetés NAÏVETÉS"), (61, ""), (62, " 123 "), (63, chain), (63, "repeated rows rowsrows"), (63, "repeated rows rowsrows"), (64, "x" * 300 + " " + "x" * 300 + " " + "x" * 299 + " " + "x" * 299)]


@pytest.mark.parametrize(("cell", "pairs"), [(50_000, 1 << 21), (40, 1 << 21), (40, 2)])
def test_variants(spark, monkeypatch, cell, pairs):
    """Words of few letters; one cell and many, with pieces."""
    if pairs == 2:  # in this process, so that the constant holds: large buckets are met by halves
        monkeypatch.setattr(spelling, "PAIRS", pairs)
        words = sorted({w for _, t in odd_words() for w in (t or "").split() if len(w) == 8 and w.isalpha()})
        own = spelling.Cell(words, [1] * len(words))
        got = [tuple(sorted((own.words[i], own.words[j]))) for x, y in spelling.near_words(own, own, 1) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
        assert sorted(got) == sorted((a, b) for k, a in enumerate(words) for b in words[k + 1 :] if near(a, b))
        longer = sorted({w + "a" for w in words} | {"b" + w for w in words})
        other = spelling.Cell(longer, [1] * len(longer))
        got = [(own.words[i], other.words[j]) for x, y in spelling.near_words(own, other, 0) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
        assert sorted(got) == sorted((a, b) for a in words for b in longer if near(a, b))
        return
    assert found(spark, odd_words(), cell=cell) == by_hand(odd_words())


def test_small_table(spark, small):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert found(spark, texts, cell=500) == by_hand(texts)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "short words")], "doc_id long, text string")).count() == 0
