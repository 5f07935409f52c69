"""The n-gram join against all pairs of sets, also where many meet and blocks are small."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import ngram_join
from tests.llm.test_llm import odd_texts, passage


def by_hand(texts: list[tuple[int | None, str | None]]) -> Counter:
    sets = []
    for _, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))
    for x in range(len(texts)):
        for y in range(x):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                low, high = sorted((root[x], root[y]))
                root = [low if r == high else r for r in root]
    names = {r: min((texts[k][0] for k in range(len(texts)) if root[k] == r and texts[k][0] is not None), default=None) for r in root}
    return Counter((i, len(own), names[r]) for (i, _), own, r in zip(texts, sets, root, strict=True))


def found(spark, texts: list) -> Counter:
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    return Counter(tuple(r) for r in ngram_join.join(docs).select("doc_id", "n_shingles", "component_id").collect())


def edited(text: str, at: set[int], new: str = "new") -> str:
    return " ".join(f"{new}{k}" if k in at else w for k, w in enumerate(text.split()))


@pytest.mark.parametrize(("few", "block", "most"), [(16, 1000, (4, 32, None)), (2, 5, (1, None))])
def test_all_pairs(spark, small, monkeypatch, few, block, most):
    """The small table, and texts of every length with copies near the threshold."""
    for name, value in (("FEW", few), ("BLOCK", block), ("ROUNDS", most)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = np.random.default_rng(11)
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for k in range(60):
        n = int(rng.integers(5, 120))
        own = passage(5000 + k, n)
        texts += [(10_000 + 3 * k, own), *[(10_000 + 3 * k + c, edited(own, set(rng.integers(0, n, max(1, n // 45)).tolist())).upper()) for c in (1, 2)]]
    assert found(spark, texts) == by_hand(texts)


def test_large_group(spark, monkeypatch):
    """Copies of one text, most of whose pairs are too far apart to link, and texts that share a passage only."""
    for name, value in (("FEW", 3), ("BLOCK", 7), ("ROUNDS", (1, 3, None))):
        monkeypatch.setattr(ngram_join, name, value)
    rng = np.random.default_rng(5)
    base, shared = passage(1, 150), passage(2, 60)
    texts = [(k, edited(base, set(rng.integers(0, 150, int(rng.integers(1, 6))).tolist()), f"n{k}_")) for k in range(90)]
    texts += [(100 + k, f"{shared} {passage(300 + k, 90)}") for k in range(40)]
    assert found(spark, texts) == by_hand(texts)


def test_odd_texts(spark):
    texts = [*odd_texts(), (30, "A b"), (31, "a B"), (32, "a b c d e"), (33, "a b c d e f"), (34, "x y x y x y x y x y x y"), (35, "y x y x y x y x y x"), (None, "a\tb")]
    assert found(spark, texts) == by_hand(texts)


def test_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "A b c d e f g")], "doc_id long, text string")
    clashing = docs.withColumns({c: F.lit("x") for c in ("node", "key", "n", "mark", "name", "id", "root", "size", "center")})
    assert {r["component_id"] for r in ngram_join.join(clashing).collect()} == {1}
    assert ngram_join.join(docs.where("false")).count() == 0
    assert ngram_join.join(docs.limit(1)).count() == 1
