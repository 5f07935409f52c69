"""The Merkle manifest against a tree built by hand, with blocks of several sizes."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallywright.llm import manifest
from tallywright.llm.more_queries import op11_manifest


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row: tuple) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree_by_hand(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each leaf (sibling before, sibling after) on each level."""
    steps: list[list[tuple[str, str]]] = [[] for _ in leaves]
    level, at = list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, place in enumerate(at):
            before = level[place - 1] if place % 2 else ""
            after = level[place + 1] if place % 2 == 0 and place + 1 < len(level) else ""
            steps[k].append((before, after))
        level = [h(*level[k : k + 2]) for k in range(0, len(level), 2)]
        at = [place // 2 for place in at]
    return level[0], steps


def by_hand(rows: list[tuple]) -> Counter:
    """rows (doc_id, source, lang, n_chars, text) -> the rows of op11."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs = {}
    for lang in order:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(r)))
        subs[lang] = tree_by_hand([leaf_by_hand(r) for r in groups[lang]])
    root, tops = tree_by_hand([subs[x][0] for x in order])
    out = Counter()
    for lang, top in zip(order, tops, strict=True):
        for row, steps in zip(groups[lang], subs[lang][1], strict=True):
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                changed = (*row[:3], row[3] + 1, row[4])
            node = leaf_by_hand(changed)
            for before, after in [*steps, *top]:
                node = h(before, node, after)
            out[row[0], leaf_by_hand(row), subs[lang][0], root, h(*[x for s in [*steps, *top] for x in s]), node, node == root] += 1
    return out


COLUMNS = "doc_id source lang n_chars text".split()
RESULT = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


def odd_rows() -> list[tuple]:
    rows = [(k, f"src{k % 3}", "en", 10 * k, f"text {k}") for k in range(37)]
    rows += [(k, None, "fr", None, "é" * k) for k in range(100, 109)] + [(200, "a", None, 1, None), (201, "b", None, 2, ""), (None, None, None, None, None)]
    return rows + [(7, "x", "lone", 3, "long " * 30_000), (5, "src2", "en", 50, "other"), *[(9, "same", "fr", 1, "same")] * 5, (None, "y", "fr", 1, "z"), (None, "y", "fr", 1, "z"), (3, "", "", 0, "")]


@pytest.mark.parametrize("size", [1024, 4, 2])
def test_manifest(spark, tmp_path, monkeypatch, size):
    """Nulls in every column, ties, repeated rows, groups of one, and columns whose names the operator uses inside."""
    monkeypatch.setattr(manifest.manifest, "__defaults__", (*manifest.manifest.__defaults__[:-1], size))
    docs = spark.createDataFrame(odd_rows(), "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    docs.withColumns({c: F.lit("clash") for c in ("grp", "pos", "n", "leaf", "witness", "root", "at", "block", "carried", "by_0")}).write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter(tuple(r) for r in op11_manifest(spark, str(tmp_path)).select(RESULT).collect())
    assert found == by_hand(odd_rows())


def test_many_groups(spark):
    rows = [(k, "s", f"g{k % 23}", k, "t") for k in range(300)]
    leaves = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    leaves = leaves.withColumn("leaf", manifest.leaf([F.col(c) for c in COLUMNS]))
    out = manifest.manifest(leaves, size=4).withColumn("folded", manifest.fold(F.col("leaf"), F.col("witness"))).collect()
    assert {r["root"] for r in out} == {key[3] for key in by_hand(rows)} == {r["folded"] for r in out} and len(out) == 300


def test_whole_small_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select(COLUMNS).collect()]
    assert Counter(tuple(r) for r in op11_manifest(spark, small).select(RESULT).collect()) == by_hand(rows)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, lang string, leaf string")
    assert manifest.manifest(none).count() == 0
