"""Operators against brute force, on whole small tables and on odd rows.

The odd rows hold nulls in any column, empty and long texts, ties, repeated rows and extra columns whose names the
operators use inside.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tallywright.llm import fingerprints, hashing, mixing, packing, quality_classifier, quality_rules, sharding, simhash, substring_dedup, suffix_dedup, url_rules
from tallywright.llm.common import stored
from tools.check_queries import compare, duck

CLASHES = ("key doc near node root a b n core low part rank length tokens share budget kept verdict w role at starts anchors print first label n_tokens "
           "kept_id cut_id cut_text n_removed lang_ domain text_crc32 size slot place bucket").split()
WORDS = [f"w{k}" for k in range(400)]


def passage(seed: int, n: int) -> str:
    return " ".join(WORDS[x] for x in np.random.default_rng(seed).integers(0, 400, n))


def odd_texts() -> list[tuple[int | None, str | None]]:
    shared = passage(1, 70)
    near = passage(2, 200).split()
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "one two three"), (6, f"{passage(3, 30)} {shared} {passage(4, 40)}"),
        (7, f"{passage(5, 20)}\n{shared}\n{passage(6, 10)}"), (8, shared), (9, shared), (10, " ".join(near)),
        (11, " ".join([*near[:100], "edited", *near[101:]])), (12, passage(7, 13)), (13, f"{passage(7, 13)} more"), (14, "ab " * 700),
        (15, "Été çà\u3000où\x0bnaïve été\x85x" * 30), (None, f"{passage(8, 40)}"), (17, passage(9, 12_000)), (18, f"<|endoftext|> {passage(10, 30)}"),
        (19, passage(11, 60)), (19, passage(11, 60)), (-5, f"{shared} tail"), (21, "The THE the the the the the the the the the the"),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, source, len(t) if t else None) for (i, t), lang, source in zip(odd_texts(), ["en", "fr", None, "xx"] * 6, ["src0", None, "src1"] * 8, strict=False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (7, 1, None), (14, 0, 0), (None, 1, 0), (10, None, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents(spark, small):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def removed_bytes(texts: list[bytes], length: int) -> list[bytes]:
    """One flag byte for each byte."""
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(bytes(gone))
    return out


def check_suffixes(rows: list, texts: list[tuple], length: int) -> None:
    raw = [(t or "").encode() for _, t in texts]
    want = Counter()
    for (i, _), t, gone in zip(texts, raw, removed_bytes(raw, length), strict=True):
        spans = len(re.findall(b"\x01+", gone))
        want[(i, len(t), sum(gone), spans, bytes(b for b, x in zip(t, gone, strict=True) if not x))] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows) == want


@pytest.mark.parametrize("most", [1000, 1])
def test_suffix_dedup(spark, small, odd, monkeypatch, most):
    """Bucket sort, and counting by name for cores of more surroundings than a bucket takes."""
    monkeypatch.setattr(suffix_dedup, "MOST_IN_BUCKET", most)
    check_suffixes(suffix_dedup.dedup(odd, 400).collect(), odd_texts(), 400)
    if most == 1:
        check_suffixes(suffix_dedup.dedup(spark.read.parquet(f"{small}/documents.parquet")).collect(), list(documents(spark, small).items()), 400)


def test_suffix_dedup_short_period(spark):
    """Strings whose every place is alike have an anchor at each place."""
    texts = [(1, "x" * 900), (2, "y" * 400), (3, "z" * 399), (4, "z" * 399), (5, "ab" * 201), (6, "abc" * 400 + passage(3, 100))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    check_suffixes(suffix_dedup.dedup(docs).collect(), texts, 400)


def check_passages(rows: list, texts: list[tuple], window: int) -> None:
    order = lambda i: -(2**63) if i is None else i
    lists = [(i, words_of(t)) for i, t in texts]
    first: dict[tuple, int] = {}
    for i, words in lists:
        for k in range(len(words) - window + 1):
            gram = tuple(words[k : k + window])
            first[gram] = min(first.get(gram, 2**63), order(i))
    want = Counter()
    for i, words in lists:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < order(i):
                gone[k : k + window] = [True] * window
        want[(i, len(words), sum(gone), " ".join(w for w, x in zip(words, gone, strict=True) if not x))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in rows) == want


@pytest.mark.parametrize("window", [13, 50])
def test_substring_dedup(odd, window):
    check_passages(substring_dedup.dedup(odd, window).collect(), odd_texts(), window)


def test_substring_dedup_frequent(spark, monkeypatch):
    """Anchors that many documents share go another way to the same result."""
    monkeypatch.setattr(substring_dedup, "SHOWN", 1)
    monkeypatch.setattr(substring_dedup, "FREQUENT_LEAST", 3)
    texts = [(i, f"{passage(i, 20)} {passage(999, 15)} {passage(i + 500, i)}") for i in range(1, 30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert len(substring_dedup.frequent_keys(docs.withColumnRenamed("doc_id", "doc"), 13))
    check_passages(substring_dedup.dedup(docs, 13).collect(), texts, 13)


def test_substring_dedup_spacing(spark):
    shared = passage(1, 50)
    docs = spark.createDataFrame([(1, f"a  b\n{shared}"), (2, f" c\t{shared}\n\nd  e "), (3, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in substring_dedup.dedup(docs, 50, spacing=True).collect()} == {1: f"a  b\n{shared}", 2: " c\td  e ", 3: ""}


def same_ids() -> list[tuple[int | None, str | None]]:
    """Two null ids and a repeated id with texts of different lengths, the longer with passages of others."""
    shared, other = passage(51, 220), passage(52, 230)
    return [
        (None, f"{passage(53, 90)} {shared} {passage(54, 60)}"), (None, passage(55, 8)), (None, f"{passage(56, 140)} {other}"), (4, shared),
        (7, passage(57, 20)), (7, f"{passage(58, 300)} {other} {shared} {passage(59, 9)}"), (7, f"{other} {passage(60, 200)}"), (7, passage(57, 20)), (9, f"{other} {passage(61, 30)} {shared}"),
    ]


@pytest.mark.parametrize("most", [1000, 1])
def test_suffix_dedup_same_ids(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_IN_BUCKET", most)
    docs = spark.createDataFrame(same_ids(), "doc_id long, text string").repartition(2)
    check_suffixes(suffix_dedup.dedup(docs, 400).collect(), same_ids(), 400)


@pytest.mark.parametrize("window", [13, 50])
def test_substring_dedup_same_ids(spark, window):
    docs = spark.createDataFrame(same_ids(), "doc_id long, text string").repartition(2)
    check_passages(substring_dedup.dedup(docs, window).collect(), same_ids(), window)


def test_cut_passages_same_ids(spark):
    """Each row keeps its own text where rows share a doc_id or have none."""
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in same_ids()], "doc_id long, text string, n_chars long")
    want = Counter((r["doc_id"], " ".join(r["text"].split())) for r in substring_dedup.dedup(docs, 50).collect())
    assert Counter((r["doc_id"], " ".join(r["text"].split())) for r in corpus_pipeline.cut_passages(spark, docs, "").collect()) == want


@pytest.mark.parametrize("period", substring_dedup.COVERS)
def test_difference_covers(period):
    members = substring_dedup.COVERS[period]
    assert {(a - b) % period for a in members for b in members} == set(range(period))


def rooms_by_best_fit(lengths: list[int], capacity: int) -> list[int]:
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(5)
    for _ in range(60):
        capacity = int(rng.integers(5, 90))
        counts = {int(n): int(rng.integers(1, 20)) for n in rng.integers(1, capacity + 1, 12)}
        bins = defaultdict(list)
        for length, _first, items, per, first_bin, offset in packing.plan(counts, capacity):
            for i in range(items):
                bins[first_bin + i // per].append((offset + i % per * length, length))
        for own in bins.values():
            ends = [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
            assert [a for a, _ in sorted(own)] == ends
        assert sorted(capacity - sum(n for _, n in own) for own in bins.values()) == rooms_by_best_fit([n for n, c in counts.items() for _ in range(c)], capacity)


def token_ids(texts: list[str]) -> list[list[int]]:
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    return [[*e.ids, 0] for e in model.encode_batch(texts, add_special_tokens=False)]


def test_pack(odd):
    rows = packing.pack(odd, 2048).collect()
    want, lengths = Counter(), []
    for (i, _), ids in zip(odd_texts(), token_ids([t or "" for _, t in odd_texts()]), strict=True):
        head = (len(ids) - 1) % 2048 + 1
        at = [0, *range(head, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
            lengths.append(b - a)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        assert [a for a, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
    assert sorted(2048 - sum(n for _, n in own) for own in bins.values()) == rooms_by_best_fit(lengths, 2048)


def test_pack_added_tokens(spark):
    """The registered query and the pipeline give the ids of the tokenizer file at its defaults."""
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " x<|endoftext|>  y\n", "<|endoftext| >", passage(80, 20)]
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: zlib.crc32(np.array([*model.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["ids_crc32"] for r in corpus_pipeline.pack(spark, docs, "").collect()} == want
    assert {r["doc_id"]: r["ids_crc32"] for r in packing.pack(docs, added=packing.added_tokens()).collect()} == want


def test_gumbel_top_k_and_place(spark):
    keys = [3.5, -1.25, 0.0, -0.0, 7.0, 7.0, -1e300, 2.0**-1000]
    place = np.array(keys).view(np.int64)
    place = np.where(place < 0, place ^ np.int64(2**63 - 1), place)
    rows = spark.createDataFrame([(int(x),) for x in place], "place long")
    for k in range(1, len(keys) + 1):
        assert quality_classifier.kth_place(rows, k) == sorted(place.tolist(), reverse=True)[k - 1]


def test_best_cut():
    assert quality_classifier.best_cut(np.array([5.0, 6.0]), np.array([-3.0, 1.0])) == 3.0
    assert quality_classifier.best_cut(np.zeros(0), np.zeros(0)) == 0.0
    assert quality_classifier.best_cut(np.array([2.0]), np.zeros(0)) == 1.0


def mixed(h: int) -> int:
    h &= 2**64 - 1
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> 33) * factor % 2**64
    return h ^ h >> 33


def buckets_of(text: str | None) -> list[int]:
    """Every n-gram of a text, one at a time: words, pairs of words and three bytes, 2^14 buckets for each kind."""
    def hashed(word: bytes) -> int:
        return mixed(sum(int(hashing._BYTE_VALUES[x]) * pow(hashing.BASES[0], i, 2**64) for i, x in enumerate(word)) + len(word))

    data = (text or "").encode()
    words = [hashed(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", data)]
    pairs = [0 if v == w else mixed(v + w * hashing.BASES[1]) >> 50 for v, w in zip(words, words[1:])]
    threes = [mixed(int.from_bytes(data[i : i + 3], "little")) >> 50 for i in range(len(data) - 2)]
    return [w >> 50 for w in words] + [2**14 + p for p in pairs] + [2**15 + t for t in threes]


def classified(docs: list[tuple[int | None, str | None]], marks: dict[int, tuple[int, int]], seed: int) -> list[tuple]:
    """(doc_id, log weight, key, kept) of each row by counting in Python: models, cuts, k, Gumbel keys and their top k."""
    grams = [buckets_of(t) for _, t in docs]
    signed = lambda x: (x % 2**64).to_bytes(8, "little")
    first = {i: xxhash.xxh64_intdigest(signed(i), 42) for i in marks}
    held = {i: xxhash.xxh64_intdigest(b"held", first[i]) % 2 == 0 for i in marks}
    good = {i for i, (quality, toxic) in marks.items() if quality == 1 and not toxic}
    toxic = {i for i, mark in marks.items() if mark[1]}
    raw = Counter(g for row in grams for g in row)
    target = Counter(g for (i, _), row in zip(docs, grams) for g in row if i in good and not held[i])
    ratio = {}
    for kind in range(3):
        own = range(kind << 14, (kind + 1) << 14)
        of_raw, of_target = (sum(c[g] for g in own) + 2**14 for c in (raw, target))
        ratio |= {g: np.log(0.95 * ((target[g] + 1) / of_target) / ((raw[g] + 1) / of_raw) + 0.05) for g in own}
    sides = [[set(row) for (i, _), row in zip(docs, grams) if i in marks and not held[i] and (i in toxic) == side] for side in (True, False)]
    having = [Counter(g for row in rows for g in row) for rows in sides]
    prior = 0.005 + 2 / max(len(sides[1]), 1)
    worst = lambda g: np.log((having[0][g] / len(sides[0]) + prior) / (having[1][g] / len(sides[1]) + prior)) if all(sides) else 0.0
    weights = [round(sum(ratio[g] for g in row), 9) for row in grams]
    toxicity = [max([0.0, *map(worst, set(row))]) for row in grams]
    at = lambda values, ids: [v for (i, _), v in zip(docs, values) if i in ids]
    cut = least_cost(at(weights, {i for i in good if held[i]}), at(weights, {i for i in marks if held[i] and (marks[i][0] == 0 or i in toxic)}))
    fits = [True] * len(docs)
    if at(toxicity, {i for i in toxic if held[i]}):
        most = -least_cost([-x for x in at(toxicity, {i for i in marks if held[i] and i not in toxic})], [-x for x in at(toxicity, {i for i in toxic if held[i]})])
        fits = [x <= most for x in toxicity]
    keys = []
    for (i, _), weight in zip(docs, weights):
        drawn = mixed((quality_classifier.NULL_ID if i is None else i) % 2**64 ^ mixed(seed + 1)) >> 11
        keys.append(weight - np.log(-np.log((drawn + 0.5) / 2**53)))
    k = sum(f and w >= cut for f, w in zip(fits, weights))
    last = sorted((x for f, x in zip(fits, keys) if f), reverse=True)[k - 1] if k else np.inf
    return [(i, weight, key, bool(f and key >= last)) for (i, _), weight, key, f in zip(docs, weights, keys, fits)]


def least_cost(good: list[float], bad: list[float]) -> float:
    """The mean of the cuts of least cost among those below, between and above all values; a rejected good one costs ten."""
    if not good and not bad:
        return 0.0
    values = sorted({*good, *bad})
    cuts = [values[0] - 1, *[(v + w) / 2 for v, w in zip(values, values[1:])], values[-1] + 1]
    costs = [10 * sum(g < c for g in good) + sum(x >= c for x in bad) for c in cuts]
    least = [c for c, cost in zip(cuts, costs) if cost == min(costs)]
    return sum(least) / len(least)


def same_rows(found, want) -> None:
    place = lambda r: (r[0] is None, r[0] or 0, round(r[1], 4))
    found, want = sorted(((r["doc_id"], r["log_weight"], r["key"], r["kept"]) for r in found), key=place), sorted(want, key=place)
    assert [(r[0], r[3]) for r in found] == [(r[0], r[3]) for r in want]
    np.testing.assert_allclose([r[1:3] for r in found], [r[1:3] for r in want], atol=1e-6)


def test_quality_classifier_by_counting(spark, small):
    """The registered query on whole tables: weights, Gumbel keys and kept rows equal those counted one n-gram at a time."""
    small = small.replace("0.001", "0.01")  # the smallest has too few labels of bad texts to leave any out
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    marks = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    want = classified(docs, marks, 8)
    assert 0 < sum(r[3] for r in want) < len(want)
    same_rows(queries()["op8_quality_classifier"](spark, small).collect(), want)


def test_quality_classifier(odd, labels):
    """Odd rows: weights, keys and kept rows as counted one n-gram at a time; all rows come back."""
    rows = quality_classifier.classify(odd, labels).collect()
    same_rows(rows, classified(odd_texts(), {6: (1, 0), 7: (1, 0), 14: (0, 0)}, 0))
    empty = [r for r in rows if r["doc_id"] in (1, 2)]
    assert [r["log_weight"] for r in empty] == [0.0, 0.0]
    twice = [(r["log_weight"], r["key"], r["kept"]) for r in rows if r["doc_id"] == 19]
    assert twice[0] == twice[1]


def test_gumbel_keys_sample_in_proportion():
    """Over many seeds the largest key falls on each of three rows in proportion to their weights."""
    weights = np.log(np.array([0.5, 0.3, 0.2]))
    firsts = [int(np.argmax(weights + quality_classifier.NOISE * quality_classifier.gumbel(np.array([11, 12, 13]), s))) for s in range(20_000)]
    np.testing.assert_allclose(np.bincount(firsts) / 20_000, [0.5, 0.3, 0.2], atol=0.015)


def test_quality_classifier_held_out(spark):
    """Bad texts of held-out labels are left out and good ones kept."""
    rows = [(i, passage(i, 80) if i % 5 else f"{WORDS[i % 400]}! " * 80) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality_classifier.classify(docs, marks).where("kept").collect()}
    assert kept == {i for i in range(400) if i % 5}


def test_quality_classifier_leaves_out_toxic(spark):
    """A few toxic words in texts of quality 1 decide, whatever their other words are."""
    bad = ["vile", "nasty", "awful"]
    text = lambda i: " ".join(bad[(i + k) % 3] if not i % 8 and k % 40 == 7 else w for k, w in enumerate(passage(i, 120).split()))
    docs = spark.createDataFrame([(i, text(i)) for i in range(800)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(0, 800) if i % 16 < 9], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality_classifier.classify(docs, marks).where("kept").collect()}
    assert kept and not {i for i in kept if i % 8 == 0} and len(kept) > 600


def js(p: list[int], q: list[int]) -> float:
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    part = lambda x: np.where(x > 0, x * np.log2(np.maximum(x, 1e-300) / ((p + q) / 2)), 0).sum() / 2
    return float(np.sqrt(max(0, part(p) + part(q))))


def test_quality_rules(odd):
    rows = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in quality_rules.judge(odd).collect()}
    for (i, text), lang in zip(odd_texts(), ["en", "fr", "", "xx"] * 6, strict=False):
        words, text = words_of(text), text or ""
        r = rows[i, len(words), sum(map(len, words))]
        times = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        again = {k + j for k in range(len(words) - 4) if times[tuple(words[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if words_of(x)]
        assert (r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(again) > 20 * len(words))
        assert r["common_distance"] is None or lang in quality_rules.COMMON


def test_divergence(spark):
    row = spark.createDataFrame([([3, 0, 5], [1, 1, 2])], "a array<long>, b array<long>").select(quality_rules.distance(F.col("a"), F.col("b")).alias("d")).first()
    assert row["d"] == pytest.approx(js([3, 0, 5], [1, 1, 2]))


URLS = [
    (1, None), (2, "no scheme"), (3, "HTTP://A.ORG"), (4, "http://x.Example.ORG/es/1?q#f"), (None, "://"), (5, "https://EXAMPLE.org/en/1x"), (5, "https://EXAMPLE.org/en/1x"),
    (6, "a://b://c"), (7, "http://example.com/de/x"), (8, "http://notorg/x"), (9, "http://bad.net?x=/de/"), (10, "http://É.Org/#"), (11, "http://my-example.org/es/"),
    (12, "http://s.example.com/fr/1?a=1&b"), (13, "http://s.example.com/fr"), (14, "x" * 20_000 + "://q.org/" + "p/" * 5_000),
]


def python_rule(url: str | None) -> tuple[str, str, str | None, str | None]:
    rest = (url or "").partition("://")[2]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, rule, verdict


def python_mined(labelled: list[tuple[list[str], str]], sets: list[tuple[str, ...]], support: float, confidence: float) -> dict:
    """Strongest rule for each set of tokens, by listing every combination."""
    both, alone = Counter(), Counter()
    for tokens, verdict in labelled:
        for m in range(1, 1 << len(tokens)):
            items = tuple(t for k, t in enumerate(tokens) if m >> k & 1)
            alone[items] += 1
            both[items, verdict] += 1
    n = len(labelled)
    rules = [(c / alone[i], c / n, len(i), "\n".join(i), set(i), v) for (i, v), c in both.items() if c >= support * n and c / alone[i] >= confidence]
    best = {s: max((r for r in rules if r[4] <= set(s)), default=None, key=lambda r: r[:4]) for s in sets}
    return {s: r[5] for s, r in best.items() if r}


def test_url_rules(spark, small):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumns({c: F.lit(0) for c in ("tokens", "rule", "item", "mined", "host", "path")})
    rows = url_rules.judge(pages).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in rows) == Counter((i, *python_rule(u)[:3]) for i, u in URLS)
    assert all(r["verdict"] in ("allow", "block") for r in rows)


def test_url_rules_mined(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url")
    host, path = url_rules.host_and_path(F.col("url"))
    tokens = {r["page_id"]: tuple(r["t"]) for r in pages.select("page_id", url_rules.tokens(F.col("url"), host, path).alias("t")).collect()}
    found = {r["page_id"]: python_rule(r["url"]) for r in pages.collect()}
    labelled = [(list(tokens[i]), x[3]) for i, x in found.items() if x[3]]
    mined = python_mined(labelled, [tokens[i] for i, x in found.items() if not x[3]], 0.1, 0.8)
    want = {i: x[3] or mined.get(tokens[i], "allow") for i, x in found.items()}
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, least_support=0.1, least_confidence=0.8).collect()} == want
    assert set(mined.values()) == {"allow", "block"} or mined


def test_url_rules_of_long_urls(spark):
    """A URL of 40 words that a thousand pages repeat is one item, and any of its words stands for it."""
    long = "http://a.test/" + "/".join(f"s{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40))
    urls = [f"http://x.org/{'/'.join(['w' + c for c in 'abc'])}"] * 1000 + [long.replace("a.test", "b.com").replace("b.com/", "b.com/de/")] * 1000
    urls += [long, "http://a.test/saa", "http://a.test/wa", "http://a.test/none"] + ["http://z.test/" + "/".join(f"long{k}x" for k in range(3000))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages).collect()}
    assert [found[k] for k in range(2000, 2005)] == ["block", "block", "allow", "allow", "allow"] and found[1500] == "block" and found[3] == "allow"


def components_by_hand(prints: list[int], bits: int) -> list[int]:
    root = list(range(len(prints)))
    for _ in prints:
        for i in range(len(prints)):
            root[i] = min(root[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= bits)
    return root


def print_by_hand(text: str | None) -> int:
    parts = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words_of(text)]
    grams = [" ".join(parts[k : k + 4]) for k in range(max(1, len(parts) - 3))] if parts else []
    votes = Counter(b for g in grams for h in [xxhash.xxh64_intdigest(g.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(grams))


@pytest.mark.parametrize("meeting", [2000, 3])
def test_simhash(odd, monkeypatch, meeting):
    """Also with meetings that are split."""
    monkeypatch.setattr(simhash, "MEETING", meeting)
    texts = sorted(odd_texts(), key=lambda x: (x[0] is None, x[0]))
    prints = [print_by_hand(text) for _, text in texts]
    names = [texts[k][0] for k in components_by_hand(prints, 4)]
    want = Counter((i, f"{p:016x}", c) for (i, _), p, c in zip(texts, prints, names, strict=True))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()) == want


def test_groups_without_ids(spark):
    """Classes whose doc_ids are all null never name a group that has a doc_id, and a group without ids keeps one row."""
    def edit(seed: int, at: int) -> str:
        return " ".join("new" if k == at else w for k, w in enumerate(passage(seed, 400).split()))

    rows = [(5, passage(70, 400)), *[(None, edit(70, k)) for k in (0, 1, 399)], (None, passage(71, 400)), (None, edit(71, 0)), (None, edit(71, 0)), (None, passage(72, 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_duplicates(docs)
    assert Counter((r["doc_id"], r["component_id"]) for r in found.collect()) == {(5, 5): 1, (None, 5): 3, (None, None): 4}
    kept = Counter((r["doc_id"], r["text"].split()[9]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert kept == {(5, rows[0][1].split()[9]): 1, (None, rows[4][1].split()[9]): 1, (None, rows[7][1].split()[9]): 1}


def test_meetings_are_not_broadcast(spark):
    """A fingerprint meets others in 35 places; Spark sizes them as one row and would send them all through the driver."""
    found = simhash.links(spark.range(3_000).select(F.xxhash64("id").alias("node")), 4)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_copies_broadcast_no_meetings(spark, monkeypatch):
    """The stage of the pipeline, with fingerprints read from files, as they are sized there."""
    plans = {}

    def kept(df, name):
        out = stored(df, name)
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(simhash, "stored", kept)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.xxhash64("id", F.lit(k)) for k in range(9)]).alias("text"))
    assert corpus_pipeline.drop_near_copies(spark, docs, "").count() == 300
    assert "SortMergeJoin" in plans["links"][0] and "Broadcast" not in plans["links"][0]


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2)) if a != b] + [(k, k + 1) for k in range(200, 260)]
    root = {x: x for e in edges for x in e}
    for _ in range(70):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()} == root


def jaccard(a: str, b: str) -> float:
    def grams(text: str) -> Counter:
        words = words_of(text)
        return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()

    a, b = grams(a), grams(b)
    return (a & b).total() / (a | b).total() if a or b else 1.0


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_fingerprints(spark, odd, parts):
    """Edits follow the order across parts; likeness estimates generalised Jaccard similarity of texts of any length."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    order = sorted(odd_texts(), key=lambda x: (-(2**63) if x[0] is None else x[0], x[1] or ""), reverse=True)
    texts = [t or "" for _, t in order]
    rows = fingerprints.fingerprint(odd).collect()
    spark.conf.set("spark.sql.shuffle.partitions", usual)
    edits = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, [*texts[1:], texts[0]], strict=True)]
    want = Counter((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for (i, _), t, e in zip(order, texts, edits, strict=True))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == want
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert prints[8] == prints[9] and prints[1] == prints[2] == "0" * 512
    for r in rows:
        at = next(k for k, (i, _) in enumerate(order) if i == r["doc_id"])
        if r["doc_id"] != 19:
            likeness = jaccard(texts[at], edits[at])
            assert abs(r["near_edited"] - likeness) <= 4 * (likeness * (1 - likeness) / fingerprints.SAMPLES) ** 0.5 + 1e-9


def test_weighted_samples_follow_weights():
    """Without shared hashes, the rate of equal samples is the generalised Jaccard similarity of repeated shingles."""
    a, b = " ".join(["p q r s t u v w"] * 9 + ["x y z"]), " ".join(["p q r s t u v w"] * 4 + ["k l m"])
    pair = fingerprints.signatures([a, b])
    assert abs(float((pair[0] == pair[1]).mean()) - jaccard(a, b)) < 0.15


def test_unlike_texts_of_any_length():
    words = np.array([f"v{k}" for k in range(50_000)])
    for n in (2_000, 20_000, 200_000):
        a, b = (" ".join(words[np.random.default_rng(k).integers(0, 50_000, n)]) for k in (1, 2))
        half = " ".join([*a.split()[: n // 2], *b.split()[: n // 2]])
        pair = fingerprints.signatures([a, b, half])
        assert (pair[0] == pair[1]).mean() < 0.02 and abs((pair[0] == pair[2]).mean() - 1 / 3) < 4 * (2 / 9 / fingerprints.SAMPLES) ** 0.5


def test_sharding(odd):
    rows = sharding.shard(odd, 16).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_texts())
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


@pytest.mark.parametrize("shards", [1, 6, 10, 16])
def test_one_shard_more_takes_rows_only_into_itself(spark, shards):
    rows = sharding.shard(spark.range(2000).selectExpr("id AS doc_id", "'x' AS text"), shards).collect()
    assert all(r["grown_shard"] in (r["shard"], shards) for r in rows) and {r["shard"] for r in rows} == set(range(shards))
    moved = sum(r["grown_shard"] == shards for r in rows)
    assert abs(moved - 2000 / (shards + 1)) < 5 * (2000 * shards / (shards + 1) ** 2) ** 0.5


def test_sharding_moves_only_into_the_new_subtree(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("x"))
    rows = sharding.shard(keys, 16).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(16)) and max(sizes.values()) < 1.4 * 250 and min(sizes.values()) > 0.6 * 250
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {16} and 150 < len(moved) < 330
    # a heavier rack draws rows from everywhere into its region; other regions exchange none
    heavier = sharding.tree(16)
    heavier["region1"]["rack2"] = {"4": 3.0, "5": 1.0}
    again = keys.select(sharding.place(F.col("doc_id"), sharding.tree(16)).alias("a"), sharding.place(F.col("doc_id"), heavier).alias("b")).where("a <> b").collect()
    assert again and all(r["b"] in (4, 5, 6, 7) for r in again)


def test_mixing_budgets(spark):
    """A full leaf's rest goes to its siblings first, then up."""
    leaves = spark.createDataFrame(
        [("a", "en", "s1", 10), ("a", "en", "s2", 100), ("a", "fr", "s3", 100), ("b", "en", "s4", 1000), ("b", "de", "s5", 0)], "domain string, lang string, source string, tokens long")
    found = {r["source"]: r["budget"] for r in mixing.budgets(leaves, {"b": 1}, F.lit(400 / 1210), 1).collect()}
    assert found == {"s1": 10, "s2": 90, "s3": 100, "s4": 200, "s5": 0}
    found = {r["source"]: r["budget"] for r in mixing.budgets(leaves, {"a": 3, "a/en": 3, "b": 1}, F.lit(400 / 1210), 1).collect()}
    assert found == {"s1": 10, "s2": 100, "s3": 100, "s4": 190, "s5": 0}


def test_mixing_prefixes(odd):
    docs = odd.withColumn("domain", F.lit(None).cast("string"))
    sizes = Counter()
    for i, t in odd_texts():
        sizes[i] += len(words_of(t))
    rows = mixing.mix(docs, {}, budget=0.5, max_epochs=3).collect()
    assert all(r["n_tokens"] == len(words_of(dict(odd_texts())[r["doc_id"]])) for r in rows)
    taken = sum(r["epochs"] * r["n_tokens"] + r["cut"] for r in rows)
    assert 0.5 * sizes.total() - 30 <= taken <= 0.5 * sizes.total()
    for leaf in {(r["lang"], r["source"]) for r in rows}:
        assert sum(0 < r["cut"] < r["n_tokens"] for r in rows if (r["lang"], r["source"]) == leaf) <= 1


def test_empty_tables(spark, odd, labels):
    none = odd.where("false")
    pages = spark.createDataFrame([], "page_id long, url string")
    results = [
        suffix_dedup.dedup(none), mixing.mix(none.withColumn("domain", F.lit("x")), {}), packing.pack(none), fingerprints.fingerprint(none), quality_rules.judge(none),
        url_rules.judge(pages), simhash.near_duplicates(none), quality_classifier.classify(none, labels), sharding.shard(none),
        substring_dedup.dedup(none),
    ]
    assert [r.count() for r in results] == [0] * len(results)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0
    assert quality_classifier.classify(odd, labels.where("false")).count() == len(odd_texts())


def test_stages_on_odd_rows(spark, odd, small):
    """Stages keep columns, drop copies, cut passages, and take nulls."""
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, small)
        assert docs.columns == odd.columns, name
        assert docs.count() <= before.count()
    near = corpus_pipeline.drop_near_copies(spark, odd, small).select("doc_id").collect()
    assert {r["doc_id"] for r in near} >= {6, 10, 12, 17, -5, None} and not {2, 3, 9} & {r["doc_id"] for r in near}
    cut = {r["doc_id"]: r for r in corpus_pipeline.cut_passages(spark, odd, small).collect()}
    assert cut[8]["text"] == "" and cut[8]["n_chars"] == 0 and cut[-5]["text"].endswith("tail") and len(words_of(cut[6]["text"])) == 70
    assert cut[1]["text"] is None


def test_rows_of_one_id_are_judged_singly(spark, small):
    """A kept row without a doc_id keeps no other row without one, nor does a repeated doc_id; see ``classify``."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    judged = quality_classifier.classify(docs, spark.read.parquet(f"{small}/labels.parquet"), seed=8, carry="text")
    good, bad = ([r["text"] for r in judged.where(f"kept = {kept}").orderBy(F.abs("log_weight").desc()).limit(3).collect()] for kept in ("true", "false"))
    rows = [(i, t, len(t)) for i, t in zip([None, -1, -2], good, strict=True)] + [(i, t, len(t)) for i in (None, -1) for t in bad]
    more = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumns({"lang": F.lit("en"), "source": F.lit("src0")})
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    kept = corpus_pipeline.classify(spark, docs.select(columns).union(more.select(columns)), small)
    assert {(r["doc_id"], r["text"]) for r in kept.where("coalesce(doc_id, -1) < 0").collect()} == set(zip([None, -1, -2], good, strict=True))


def test_pipeline_by_brute_force(spark, small):
    """Each stage's decisions, taken again from its own input, over the whole small table."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.classify(spark, docs, small)
    judged = quality_classifier.classify(docs, spark.read.parquet(f"{small}/labels.parquet"), seed=8)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in judged.where("kept").collect()}
    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    near = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, kept, small).collect()}
    ids = sorted(rows)
    roots = components_by_hand([print_by_hand(rows[i]) for i in ids], 4)
    assert near == {ids[r] for r in roots}
    cut = corpus_pipeline.cut_passages(spark, docs, small).collect()
    words = {r["doc_id"]: words_of(r["text"]) for r in docs.collect()}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    for r in cut:
        own, gone = words[r["doc_id"]], set()
        for k in range(len(own) - 49):
            if first[tuple(own[k : k + 50])] < r["doc_id"]:
                gone |= set(range(k, k + 50))
        assert words_of(r["text"]) == [w for k, w in enumerate(own) if k not in gone]


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if re.match(r"op\d+_", n)))
def test_sql(spark, name):
    root = "/root/testdata/sf0.01"
    df = queries()[name](spark, root)
    assert compare(df.columns, df.dtypes, [tuple(r) for r in df.collect()], duck(root), oracle_sql()[name]) == ""


def test_each_operator_is_registered():
    found = queries()
    assert all(sum(n.startswith(f"op{k}_") for n in found) == 1 for k in range(1, 14)) and "pipeline" in found
