"""Grouping of spelling variants: k-d trees over letter-count vectors.

One edit changes the letter counts of a word by one letter more, one less, or one of each, so the vectors of near words
are at most two apart. The words of each length get a k-d tree; its cells are shared out among tasks, and every word
searches the cells that its range can reach, in the tree of its own length and in that of words one letter longer. In a
cell a k-d tree over the different vectors finds those in range by pruning boxes, and the words behind them are compared
letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import id_and_text, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One in so many words of a document, by hash, loses a letter before words are counted.
SLIPS = 31
#: Letters are counted in so many places: a to z, and all others by their code in the rest.
PLACES = 32
LETTER = np.array([c - 97 if 97 <= c <= 122 else 26 + c % 6 for c in range(256)])
#: Words that decide how the trees are cut into cells, at most; they settle where work is done, not what is found.
SAMPLE = 100_000
#: Words of a cell; one with more is dealt to pieces.
CELL = 50_000
LEAF = 48
#: Words counted by a task before it hands on its counts.
HELD = 500_000
#: Pairs of words compared at once. Vectors with more pairs are met by equal halves of their words first.
PAIRS = 1 << 21


def slip(run: str, seed: int) -> str:
    """``run`` as it is counted in a document whose id, with a colon, has CRC-32 ``seed``."""
    h = zlib.crc32(run.encode(), seed)
    if h % SLIPS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, least_letters: int) -> DataFrame:
    """(word, n): occurrences of words of at least ``least_letters`` letters over all documents."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
                    if len(run) >= least_letters and len(word := slip(run, seed)) >= least_letters:
                        sums[word] += n
                if len(sums) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), pa.int64())], ["word", "n"])
                    sums = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], ["word", "n"])

    return id_and_text(docs).select("doc_id", "text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str]) -> np.ndarray:
    """The letters of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each row."""
    out = np.zeros((len(codes), PLACES), np.int8)
    rows = np.arange(len(codes))
    for column in LETTER[codes].T:
        out[rows, column] += 1
    return out


class Tree:
    """A k-d tree over rows of letter counts: median cuts along the letter that varies most."""

    def __init__(self, points: np.ndarray, most: int) -> None:
        self.nodes: list[tuple[int, int, int, int]] = []  # letter, cut, and the nodes up to and above it; or -1 and a cell
        self.members: list[np.ndarray] = []
        self.points = points
        self._grow(np.arange(len(points)), most)

    def _grow(self, own: np.ndarray, most: int) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, len(self.members), 0, 0))
        points = self.points[own]
        low, high = (points.min(axis=0), points.max(axis=0)) if len(own) else (np.zeros(1), np.zeros(1))
        if len(own) <= most or (low == high).all():
            self.members.append(own)
            return at
        letter = int(np.argmax(points.var(axis=0)))
        cut = min(int(np.median(points[:, letter])), int(high[letter]) - 1)
        below = points[:, letter] <= cut
        self.nodes[at] = (letter, cut, self._grow(own[below], most), self._grow(own[~below], most))
        return at

    def homes(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            letter, cut, left, right = self.nodes[node]
            if letter < 0:
                out[own] = cut
                continue
            below = points[own, letter] <= cut
            todo += [(left, own[below]), (right, own[~below])]
        return out

    def reached(self, points: np.ndarray, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, which of ``points``): cells whose box may hold a vector with one letter more and ``fewer`` less, or none of both."""
        none = np.zeros(len(points), np.int8)
        todo = [(0, np.arange(len(points)), none, none, {}, {})]
        while todo:
            node, own, more, less, low, high = todo.pop()
            letter, cut, left, right = self.nodes[node]
            if letter < 0:
                yield cut, own
                continue
            value = points[own, letter]
            over = np.maximum(value - cut, 0) - (np.maximum(value - high[letter], 0) if letter in high else 0) + less
            under = np.maximum(cut + 1 - value, 0) - (np.maximum(low[letter] - value, 0) if letter in low else 0) + more
            take = over <= fewer
            if take.any():
                todo.append((left, own[take], more[take], over[take], low, {**high, letter: cut}))
            take = under <= 1
            if take.any():
                todo.append((right, own[take], under[take], less[take], {**low, letter: cut + 1}, high))


def marks(points: np.ndarray) -> np.ndarray:
    """Two words of 64 bits for each vector: a bit for each of a letter's first four occurrences."""
    bits = points[:, :, None] > np.arange(4)
    return np.packbits(bits.reshape(len(points), -1), axis=1).view(np.uint64)


class Cell:
    """The words of a cell, by vector."""

    def __init__(self, words: list[str], n: list[int]) -> None:
        codes = letters(words)
        points = vectors(codes)
        own, which = np.unique(points.view(f"V{PLACES}").ravel(), return_inverse=True)
        self.vectors = own.view(np.int8).reshape(-1, PLACES)
        order = np.argsort(which, kind="stable")
        self.words, self.n, self.codes = np.array(words, object)[order], np.array(n, np.int64)[order], codes[order]
        self.ends = np.concatenate(([0], np.cumsum(np.bincount(which))))
        self.marks = marks(self.vectors)
        self.tree = Tree(self.vectors, LEAF)

    def in_range(self, other: Cell, fewer: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a vector of ``other`` and one of this cell that has one letter more and ``fewer`` less, or is equal."""
        found = [np.zeros((2, 0), np.int64)]
        for leaf, asked in self.tree.reached(other.vectors, fewer):
            members = self.tree.members[leaf]
            for k in range(0, len(asked), 4096):
                own = asked[k : k + 4096]
                a, b = other.marks[own][:, None, :], self.marks[members][None, :, :]
                fits = (np.bitwise_count(b & ~a).sum(axis=2, dtype=np.uint8) <= 1) & (np.bitwise_count(a & ~b).sum(axis=2, dtype=np.uint8) <= fewer)
                x, y = np.nonzero(fits)
                found.append(np.stack((own[x], members[y])))
        return tuple(np.concatenate(found, axis=1))


def one_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` differ by one replaced letter, or one that ``b`` has more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    head = np.cumprod(a == b[:, :n], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    return head + tail >= n


def equal_rows(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of equal rows of ``a`` and ``b``, in runs of about PAIRS."""
    both = np.ascontiguousarray(np.concatenate((a, b)))
    _, which = np.unique(both.view(f"V{both.shape[1]}").ravel(), return_inverse=True)
    left, right = which[: len(a)], which[len(a) :]
    order = np.argsort(right, kind="stable")
    start, end = np.searchsorted(right[order], left), np.searchsorted(right[order], left, "right")
    yield from ((x, order[y]) for x, y in laid_out(np.arange(len(a)), np.arange(len(a)) + 1, start, end))


def laid_out(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every number of a range from ``a`` with every one of its range from ``b``, in runs of about PAIRS."""
    size = (a_end - a) * (b_end - b)
    totals = np.cumsum(size)
    first = 0
    while first < len(size):
        before = totals[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(totals, before + PAIRS, "right")))
        of = np.repeat(np.arange(first, last), size[first:last])
        k = np.arange(len(of)) - np.repeat(totals[first:last] - size[first:last] - before, size[first:last])
        width = (b_end - b)[of]
        yield a[of] + k // np.maximum(width, 1), b[of] + k % np.maximum(width, 1)
        first = last


def near_words(asked: Cell, cell: Cell, fewer: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of near words of ``asked`` and ``cell``, as their numbers there; once each if both are the same cell."""
    x, y = cell.in_range(asked, fewer)
    if asked is cell:
        x, y = x[x <= y], y[x <= y]
    size = np.diff(asked.ends)[x] * np.diff(cell.ends)[y]
    small = size <= PAIRS
    for i, j in laid_out(asked.ends[x[small]], asked.ends[x[small] + 1], cell.ends[y[small]], cell.ends[y[small] + 1]):
        good = one_apart(asked.codes[i], cell.codes[j]) & ((asked is not cell) | (i < j))
        yield i[good], j[good]
    for u, v in zip(x[~small].tolist(), y[~small].tolist(), strict=True):  # one edit leaves the first or the last half as it is
        a, b = asked.codes[asked.ends[u] : asked.ends[u + 1]], cell.codes[cell.ends[v] : cell.ends[v + 1]]
        half = a.shape[1] // 2
        for turn, (own, other) in enumerate(((a[:, :half], b[:, :half]), (a[:, half:], b[:, half - a.shape[1] :]))):
            for i, j in equal_rows(own, other):
                good = one_apart(a[i], b[j])
                if turn:
                    good &= (a[i, :half] != b[j, :half]).any(axis=1)  # else found in the first turn
                i, j = i[good] + asked.ends[u], j[good] + cell.ends[v]
                own_order = (asked is not cell) | (i < j)
                yield i[own_order], j[own_order]


def cut_trees(words: DataFrame, cell: int) -> tuple[dict[int, Tree], dict[int, np.ndarray]]:
    """A tree for each length, from a sample, and the numbers of pieces of its cells, from counts of all words."""
    total = words.count()
    one_in = max(1, -(-total // SAMPLE))
    sample = [r["word"] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0).select("word").collect()]
    trees = {n: Tree(vectors(letters(own)), max(1, cell // (2 * one_in))) for n in sorted({len(w) for w in sample}) if (own := [w for w in sample if len(w) == n])}
    for tree in trees.values():
        tree.members, tree.points = [np.zeros(0, np.int64)] * len(tree.members), np.zeros((0, PLACES), np.int8)

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, lengths = batch["word"].to_pylist(), batch["length"].to_numpy()
            home = np.zeros(len(own), np.int32)
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                if n in trees:
                    home[at] = trees[n].homes(vectors(letters([own[k] for k in at])))
            yield pa.RecordBatch.from_arrays([batch["length"], pa.array(home)], ["length", "cell"])

    counts = words.select("word", F.char_length("word").alias("length")).mapInArrow(at_home, "length int, cell int").groupBy("length", "cell").count().collect()
    pieces: dict[int, np.ndarray] = {r["length"]: np.ones(len(trees[r["length"]].members) if r["length"] in trees else 1, np.int64) for r in counts}
    for r in counts:
        pieces[r["length"]][r["cell"]] = max(1, -(-r["count"] // cell))
    return trees, pieces


def shared_out(words: DataFrame, trees: dict[int, Tree], pieces: dict[int, np.ndarray]) -> DataFrame:
    """(length, cell, kind, word, n): each word in its cell (kind 0), and in the later cells of its length (1) and in those of
    the next length (2) that it must search. Pieces of a cell count as cells."""
    starts = {n: np.concatenate(([0], np.cumsum(x))) for n, x in pieces.items()}
    lone = Tree(np.zeros((0, PLACES), np.int8), 1)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, lengths, n, piece = batch["word"].to_pylist(), batch["length"].to_numpy(), batch["n"].to_numpy(), batch["piece"].to_numpy()
            rows, length, cells, kinds = [], [], [], []

            def add(which: np.ndarray, tree_of: int, cell: np.ndarray, kind: int) -> None:
                rows.append(which)
                length.append(np.full(len(which), tree_of, np.int32))
                cells.append(cell.astype(np.int32))
                kinds.append(np.full(len(which), kind, np.int32))

            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                points = vectors(letters([own[k] for k in at]))
                tree, start, count = trees.get(size, lone), starts[size], pieces[size]
                home = tree.homes(points)
                home = start[home] + piece[at] % count[home]
                add(at, size, home, 0)
                for kind, searched in ((1, size), (2, size + 1)):
                    if searched not in pieces:
                        continue
                    for cell, which in trees.get(searched, lone).reached(points, 2 - kind):
                        for k in range(starts[searched][cell], starts[searched][cell + 1]):
                            own_ones = which[home[which] < k] if kind == 1 else which
                            add(at[own_ones], searched, np.full(len(own_ones), k), kind)
            rows = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.concatenate(x)) for x in (length, cells, kinds)), batch["word"].take(pa.array(rows)), pa.array(n[rows])], ["length", "cell", "kind", "word", "n"],
            )

    words = words.select("word", "n", F.char_length("word").alias("length"), F.pmod(F.xxhash64("word"), F.lit(1 << 30)).alias("piece"))
    return words.mapInArrow(dealt, "length int, cell int, kind int, word string, n long")


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n), both ways, of the rows of cells in order: a cell's own words are held, those that search it pass by."""
    key: tuple | None = None
    words: list[str] = []
    n: list[int] = []
    cell: Cell | None = None

    def pairs(asked: Cell, own: Cell, fewer: int) -> Iterator[pa.RecordBatch]:
        for i, j in near_words(asked, own, fewer):
            if len(i):
                columns = [np.concatenate(x) for x in ((asked.words[i], own.words[j]), (own.words[j], asked.words[i]), (own.n[j], asked.n[i]))]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2])], ["word", "near", "near_n"])

    def held() -> Iterator[pa.RecordBatch]:
        nonlocal cell
        if words and cell is None:
            cell = Cell(words, n)
            yield from pairs(cell, cell, 1)

    for batch in batches:
        marks = np.stack([batch[c].to_numpy() for c in ("length", "cell", "kind")])
        edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *edges], [*edges, len(batch)], strict=True):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            length, number, kind = marks[:, start].tolist()
            if key != (length, number):
                yield from held()
                key, words, n, cell = (length, number), [], [], None
            if kind == 0:
                words.extend(part["word"].to_pylist())
                n.extend(part["n"].to_pylist())
            elif words:
                yield from held()
                yield from pairs(Cell(part["word"].to_pylist(), part["n"].to_pylist()), cell, 2 - kind)
    yield from held()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where ``forms`` (word, form) lead to; each round follows twice as many. Forms are ever more frequent, so chains end."""
    state = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(state.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        state = after.select("word", "root")


def variants(docs: DataFrame, least_letters: int = 7, least_n: int = 2, times: int = 10, cell: int = CELL) -> DataFrame:
    """Words of the documents and the more frequent words that they are spelling variants of.

    Words are runs of letters up to U+00FF, A-Z lower-cased, of which one in SLIPS in each document, by hash, has lost a
    letter; those of ``least_letters`` letters and ``least_n`` occurrences are kept. Two are near if they differ by exactly
    one inserted, deleted or replaced letter. Returns word, form (the most frequent near word, ties by code points, if it
    is ``times`` times as frequent), root (where forms lead, or the word), n, n_near and form_n. Null and empty texts
    have no words; a null doc_id counts as an empty one in the hash; repeated rows count singly; an empty table gives no
    rows. Other columns go. ``cell`` bounds the words that one task searches in; it changes no result.
    """
    words = stored(word_counts(docs, least_letters).where(F.col("n") >= least_n), "words")
    rows = shared_out(words, *cut_trees(words, cell)).repartition("length", "cell").sortWithinPartitions("length", "cell", "kind")
    near = rows.mapInArrow(searched, "word string, near string, near_n long")
    near = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = words.join(near, "word", "left")
    has = -F.col("best.less") >= times * F.col("n")
    out = stored(out.select("word", F.when(has, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, -F.col("best.less")).alias("form_n")), "variants")
    led = roots(out.where("form is not null"))
    return out.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
