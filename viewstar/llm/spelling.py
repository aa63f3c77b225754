"""Spelling variant grouping: words one edit apart, found in k-d trees over their letter counts.

A word of n letters is a point of letter counts.  One replaced letter lowers
one count by one and raises another; one inserted letter raises one count.  So
the near words of a word lie in the tree of its own length, at most one step
down and one step up, and in the tree of the next length, one step up and none
down: box-pruned range searches per pair of lengths, whose hits are verified
letter by letter.  Counts are kept in unary in one 64-bit word (32 letter
classes, counts up to 2, a higher count is 2), so a box is the AND and the OR
of its points, and a step is a bit; merged classes and the bound only make
distances smaller, which never loses a hit.

The top of each length's tree cuts the points into cells (planes fitted on a
bounded sample, see ``SAMPLE_WORDS``; every word is indexed).  A word goes to
one cell as a point and, as a query, to every cell its steps reach.  A task
holds the points of one cell as a tree and lets the queries stream past; a
cell above its size (equal letter counts cannot be split) is dealt over salts
by the word's hash, and queries go to each.  Words of over ``LONGEST`` letters
take one cell a length, salted alike.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least twice its own; its root follows the forms to
the last one, by pointer doubling over written tables.

Null texts hold no words; a null id is empty in the hash below.  An empty table
gives no rows.  Rows that repeat count each.  Other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm.tables import hash_share, importable, texts, written
from viewstar.llm.textkit import FOLD_TABLE, text_bytes

#: Runs of ``[A-Za-zÀ-ÿ]``, A-Z folded, that may give a word of MIN_LETTERS.
MIN_LETTERS = 5
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)
#: Occurrences a word needs.
MIN_COUNT = 3
#: A run is shortened where this divides its hash.
SLIP = 97
#: Words the planes of the cells are fitted on (every word is then indexed), and the points a cell should hold.
SAMPLE_WORDS, CELL_WORDS = 100_000, 40_000
#: Longer words take one cell a length.
LONGEST = 64
#: Points of a leaf, pairs verified at once, words counted in a task before they are handed on.
LEAF, PAIRS_AT_ONCE, WORDS_HELD = 48, 1 << 18, 300_000

U64 = np.uint64


def _letter_classes() -> np.ndarray:
    lut = np.zeros(256, np.uint8)
    lut[97:123] = np.arange(26)
    lut[0xC0:] = 26 + np.arange(64) % 6
    return lut


_CLASS = _letter_classes()


def _counted(batches):
    """(id text, text) to (word, n), partial counts."""
    counts: Counter[str] = Counter()

    def handed_on():
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                         ["word", "n"])
        counts.clear()
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        for k, doc in enumerate(batch.column(0).to_pylist()):
            text = raw[offsets[k]:offsets[k + 1]].tobytes().translate(FOLD_TABLE).decode("utf-8", "surrogatepass")
            start = zlib.crc32(f"{doc}:".encode())
            for run, times in Counter(RUN.findall(text)).items():
                h = zlib.crc32(run.encode(), start)
                if h % SLIP == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                    if len(run) < MIN_LETTERS:
                        continue
                counts[run] += times
            if len(counts) > WORDS_HELD:
                yield from handed_on()
    if counts:
        yield from handed_on()


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: every word of at least MIN_LETTERS letters and ``min_count`` occurrences, slips included."""
    importable(docs.sparkSession)
    rows = texts(docs, id_column, text_column).select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "text")
    return rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= min_count)


def letters(words: list[str], size: int) -> np.ndarray:
    """Words of ``size`` letters as a matrix of Latin-1 bytes, whose order is that of the code points."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), size)


def letter_counts(matrix: np.ndarray) -> np.ndarray:
    """Bit 2c: letter class c occurs; bit 2c + 1: twice or more."""
    one, two = np.zeros(len(matrix), U64), np.zeros(len(matrix), U64)
    for column in matrix.T:
        bit = U64(1) << (_CLASS[column].astype(U64) * U64(2))
        two |= one & bit
        one |= bit
    return one | (two << U64(1))


def _even_bit(codes: np.ndarray) -> int | None:
    """The bit (a letter class and a count) that halves the points best; None if all are equal."""
    held = np.unpackbits(codes.view(np.uint8).reshape(len(codes), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    off = np.abs(2 * held - len(codes))
    bit = int(np.argmin(off))
    return None if off[bit] == len(codes) else bit


def _has(codes: np.ndarray, bit: int) -> np.ndarray:
    return (codes >> U64(bit)) & U64(1) == 1


class Planes:
    """The top of one length's tree: inner nodes (bit, node without it, node with it), leaves the numbers of cells."""

    def __init__(self, codes: np.ndarray, levels: int, least: int = 8):
        self.nodes: list[tuple] = []
        self.cells = 0
        self._grow(codes, levels, least)

    def _grow(self, codes: np.ndarray, levels: int, least: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        bit = _even_bit(codes) if levels and len(codes) >= 2 * least else None
        if bit is None:
            self.nodes[at] = (None, self.cells)
            self.cells += 1
        else:
            on = _has(codes, bit)
            self.nodes[at] = (bit, self._grow(codes[~on], levels - 1, least), self._grow(codes[on], levels - 1, least))
        return at

    def reach(self, codes: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, int]]:
        """(rows, cell) for all cells within ``up`` raised and ``down`` lowered counts."""
        todo = [(0, np.arange(len(codes)), np.full(len(codes), up), np.full(len(codes), down))]
        while todo:
            node, rows, ups, downs = todo.pop()
            if not len(rows):
                continue
            if self.nodes[node][0] is None:
                yield rows, self.nodes[node][1]
                continue
            bit, off, on = self.nodes[node]
            has = _has(codes[rows], bit)
            lower, raise_ = has & (downs > 0), ~has & (ups > 0)
            todo.append((off, np.r_[rows[~has], rows[lower]], np.r_[ups[~has], ups[lower]], np.r_[downs[~has], downs[lower] - 1]))
            todo.append((on, np.r_[rows[has], rows[raise_]], np.r_[ups[has], ups[raise_] - 1], np.r_[downs[has], downs[raise_]]))


@dataclass
class Cells:
    """Where words go: planes of the lengths cut into cells, lengths that occur (up to LONGEST), salts of large cells."""
    planes: dict[int, Planes] = field(default_factory=dict)
    lengths: set[int] = field(default_factory=set)
    salts: dict[tuple[int, int], int] = field(default_factory=dict)

    def reach(self, size: int, codes: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, int]]:
        if size in self.planes:
            yield from self.planes[size].reach(codes, up, down)
        elif size > LONGEST or size in self.lengths:
            yield np.arange(len(codes)), 0


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(sizes[order]) != 0, True]) if len(words) else []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield int(sizes[order[lo]]), order[lo:hi]


POINT, SAME, SHORTER = 0, 1, 2
_DEALT = "size int, cell int, salt int, role int, word string, n long"


def _dealt(cells: Cells, roles: tuple[int, ...]):
    """(word, n) to where it is a point, and where it is a query of its own and of the next length."""
    steps = {POINT: (0, 0, 0), SAME: (0, 1, 1), SHORTER: (1, 1, 0)}

    def deal(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            for size, at in _by_length(words):
                codes = letter_counts(letters([words[k] for k in at], size))
                for role in roles:
                    longer, up, down = steps[role]
                    for rows, cell in cells.reach(size + longer, codes, up, down):
                        salts = cells.salts.get((size + longer, cell), 1)
                        taken = pa.array(at[rows])
                        word, n = batch.column(0).take(taken), batch.column(1).take(taken)
                        if role == POINT and salts > 1:
                            own = np.fromiter((zlib.crc32(w.encode()) % salts for w in word.to_pylist()), np.int32, len(rows))
                            copies = [own]
                        else:
                            copies = [np.full(len(rows), salt, np.int32) for salt in range(salts)]
                        for salt in copies:
                            fixed = [pa.array(np.full(len(rows), x, np.int32)) for x in (size + longer, cell, role)]
                            yield pa.RecordBatch.from_arrays([fixed[0], fixed[1], pa.array(salt), fixed[2], word, n],
                                                             ["size", "cell", "salt", "role", "word", "n"])
    return deal


class Tree:
    """A k-d tree over the points of a cell (their words in code-point order)."""

    def __init__(self, words: list[str], n: np.ndarray, size: int):
        self.words, self.n, self.size = words, n, size
        self.letters = letters(words, size)
        self.codes = letter_counts(self.letters)
        self.nodes: list[tuple] = []
        self._grow(np.arange(len(words)))
        self.near = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, str]] = {}

    def _grow(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        codes = self.codes[rows]
        self.nodes.append(())
        bit = _even_bit(codes) if len(rows) > LEAF else None
        box = (np.bitwise_and.reduce(codes), np.bitwise_or.reduce(codes))
        if bit is None:
            self.nodes[at] = (*box, rows, None)
        else:
            on = _has(codes, bit)
            self.nodes[at] = (*box, self._grow(rows[~on]), self._grow(rows[on]))
        return at

    def hits(self, codes: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, points) within the steps by letter counts, in bounded portions."""
        todo = [(0, np.arange(len(codes)))]
        while todo:
            node, rows = todo.pop()
            least, most, left, right = self.nodes[node]
            own = codes[rows]
            rows = rows[(np.bitwise_count(least & ~own) <= up) & (np.bitwise_count(own & ~most) <= down)]
            if not len(rows):
                continue
            if right is not None:
                todo += [(left, rows), (right, rows)]
                continue
            for lo in range(0, len(left), LEAF):
                points = left[lo:lo + LEAF]
                q, p = np.nonzero(np.bitwise_count(codes[rows][:, None] ^ self.codes[points][None, :]) <= up + down)
                if len(q):
                    yield rows[q], points[p]

    def _verified(self, matrix: np.ndarray, q: np.ndarray, p: np.ndarray) -> np.ndarray:
        same = matrix.shape[1] == self.size
        out = []
        step = max(1, PAIRS_AT_ONCE * 8 // self.size)
        for lo in range(0, len(q), step):
            a, b = matrix[q[lo:lo + step]], self.letters[p[lo:lo + step]]
            if same:
                out.append((a != b).sum(1) == 1)
            else:
                front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
                back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
                out.append(front + back >= matrix.shape[1])
        return np.concatenate(out) if out else np.zeros(0, bool)

    def search(self, words: list[str], n: np.ndarray, role: int) -> list[tuple[str, int, int, str]]:
        """(word, near words here, largest count, its word) of the queries with a near word here.  Queries of the
        next shorter length also count for the points, see :meth:`of_points`."""
        order = sorted(range(len(words)), key=words.__getitem__)
        words, n = [words[k] for k in order], n[order]
        matrix = letters(words, self.size - (role == SHORTER))
        q, p, held = [], [], 0
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def verify():
            rows, points = np.concatenate(q), np.concatenate(p)
            right = self._verified(matrix, rows, points)
            found.append((rows[right], points[right]))
        for rows, points in self.hits(letter_counts(matrix), 1, int(role == SAME)):
            q.append(rows)
            p.append(points)
            held += len(rows)
            if held > PAIRS_AT_ONCE:
                verify()
                q, p, held = [], [], 0
        if held:
            verify()
        if not found:
            return []
        rows, points = (np.concatenate(x) for x in zip(*found))
        if role == SHORTER:
            for k, times, best in _largest(points, rows, n):
                self.near[k] += times
                mine = (-int(n[best]), words[best])
                self.best[k] = min(self.best.get(k, mine), mine)
        return [(words[k], times, int(self.n[best]), self.words[best]) for k, times, best in _largest(rows, points, self.n)]

    def of_points(self) -> list[tuple[str, int, int, str]]:
        return [(self.words[k], int(self.near[k]), -minus, word) for k, (minus, word) in self.best.items()]


def _largest(of: np.ndarray, other: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int]]:
    """(of, how many, the other of largest n, then smallest number) per distinct ``of``."""
    if not len(of):
        return []
    order = np.lexsort((other, -n[other], of))
    of, other = of[order], other[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    return list(zip(of[first].tolist(), np.diff(np.r_[first, len(of)]).tolist(), other[first].tolist()))


def _searched(batches):
    """Rows of a cell come together, points first: (word, near, best_n, best) partial rows."""
    def table(rows):
        word, near, best_n, best = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()),
                                           pa.array(best_n, pa.int64()), pa.array(best, pa.string())],
                                          ["word", "near", "best_n", "best"])
    here, points, tree = None, [], None
    for batch in batches:
        key = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
        cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1), True]) if len(key) else []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            place, role = tuple(key[lo][:3].tolist()), int(key[lo][3])
            if place != here:
                if tree and (rows := tree.of_points()):
                    yield table(rows)
                here, points, tree = place, [], None
            words, n = batch.column(4).slice(lo, hi - lo).to_pylist(), batch.column(5).slice(lo, hi - lo).to_numpy()
            if role == POINT:
                points.append((words, n))
                continue
            if tree is None and points:
                tree = Tree([w for part, _ in points for w in part], np.concatenate([x for _, x in points]), place[0])
                points = []
            if tree and (rows := tree.search(words, n, role)):
                yield table(rows)
    if tree and (rows := tree.of_points()):
        yield table(rows)


def cells_of(words: DataFrame, sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> Cells:
    """Planes from a sample of at most about ``sample_words`` words; counts over all words."""
    importable(words.sparkSession)
    short = words.where(F.length("word") <= LONGEST).select("word", F.length("word").alias("size"))
    counts = {r["size"]: r["c"] for r in short.groupBy("size").agg(F.count(F.lit(1)).alias("c")).collect()}
    cells = Cells(lengths=set(counts))
    large = [size for size, c in counts.items() if c > cell_words]
    if large:
        total = sum(counts[size] for size in large)
        sample = hash_share(short.where(F.col("size").isin(large)), F.col("word"), F.lit(sample_words), F.lit(total))
        for size, group in sample.toPandas().groupby("size"):
            levels = int(np.ceil(np.log2(counts[size] / cell_words)))
            cells.planes[int(size)] = Planes(letter_counts(letters(sorted(group["word"]), int(size))), levels)
    at = words.select("word", "n").mapInArrow(_dealt(cells, (POINT,)), _DEALT).groupBy("size", "cell").agg(
        F.count(F.lit(1)).alias("c")).where(F.col("c") > 2 * cell_words).collect()
    cells.salts = {(r["size"], r["cell"]): -(-r["c"] // cell_words) for r in at}
    return cells


def near_words(words: DataFrame, sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n_near, best, best_n of every word of ``words`` (word, n) with a word one edit away."""
    cells = cells_of(words, sample_words, cell_words)
    place = ["size", "cell", "salt"]
    return words.select("word", "n").mapInArrow(_dealt(cells, (POINT, SAME, SHORTER)), _DEALT) \
        .repartition(*place).sortWithinPartitions(*place, "role", "word") \
        .mapInArrow(_searched, "word string, near long, best_n long, best string") \
        .groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")) \
        .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of (word, form), by doubling; a form is at least twice as
    frequent, so chains are at most log2 of the largest count long."""
    up = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        far = up.select(F.col("word").alias("root"), F.col("root").alias("far"))
        fresh = written(up.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"),
                                                            F.col("far").isNotNull().alias("moved")), "spelling-roots")
        up = fresh.select("word", "root")
        if fresh.where("moved").isEmpty():
            return up


def group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_count: int = MIN_COUNT,
          sample_words: int = SAMPLE_WORDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    words = written(vocabulary(docs, id_column, text_column, min_count), "spelling-words")
    near = near_words(words, sample_words, cell_words)
    strong = F.col("best_n") >= 2 * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best")).alias("form"),
        F.when(strong, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
