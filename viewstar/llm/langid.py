"""Language identification by prediction by partial matching (PPM).

Per language a variable-order byte context tree with escape probabilities
(method C) is learned from a bounded sample and then frozen.  A byte's code
length is -log2 of its probability in the longest context in which it was
seen, each shorter context costing an escape.  The trees are kept sparse: per
depth, a hash table of the grams (context and byte) that any language has
seen, with their exact code lengths under every language, and one of the
contexts with their escapes.  So a text is scored with about one lookup per
byte at any depth and alphabet, and the language with the shortest total code
wins.

Symbols: the 26 letters with case folded, one for every other ASCII byte, and
one for each byte above 127 seen in training (one more for all unseen ones).
The depth is a parameter (3) and never changes by itself; the model holds the
grams of the sample, so it is bounded by the sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm import textkit as tk
from viewstar.llm.tables import TEXT_BYTES, by_batch, hash_share, small_batches, text_key, texts, without, written

UNDETERMINED = "und"
ORDER = 3
_TEXTS = 64  # texts of a language whose grams are held apart
_SPAN = 1 << 17  # bytes scored at once (a hundred times as much is taken for them)

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
#: Training alphabet: folded letters and high bytes as they are, all else a space.
_RAW = np.where(_LETTERS | (np.arange(256) > 127), np.arange(256), 32).astype(np.uint8)
_RAW[65:91] += 32


class _Rows:
    """Row numbers of distinct codes (their places in the array given): open addressing over numpy arrays."""

    def __init__(self, codes: np.ndarray):
        self.shift = 64 - max(int(2 * len(codes)).bit_length(), 4)
        mask = (1 << (64 - self.shift)) - 1
        self.code = np.full(mask + 1, -1, dtype=np.int64)
        self.row = np.zeros(mask + 1, dtype=np.int32)
        left, at = np.arange(len(codes)), self._slot(codes)
        while len(left):
            free = self.code[at] < 0
            _, one = np.unique(at[free], return_index=True)
            taken = np.flatnonzero(free)[one]
            self.code[at[taken]] = codes[left[taken]]
            self.row[at[taken]] = left[taken]
            rest = np.ones(len(left), dtype=bool)
            rest[taken] = False
            left, at = left[rest], (at[rest] + 1) & mask

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Row of each code, -1 for one that is not there."""
        at, mask = self._slot(codes), len(self.code) - 1
        there = self.code[at]
        out = np.where(there == codes, self.row[at], -1)
        left = np.flatnonzero((there != codes) & (there >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & mask
            there = self.code[at]
            same = there == codes[left]
            out[left[same]] = self.row[at[same]]
            more = ~same & (there >= 0)
            left, at = left[more], at[more]
        return out


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray   # byte -> symbol
    size: int            # number of symbols
    order: int
    first: np.ndarray    # (size, languages) code lengths in bits without context, float32
    grams: list[tuple[_Rows, np.ndarray]]    # per depth from 1: grams seen by any language, their code lengths
    escapes: list[tuple[_Rows, np.ndarray]]  # per depth from 1: contexts seen by any language, bits of their escape

    def _bits(self, code: np.ndarray) -> np.ndarray:
        """Code lengths of grams of full depth (a byte per symbol, the last one lowest); (grams, languages)."""
        out = np.zeros((len(code), len(self.languages)), dtype=np.float32)
        left = np.arange(len(code))
        for depth in range(self.order, 0, -1):
            own = code[left] & ((1 << 8 * (depth + 1)) - 1)
            rows, cost = self.grams[depth - 1]
            row = rows.of(own)
            hit = row >= 0
            out[left[hit]] += cost[row[hit]]
            left, own = left[~hit], own[~hit]
            if not len(left):
                return out
            rows, cost = self.escapes[depth - 1]
            row = rows.of(own >> 8)
            known = row >= 0  # a context no language has seen costs nothing to leave
            out[left[known]] += cost[row[known]]
        out[left] += self.first[code[left] & 255]
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Total bits of each text under each language; (texts, languages), float64."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        sym = self.symbol[data]
        for lo in range(0, len(sym), _SPAN):
            hi = min(lo + _SPAN, len(sym))
            code = sym[lo:hi].astype(np.int64)
            starts = offsets[(offsets >= lo - self.order) & (offsets < hi)]
            for back in range(1, self.order + 1):
                before = np.zeros(hi - lo, dtype=np.int64)
                take = max(back - lo, 0)
                if take < hi - lo:
                    before[take:] = sym[lo + take - back:hi - back]
                for k in range(back):  # what lies before a text's start counts as a space
                    at = starts + k - lo
                    before[at[(at >= 0) & (at < hi - lo)]] = 0
                code += before << 8 * back
            bits = self._bits(code)
            first = np.searchsorted(offsets, lo, side="right") - 1
            last = np.searchsorted(offsets, hi, side="left")
            rows = np.arange(first, last)
            begin = np.maximum(offsets[rows], lo) - lo
            some = np.minimum(offsets[rows + 1], hi) - lo > begin
            if some.any():
                total[rows[some]] += np.add.reduceat(bits, begin[some], axis=0, dtype=np.float64)
        return total

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, posterior) of each text of a batch."""
        raw, offsets = tk.text_bytes(column)
        names, scores = [], []
        for lo, hi in tk.bounds(offsets, _SPAN):
            data, off = raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            bits = self.code_lengths(data, off)
            best = bits.argmin(axis=1) if len(self.languages) else np.zeros(hi - lo, dtype=int)
            odds = np.exp2(np.maximum(bits.min(axis=1, initial=np.inf, keepdims=True) - bits, -1000.0))
            share = 1.0 / np.maximum(odds.sum(axis=1), 1.0)
            letters = np.append(0, np.cumsum(_LETTERS[data]))
            spoken = letters[off[1:]] > letters[off[:-1]]
            high = np.append(0, np.cumsum(data > 127))
            for i in np.flatnonzero(~spoken & (high[off[1:]] > high[off[:-1]])):
                spoken[i] = any(map(str.isalpha, bytes(data[off[i]:off[i + 1]]).decode("utf-8", "replace")))
            spoken &= bool(self.languages)
            names += [self.languages[b] if s else UNDETERMINED for b, s in zip(best, spoken)]
            scores.append(np.where(spoken, share, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def _gram_counts(labelled: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): folded byte grams of ``order`` context bytes and one more, counted by Spark."""
    def merged(parts: list[np.ndarray]) -> np.ndarray:
        both = np.concatenate(parts, axis=1)
        grams, inverse = np.unique(both[0], return_inverse=True)
        return np.stack([grams, np.bincount(inverse, weights=both[1]).astype(np.int64)])

    def count(batch):
        langs = batch.column("lang").to_pylist()
        raw, offsets = tk.text_bytes(batch.column("text"))
        groups: dict[str, list[np.ndarray]] = {}
        for i, lang in enumerate(langs):
            data = raw[offsets[i]:offsets[i + 1]]
            if len(data):
                padded = np.concatenate([np.full(order, 32, np.uint8), _RAW[data]]).astype(np.int64)
                gram = np.zeros(len(data), dtype=np.int64)
                for k in range(order + 1):
                    gram = gram * 256 + padded[k:k + len(data)]
                own = groups.setdefault(lang, [])
                own.append(np.stack(np.unique(gram, return_counts=True)))
                if len(own) >= _TEXTS:
                    groups[lang] = [merged(own)]
        for lang, parts in groups.items():
            grams, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)],
                                             ["lang", "gram", "n"])
    return (by_batch(labelled, count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _sums(code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their rows."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(counts[order], first, axis=0) if len(first) else counts[:0]


def _trees(code: np.ndarray, counts: np.ndarray, size: int, order: int):
    """(first, grams, escapes) of :class:`Model` from counts (grams of full depth, languages): PPM method C."""
    bits = lambda p: -np.log2(p).astype(np.float32)
    total, kinds, dense = counts.sum(axis=0), np.zeros(counts.shape[1]), np.zeros((size, counts.shape[1]))
    symbols, times = _sums(code & 255, counts)
    dense[symbols] = times
    kinds = np.count_nonzero(dense, axis=0)
    all_ = np.maximum(total + kinds, 1)
    escape = np.where(total > 0, kinds / all_, 1.0)
    level = np.where(dense > 0, dense / all_, escape / size)
    first, grams, escapes = bits(level), [], []
    below = np.arange(size)
    for depth in range(1, order + 1):
        own, n = _sums(code & ((1 << 8 * (depth + 1)) - 1), counts)
        context, total = _sums(own >> 8, n)
        _, kinds = _sums(own >> 8, (n > 0).astype(np.float64))
        all_ = np.maximum(total + kinds, 1)
        escape = np.where(total > 0, kinds / all_, 1.0)
        of = np.searchsorted(context, own >> 8)
        shorter = level[np.searchsorted(below, own & ((1 << 8 * depth) - 1))]
        level, below = np.where(n > 0, n / all_[of], escape[of] * shorter), own
        grams.append((_Rows(own), bits(level)))
        escapes.append((_Rows(context), bits(escape)))
    return first, grams, escapes


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
          sample_docs: int | None = 1500, order: int = ORDER) -> Model:
    """Learn from about ``sample_docs`` documents of each language (all, if there are fewer, or for None),
    chosen by the hash of id and text.  Rows without text or language are not used.

    Only gram counts come to the driver.
    """
    labelled = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"),
                           F.col(lang_column).cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(256, np.int16), 1, 0, np.zeros((1, 0), np.float32), [], [])
    languages = sorted(sizes)
    learned = labelled
    if sample_docs is not None:
        many = F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))])
        learned = hash_share(labelled, F.struct("id", "text"), F.lit(float(sample_docs)), many[F.col("lang")])
    grams = _gram_counts(learned, order).toPandas()
    codes = grams["gram"].to_numpy(dtype=np.int64)
    raw = np.stack([(codes >> (8 * (order - k))) & 255 for k in range(order + 1)])
    high = np.unique(raw[raw > 127])
    symbol = np.zeros(256, dtype=np.int16)
    symbol[65:91] = symbol[97:123] = np.arange(1, 27)
    symbol[128:] = 27 + len(high)
    symbol[high] = 27 + np.arange(len(high))
    size = 28 + len(high)
    code = np.zeros(len(codes), dtype=np.int64)
    for row in raw:
        code = code << 8 | symbol[row]
    owner = np.searchsorted(np.array(languages), grams["lang"].to_numpy().astype(str))
    counts = np.zeros((len(codes), len(languages)))
    counts[np.arange(len(codes)), owner] = grams["n"].to_numpy(dtype=np.float64)
    return Model(languages, symbol, size, order, *_trees(*_sums(code, counts), size, order))


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score), one row per input row, from the text alone.

    ``score`` is the winner's posterior under equal priors.  ``und`` with score
    0 stands for a null or empty text, one without letters, and a model that
    learned no language.  Equal code lengths go to the language that sorts
    first.  Repeated rows are scored alike; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch):
        names, scores = shared.value.predict(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(scores)],
                                         ["id", "lang_pred", "score"])
    return by_batch(texts(docs, id_column, text_column), score, "id long, lang_pred string, score double",
                    TEXT_BYTES)


def spoken(docs: DataFrame, model: Model, min_score: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns, as they are) whose text has a language.

    Rejected: ``und``, and texts whose best language has a posterior below
    ``min_score`` (no language explains them better than the rest together).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def unlikely(batch):
        names, scores = shared.value.predict(batch.column("text"))
        yield batch.select(["key"]).filter(pa.array([n == UNDETERMINED or s < min_score for n, s in zip(names, scores)]))
    keyed = docs.withColumn("__key", text_key(text_column))
    with small_batches(docs.sparkSession):
        gone = written(by_batch(keyed.select(F.col("__key").alias("key"), F.col(text_column).cast("string").alias("text")),
                                unlikely, "key string").select(F.col("key").alias("__key")).distinct(), "without-language")
    return without(keyed, gone, "__key").select(*docs.columns)
