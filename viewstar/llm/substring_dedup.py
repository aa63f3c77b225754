"""Substring dedup by sliding sentence spans.

A text is cut into sentences (after words ending in . ! or ?, and at line
feeds); a sentence of more than ``max_words`` words is cut at words that its
content names, so text without punctuation has spans too, and a passage is cut
alike wherever it begins.  Every run of ``run`` consecutive sentences is hashed
(96 bits of its words, A-Z folded).  A run of fewer than ``min_words`` words
grows, forwards and backwards, until it holds them, and a text too small for
any run is one run as a whole.  Runs are joined over the whole corpus: of every
run that occurs twice or more, the first occurrence (smallest document id, then
first sentence) stays, and sentences covered by any other are removed.

What moves between tasks: counts of run hashes, delta-coded by range of hash
space, from which a bitmap of fixed size is filled; the occurrences of runs
that the bitmap says repeat; and the texts that lose something.  Words, cuts
and hashes are numpy over a slice of texts at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm import textkit as tk
from viewstar.llm.tables import Bitmap, by_batch, repeated_hashes, texts, written

RUN, MIN_WORDS, MAX_WORDS = 3, 8, 16
#: A run counts as hot if it has over 1 / HOT_SHARE of all occurrences of repeated runs: at most so many are broadcast.
HOT_SHARE = 10_000

_STEP, _STEP2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SENTENCE_ENDS = np.array([33, 46, 63], np.uint8)


# -- sentences and runs of a slice of texts ------------------------------------------------
def _cuts(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, reach: int) -> np.ndarray:
    """Of the words of long sentences (word hashes, each word's sentence bounds), those that begin a piece.

    A word is chosen if, of some ``reach`` consecutive words of its sentence,
    it has the smallest hash of itself and the next word (the last of equal
    ones): so cuts are at most ``reach`` apart, and inside a passage they are
    the passage's own, but for its first and last ``reach`` words.  Of equal
    choices close together, as in repeated words, one in ten words is kept.
    """
    at = np.arange(len(h))
    g = tk.mix(h + np.where(at + 1 < hi, np.append(h[1:], np.uint64(0)), np.uint64(0)) * np.uint64(_STEP))
    smaller_left, reached_right = np.full(len(h), reach), np.full(len(h), reach)
    for j in range(reach - 1, 0, -1):
        left, right = np.roll(g, j), np.roll(g, -j)
        smaller_left[(at - j >= lo) & (left < g)] = j
        reached_right[(at + j < hi) & (right <= g)] = j
    first = np.maximum(lo, at - smaller_left + 1)
    chosen = np.flatnonzero(first <= np.minimum(hi - reach, at + reached_right - reach))
    if not len(chosen):
        return chosen
    close = np.append(False, (np.diff(chosen) <= 4) & (g[chosen[1:]] == g[chosen[:-1]]) & (lo[chosen[1:]] == lo[chosen[:-1]]))
    group = np.cumsum(~close) - 1
    begin = np.flatnonzero(~close)
    cell = (chosen - chosen[begin][group]) // 10
    keep = ~close | np.append(True, cell[1:] != cell[:-1])
    last = np.append(~close[1:], True)
    before = np.maximum.accumulate(np.where(keep, chosen, -1))
    return chosen[keep | (last & (chosen - before >= 3))]


def _pieces(s: tk.Slice, h: np.ndarray, max_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of every piece, first piece of every text and the number of pieces)."""
    n = len(s.start)
    begin = np.zeros(n, dtype=bool)
    if n:
        begin[s.first[:-1][np.diff(s.first) > 0]] = True
        feeds = np.append(0, np.cumsum(s.data == 10))
        begin[1:] |= np.isin(s.data[s.end[:-1] - 1], _SENTENCE_ENDS) | (feeds[s.start[1:]] > feeds[s.end[:-1]])
        at = np.flatnonzero(begin)
        size = np.diff(np.append(at, n))
        if max_words and (size > max_words).any():
            long = np.repeat(size > max_words, size)
            words = np.flatnonzero(long)
            lengths = size[size > max_words]
            ends = np.cumsum(lengths)
            lo, hi = np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)
            begin[words[_cuts(h[words], lo, hi, max_words - 2)]] = True
    piece = np.flatnonzero(begin)
    return piece, np.searchsorted(piece, s.first)


def _edges(s: tk.Slice, piece: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Byte offsets at which text ``k`` of the slice is cut: its pieces add up to it."""
    own = s.start[piece[first[k]:first[k + 1]]] - s.offsets[k]
    size = s.offsets[k + 1] - s.offsets[k]
    if not len(own):
        return np.array([0, size] if size else [0])
    return np.concatenate([[0], own[1:], [size]])


def sentences(text: str, max_words: int = MAX_WORDS) -> list[str]:
    """The text in pieces that add up to it: a sentence each, with the white space that follows."""
    data = text.encode()
    s = tk.Slice(np.frombuffer(data, np.uint8), np.array([0, len(data)]), tk.SPACE_WORDS)
    piece, first = _pieces(s, s.hashes(), max_words)
    at = _edges(s, piece, first, 0).tolist()
    return [data[a:b].decode() for a, b in zip(at[:-1], at[1:])]


def extents(piece: np.ndarray, first: np.ndarray, words: int, run: int, min_words: int) -> tuple[np.ndarray, ...]:
    """(text, first piece, end piece) of every run, by the first words of pieces, sorted by text and first piece.

    From every piece the shortest run forwards, up to every piece the shortest
    run backwards, that has ``run`` pieces and ``min_words`` words.  Whether
    pieces are a run depends on them alone, so all their occurrences agree.
    """
    bounds = np.append(piece, words)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    a = np.arange(len(piece))
    forwards = np.maximum(a + run, np.searchsorted(bounds, piece + min_words))
    ahead = forwards <= first[text + 1]
    e = a + 1  # ends of runs: one past each piece
    backwards = np.minimum(e - run, np.searchsorted(bounds, bounds[e] - min_words, side="right") - 1)
    behind = backwards >= first[text]
    behind &= ~(ahead[np.maximum(backwards, 0)] & (forwards[np.maximum(backwards, 0)] == e))
    lo, hi = first[:-1], first[1:]
    small = np.flatnonzero((hi > lo) & ((hi - lo < run) | (bounds[hi] - bounds[lo] < min_words)))
    parts = (np.concatenate([text[ahead], text[behind], small]), np.concatenate([a[ahead], backwards[behind], lo[small]]),
             np.concatenate([forwards[ahead], e[behind], hi[small]]))
    order = np.lexsort((parts[2], parts[1], parts[0]))
    return tuple(x[order] for x in parts)


def _powers(step: int, n: int) -> np.ndarray:
    return np.append(np.uint64(1), np.cumprod(np.full(n, step, dtype=np.uint64)))


def _run_hashes(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, step: int) -> np.ndarray:
    """Hash of the words lo..hi of each run, whatever its place: differences of prefix sums."""
    up, down = _powers(step, len(h)), _powers(pow(step, -1, 1 << 64), len(h))
    sums = np.append(np.uint64(0), np.cumsum(h * up[:-1], dtype=np.uint64))
    return tk.mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def _keys(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of every whole text."""
    return np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64).view(np.int64)


def _runs(docs: DataFrame, run: int, min_words: int, max_words: int) -> DataFrame:
    """id, key and, per run of the text, its pieces a..b and its hash (h, g); texts without words are left out."""
    def emit(batch):
        raw, offsets = tk.text_bytes(batch.column("text"))
        for lo, hi, s in tk.slices(batch.column("text"), tk.SPACE_WORDS):
            h = s.hashes()
            piece, first = _pieces(s, h, max_words)
            text, a, b = extents(piece, first, len(h), run, min_words)
            if not len(text):
                continue
            bounds = np.append(piece, len(h))
            one = tk.signed(_run_hashes(h, bounds[a], bounds[b], _STEP))
            two = tk.signed(_run_hashes(tk.mix(h + np.uint64(_STEP2)), bounds[a], bounds[b], _STEP2)).astype(np.int32)
            some, counts = np.unique(text, return_counts=True)
            ends = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            key = _keys(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo).take(pa.array(some)), pa.array(key[some]),
                 *[pa.ListArray.from_arrays(ends, pa.array(x)) for x in
                   ((a - first[text]).astype(np.int32), (b - first[text]).astype(np.int32), one, two)]],
                ["id", "key", "a", "b", "h", "g"])
    return by_batch(docs, emit, "id long, key long, a array<int>, b array<int>, h array<long>, g array<int>")


def _repeated(runs: DataFrame) -> DataFrame:
    """h, g, id, key, a, b: the occurrences of runs that may repeat (all that do, and a few that the bitmap takes for such)."""
    shared = runs.sparkSession.sparkContext.broadcast(Bitmap.of(repeated_hashes(runs, "h"), "h", 1 << 24))

    def hits(batch):
        lists = [batch.column(c) for c in ("a", "b", "h", "g")]
        size = np.diff(lists[0].offsets.to_numpy())
        a, b, h, g = (x.flatten().to_numpy() for x in lists)
        use = np.flatnonzero(shared.value.has(tk.mix(h.view(np.uint64) >> np.uint64(24))))
        rows = pa.array(np.repeat(np.arange(len(size)), size)[use])
        yield pa.RecordBatch.from_arrays([pa.array(h[use]), pa.array(g[use]), batch.column("id").take(rows),
                                          batch.column("key").take(rows), pa.array(a[use]), pa.array(b[use])],
                                         ["h", "g", "id", "key", "a", "b"])
    return by_batch(runs, hits, "h long, g int, id long, key long, a int, b int")


def repeated_spans(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS) -> DataFrame:
    """(id, key, spans): per row of (id, text), the pieces a..b of its non-first repeated runs."""
    found = written(_repeated(written(_runs(docs, run, min_words, max_words), "sentence-runs")), "repeated-runs")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "a", "b")
    firsts = written(found.groupBy("h", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("m"))
                     .where("m > 1"), "first-runs")
    total = firsts.agg(F.sum("m")).first()[0] or 0
    # A run that holds a good part of all occurrences meets its first one by broadcast, so no task gets them all.
    hot = F.broadcast(firsts.where(F.col("m") > total / HOT_SHARE).select("h", "g", F.col("first").alias("hot")))
    marked = found.join(hot, ["h", "g"], "left")
    cold = marked.where("hot IS NULL").drop("hot").join(
        firsts.where(F.col("m") <= total / HOT_SHARE).select("h", "g", "first"), ["h", "g"])
    later = cold.unionByName(marked.where("hot IS NOT NULL").withColumnRenamed("hot", "first")).where(place != F.col("first"))
    return later.groupBy("id", "key").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))


def dedup(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text (what is left), n_sentences, n_removed, spans (removed sentence ranges start-end, end
    exclusive, comma-joined), one row per input row.

    A null or empty text has no sentence and comes back empty; one of white
    space only is one sentence and stays.  A text of fewer than ``run``
    sentences or ``min_words`` words is cut only as a whole, as a copy of
    another such text.  Of a passage repeated inside one text the first copy
    stays.  Null ids sort last; rows that repeat id and text count as one (they
    all keep what the first keeps).  Other columns are not read.
    """
    rows = texts(docs, id_column, text_column)
    later = written(repeated_spans(rows, run, min_words, max_words), "later-runs")
    touched = docs.sparkSession.sparkContext.broadcast(Bitmap.of(later.select(F.col("key").alias("h")), "h", 1 << 24))

    def keyed(wanted: bool):
        def key(batch):
            raw, offsets = tk.text_bytes(batch.column("text"))
            keys = _keys(raw, offsets)
            chosen = np.flatnonzero(touched.value.has(keys.view(np.uint64)) == wanted)
            if len(chosen):
                taken = pa.array(chosen)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(taken), batch.column("text").take(taken),
                                                  pa.array(keys[chosen])], ["id", "text", "key"])
        return by_batch(rows, key, "id long, text string, key long")
    same = F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.key") == F.col("r.key"))
    # Only texts that may lose something go through the join.
    joined = keyed(True).alias("d").join(later.alias("r"), same, "left").select("d.id", "d.text", "r.spans") \
        .unionByName(keyed(False).select("id", "text", F.lit(None).cast("array<struct<a: int, b: int>>").alias("spans")))

    def cut(batch):
        spans = batch.column("spans")
        for lo, hi, s in tk.slices(batch.column("text"), tk.SPACE_WORDS):
            piece, first = _pieces(s, s.hashes(), max_words)
            whole = batch.column("text").slice(lo, hi - lo).to_pylist()
            out: list[list] = [[], [], [], []]
            for k, text in enumerate(whole):
                n, own = int(first[k + 1] - first[k]), spans[lo + k].as_py()
                if not own:
                    out[0].append(text or "")
                    out[1].append(n or int(bool(text)))
                    out[2].append(0)
                    out[3].append("")
                    continue
                gone = np.zeros(n + 2, dtype=np.int64)
                np.add.at(gone, [x["a"] for x in own], 1)
                np.add.at(gone, [x["b"] for x in own], -1)
                gone = np.append(False, np.cumsum(gone)[:n + 1] > 0)
                edge = np.flatnonzero(np.diff(gone))
                at, data = _edges(s, piece, first, k), text.encode()
                stay = np.flatnonzero(~gone[1:n + 1])
                out[0].append(b"".join(data[at[j]:at[j + 1]] for j in stay).decode())
                out[1].append(n)
                out[2].append(int(gone[1:n + 1].sum()))
                out[3].append(",".join(f"{a}-{b}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo), pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                ["doc_id", "text", "n_sentences", "n_removed", "spans"])
    return by_batch(joined, cut, "doc_id long, text string, n_sentences long, n_removed long, spans string")
