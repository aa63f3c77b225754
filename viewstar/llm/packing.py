"""Best-fit-decreasing packing of token sequences into windows of fixed size.

A document's ids are cut into full windows and one shorter rest.  Which pieces
share a window depends on piece lengths alone, and a length is at most the
window, so the packing itself runs on a histogram of ``window`` numbers: runs
of equal pieces go into runs of windows with equal free space, the tightest
free space that fits being found by a segment tree indexed by remaining
capacity.  The plan is a list of length / rank ranges.  Spark then ranks the
pieces of each length (a position in its partition plus the counts of the
partitions before) and looks every piece up in the plan, so the result is the
best-fit-decreasing packing of all pieces of the corpus, and neither the
driver nor any task ever holds more than counts.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewstar.llm.tables import by_batch, importable, lean, small_batches, texts, written
from viewstar.llm.textkit import Slice, bounds, text_bytes

WINDOW = 1024
END_OF_TEXT = 0
_SLICE = 1 << 20  # bytes of text encoded at once (the work on them takes some 20 times as much)
_CACHE_IDS = 2_500_000  # ids of known chunks that a worker keeps


# -- tokens -------------------------------------------------------------------------------
_GAP = np.ones(256, dtype=bool)          # a chunk is a run of anything but space and line feed
_GAP[[0x20, 0x0A]] = False
_ODD = np.zeros(256, dtype=bool)         # other ASCII white space, and first bytes of the rest of it
_ODD[[0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20)]] = True
_LEADS_SPACE = np.zeros(256, dtype=bool)
_LEADS_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_SEPARATOR = np.zeros(256, dtype=np.uint64)
_SEPARATOR[0x20], _SEPARATOR[0x0A] = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class Encoder:
    """Byte-level BPE ids of whole texts, by the public vocabulary files.

    ``tokenizers`` defines the ids (file ``byte_bpe_50k.json``, no special
    tokens added; a text that spells out an added token holds that token, as
    the file has it); the same vocabulary as ranks gives equal ids several times faster through
    ``tiktoken`` (tests hold the two against each other).  Byte-level BPE never
    merges across its word pattern's cuts, and the pattern always cuts between
    a character that is no white space and a single space or line feed
    followed by another such character.  So a text's ids are those of its
    chunks in a row: each different chunk of a slice of texts is encoded once,
    and numpy gathers the ids.
    """

    def __init__(self, vocabulary: str = "byte_bpe_50k"):
        import base64

        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        size = max(ranks.values()) + 1
        self.spaced, self.broken = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.broken[[i for token, i in ranks.items() if token.startswith(b"\n")]] = True
        self.added = sorted(t.content for t in self._defining().get_added_tokens_decoder().values())
        self.keys, self.flat = np.zeros(0, np.uint64), np.zeros(0, "<u4")
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _defining(self):
        import public_tokenizers
        from tokenizers import Tokenizer

        return Tokenizer.from_file(public_tokenizers.path(f"{self.vocabulary}.json"))

    @cached_property
    def library(self):
        """The defining library, kept from the first text that needs it: it is as large as all the rest."""
        return self._defining()

    def one(self, text: str) -> np.ndarray:
        """ids of a whole text; by the defining library if it spells out an added token."""
        if any(s in text for s in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text).astype("<u4")

    def _joined(self, chunks: list[bytes], lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks in a row, where each begins); every chunk starts with its separator."""
        ids = self.fast.encode_to_numpy(b"".join(chunks).decode()) if chunks else np.zeros(0, np.uint32)
        return ids.astype("<u4"), np.flatnonzero(lead[ids]) if chunks else np.zeros(0, np.int64)

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """ids of each text of a slice of UTF-8 bytes."""
        n = len(offsets) - 1
        s = Slice(raw, offsets, _GAP, fold=False)
        words = np.diff(s.first)
        gaps = np.diff(np.searchsorted(np.flatnonzero(~_GAP[raw]), offsets))
        odd = np.diff(np.searchsorted(np.flatnonzero(_ODD[raw]), offsets))
        lo, hi = offsets[:-1], offsets[1:]
        plain = (gaps == words - 1) & (odd == 0)
        if len(raw):  # no white space of another kind at a chunk's edge
            edge = _LEADS_SPACE[raw[s.start]] | _LEADS_SPACE[raw[np.maximum(s.end - 2, 0)]] \
                | _LEADS_SPACE[raw[np.maximum(s.end - 3, 0)]]
            plain &= np.diff(np.searchsorted(np.flatnonzero(edge), s.first)) == 0
            opens = raw[np.minimum(lo, len(raw) - 1)]
            plain &= _GAP[opens] & _GAP[raw[np.maximum(hi, 1) - 1]]
        text = raw.tobytes()
        for mark in map(str.encode, self.added):
            at = text.find(mark)
            while at >= 0:
                plain[np.searchsorted(offsets, at, side="right") - 1] = False
                at = text.find(mark, at + 1)
        out: list[np.ndarray | None] = [None] * n
        for i in np.flatnonzero(~plain):
            out[i] = self.one(text[lo[i]:hi[i]].decode())
        use = np.repeat(plain, words)
        if not use.any():
            return out
        start, end = s.start[use], s.end[use]
        opening = np.zeros(len(s.start), dtype=bool)
        opening[s.first[:-1][plain]] = True
        opening = opening[use]
        separator = np.where(opening, 0, raw[np.maximum(start - 1, 0)])
        key = s.hashes()[use] ^ _SEPARATOR[separator]
        key, where, index = np.unique(key, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = self.keys[at] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
        size, begin = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
        size[known], begin[known] = self.sizes[at[known]], self.begins[at[known]]
        flat, total = [self.flat], len(self.flat)
        kind = np.where(known, 255, separator[where])
        for code, lead in ((0x20, self.spaced), (0x0A, self.broken)):
            mine = np.flatnonzero(kind == code)
            w = where[mine]
            ids, first = self._joined([text[a:b] for a, b in zip((start[w] - 1).tolist(), end[w].tolist())], lead)
            begin[mine] = total + first
            size[mine] = np.diff(np.append(first, len(ids)))
            flat.append(ids)
            total += len(ids)
        for k in np.flatnonzero(kind == 0):
            ids = self.fast.encode_to_numpy(text[start[where[k]]:end[where[k]]].decode()).astype("<u4")
            begin[k], size[k] = total, len(ids)
            flat.append(ids)
            total += len(ids)
        pool = np.concatenate(flat)
        if not known.all() and total <= _CACHE_IDS:  # chunks met so far, for the next slices
            keys = np.concatenate([self.keys, key[~known]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.flat = keys[order], pool
            self.begins = np.concatenate([self.begins, begin[~known]])[order]
            self.sizes = np.concatenate([self.sizes, size[~known]])[order]
        sizes = size[index]
        stop = np.cumsum(sizes)
        ids = pool[np.repeat(begin[index] - (stop - sizes), sizes) + np.arange(stop[-1])]
        stop = np.append(0, stop)
        first = np.append(0, np.cumsum(words[plain]))
        for i, a, b in zip(np.flatnonzero(plain), stop[first[:-1]], stop[first[1:]]):
            out[i] = ids[a:b]
        return out


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


_TOKENS = ("part int, id long, doc_tokens long, n_full long, full_rank long, rest int, rest_rank long, "
           "crc array<long>, ids binary")


def tokenised(docs: DataFrame, window: int, vocabulary: str, with_ids: bool, id_column: str = "doc_id",
              text_column: str = "text") -> DataFrame:
    """A row per document with its piece sizes, checksums and ranks within its partition."""
    def run(batches):
        encode, part = _encoder(vocabulary), TaskContext.get().partitionId()
        lean()
        tail, ranks, full_rank = array("I", [END_OF_TEXT]).tobytes(), np.zeros(window, dtype=np.int64), 0
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for lo, hi in bounds(offsets, _SLICE):
                rows = []
                found = encode(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                for doc_id, own in zip(doc_ids[lo:hi], found):
                    ids = own.tobytes() + tail
                    n, step = len(ids) // 4, 4 * window
                    full, rest = divmod(n, window)
                    rows.append((part, doc_id, n, full, full_rank, rest, int(ranks[rest]) if rest else 0,
                                 [zlib.crc32(ids[k:k + step]) for k in range(0, len(ids), step)],
                                 ids if with_ids else None))
                    full_rank += full
                    if rest:
                        ranks[rest] += 1
                yield _tokens_batch(rows)
        batch = raw = found = rows = own = ids = None
        lean()
    importable(docs.sparkSession)
    return texts(docs, id_column, text_column).mapInArrow(run, _TOKENS)


def _tokens_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
             pa.list_(pa.int64()), pa.binary()]
    names = ["part", "id", "doc_tokens", "n_full", "full_rank", "rest", "rest_rank", "crc", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


# -- plan -------------------------------------------------------------------------------
class CapacityTree:
    """Segment tree over free capacities; ``tightest(n)`` is the smallest capacity >= n that is in use."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.used = [False] * (2 * self.size)

    def put(self, capacity: int, used: bool) -> None:
        k = capacity + self.size
        self.used[k] = used
        while k > 1:
            k //= 2
            self.used[k] = self.used[2 * k] or self.used[2 * k + 1]

    def tightest(self, n: int) -> int | None:
        k = n + self.size
        if self.used[k]:
            return n
        while k > 1 and (k % 2 or not self.used[k + 1]):
            k //= 2
        if k <= 1:
            return None
        k += 1
        while k < self.size:
            k = 2 * k if self.used[2 * k] else 2 * k + 1
        return k - self.size


@dataclass
class Plan:
    """Where pieces go: piece ``r`` of ``length`` is in the range with the largest ``rank <= r``;
    its sequence is ``sequence + (r - rank) // each``, its offset ``offset + (r - rank) % each * length``."""

    key: np.ndarray       # length * stride + rank, ascending
    stride: int
    sequence: np.ndarray
    offset: np.ndarray
    each: np.ndarray
    rank: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, length * self.stride + rank, side="right") - 1
        over = rank - self.rank[k]
        return self.sequence[k] + over // self.each[k], self.offset[k] + over % self.each[k] * length


def best_fit_decreasing(counts: dict[int, int], window: int) -> Plan:
    """Pack ``counts[length]`` pieces of each length, longest first, each into the tightest open window.

    Equal pieces fill one window after the other, as best fit would: a window
    just used is the tightest one for the next equal piece while it fits.
    """
    tree, open_runs = CapacityTree(window), {}
    ranges, made = [], 0

    def opened(capacity: int, sequence: int, n: int) -> None:
        if capacity and n:
            open_runs.setdefault(capacity, []).append((sequence, n))
            tree.put(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, sequence, n = window, made, -(-left // (window // length))
                made += n
            else:
                sequence, n = open_runs[capacity].pop()
                if not open_runs[capacity]:
                    del open_runs[capacity]
                    tree.put(capacity, False)
            each = capacity // length
            filled = min(n, left // each)   # windows that take all they can
            placed = filled * each
            some = min(left - placed, each) if filled < n else 0
            ranges.append((length, rank, sequence, window - capacity, each))
            opened(capacity - each * length, sequence, filled)
            if some:
                opened(capacity - some * length, sequence + filled, 1)
            opened(capacity, sequence + filled + bool(some), n - filled - bool(some))
            rank, left = rank + placed + some, left - placed - some
    stride = max(counts.values(), default=0) + 1
    rows = np.array(sorted(ranges), dtype=np.int64).reshape(-1, 5)
    return Plan(rows[:, 0] * stride + rows[:, 1], stride, rows[:, 2], rows[:, 3], rows[:, 4], rows[:, 1], made)


# -- operator -----------------------------------------------------------------------------
def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = "byte_bpe_50k", with_ids: bool = False,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked).

    Every document ends with id 0, so a null or empty text is one piece of one
    token.  Repeated rows are packed as documents of their own; a null id is
    kept as it is.  Within a sequence, pieces lie gapless from offset 0.  An
    empty table gives no rows.  The tokens are computed once and only sizes,
    checksums and ranks (and ids, if asked) are written.
    """
    spark = docs.sparkSession
    with small_batches(spark):  # the table is written when it ends
        rows = written(tokenised(docs, window, vocabulary, with_ids, id_column, text_column), "tokens")
    sizes = (rows.select("part", F.explode(F.array(
        F.struct(F.lit(window).alias("length"), F.col("n_full").alias("n")),
        F.struct(F.col("rest").alias("length"), F.lit(1).cast("long").alias("n")))).alias("s"))
        .where("s.length > 0 AND s.n > 0").groupBy("part", F.col("s.length").alias("length"))
        .agg(F.sum("s.n").alias("n")))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-ranks")
    counts = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit_decreasing(counts, window))

    full = bases.where(F.col("length") == window).select("part", F.col("base").alias("full_base"))
    rest = bases.select("part", F.col("length").alias("rest"), F.col("base").alias("rest_base"))
    ranked = rows.join(rest, ["part", "rest"], "left").join(full, ["part"], "left").select(
        "id", "doc_tokens", "n_full", "rest", "crc", "ids",
        (F.col("full_rank") + F.coalesce("full_base", F.lit(0))).alias("full_rank"),
        (F.col("rest_rank") + F.coalesce("rest_base", F.lit(0))).alias("rest_rank"))
    pieces = ranked.select("*", F.posexplode("crc").alias("k", "ids_crc32")).select(
        F.col("id").alias("doc_id"), (F.col("k") * F.lit(window)).cast("long").alias("start"),
        F.when(F.col("k") < F.col("n_full"), F.lit(window)).otherwise(F.col("rest")).cast("long").alias("length"),
        "ids_crc32", "doc_tokens",
        F.when(F.col("k") < F.col("n_full"), F.col("full_rank") + F.col("k")).otherwise(F.col("rest_rank"))
        .cast("long").alias("rank"),
        *([F.expr(f"substring(ids, cast(k * {4 * window} as int) + 1, {4 * window})").alias("ids")] if with_ids else []))

    def place(batch):
        sequence, offset = plan.value.place(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")),
             pa.array(sequence), pa.array(offset), *([batch.column("ids")] if with_ids else [])],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
             *(["ids"] if with_ids else [])])
    return by_batch(pieces, place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                   "sequence_id long, offset long" + (", ids binary" if with_ids else ""))
