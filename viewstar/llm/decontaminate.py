"""Benchmark decontamination by winnowing.

k-gram hashes of the words are winnowed: of every ``GUARD`` consecutive hashes
the smallest is kept as a fingerprint, so two texts that share at least
``K + GUARD - 1`` words share a fingerprint inside that span.  With K = 5 and
GUARD = 6 that is exactly a window of 10 words: no shared window is missed.
Test fingerprints go into a bitmap of fixed size, which every task of the
document scan gets; where a document's fingerprint may match, the windows
around it are candidates.  Those are joined with the test windows on 128-bit
hashes (extension to the exact, whole window), by a shuffle join that does
not depend on the benchmark's size.  Items of fewer words than a window are
one window of their own length, looked up by their whole hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewstar.llm import textkit as tk
from viewstar.llm.tables import Bitmap, by_batch, row_key, small_batches, texts, without, written

WINDOW = 10
K, GUARD = 5, 6


def _winnowed(g: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Which hashes are the (rightmost) smallest of some window of GUARD consecutive ones; only the
    windows whose first position is ``valid`` count."""
    chosen = np.zeros(len(g), dtype=bool)
    n = len(g) - GUARD + 1
    if n > 0:
        least = g[:n].copy()
        for k in range(1, GUARD):
            np.minimum(least, g[k:k + n], out=least)
        open_windows = valid[:n].copy()
        for k in reversed(range(GUARD)):
            now = open_windows & (g[k:k + n] == least)
            chosen[k:k + n] |= now
            open_windows &= ~now
    return chosen


def _item_windows(items: DataFrame) -> DataFrame:
    """(item, size, a, b, fingerprint): a row per window of the test texts; the fingerprints (fewer)
    stand beside the first windows."""
    def run(batch):
        ids = batch.column("id").to_pylist()
        cols: list[list] = [[], [], [], [], []]
        for lo, hi, s in tk.slices(batch.column("text"), tk.ALNUM_WORDS):
            words = s.hashes()
            for i in range(hi - lo):
                h = words[s.first[i]:s.first[i + 1]]
                if not len(h):
                    continue
                size = min(len(h), WINDOW)
                a, b = tk.grams(h, size), tk.grams(h, size, 1)
                f = tk.grams(h, K) if size == WINDOW else a
                if size == WINDOW:
                    f = f[_winnowed(f, np.ones(len(f), dtype=bool))]
                n = len(a)
                for col, values in zip(cols, ([ids[lo + i]] * n, [size] * n, tk.signed(a).tolist(), tk.signed(b).tolist(),
                                              [*tk.signed(f).tolist(), *[None] * (n - len(f))])):
                    col += values
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                          *(pa.array(c, pa.int64()) for c in cols[2:])],
                                         ["item", "size", "a", "b", "fingerprint"])
    return by_batch(items, run, "item long, size int, a long, b long, fingerprint long")


def _candidates(docs: DataFrame, bitmap: Bitmap, short: list[int]) -> DataFrame:
    """Per document its word count and the windows whose fingerprint may be a test's."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    struct = pa.struct([("pos", pa.int64()), ("size", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batch):
        marks = shared.value
        for lo, hi, s in tk.slices(batch.column("text"), tk.ALNUM_WORDS):
            h = s.hashes()
            owner = np.repeat(np.arange(hi - lo), np.diff(s.first))
            last = s.first[1:][owner]  # end of the word's text
            pos_parts, size_parts = [], []
            g = tk.grams(h, K)
            inside = last[:len(g)] >= np.arange(len(g)) + WINDOW
            hit = np.flatnonzero(_winnowed(g, inside))
            hit = hit[marks.has(g[hit])]
            if len(hit):  # every window that holds a matching fingerprint; the join decides exactly
                starts = np.unique((hit[:, None] - np.arange(WINDOW - K + 1)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts + WINDOW <= len(h))]
                starts = starts[owner[starts] == owner[starts + WINDOW - 1]]
                pos_parts.append(starts)
                size_parts.append(np.full(len(starts), WINDOW))
            for size in short:
                a = tk.grams(h, size)
                at = np.flatnonzero(marks.has(a) & (last[:len(a)] >= np.arange(len(a)) + size))
                pos_parts.append(at)
                size_parts.append(np.full(len(at), size))
            pos = np.concatenate(pos_parts) if pos_parts else np.zeros(0, np.int64)
            size = np.concatenate(size_parts) if size_parts else np.zeros(0, np.int64)
            order = np.argsort(pos, kind="stable")
            pos, size = pos[order], size[order]
            a, b = np.zeros(len(pos), np.uint64), np.zeros(len(pos), np.uint64)
            for n in np.unique(size):
                mine = size == n
                a[mine], b[mine] = tk.grams(h, int(n))[pos[mine]], tk.grams(h, int(n), 1)[pos[mine]]
            off = np.searchsorted(pos, s.first)
            own = pos - s.first[:-1][owner[pos]] if len(pos) else pos
            values = pa.StructArray.from_arrays(
                [pa.array(own.astype(np.int64)), pa.array(size.astype(np.int32)),
                 pa.array(tk.signed(a)), pa.array(tk.signed(b))], fields=list(struct))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo), batch.column("key").slice(lo, hi - lo), pa.array(np.diff(s.first)),
                 pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), values)],
                ["id", "key", "n_words", "windows"])
    keyed = docs.withColumn("key", row_key("id", "text"))
    return by_batch(keyed, run, "id long, key string, n_words long, "
                               "windows array<struct<pos: long, size: int, a: long, b: long>>")


def overlaps(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items array<long>, spans array<struct<start, end>>), one row per input row.

    ``n_hit`` counts the words inside any occurrence of a test window; spans
    are the merged word ranges, end exclusive.  A null, empty or wordless text
    has no words and no hits; a wordless or null item has no window, and an
    item without id is reported by no id but still hits.  Rows that repeat
    (null ids included) each get the same figures.  An empty benchmark hits
    nothing.  Other columns are not read.
    """
    return _overlaps(docs, items, id_column, text_column, item_column, item_text_column).drop("key")


def _overlaps(docs: DataFrame, items: DataFrame, id_column: str, text_column: str, item_column: str,
              item_text_column: str) -> DataFrame:
    """:func:`overlaps` with each row's key."""
    windows = written(_item_windows(texts(items, item_column, item_text_column)), "test-windows")
    bitmap = Bitmap.of(windows.select("fingerprint").where("fingerprint IS NOT NULL"), "fingerprint")
    short = sorted(r["size"] for r in windows.select("size").distinct().collect() if r["size"] < WINDOW)
    with small_batches(docs.sparkSession):
        found = written(_candidates(texts(docs, id_column, text_column), bitmap, short), "candidates")
    tests = windows.select("item", "size", "a", "b").distinct() \
        .groupBy("size", "a", "b").agg(F.collect_set("item").alias("items"))
    hits = found.where(F.size("windows") > 0).select("id", "key", F.explode("windows").alias("w")) \
        .select("id", "key", "w.*").distinct().join(tests, ["size", "a", "b"])
    doc = Window.partitionBy("id", "key").orderBy("pos", "size")
    reach = F.max("end").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    merged = hits.withColumn("end", F.col("pos") + F.col("size")) \
        .withColumn("before", F.coalesce(reach, F.lit(-1))) \
        .withColumn("fresh", (F.col("pos") > F.col("before")).cast("int")) \
        .withColumn("run", F.sum("fresh").over(doc)) \
        .withColumn("new_words", F.greatest(F.col("end") - F.greatest("pos", "before"), F.lit(0)))
    spans = merged.groupBy("id", "key", "run").agg(
        F.min("pos").alias("start"), F.max("end").alias("end"), F.sum("new_words").alias("n_hit"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    per_doc = spans.groupBy("id", "key").agg(
        F.sum("n_hit").alias("n_hit"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    left, right = found.drop("windows").alias("l"), per_doc.alias("r")
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.key") == F.col("r.key"))
    return left.join(right, same, "left").select(
        F.col("l.id").alias("doc_id"), F.col("l.key").alias("key"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """n_items, items_sha256 (ids sorted as strings, comma-joined) and contaminated from :func:`overlaps`."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns, as they are) that hold no test window, each by its own text,
    whatever rows share its id (or have none)."""
    bad = _overlaps(docs, items, id_column, text_column, item_column, item_text_column).where("n_hit > 0") \
        .select(F.col("key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", row_key(id_column, text_column))
    return without(keyed, written(bad, "overlapping"), "__key").select(*docs.columns)
