"""Source divergence audit: how far the term shares of each source lie from those of its language.

Terms are counted by single-pass in-memory indexing.  A task reads texts once
and builds block postings (term, language, source: occurrences, documents)
until its memory is full, then spills the block as a run sorted by term and
language, dealt over hash shards in small pages.  Each shard merges its runs
with a heap: pages come in the order of their first key, so a page is opened
only when the merge reaches it, and memory holds one open page a run.  The
merge yields whole frequencies, of which terms in too few documents go.

Shares and divergences are whole numbers (see :func:`shares`).  The sum of
f over all V kept terms of a pair of sources is never computed term by term
where a count is 0:  V times the value of two zero counts, plus, per source,
its count histogram against the other's zero count, plus corrections streamed
over the terms that both sources hold.  Corrections are summed inside tasks
and leave them as one row per pair.

Null text, language and source are ''.  A language without kept terms gives
pairs of value 0 and no term rows; a source alone in its language has no
pairs; an empty table gives no rows.  Repeated rows count as often as they
occur; ties rank by the item's UTF-8 bytes.  Other columns are never read.
"""

from __future__ import annotations

import heapq
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewstar.llm.tables import importable, written
from viewstar.llm.textkit import FOLD_TABLE

#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` over folded UTF-8 bytes
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
#: Documents of its language that a kept term occurs in.
MIN_DOCS = 10
#: Bytes a block may take before it is spilled (an estimate, not a cap on rows).
BLOCK_BYTES = 96 << 20
#: Terms of a page of a run.
PAGE_TERMS = 512
#: Bytes of text taken apart at once.
PIECE_BYTES = 1 << 20
#: Pairs of sources corrected at once, and pairs summed before they are handed on.
PAIRS_AT_ONCE, PAIRS_HELD = 1 << 20, 200_000


class _Ids(dict):
    """Numbers terms in the order they come; ``bytes`` is what their names take."""

    bytes = 0

    def __missing__(self, term):
        self[term] = n = len(self)
        self.bytes += len(term)
        return n


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut between terms into pieces of about PIECE_BYTES."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        cut = _BREAK.search(data, at + PIECE_BYTES)
        if cut is None:
            break
        yield data[at:cut.start()]
        at = cut.start()
    yield data[at:] if at else data


class Block:
    """Postings of the texts read since the last spill."""

    def __init__(self):
        self.terms, self.groups = _Ids(), {}
        self.key, self.tf, self.df = (np.zeros(0, np.int64) for _ in range(3))
        self.fresh: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, lang: str, source: str, text: str) -> None:
        group = self.groups.setdefault((lang.encode(), source.encode()), len(self.groups))
        number = self.terms.__getitem__
        ids = [np.fromiter(map(number, TERM.findall(piece)), np.int64)
               for piece in _pieces(text.encode("utf-8", "surrogatepass").translate(FOLD_TABLE))]
        held, times = np.unique(ids[0] if len(ids) == 1 else np.concatenate(ids), return_counts=True)
        self.fresh.append(((held << 32) | group, times))
        self.waiting += len(held)
        if self.waiting > 1_000_000:
            self.fold()

    def fold(self) -> None:
        if self.fresh:
            key = np.concatenate([self.key, *[k for k, _ in self.fresh]])
            tf = np.concatenate([self.tf, *[t for _, t in self.fresh]])
            df = np.concatenate([self.df, np.ones(len(key) - len(self.key), np.int64)])
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            self.key = key[first]
            self.tf, self.df = ((np.add.reduceat(x[order], first) if len(first) else x[:0]) for x in (tf, df))
            self.fresh, self.waiting = [], 0

    def size(self) -> int:
        return 120 * len(self.terms) + self.terms.bytes + 24 * len(self.key) + 48 * self.waiting + 200 * len(self.groups)

    def run(self, shards: int) -> Iterator[tuple[int, bytes, bytes]]:
        """(shard, first key, page): per shard the block's terms in order, a page at a time.

        A key is term, 0, language: no term holds a 0, so keys sort by term, then language.
        A page is (keys, documents, ends of their postings, source names, source of each posting, occurrences).
        """
        self.fold()
        terms, groups = list(self.terms), list(self.groups)
        rank = np.empty(len(terms), np.int64)
        rank[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
        place = np.empty(len(groups), np.int64)
        place[sorted(range(len(groups)), key=groups.__getitem__)] = np.arange(len(groups))
        term, group = self.key >> 32, self.key & 0xFFFFFFFF
        order = np.argsort(rank[term] * len(groups) + place[group])
        term, group, tf, df = term[order], group[order], self.tf[order], self.df[order]
        if not len(term):
            return
        langs = {lang: k for k, lang in enumerate({lang for lang, _ in groups})}
        lang = np.array([langs[x] for x, _ in groups])[group]
        begin = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])])
        end = np.r_[begin[1:], len(term)]
        docs = np.add.reduceat(df, begin)
        tail = [b"\0" + groups[g][0] for g in range(len(groups))]
        keys = [terms[t] + tail[g] for t, g in zip(term[begin].tolist(), group[begin].tolist())]
        shard = np.fromiter((zlib.crc32(k) % shards for k in keys), np.int64, len(keys))
        by_shard = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(shard[by_shard]) != 0, True])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            for at in range(lo, hi, PAGE_TERMS):
                items = by_shard[at:min(at + PAGE_TERMS, hi)]
                sizes = end[items] - begin[items]
                ends = np.cumsum(sizes)
                rows = np.repeat(begin[items] - ends + sizes, sizes) + np.arange(ends[-1])
                used, of = np.unique(group[rows], return_inverse=True)
                page = ([keys[i] for i in items], docs[items].tolist(), ends.tolist(), [groups[g][1] for g in used],
                        of.astype(np.int32), tf[rows])
                yield int(shard[items[0]]), page[0][0], pickle.dumps(page, protocol=5)


def _runs(shards: int, block_bytes: int):
    def build(batches):
        block = Block()

        def spilled():
            pages = list(zip(*block.run(shards)))
            if pages:
                yield pa.RecordBatch.from_arrays([pa.array(pages[0], pa.int32()), pa.array(pages[1], pa.binary()),
                                                  pa.array(pages[2], pa.binary())], ["shard", "first", "page"])
        for batch in batches:
            for lang, source, text in zip(*[batch.column(k) for k in range(3)]):
                block.add(lang.as_py(), source.as_py(), text.as_py())
                if block.size() > block_bytes:
                    yield from spilled()
                    block = Block()
        yield from spilled()
    return build


def _items(pages: Iterator[tuple[bytes, bytes]]) -> Iterator[tuple]:
    """(key, serial, documents, first posting, end, page) in the order of keys: a heap over the open pages.

    Pages come by their first key, so all keys below the next page's first are ready.
    """
    heap: list[tuple] = []
    serial = 0

    def step():
        item = heap[0]
        page, k = item[5], item[6] + 1
        if k < len(page[0]):
            heapq.heapreplace(heap, (page[0][k], item[1], page[1][k], item[4], page[2][k], page, k))
        else:
            heapq.heappop(heap)
        return item
    for first, body in pages:
        while heap and heap[0][0] < first:
            yield step()
        page = pickle.loads(body)
        heapq.heappush(heap, (page[0][0], serial, page[1][0], 0, page[2][0], page, 0))
        serial += 1
    while heap:
        yield step()


def _kept(pages: Iterator[tuple[bytes, bytes]], min_docs: int) -> Iterator[tuple]:
    """(lang, term, source, tf, lang_tf, head) of every term in ``min_docs`` documents; head: a term's first row."""
    key, docs, parts = None, 0, []

    def rows():
        if docs < min_docs:
            return
        term, lang = key.split(b"\0", 1)
        tf: dict[bytes, int] = {}
        for lo, hi, page in parts:
            for source, times in zip(page[4][lo:hi].tolist(), page[5][lo:hi].tolist()):
                name = page[3][source]
                tf[name] = tf.get(name, 0) + times
        total = sum(tf.values())
        for k, source in enumerate(sorted(tf)):
            yield lang, term, source, tf[source], total, k == 0
    for item in _items(pages):
        if item[0] != key:
            yield from rows()
            key, docs, parts = item[0], 0, []
        docs += item[2]
        parts.append((item[3], item[4], item[5]))
    yield from rows()


_FREQ = [("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("tf", pa.int64()), ("lang_tf", pa.int64()),
         ("head", pa.bool_())]


def _merged(min_docs: int):
    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        columns[:3] = [[x.decode("utf-8", "surrogatepass") for x in c] for c in columns[:3]]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, _FREQ)], [n for n, _ in _FREQ])

    def merge(batches):
        def pages():
            """(shard, first, page) of the partition; a task may hold several shards, one after the other."""
            for batch in batches:
                for k in range(batch.num_rows):
                    yield batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), batch.column(2)[k].as_py()
        rest = pages()
        ahead = next(rest, None)
        while ahead is not None:
            shard = ahead[0]

            def own():
                nonlocal ahead
                while ahead is not None and ahead[0] == shard:
                    yield ahead[1:]
                    ahead = next(rest, None)
            held = []
            for row in _kept(own(), min_docs):
                held.append(row)
                if len(held) >= 20_000:
                    yield table(held)
                    held = []
            if held:
                yield table(held)
    return merge


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, shards: int | None = None,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, term, source, tf, lang_tf, head: occurrences of every kept term in every source that holds it."""
    spark = docs.sparkSession
    importable(spark)
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = docs.select("lang", "source", "text").mapInArrow(_runs(shards, block_bytes), "shard int, first binary, page binary")
    return written(runs.repartition("shard").sortWithinPartitions("shard", "first").mapInArrow(
        _merged(min_docs), "lang string, term string, source string, tf long, lang_tf long, head boolean"), "term-frequencies")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / total), exact for totals under 9 * 10**15: three steps of long division."""
    out, rest = np.ones_like(count), count + 2
    for unit in (1_000_000, 1_000, 1):
        out = out + unit * (rest * 1000 // total)
        rest = rest * 1000 % total
    return out


def _share(count: str, total: str) -> str:
    """:func:`shares` as SQL."""
    a = f"(({count} + 2) * 1000)"
    b = f"({a} % {total} * 1000)"
    c = f"({b} % {total} * 1000)"
    return f"(1 + 1000000 * ({a} div {total}) + 1000 * ({b} div {total}) + {c} div {total})"


def _apart(p: str, q: str) -> str:
    """floor((p - q)^2 / (p + q)) as SQL (p and q are at most 10**9 + 1, so nothing overflows)."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _corrections(batches):
    """Rows (lang, term, gid, p, zero), a term's rows together and by gid, to (lang, a, b, value) with a < b.

    For every term that both sources hold: f of their shares, less what the
    zero-count forms stand for.  Partial sums; a pair may come several times.
    """
    sums: dict[tuple[str, int, int], int] = {}

    def handed_on():
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), *[pa.array([k[n] for k in keys], pa.int64()) for n in (1, 2)],
             pa.array([sums[k] for k in keys], pa.int64())], ["lang", "a", "b", "value"])
        sums.clear()

    def terms(rows: pa.RecordBatch, last: bool):
        """Corrects the whole terms of ``rows``; returns the rows of an unfinished last term."""
        n = rows.num_rows
        new = np.ones(n, bool)
        for name in ("lang", "term"):
            column = rows.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            new[1:] = new[1:] & (column[1:] == column[:-1])
        new = ~new
        new[:1] = True
        begin = np.flatnonzero(new)
        whole = n if last else int(begin[-1])
        gid, p, zero = (rows.column(c).to_numpy(zero_copy_only=False)[:whole] for c in ("gid", "p", "zero"))
        end = np.r_[begin[1:], n][np.cumsum(new) - 1][:whole]
        after = end - np.arange(whole) - 1
        langs, of = np.unique(rows.column("lang").to_numpy(zero_copy_only=False)[:whole].astype(str), return_inverse=True)
        upto = np.cumsum(after)
        lo = 0
        while lo < whole:
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE, side="right")))
            m = after[lo:hi]
            i = np.repeat(np.arange(lo, hi), m)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(m) - m, m)
            if len(i):
                value = divergences(p[i], p[j]) - divergences(p[i], zero[j]) - divergences(zero[i], p[j]) \
                    + divergences(zero[i], zero[j])
                order = np.lexsort((gid[j], gid[i], of[i]))
                a, b, c = gid[i][order], gid[j][order], of[i][order]
                first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
                for lang, x, y, v in zip(c[first].tolist(), a[first].tolist(), b[first].tolist(),
                                         np.add.reduceat(value[order], first).tolist()):
                    key = (str(langs[lang]), x, y)
                    sums[key] = sums.get(key, 0) + v
                if len(sums) > PAIRS_HELD:
                    yield from handed_on()
            lo = hi
        return rows.slice(whole)
    rest = None
    for batch in batches:
        rows = batch if rest is None or not rest.num_rows else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if rows.num_rows:
            rest = yield from terms(rows, False)
    if rest is not None and rest.num_rows:
        yield from terms(rest, True)
    if sums:
        yield from handed_on()


def audit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = 10, shards: int | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language by divergence (part ``pair``),
    and the ``top_terms`` kept terms of the source that stand out of its language most (part ``term``)."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in
                         ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))])
    freq = frequencies(rows, min_docs, shards, block_bytes)
    by_source = freq.groupBy("lang", "source").agg(F.sum("tf").alias("n"))
    by_lang = freq.groupBy("lang").agg(F.sum("tf").alias("lang_n"), F.count_if("head").alias("v"))
    groups = written(rows.select("lang", "source").distinct().join(by_source, ["lang", "source"], "left")
                     .join(by_lang, "lang", "left").select(
        "lang", "source", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long").alias("gid"),
        F.coalesce("v", F.lit(0)).alias("v"),
        F.expr("coalesce(n, 0) + 2 * coalesce(v, 0)").alias("d"),
        F.expr("coalesce(lang_n, 0) + 2 * coalesce(v, 0)").alias("lang_d"))
        .withColumn("zero", F.when(F.col("v") > 0, F.expr(_share("0L", "d")))), "divergence-groups")
    counted = freq.join(groups, ["lang", "source"]).withColumn("p", F.expr(_share("tf", "d")))

    found = counted.withColumn("q", F.expr(_share("lang_tf", "lang_d"))).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = found.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)

    both = counted.select("lang", "term", "gid", "p", "zero").repartition("lang", "term") \
        .sortWithinPartitions("lang", "term", "gid").mapInArrow(_corrections, "lang string, a long, b long, value long") \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = both.union(both.select("lang", "b", "a", "value"))
    counts = counted.groupBy("lang", "gid", "p", "zero").agg(F.count(F.lit(1)).alias("times"))
    other = groups.select("lang", F.col("gid").alias("b"), F.col("zero").alias("other_zero"))
    alone = counts.join(other, "lang").where("gid <> b").groupBy("lang", F.col("gid").alias("a"), "b").agg(
        F.sum(F.expr(f"times * ({_apart('p', 'other_zero')} - {_apart('zero', 'other_zero')})")).alias("value"))
    alone = alone.union(alone.select("lang", "b", "a", "value"))
    mine = groups.select("lang", "source", F.col("gid").alias("a"), "zero", "v")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("gid").alias("b"), F.col("zero").alias("other_zero"))
    base = mine.join(theirs, "lang").where("a <> b").withColumn(
        "value", F.coalesce(F.expr(f"v * {_apart('zero', 'other_zero')}"), F.lit(0)))
    extra = both.union(alone).groupBy("lang", "a", "b").agg(F.sum("value").alias("more"))
    pairs = base.join(extra, ["lang", "a", "b"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        (F.col("value") + F.coalesce("more", F.lit(0))).alias("value")).withColumn("rank", F.row_number().over(by_value))
    return pairs.union(terms)
