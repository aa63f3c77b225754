"""Exact Jaccard self-join of documents on word n-grams, with rare-first prefix filtering.

1. Document frequencies of all n-grams are counted: every task sorts its
   n-gram hashes and sends (range of hash space, delta-coded keys, counts), and
   one task per range adds them up.  Frequency classes (once, rare, common,
   very common) go into bitmaps of fixed size.
2. Each document's distinct n-grams are put in one global order, rarest class
   first, then by hash.  A bitmap that says "common" wrongly only moves an
   n-gram in that order, the same way for every document, so the join stays
   exact.  Two sets of similarity t share an n-gram among their first
   n - ceil(t n) + 1; those that occur in no other document are not sent at all.
3. Documents with equal sets are one class; classes are joined on prefix
   n-grams with length and positional filters, then a sketch filter (a sketch
   holds per hash bucket whether a set has an odd number of n-grams there; sets
   differ in at least one n-gram per bucket in which their sketches differ), and
   each remaining pair of classes is verified once on the whole sets.
4. To stay clear of all pairs inside a large group of near copies, a round
   takes of every prefix n-gram one class per component and pairs it with the
   largest component's; links merge components at once, and classes already
   connected need no further pair, so each round is linear in the entries and
   leaves fewer components.  When few pairs are left, or rounds no longer
   lower their number, every pair still between components is taken.  Links that could
   join two components are all found: components are exact.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar.llm import textkit as tk
from viewstar.llm.components import components
from viewstar.llm.tables import Bitmap, by_batch, forget, importable, lean, small_batches, texts, without, written

N = 5
SIMILARITY = 80  # per cent
#: Document frequencies from which an n-gram is in class 1, 2, 3 (class 0: one document).
CLASSES = (2, 16, 256)
BUCKETS = 1024   # of the sketch filter, a bit each
_KEEP = np.uint64(0x3FFFFFFFFFFFFFFF)  # n-gram hashes have 62 bits; the class stands above them
_FLUSH = 2_000_000  # n-grams a task gathers before it sends them on


# -- n-grams of a slice of texts ----------------------------------------------------------
def _shingles(s: tk.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the n-grams of every text: a text of fewer words is one n-gram."""
    h, first = s.hashes(), s.first
    size = np.diff(first)
    g = tk.grams(h, N)
    owner = np.repeat(np.arange(len(size)), size)[:len(g)]
    inside = first[1:][owner] >= np.arange(len(g)) + N
    short = np.flatnonzero((size > 0) & (size < N))
    small = np.array([tk.grams(h[first[i]:first[i + 1]], int(size[i]), 7)[0] for i in short], dtype=np.uint64)
    return np.concatenate([owner[inside], short]), np.concatenate([g[inside], small]) & _KEEP


def _distinct(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by (owner, key), repeats removed."""
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    if len(key):
        new = np.append(True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1]))
        owner, key = owner[new], key[new]
    return owner, key


def _signatures(owner: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums of each set's mixed hashes (order does not count)."""
    out = []
    for salt in (np.uint64(0x51ED270B8F5C7E35), np.uint64(0xA24BAED4963EE407)):
        total = np.append(np.uint64(0), np.cumsum(tk.mix(key + salt), dtype=np.uint64))
        at = np.searchsorted(owner, np.arange(rows + 1))
        out.append(total[at[1:]] - total[at[:-1]])
    return out[0], out[1]


def _sketches(owner: np.ndarray, key: np.ndarray, rows: int) -> np.ndarray:
    """Per set, a bit for each hash bucket that holds an odd number of its n-grams, as rows of 64-bit words."""
    counts = np.bincount(owner * BUCKETS + (key & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=rows * BUCKETS)
    return np.packbits((counts & 1).astype(bool), bitorder="little").view("<i8").reshape(rows, BUCKETS // 64)


# -- 1. document frequencies --------------------------------------------------------------
def _frequency_classes(docs: DataFrame) -> list[Bitmap]:
    """For each class bound, the bitmap of n-grams (by their upper 40 bits) in that many documents."""
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = -(-(1 << 40) // ranges)
    if width >= 1 << 32:  # deltas are 32-bit
        width = (1 << 32) - 1
        ranges = -(-(1 << 40) // width)
    importable(spark)

    def emit(keys: list[np.ndarray]):
        key = np.concatenate(keys)
        keys.clear()
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n = np.diff(first, append=len(key)).astype(np.uint32)
        key = key[first]
        at = np.searchsorted(key, np.arange(ranges + 1, dtype=np.int64) * width)
        rows = [(r, tk.planes(np.diff(key[a:b], prepend=r * width)), tk.planes(n[a:b]))
                for r, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()),
                                           pa.array([x[1] for x in rows], pa.binary()),
                                           pa.array([x[2] for x in rows], pa.binary())], ["r", "deltas", "n"])

    def count(batches):
        lean()
        held, size = [], 0
        for batch in batches:
            for _, _, s in tk.slices(batch.column("text"), tk.SPACE_WORDS):
                _, key = _distinct(*_shingles(s))
                held.append((key >> np.uint64(22)).astype(np.int64))
                size += len(key)
                if size >= _FLUSH:
                    yield emit(held)
                    size = 0
        if size:
            yield emit(held)
        batch = s = key = None
        lean()

    def add(group: pa.Table) -> pa.Table:
        keys = [np.cumsum(tk.unplanes(d.as_py()), dtype=np.int64) for d in group.column("deltas")]
        key = np.concatenate(keys) + group.column("r")[0].as_py() * width
        n = np.concatenate([tk.unplanes(d.as_py()) for d in group.column("n")]).astype(np.int64)
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.add.reduceat(n, first)
        level = np.searchsorted(CLASSES, total, side="right")
        return pa.table({"h": tk.signed(tk.mix(key[first][level > 0].astype(np.uint64))), "level": level[level > 0].astype(np.int32)})

    counted = docs.mapInArrow(count, "r int, deltas binary, n binary") \
        .groupBy("r").applyInArrow(add, "h long, level int")
    return Bitmap.of_levels(counted, "h", "level", len(CLASSES))


def _levels(key: np.ndarray, classes: list[Bitmap]) -> np.ndarray:
    h = tk.mix(key >> np.uint64(22))
    level = np.zeros(len(key), dtype=np.uint64)
    for bitmap in classes:
        level += bitmap.has(h)
    return level


# -- 2. prefixes --------------------------------------------------------------------------
def _prefixes(docs: DataFrame, classes: list[Bitmap], similarity: int) -> DataFrame:
    """uid, id, n, sig1, sig2 per row, with prefix n-grams (shared ones only) and sketch."""
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    entry = pa.struct([("key", pa.int64()), ("pos", pa.int32())])

    def run(batches):
        lean()
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, s in tk.slices(batch.column("text"), tk.SPACE_WORDS):
                rows = hi - lo
                owner, key = _distinct(*_shingles(s))
                sig1, sig2 = _signatures(owner, key, rows)
                n = np.bincount(owner, minlength=rows)
                level = _levels(key, shared.value)
                order = np.lexsort((key, level, owner))
                o_key, o_level = key[order], level[order]
                first = np.append(0, np.cumsum(n))
                pos = np.arange(len(key)) - np.repeat(first[:-1], n)
                length = n - (similarity * n + 99) // 100 + 1
                use = (pos < np.repeat(length, n)) & (o_level > 0)
                cut = np.append(0, np.cumsum(np.bincount(owner[use], minlength=rows)))
                joined = np.diff(cut) > 0
                sketch = _sketches(owner, key, rows)[joined]
                entries = pa.StructArray.from_arrays(
                    [pa.array(tk.signed(o_key[use])), pa.array(pos[use].astype(np.int32))], fields=list(entry))
                ends = np.append(0, np.cumsum(joined) * (BUCKETS // 64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(rows)), batch.column("id").slice(lo, rows), pa.array(n.astype(np.int64)),
                     pa.array(tk.signed(sig1)), pa.array(tk.signed(sig2)),
                     pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), entries),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(sketch.ravel()))],
                    ["uid", "id", "n", "sig1", "sig2", "prefix", "sketch"])
                uid += rows
    return docs.mapInArrow(run, "uid long, id long, n long, sig1 long, sig2 long, "
                                "prefix array<struct<key: long, pos: int>>, sketch array<long>")


# -- 3. filters and verification ----------------------------------------------------------
def _needed(a: Column, b: Column, similarity: int) -> Column:
    """The least overlap of two sets of these sizes: ceil(t (a + b) / (1 + t))."""
    return F.ceil(F.lit(similarity) * (a + b) / F.lit(100 + similarity) - F.lit(1e-9))


def _passes(n: Column, pos: Column, m: Column, qos: Column, similarity: int) -> Column:
    """Length and positional filter for two sets that share the n-gram at ``pos`` and ``qos``.

    If it is their first common n-gram, nothing before it is shared and the
    overlap is at most what follows.  At a later common n-gram the bound may
    turn a pair away, but the pair stays if it passes at its first one.
    """
    length = F.least(n, m) * 100 >= F.greatest(n, m) * similarity
    return length & (F.least(n - pos, m - qos) >= _needed(n, m, similarity))


def _close(n: Column, p: Column, m: Column, q: Column, similarity: int) -> Column:
    """Whether two sets of these sizes and sketches may be similar enough (sketch filter)."""
    apart = reduce(add, [F.bit_count(p[k].bitwiseXOR(q[k])) for k in range(BUCKETS // 64)])
    return apart <= n + m - 2 * _needed(n, m, similarity)


def _sketch_filtered(pairs: DataFrame, reps: DataFrame, similarity: int) -> DataFrame:
    one = reps.select(F.col("uid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("p_a"))
    two = reps.select(F.col("uid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("p_b"))
    return pairs.join(one, "a").join(two, "b") \
        .where(_close(F.col("n_a"), F.col("p_a"), F.col("n_b"), F.col("p_b"), similarity)).select("a", "b")


def _whole_sets(uids: DataFrame, reps: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """(uid, grams): the whole sets of some classes, made again from one of their texts; other texts are passed over."""
    wanted = written(uids.distinct().join(reps.select("uid", "id", "sig1", "sig2"), "uid"), f"wanted-{name}")
    shared = docs.sparkSession.sparkContext.broadcast(Bitmap.of(wanted.select(F.xxhash64("id").alias("h")), "h"))

    def sets(batch):
        batch = batch.filter(pa.array(shared.value.has(batch.column("h").to_numpy().view(np.uint64))))
        for lo, hi, s in tk.slices(batch.column("text"), tk.SPACE_WORDS):
            owner, key = _distinct(*_shingles(s))
            sig1, sig2 = _signatures(owner, key, hi - lo)
            ends = np.searchsorted(owner, np.arange(hi - lo + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, hi - lo), pa.array(tk.signed(sig1)), pa.array(tk.signed(sig2)),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tk.signed(key)))],
                ["id", "sig1", "sig2", "grams"])

    # Repeated rows give the same set; dropping them and the join share one shuffle.
    found = by_batch(docs.where("id IS NOT NULL").select("id", "text", F.xxhash64("id").alias("h")), sets,
                     "id long, sig1 long, sig2 long, grams array<long>") \
        .dropDuplicates(["id", "sig1", "sig2"]).join(wanted, ["id", "sig1", "sig2"]).select("uid", "grams")
    out = written(found, name)
    forget(wanted)
    return out


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(a, b, linked): each pair of classes decided on the whole sets."""
    # Row by row in the JVM: batches of whole sets would fill a Python worker.
    both = F.size(F.array_intersect("x", "y"))
    sided = pairs.join(sets.select(F.col("uid").alias("a"), F.col("grams").alias("x")), "a") \
        .join(sets.select(F.col("uid").alias("b"), F.col("grams").alias("y")), "b")
    sided = sided.select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sizes"))
    return sided.select("a", "b", (F.col("both") * 100 >= (F.col("sizes") - F.col("both")) * similarity).alias("linked"))


# -- 4. links ------------------------------------------------------------------------------
BLOCK_SETS, BLOCK_GRAMS = 512, 1 << 19


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common n-grams of every set on the left with every one on the right."""
    grams = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for side in (left, right):
        owner, key = np.repeat(np.arange(len(side)), [len(x) for x in side]), np.concatenate(side)
        column = np.minimum(np.searchsorted(grams, key), max(len(grams) - 1, 0))
        use = grams[column] == key if len(grams) else np.zeros(len(key), dtype=bool)
        column, owner = column[use], owner[use]
        order = np.argsort(column, kind="stable")
        sides.append((column[order], owner[order]))
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for lo in range(0, len(grams), 4096):
        dense = []
        for side, (column, owner) in zip((left, right), sides):
            a, b = np.searchsorted(column, [lo, lo + 4096])
            dense.append(np.zeros((len(side), 4096), dtype=np.float32))
            dense[-1][owner[a:b], column[a:b] - lo] = 1
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def _links(labels: DataFrame, copies: DataFrame, verified: DataFrame, sets: DataFrame, reps: DataFrame, docs: DataFrame,
           similarity: int) -> DataFrame:
    """(uid, links): rows of other classes that each class links to.

    All links lie within components.  Where every pair of a component's
    classes is among ``verified``, its links are known; the others' are
    counted on whole sets.
    """
    classes = labels.groupBy("c").agg(F.count(F.lit(1)).alias("k"))
    inside = verified.join(labels.select(F.col("v").alias("a"), "c"), "a") \
        .join(labels.select(F.col("v").alias("b"), F.col("c").alias("c_b")), "b").where("c = c_b")
    tested = inside.groupBy("c").agg(F.count(F.lit(1)).alias("pairs"))
    known = written(classes.join(tested, "c").select("c", (2 * F.col("pairs") == F.col("k") * (F.col("k") - 1)).alias("known")),
                    "known-components")
    sure = inside.join(known.where("known").select("c"), "c").where("linked").select("a", "b")
    sure = sure.union(sure.select("b", "a")).join(copies.select(F.col("uid").alias("b"), "copies"), "b") \
        .groupBy(F.col("a").alias("uid")).agg(F.sum("copies").alias("links"))
    rest = labels.join(known.where("NOT known").select("c"), "c").select("v", "c")
    if rest.isEmpty():
        return sure
    return sure.unionByName(_counted_links(rest, copies, sets, reps, docs, similarity))


def _counted_links(labels: DataFrame, copies: DataFrame, have: DataFrame, reps: DataFrame, docs: DataFrame,
                   similarity: int) -> DataFrame:
    """:func:`_links` by comparing all sets of a component.

    Classes of a component go by set size into bands, so that links are within
    a band or between neighbours, and bands into blocks of bounded size by a
    hash; each pair of blocks is one group of rows, whose pairs of sets are
    compared as matrices.
    """
    members = labels.select(F.col("v").alias("uid"))
    more = _whole_sets(members.join(have.select("uid"), "uid", "left_anti"), reps, docs, "component-sets")
    sets = have.join(members, "uid", "left_semi").unionByName(more)
    sized = sets.join(copies, "uid").join(labels.select(F.col("v").alias("uid"), "c"), "uid") \
        .withColumn("n", F.size("grams")) \
        .withColumn("band", F.floor(F.log("n") / F.log(F.lit(100 / similarity)) * 0.999999).cast("long"))
    sized = written(sized, "component-classes")
    blocks = written(sized.groupBy("c", "band").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_GRAMS)).cast("int").alias("k")), "component-blocks")
    above = blocks.select("c", (F.col("band") - 1).alias("band"), F.col("k").alias("k_up"))
    below = blocks.select("c", (F.col("band") + 1).alias("band"), F.col("k").alias("k_down"))
    around = blocks.join(above, ["c", "band"], "left").join(below, ["c", "band"], "left").fillna(0, ["k_up", "k_down"])
    key = "struct<low: long, up: long, x: int, y: int, second: boolean>"
    spread = sized.join(around, ["c", "band"]).withColumn("s", F.expr("cast(pmod(xxhash64(uid), k) as int)")) \
        .withColumn("p", F.explode(F.expr(f"""concat(
            transform(sequence(0, k - 1), o -> cast(struct(band, band, least(s, o), greatest(s, o), s > o) as {key})),
            if(k_up > 0, transform(sequence(0, k_up - 1), o -> cast(struct(band, band + 1, s, o, false) as {key})), array()),
            if(k_down > 0, transform(sequence(0, k_down - 1), o -> cast(struct(band - 1, band, o, s, true) as {key})), array())
        )"""))).select("c", "p.*", "uid", "copies", "grams")

    def count(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        uid, copies = group["uid"].to_numpy(), group["copies"].to_numpy()
        second = group["second"].to_numpy(zero_copy_only=False)
        grams = [np.asarray(g, dtype=np.int64) for g in group["grams"].chunk(0).to_numpy(zero_copy_only=False)]
        one = group["low"][0] == group["up"][0] and group["x"][0] == group["y"][0]
        left = np.flatnonzero(~second)
        right = left if one else np.flatnonzero(second)
        links = np.zeros(len(uid), dtype=np.int64)
        if len(left) and len(right):
            both = _shared([grams[i] for i in left], [grams[i] for i in right])
            size = np.array([len(g) for g in grams])
            linked = both * 100 >= (size[left][:, None] + size[right][None, :] - both) * similarity
            if one:
                np.fill_diagonal(linked, False)
                links[left] = linked @ copies[left]
            else:
                links[left], links[right] = linked @ copies[right], copies[left] @ linked
        return pa.table({"uid": uid, "links": links})

    return spread.groupBy("c", "low", "up", "x", "y").applyInArrow(count, "uid long, links long") \
        .groupBy("uid").agg(F.sum("links").alias("links"))


# -- 5. rounds ----------------------------------------------------------------------------
def _with_components(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.join(labels.select(F.col("v").alias("uid"), "c"), "uid", "left") \
        .withColumn("c", F.coalesce("c", "uid"))


def _merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (v, c) once the links ``found`` (a, b) hold too: only links between components are looked at."""
    ends = found.join(labels.select(F.col("v").alias("a"), F.col("c").alias("c_a")), "a", "left") \
        .join(labels.select(F.col("v").alias("b"), F.col("c").alias("c_b")), "b", "left") \
        .select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    small = components(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    known = labels.unionByName(found.select(F.explode(F.array("a", "b")).alias("v")).distinct()
                               .join(labels.select("v"), "v", "left_anti").select("v", F.col("v").alias("c")))
    out = written(known.join(small.select(F.col("v").alias("c"), F.col("c").alias("to")), "c", "left")
                  .select("v", F.coalesce("to", "c").alias("c")), "labels")
    forget(small)
    return out


def _with_partner(mixed: DataFrame, similarity: int) -> DataFrame:
    """The entries that pass the length and positional filters with one of another component at their n-gram.

    The others are part of no link: a linked pair passes at its first common
    n-gram, where both its entries stay.
    """
    entry = ["uid", "n", "pos", "c"]
    x, y = (mixed.select("key", *[F.col(c).alias(f"{c}_{side}") for c in entry]).alias(side) for side in "xy")
    passes = (F.col("c_x") != F.col("c_y")) & _passes(F.col("n_x"), F.col("pos_x"), F.col("n_y"), F.col("pos_y"), similarity)
    return x.join(y, (F.col("x.key") == F.col("y.key")) & passes, "left_semi") \
        .select("key", *[F.col(f"{c}_x").alias(c) for c in entry])


def _candidates(mixed: DataFrame, reps: DataFrame, turn: int, every: bool, similarity: int) -> DataFrame:
    """(a, b): pairs of classes in different components that share an n-gram and pass the filters.

    ``mixed`` holds the entries of the n-grams that occur in several components.

    One class of each component with one of the n-gram's largest component; or
    (``every``) all pairs, each at its first common prefix n-gram only, with
    the sketch filter in the join, so no more pairs leave it than are verified.
    """
    entry = ["uid", "n", "pos", "c"]
    if every:
        mixed = _with_partner(mixed, similarity)
        # Every n-gram at which a pair passes is here for both of its classes, so the others need no place in a row.
        ordered = mixed.groupBy("uid").agg(F.first("n").alias("n"), F.first("c").alias("c"),
                                           F.sort_array(F.collect_list(F.struct("pos", "key"))).alias("at"))
        mixed = ordered.join(reps.select("uid", "sketch"), "uid") \
            .select("uid", "n", "c", "sketch", F.col("at.key").alias("keys"), F.posexplode("at").alias("i", "e")) \
            .select("uid", "n", "c", "sketch", "e.pos", "e.key", F.slice("keys", F.lit(1), F.col("i")).alias("before"))
        x, y = (mixed.select("key", *[F.col(c).alias(f"{c}_{side}") for c in (*entry, "sketch", "before")]) for side in "xy")
        filters = (F.col("uid_x") < F.col("uid_y")) & (F.col("c_x") != F.col("c_y")) \
            & _passes(F.col("n_x"), F.col("pos_x"), F.col("n_y"), F.col("pos_y"), similarity) \
            & _close(F.col("n_x"), F.col("sketch_x"), F.col("n_y"), F.col("sketch_y"), similarity) \
            & ~F.arrays_overlap("before_x", "before_y")
        return x.alias("x").join(y.alias("y"), (F.col("x.key") == F.col("y.key")) & filters) \
            .select(F.col("uid_x").alias("a"), F.col("uid_y").alias("b"))
    if turn:
        of_each = written(mixed.groupBy("key", "c").agg(F.min_by(F.struct(*entry), F.xxhash64("uid", F.lit(turn))).alias("x"),
                                                        F.count(F.lit(1)).alias("m")), "one-of-each")
    else:  # nothing is linked yet: a component has an n-gram once
        of_each = mixed.select("key", "c", F.struct(*entry).alias("x"), F.lit(1).alias("m"))
    largest = of_each.groupBy("key").agg(F.min_by("x", F.struct(-F.col("m"), F.xxhash64("c", F.lit(turn)))).alias("y"))
    both = of_each.join(largest, "key").where("x.c <> y.c") \
        .where(_passes(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), similarity))
    return both.select(F.least("x.uid", "y.uid").alias("a"), F.greatest("x.uid", "y.uid").alias("b")).distinct()


#: Rounds go on while pairs between components exceed so many per row and, after the least number of rounds, the last
#: one left at most this share of them, for so many rounds at most; then all pairs left are taken.
PAIRS_LEFT, SHRUNK, LEAST_ROUNDS, ROUNDS = 4, 0.7, 3, 8


def _components(docs: DataFrame, similarity: int, links: bool) -> tuple[DataFrame, DataFrame]:
    """Every row with its set's signature, and per set its class, component and (with ``links``) number of linked rows."""
    with small_batches(docs.sparkSession):  # every Python task of it has run when it returns
        return _joined(docs, similarity, links)


def _joined(docs: DataFrame, similarity: int, links: bool) -> tuple[DataFrame, DataFrame]:
    classes = _frequency_classes(docs)
    rows = written(_prefixes(docs, classes, similarity), "prefixes")
    sets = rows.where("n > 0 AND id IS NOT NULL").groupBy("sig1", "sig2") \
        .agg(F.min(F.struct("id", "uid")).alias("rep"), F.count(F.lit(1)).alias("copies"))
    sets = written(sets.select("sig1", "sig2", "copies", F.col("rep.id").alias("class_id"), F.col("rep.uid").alias("uid")), "classes")
    reps = written(rows.where(F.size("prefix") > 0).join(sets.select("uid"), "uid", "left_semi"), "representatives")
    whole_rows, rows = rows, written(rows.select("uid", "id", "n", "sig1", "sig2"), "rows")
    forget(whole_rows)

    entries = reps.select("uid", "n", F.explode("prefix").alias("e")).select("uid", "n", "e.key", "e.pos")
    keys = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "shared-keys")
    entries = stored = written(entries.join(keys.select("key"), "key").select("uid", "n", "key", "pos"), "prefix-entries")
    spark, total = docs.sparkSession, rows.count()
    none = spark.range(0)  # empty tables without a Python task
    labels = none.select(F.col("id").alias("v"), F.col("id").alias("c"))
    whole = none.select(F.col("id").alias("uid"), F.array("id").alias("grams"))
    tested = none.select(F.col("id").alias("a"), F.col("id").alias("b"), (F.col("id") > 0).alias("linked"))
    before, turn = float("inf"), 0
    while True:
        if turn:
            placed = written(_with_components(entries, labels), "placed")
            per_key = written(placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(
                F.count(F.lit(1)).alias("parts"), F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("mm"))
                .where("parts > 1"), "mixed-keys")
        else:  # every class is a component, and has an n-gram once: the counts are there
            mixed, per_key = entries.withColumn("c", F.col("uid")), keys.withColumn("mm", F.col("m"))
        left = per_key.agg(F.sum((F.col("m") * F.col("m") - F.col("mm")) / 2)).first()[0] or 0
        every = turn == ROUNDS or left <= PAIRS_LEFT * total or (turn >= LEAST_ROUNDS and left > SHRUNK * before)
        if turn:  # an n-gram within one component stays so: its entries have no part in later rounds either
            mixed = placed.join(per_key.select("key"), "key")
            if not every:
                forget(stored)
                mixed = stored = written(mixed, "mixed-entries")
                entries = mixed.select("uid", "n", "key", "pos")
        if left:
            close = _candidates(mixed, reps, turn, every, similarity)
            pairs = close.join(tested, ["a", "b"], "left_anti")
            pairs = written(pairs if every else _sketch_filtered(pairs, reps, similarity), "pairs")
            ends = written(pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct(), "ends-of-pairs")
            used = whole.join(ends, "uid", "left_semi")  # a round moves only the sets of its own pairs
            missing = ends.join(whole.select("uid"), "uid", "left_anti")
            if not missing.isEmpty():
                more = _whole_sets(missing, reps, docs, "sets")
                whole, used = whole.unionByName(more), used.unionByName(more)
            fresh = written(_verified(pairs, used, similarity), "verified")
            found = fresh.where("linked").select("a", "b")
            # Of the last round, whose pairs lay in different components, only links say anything about one component.
            tested = tested.unionByName(fresh.where("linked") if every else fresh)
            if not found.isEmpty():
                old, labels = labels, _merged(labels, found)
                forget(old)
            forget(pairs, ends)
        forget(*((placed, per_key) if turn else (keys,)))
        before, turn = left, turn + 1
        if every or not left:
            break

    named = sets.join(labels.select(F.col("v").alias("uid"), "c"), "uid", "left") \
        .withColumn("c", F.coalesce("c", "uid"))
    smallest = named.groupBy("c").agg(F.min("class_id").alias("component_id"))
    n_links = F.lit(None).cast("long")
    if links:
        others = _links(labels, sets.select("uid", "copies"), tested, whole, reps, docs, similarity)
        named = named.join(others, "uid", "left")
        n_links = F.col("copies") - 1 + F.coalesce("links", F.lit(0).cast("long"))
    placed = written(named.join(smallest, "c").select("sig1", "sig2", "class_id", "component_id", n_links.alias("n_links")),
                     "components")
    forget(sets, reps, stored, labels)
    return rows, placed


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, n_links, one row per input row.

    Texts are whole; A-Z are lower-cased and words are runs of non-space
    (ASCII white space).  Two rows link when their sets of distinct 5-word
    shingles have a Jaccard similarity of at least ``similarity`` per cent; a
    text of 1 to 4 words has its whole word sequence as its one shingle.  A
    null, empty or wordless text has 0 shingles and links with nothing.
    ``component_id`` is the smallest doc_id reachable; ``class_id`` the
    smallest among rows with an equal set; ``n_links`` is the number of rows it
    links to, copies included.  Rows without id link with nothing
    and have a null component; repeated rows are copies of each other.  Other
    columns are not read.
    """
    rows, placed = _components(texts(docs, id_column, text_column), similarity, True)
    return _members(rows, placed).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def _members(rows: DataFrame, placed: DataFrame) -> DataFrame:
    member = rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                         F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("sig1")).alias("sig1"), "sig2")
    return member.join(placed, ["sig1", "sig2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def first_of_each(docs: DataFrame, similarity: int = SIMILARITY, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns, as they are), one of each component, each row by its own text.

    Of a component the row with the smallest id stays (no id: last), then the
    first one read.  Rows that share an id without being near copies all stay;
    rows without words all stay.
    """
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows", "zstd")
    rows, placed = _components(numbered.select(F.col("__row").alias("id"), F.col(text_column).cast("string").alias("text")),
                               similarity, False)
    member = _members(rows, placed).select(F.col("doc_id").alias("__row"), "component_id") \
        .join(numbered.select("__row", F.col(id_column).cast("long").alias("__id")), "__row")
    first = member.groupBy("component_id").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__row")).alias("f"))
    kept = written(first.select(F.col("f.__row").alias("__row")), "kept-rows")
    dropped = written(rows.select(F.col("id").alias("__row")).join(kept, "__row", "left_anti"), "dropped-rows")
    return without(numbered, dropped, "__row").select(*docs.columns)
