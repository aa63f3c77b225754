"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is two buckets of two hash tables whose embeddings are added (a clash
in one table leaves the other half apart).  Filters of widths 1, 2 and 3 run
over the words; each filter's largest value over the whole text (max pooling)
feeds one logistic unit.  Embeddings start from the training rows' log
odds and are then trained with the filters by Adam, shard by shard of all
labelled rows, the shards' models averaged after every epoch.  The decision
threshold is calibrated per language on held-back training rows and folded into the score,
so 0.5 is the threshold everywhere; the language is the one predicted from the
text, never a column.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm import langid
from viewstar.llm import textkit as tk
from viewstar.llm.tables import Bitmap, by_batch, forget, hash_share, texts, written

WIDTHS = (1, 2, 3)
_PAD = max(WIDTHS) - 1


def _buckets(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


@dataclass
class Model:
    bits: int
    tables: np.ndarray        # (2, 2**bits, dim) embeddings
    filters: list[np.ndarray]  # per width: (width, dim, filters)
    bias: np.ndarray          # (widths * filters,)
    out: np.ndarray           # (widths * filters,)
    intercept: float
    language: langid.Model | None = None
    thresholds: dict[str, float] = field(default_factory=dict)  # logit per predicted language
    threshold: float = 0.0

    def pooled(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts, features) pooled filter values before ReLU and the padded embeddings.

        Every text is followed by two zero rows, so no window reaches the next text.
        """
        n_texts, dim = len(first) - 1, self.tables.shape[2]
        owner = np.repeat(np.arange(n_texts), np.diff(first))
        at = np.arange(len(h)) + _PAD * owner
        a, b = _buckets(h, self.bits)
        x = np.zeros((len(h) + _PAD * n_texts + _PAD, dim), dtype=np.float32)
        x[at] = self.tables[0][a] + self.tables[1][b]
        best = np.full((n_texts, len(self.bias)), -1e9, dtype=np.float32)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            low, lo = first[some], 0
            for w, f in zip(WIDTHS, self.filters):
                y = x[:len(x) - _PAD] @ f[0]
                for k in range(1, w):
                    y += x[k:len(x) - _PAD + k] @ f[k]
                best[some, lo:lo + f.shape[2]] = np.maximum.reduceat(y[at], low, axis=0)
                lo += f.shape[2]
        return best, x

    def logits(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        best, _ = self.pooled(h, first)
        return np.maximum(best + self.bias, 0.0).astype(np.float64) @ self.out + self.intercept

    def scores(self, column: pa.Array) -> np.ndarray:
        """Calibrated score of each text of a batch."""
        found = []
        for lo, hi, s in tk.slices(column, tk.ALNUM_WORDS):
            h, limit = s.hashes(), 1 << 18
            if len(h) <= limit:
                found.append(self.logits(h, s.first))
            else:  # one very long text: filters in overlapping runs of words, the largest value over all
                best = np.max([self.pooled(h[k:k + limit + _PAD], np.array([0, len(h[k:k + limit + _PAD])]))[0]
                               for k in range(0, len(h), limit)], axis=0) if hi - lo == 1 else self.pooled(h, s.first)[0]
                found.append(np.maximum(best + self.bias, 0.0).astype(np.float64) @ self.out + self.intercept)
        logit = np.concatenate(found) if found else np.zeros(0)
        limit = self.threshold
        if self.thresholds and self.language is not None:
            names, _ = self.language.predict(column)
            limit = np.array([self.thresholds.get(n, self.threshold) for n in names])
        return 1.0 / (1.0 + np.exp(-np.clip(logit - limit, -60.0, 60.0)))


def _seen(samples: list[np.ndarray], y: np.ndarray, bits: int) -> np.ndarray:
    """(tables, labels, buckets): documents of each label that hold a bucket."""
    seen = np.zeros((2, 2, 1 << bits))
    for h, label in zip(samples, y):
        for k in range(2):
            seen[k, label, np.unique(_buckets(h, bits)[k])] += 1
    return seen


@dataclass
class _Training:
    """A model being trained: its weights, the state of Adam and the order of documents."""

    model: Model
    weight: np.ndarray  # of a document of each label
    rate: float
    rng: np.random.Generator
    moments: list[tuple[np.ndarray, np.ndarray]]
    step: int = 0

    @classmethod
    def begin(cls, seen: np.ndarray, n: np.ndarray, bits: int, dim: int, n_filters: int, rate: float,
              seed: int = 11) -> "_Training":
        """From the documents per label and bucket (:func:`_seen`) and per label."""
        rng = np.random.default_rng(seed)
        tables = rng.normal(0, 0.05, size=(2, 1 << bits, dim)).astype(np.float32)
        for k in range(2):  # first dimension: log odds of a bucket's documents
            odds = np.log((seen[k, 1] + 0.5) / (n[1] + 1.0)) - np.log((seen[k, 0] + 0.5) / (n[0] + 1.0))
            tables[k, :, 0] = 0.5 * odds * (seen[k].sum(axis=0) / (seen[k].sum(axis=0) + 3.0))
        filters = [rng.normal(0, 0.2, size=(w, dim, n_filters)).astype(np.float32) for w in WIDTHS]
        for f in filters:
            f[0, 0, 0] += 1.0
        features = len(WIDTHS) * n_filters
        model = Model(bits, tables, filters, np.zeros(features, np.float32),
                      np.full(features, 0.3, np.float32), -1.0)
        share = n[1] / max(n.sum(), 1)
        weight = np.array([0.5 / max(1 - share, 1e-3), 0.5 / max(share, 1e-3)])
        return cls(model, weight, rate, rng, [(np.zeros_like(p), np.zeros_like(p)) for p in [*filters, model.bias, model.out]])

    def params(self) -> list[np.ndarray]:
        return [*self.model.filters, self.model.bias, self.model.out]

    def epoch(self, samples: list[np.ndarray], y: np.ndarray) -> None:
        """Adam over all documents once, 32 at a time."""
        model, rate, params = self.model, self.rate, self.params()
        n_filters = model.filters[0].shape[2]
        order = self.rng.permutation(len(samples))
        for lo in range(0, len(order), 32):
            rows = order[lo:lo + 32]
            hs = [samples[i] for i in rows]
            first = np.concatenate([[0], np.cumsum([len(h) for h in hs])])
            h = np.concatenate(hs)
            best, x = model.pooled(h, first)
            value = best + model.bias
            active = np.maximum(value, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ model.out + model.intercept, -30, 30)))
            g = ((p - y[rows]) * self.weight[y[rows]] / len(rows)).astype(np.float32)
            d_value = np.outer(g, model.out) * (value > 0)
            grads = [np.zeros_like(f) for f in model.filters] + [d_value.sum(axis=0), active.T @ g]
            a, b = _buckets(h, model.bits)
            for i, hh in enumerate(hs):
                if not len(hh):
                    continue
                begin = first[i] + _PAD * i
                col = 0
                for k, (w, f) in enumerate(zip(WIDTHS, model.filters)):
                    live = np.flatnonzero(d_value[i, col:col + n_filters])
                    if len(live):
                        y_own = sum(x[begin + j:begin + len(hh) + j] @ f[j][:, live] for j in range(w))
                        top = y_own.argmax(axis=0)
                        d = d_value[i, col + live]
                        for j in range(w):
                            at = top + j
                            grads[k][j][:, live] += x[begin + at].T * d
                            ok = at < len(hh)
                            back = (f[j][:, live] * d).T[ok] * rate * 10
                            word = first[i] + at[ok]
                            np.add.at(model.tables[0], a[word], -back)
                            np.add.at(model.tables[1], b[word], -back)
                    col += n_filters
            self.step += 1
            for param, grad, (m, v) in zip(params, grads, self.moments):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad * grad
                param -= rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
            model.intercept -= rate * float(g.sum())

    def state(self) -> np.ndarray:
        """All that an epoch changes but the embeddings, as one vector."""
        return np.concatenate([x.ravel().astype(np.float64) for x in
                               [*self.params(), *[z for pair in self.moments for z in pair]]] + [[self.model.intercept, self.step]])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for x in [*self.params(), *[z for pair in self.moments for z in pair]]:
            x[...] = state[at:at + x.size].reshape(x.shape)
            at += x.size
        self.model.intercept, self.step = float(state[at]), int(round(state[at + 1]))

    def copy(self, turn: int) -> "_Training":
        """To train on by itself, with an order of its own in every round."""
        own = copy.deepcopy(self)
        own.rng = np.random.Generator(own.rng.bit_generator.jumped(turn))
        return own


def _fit(samples: list[np.ndarray], y: np.ndarray, bits: int, dim: int, n_filters: int, epochs: int, rate: float) -> Model:
    training = _Training.begin(_seen(samples, y, bits), np.bincount(y, minlength=2), bits, dim, n_filters, rate)
    for _ in range(epochs):
        training.epoch(samples, y)
    return training.model


def _threshold(logit: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap with the best F1."""
    value, group = np.unique(logit, return_inverse=True)
    return _cut(value, value, np.bincount(group, weights=y), np.bincount(group))


def _cut(low: np.ndarray, high: np.ndarray, positive: np.ndarray, n: np.ndarray) -> float:
    """:func:`_threshold` from ascending groups of logits: their least and largest ones, toxic and all documents."""
    low, high = low[::-1], high[::-1]
    f1 = 2 * np.cumsum(positive[::-1]) / (np.cumsum(n[::-1]) + positive.sum())
    k = int(f1.argmax())
    return float((low[k] + high[k + 1]) / 2) if k + 1 < len(low) else float(low[k] - 1.0)


#: A shard of the training rows, which one task trains on: about so many documents and bytes of text.
SHARD_DOCS, SHARD_BYTES = 6000, 1 << 26
_BLOCK = 1 << 11    # buckets in one row of a round's result
_MERGED = 64        # rows of a block merged at once
_STEPS = 1024       # groups of logits in one unit of them


def _packed(h: np.ndarray, bits: int) -> bytes:
    """The parts of the hashes that :func:`_buckets` looks at."""
    if bits > 16:
        return h.astype("<u8").tobytes()
    a, b = _buckets(h, bits)
    return (a | b << 16).astype("<u4").tobytes()


def _unpacked(data: bytes, bits: int) -> np.ndarray:
    if bits > 16:
        return np.frombuffer(data, "<u8").astype(np.uint64)
    v = np.frombuffer(data, "<u4").astype(np.uint64)
    return v & np.uint64(0xFFFF) | v >> np.uint64(16) << np.uint64(32)


def _shards(docs: DataFrame, marks: DataFrame, language: langid.Model | None, bits: int) -> tuple[DataFrame, int]:
    """(s, y, lang, words): every text of every id in ``marks`` (id, y) once, one row per shard; and their number."""
    known = written(docs.select("id", F.xxhash64("text").alias("k"), F.octet_length("text").alias("size")).join(marks, "id")
                    .groupBy("id", "k").agg(F.max("y").alias("y"), F.max("size").alias("size")), "labelled-rows")
    sized = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    count = max(-(-sized["n"] // SHARD_DOCS), -(-sized["size"] // SHARD_BYTES), 1)
    shard = F.pmod(F.xxhash64("id", "k"), F.lit(count)).cast("int").alias("s")
    shared = docs.sparkSession.sparkContext.broadcast((Bitmap.of(marks.select(F.xxhash64("id").alias("h")), "h"), language))

    def words(batch):
        marked, language = shared.value
        batch = batch.filter(pa.array(marked.has(batch.column("h").to_numpy().view(np.uint64))))
        out = []
        for lo, hi, s in tk.slices(batch.column("text"), tk.ALNUM_WORDS):
            h = s.hashes()
            out += [_packed(h[s.first[i]:s.first[i + 1]], bits) for i in range(hi - lo)]
        langs = language.predict(batch.column("text"))[0] if language else [""] * batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("k"), pa.array(langs, pa.string()),
                                          pa.array(out, pa.binary())], ["id", "k", "lang", "words"])

    def pack(found: pa.Table, known: pa.Table) -> pa.Table:
        # The filter on ids may let others through, and a text may come twice: the labelled ones stay, once.
        rows = found.select(["id", "k"]).to_pandas().drop_duplicates()
        rows = rows.assign(row=rows.index).merge(known.select(["id", "k", "y"]).to_pandas(), on=["id", "k"]).sort_values(["id", "k"])
        own = found.take(pa.array(rows["row"].to_numpy(dtype=np.int64)))
        lists = {"y": rows["y"].to_list(), "lang": own["lang"].to_pylist(), "words": own["words"].to_pylist()}
        kinds = {"y": pa.int32(), "lang": pa.string(), "words": pa.binary()}
        return pa.table({"s": pa.array([known["s"][0].as_py()] if len(rows) else [], pa.int32()),
                         **{c: pa.array([x] if len(rows) else [], pa.list_(kinds[c])) for c, x in lists.items()}})

    # The texts' words move once; their labels, found by ids, come to them.
    rows = by_batch(docs.where("id IS NOT NULL").select("id", "text", F.xxhash64("text").alias("k"), F.xxhash64("id").alias("h")),
                    words, "id long, k long, lang string, words binary").withColumn("s", shard)
    packed = rows.groupBy("s").cogroup(known.withColumn("s", shard).groupBy("s")) \
        .applyInArrow(pack, "s int, y array<int>, lang array<string>, words array<binary>")
    shards = written(packed, "training-shards")
    forget(known)
    return shards, count


def _documents(batch: pa.RecordBatch, bits: int, held: bool | None):
    """Of every shard of a batch: number, words, labels and languages; of the quarter held back, the others or (None) all."""
    for r in range(batch.num_rows):
        y = np.array(batch.column("y")[r].as_py(), dtype=np.int64)
        use = np.flatnonzero((np.arange(len(y)) % 4 == 3) == held) if held is not None else np.arange(len(y))
        words, lang = batch.column("words")[r], batch.column("lang")[r]
        yield (batch.column("s")[r].as_py(), [_unpacked(words[i].as_py(), bits) for i in use.tolist()], y[use],
               [lang[i].as_py() for i in use.tolist()])


_BLOCKS = "block int, s int, at binary, n binary, v binary"


def _blocks(s: int, at: np.ndarray, values: np.ndarray, n: float) -> pa.RecordBatch:
    """Rows of ``_BLOCKS``: values of the places ``at`` (ascending) with a weight, by block of places."""
    block = at // _BLOCK
    cuts = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(at)) if len(at) else np.zeros(1, int)
    parts = [(int(block[lo]), at[lo:hi].astype("<i8").tobytes(), np.full(hi - lo, float(n)).tobytes(),
              values[lo:hi].astype("<f8" if block[lo] < 0 else "<f4").tobytes()) for lo, hi in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in parts], pa.int32()), pa.array([s] * len(parts), pa.int32()),
         *[pa.array([x[k] for x in parts], pa.binary()) for k in (1, 2, 3)]], ["block", "s", "at", "n", "v"])


def _means(rows: DataFrame, shards: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(at, total weight, weighted mean) of every block; merged in steps, so no group grows with the shards."""
    def merge(group: pa.Table) -> pa.Table:
        block = group["block"][0].as_py()
        kind = "<f8" if block < 0 else "<f4"
        at, n = (np.concatenate([np.frombuffer(x.as_py(), t) for x in group[c]]) for c, t in (("at", "<i8"), ("n", "<f8")))
        v = np.concatenate([np.frombuffer(x.as_py(), kind) for x in group["v"]]).astype(np.float64).reshape(len(at), -1)
        place, own = np.unique(at, return_inverse=True)
        total, weight = np.zeros((len(place), v.shape[1])), np.bincount(own, weights=n)
        np.add.at(total, own, v * n[:, None])
        return pa.table({"block": pa.array([block], pa.int32()), "s": group["s"][:1], "at": [place.astype("<i8").tobytes()],
                         "n": [weight.tobytes()], "v": [(total / weight[:, None]).astype(kind).tobytes()]})

    while shards > _MERGED:
        shards = -(-shards // _MERGED)
        rows = rows.withColumn("s", F.pmod("s", F.lit(shards)).cast("int")).groupBy("block", "s").applyInArrow(merge, _BLOCKS)
    found = []
    for r in rows.groupBy("block").applyInArrow(merge, _BLOCKS).orderBy("block").toPandas().itertuples():
        at, n = np.frombuffer(r.at, "<i8"), np.frombuffer(r.n, "<f8")
        found.append((at, n, np.frombuffer(r.v, "<f8" if r.block < 0 else "<f4").reshape(len(at), -1)))
    return found


def _fit_shards(shards: DataFrame, count: int, n: np.ndarray, held: bool | None, bits: int, dim: int, n_filters: int,
                epochs: int, rate: float) -> Model:
    """:func:`_fit` on all shards: each round, every shard trains a copy of the model on its documents, and the copies'
    mean is the next model (of a bucket's embedding, the mean of the copies that changed it).  One shard needs one round."""
    spark, size = shards.sparkSession, 1 << bits

    def count_buckets(batch):
        for s, samples, y, _ in _documents(batch, bits, held):
            seen = _seen(samples, y, bits).transpose(0, 2, 1).reshape(-1, 2)
            at = np.flatnonzero(seen.any(axis=1))
            # The weight is 1, so a mean times the total weight is the sum.
            yield _blocks(s, at, seen[at], 1)

    seen = np.zeros((2 * size, 2))
    for at, times, mean in _means(by_batch(shards, count_buckets, _BLOCKS), count):
        seen[at] = np.rint(mean.astype(np.float64) * times[:, None])
    training = _Training.begin(seen.reshape(2, size, 2).transpose(0, 2, 1), n, bits, dim, n_filters, rate)
    rounds, each = (1, epochs) if count == 1 else (epochs, 1)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(training)

        def one_round(batch, turn=turn, shared=shared):
            before = shared.value.model.tables.reshape(2 * size, dim)
            for s, samples, y, _ in _documents(batch, bits, held):
                if len(y):
                    own = shared.value.copy(turn)
                    for _ in range(each):
                        own.epoch(samples, y)
                    tables = own.model.tables.reshape(2 * size, dim)
                    at = np.flatnonzero((tables != before).any(axis=1))
                    yield _blocks(s, at, tables[at], len(y))
                    yield _blocks(s, np.array([-1]), own.state()[None], len(y))

        for at, _, mean in _means(by_batch(shards, one_round, _BLOCKS), count):
            if at[0] < 0:
                training.restore(mean[0])
            else:
                training.model.tables.reshape(2 * size, dim)[at] = mean
        shared.unpersist()
    return training.model


def _calibrate_shards(model: Model, shards: DataFrame, held: bool | None, least_positive: int) -> None:
    """Thresholds with the best F1 by language and in all, from counts of logits by steps of 1/1024 (clipped at 60)."""
    shared = shards.sparkSession.sparkContext.broadcast(model)

    def logits(batch):
        for _, samples, y, lang in _documents(batch, model.bits, held):
            z = np.concatenate([shared.value.logits(h, np.array([0, len(h)])) for h in samples]) if samples else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(y), pa.array(np.clip(z, -60.0, 60.0))],
                                             ["lang", "y", "z"])
    groups = by_batch(shards, logits, "lang string, y long, z double") \
        .groupBy("lang", F.floor(F.col("z") * _STEPS).alias("step")) \
        .agg(F.min("z").alias("low"), F.max("z").alias("high"), F.sum("y").alias("positive"), F.count(F.lit(1)).alias("n")) \
        .toPandas()
    how = {"low": "min", "high": "max", "positive": "sum", "n": "sum"}
    cut = lambda x: _cut(*(x.sort_values("step")[c].to_numpy(dtype=np.float64) for c in how))
    model.threshold = cut(groups.groupby("step", as_index=False).agg(how))
    for name, mine in groups.groupby("lang"):
        if mine["positive"].sum() >= least_positive and (mine["n"] - mine["positive"]).sum() >= least_positive:
            model.thresholds[name] = cut(mine)


def _silent(language: langid.Model | None) -> Model:
    """Scores every text 0."""
    zero = np.zeros((2, 1, 1), np.float32)
    return Model(0, zero, [np.zeros((w, 1, 1), np.float32) for w in WIDTHS], np.zeros(3, np.float32),
                 np.zeros(3, np.float32), -60.0, language)


def train(docs: DataFrame, labels: DataFrame, language: langid.Model | None = None, id_column: str = "doc_id",
          text_column: str = "text", label_column: str = "toxic", sample_docs: int | None = None,
          max_sample_words: int = 4000, bits: int = 16, dim: int = 8, n_filters: int = 8, epochs: int = 6,
          rate: float = 0.01, least_positive: int = 8) -> Model:
    """Fit on every labelled document, each text of an id once, whatever its length; a quarter calibrates thresholds.

    The rows lie in shards of bounded size, each trained on by one task per
    epoch; only models, counts per bucket and counts of logits reach the
    driver.  With ``sample_docs``, the driver trains on about so many of them
    (chosen by the hash of id and text), of up to ``max_sample_words`` words.

    A document labelled twice counts as toxic if any label says so.  Without a
    label of each kind the model scores every text 0.
    """
    marks = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y"))
    docs = texts(docs, id_column, text_column)
    if sample_docs is not None:
        return _train_on_sample(docs, marks, language, sample_docs, max_sample_words, bits, dim, n_filters, epochs, rate,
                                least_positive)
    marks = written(marks, "marks")
    shards, count = _shards(docs, marks, language, bits)
    sizes = np.zeros((2, 2), dtype=np.int64)  # held back, label
    for r in shards.select(F.posexplode("y").alias("at", "y")).groupBy((F.col("at") % 4 == 3).alias("held"), "y") \
            .agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[int(r["held"]), r["y"]] = r["n"]
    if sizes.sum(axis=0).all():
        hold = bool(sizes[1].all())
        model = _fit_shards(shards, count, sizes[0] if hold else sizes.sum(axis=0), False if hold else None,
                            bits, dim, n_filters, epochs, rate)
        _calibrate_shards(model, shards, True if hold else None, least_positive)
        model.language = language
    else:
        model = _silent(language)
    forget(marks, shards)
    return model


def _train_on_sample(docs: DataFrame, marks: DataFrame, language: langid.Model | None, sample_docs: int, max_sample_words: int,
                     bits: int, dim: int, n_filters: int, epochs: int, rate: float, least_positive: int) -> Model:
    """Both bounds limit what the driver gathers, however often an id repeats."""
    total = marks.count()
    chosen = hash_share(marks, F.col("id"), F.lit(float(sample_docs)), F.lit(total))

    def words(batch):
        out, langs = [], []
        for lo, hi, s in tk.slices(batch.column("text"), tk.ALNUM_WORDS):
            h = s.hashes()
            out += [tk.signed(h[s.first[i]:s.first[i + 1]]) for i in range(hi - lo)]
        langs = language.predict(batch.column("text"))[0] if language else [""] * batch.num_rows
        fit = [len(h) <= max_sample_words for h in out]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").filter(pa.array(fit)), batch.column("y").filter(pa.array(fit)),
             pa.array([n for n, k in zip(langs, fit) if k], pa.string()),
             pa.array([h for h, k in zip(out, fit) if k], pa.list_(pa.int64()))], ["id", "y", "lang", "h"])

    # The chosen labels are at most a few more than sample_docs rows of 12 bytes; their documents may be any number.
    known = written(docs.join(F.broadcast(chosen), "id")
                    .withColumn("k", F.xxhash64("text")).dropDuplicates(["id", "k"]), "labelled-texts")
    sample = hash_share(known, F.struct("id", "k"), F.lit(float(sample_docs)), F.lit(known.count()))
    rows = by_batch(sample.select("id", "text", "y"), words, "id long, y int, lang string, h array<long>").toPandas()
    forget(known)
    rows = rows.assign(k=[hash(tuple(h)) for h in rows["h"]]).sort_values(["id", "k"], kind="stable")
    y = rows["y"].to_numpy(dtype=np.int64)
    if len(np.unique(y)) < 2:
        return _silent(language)
    samples = [np.asarray(h, dtype=np.int64).view(np.uint64) for h in rows["h"]]
    held = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[held])) < 2:
        held[:] = False
    model = _fit([s for s, k in zip(samples, held) if not k], y[~held], bits, dim, n_filters, epochs, rate)
    check = held if held.any() else np.ones(len(y), dtype=bool)
    kept = [s for s, k in zip(samples, check) if k]
    logit = np.concatenate([model.logits(s, np.array([0, len(s)])) for s in kept])
    t, names = y[check], rows["lang"].to_numpy()[check]
    model.threshold = _threshold(logit, t)
    model.language = language
    for name in sorted(set(names)):
        mine = names == name
        if t[mine].sum() >= least_positive and (t[mine] == 0).sum() >= least_positive:
            model.thresholds[name] = _threshold(logit[mine], t[mine])
    return model


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score, predicted), one row per input row; a null or empty text scores as one without any word.

    Whole texts are scored whatever their length; repeated rows score alike;
    other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batch):
        s = shared.value.scores(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["id", "score", "predicted"])
    return by_batch(texts(docs, id_column, text_column), each, "id long, score double, predicted int")
