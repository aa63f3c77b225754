"""Personal data: exact patterns, and terms that give a protected value away.

Patterns find e-mail addresses, IPv4 addresses, payment cards (Luhn) and
international phone numbers.  Every such value is a protected entity, and so is
its class (domain, network, first digits), which pools what rare values lack.
Over the whole corpus, Spark counts in how many documents a term stands near
an entity, and in how many the entity and the term occur at all.  A term
discloses an entity as far as a document with the term surely holds it: the
lower confidence bound of P(entity | term), so two documents say more than
one and one alone never enough.  -log2 of it is what remains unknown of the
entity; the term must also tell at least ``MIN_BITS`` more than P(entity)
does.  Terms above ``generalise_at`` are generalised, those above
``remove_at`` removed, wherever they stand.  Documents without the term and
the entity change nothing but P(entity), so decisions do not drift as the
corpus grows.

Nothing of corpus size is collected or broadcast: candidate terms go into a
bitmap of fixed size, what passes it is joined with the term table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar.llm import textkit as tk
from viewstar.llm.tables import TEXT_BYTES, Bitmap, by_batch, row_key, small_batches, split, texts, written

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

#: Bounds of P(entity | term) from which a term is generalised or removed; quantile of the confidence bound (95 %,
#: one-sided), and bits a term must tell about an entity beyond its share of all documents.
GENERALISE_AT, REMOVE_AT, Z, MIN_BITS = 0.4, 0.6, 1.645, 1.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str):
    """Leftmost matches of local@domain, found from the @ signs (linear on any text)."""
    pos, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > pos and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            yield lo, m.end()
        pos = m.end() if m else at + 1
        at = text.find("@", pos)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind as in ``KINDS``, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text)
                    if 8 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15]
    return out


def _span_arrays(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    flat = [x for r in rows for x in r]
    kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    values = pa.StructArray.from_arrays([pa.array([x[k] for x in flat], kind[k].type) for k in range(3)], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)), values)


_SPANS = "array<struct<kind: int, start: long, end: long>>"


def pool(kind: int, value: str) -> str:
    """The class a value belongs to: an address's domain, an IP's network, a number's first six digits."""
    if KINDS[kind] == "email":
        return value[value.rindex("@"):]
    if KINDS[kind] == "ip":
        return value[:value.rindex(".") + 1]
    return "".join(c for c in value if c.isdigit())[:6]


def _scan(docs: DataFrame, reach: int) -> DataFrame:
    """Per row its base spans, the entities in it (values and classes) and the terms within ``reach`` words of each."""
    def run(batch):
        raw, offsets = tk.text_bytes(batch.column("text"))
        spans, near, entities = [], [], []
        for a, b in zip(offsets[:-1], offsets[1:]):
            data = raw[a:b].tobytes()
            text = data.decode()
            own = base_spans(text)
            spans.append(own)
            pairs, seen = set(), set()
            if own:
                s = tk.Slice(raw[a:b], np.array([0, b - a]), tk.ALNUM_WORDS)
                h = tk.signed(s.hashes())
                edges = [(len(text[:x].encode()), len(text[:y].encode())) for _, x, y in own]
                free = np.ones(len(h), dtype=bool)
                for x, y in edges:
                    free &= (s.end <= x) | (s.start >= y)
                for (kind, x, y), (lo, hi) in zip(own, edges):
                    value = text[x:y].lower()
                    names = [f"{kind}:{value}", f"{kind}::{pool(kind, value)}"]
                    own_e = [xxhash.xxh3_64_intdigest(name.encode()) - (1 << 63) for name in names]
                    seen.update(own_e)
                    k = int(np.searchsorted(s.start, lo))
                    before, after = np.flatnonzero(free[max(k - 4 * reach, 0):k]), np.flatnonzero(free[k:k + 4 * reach])
                    for t in [*(before[-reach:] + max(k - 4 * reach, 0)), *(after[:reach] + k)]:
                        pairs.update((e, int(h[t])) for e in own_e)
            near.append([{"e": e, "t": t} for e, t in sorted(pairs)])
            entities.append(sorted(seen))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), _span_arrays(spans),
             pa.array(near, pa.list_(pa.struct([("e", pa.int64()), ("t", pa.int64())]))),
             pa.array(entities, pa.list_(pa.int64()))], ["id", "key", "spans", "near", "entities"])
    return by_batch(docs, run, f"id long, key string, spans {_SPANS}, near array<struct<e: long, t: long>>, entities array<long>")


def _document_counts(docs: DataFrame, bitmap: Bitmap) -> DataFrame:
    """(t, n_t): in how many rows a word that may be a candidate stands; each slice of texts sends sums."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch):
        for _, _, s in tk.slices(batch.column("text"), tk.ALNUM_WORDS):
            h = s.hashes()
            at = np.flatnonzero(shared.value.has(h))
            if len(at):
                owner, word = np.searchsorted(s.first, at, side="right") - 1, h[at]
                order = np.lexsort((word, owner))
                owner, word = owner[order], word[order]
                new = np.append(True, (owner[1:] != owner[:-1]) | (word[1:] != word[:-1]))
                word, n = np.unique(word[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tk.signed(word)), pa.array(n.astype(np.int64))], ["t", "n"])
    return by_batch(docs, run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n_t"))


def _occurrences(docs: DataFrame, bitmap: Bitmap) -> DataFrame:
    """Per row the places (code points) of words that may be candidate terms; rows without any are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    kind = pa.struct([("t", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batch):
        for lo, hi, s in tk.slices(batch.column("text"), tk.ALNUM_WORDS):
            h = s.hashes()
            at = np.flatnonzero(shared.value.has(h))
            if not len(at):
                continue
            point = np.append(0, np.cumsum((s.data & 0xC0) != 0x80))
            owner = np.searchsorted(s.first, at, side="right") - 1
            base = point[s.offsets[owner]]
            rows = np.unique(owner)
            cut = np.append(np.searchsorted(owner, rows), len(owner))
            values = pa.StructArray.from_arrays([pa.array(tk.signed(h[at])), pa.array(point[s.start[at]] - base),
                                                 pa.array(point[s.end[at]] - base)], fields=list(kind))
            mine = pa.array(rows + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(mine), batch.column("key").take(mine),
                 pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), values)], ["id", "key", "places"])
    return by_batch(docs, run, "id long, key string, places array<struct<t: long, start: long, end: long>>")


def lower_bound(hits: Column, of: Column, z: float = Z) -> Column:
    """Lower end of the Wilson interval of the share ``hits / of``."""
    p, n = hits / of, of.cast("double")
    return (p + F.lit(z * z) / (2 * n) - z * F.sqrt(p * (1 - p) / n + F.lit(z * z) / (4 * n * n))) / (1 + F.lit(z * z) / n)


def find(docs: DataFrame, reach: int = 8, generalise_at: float = GENERALISE_AT, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """(id, key, spans, terms): base spans and risky terms of each row; ``key`` is its :func:`row_key`.

    ``terms`` holds (start, end, disclosure) in code points.  A term is risky
    if for an entity near which it stands the lower bound of P(entity | term)
    is at least ``generalise_at``.  A null text is an empty one, without spans;
    repeated rows count as documents of their own and get equal spans; other
    columns are not read.
    """
    spark = docs.sparkSession
    docs = texts(docs, id_column, text_column).withColumn("key", row_key("id", "text"))
    with small_batches(spark):
        base = written(_scan(docs, reach), "pii-base")
    total = base.count()
    joint = base.select(F.explode("near").alias("p")).groupBy("p.e", "p.t").agg(F.count(F.lit(1)).alias("n_et"))
    # What could not pass if the term stood nowhere but near entities need not be looked for elsewhere: common words,
    # which stand near many, go here.
    joint = written(joint.where(lower_bound(F.col("n_et"), F.col("n_et")) >= generalise_at), "pii-met")
    beside = written(base.select(F.explode(F.array_distinct(F.transform("near", lambda p: p["t"]))).alias("t"))
                     .groupBy("t").agg(F.count(F.lit(1)).alias("n_near")), "pii-beside")
    joint = written(joint.join(beside, "t").where(lower_bound(F.col("n_et"), F.col("n_near")) >= generalise_at)
                    .select("e", "t", "n_et"), "pii-pairs")
    n_term = _document_counts(docs, Bitmap.of(joint.select("t").distinct(), "t"))
    n_entity = base.select(F.explode("entities").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n_e"))
    bound = lower_bound(F.col("n_et"), F.greatest("n_t", "n_et"))
    told = F.log2(bound * F.lit(float(max(total, 1))) / F.col("n_e"))
    risky = joint.join(n_entity, "e").join(n_term, "t").where((bound >= generalise_at) & (told >= MIN_BITS)) \
        .groupBy("t").agg(F.max(bound).alias("disclosure"))
    with small_batches(spark):
        risky = written(risky, "pii-risky")
    # Only now, with common words ruled out, are places looked up.
    bitmap = Bitmap.of(risky, "t")
    with small_batches(spark):
        places = written(_occurrences(docs, bitmap), "pii-terms")
    hits = places.dropDuplicates(["id", "key"]).select("id", "key", F.explode("places").alias("p")) \
        .select("id", "key", F.col("p.t").alias("t"), F.col("p.start").alias("start"), F.col("p.end").alias("end")) \
        .join(risky, "t").groupBy("id", "key") \
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    same = F.col("b.id").eqNullSafe(F.col("h.id")) & (F.col("b.key") == F.col("h.key"))
    joined = base.select("id", "key", "spans").alias("b").join(hits.alias("h"), same, "left") \
        .select("b.id", "b.key", "spans", F.coalesce("terms", F.array().cast(
            "array<struct<start: long, end: long, disclosure: double>>")).alias("terms"))
    clear = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"])))
    return joined.withColumn("terms", clear)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans, n_terms from :func:`find`."""
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("spans", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
                                                      s["end"].cast("string")))
    terms = F.transform("terms", lambda t: F.concat_ws(":", F.lit(TERM), t["start"].cast("string"), t["end"].cast("string")))
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(F.array_remove(F.transform("spans", lambda s: (s["kind"] == i)), False)).cast("long").alias(f"n_{k}")
          for i, k in enumerate(KINDS)],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def sanitise(docs: DataFrame, reach: int = 8, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT,
             id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` (all rows and columns) with base spans replaced by [KIND], risky terms by [TERM], and terms
    that disclose at least ``remove_at`` taken out.  Texts without either come back as they are (null: null)."""
    found = find(docs, reach, generalise_at, id_column, text_column) \
        .where((F.size("spans") > 0) | (F.size("terms") > 0)).dropDuplicates(["key"]) \
        .select(F.col("key").alias("__key"), F.col("spans").alias("__spans"), F.col("terms").alias("__terms"))
    found = written(found, "pii-found")
    at = docs.columns.index(text_column)
    as_is, others = split(docs.withColumn("__key", row_key(id_column, text_column)), found, "__key")
    joined = others.join(found, "__key", "left").select(*docs.columns, "__spans", "__terms")

    def replace(batch):
        column = batch.column(at)
        texts_of, spans, terms = column.to_pylist(), batch.column("__spans").to_pylist(), batch.column("__terms").to_pylist()
        for i, (text, own, risky) in enumerate(zip(texts_of, spans, terms)):
            if text is None or not (own or risky):
                continue
            cuts = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in own or ()]
            cuts += [(t["start"], t["end"], "" if t["disclosure"] >= remove_at else "[TERM]") for t in risky or ()]
            out, done = [], 0
            for a, b, mark in sorted(cuts):
                if a >= done:
                    out += [text[done:a], mark]
                done = max(done, b)
            texts_of[i] = "".join(out) + text[done:]
        columns = list(batch.columns[:-2])
        columns[at] = pa.array(texts_of, column.type)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-2])
    return as_is.select(*docs.columns).unionByName(by_batch(joined, replace, docs.schema, TEXT_BYTES))

