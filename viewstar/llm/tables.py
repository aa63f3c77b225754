"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.llm import textkit as tk
from viewstar.session import remove_path, scratch_path


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared scratch folder, read back: the lineage is cut there,
    and a lost executor costs a re-read of files.  For whole texts, codec ``zstd`` takes less disk."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path, compression=codec)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def forget(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` whose last reader is done (frames derived from one are not known here)."""
    for df in tables:
        if path := getattr(df, "scratch", None):
            remove_path(df.sparkSession, path)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text) under fixed names; every other column, whatever its name, is left behind."""
    return docs.select(F.col(id_column).cast("long").alias("id"),
                       F.col(text_column).cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of a column's text, modulo ``buckets`` (null stays null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets


def importable(spark: SparkSession) -> None:
    """Let local Python workers find this package wherever the driver was started; on a cluster
    it is shipped with the job (``--py-files``) or installed."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))


#: Bytes of whole texts that a Python task works on at once, see :func:`by_batch`.
TEXT_BYTES = 2 << 20


def lean() -> None:
    """Give back what this Python worker has freed: Spark keeps workers for later tasks, and neither Arrow's pool
    nor the C library returns memory of finished ones by itself."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def by_batch(df: DataFrame, each: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
             limit: int | None = None) -> DataFrame:
    """mapInArrow over every batch; with a ``limit`` over pieces of about so many bytes (one row at least), so that
    what ``each`` makes of whole texts, and what the JVM reads back at once, is as small."""
    importable(df.sparkSession)

    def run(batches):
        lean()
        for batch in batches:
            rows = batch.num_rows
            step = max(1, min(rows, rows * limit // max(batch.nbytes, 1))) if limit else max(rows, 1)
            for lo in range(0, rows, step):
                yield from each(batch.slice(lo, step))
        batch = None
        lean()
    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Python tasks that run inside get at most so many rows at once: the default of 10,000 is counted in
    rows, and whole texts of that many fill both sides of the pipe."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_key(text_column: str) -> Column:
    """128 bits of a text, as a string; a null has a key as well."""
    text = F.col(text_column).cast("string")
    return F.concat_ws(":", F.xxhash64(text).cast("string"), F.xxhash64(F.lit(1), text).cast("string"))


def row_key(id_column: str, text_column: str) -> Column:
    """A row's id (null is one too) and the hash of its text, as :func:`texts` has both."""
    return F.concat_ws(":", F.coalesce(F.col(id_column).cast("long").cast("string"), F.lit("")),
                       F.xxhash64(F.col(text_column).cast("string")).cast("string"))


def split(df: DataFrame, keys: DataFrame, key: str, bits: int = 1 << 23) -> tuple[DataFrame, DataFrame]:
    """(rows of ``df`` whose ``key`` is surely not in ``keys``, the others); no key of ``keys`` is null.

    A table of at most ``bits / 64`` words, whatever the size of ``keys``,
    tells them apart, so no row is shuffled.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    words = keys.select(slot.alias("__slot")).groupBy(F.expr("__slot div 64").alias("__word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__slot % 64 as int))")).alias("__bits"))
    marked = df.withColumn("__slot", slot).withColumn("__word", F.expr("__slot div 64")) \
        .join(F.broadcast(words), "__word", "left") \
        .withColumn("__maybe", F.coalesce(F.expr("shiftright(__bits, cast(__slot % 64 as int)) & 1L"), F.lit(0)) == 1)
    return marked.where("NOT __maybe").select(*df.columns), marked.where("__maybe").select(*df.columns)


def without(df: DataFrame, dropped: DataFrame, key: str, bits: int = 1 << 23) -> DataFrame:
    """``df`` less the rows whose ``key`` is in ``dropped`` (no nulls there); whole rows are shuffled only where
    :func:`split` cannot tell that they stay."""
    stay, maybe = split(df, dropped, key, bits)
    return stay.unionByName(maybe.join(dropped, key, "left_anti").select(*df.columns))


def hash_share(df: DataFrame, key: Column, wanted: Column, total: Column) -> DataFrame:
    """About ``wanted`` of ``total`` rows, chosen by the hash of ``key`` (no shuffle, the same every time).

    Rows of one key are taken or left together, so give a key that few rows share."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.lit(1_000_000.0) * wanted / F.greatest(total, F.lit(1)))


def repeated_hashes(rows: DataFrame, column: str, flush: int = 2_000_000) -> DataFrame:
    """(h): of the 64-bit hashes in an array column, the mixed upper 40 bits that occur twice or more.

    Every task sends its sorted, distinct keys per range of hash space, delta-coded
    (about 4 bytes a key), and one group per range merges them.
    """
    spark = rows.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = min(-(-(1 << 40) // ranges), (1 << 32) - 1)  # deltas are 32-bit
    ranges = -(-(1 << 40) // width)
    importable(spark)

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        at = np.searchsorted(key, np.arange(ranges + 1, dtype=np.int64) * width)
        parts = [(r, tk.planes(np.diff(key[a:b], prepend=r * width)), (n[a:b] > 1).tobytes())
                 for r, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in parts], pa.int32()), pa.array([x[1] for x in parts], pa.binary()),
                                           pa.array([x[2] for x in parts], pa.binary())], ["r", "deltas", "twice"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().view(np.uint64)
            held.append((values >> np.uint64(24)).astype(np.int64))
            size += len(values)
            if size >= flush:
                yield emit(held)
                held, size = [], 0
        if size:
            yield emit(held)

    def merge(group: pa.Table) -> pa.Table:
        key = np.concatenate([np.cumsum(tk.unplanes(d.as_py()), dtype=np.int64) for d in group.column("deltas")])
        twice = np.concatenate([np.frombuffer(d.as_py(), dtype=bool) for d in group.column("twice")])
        order = np.argsort(key, kind="stable")
        key, twice = key[order] + group.column("r")[0].as_py() * width, twice[order]
        same = np.append(key[1:] == key[:-1], False)
        again = np.unique(key[same | twice])
        return pa.table({"h": tk.signed(tk.mix(again.astype(np.uint64)))})
    return rows.select(column).mapInArrow(count, "r int, deltas binary, twice binary").groupBy("r").applyInArrow(merge, "h long")


class Bitmap:
    """A fixed-size set of 64-bit hashes that may say yes wrongly, never no wrongly.

    Built by one aggregate of at most ``bits / 64`` rows, whatever the table's
    size, so it is safe to send to every task; a full bitmap only means that
    nothing is filtered.
    """

    BITS = 1 << 23

    def __init__(self, words: np.ndarray):
        self.words = words
        self.bits = 64 * len(words)

    @classmethod
    def of(cls, df: DataFrame, hash_column: str, bits: int = BITS) -> "Bitmap":
        return cls.of_levels(df.select(F.col(hash_column).alias("h"), F.lit(1).alias("level")), "h", "level", 1, bits)[0]

    @classmethod
    def of_levels(cls, df: DataFrame, hash_column: str, level_column: str, levels: int,
                  bits: int = 1 << 24) -> list["Bitmap"]:
        """Bitmap k holds the hashes of level k or above, k = 1 .. levels; one pass over ``df``."""
        slot = F.pmod(F.shiftright(F.col(hash_column), 20), F.lit(bits)).cast("long").alias("s")
        bit = F.expr("shiftleft(1L, cast(s % 64 as int))")
        rows = df.select(slot, F.col(level_column).alias("level")) \
            .select(F.expr("s div 64").alias("w"), *[F.when(F.col("level") >= k, bit).otherwise(F.lit(0).cast("long"))
                                                     .alias(f"b{k}") for k in range(1, levels + 1)]) \
            .groupBy("w").agg(*[F.bit_or(f"b{k}").alias(f"b{k}") for k in range(1, levels + 1)]).toPandas()
        made = []
        for k in range(1, levels + 1):
            words = np.zeros(bits // 64, dtype=np.int64)
            words[rows["w"].to_numpy(dtype=np.int64)] = rows[f"b{k}"].to_numpy(dtype=np.int64)
            made.append(cls(words.view(np.uint64)))
        return made

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """``hashes`` as uint64; the slot is taken from bit 20 upwards, as in ``of_levels``."""
        slot = ((hashes >> np.uint64(20)) & np.uint64(self.bits - 1)).astype(np.int64)
        return ((self.words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
