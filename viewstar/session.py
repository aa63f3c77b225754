"""Session construction and shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every viewstar job wants, whatever the cluster size.  Shuffle
# partition counts are left to AQE coalescing instead of a fixed number.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Joins of a small filtered side with a long history test the history's keys against a Bloom filter of the
    # small side before shuffling them.  The filter is at most 32 MB; a full one prunes less, nothing is lost.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "32000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "268435456",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming dedup / aggregate state lives in RocksDB (on local disk, with
    # changelog checkpoints), not on the JVM heap, so large key sets fit.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "viewstar",
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_base(spark)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) that has none gets a private one; on a
    cluster a folder of the driver's machine would be missing elsewhere, so
    that raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors share (master is {master})")
        base = tempfile.mkdtemp(prefix="viewstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_base(spark)}/viewstar/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder on whatever file system it is on (none there: nothing happens)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    _, target, fs = _file_system(spark, path)
    return bool(fs.exists(target))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted (none there: empty)."""
    _, target, fs = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all: written beside under a hidden name, then renamed."""
    jvm, target, fs = _file_system(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex[:12]}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"could not rename to {path}")


def get_text(spark: SparkSession, path: str) -> str:
    jvm, target, fs = _file_system(spark, path)
    source = fs.open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
