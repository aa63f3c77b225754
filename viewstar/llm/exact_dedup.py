"""Exact dedup: group by a 128-bit content hash, keep one row, compare bytes inside the groups.

DataFrame functions only; no Python runs on rows.  Two texts are equal when
they are identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted.
Of equal texts the row with the most code points in its original text stays,
then the one with the smallest id (no id: last), then the first row read.

* The hash is the first half of the normalised text's SHA-256.  It only says
  where to look: every hash is tested by grouping on (hash, whole normalised
  text), which compares bytes and folds copies inside each task before the
  shuffle, so a text holding a third of all rows moves once per task.
* If some hash has two texts, those rows alone carry their whole text in the
  grouping key (normally empty); all other rows are grouped by 16 bytes.
* Sizes and keepers come from fixed-width hash aggregates in three steps
  (length and id, length, hash), each folded before its shuffle.  They and
  the narrow rows are written tables, so the join back is a plain sort-merge
  join of two scans, whose hot keys adaptive execution splits.

A null text is an empty text; empty texts are equal to each other.  Rows that
repeat an id and a text are rows of one group, and exactly one is kept.  An
empty table gives no rows.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar.llm.tables import texts, written

#: ``[\x20\x09-\x0D]``
WHITESPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """``text`` without white space (null: empty)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def half_of_sha256(norm: Column) -> Column:
    """16 bytes: the first half of the SHA-256 of ``norm`` in UTF-8."""
    return F.unhex(F.substring(F.sha2(norm, 256), 1, 32))


def _shared_hashes(rows: DataFrame) -> DataFrame:
    """Hashes that stand for two or more different texts (bytes compared)."""
    distinct = rows.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("copies"))
    return written(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h"),
                   "shared-hashes")


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          content_hash: Callable[[Column], Column] = half_of_sha256) -> DataFrame:
    """id, keep_id, group_size, kept, sha (32 bytes) for every row of ``docs``."""
    rows = texts(docs, id_column, text_column).select(
        "id", normalised(F.col("text")).alias("norm"), F.length(F.coalesce("text", F.lit(""))).alias("n")) \
        .withColumn("h", content_hash(F.col("norm")))
    shared = _shared_hashes(rows)
    if shared.isEmpty():
        rows = rows.withColumn("twin", F.lit(""))
    else:
        rows = rows.join(shared.withColumn("many", F.lit(True)), "h", "left") \
            .withColumn("twin", F.when(F.col("many"), F.col("norm")).otherwise(""))
    narrow = written(rows.select("h", "twin", "id", "n", F.unhex(F.sha2("norm", 256)).alias("sha"),
                                 F.monotonically_increasing_id().alias("row")), "exact-rows")
    by_id = narrow.groupBy("h", "twin", "n", "id").agg(F.count(F.lit(1)).alias("c"), F.min("row").alias("row"))
    by_length = by_id.groupBy("h", "twin", "n").agg(
        F.sum("c").alias("c"), F.min("id").alias("keep_id"),
        F.coalesce(F.min_by("row", "id"), F.min("row")).alias("keep_row"))
    groups = written(by_length.groupBy("h", "twin").agg(
        F.sum("c").alias("group_size"), F.max_by("keep_id", "n").alias("keep_id"),
        F.max_by("keep_row", "n").alias("keep_row")), "exact-groups")
    return narrow.join(groups, ["h", "twin"]).select(
        "id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "sha")


def kept(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of :func:`dedup` that stay."""
    return dedup(docs, id_column, text_column).where("kept")
