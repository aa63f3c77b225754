"""Data-quality operators: timestamp normalising, null handling, dedup.

Every profile is one aggregate pass (one job) over the table, not one or
two jobs per column.  Dedup is an aggregate, so a key holding a third of
all rows is folded map-side instead of landing whole in one task.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewstar import schemas
from viewstar.functions.booleans import flag_to_boolean, text_to_boolean
from viewstar.functions.timestamps import TIMESTAMP_FORMATS, parse_timestamp


# -- C1 / C3 ------------------------------------------------------------------
def normalise_timestamps(df: DataFrame, columns: Iterable[str],
                         formats=TIMESTAMP_FORMATS, keep_fraction: bool = False) -> DataFrame:
    """Replace each column by its parsed TIMESTAMP_NTZ value (null if no layout fits).

    A column that is already a timestamp is matched on its text form, so a
    value with a fraction of a second fails every guard and becomes null --
    the original job's behaviour.  ``keep_fraction=True`` truncates to whole
    seconds first instead.
    """
    types = dict(df.dtypes)
    out = {}
    for name in columns:
        c = F.col(name)
        if types[name] in ("timestamp", "timestamp_ntz"):
            if keep_fraction:
                c = F.date_trunc("second", c)
            c = c.cast("string")
        out[name] = parse_timestamp(c, formats)
    return df.withColumns(out)


# -- C2 / C4 / C5 / C11 -------------------------------------------------------
def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``total_rows`` and, per column, its number of nulls."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def invalid_timestamp_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row, per time column ``invalid_<col>``: values left null by parsing."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"invalid_{c}") for c in columns])


def any_null(df: DataFrame) -> DataFrame:
    """One row, ``has_nulls``: does any cell of the table hold a null?"""
    cond = F.lit(False)
    for c in df.columns:
        cond = cond | F.col(c).isNull()
    return df.agg(F.coalesce(F.max(cond), F.lit(False)).alias("has_nulls"))


def all_null_columns(df: DataFrame, probe_rows: int = 1000) -> list[str]:
    """Columns null in every row; empty tables have none.

    Exact, and in the usual case without a pass over the table: the first
    ``probe_rows`` rows (an incremental take, which reads the first splits
    only) settle every column that shows a value there.  Only columns still
    without a value are counted over the whole table, in one aggregate that
    reads just those columns.  The driver sees at most ``probe_rows`` rows of
    booleans and then one row.
    """
    cols = df.columns
    if not cols:
        return []
    probe = df.select(*[F.col(f"`{c}`").isNotNull().alias(f"_{i}") for i, c in enumerate(cols)])
    rows = probe.head(probe_rows)
    if not rows:
        return []
    open_cols = [c for i, c in enumerate(cols) if not any(r[i] for r in rows)]
    if not open_cols or len(rows) < probe_rows:
        return open_cols
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(open_cols)]).first()
    return [c for i, c in enumerate(open_cols) if row[i] == 0]


# -- C6 -------------------------------------------------------------------------
def drop_all_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``: columns that stay in any case (a key is filled, never dropped)."""
    dead = [c for c in all_null_columns(df) if c not in keep]
    return df.drop(*dead) if dead else df


# -- C7 -------------------------------------------------------------------------
def fill_value(data_type: T.DataType) -> Column | None:
    """The typed fill literal for a column type; None leaves the column alone."""
    if isinstance(data_type, T.StringType):
        return F.lit(schemas.FILL_STRING)
    # Typed SQL literals, not casts of text: they are non-nullable when the
    # plan is analysed, so joins on derived time parts infer no null checks
    # (which Catalyst would push down with the whole parse inlined).
    if isinstance(data_type, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{schemas.FILL_TIMESTAMP}'")
    if isinstance(data_type, T.TimestampType):
        return F.expr(f"TIMESTAMP_LTZ '{schemas.FILL_TIMESTAMP}'")
    if isinstance(data_type, T.DateType):
        return F.expr(f"DATE '{schemas.FILL_DATE}'")
    if isinstance(data_type, T.NumericType):
        return F.lit(schemas.FILL_NUMBER).cast(data_type)
    # Booleans keep their nulls; binary and nested types cannot take a text
    # fill, so they are left as they are.
    return None


def fill_nulls(df: DataFrame) -> DataFrame:
    """Typed null fill; types are kept (a filled timestamp stays a timestamp)."""
    out = {}
    for field in df.schema.fields:
        value = fill_value(field.dataType)
        if value is not None:
            out[field.name] = F.coalesce(F.col(field.name), value)
    return df.withColumns(out) if out else df


def handle_nulls(df: DataFrame, drop_all_null: bool = True, keep: Sequence[str] = (),
                 watch: Watch | None = None) -> DataFrame:
    """C4-C7 in order: drop columns with no value (but those in ``keep``), then fill the rest by type.

    ``watch`` sees the rows after the all-null test's own reads and before the fill."""
    dead = [c for c in all_null_columns(df) if c not in keep] if drop_all_null else []
    if watch:
        df = watch.on_read(df)
    return fill_nulls(df.drop(*dead) if dead else df)


# -- C8 / A12 -------------------------------------------------------------------
def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``total_rows``, ``distinct_keys``, ``duplicate_rows``, ``has_duplicates``.

    Null keys count as one key, as in ``select(keys).distinct()``.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
    ).withColumns({
        "duplicate_rows": F.col("total_rows") - F.col("distinct_keys"),
        "has_duplicates": F.col("total_rows") > F.col("distinct_keys"),
    })


# -- one run's report (C2, C4, C5, C8) --------------------------------------------
def quality_report(df: DataFrame, table: str, keys: Sequence[str], time_columns: Sequence[str] = (),
                   dt: str | None = None) -> DataFrame:
    """A row per column of ``table``: rows, nulls, invalid times and duplicate rows, in one aggregate.

    ``df`` holds parsed but unfilled columns, so a null of a time column is an
    invalid time.  Duplicates are rows beyond the first of their key, keys
    being compared as they will be once nulls are filled.  The fold per key
    is partial before its shuffle; what follows is one row per key.
    """
    keyed = df.select(*[F.col(c).isNull().cast("long").alias(c) for c in df.columns],
                      *[c.alias(f"_key_{k}") for k, c in zip(keys, _fills(df, keys))])
    per_key = keyed.groupBy(*[f"_key_{k}" for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in df.columns])
    totals = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
                         (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("_duplicates"),
                         *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in df.columns])
    each = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(c).alias("nulls"),
        (F.col(c) if c in time_columns else F.lit(0).cast("long")).alias("invalid")) for c in df.columns]))
    return totals.select("_rows", "_duplicates", each.alias("e")).select(
        F.lit(dt).cast("date").alias("dt"), F.lit(table).alias("table"), "e.column", F.col("_rows").alias("rows"),
        "e.nulls", "e.invalid", F.col("_duplicates").alias("duplicates"))


class Watch:
    """Quality counts of one table, taken while its clean form is written: no second pass over the raw rows.

    Rows and nulls are observed where the parsed rows are read.  That is
    before the fold's shuffle, where a task run again after a lost executor
    counts its rows again; so the fold carries each key's number of rows, and
    they are summed in the write's own tasks, which Spark counts once each.
    If the two row counts differ, the first ones are not used and
    :meth:`report` gives None: count with :func:`quality_report` then.
    """

    COPIES = "_copies"

    def __init__(self, table: str, time_columns: Sequence[str] = ()):
        self.table, self.time_columns, self.columns = table, tuple(time_columns), []
        self.read, self.folded = Observation(), Observation()

    def on_read(self, df: DataFrame) -> DataFrame:
        """``df``: parsed, unfilled rows (an action on them before the write would use the observation up)."""
        self.columns = df.columns
        return df.observe(self.read, F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{k}") for k, c in enumerate(self.columns)])

    def on_folded(self, df: DataFrame) -> DataFrame:
        """``df``: one row per key, with the number of its rows in ``COPIES``, which goes here."""
        return df.observe(self.folded, F.coalesce(F.sum(self.COPIES), F.lit(0)).alias("rows"),
                          F.count(F.lit(1)).alias("keys")).drop(self.COPIES)

    def report(self, dt: str | None = None) -> list[tuple] | None:
        """Rows of REPORT_DDL once the write is done; None if tasks ran twice."""
        read, folded = self.read.get, self.folded.get
        if read["rows"] != folded["rows"]:
            return None
        day = None if dt is None else datetime.date.fromisoformat(dt)
        return [(day, self.table, c, read["rows"], read[f"nulls_{k}"], read[f"nulls_{k}"] if c in self.time_columns else 0,
                 folded["rows"] - folded["keys"]) for k, c in enumerate(self.columns)]


REPORT_DDL = "dt DATE, table STRING, column STRING, rows LONG, nulls LONG, invalid LONG, duplicates LONG"


def _fills(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    out = []
    for c in columns:
        value = fill_value(df.schema[c].dataType)
        out.append(F.col(c) if value is None else F.coalesce(F.col(c), value))
    return out


# -- C9 -------------------------------------------------------------------------
def dedup(df: DataFrame, keys: Sequence[str], copies: str | None = None) -> DataFrame:
    """One row per key: the first by the other columns, ascending, nulls last.

    The original keeps an arbitrary row; this keeps a fixed one, so reruns
    agree.  Built as ``min(struct)`` per key, which Spark aggregates
    partially before the shuffle: a hot key is folded map-side.  ``copies``
    names a column for the number of rows the key had.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest and not copies:
        return df.dropDuplicates(keys)
    order = []
    for c in rest:
        order += [F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(c)]
    aggs = [F.min(F.struct(*order)).alias("_first")] if rest else []
    first = df.groupBy(*keys).agg(*aggs, *([F.count(F.lit(1)).alias(copies)] if copies else []))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest], *([copies] if copies else [])) \
        .select(*df.columns, *([copies] if copies else []))


def _folded(df: DataFrame, keys: Sequence[str], watch: Watch | None) -> DataFrame:
    return watch.on_folded(dedup(df, keys, Watch.COPIES)) if watch else dedup(df, keys)


# -- C10 / C12 ------------------------------------------------------------------
def to_boolean(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    types = dict(df.dtypes)
    out = {}
    for c in columns:
        out[c] = text_to_boolean(F.col(c)) if types[c] == "string" else flag_to_boolean(F.col(c))
    return df.withColumns(out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float/double columns -> null."""
    out = {f.name: F.when(~F.isnan(f.name), F.col(f.name))
           for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.withColumns(out) if out else df


# -- The three cleaning chains (C1 -> C10 -> C6/C7 -> C9) -----------------------
#: Time columns of the listing table.
LISTING_TIMES = ("listing_created_on", "last_modified_timestamp")


def clean_viewings(raw: DataFrame, keys: Sequence[str] = schemas.VIEWING_KEY,
                   drop_all_null: bool = True, drop_sentinel: bool = False, watch: Watch | None = None) -> DataFrame:
    df = normalise_timestamps(raw, ["viewed_at"])
    df = to_boolean(df, ["is_wishlisted"])
    df = handle_nulls(df, drop_all_null, (*keys, "viewed_at"), watch)
    df = _folded(df, keys, watch)
    if drop_sentinel and "viewed_at" in df.columns:
        df = df.filter(F.col("viewed_at") != F.expr(f"TIMESTAMP_NTZ '{schemas.FILL_TIMESTAMP}'"))
    return df


def clean_apartments(raw: DataFrame, drop_all_null: bool = True,
                     keep_fraction: bool = False, watch: Watch | None = None) -> DataFrame:
    df = normalise_timestamps(raw, LISTING_TIMES, keep_fraction=keep_fraction)
    df = to_boolean(df, ["is_active"])
    df = handle_nulls(df, drop_all_null, schemas.LISTING_KEY, watch)
    return _folded(df, schemas.LISTING_KEY, watch)


def clean_attributes(raw: DataFrame, drop_all_null: bool = True, watch: Watch | None = None) -> DataFrame:
    df = handle_nulls(raw, drop_all_null, schemas.LISTING_KEY, watch)
    return _folded(df, schemas.LISTING_KEY, watch)
