"""Top-k per group with a fixed tie order.

``row_number`` over (views desc, item asc nulls last) filtered to <= k is
planned by Catalyst as a partial ``WindowGroupLimit`` before the shuffle,
so each map task ships at most k rows per group: a group with millions of
items never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(weight: str, item: str):
    return [F.col(weight).desc(), F.col(item).asc_nulls_last()]


def top_n(df: DataFrame, keys: Sequence[str], item: str, n: int,
          weight: str = "total_views", rank_col: str = "row_num") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order(weight, item))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def ranked_with_ties(df: DataFrame, keys: Sequence[str], item: str, n: int,
                     weight: str = "total_views") -> DataFrame:
    """Top n rows with both ``rank`` (views only: ties share) and ``row_num``.

    The limit comes first (a partial ``WindowGroupLimit``): a kept row's rank
    depends only on rows with more views, which are kept too, so ``rank`` is
    computed on at most n rows per group.
    """
    by_views = Window.partitionBy(*keys).orderBy(F.col(weight).desc())
    return top_n(df, keys, item, n, weight).withColumn("rank", F.rank().over(by_views))


def mode_of(df: DataFrame, keys: Sequence[str], item: str, out: str | None = None,
            weight: str = "total_views") -> DataFrame:
    """The item with most views per group (first by item on ties)."""
    best = top_n(df, keys, item, 1, weight).select(*keys, item)
    return best.withColumnRenamed(item, out) if out else best


def top_list(df: DataFrame, keys: Sequence[str], item: str, n: int, out: str,
             weight: str = "total_views", sep: str = ", ") -> DataFrame:
    """Top n items per group joined to one text, best first."""
    ranked = top_n(df, keys, item, n, weight)
    pairs = F.array_sort(F.collect_list(F.struct("row_num", item)))
    return ranked.groupBy(*keys).agg(
        F.array_join(F.transform(pairs, lambda p: p[item]), sep).alias(out))


def summary_with_leaders(df: DataFrame, keys: Sequence[str], aggs: Sequence,
                         leaders: Sequence[tuple[str, int, str]],
                         weight: str = "total_views", sep: str = ", ") -> DataFrame:
    """Per group of ``keys``: ``aggs`` plus the leading items of each leader column.

    ``leaders`` holds (item, n, out): with n = 1, ``out`` is the item with most
    ``weight`` (the mode); with n > 1 it is the top n items joined by ``sep``,
    best first.  Ties go to the smaller item, nulls last.  ``aggs`` must
    produce ``weight``.

    One linear flow, however many leaders: a GROUPING SETS aggregate makes
    the group rows and the (group, item) rows in one pass over ``df`` (one
    shuffle, partial aggregation first), a row_number window filtered to
    the largest n ranks the items (planned as a partial ``WindowGroupLimit``,
    so a group with millions of items ships at most n rows per map task),
    and a last aggregate folds the at most 1 + sum(n) rows per group into
    one.  Unlike one aggregate per output joined back, ``df`` is read once.

    A group with a null key gets null leaders: the original assembled these
    tables with equality joins, which never match a null key.
    """
    keys = list(keys)
    items = [item for item, _, _ in leaders]
    sets = [keys] + [[*keys, item] for item in items]
    kind = F.lit(0)
    for i, item in reversed(list(enumerate(items, start=1))):
        kind = F.when(F.grouping(item) == 0, F.lit(i)).otherwise(kind)
    value = None
    for i, item in enumerate(items, start=1):
        value = (F.when(F.col("_kind") == i, F.col(item)) if value is None
                 else value.when(F.col("_kind") == i, F.col(item)))
    rows = df.groupingSets(sets, *keys, *items).agg(*aggs, kind.alias("_kind"))
    rows = rows.withColumn("_item", value if value is not None else F.lit(None))
    w = Window.partitionBy(*keys, "_kind").orderBy(*_order(weight, "_item"))
    top = max([n for _, n, _ in leaders], default=1)
    ranked = rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= top)

    out_names = [f.name for f in rows.schema.fields
                 if f.name not in (*keys, *items, "_kind", "_item")]
    is_group = F.col("_kind") == 0
    folded = [F.max(F.when(is_group, F.col(c))).alias(c) for c in out_names]
    all_keys = F.lit(True)
    for k in keys:
        all_keys = all_keys & F.col(k).isNotNull()
    for i, (item, n, out) in enumerate(leaders, start=1):
        mine = (F.col("_kind") == i) & (F.col("_rn") <= n)
        if n == 1:
            folded.append(F.max(F.when(mine, F.col("_item"))).alias(out))
        else:
            pairs = F.array_sort(F.collect_list(F.when(mine, F.struct("_rn", "_item"))))
            folded.append(F.array_join(F.transform(pairs, lambda p: p["_item"]), sep).alias(out))
    result = ranked.groupBy(*keys).agg(*folded)
    return result.withColumns({out: F.when(all_keys, F.col(out)) for _, _, out in leaders})
