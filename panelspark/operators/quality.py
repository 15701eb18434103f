"""Key quality: drop duplicate-key groups, keep the latest row per key, duplicate reports (Q1-Q6).

All of these are aggregations over the key with partial (map-side) aggregation, so a key
holding a third of all rows collapses to one partial row per task before the shuffle;
no window buffers a whole hot group and no row count ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def drop_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop every row of any key group with more than one row; NULL keys form one group (Q1).

    One aggregation: the count and the (single) row travel together, so a surviving
    group's row is read back from the aggregate without a second join.
    """
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_grp_n"),
                                *[F.first(c, ignorenulls=False).alias(c) for c in others])
    return agg.filter(F.col("_grp_n") == 1).select(*df.columns)


def successive_drop_counts(df: DataFrame, steps: list[list[str]]) -> DataFrame:
    """One row ``_c0 .. _ck``: the rows of ``df``, and those left after ``drop_duplicate_keys`` by the
    first, the first two, ... key lists of ``steps``.

    One chain of aggregations over the key columns alone. A dropped group travels on as a count
    under the all-NULL dead key, which collapses map-side, so no step is computed twice and neither
    a hot key nor the dropped rows gather in a task. An empty table counts 0 everywhere.
    """
    cols = list(dict.fromkeys(c for keys in steps for c in keys))
    state = df.select(F.lit(True).alias("_live"), *cols, F.lit(1).cast("long").alias("_c0"))
    for i, keys in enumerate(steps, 1):
        later = list(dict.fromkeys(c for ks in steps[i:] for c in ks if c not in keys))
        done = [f"_c{j}" for j in range(i)]
        groups = state.groupBy("_live", *keys).agg(
            *[F.sum(c).alias(c) for c in done], F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in later])
        alive = F.col("_live") & (F.col("_n") == 1)
        state = groups.select(alive.alias("_live"), *[F.when(alive, F.col(c)).alias(c) for c in [*keys, *later]],
                              *done, alive.cast("long").alias(f"_c{i}"))
    return state.agg(*[F.coalesce(F.sum(f"_c{j}"), F.lit(0).cast("long")).alias(f"_c{j}") for j in range(len(steps) + 1)])


def keep_latest(df: DataFrame, keys: list[str], latest: str, tiebreak: list[str] | None = None) -> DataFrame:
    """One row per key: the largest ``latest``, then the largest tie-breakers.

    ``max_by`` over a struct is an ordinary aggregate (partial + final), unlike a
    row_number window that must hold a whole key group in one task.
    NULLs order lowest, so a row with a NULL ``latest`` only wins when nothing else exists.
    """
    order = F.struct(*[F.col(c) for c in [latest, *(tiebreak or [])]])
    row = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
            .select(*[F.col(f"_row.{c}").alias(c) for c in df.columns]))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Group sizes of duplicated keys, largest first (Q4/Q5): keys..., n."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1).orderBy(F.col("n").desc(), *keys))


def group_sizes(df: DataFrame, keys: list[str], non_null: bool = True) -> DataFrame:
    """Rows per key, largest first, optionally only complete keys (Q5)."""
    if non_null:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *keys)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in key groups with more than one row, key columns first (Q3).

    A semi join on the duplicated keys (NULL-safe, so NULL keys group as in Q1);
    a hot key is split by AQE's skew-join handling rather than landing on one task.
    """
    dup_keys = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    left, right = df.alias("l"), dup_keys.alias("r")
    out = left.join(right, on=_null_safe_on(left, right, keys), how="left_semi")
    return out.select(*keys, *[c for c in df.columns if c not in keys])


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: duplicated groups, rows in them and extra rows (rows - groups) (Q3)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return sizes.agg(F.count(F.lit(1)).alias("groups"),
                     F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                     (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("extra"))


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct rows over selected columns (Q6)."""
    return df.select(*cols).distinct()


def encode_alphabetical(df: DataFrame, col: str, out: str) -> DataFrame:
    """Integer code 1..k of a string key in alphabetical order, e.g. for a fixed-effect id.

    The distinct keys are ranked with the distributed ``rank_rows`` (no single partition),
    then joined back on the key.
    """
    from panelspark.operators.quantiles import rank_rows

    keys = df.select(col).distinct().filter(F.col(col).isNotNull())
    codes = rank_rows(keys, [col], rank=out).select(col, F.col(out).cast("long").alias(out))
    return df.join(codes, on=col, how="left")


def top_groups(df: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The k largest key groups (O3): a top-k report, so the limit is the feature. Ties are
    broken by the keys; Spark plans it as TakeOrderedAndProject (per-task top k, then merge)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k))


def sort_all(df: DataFrame) -> DataFrame:
    """Sort by every column left to right (O2), a range-partitioned global sort."""
    return df.orderBy(*df.columns)
