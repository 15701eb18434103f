"""Validity-range joins (SCD-2 style links): J1, J2, J2b.

The join is an equi join on the entity key with the date range as a residual
condition, or (``bucket_days``) on the key and bins of several resolutions, so Spark plans it as a
hash or sort-merge join (never a nested loop). A link table is usually small; Catalyst broadcasts it when its statistics are
under the broadcast threshold, and AQE re-plans from runtime sizes and splits a skewed
entity on the panel side.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAR_FUTURE = _dt.date(2099, 12, 31)


def range_join(left: DataFrame, right: DataFrame, keys: list[str] | dict[str, str], date: str,
               start: str, end: str, how: str = "inner", open_end: _dt.date | None = FAR_FUTURE,
               null_start_matches: bool = False, unmatched: str = "keep",
               right_cols: list[str] | None = None, bucket_days: int | None = None) -> DataFrame:
    """Join ``left`` rows to ``right`` ranges with ``start <= left.date <= end`` on equal keys.

    - ``open_end``: a NULL ``end`` is read as this date (J1: 2099-12-31); ``None`` keeps
      NULL ends unmatched.
    - ``null_start_matches``: a NULL ``start`` matches any date (J2).
    - ``how="left"`` keeps unmatched rows with NULLs; ``unmatched="drop"`` instead joins on
      the key and then filters, so a key present but out of range is dropped (J2b, R).
    - several matching ranges fan out (kept, as in the reference).
    - ``bucket_days``: when keys carry many ranges, or one key many rows. The distinct (keys, date)
      of the left side, a narrow table that collapses before it is shuffled, look up the ranges by
      (keys, level, bin) with the exact range as residual; a range of any length is in at most two
      bins (``range_bins``), so open ends cost no more than short ones. Their hits join the left
      rows on (keys, date), which spreads a hot key over its dates. Rows equal the plain join's.
    """
    pairs = keys.items() if isinstance(keys, dict) else [(k, k) for k in keys]
    r_keep = right_cols if right_cols is not None else [c for c in right.columns
                                                        if c not in {rk for _, rk in pairs}]
    r = right.select(*[F.col(rk).alias(f"_rk{i}") for i, (_, rk) in enumerate(pairs)],
                     F.col(start).alias("_rstart"), F.col(end).alias("_rend"), *r_keep)
    key = _keys_equal(left, r, pairs)
    on = key & _in_range(left[date], r["_rstart"], r["_rend"], open_end, null_start_matches)

    helpers = [*[f"_rk{i}" for i in range(len(pairs))], "_rstart", "_rend"]

    def matched(how: str) -> DataFrame:
        if bucket_days is not None:
            return _binned(left, r, pairs, date, how, open_end, null_start_matches, bucket_days)
        return left.join(r, on=on, how=how).drop(*helpers)

    if how == "left" and unmatched == "drop":
        # rows in range, and rows whose key has no range at all: no (row, range) pair of a key is
        # emitted only to be filtered
        present = r.select(*[f"_rk{i}" for i in range(len(pairs))]).distinct()
        alone = left.join(present, _keys_equal(left, present, pairs), "left_anti")
        return matched("inner").unionByName(alone, allowMissingColumns=True)
    return matched(how)


def _keys_equal(left: DataFrame, r: DataFrame, pairs) -> Column:
    cond = F.lit(True)
    for i, (lk, _) in enumerate(pairs):
        cond = cond & (left[lk] == r[f"_rk{i}"])
    return cond


def _in_range(d: Column, start: Column, end: Column, open_end, null_start_matches: bool) -> Column:
    end = F.coalesce(end, F.lit(open_end)) if open_end is not None else end
    inside = (d >= start) & (d <= end)
    return start.isNull() | inside if null_start_matches else inside


_EPOCH = _dt.date(1970, 1, 1)
_ANY_DAY = -1  # level of the ranges without a start, which hold on every day and on no day


def _bucket(c, days: int):
    return F.floor(F.datediff(c, F.lit(_EPOCH)) / days).cast("long")


def range_bins(r: DataFrame, days: int, open_end, null_start_matches: bool) -> DataFrame:
    """``r`` (with _rstart, _rend) once per bin of its range, as _level and _bin: at level l a bin is
    2^l buckets of ``days`` days. A range takes the first level at which a bin is as long as itself,
    so it lies in one or two bins however long it is, and no bin is over twice as long as its ranges
    (or one bucket)."""
    end = F.coalesce(F.col("_rend"), F.lit(open_end)) if open_end is not None else F.col("_rend")
    r = r.withColumns({"_b0": _bucket(F.col("_rstart"), days), "_b1": _bucket(end, days)})
    # number of binary digits of last - first: 2^level is at least the number of buckets
    r = r.withColumn("_level", F.when(F.col("_b1") > F.col("_b0"), F.length(F.bin(F.col("_b1") - F.col("_b0")))).otherwise(0))
    none = F.array().cast("array<struct<l:int,b:bigint>>")
    anywhere = F.array(F.struct(F.lit(_ANY_DAY).alias("l"), F.lit(0).cast("long").alias("b"))) if null_start_matches else none
    own = F.expr("array_distinct(array(named_struct('l', _level, 'b', shiftright(_b0, _level)),"
                 " named_struct('l', _level, 'b', shiftright(_b1, _level))))")
    bins = F.when(F.col("_rstart").isNull(), anywhere).when(end >= F.col("_rstart"), own).otherwise(none)
    return r.withColumn("_x", F.explode(bins)).withColumns({"_level": F.col("_x.l"), "_bin": F.col("_x.b")}).drop("_x", "_b0", "_b1")


def _binned(left: DataFrame, r: DataFrame, pairs, date: str, how: str, open_end, null_start_matches: bool, days: int) -> DataFrame:
    n = len(pairs)
    rb = range_bins(r, days, open_end, null_start_matches)
    levels = rb.agg(F.collect_set("_level").alias("_levels"))  # a single row of at most some twenty numbers
    points = left.select(*[F.col(lk).alias(f"_pk{i}") for i, (lk, _) in enumerate(pairs)], F.col(date).alias("_pd")).distinct()
    points = points.crossJoin(F.broadcast(levels)).withColumn("_pl", F.explode("_levels")).drop("_levels")
    place = F.when(F.col("_pl") == _ANY_DAY, F.lit(0).cast("long")).otherwise(F.expr("shiftright(_pb, greatest(_pl, 0))"))
    points = points.withColumn("_pb", _bucket(F.col("_pd"), days)).withColumn("_pb", place)
    keys = F.lit(True)
    for i in range(n):
        keys = keys & (points[f"_pk{i}"] == rb[f"_rk{i}"])
    hits = points.join(rb, keys & (points["_pl"] == rb["_level"]) & (points["_pb"] == rb["_bin"])
                       & _in_range(points["_pd"], rb["_rstart"], rb["_rend"], open_end, null_start_matches))
    hits = hits.drop(*[f"_rk{i}" for i in range(n)], "_rstart", "_rend", "_level", "_bin", "_pl", "_pb")
    on = left[date].eqNullSafe(hits["_pd"])
    for i, (lk, _) in enumerate(pairs):
        on = on & (left[lk] == hits[f"_pk{i}"])
    return left.join(hits, on, how).drop(*[f"_pk{i}" for i in range(n)], "_pd")
