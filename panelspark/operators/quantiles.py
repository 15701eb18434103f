"""Exact order-statistic quantiles (ST1) and ranks without a single partition (ST2).

Spark's exact ``percentile``/``percentile_disc`` keep a value->count map of the whole
group on one task, and a global ``row_number`` sorts everything on one partition; neither
survives 100 TB. Here, with one plan at every size:

* ``quantiles`` counts rows per (group, column, value) (ties collapse map-side), range
  partitions these cells, and sums the counts per partition. A running total over that small
  table (partitions x groups) tells which partition holds each target rank; only those
  partitions are sorted, and the target is read from their running counts. A group of any
  size is spread over the range partitions.
* ``rank_rows`` gives every row its 1-based position inside its group: range partition on
  (group, value, tie-breakers), sort inside partitions, number rows per partition, and add
  the counts of all earlier partitions (a table of partitions x groups).

Quantile rules (0-based sorted values v[0..n-1], h = (n-1)q):
lower v[floor h]; higher v[ceil h]; nearest v[round-half-away h]; linear v[f] + (h-f)(v[f+1]-v[f]);
midpoint (v[floor h] + v[ceil h]) / 2; type2 (R): m = nq, j = floor(m + 4 eps):
x_(j+1) if m > j else the mean of x_j and x_(j+1) (1-based, clamped to 1..n).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import reliable_checkpoint

RULES = ("lower", "higher", "nearest", "linear", "midpoint", "type2")
BROADCAST_STATE_ROWS = 100_000
_EPS4 = 4 * 2.220446049250313e-16


@dataclass(frozen=True)
class QSpec:
    col: str
    q: float
    rule: str
    out: str


def _positions(rule: str, n: str, q: float) -> tuple[str, str, str]:
    """(k_lo, k_hi, weight) as SQL over the group-size column ``n``; value = v[lo] + w (v[hi] - v[lo]).

    Built as SQL text so a whole target list costs one JVM call instead of one per node."""
    qd = f"CAST({q!r} AS DOUBLE)"
    nd = f"CAST({n} AS DOUBLE)"
    h = f"(({nd} - CAST(1 AS DOUBLE)) * {qd})"
    last = f"({n} - 1)"
    if rule == "lower":
        k = f"floor({h})"
        return k, k, "0.0D"
    if rule == "higher":
        k = f"ceil({h})"
        return k, k, "0.0D"
    if rule == "nearest":
        k = f"floor({h} + 0.5D)"
        return k, k, "0.0D"
    if rule == "linear":
        f = f"floor({h})"
        return f, f"least({f} + 1, {last})", f"({h} - {f})"
    if rule == "midpoint":
        f, c = f"floor({h})", f"ceil({h})"
        return f, c, f"(CASE WHEN {f} = {c} THEN 0.0D ELSE 0.5D END)"
    if rule == "type2":
        m = f"({nd} * {qd})"
        j = f"floor({m} + CAST({_EPS4!r} AS DOUBLE))"
        above = f"({m} > {j})"
        lo = f"least(greatest(CASE WHEN {above} THEN {j} ELSE {j} - 1 END, 0), {last})"
        hi = f"least(greatest({j}, 0), {last})"
        return lo, f"(CASE WHEN {above} THEN {lo} ELSE {hi} END)", f"(CASE WHEN {above} THEN 0.0D ELSE 0.5D END)"
    raise ValueError(f"unknown quantile rule {rule!r}; use one of {RULES}")


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def null_safe(left: list[str], right: list[str]) -> Column:
    """All pairs equal, NULL equal to NULL; true for no pairs."""
    return _and([F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)] or [F.lit(True)])


def value_cells(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """(by, _c column index, _v value, _cnt rows, _pid partition): distinct values range partitioned in
    order of (by, _c, _v). A NULL value has count 0, so a group without values stays visible.

    Which partition a value falls in depends on a sample, so the cells are checkpointed: every
    reader sees the same layout, also after a lost executor."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x"))
                                for i, c in enumerate(cols)])).alias("_p")
    cells = (df.select(*by, pairs).groupBy(*by, F.col("_p.c").alias("_c"), F.col("_p.x").alias("_v"))
             .agg(F.count("_p.x").alias("_cnt")))
    return reliable_checkpoint(cells.repartitionByRange(n, *by, "_c", "_v").withColumn("_pid", F.spark_partition_id()))


def cell_offsets(cells: DataFrame, by: list[str]) -> DataFrame:
    """(by, _c, _pid, _part, _off, _n): rows of a group in a partition, in all earlier ones, and in all.
    One row per (group, column) and partition it reaches."""
    w = Window.partitionBy(*by, "_c")
    before = w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return (cells.groupBy(*by, "_c", "_pid").agg(F.sum("_cnt").alias("_part"))
            .withColumn("_off", F.coalesce(F.sum("_part").over(before), F.lit(0)))
            .withColumn("_n", F.sum("_part").over(w)))


def quantiles(df: DataFrame, specs: list[QSpec], by: list[str] | None = None) -> DataFrame:
    """Exact quantiles: one row per group with one column per spec (``spec.out``).

    NULLs are ignored; a group with no non-NULL value gets NULL.
    """
    by = list(by or [])
    cols = sorted({s.col for s in specs})
    ci = {c: i for i, c in enumerate(cols)}
    cells = value_cells(df, cols, by)
    offsets = cell_offsets(cells, by)

    # targets: every (column, rank expression) a spec needs
    targets: list[tuple[int, str]] = []
    combos = []  # per spec: (tid_lo, tid_hi, weight, n)
    for s in specs:
        n = f"_n{ci[s.col]}"
        lo, hi, w = _positions(s.rule, n, s.q)
        t_lo = t_hi = len(targets)
        targets.append((ci[s.col], lo))
        if s.rule not in ("lower", "higher", "nearest"):
            t_hi = len(targets)
            targets.append((ci[s.col], hi))
        combos.append((t_lo, t_hi, w, n))

    sizes = offsets.groupBy(*by).agg(*[F.coalesce(F.max(F.when(F.col("_c") == i, F.col("_n"))), F.lit(0)).alias(f"_n{i}")
                                       for i in range(len(cols))])
    bt, bh, bw = ([f"_{x}{i}" for i in range(len(by))] for x in ("bt", "bh", "bw"))
    structs = ", ".join(f"named_struct('t', {t}, 'c', {c}, 'k', CAST({k} AS BIGINT))" for t, (c, k) in enumerate(targets))
    wanted = sizes.select(*[F.col(b).alias(x) for b, x in zip(by, bt)], F.explode(F.expr(f"array({structs})")).alias("_s"))
    # the partition that holds each target's rank; at most one row per group and target
    hits = offsets.join(wanted, null_safe(by, bt) & (F.col("_c") == F.col("_s.c")) & (F.col("_off") <= F.col("_s.k"))
                        & (F.col("_s.k") < F.col("_off") + F.col("_part")))
    hits = hits.groupBy(*[F.col(b).alias(x) for b, x in zip(by, bh)], F.col("_c").alias("_hc"), F.col("_pid").alias("_hp"),
                        F.col("_off").alias("_ho")).agg(F.collect_list("_s").alias("_ts"))
    run = (Window.partitionBy(*by, "_c", "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = (cells.join(hits, null_safe(by, bh) & (F.col("_c") == F.col("_hc")) & (F.col("_pid") == F.col("_hp")))
           .withColumn("_cum", F.col("_ho") + F.sum("_cnt").over(run)))
    found = cum.select(*[F.col(b).alias(x) for b, x in zip(by, bw)], "_v", F.explode(F.filter(
        "_ts", lambda s: (F.col("_cum") - F.col("_cnt") <= s["k"]) & (s["k"] < F.col("_cum")))).alias("_s"))
    wide = found.groupBy(*bw).agg(*[F.expr(f"max(CASE WHEN _s.t = {t} THEN _v END) AS _v{t}") for t in range(len(targets))])
    res = sizes.join(wide, null_safe(by, bw), how="left") if by else sizes.crossJoin(F.broadcast(wide))
    return _combine(res, specs, combos, by)


def _combine(res: DataFrame, specs: list[QSpec], combos, by: list[str]) -> DataFrame:
    outs = []
    for s, (t_lo, t_hi, w, n) in zip(specs, combos):
        vlo, vhi = f"_v{t_lo}", f"_v{t_hi}"
        if s.rule in ("midpoint", "type2"):
            val = f"CASE WHEN {w} = 0.0D THEN {vlo} ELSE ({vlo} + {vhi}) / 2.0D END"
        else:
            val = f"CASE WHEN {w} = 0.0D THEN {vlo} ELSE {vlo} + {w} * ({vhi} - {vlo}) END"
        outs.append(f"CASE WHEN {n} > 0 THEN {val} END AS `{s.out}`")
    return res.selectExpr(*[f"`{b}`" for b in by], *outs)


def quantile(df: DataFrame, col: str, q: float | list[float], rule: str = "linear",
             by: list[str] | None = None, prefix: str | None = None) -> DataFrame:
    qs = q if isinstance(q, list) else [q]
    prefix = prefix or col
    specs = [QSpec(col, x, rule, f"{prefix}_q{str(x).replace('.', '_')}") for x in qs]
    return quantiles(df, specs, by)


def rank_rows(df: DataFrame, order: list[str], by: list[str] | None = None, n_parts: int | None = None,
              rank: str = "_rank", size: str = "_n") -> DataFrame:
    """Attach each row's 1-based position inside its ``by`` group ordered by ``order`` (ST2).

    ``order`` should make rows unique (add tie-breakers); otherwise tied rows get distinct
    but arbitrary positions. NULLs in the first order column sort first; filter them out
    beforehand when they should not be ranked.
    """
    by = list(by or [])
    spark = df.sparkSession
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, *order]
    ordered = (df.repartitionByRange(n_parts, *[F.col(k).asc_nulls_first() for k in keys])
               .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
               .withColumn("_mid", F.monotonically_increasing_id()))
    # numbering depends on the partition layout: pin it once so both uses see the same rows
    ordered = reliable_checkpoint(ordered)
    ordered = ordered.withColumns({"_pid": F.shiftright("_mid", 33),
                                   "_loc": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = ordered.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_loc").alias("_first"))
    wg = (Window.partitionBy(*by) if by else Window).orderBy("_pid")
    whole = wg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        "_pid", *by, "_first",
        F.coalesce(F.sum("_cnt").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(whole).alias(size))
    # partitions x groups-per-partition: at most n_parts + n_groups rows
    n_off = offsets.count()
    off = F.broadcast(offsets) if n_off <= BROADCAST_STATE_ROWS else offsets
    out = ordered.join(off, on=["_pid", *by], how="inner")
    return out.withColumn(rank, (F.col("_off") + F.col("_loc") - F.col("_first") + 1).cast("long")).drop(
        "_mid", "_pid", "_loc", "_first", "_off")
