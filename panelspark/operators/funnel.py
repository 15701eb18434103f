"""Selection funnel: counts after each filter step (A2) and the (Diff) table.

``funnel`` stays lazy (a union of one-row tables) so it can be returned as a DataFrame. Steps
that one aggregation can count together share a part, so a pass over the data serves several steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.scalar import paren_thousands, thousands


def count_rows(df: DataFrame) -> DataFrame:
    """A one-row table with the number of rows of ``df``."""
    return df.agg(F.count(F.lit(1)).alias("obs"))


def funnel(parts: list[tuple[list[tuple[int, str]], DataFrame]]) -> DataFrame:
    """(step, description, obs) from parts ``([(step, description), ...], counts)``: ``counts`` is a
    one-row table whose columns hold the counts of the steps, in their order."""
    rows = []
    for steps, counts in parts:
        cells = [F.struct(F.lit(step).cast("int").alias("step"), F.lit(desc).alias("description"),
                          F.col(c).cast("long").alias("obs")) for (step, desc), c in zip(steps, counts.columns, strict=True)]
        rows.append(counts.select(F.inline(F.array(*cells))))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    # fresh attribute ids: the stages share lineage, so the union's names would be ambiguous
    return out.toDF("step", "description", "obs")


def funnel_table(sel: DataFrame) -> DataFrame:
    """Adds diff = previous obs - obs and the formatted "12,345" / "(1,234)" strings.

    The funnel has one row per step (a handful), so the ordered window is tiny.
    """
    w = Window.orderBy("step")
    out = sel.withColumn("diff", F.lag("obs").over(w) - F.col("obs"))
    return out.select("step", "description", "obs", "diff",
                      thousands("obs").alias("obs_text"), paren_thousands("diff").alias("diff_text"))
