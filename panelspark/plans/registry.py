"""Registered queries: name -> (spark builder, DuckDB SQL, float columns to round).

Every builder reads the driver tables at ``sf_dir`` (through the role bindings) and
returns a lazy DataFrame. Floating outputs are rounded to ``DIGITS`` decimals on both
sides: sums and products are order-sensitive in their last bits. Columns named in ``sig`` (standard errors and
other small outputs) keep ``DIGITS`` significant digits instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.plans import bindings as B
from panelspark.plans.oracle import with_bindings

DIGITS = 6
NUDGE = 1.0 + 1e-12


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    floats: list[str] = field(default_factory=list)
    sig: list[str] = field(default_factory=list)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.floats:
            # x * (1 + 1e-12) moves values that sit exactly on a rounding half (means of
            # 2-decimal data) off the boundary by more than any summation-order noise, so
            # both engines round them alike; "+ 0.0" folds -0.0 into 0.0
            df = df.withColumns({c: F.round(F.col(c) * F.lit(NUDGE), DIGITS) + F.lit(0.0) for c in self.floats})
        for c in self.sig:
            scale = F.pow(F.lit(10.0), F.lit(DIGITS - 1.0) - F.floor(F.log10(F.abs(F.col(c)))))
            df = df.withColumn(c, F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.round(F.col(c) * scale * F.lit(NUDGE)) / scale))
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = with_bindings(self.sql)
        if not self.floats and not self.sig:
            return body
        repl = [f"round({c} * CAST({NUDGE!r} AS DOUBLE), {DIGITS}) + 0.0 AS {c}" for c in self.floats]
        for c in self.sig:
            scale = f"power(10.0::DOUBLE, {DIGITS - 1.0} - floor(log10(abs({c}))))"
            repl.append(f"CASE WHEN {c} = 0 THEN 0.0::DOUBLE ELSE round({c} * {scale} * CAST({NUDGE!r} AS DOUBLE)) / {scale} END AS {c}")
        repl = ", ".join(repl)
        return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) q"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, floats: list[str] | None = None, sig: list[str] | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql, list(floats or []), list(sig or []))
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the query modules fills REGISTRY
    from panelspark.plans import queries_event, queries_io, queries_panel, queries_reports, queries_stats  # noqa: F401
    return REGISTRY
