"""Batch jobs in the shape of the reference workflow: transform -> figures -> tables -> provenance.

Each job reads its inputs as DataFrames (or Parquet folders), runs the operators and
writes Parquet (and CSV where a person reads the file). Inputs are addressed by role, so
any source with the needed columns works:

    panel_raw      gvkey, datadate, fyearq, fqtr, rdq, saleq, ibq, cshoq, prccq
    links          gvkey, lpermno, linktype, linkprim, linkdt, linkenddt
    name_history   permno, namedt, nameenddt, siccd
    daily_returns  permno, dlycaldt, dlyret
    market_index   dlycaldt, dlytotret
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import regression as R
from panelspark.operators import tables as T
from panelspark.operators.funnel import funnel_table
from panelspark.operators.transforms import standardize
from panelspark.plans import pipeline as P
from panelspark.sources.extract import write_csv, write_parquet
from panelspark.sources.inventory import file_inventory

ROLES = ("panel_raw", "links", "name_history", "daily_returns", "market_index")
DESCRIPTIVE_VARS = ["bhar", "sue", "same_sign", "loss", "log_mve"]
MODELS = {
    "Base": dict(terms=["sue"]),
    "Interaction": dict(terms=["sue*same_sign"]),
    "Year FE": dict(terms=["sue*same_sign"], absorb=["fyearq"]),
    "Two-Way FE": dict(terms=["sue*same_sign"], absorb=["fyearq", "ff12num"]),
    "Controls": dict(terms=["sue*same_sign", "sue*log_mve_std", "sue*loss"], absorb=["fyearq", "ff12num"]),
}
SHOWN_TERMS = ["sue", "same_sign", "sue:same_sign"]


def model_markers(models: dict[str, dict]) -> dict[str, list[str]]:
    """Rows under a regression table: one per absorbed column or further regressor, with a mark in the
    models that have it."""
    def parts(spec: dict) -> set[str]:
        return {v for t in spec["terms"] for v in t.split("*")}

    fes = dict.fromkeys(c for m in models.values() for c in m.get("absorb", []))
    shown = {v for t in SHOWN_TERMS for v in t.split(":")}
    more = dict.fromkeys(v for m in models.values() for v in sorted(parts(m) - shown))
    return {f"absorbs {c}": ["x" if c in m.get("absorb", []) else "" for m in models.values()] for c in fes} | \
        {f"includes {v}": ["x" if v in parts(m) else "" for m in models.values()] for v in more}


def _load(spark: SparkSession, src: DataFrame | str) -> DataFrame:
    return src if isinstance(src, DataFrame) else spark.read.parquet(src)


def transform(spark: SparkSession, inputs: dict[str, DataFrame | str], data_dir: str, max_year: int = 2024) -> dict:
    """Writes regdata, figure_data, trading_dates and sample_selection under ``data_dir``."""
    raw = {r: _load(spark, inputs[r]) for r in ROLES}
    st = P.build(raw["panel_raw"], raw["links"], raw["name_history"], raw["daily_returns"],
                 raw["market_index"], max_year=max_year)
    write_parquet(st.regdata, f"{data_dir}/regdata.parquet")
    write_parquet(st.figure_data, f"{data_dir}/figure_data.parquet")
    write_parquet(st.calendar, f"{data_dir}/trading_dates.parquet")
    write_parquet(st.funnel(), f"{data_dir}/sample_selection.parquet")
    return {"regdata_rows": spark.read.parquet(f"{data_dir}/regdata.parquet").count()}


def figures(spark: SparkSession, data_dir: str, out_dir: str) -> None:
    """The data behind the five figures."""
    reg = spark.read.parquet(f"{data_dir}/regdata.parquet")
    fig = spark.read.parquet(f"{data_dir}/figure_data.parquet")
    write_parquet(T.flag_rate_by_industry(reg), f"{out_dir}/fig_industry.parquet")
    write_parquet(T.flag_rate_year_size(reg), f"{out_dir}/fig_year_size.parquet")
    write_parquet(T.pearson_matrix(reg, DESCRIPTIVE_VARS), f"{out_dir}/fig_corr.parquet")
    groups = reg.select("permno", "rdq", F.when(F.col("sue") != 0, F.signum("sue").cast("int")).alias("sue_sign"),
                        "same_sign")
    write_parquet(T.car_summary(fig, groups, ["permno", "rdq"], "sue_sign", "same_sign"),
                  f"{out_dir}/fig_car.parquet")
    write_parquet(R.group_slopes(reg, "bhar", "sue", ["fyearq", "same_sign"]), f"{out_dir}/fig_erc.parquet")


def tables(spark: SparkSession, data_dir: str, out_dir: str, cluster: tuple[str, str] = ("permno", "fyearq"),
           labels: dict[str, str] | None = None) -> None:
    """Selection table, frequency by decade, descriptives, correlations, regressions.
    ``labels`` names the variables in the tables (default: their column names)."""
    reg = spark.read.parquet(f"{data_dir}/regdata.parquet")
    write_csv(funnel_table(spark.read.parquet(f"{data_dir}/sample_selection.parquet")), f"{out_dir}/selection")
    write_csv(T.freq_by_decade(reg, "fyearq", "same_sign"), f"{out_dir}/freq_decade")
    write_csv(T.descriptives(reg, DESCRIPTIVE_VARS, labels), f"{out_dir}/descriptives")
    write_csv(T.pearson_spearman(reg, DESCRIPTIVE_VARS, ["permno", "rdq"], labels), f"{out_dir}/correlations")
    data = standardize(reg, "log_mve", suffix="_std").persist()
    try:
        fits = R.ols_models(data, "bhar", MODELS, cluster=list(cluster))
    finally:
        data.unpersist()
    table = R.regression_table(spark, fits, SHOWN_TERMS, markers=model_markers(MODELS))
    write_csv(table, f"{out_dir}/regression_long")
    write_csv(R.fit_table(spark, fits), f"{out_dir}/regression_fit")


def provenance(spark: SparkSession, data_dir: str, inventory_dirs: list[str] | None = None) -> DataFrame:
    """Sorted sample identifiers (Parquet + CSV), the inventory of all files but Spark's own markers in
    ``inventory_dirs`` (Parquet), and a summary of both."""
    reg = spark.read.parquet(f"{data_dir}/regdata.parquet")
    ids = T.sample_identifiers(reg)
    write_parquet(ids, f"{data_dir}/sample_identifiers.parquet")
    write_csv(ids, f"{data_dir}/sample_identifiers_csv")
    inv = None
    for d in inventory_dirs or [data_dir]:
        part = file_inventory(spark, d).where("NOT marker").drop("marker").withColumn("directory", F.lit(os.path.basename(d.rstrip("/"))))
        inv = part if inv is None else inv.unionByName(part)
    write_parquet(inv, f"{data_dir}/file_inventory.parquet")
    inv = spark.read.parquet(f"{data_dir}/file_inventory.parquet")
    return T.identifier_summary(reg).crossJoin(inv.agg(F.count(F.lit(1)).alias("files_inventoried")))
