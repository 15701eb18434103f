"""The batch jobs end to end on the smallest driver tables (roles from plans.bindings)."""

import hashlib
import os
import tempfile

import numpy as np
import pytest
from conftest import SF_SMALL
from panelspark.operators.quality import encode_alphabetical
from panelspark.plans import bindings as B
from panelspark.plans import jobs


def test_jobs_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="ps-jobs-")
    data, out = os.path.join(root, "data"), os.path.join(root, "out")
    inputs = {r: getattr(B, r)(spark, SF_SMALL) for r in jobs.ROLES}
    res = jobs.transform(spark, inputs, data, max_year=2000)
    assert res["regdata_rows"] == spark.read.parquet(f"{data}/regdata.parquet").count()
    sel = spark.read.parquet(f"{data}/sample_selection.parquet").orderBy("step").collect()
    assert [r.step for r in sel] == list(range(1, 10))
    obs = [r.obs for r in sel]
    assert all(obs[i] >= obs[i + 1] for i in range(len(obs) - 1) if i + 1 != 3)   # step 4 may fan out
    summary = jobs.provenance(spark, data).first()
    inventory = {r.name: r for r in spark.read.parquet(f"{data}/file_inventory.parquet").collect()}
    on_disk = {os.path.relpath(os.path.join(folder, f), data) for folder, _, names in os.walk(data) for f in names if f[0] not in "_."}
    on_disk = {f for f in on_disk if not f.startswith("file_inventory.parquet")}  # written after the listing
    assert set(inventory) == on_disk and summary.files_inventoried == len(on_disk) > 4
    for name, row in inventory.items():
        with open(os.path.join(data, name), "rb") as fh:
            content = fh.read()
        assert row.sha256 == hashlib.sha256(content).hexdigest() and row.size_mb == len(content) / 1e6 and len(row.mtime) == 16

    reg = spark.read.parquet(f"{data}/regdata.parquet").toPandas()
    jobs.figures(spark, data, out)
    rates = spark.read.parquet(f"{out}/fig_industry.parquet").toPandas()
    assert rates.n.sum() == len(reg) and rates.set_index("FF12").pct_same_sign.to_dict() == pytest.approx(reg.groupby("FF12").same_sign.mean().to_dict())
    slopes = {(r.fyearq, r.same_sign): r for r in spark.read.parquet(f"{out}/fig_erc.parquet").collect()}
    for key, part in reg.groupby(["fyearq", "same_sign"]):
        assert slopes[key].n == len(part)
        if len(part) > 2:
            assert slopes[key].estimate == pytest.approx(np.polyfit(part.sue, part.bhar, 1)[0], rel=1e-6, abs=1e-9)
    jobs.tables(spark, data, out)
    table = {(r["model"], r["row"]): r["value"] for r in spark.read.option("header", True).csv(f"{out}/regression_long").collect()}
    assert {table[m, "N"] for m in jobs.MODELS} == {f"{len(reg):,}"}
    x = np.column_stack([np.ones(len(reg)), reg.sue])
    beta, *_ = np.linalg.lstsq(x, reg.bhar, rcond=None)
    assert table["Base", "sue"].rstrip("*") == f"{beta[1]:.3f}"
    assert spark.read.option("header", True).csv(f"{out}/selection").count() == 9


def test_large_files_are_streamed(spark, tmp_path, monkeypatch):
    from panelspark.sources import inventory

    (tmp_path / "sub").mkdir()
    (tmp_path / "a.bin").write_bytes(b"x" * 3_000_000)
    (tmp_path / "sub" / "b.bin").write_bytes(b"")
    plain = inventory.file_inventory(spark, str(tmp_path)).collect()
    monkeypatch.setattr(inventory, "MAX_BINARY_FILE", 0)
    assert inventory.file_inventory(spark, str(tmp_path)).collect() == plain and [r.name for r in plain] == ["a.bin", "sub/b.bin"]


def test_encode_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "g string")
    got = {r.g: r.code for r in encode_alphabetical(df, "g", "code").collect()}
    assert got == {"a": 1, "b": 2, "c": 3, None: None}
