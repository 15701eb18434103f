"""Sources, industries and provenance."""

import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelspark.functions.industry import assign_ff49, ff12
from panelspark.sources.extract import batch_rows, extract, widen_decimals
from panelspark.sources.inventory import file_inventory


def test_batch_rows():
    assert batch_rows(3, 8000) == 5_000_000                # capped when auto-sized
    assert batch_rows(10_000, 1) == 1_000                 # floor
    assert batch_rows(3, 8000, batch_size=7_000_000) == 7_000_000   # explicit wins


def test_extract_skip_existing_and_decimals(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="ps-test-"), "t.parquet")
    df = spark.range(10).select(F.col("id"), F.col("id").cast("decimal(9,2)").alias("d"))
    assert extract(df, out) == 10
    assert dict(spark.read.parquet(out).dtypes)["d"] == "double"
    assert extract(df, out) == 0                          # complete output exists -> skipped
    assert widen_decimals(df).schema["d"].dataType.typeName() == "double"


def test_a_failed_extract_leaves_the_old_output(spark, tmp_path, monkeypatch):
    from panelspark.sources import extract as E

    out = str(tmp_path / "t.parquet")
    assert extract(spark.range(10), out) == 10
    assert E.read_manifest(spark, out) == {"rows": 10, "columns": ["id"], "schema_sha256": E.schema_hash(spark.range(1))}

    def old_stays():
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10))
        assert E.is_complete(spark, out) and os.listdir(tmp_path) == ["t.parquet"]

    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        extract(broken, out, skip_if_exists=False)
    old_stays()
    with monkeypatch.context() as m:
        m.setattr(E, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            extract(spark.range(3), out, skip_if_exists=False)
    old_stays()
    assert extract(spark.range(3).selectExpr("id AS other"), out, skip_if_exists=False) == 3
    assert spark.read.parquet(out).columns == ["other"] and E.read_manifest(spark, out)["rows"] == 3
    os.remove(os.path.join(out, "_SUCCESS"))             # an output of unknown state is written anew
    assert extract(spark.range(4), out) == 4 and spark.read.parquet(out).count() == 4


def test_publish_puts_the_old_folder_back(spark, tmp_path):
    from panelspark.sources import extract as E

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "old").write_text("x")
    with pytest.raises(Exception):
        E.publish(spark, str(tmp_path / "nothing"), str(tmp_path / "t"))
    assert os.listdir(tmp_path / "t") == ["old"]


def test_ff12_ff49(spark):
    df = spark.createDataFrame([(2834,), (4911,), (6021,), (3571,), (9999,), (None,)], "sic int")
    got = {r.sic: (r.FF12, r.ff12num) for r in df.select("sic", *ff12("sic")).collect()}
    assert got[2834] == ("Healthcare", 10.0) and got[4911] == ("Utilities", 8.0)
    assert got[6021] == ("Finance", 11.0) and got[9999] == ("Other", 12.0) and got[None] == ("Other", 12.0)
    g49 = {r.sic: (r.FF49, r.ff49num) for r in assign_ff49(df, "sic").collect()}
    assert g49[2834] == ("Pharmaceutical Products", 13.0) and g49[3571] == ("Computer Hardware", 35.0)
    assert g49[9999] == ("Other", 49.0) and g49[None] == ("Other", 49.0)


def test_file_inventory_sha256(spark):
    d = tempfile.mkdtemp(prefix="ps-inv-")
    for name, body in (("b.txt", b"hello"), ("a.bin", b"\x00" * 1000)):
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(body)
    os.mkdir(os.path.join(d, "sub"))
    got = file_inventory(spark, d).collect()
    assert [r.name for r in got] == ["a.bin", "b.txt"]
    assert got[1].sha256 == hashlib.sha256(b"hello").hexdigest() and got[1].size_mb == 5 / 1e6
    assert file_inventory(spark, os.path.join(d, "missing")).count() == 0


def test_labels_roundtrip(spark):
    from panelspark.sources.extract import attach_labels, labels_of, write_parquet
    df = attach_labels(spark.range(3).withColumnRenamed("id", "sue"), {"sue": "SUE", "missing": "x"})
    out = os.path.join(tempfile.mkdtemp(prefix="ps-lab-"), "l.parquet")
    write_parquet(df, out)
    assert labels_of(spark.read.parquet(out)) == {"sue": "SUE"}


def test_top_groups_and_group_label(spark):
    from panelspark.functions.scalar import group_label
    from panelspark.operators.quality import top_groups
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "g string")
    assert [(r.g, r.n) for r in top_groups(df, ["g"], 2).collect()] == [("c", 3), ("a", 2)]
    assert df.select(group_label("g", "g").alias("l")).first().l == "a / a"


def test_file_inventory_lists_hidden_names(spark, tmp_path):
    files = {"_codes.csv": b"a,b", ".notes": b"n", ".own.crc": b"o", "sub/_x": b"", "t/part-0": b"p", "t/.part-0.crc": b"c", "t/_SUCCESS": b""}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = file_inventory(spark, str(tmp_path)).collect()
    assert {r.name: r.sha256 for r in got} == {n: hashlib.sha256(d).hexdigest() for n, d in files.items()}
    assert {r.name for r in got if r.marker} == {"t/.part-0.crc", "t/_SUCCESS"}


def test_file_inventory_splits_large_files_over_tasks(spark, tmp_path, monkeypatch):
    """One record or one task must not hold a whole large file (round 3, F1)."""
    from panelspark.sources import inventory, sha256

    body = bytes(range(256)) * 5
    sizes = {"whole": 512, "more": 513, "less": 511, "long": 1279, "packed.gz": 1000, "a b%20#c.bin": 700, "_kept": 300, "small": 90}
    for name, size in sizes.items():
        (tmp_path / name).write_bytes(body[:size])
    monkeypatch.setattr(inventory, "MAX_BINARY_FILE", 100)
    monkeypatch.setattr(inventory, "SEGMENT", 256)
    jobs = "inventory-segments"
    spark.sparkContext.setJobGroup(jobs, jobs)
    try:
        df = inventory.file_inventory(spark, str(tmp_path))
        rounds = spark.sparkContext.statusTracker().getJobIdsForGroup(jobs)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.name: (r.sha256, r.size_mb) for r in df.collect()} == {n: (hashlib.sha256(body[:s]).hexdigest(), s / 1e6) for n, s in sizes.items()}
    assert [os.path.basename(f) for f in df.inputFiles()] == ["small"]
    assert len(rounds) == 5  # 1279 bytes, 256 a task

    path, done, words, digest, ends = f"file:{tmp_path}/long", 0, None, None, []
    while not digest:
        done, words, digest = sha256.read_segment(path, 1279, done, words, 256, chunk=100)
        ends.append(done)
    assert ends == [256, 512, 768, 1024, 1279] and digest == hashlib.sha256(body[:1279]).hexdigest()
    with pytest.raises(OSError):
        sha256.read_segment(path, 1300, 0, None, 2000)
    monkeypatch.setattr(sha256, "resume", lambda *_: None)  # no state to hand on: one task, the whole file
    assert sha256.read_segment(path, 1279, 0, None, 256) == (1279, None, digest)


def test_file_inventory_keeps_large_files_out_of_records(spark, tmp_path):
    """At the built-in sizes: a file of 128 MB is streamed, not read as one record (round 3, F1)."""
    with open(tmp_path / "big.bin", "wb") as fh:
        fh.truncate((1 << 27) + 1)
    df = file_inventory(spark, str(tmp_path))
    with open(tmp_path / "big.bin", "rb") as fh:
        assert df.first().sha256 == hashlib.file_digest(fh, "sha256").hexdigest()
    assert df.inputFiles() == []


def test_file_inventory_by_records_where_pyarrow_has_no_file_system(spark, tmp_path, monkeypatch):
    from panelspark.sources import inventory

    (tmp_path / "a.bin").write_bytes(b"x" * 1000)
    monkeypatch.setattr(inventory, "MAX_BINARY_FILE", 100)
    monkeypatch.setattr(inventory, "open_store", lambda path: (_ for _ in ()).throw(OSError("no libhdfs")))
    df = inventory.file_inventory(spark, str(tmp_path))
    assert [os.path.basename(f) for f in df.inputFiles()] == ["a.bin"] and df.first().sha256 == hashlib.sha256(b"x" * 1000).hexdigest()
