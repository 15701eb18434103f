"""Sources and sinks: JDBC reads with pushdown, extract-to-Parquet with skip-if-exists,
DECIMAL widening, batch sizing, CSV output (S1-S12, S14).

An extract is a Spark job: the JDBC relation is read by ``numPartitions`` parallel
range queries (projection and filters pushed to the database), widened, and written by
the executors into a staging folder that takes the place of the output when it is complete.
Completion is marked by the ``_SUCCESS`` file, so a broken partial write is never mistaken for a
finished one.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

BATCH_FLOOR = 1_000
BATCH_CAP = 5_000_000
BYTES_PER_VALUE = 8


def batch_rows(n_cols: int, max_ram_mb: int = 8000, batch_size: int | None = None) -> int:
    """Rows per fetch: an explicit size is kept; otherwise max(1000, ram / (cols * 8 bytes)),
    capped at 5,000,000 (S6)."""
    if batch_size is not None:
        return int(batch_size)
    raw = max(BATCH_FLOOR, int(max_ram_mb * 1e6 / (max(n_cols, 1) * BYTES_PER_VALUE)))
    return min(raw, BATCH_CAP)


def widen_decimals(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to double (S5): precision can drift between batches/sources."""
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.withColumns(casts) if casts else df


def jdbc_source(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
                user: str | None = None, password: str | None = None, driver: str | None = None,
                partition_column: str | None = None, lower: int | str | None = None,
                upper: int | str | None = None, num_partitions: int | None = None,
                fetchsize: int | None = None, n_cols_hint: int | None = None, max_ram_mb: int = 8000,
                **options) -> DataFrame:
    """A JDBC relation (S1, S2, S14). With ``partition_column`` the read is split into
    ``num_partitions`` range queries; ``fetchsize`` defaults to the batch rule (S6)."""
    r = spark.read.format("jdbc").option("url", url)
    if query is not None:
        r = r.option("query", query)
    if table is not None:
        r = r.option("dbtable", table)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions or 8)))
    if fetchsize is None and n_cols_hint is not None:
        fetchsize = batch_rows(n_cols_hint, max_ram_mb)
    if fetchsize is not None:
        r = r.option("fetchsize", str(fetchsize))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


MANIFEST = "_manifest.json"  # Spark's readers pass over names that begin with "_"


def is_complete(spark: SparkSession, path: str) -> bool:
    """A finished Spark write: the folder holds ``_SUCCESS``."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def schema_hash(df: DataFrame) -> str:
    """SHA-256 of the column names and types, without metadata and nullability."""
    return hashlib.sha256(json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema.fields]).encode()).hexdigest()


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """What ``extract`` noted beside its output (rows, columns, schema_sha256); None without a note."""
    name = f"{path.rstrip('/')}/{MANIFEST}"
    if not path_exists(spark, name):
        return None
    fs, hadoop_path = _file_system(spark, name)
    note = fs.open(hadoop_path(name))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(note, "UTF-8"))
    finally:
        note.close()


def write_manifest(spark: SparkSession, path: str, note: dict) -> None:
    fs, hadoop_path = _file_system(spark, path)
    out = fs.create(hadoop_path(f"{path.rstrip('/')}/{MANIFEST}"))
    try:
        out.write(json.dumps(note).encode())
    finally:
        out.close()


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path`` by renaming. The folder that was there is
    renamed first and deleted last; if the second rename fails, it is put back. On object stores,
    where a rename copies, readers may meet the moment between the two."""
    fs, hadoop_path = _file_system(spark, path)
    target, old = hadoop_path(path), hadoop_path(f"{staged}.replaced")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    try:
        if not fs.rename(hadoop_path(staged), target):  # some file systems answer, others raise
            raise OSError(f"cannot move {staged} to {path}")
    except BaseException:
        if had:
            fs.rename(old, target)
        raise
    if had:
        fs.delete(old, True)


def extract(df: DataFrame, path: str, compression: str = "zstd", skip_if_exists: bool = True,
            max_records_per_file: int | None = None, partition_by: list[str] | None = None) -> int:
    """Write ``df`` (DECIMALs widened) to Parquet at ``path``; returns rows written, 0 when
    skipped because a complete output exists (S3, S4, S9).

    The job writes to a staging folder beside ``path`` (a hidden name, so no reader of the parent
    takes it for data), notes rows and schema in a manifest there, and only then takes the place of
    ``path`` (``publish``): a job that is killed leaves the old output as it was. The row count comes
    from an ``Observation`` on the write itself, whose tasks count once each however often they run.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    if skip_if_exists and is_complete(spark, path):
        return 0
    parent, _, name = path.rpartition("/")
    staged = f"{parent + '/' if parent else ''}.{name}.{uuid.uuid4().hex}"
    obs = Observation("extract")
    out = widen_decimals(df)
    w = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", compression)
    if max_records_per_file is not None:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    fs, hadoop_path = _file_system(spark, path)
    try:
        w.parquet(staged)
        rows = int(obs.get.get("rows", 0))
        write_manifest(spark, staged, {"rows": rows, "columns": out.columns, "schema_sha256": schema_hash(out)})
        publish(spark, staged, path)
    except BaseException:
        fs.delete(hadoop_path(staged), True)
        raise
    return rows


def write_parquet(df: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row and no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to SQL."""
    df.createOrReplaceTempView(name)
    return df


def attach_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Store human-readable variable labels in the column metadata (P6); Parquet keeps them."""
    for c, lab in labels.items():
        if c in df.columns:
            df = df.withMetadata(c, {**df.schema[c].metadata, "label": lab})
    return df


def labels_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["label"] for f in df.schema.fields if "label" in f.metadata}
