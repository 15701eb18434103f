"""Bucketed storage of a large table, so that joins on its keys read it without a shuffle.

Daily returns are written once and joined by every event study. Bucketed by (entity, date), their
side of the event-day join needs no exchange, and a hot entity is spread over its dates. The
catalog entry only names the folder: the layout is noted beside the files, so any later session can
open them again with ``open_bucketed``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.sources.extract import _file_system, publish, read_manifest, write_manifest


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None) -> None:
    """Write ``df`` as Parquet at ``path``, bucketed and sorted by ``keys``; one file per bucket.

    ``buckets`` is by default ``spark.sql.shuffle.partitions``: a join plans no exchange on this side
    as long as the session has no more shuffle partitions than that. The rows are dealt by the hash
    that Spark buckets by, one shuffle at most. Rows with NULL keys are kept. The output is staged and
    renamed into place like an extract's, so a killed job leaves an earlier table as it was.
    """
    if not keys or set(keys) - set(df.columns):
        raise ValueError(f"bucket keys {keys} must be columns of the table")
    spark = df.sparkSession
    path = path.rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parent, _, name = path.rpartition("/")
    staged = f"{parent + '/' if parent else ''}.{name}.{uuid.uuid4().hex}"
    entry = f"staged_{uuid.uuid4().hex}"
    fs, hadoop_path = _file_system(spark, path)
    try:
        (df.repartition(buckets, *[F.col(k) for k in keys]).write.format("parquet").bucketBy(buckets, *keys)
         .sortBy(*keys).option("path", staged).saveAsTable(entry))
        columns = [[f.name, f.dataType.simpleString()] for f in df.schema.fields]
        write_manifest(spark, staged, {"keys": keys, "buckets": buckets, "columns": columns})
        publish(spark, staged, path)
    except BaseException:
        fs.delete(hadoop_path(staged), True)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")  # external: the files stay


def open_bucketed(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The table that ``write_bucketed`` left at ``path``, entered in the catalog as ``name`` (a fresh
    name by default) with the keys and the number of buckets noted there."""
    path = path.rstrip("/")
    note = read_manifest(spark, path)
    if not note or "buckets" not in note:
        raise ValueError(f"{path} holds no bucketed table")
    name = name or f"bucketed_{uuid.uuid4().hex}"

    def quoted(names):
        return ", ".join(f"`{n}`" for n in names)

    columns = ", ".join(f"`{c}` {kind}" for c, kind in note["columns"])
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY ({quoted(note['keys'])}) "
              f"SORTED BY ({quoted(note['keys'])}) INTO {note['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)
