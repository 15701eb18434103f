"""Registered queries: sources and provenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelspark.plans import bindings as B
from panelspark.plans.registry import register
from panelspark.session import ensure_checkpoint_dir
from panelspark.sources.extract import extract, read_manifest, widen_decimals
from panelspark.sources.inventory import file_inventory


@register("decimal_to_double", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_extendedprice AS DECIMAL(15, 2)) AS DOUBLE) AS price,
       CAST(CAST(l_discount AS DECIMAL(4, 2)) AS DOUBLE) AS discount
FROM lineitem""", ["price", "discount"])
def q_decimal_to_double(spark, sf_dir):
    li = B.table(spark, sf_dir, "lineitem")
    src = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("l_extendedprice").cast("decimal(15,2)").alias("price"),
                    F.col("l_discount").cast("decimal(4,2)").alias("discount"))
    return widen_decimals(src)


@register("extract_skip_existing", """
SELECT l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity, sum(CAST(l_extendedprice AS DECIMAL(15, 2)))::DOUBLE AS price,
       (SELECT count(*) FROM lineitem) AS written, 0::BIGINT AS written_again, (SELECT count(*) FROM lineitem) AS noted
FROM lineitem GROUP BY l_returnflag""")
def q_extract_skip_existing(spark, sf_dir):
    """Line items extracted to the shared folder and read back; a second extract finds them complete
    and writes nothing (S3, S4, S9)."""
    li = B.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", F.col("l_extendedprice").cast("decimal(15,2)").alias("price"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/extract-{uuid.uuid4().hex}/lineitem.parquet"
    written = extract(li, path, partition_by=["l_returnflag"])
    again = extract(li.limit(1), path, partition_by=["l_returnflag"])
    back = spark.read.schema("l_quantity double, price double, l_returnflag string").parquet(path)
    return back.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.sum(F.col("price").cast("decimal(15,2)")).cast("double").alias("price"),
        F.lit(written).cast("long").alias("written"), F.lit(again).cast("long").alias("written_again"),
        F.lit(read_manifest(spark, path)["rows"]).cast("long").alias("noted"))


@register("file_inventory", None)
def q_file_inventory(spark, sf_dir):
    """SHA-256 of every input table file (no SQL twin: hashing bytes is not in the oracle)."""
    return file_inventory(spark, sf_dir).select("name", "size_mb", "sha256")
