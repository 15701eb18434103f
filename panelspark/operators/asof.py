"""As-of join of two large tables per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelspark.session import reliable_checkpoint


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, right_cols: list[str],
              direction: str = "backward", exact: bool = True) -> DataFrame:
    """Every row of ``left`` with ``right_cols`` (and ``right_time``) of the right row of the same ``keys`` nearest in time: the
    last one at or before ``left_time`` (``backward``), or the first one at or after it (``forward``).

    ``exact=False`` leaves rows of equal time out. Of several right rows at one time, the one of largest
    ``right_cols`` counts. No match, or a NULL key or time, gives NULLs; no left row is lost or doubled.

    Both tables are laid in one order of (keys, time), range partitioned, so a key may span many tasks. Within a task the
    last right row is carried forward; what a task hands on to the next ones is one row per key, carried
    over a table of at most one row per key and partition.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    sign = 1 if direction == "backward" else -1
    found = F.struct(F.col(right_time).alias("time"), *[F.col(c).alias(c) for c in right_cols])
    kind = right.select(found.alias("f")).schema["f"].dataType
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # the right rows of one time come before the left ones, or after them if equal times do not count
    rows = left.select(*[F.col(k) for k in keys], F.col(left_time).cast("timestamp").alias("_at"), F.lit(0 if exact else -1).alias("_side"),
                       F.struct("*").alias("_left"), F.lit(None).cast(kind).alias("_found"))
    facts = right.where(known & F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).cast("timestamp").alias("_at")).agg(F.max(found).alias("_found"))
    both = rows.unionByName(facts.withColumns({"_side": F.lit(-1 if exact else 0), "_left": F.lit(None).cast(rows.schema["_left"].dataType)}))
    both = both.withColumn("_t", sign * F.unix_micros("_at"))
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "_t", "_side", "_salt")
    both = reliable_checkpoint(both.withColumn("_piece", F.spark_partition_id()))
    piece = W.partitionBy(*keys, "_piece")
    # the last fact of each piece, handed on to the pieces after it
    last = both.where("_found IS NOT NULL").groupBy(*keys, "_piece").agg(F.max_by("_found", "_t").alias("_last"))
    pieces = both.select(*keys, "_piece").distinct().join(last, [*keys, "_piece"], "left")
    before = W.partitionBy(*keys).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    carry = pieces.select(*keys, "_piece", F.last("_last", ignorenulls=True).over(before).alias("_carry")).where("_carry IS NOT NULL")
    here = F.last("_found", ignorenulls=True).over(piece.orderBy("_t", "_side", "_salt").rowsBetween(W.unboundedPreceding, 0))
    out = both.withColumn("_here", here).where("_left IS NOT NULL").join(carry, [*keys, "_piece"], "left")
    match = F.when(known & F.col("_at").isNotNull(), F.coalesce("_here", "_carry"))
    return out.select("_left", match.alias("_match")).select("_left.*", F.col("_match.time").alias(right_time), *[F.col(f"_match.{c}").alias(c) for c in right_cols])
