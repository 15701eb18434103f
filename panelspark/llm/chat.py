"""Chat formatting: every participant's view of a dialogue, with loss masks. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelspark.session import reliable_checkpoint

BEGIN, END = "<|im_start|>", "<|im_end|>"


def _header(role: Column, speaker: Column, system: tuple[str, ...]) -> Column:
    return (F.when(role.isin(*system), F.lit(f"{BEGIN}system\n"))
            .when(role == speaker, F.lit(f"{BEGIN}assistant\n"))
            .when(role.isNull(), F.lit(f"{BEGIN}user\n"))
            .otherwise(F.concat(F.lit(f"{BEGIN}user name="), role, F.lit("\n"))))


def _in_parts(rows: DataFrame, part_turns: int) -> DataFrame:
    """``rows`` with the column ``part``: the place of a turn in its dialogue, divided by ``part_turns``."""
    long = rows.groupBy("conv_id").count().where(F.col("count") > part_turns).select("conv_id")
    if long.isEmpty():
        return rows.withColumn("part", F.lit(0).cast("long"))
    order = ["turn", "role", "text", "salt"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    far = rows.join(long, "conv_id").withColumn("salt", F.monotonically_increasing_id())
    far = reliable_checkpoint(far.repartitionByRange(parts, "conv_id", *order).withColumn("piece", F.spark_partition_id()))
    before = far.groupBy("conv_id", "piece").count().select(
        "conv_id", "piece", F.coalesce(F.sum("count").over(W.partitionBy("conv_id").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("conv_id", "piece").orderBy(*order)) - 1
    far = far.withColumn("within", within).join(before, ["conv_id", "piece"])
    far = far.withColumn("part", F.floor((F.col("before") + F.col("within")) / part_turns).cast("long")).select(*rows.columns, "part")
    return rows.join(long, "conv_id", "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(far)


def perspectives(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 system: tuple[str, ...] = ("system",), part_turns: int = 4096) -> DataFrame:
    """One row per dialogue, part and participant: the dialogue as that participant lived it.

    ``conv_id, part, speaker, n_turns, n_own, text, spans, mask, masked_chars``. The speaker's turns are
    the assistant's; other participants are users with their names; turns of ``system`` roles stay
    system turns, and those roles are not participants. ``n_turns`` counts the part's turns, ``spans`` holds the (start, stop) character
    ranges of ``text`` to learn from: the content and end mark of the speaker's turns; ``mask`` is
    the same as text (``12-40,60-75``).

    Turns are ordered by number, then role, then text; repeated turns stay. A dialogue is collected
    once, not once per participant. A dialogue of up to ``part_turns`` turns is one part (0). Of a longer one,
    part p holds its turns p * ``part_turns`` and following in that order, a row of its own with every participant of the whole
    dialogue, so an endless dialogue is no endless group; ``spans`` count from the part's beginning. The turns of long
    dialogues are placed by a range partitioning and prefix sums over its partitions, not by one task.
    Turns without a number come first. A null role speaks as an unnamed user; a null text
    is empty. Rows with a null id belong to no dialogue and give no row, and neither does
    a dialogue without participants. An empty table gives no rows; other columns are not read.
    """
    rows = df.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    whole = rows.where("conv_id IS NOT NULL")
    rows = _in_parts(whole, part_turns)
    speakers = whole.where(F.col("role").isNotNull() & ~F.col("role").isin(*system)).select("conv_id", F.col("role").alias("speaker")).distinct()
    turns = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    both = turns.join(speakers, "conv_id")
    heads = F.transform("turns", lambda t: _header(t["role"], F.col("speaker"), system))
    both = both.withColumn("heads", heads)
    both = both.withColumn("pieces", F.zip_with("heads", "turns", lambda h, t: F.concat(h, t["text"], F.lit(END + "\n"))))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["head"])
        stop = start + F.length(x["text"]) + F.lit(len(END))
        return F.struct((stop + 1).alias("at"), F.when(x["own"], F.concat(acc["spans"], F.array(F.struct(start.alias("start"), stop.alias("stop"))))).otherwise(acc["spans"]).alias("spans"))

    own = F.zip_with("heads", "turns", lambda h, t: F.struct(h.alias("head"), t["text"].alias("text"), F.coalesce(t["role"] == F.col("speaker"), F.lit(False)).alias("own")))
    both = both.withColumn("spans", F.aggregate(own, state, step, lambda acc: acc["spans"]))
    return both.select(
        "conv_id", "part", "speaker", F.size("turns").cast("long").alias("n_turns"), F.size("spans").cast("long").alias("n_own"),
        F.array_join("pieces", "").alias("text"), "spans",
        F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string"))), ",").alias("mask"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("masked_chars"))


ORACLE = f"""
WITH rows_ AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, coalesce(text, '')) - 1) // 4096 AS part
  FROM conversations WHERE conv_id IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM rows_ WHERE role IS NOT NULL AND role <> 'system'),
pieces AS (
  SELECT r.conv_id, r.part, s.speaker, r.turn, r.role, r.text, coalesce(r.role = s.speaker, false) AS own,
         CASE WHEN r.role = 'system' THEN '{BEGIN}system' || chr(10) WHEN r.role = s.speaker THEN '{BEGIN}assistant' || chr(10)
              WHEN r.role IS NULL THEN '{BEGIN}user' || chr(10) ELSE '{BEGIN}user name=' || r.role || chr(10) END AS head
  FROM rows_ r JOIN speakers s ON r.conv_id = s.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(text) + {len(END) + 1}) OVER (PARTITION BY conv_id, part, speaker
            ORDER BY turn NULLS FIRST, role NULLS FIRST, text ROWS UNBOUNDED PRECEDING) AS stop_
  FROM pieces)
SELECT conv_id, part, speaker, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own,
       string_agg(head || text || '{END}' || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(CAST(stop_ - 1 - length(text) - {len(END)} AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(stop_ - 1 AS BIGINT) AS VARCHAR) END, ','
                ORDER BY turn NULLS FIRST, role NULLS FIRST, text), '') AS mask,
       CAST(coalesce(sum(CASE WHEN own THEN length(text) + {len(END)} END), 0) AS BIGINT) AS masked_chars
FROM placed GROUP BY conv_id, part, speaker
"""
