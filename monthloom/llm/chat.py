"""Chat formatting: cumulative snapshots of one conversation collapse to the longest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthloom.llm.common import saved


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Turns with position, number of turns and a rolling hash of all turns up to here.

    The hash of a prefix is the exclusive or of 2 x 64 bits of each (position, role, text)
    in it, so one running aggregate gives it for every prefix. Turns are ordered by (turn,
    role, text); a null role or text differs from an empty one.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.select("conv_id", "turn", "role", "text").withColumn("position", F.row_number().over(order))
    content = [F.col("position"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    for k in (1, 2):
        placed = placed.withColumn(f"h{k}", F.bit_xor(F.xxhash64(F.lit(k), *content)).over(upto))
    return placed.withColumn("n_turns", F.count("*").over(Window.partitionBy("conv_id")))


def rendered(role, text):
    """One turn as text. A null role is ``unknown``; a null text is empty."""
    return F.concat(
        F.lit("<|im_start|>"), F.coalesce(role, F.lit("unknown")), F.lit("\n"),
        F.trim(F.coalesce(text, F.lit(""))), F.lit("<|im_end|>\n"),
    )


def collapse_snapshots(conversations: DataFrame) -> DataFrame:
    """Rendered turns (conv_id, position, n_turns, n_copies, rendered) of maximal conversations.

    A conversation all of whose turns begin a longer one is dropped by an anti-join on
    (length, hashes); of equal conversations the smallest conv_id stays and ``n_copies``
    counts them. Concatenated by position the rows are the formatted conversation; they stay
    one row a turn, so that no long conversation has to fit in one row.

    Rows with null conv_id form one conversation. Repeated rows are turns of their own. An
    empty table gives no rows; columns other than conv_id, turn, role, text are ignored.
    """
    turns = saved(prefix_hashes(conversations))
    key = ["position", "h1", "h2"]
    longer = turns.filter("position < n_turns").select(*key).distinct()
    whole = (
        turns.filter("position = n_turns")
        .groupBy(*key)
        .agg(F.min("conv_id").alias("kept_id"), F.count("*").alias("n_copies"))
        .join(longer, key, "left_anti")
        .select("kept_id", "n_copies")
    )
    return turns.join(whole, F.col("conv_id").eqNullSafe(F.col("kept_id"))).select(
        "conv_id", F.col("position").cast("long").alias("position"), "n_turns", "n_copies",
        rendered(F.col("role"), F.col("text")).alias("rendered"),
    )


SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER w AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg(coalesce('1' || role, '0') || chr(31) || coalesce('1' || text, '0'), chr(30)) OVER w AS prefix,
         '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || trim(coalesce(text, ''), ' ') || '<|im_end|>' || chr(10) AS rendered
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
w AS (
  SELECT min(conv_id) AS conv_id, count(*) AS n_copies FROM t AS a
  WHERE position = n_turns AND NOT EXISTS (SELECT 1 FROM t AS b WHERE b.position = a.position AND b.position < b.n_turns AND b.prefix = a.prefix)
  GROUP BY prefix)
SELECT t.conv_id, t.position, t.n_turns, w.n_copies, t.rendered FROM t JOIN w ON t.conv_id IS NOT DISTINCT FROM w.conv_id
"""
