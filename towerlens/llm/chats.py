"""Chat formatting of logged conversations, without snapshots of ones that went on.

Defined results: turns stand in the order of ``turn``, then role and text, nulls first; a null role or text is
rendered as an empty one but is not equal to it; rows with a null id are one conversation; of equal
conversations the least id stays, a null one only where there's no other; a turn that is logged twice counts
twice; an empty table gives no rows. Only the four named columns are read.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

TURN = "<|im_start|>%s\n%s<|im_end|>\n"


def prefixes(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(id, place, role, text, a, b, last)``: of every turn its place and a rolling 128-bit hash of the turns up to it.

    The hash of a prefix is that of the prefix before, xor that of the turn at its place, so one running window
    gives all of them.
    """
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    order = Window.partitionBy("id").orderBy(
        F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")
    )
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn("last", F.lead(F.lit(1)).over(order).isNull())
    said = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    rows = rows.withColumn("own", F.xxhash64(*said)).withColumn("other", F.xxhash64(F.lit(1), *reversed(said)))
    so_far = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolling = [F.bit_xor("own").over(so_far).alias("a"), F.bit_xor("other").over(so_far).alias("b")]
    return rows.select("id", "place", "role", "text", "last", *rolling)


def maximal(hashed: DataFrame) -> DataFrame:
    """``(id, n_turns, n_copies)`` of conversations that are no prefix of a longer one, equal ones once.

    Prefixes and whole conversations are made distinct before they meet, so common first turns and conversations
    logged many times are one row each.
    """
    key = ["place", "a", "b"]
    whole = hashed.where("last").groupBy(*key).agg(F.min("id").alias("id"), F.count("*").alias("n_copies"))
    longer = hashed.where("not last").select(*key).distinct()
    return whole.join(longer, key, "left_anti").select("id", F.col("place").cast("long").alias("n_turns"), "n_copies")


def rendered(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(id, n_turns, n_copies, text)`` of every maximal conversation; ``text`` is its turns in chat markup."""
    hashed = written(prefixes(turns, id_col, turn_col, role_col, text_col), "prefixes")
    kept = written(maximal(hashed), "maximal").withColumnRenamed("id", "kept_id")
    # Only the turns of conversations that stay are gathered and rendered.
    said = hashed.select("id", "place", "role", "text").join(kept, F.col("id").eqNullSafe(F.col("kept_id")))
    turn = F.struct("place", F.format_string(TURN, F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("turn"))
    rows = said.groupBy("id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(turn)).alias("said"))
    return rows.select(F.col("id").alias(id_col), "n_turns", "n_copies", F.array_join(F.col("said.turn"), "").alias("text"))


ORACLE = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER
    (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM conversations
), upto AS (
  SELECT conv_id, place, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY place) AS said,
    string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '')
      OVER (PARTITION BY conv_id ORDER BY place) AS markup,
    count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM turns
), whole AS (
  SELECT said, n_turns, markup, min(conv_id) AS conv_id, count(*) AS n_copies FROM upto WHERE place = n_turns GROUP BY ALL
)
SELECT conv_id, n_turns, n_copies, markup AS text FROM whole
WHERE NOT EXISTS (SELECT 1 FROM upto u WHERE u.place < u.n_turns AND u.place = whole.n_turns AND u.said = whole.said)
"""
