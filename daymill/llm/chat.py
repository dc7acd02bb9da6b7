"""Chat formatting of maximal conversations. DataFrame operations only."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymill import workspace

START, END = "<|im_start|>", "<|im_end|>"
SECOND_SEED = 7919


def _mark(*more: Column) -> Column:
    """Hash of a turn at its place; null and empty differ."""
    return F.xxhash64("_at", F.isnull("role"), "role", F.isnull("text"), "text", *more)


def rolling_prefixes(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, at, h1, h2, last) for every turn: 128 bits that stand for all turns up to this one.

    Each turn's hash holds its place, so the running XOR depends on the order. Turns come by number, then role,
    then text, null first; numbers may have gaps or repeat. One window pass with constant memory per conversation.
    """
    order = Window.partitionBy("_id").orderBy("turn", "role", "text")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.select(F.col(id_col).alias("_id"), "turn", "role", "text").withColumn("_at", F.row_number().over(order))
    return placed.select(
        F.col("_id").alias(id_col),
        F.col("_at").alias("at"),
        F.bit_xor(_mark()).over(running).alias("h1"),
        F.bit_xor(_mark(F.lit(SECOND_SEED))).over(running).alias("h2"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
    )


def maximal(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, n_turns, n_copies): conversations that begin no longer one; of equal ones the smallest id, with their number.

    Prefixes are reduced to distinct ones in the tasks before the shuffle, so a first turn that a third of all
    conversations share is one row per task.
    """
    rolled = workspace.materialize(rolling_prefixes(turns, id_col), "prefixes")
    key = ["at", "h1", "h2"]
    whole = rolled.filter("last").groupBy(*key).agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("n_copies"))
    shorter = rolled.filter("not last").select(*key).distinct()
    return whole.join(shorter, key, "left_anti").select(id_col, F.col("at").cast("long").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, n_turns, n_copies, chat): maximal conversations, rendered turn by turn.

    A null role reads `unknown`, a null text is empty. Rows with a null id are one conversation. Other columns are
    not read. A rendered conversation is one value, so its own turns meet in one task; no other group does.
    """
    held = maximal(turns, id_col).withColumnRenamed(id_col, "_kept")
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    said = lambda t: F.concat(
        F.lit(START), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(END + "\n")
    )
    rows = turns.select(F.col(id_col).alias("_id"), turn.alias("_turn"))
    rows = rows.join(held, F.col("_id").eqNullSafe(F.col("_kept")))
    chats = rows.groupBy("_id").agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), F.sort_array(F.collect_list("_turn")).alias("_turns")
    )
    return chats.select(
        F.col("_id").alias(id_col), "n_turns", "n_copies", F.concat_ws("", F.transform("_turns", said)).alias("chat")
    )


ORACLE = f"""
    WITH c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
               FROM conversations GROUP BY conv_id),
    u AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, turns FROM c GROUP BY turns)
    SELECT conv_id, len(turns) AS n_turns, n_copies,
           list_aggregate(list_transform(turns, lambda t: '{START}' || coalesce(t.role, 'unknown') || chr(10) || coalesce(t.text, '') || '{END}' || chr(10)), 'string_agg', '') AS chat
    FROM u WHERE NOT EXISTS (SELECT 1 FROM c WHERE len(c.turns) > len(u.turns) AND c.turns[1:len(u.turns)] = u.turns)"""
