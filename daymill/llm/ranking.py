"""Places of rows within groups of any size, without a window over a group's rows."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymill import workspace


def placed(rows: DataFrame, group: list[str], order: list, name: str = "placed") -> DataFrame:
    """`rows` with `place` (from 0, in its group by `order`) and `group_size`; an empty `group` ranks the whole table.

    Rows are dealt out by ranges of (group, order), sorted and stored once with their running number. A row's place
    is its number less the first one of its (range, group), plus what earlier ranges hold of the group: the windows
    run over one row per (range, group). So a group with most of the rows is as many tasks as its size asks for.
    Rows that `order` does not tell apart get places in any order among themselves; null groups are one group.
    Column names beginning with `_p_` are taken.
    """
    keys = [F.col(c) for c in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = workspace.materialize(sorted_rows.withColumn("_p_at", F.monotonically_increasing_id()), name)
    part, row = F.shiftright("_p_at", 33), F.col("_p_at").bitwiseAND((1 << 33) - 1)
    stored = stored.withColumns({"_p_part": part, "_p_row": row}).drop("_p_at")
    spans = stored.groupBy("_p_part", *group).agg(F.count(F.lit(1)).alias("_p_n"), F.min("_p_row").alias("_p_low"))
    over = Window.partitionBy(*group)
    earlier = F.sum("_p_n").over(over.orderBy("_p_part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(
        F.col("_p_part").alias("_p_span"), *[F.col(c).alias(f"_p_{c}") for c in group],
        (F.coalesce(earlier, F.lit(0)) - F.col("_p_low")).alias("_p_shift"), F.sum("_p_n").over(over).alias("group_size"),
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in group], F.col("_p_part") == F.col("_p_span"))
    joined = stored.join(spans, same).withColumn("place", F.col("_p_row") + F.col("_p_shift"))
    return joined.select(*rows.columns, "place", "group_size")
