"""Places of rows inside their groups, however large a group is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rangehaul.llm.store import written

_SEATS = 33  # monotonically_increasing_id keeps the row of a partition in so many bits


def placed(rows: DataFrame, group: str, by: Sequence[str], name: str = "placed") -> DataFrame:
    """The rows, as a written table, with `at` (place in the group from 0, ascending by `by`, nulls first) and `size` (rows of the group).

    Rows are sorted by range, so that a group spreads over as many tasks as it needs; a task numbers its own rows, and only counts of
    (task, group) are summed up. Rows that tie in all of `by` take neighbouring places.
    """
    spark = rows.sparkSession
    # The tie breaker spreads rows that are equal in everything.
    held = written(rows.withColumn("__tie", F.monotonically_increasing_id()), f"{name}-rows")
    order = [F.col(c).asc_nulls_first() for c in (group, *by, "__tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    seated = held.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__seat", F.monotonically_increasing_id())
    table = written(seated.withColumn("__part", F.shiftright("__seat", _SEATS)), name)
    counts = table.groupBy("__part", F.col(group).alias("__group")).agg(F.min("__seat").alias("__first"), F.count(F.lit(1)).alias("__n"))
    own = Window.partitionBy("__group")
    before = F.sum("__n").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("__part").alias("__p"), "__group", "__first", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(own).alias("size"))
    both = table.join(counts, (table["__part"] == counts["__p"]) & table[group].eqNullSafe(counts["__group"]))
    return both.withColumn("at", F.col("__seat") - F.col("__first") + F.col("__before")).drop("__tie", "__seat", "__part", "__p", "__group", "__first", "__before")
