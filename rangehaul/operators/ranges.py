"""Split keys, boundaries, range predicates and range assignment.

Planning frames are small by construction (one row per table, column, histogram step or
boundary); range assignment and coverage run over the data rows without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from rangehaul.functions.interpolation import interpolate
from rangehaul.functions.literals import constant_array, literal, quoted
from rangehaul.functions.types import INTEGER_TYPES, NUMERIC_TYPES, TEMPORAL_TYPES


def choose_split_key(profile: DataFrame) -> DataFrame:
    """One key per table: the best indexed numeric or temporal column.

    `profile` has one row per column: table, column, position, sql_type, nullable, index_id,
    clustered, is_unique, primary_key. Tables without a candidate are absent (single scan).
    """
    usable = profile.filter(F.col("index_id").isNotNull() & (F.col("index_id") != 0)).filter(
        F.col("sql_type").isin(*NUMERIC_TYPES, *TEMPORAL_TYPES)
    )
    order = W.partitionBy("table").orderBy(
        F.desc("clustered"),
        F.desc("is_unique"),
        F.desc("primary_key"),
        F.asc("nullable"),
        F.desc(F.col("sql_type").isin(*INTEGER_TYPES)),
        F.asc("position"),
    )
    return usable.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def histogram_boundaries(
    steps: DataFrame, partitions: int | Column, by: Sequence[str] = ("table", "column"), high: str = "high"
) -> DataFrame:
    """Equi-depth boundaries: the keys at which i/n of the rows lie below, i = 1 … n-1.

    `steps` has (by…, high, range_rows, equal_rows); the step with a NULL high carries the NULL
    rows, which count as lying first. Each step names the targets that fall into it, so no join
    of targets with steps takes place. A value repeated over several targets gives one boundary.
    """
    by = list(by)
    dtype = steps.schema[high].dataType
    n = F.lit(partitions).cast("bigint") if isinstance(partitions, int) else partitions.cast("bigint")
    at_least_zero = lambda name: F.greatest(F.lit(0.0), F.coalesce(F.col(name).cast("double"), F.lit(0.0)))
    rows = F.col("_range") + F.col("_equal")
    group = W.partitionBy(*by)
    ordered = group.orderBy(F.col("_null_step").desc(), F.col(high).asc())
    running = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    keyed = (
        steps.withColumn("_null_step", F.col(high).isNull())
        .withColumn("_range", F.when(F.col("_null_step"), F.lit(0.0)).otherwise(at_least_zero("range_rows")))
        .withColumn("_equal", at_least_zero("equal_rows"))
        # The NULL step's range rows count in the total, but not as rows below the first key.
        .withColumn("_whole", at_least_zero("range_rows") + F.col("_equal"))
        .withColumn("_n", n)
        .withColumn("_total", F.sum("_whole").over(group))
        .withColumn("_end", F.sum(rows).over(running))
        .withColumn("_previous", F.lag(high).over(ordered))
        .withColumn("_lowest", F.min(high).over(group))
        .withColumn("_highest", F.max(high).over(group))
        .filter(~F.col("_null_step") & (F.col("_total") > 0) & (F.col("_n") > 1))
        .withColumn("_before", F.when(F.col("_previous").isNull(), F.lit(0.0)).otherwise(F.col("_end") - rows))
    )
    # Candidates with one to spare on either side; the exact comparison follows.
    per_row = F.col("_n") / F.col("_total")
    first = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("_before") * per_row))
    last = F.least(F.col("_n") - 1, F.ceil(F.col("_end") * per_row))
    target = F.col("_total") * F.col("_i") / F.col("_n")
    below = F.col("_end") - rows
    inside = F.col("_previous").isNotNull() & (target < below + F.col("_range")) & (F.col("_range") > 0)
    ratio = (target - below) / F.when(F.col("_range") > 0, F.col("_range"))
    return (
        keyed.filter(first <= last)
        .withColumn("_i", F.explode(F.sequence(first, last)))
        .filter((target <= F.col("_end")) & (F.col("_previous").isNull() | (target > F.col("_before"))))
        .withColumn(
            "boundary",
            F.when(inside, interpolate(F.col("_previous"), F.col(high), ratio, dtype)).otherwise(F.col(high)),
        )
        .filter((F.col("boundary") > F.col("_lowest")) & (F.col("boundary") <= F.col("_highest")))
        .select(*by, "boundary")
        .distinct()
    )


def linear_boundaries(
    bounds: DataFrame,
    partitions: int | Column,
    by: Sequence[str] = ("table", "column"),
    low: str = "low",
    high: str = "high",
) -> DataFrame:
    """Evenly spaced boundaries between the smallest and the largest key of each table."""
    dtype = bounds.schema[low].dataType
    n = F.lit(partitions).cast("bigint") if isinstance(partitions, int) else partitions.cast("bigint")
    point = interpolate(F.col(low), F.col(high), F.col("_i") / F.col("_n"), dtype)
    return (
        bounds.withColumn("_n", n)
        .filter((F.col("_n") > 1) & (F.col(low) < F.col(high)))
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n") - 1)))
        .withColumn("boundary", point)
        .filter((F.col("boundary") > F.col(low)) & (F.col("boundary") <= F.col(high)))
        .select(*by, "boundary")
        .distinct()
    )


def range_predicates(
    boundaries: DataFrame,
    nullable: bool | Column = False,
    by: Sequence[str] = ("table", "column"),
    dialect: str = "spark",
) -> DataFrame:
    """Boundaries as disjoint predicates that together cover every key.

    The first range is open below and takes the NULLs of a nullable column, the last is open
    above: stale statistics change the balance of the ranges, never their completeness.
    Returns (by…, chunk, low, high, predicate); a table without boundaries needs `1=1`.
    """
    by = list(by)
    dtype = boundaries.schema["boundary"].dataType
    may_be_null = F.lit(nullable) if isinstance(nullable, bool) else nullable
    ordered = W.partitionBy(*by).orderBy("boundary")
    name = quoted(F.col("column"), dialect)
    lower, upper = literal(F.col("low"), dtype, dialect), literal(F.col("high"), dtype, dialect)
    below = F.concat(name, F.lit(" < "), upper)
    first = F.when(may_be_null, F.concat(F.lit("("), below, F.lit(" OR "), name, F.lit(" IS NULL)"))).otherwise(below)
    from_low = F.concat(name, F.lit(" >= "), lower)
    # Each boundary opens one range; the lowest also closes the range before it.
    opened = (
        boundaries.withColumn("_next", F.lead("boundary").over(ordered))
        .withColumn("_chunk", F.row_number().over(ordered))
        .withColumn("_null", F.lit(None).cast(dtype))
    )
    pair = lambda chunk, lo, hi: F.struct(chunk.cast("int").alias("chunk"), lo.alias("low"), hi.alias("high"))
    own = pair(F.col("_chunk"), F.col("boundary"), F.col("_next"))
    head = pair(F.lit(0), F.col("_null"), F.col("boundary"))
    ranges = opened.withColumn(
        "_range", F.explode(F.when(F.col("_chunk") == 1, F.array(head, own)).otherwise(F.array(own)))
    )
    kept = [c for c in boundaries.columns if c != "boundary"]
    return ranges.select(*kept, "_range.*").withColumn(
        "predicate",
        F.when(F.col("low").isNull(), first)
        .when(F.col("high").isNull(), from_low)
        .otherwise(F.concat(from_low, F.lit(" AND "), below)),
    )


def boundary_values(boundaries: DataFrame) -> list:
    """Boundaries of one table as sorted values for the driver (tens to hundreds of keys)."""
    return sorted(row["boundary"] for row in boundaries.select("boundary").collect())


# Up to this many boundaries a comparison tree is small enough for the JIT compiler.
_TREE_LIMIT = 32


def with_range_index(
    df: DataFrame, key: Column, boundaries: Sequence, name: str, dtype: T.DataType, above_equal: bool = True
) -> DataFrame:
    """Add the number of boundaries at or below the key (`above_equal`), or strictly below it.

    log2(n) comparisons per row, all in whole-stage codegen: a tree of conditions for few
    boundaries, else a binary search in a constant array, one projection per step (a tree of
    hundreds of conditions would be too large a method to be compiled). NULL belongs to range
    0, NaN to the last range (Spark orders NaN above all numbers).
    """
    points = sorted(set(boundaries))
    typed = lambda v: F.lit(v).cast(dtype)
    reached = (lambda p: key >= p) if above_equal else (lambda p: key > p)
    if not points:
        return df.withColumn(name, F.lit(0))
    if len(points) <= _TREE_LIMIT:

        def tree(first: int, last: int) -> Column:
            if first == last:
                return F.lit(first)
            middle = (first + last) // 2
            return F.when(reached(typed(points[middle])), tree(middle + 1, last)).otherwise(tree(first, middle))

        return df.withColumn(name, F.when(key.isNull(), F.lit(0)).otherwise(tree(0, len(points))))
    constant = constant_array(points, dtype)
    half = 1 << (len(points).bit_length() - 1)
    found = df.withColumn(name, F.when(reached(typed(points[half - 1])), half).otherwise(0))
    while half > 1:
        half //= 2
        # Beyond the end of the array the lookup is NULL, and the position stays.
        further = F.col(name) + half
        found = found.withColumn(name, F.when(reached(F.get(constant, further - 1)), further).otherwise(F.col(name)))
    return found


def with_array_index(df: DataFrame, key: Column, boundaries: Column, most: int, name: str) -> DataFrame:
    """Add how many of a row's own ascending boundaries (an array of at most `most`) lie strictly below its key; NULL for a NULL key."""
    half = 1 << max(0, most.bit_length() - 1)
    found = df.withColumn(name, F.when(key.isNotNull(), F.lit(0)))
    while half:
        further = F.col(name) + half
        # Beyond the end of the array the lookup is NULL, and the position stays.
        found = found.withColumn(name, F.when(key > F.get(boundaries, further - 1), further).otherwise(F.col(name)))
        half //= 2
    return found


def assign_ranges(df: DataFrame, column: str, boundaries: Sequence, chunk: str = "chunk") -> DataFrame:
    """Give each row the number of its range; projections only."""
    key = F.col("`" + column.replace("`", "``") + "`")
    return with_range_index(df, key, boundaries, chunk, df.schema[column].dataType)


def range_coverage(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """How many predicates each row meets; a correct plan gives the single row matches = 1."""
    met = F.lit(0)
    for predicate in predicates:
        met = met + F.coalesce(F.expr(predicate).cast("int"), F.lit(0))
    return df.select(met.alias("matches")).groupBy("matches").agg(F.count("*").alias("rows"))


def range_counts(assigned: DataFrame, chunk: str = "chunk") -> DataFrame:
    """Rows per range (partial counts before the shuffle, so a hot range costs nothing extra)."""
    return assigned.groupBy(chunk).agg(F.count("*").alias("rows"))


def range_skew(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Balance of ranges: count, variation coefficient, largest over average."""
    mean = F.avg("rows")
    return counts.groupBy(*by).agg(
        F.count("*").alias("ranges"),
        F.sum("rows").alias("rows"),
        F.max("rows").alias("max_rows"),
        F.coalesce(F.try_divide(F.stddev_pop("rows"), mean), F.lit(0.0)).alias("variation"),
        F.coalesce(F.try_divide(F.max("rows"), mean), F.lit(0.0)).alias("max_over_avg"),
    )
