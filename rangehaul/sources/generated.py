"""Generated source tables: each is a projection of a frame with the row number `n` (from 1).

`numbers(spark, rows)` gives such a frame; any frame with a distinct positive number serves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def numbers(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(1, rows + 1).withColumnRenamed("id", "n")


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _upper_md5(text: Column) -> Column:
    return F.upper(F.md5(text))


def _n() -> Column:
    return F.col("n")


def _moment(start: str, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.lit(start).cast("timestamp_ntz"))


def _day(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def _cents(value: Column, decimal: str) -> Column:
    return (value.cast("decimal(18,2)") / F.lit(100)).cast(decimal)


def _seventh() -> Column:
    return (_n().cast("decimal(28,6)") / F.lit(7)).cast("decimal(28,6)")


def small(frame: DataFrame) -> DataFrame:
    """Five columns, one of them text with non-ASCII letters."""
    return frame.select(
        _n().alias("id"),
        _text("Cliente São Paulo ", _n()).alias("name"),
        _cents(_n() % 100000, "decimal(18,2)").alias("amount"),
        _moment("2025-01-01 00:00:00", _n()).alias("updated_at"),
        (_n() % 2 == 1).alias("active"),
    )


def medium(frame: DataFrame) -> DataFrame:
    """Sixteen columns with hashes, decimals, dates and three NULL patterns."""
    n = _n()
    return frame.select(
        n.alias("id"),
        _text("Pedido ação ", n).alias("name"),
        _cents(n % 100000, "decimal(18,2)").alias("amount"),
        _moment("2025-01-01 00:00:00", n).alias("updated_at"),
        (n % 100).cast("int").alias("category"),
        F.when(n % 5 != 0, n % 10000).alias("parent_id"),
        F.repeat(_upper_md5(n.cast("string")), 3).alias("payload"),
        (n % 1000).cast("int").alias("a"),
        (n * 1000).alias("b"),
        _seventh().alias("c"),
        _day("2025-01-01", n % 365).alias("d"),
        _text("Cat-", n % 30).alias("e"),
        (n % 2 == 1).alias("f"),
        F.sqrt(n).alias("g"),
        F.when(n % 3 != 0, F.lit("Informação")).alias("h"),
        F.when(n % 7 != 0, n % 20).cast("int").alias("i"),
    )


def wide(frame: DataFrame, dense_rows: Column | int = 900_000) -> DataFrame:
    """48 columns, 43 of them sparse. Keys are dense up to `dense_rows` and stretched above it."""
    n = _n()
    dense = F.lit(dense_rows) if isinstance(dense_rows, int) else dense_rows
    sparse = [
        F.when(
            (n + 17 * k) % (7 + k % 7) == 0,
            F.concat(F.lit(f"atributo-{k}-"), _upper_md5(F.concat(n.cast("string"), F.lit(f":{k}")))),
        ).alias(f"sparse_{k:02d}")
        for k in range(1, 44)
    ]
    return frame.select(
        F.when(n <= dense, n).otherwise(n * 100 + 1_000_000_000).alias("id"),
        (n % 100).cast("int").alias("category"),
        _moment("2025-01-01 00:00:00", n).alias("updated_at"),
        _seventh().alias("amount"),
        _text("Esparso ", n).alias("label"),
        *sparse,
    )


def _padded(prefix: str, value: Column, digits: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(value.cast("string"), digits, "0"))


# Status texts by n mod 5.
_STATUS = ("NEW", "ACTIVE", "PENDING", "CLOSED", "ERROR")


def oracle_wide(frame: DataFrame) -> DataFrame:
    """48 columns as an Oracle table has them: numbers, padded texts, sparse columns."""
    n = _n()
    start = "2024-01-01 00:00:00"
    days = lambda first, count: F.timestamp_add("DAY", count, F.lit(first).cast("timestamp_ntz"))
    filler = F.char((n % 26 + 65).cast("bigint"))
    text = F.concat(F.lit("deterministic oracle benchmark row "), n.cast("string"), F.lit(" "))
    # The filler differs by row: pad with a long run of it and cut.
    description = F.substring(F.concat(text, F.repeat(filler, 180)), 1, 180)
    every = lambda period, value: F.when(n % period == 0, value)
    return frame.select(
        n.alias("id"),
        (n % 250000 + 1).alias("account_id"),
        (n % 100 + 1).alias("tenant_id"),
        _moment(start, n % 31536000).alias("event_ts"),
        days(start, n % 365).alias("event_date"),
        _cents(n * 7919 % 100000000, "decimal(14,2)").alias("amount"),
        (n % 10000).alias("quantity"),
        ((n % 10000).cast("decimal(12,6)") / F.lit(10000)).cast("decimal(12,6)").alias("rate"),
        F.element_at(F.array(*[F.lit(s) for s in _STATUS]), (n % 5 + 1).cast("int")).alias("status"),
        _padded("category-", n % 50, 2).alias("category"),
        _padded("subcategory-", n % 250, 3).alias("subcategory"),
        F.lit("oracle-local").alias("source_system"),
        _text("region-", n % 8).alias("region"),
        F.lit("BR").alias("country"),
        _padded("city-", n % 500, 3).alias("city"),
        _padded("", n % 99999999, 8).alias("postal_code"),
        _padded("customer-", n, 10).alias("customer_name"),
        F.concat(F.lit("user"), n.cast("string"), F.lit("@example.test")).alias("email"),
        _padded("+55", n % 10000000000, 10).alias("phone"),
        _padded("REF-", n, 12).alias("reference_code"),
        description.alias("description"),
        *[_text(f"a{k:02d}-", n % (999 + k)).alias(f"attr_{k:02d}") for k in range(1, 21)],
        every(10, _text("sparse-", n)).alias("sparse_01"),
        every(20, F.call_function("div", n, F.lit(20))).alias("sparse_02"),
        every(50, days("2020-01-01 00:00:00", n % 1000)).alias("sparse_03"),
        every(100, F.repeat(F.lit("x"), 100)).alias("sparse_04"),
        every(200, ((n % 7).cast("decimal(18,8)") / F.lit(7)).cast("decimal(18,8)")).alias("sparse_05"),
        F.when(n % 2 == 0, 1).otherwise(0).cast("bigint").alias("flag_active"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )
