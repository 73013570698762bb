"""From a table's name to its ranges, with frames in the place of the database."""

import pytest
from pyspark.sql import functions as F, types as T

from rangehaul.functions.sizing import PartitionLimits, cluster_limits, planned_ranges
from rangehaul.functions.types import SourceColumn, UnsupportedType
from rangehaul.operators.profile import column_histogram
from rangehaul.plans import ingest as I
from rangehaul.plans.ingest import IngestOptions
from rangehaul.plans.jdbc_load import ingest_table, plan_table
from rangehaul.sources import catalog as C
from rangehaul.sources.jdbc import JdbcTable

SERVER = JdbcTable("jdbc:x", "org.x.Driver", "dbo", "orders")
ORACLE = JdbcTable("jdbc:x", "org.x.Driver", "APP", "ORDERS", dialect="oracle")
LIMITS = PartitionLimits(max_connections=4, task_slots=4)


class Database:
    """Answers query texts with frames and remembers them."""

    def __init__(self, spark, answers):
        self.spark, self.answers, self.asked = spark, answers, []

    def __call__(self, text):
        self.asked.append(text)
        found = next(answer for part, answer in self.answers.items() if part in text)
        if isinstance(found, Exception):
            raise found
        return found


def server(spark, source, **changed):
    """The catalog of `orders` as SQL Server shows it, with a few numbers as text or bit."""
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    steps = column_histogram(source, "o_orderkey", 20)
    low, high = source.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    answers = {
        "OBJECT_ID(": make([(77,)], "object_id int"),
        "sys.dm_db_stats_histogram(77, 1)": steps.select(F.lit(1).alias("step_number"), F.col("high").cast("string"), "range_rows", "equal_rows"),
        "TOP (1)": make([(str(low), str(high))], "low string, high string"),
        "COUNT_BIG": make([(source.count(),)], "exact_rows bigint"),
        "sys.columns": make([(77, i + 1, c, k, 0 if c != "o_orderkey" else 1, 19, 2, 8) for i, (c, k) in enumerate([("o_orderkey", 127), ("o_custkey", 127), ("o_totalprice", 62)])], "table int, column_id int, column string, type_id int, nullable int, precision int, scale int, max_length int"),
        "sys.types": make([(127, "bigint"), (62, "float")], "type_id int, sql_type string"),
        "sys.index_columns": make([(77, 1, 1, 1)], "table int, index_id int, column_id int, key_ordinal int"),
        "sys.indexes": make([(77, 1, 1, 1, 1, 0, 0, 0)], "table int, index_id int, index_type int, is_unique int, primary_key int, disabled int, hypothetical int, filtered int"),
        "sys.stats_columns": make([(77, 1, 1, 1), (77, 9, 2, 1)], "table int, stats_id int, column_id int, stats_column_id int"),
        "sys.stats": make([(77, 1, 0), (77, 9, 0)], "table int, stats_id int, filtered int"),
        "sys.dm_db_partition_stats": make([(77, 1, 1000, 1 << 17)], "table int, index_id int, row_count bigint, used_page_count bigint"),
        "sys.partitions": make([(77, 1, 1 << 27)], "table int, index_id int, row_count bigint"),
    }
    return Database(spark, {**answers, **changed})


@pytest.fixture
def source(spark, data):
    return spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))


def test_query_texts():
    odd = JdbcTable("u", "d", "dbo", "o'brien]s")
    assert C.object_query(odd) == "SELECT OBJECT_ID(N'[dbo].[o''brien]]s]', 'U') AS object_id"
    assert C.of_object("stats", 5).endswith("FROM sys.stats WHERE object_id = 5")
    assert "is_user_defined = 0" in C.of_object("types", 5) and "object_id" not in C.of_object("types", 5)
    assert "CONVERT(nvarchar(128), range_high_key) AS high" in C.histogram_query(5, 2, "bigint")
    assert "CAST(range_high_key AS datetime2), 126)" in C.histogram_query(5, 2, "date")
    assert "CONVERT(nvarchar(128), range_high_key, 3)" in C.histogram_query(5, 2, "float")
    assert C.histogram_query(5, 2, "int").endswith("sys.dm_db_stats_histogram(5, 2)")
    seek = C.bounds_query(SERVER, SourceColumn("k]", "money"))
    assert seek.count("TOP (1)") == 2 and "CONVERT(nvarchar(128), [k]]], 2)" in seek and "[k]]] IS NOT NULL ORDER BY [k]]] DESC" in seek
    at = JdbcTable("u", "d", "APP", "T", dialect="oracle", snapshot=9)
    assert "AS OF SCN 9" in C.bounds_query(at, SourceColumn("K", "int")) and "AS OF SCN 9" in C.count_query(at)
    assert C.of_name("tables", ORACLE).endswith("WHERE owner = 'APP' AND table_name = 'ORDERS'")
    assert C.of_name("constraints", JdbcTable("u", "d", "A'", "t'", dialect="oracle")).endswith("owner = 'A''' AND constraint_type = 'P' AND table_name = 't'''")


def test_text_keys_become_typed(spark):
    cases = {
        ("bigint", None, None): (["-9", "9007199254740993"], [-9, 9007199254740993]),
        ("decimal", 20, 3): (["1.5", "12345678901234567.891"], ["1.500", "12345678901234567.891"]),
        ("money", None, None): (["1.2345"], ["1.2345"]),
        ("float", None, None): (["1.2345678901234567e+003"], [1234.5678901234567]),
        ("date", None, None): (["2024-02-29T00:00:00"], ["2024-02-29"]),
        ("datetime2", None, None): (["2024-02-29T13:14:15.1234567", "1753-01-01T00:00:00"], ["2024-02-29 13:14:15.123456", "1753-01-01 00:00:00"]),
    }
    for (kind, precision, scale), (texts, values) in cases.items():
        rows = [(t, 1.0, None) for t in texts] + [(None, None, 4.0)]
        typed = C.typed_steps(spark.createDataFrame(rows, "high string, range_rows double, equal_rows double"), C.key_type(kind, precision, scale))
        found = typed.select(F.col("high").cast("string"), "range_rows", "equal_rows").collect()
        assert [tuple(r) for r in found] == [(str(v), 1.0, 0.0) for v in values] + [(None, 0.0, 4.0)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        C.typed_steps(spark.createDataFrame([("x", 1.0, 1.0)], "high string, range_rows double, equal_rows double"), T.LongType()).collect()
    with pytest.raises(ValueError):
        C.key_type("nvarchar", None, None)


def test_name_to_plan(spark, source):
    database = server(spark, source)
    planned = plan_table(spark, SERVER, LIMITS, database, count_rows=True)
    plan = planned.plan
    assert plan.strategy == "histogram_ranges" and plan.column == "o_orderkey" and plan.ranges == 4 and planned.warnings == ()
    assert plan.source_rows == source.count() and planned.fetch > 0
    assert plan.predicates[0].startswith("([o_orderkey] < ") and plan.predicates[0].endswith("IS NULL)")
    assert [c.name for c in planned.columns] == ["o_orderkey", "o_custkey", "o_totalprice"]
    # The key's own statistic, and no other table's rows.
    assert all("object_id = 77" in t for t in database.asked if " FROM sys." in t and "sys.types" not in t and "histogram" not in t)
    assert not any("TOP (1)" in t for t in database.asked)
    # The same as from the frames themselves.
    steps = column_histogram(source, "o_orderkey", 20)
    rows = source.withColumn("_r", F.expr(plan.predicates[1].replace("[", "`").replace("]", "`"))).filter("_r").count()
    assert abs(rows - source.count() / 4) <= source.count() / 20 + 2
    assert steps.count() >= 20


def test_fallbacks(spark, source):
    denied = RuntimeError("permission denied")
    no_histogram = plan_table(spark, SERVER, LIMITS, server(spark, source, **{"sys.dm_db_stats_histogram(77, 1)": denied}))
    assert no_histogram.plan.strategy == "indexed_ranges" and no_histogram.plan.ranges == 4 and "histogram" in no_histogram.warnings[0]
    empty = spark.createDataFrame([], "step_number int, high string, range_rows double, equal_rows double")
    assert plan_table(spark, SERVER, LIMITS, server(spark, source, **{"sys.dm_db_stats_histogram(77, 1)": empty})).plan.strategy == "indexed_ranges"
    nothing = spark.createDataFrame([(None, None)], "low string, high string")
    alone = plan_table(spark, SERVER, LIMITS, server(spark, source, **{"sys.dm_db_stats_histogram(77, 1)": empty, "TOP (1)": nothing}))
    assert alone.plan.strategy == "single_scan" and len(alone.warnings) == 2
    widths = plan_table(spark, SERVER, LIMITS, server(spark, source, **{"sys.dm_db_partition_stats": denied}))
    assert widths.plan.ranges == 4 and "page counts" in widths.warnings[0]
    small = server(spark, source, **{"sys.dm_db_partition_stats": spark.createDataFrame([(77, 1, 5, 1)], "table int, index_id int, row_count bigint, used_page_count bigint")})
    assert plan_table(spark, SERVER, LIMITS, small).plan.predicates == ("1=1",)
    assert not any("histogram" in t or "TOP" in t for t in small.asked)
    with pytest.raises(C.TableNotFound):
        plan_table(spark, SERVER, LIMITS, server(spark, source, **{"OBJECT_ID(": spark.createDataFrame([(None,)], "object_id int")}))


def test_a_type_without_a_rule_is_refused_by_name(spark, source, scratch):
    database = server(spark, source, **{"sys.types": spark.createDataFrame([(127, "bigint")], "type_id int, sql_type string")})
    with pytest.raises(UnsupportedType, match="o_totalprice"):
        ingest_table(spark, SERVER, scratch(), "r", IngestOptions(), database, lambda planned, predicates: source)


def test_load_by_name(spark, source, scratch):
    calls = []

    def read(planned, predicates):
        calls.append(predicates)
        spoken = [p.replace("[", "`").replace("]", "`") for p in predicates]
        narrow = source.withColumn("o_custkey", F.col("o_custkey").cast("int"))
        parts = [narrow.filter(p).coalesce(1) for p in spoken]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return whole

    root = scratch()
    run = ingest_table(spark, SERVER, root, "r", IngestOptions(limits=LIMITS), server(spark, source), read).first()
    assert run["rows"] == run["source_rows"] == source.count() and run["partitions"] == 4
    copy = I.sink.read_snapshot(I.Ledger(spark, f"{root}/ledger"), "r")
    # Types are the source's, whatever the reader brought.
    assert dict(copy.dtypes)["o_custkey"] == "bigint" and copy.exceptAll(source).isEmpty()
    # A count that does not fit is found.
    with pytest.raises(I.ContentMismatch):
        ingest_table(spark, SERVER, scratch(), "r", IngestOptions(limits=LIMITS), server(spark, source, COUNT_BIG=spark.createDataFrame([(3,)], "exact_rows bigint")), read)


def oracle(spark, source, scn, rows=10**7):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    low, high = source.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return Database(spark, {
        "GET_SYSTEM_CHANGE_NUMBER": make([(scn,)], "scn bigint"),
        "all_tables": make([("ORDERS", rows, 200, 10)], "table string, num_rows bigint, avg_row_len int, blocks bigint"),
        "all_tab_columns": make([("ORDERS", 1, "o_orderkey", "NUMBER", "N", 12, 0, 22, 6), ("ORDERS", 2, "o_custkey", "NUMBER", "Y", 12, 0, 22, 6), ("ORDERS", 3, "o_totalprice", "BINARY_DOUBLE", "Y", None, None, 8, 8)], "table string, column_id int, column string, data_type string, nullable string, precision int, scale int, data_length int, avg_col_len int"),
        "all_ind_columns": make([("ORDERS", "PK", "o_orderkey", 1)], "table string, index_name string, column string, key_ordinal int"),
        "all_indexes": make([("ORDERS", "PK", "UNIQUE", "VALID", "NORMAL")], "table string, index_name string, uniqueness string, status string, index_type string"),
        "all_constraints": make([("ORDERS", "PK", "P")], "table string, index_name string, constraint_type string"),
        "MIN(": make([(low, high)], "low bigint, high bigint"),
        "COUNT(*)": make([(source.count(),)], "exact_rows bigint"),
    })


def test_oracle_snapshot_is_captured_and_kept(spark, source, scratch, monkeypatch):
    root, seen = scratch(), []

    def read(planned, predicates):
        seen.append(planned.table.snapshot)
        parts = [source.filter(p.replace('"', "`")).coalesce(1) for p in predicates]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return whole

    options = IngestOptions(limits=LIMITS)
    first = oracle(spark, source, 500)
    monkeypatch.setattr(I, "_publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest_table(spark, ORACLE, root, "r", options, first, read)
    monkeypatch.undo()
    assert any("AS OF SCN 500" in t and "MIN(" in t for t in first.asked) and any("AS OF SCN 500" in t and "COUNT(" in t for t in first.asked)
    later = oracle(spark, source, 900)
    run = ingest_table(spark, ORACLE, root, "r", options, later, read).first()
    assert run["rows"] == source.count() and run["strategy"] == "indexed_ranges" and set(seen) == {500}
    assert not any("GET_SYSTEM" in t for t in later.asked) and any("AS OF SCN 500" in t for t in later.asked)
    uncounted = plan_table(spark, ORACLE, LIMITS, oracle(spark, source, 1, rows=None))
    assert "counted" in uncounted.warnings[0]


def test_cluster_limits():
    assert planned_ranges(10**13, cluster_limits(1000)) == 4000
    assert planned_ranges(10**13, cluster_limits(1000, connections=16)) == 16
    assert planned_ranges(300 << 20, cluster_limits(1000)) == 2 and planned_ranges(0, cluster_limits(8)) == 1
