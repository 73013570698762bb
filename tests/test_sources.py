import glob
import hashlib
import json
import math
import os
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from rangehaul.functions.types import SourceColumn as C
from rangehaul.operators import ranges as R
from rangehaul.sources import generated as G, jdbc as J
from rangehaul.sources.arrow import read_arrow_ranges, scan_row_groups
from rangehaul.sources.files import as_objects, file_inventory, file_schemas, load_runs, output_stats, row_groups

# --- JDBC: no database is started here, so what reaches Spark's reader is checked ---


class Reader:
    def jdbc(self, url, table, **arguments):
        self.call = (url, table, arguments)
        return self


class Session:
    def __init__(self):
        self.read = Reader()


def source(**values):
    return J.JdbcTable("jdbc:x://h/d", "org.x.Driver", "dbo", "big]table", **values)


def test_jdbc_ranges(monkeypatch):
    monkeypatch.setenv("SOURCE_USER", "u")
    monkeypatch.setenv("SOURCE_PASSWORD", "secret")
    session = Session()
    J.read_ranges(session, source(), ["[id] < 5", "[id] >= 5"], [C("id", "bigint"), C("t", "tinyint")], 5000)
    url, table, arguments = session.read.call
    assert table == "(SELECT [id], CAST([t] AS smallint) AS [t] FROM [dbo].[big]]table]) source_rows"
    assert arguments["predicates"] == ["[id] < 5", "[id] >= 5"]
    options = arguments["properties"]
    assert options["fetchsize"] == "5000" and options["preferTimestampNTZ"] == "true" and options["user"] == "u"
    J.read_single(session, source())
    assert session.read.call[2]["predicates"] == ["1=1"] and session.read.call[1].startswith("(SELECT * FROM")


def test_oracle_snapshot_is_shared(monkeypatch):
    monkeypatch.setenv("SOURCE_USER", "u")
    monkeypatch.setenv("SOURCE_PASSWORD", "p")
    session, table = Session(), source(dialect="oracle", snapshot=123456)
    assert table.relation().endswith("AS OF SCN 123456) source_rows")
    J.read_bounds(session, table, "ID")
    assert 'MIN("ID")' in session.read.call[1] and "AS OF SCN 123456" in session.read.call[1]
    with pytest.raises(ValueError):
        source(snapshot=1).relation()


def test_credentials_come_from_the_environment(monkeypatch):
    monkeypatch.delenv("SOURCE_USER", raising=False)
    monkeypatch.setenv("SOURCE_PASSWORD", "p")
    with pytest.raises(ValueError, match="SOURCE_USER"):
        source().properties()
    assert "secret" not in repr(source())


def test_catalogs(monkeypatch):
    monkeypatch.setenv("SOURCE_USER", "u")
    monkeypatch.setenv("SOURCE_PASSWORD", "p")
    assert set(J.catalog(Session(), source())) >= {"columns", "types", "indexes", "index_columns", "stats", "stats_columns", "partition_stats"}
    session = Session()
    J.catalog(session, J.JdbcTable("u", "d", "O'NEIL", "t", dialect="oracle"))
    assert "O''NEIL" in session.read.call[1]


# --- Arrow ranges ---


def test_range_source_reads_each_row_once(spark, scratch):
    path = scratch().replace("file:", "")
    frame = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), F.col("id").cast("string").alias("v"))
    frame.repartition(3).write.parquet(path)
    points = spark.createDataFrame([("t", "k", 250), ("t", "k", 700)], "table string, column string, boundary bigint")
    predicates = [r["predicate"] for r in R.range_predicates(points, True).orderBy("chunk").collect()]
    read = read_arrow_ranges(spark, "tests.range_reader:batches", predicates, frame.schema, data=path)
    assert read.rdd.getNumPartitions() == 3
    assert read.exceptAll(frame).isEmpty() and frame.exceptAll(read).isEmpty()


def test_row_group_scan(spark, scratch):
    path = scratch()
    frame = spark.range(5000).select("id", F.current_date().alias("d"), (F.col("id") / 3).cast("decimal(20,4)").alias("x"), F.array("id").alias("v"))
    frame.repartition(3).write.option("parquet.block.size", 4096).parquet(path)
    inventory = file_inventory(spark, path)
    groups = row_groups(inventory)
    assert groups.agg(F.sum("num_rows").alias("n")).first()["n"] == 5000 and groups.count() >= 3
    read = scan_row_groups(groups, frame.schema, batch_rows=100)
    assert read.exceptAll(frame).isEmpty() and read.count() == 5000
    assert scan_row_groups(groups, frame.schema, ["id"]).columns == ["id"]


def test_inventory_footers_and_stats(spark, scratch):
    path = scratch()
    spark.range(10).write.parquet(f"{path}/a")
    spark.range(7).selectExpr("CAST(id AS INT) AS id", "'x' AS s").write.parquet(f"{path}/b")
    spark.range(3).write.parquet(f"{path}/_delta_log/c")
    spark.range(3).write.parquet(f"{path}/_dlt_loads/c")
    spark.range(3).write.json(f"{path}/d")
    inventory = file_inventory(spark, path)
    kept = {r["path"].rsplit("/", 2)[-2] for r in inventory.collect()}
    assert kept == {"a", "b"}
    schemas = {(r["path"].rsplit("/", 2)[-2], r["column"], r["type"]) for r in file_schemas(inventory).collect()}
    assert schemas == {("a", "id", "int64"), ("b", "id", "int32"), ("b", "s", "string")}
    rows = file_schemas(inventory).filter("column = 'id'").agg(F.sum("num_rows").alias("n")).first()["n"]
    assert rows == 17
    stats = output_stats(spark, f"{path}/a").first()
    sizes = [os.path.getsize(f) for f in glob.glob(f"{path.replace('file:', '')}/a/*.parquet")]
    assert (stats["files"], stats["bytes"]) == (len(sizes), sum(sizes))
    local = spark.createDataFrame([("s3a://lake/t/x.parquet", 5)], "path string, size bigint")
    assert tuple(as_objects(local).first()) == ("lake", "t/x.parquet", 5)


def test_run_documents(spark, tmp_path):
    def put(name, **values):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps(values, indent=2))

    put("runs/a.json", run_id="a", table="t", rows=5, durations_seconds={"read_write": 1.5}, plan={"strategy": "single_scan"})
    put("runs/b.failed.json", run_id="b")
    put("runs/c.json", run_id="site-smoke")
    put("runs/d.json", run_id="verification-1")
    put("runs/h.json", run_id="orders-smoke")
    put("runs/notes.txt", run_id="text")
    put("runs-direct/e.json", run_id="e", engine="direct", extract_backend="columnar")
    put("runs-direct/f.json", run_id="f", engine="direct")
    put("runs-direct/g.json", run_id="g", read_mode="arrow")
    runs = load_runs(spark, [str(tmp_path / "runs"), str(tmp_path / "runs-direct")], multiline=True, excluded_ids=["site-smoke"], excluded_prefixes=["verification-"])
    got = {r["run_id"]: (r["engine"], r["read_mode"]) for r in runs.collect()}
    assert got == {"a": ("spark", "jdbc"), "orders-smoke": ("spark", "jdbc"), "e": ("direct", "columnar"), "f": ("direct", "unknown"), "g": ("spark", "arrow")}
    row = runs.filter("run_id = 'a'").first()
    assert row["durations_seconds"] == {"read_write": 1.5} and row["plan"]["strategy"] == "single_scan"


# --- generated tables ---


def test_generated_rows(spark):
    rows = {r["id"]: r for r in G.medium(G.numbers(spark, 40)).collect()}
    assert len(rows) == 40
    n = 35
    digest = hashlib.md5(str(n).encode()).hexdigest().upper()
    row = rows[n]
    assert row["name"] == "Pedido ação 35" and row["amount"] == Decimal("0.35") and row["payload"] == digest * 3
    assert row["updated_at"] == datetime(2025, 1, 1) + timedelta(seconds=n) and row["parent_id"] is None and row["i"] is None
    assert row["h"] == "Informação" and row["g"] == math.sqrt(n) and rows[36]["h"] is None
    assert rows[36]["c"] == (Decimal(36) / 7).quantize(Decimal("0.000001"), ROUND_HALF_UP)


def test_generated_keys_are_skewed(spark):
    frame = G.wide(G.numbers(spark, 1000), 900)
    assert len(frame.columns) == 48
    assert frame.agg(F.max("id").alias("m")).first()["m"] == 1000000000 + 100 * 1000
    assert frame.filter("id <= 900").count() == 900
    row = frame.filter("id = 7").first()
    assert (row["sparse_01"] is not None) == ((7 + 17) % 8 == 0)
    assert row["sparse_01"] == "atributo-1-" + hashlib.md5(b"7:1").hexdigest().upper()


def test_generated_oracle_columns(spark):
    frame = G.oracle_wide(G.numbers(spark, 200))
    assert len(frame.columns) == 48
    row = frame.filter("id = 200").first()
    assert row["postal_code"] == "00000200" and row["reference_code"] == "REF-000000000200" and row["status"] == "NEW"
    assert row["description"] == "deterministic oracle benchmark row 200 ".ljust(180, chr(65 + 200 % 26))
    assert row["sparse_02"] == 10 and row["sparse_05"] == (Decimal(200 % 7) / 7).quantize(Decimal("0.00000001"), ROUND_HALF_UP)
    assert frame.schema["rate"].dataType.simpleString() == "decimal(12,6)"
