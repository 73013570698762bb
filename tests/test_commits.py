from concurrent.futures import ThreadPoolExecutor

import pytest

from rangehaul.plans.ingest import IngestOptions, ingest
from rangehaul.sinks import snapshots as sink
from rangehaul.sinks.commits import document, documents, put_if_absent
from rangehaul.sinks.ledger import Ledger, RunConflict

OPTIONS = IngestOptions(ranges=2)


def at_once(jobs):
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def test_one_writer_wins(spark, scratch):
    base = scratch()
    assert document(spark, f"{base}/x/1.json") is None and documents(spark, f"{base}/x") == []
    won = at_once([lambda k=k: put_if_absent(spark, f"{base}/x/1.json", f"writer {k}") for k in range(8)])
    assert won.count(True) == 1
    assert document(spark, f"{base}/x/1.json") == f"writer {won.index(True)}"
    assert not put_if_absent(spark, f"{base}/x/1.json", "later") and documents(spark, f"{base}/x") == ["1.json"]


def test_versions_have_no_gaps_and_a_run_has_one(spark, scratch):
    ledger = Ledger(spark, f"{scratch()}/ledger")
    got = at_once([lambda k=k: ledger.commit("t", f"run {k % 4}", [{"path": str(k)}]) for k in range(8)])
    by_run = {}
    for k, (version, rows) in enumerate(got):
        by_run.setdefault(k % 4, set()).add((version, rows[0]["path"]))
    assert all(len(v) == 1 for v in by_run.values())
    assert sorted(version for v in by_run.values() for version, _ in v) == [1, 2, 3, 4]
    assert ledger.commit("t", "older ledger", [], after=9)[0] == 10


def test_claims(spark, scratch):
    ledger = Ledger(spark, f"{scratch()}/ledger")
    assert at_once([lambda: ledger.claim("a/b", {"x": 1})] * 4).count(True) == 1
    with pytest.raises(RunConflict):
        ledger.claim("a/b", {"x": 2})


def test_two_loads_at_once(spark, data, scratch):
    root = f"{scratch()}/lake"
    orders = spark.read.parquet(f"{data}/orders.parquet")
    load = lambda run: ingest(orders, root, run, "orders", "o_orderkey", OPTIONS).first()
    # Two runs of one table.
    assert {r["run_id"] for r in at_once([lambda: load("one"), lambda: load("two")])} == {"one", "two"}
    ledger = Ledger(spark, f"{root}/ledger")
    versions = {r["run_id"]: r["version"] for r in ledger.read("snapshots").collect()}
    assert sorted(versions.values()) == [1, 2]
    # One run twice.
    at_once([lambda: load("three")] * 2)
    found = sink.snapshot_rows(ledger, "three").collect()
    assert {r["version"] for r in found} == {3} and sum(r["rows"] for r in found) == orders.count()
    assert sink.read_snapshot(ledger, "three").count() == orders.count()
