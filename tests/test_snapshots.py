"""Refreshes and appends that touch only what changed."""

import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import latest
from docflow.sources.buckets import BucketTable
from docflow.sources.snapshots import Snapshot, append_once

LOG = "document_name string, event_id string, t string, operation string, data string"


def log(spark, rows):
    return spark.createDataFrame(rows, LOG).withColumn("timestamp", F.col("t").cast("timestamp")).drop("t")


def state(df):
    return sorted((r.document_name, r.event_id, r.data) for r in df.collect())


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_three_refreshes_equal_one_run_and_touch_little(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"d{rng.randrange(60)}", f"e{i:04}", rng.choice([None, f"2024-01-{rng.randrange(1, 28):02}"]), rng.choice(["CREATE", "UPDATE", "DELETE"]), str(i)) for i in range(400)]
    few = [("d1", "e9001", "2024-02-01", "UPDATE", "new"), ("d2", "e9002", "2023-01-01", "UPDATE", "late"), ("d3", "e9003", "2024-02-01", "DELETE", None)]
    parts = [rows[:250], rows[250:], few, [("d3", "e9004", "2024-01-15", "UPDATE", "late, of a deleted one")]]
    shot = Snapshot(spark, str(tmp_path / "log"), str(tmp_path / "shot"), buckets=16)
    before = {}
    for n, part in enumerate(parts):
        log(spark, part).repartition(2).write.mode("append").parquet(str(tmp_path / "log"))
        told = shot.refresh()
        names = [r.document_name for r in shot.table.read().select("document_name").collect()]
        assert len(names) == len(set(names))
        now = files(tmp_path / "shot" / "latest" / "data")
        at = shot.table.manifest()
        used = {f for f in now if any(f.startswith(f"version={v}/_bucket={b}/") for b, v in at.items())}
        if n == 2:
            assert told["buckets"] <= 3 and told["files"] <= 2
            assert len({b for b, v in at.items() if v == 3}) == told["buckets"]
            assert all(now[f] == before[f] for f in used if not f.startswith("version=3/"))
        before = now
    every = log(spark, [r for p in parts for r in p])
    assert state(shot.read()) == state(latest.latest_materialized(every))
    assert "d3" not in {r.document_name for r in shot.read().collect()}
    assert shot.refresh() == {"files": 0, "buckets": 0}
    assert state(shot.read()) == state(latest.latest_materialized(every))


def test_a_refresh_that_broke_off_is_done_again(spark, tmp_path):
    shot = Snapshot(spark, str(tmp_path / "log"), str(tmp_path / "shot"), buckets=4)
    log(spark, [("a", "1", "2024-01-01", "CREATE", "x")]).coalesce(1).write.parquet(str(tmp_path / "log"))
    merge = BucketTable.merge
    BucketTable.merge = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            shot.refresh()
    finally:
        BucketTable.merge = merge
    assert shot.read() is None and shot.stale("1 HOUR")
    assert shot.refresh() == {"files": 1, "buckets": 1}
    assert state(shot.read()) == [("a", "1", "x")]


def test_staleness_decides(spark, tmp_path):
    shot = Snapshot(spark, str(tmp_path / "log"), str(tmp_path / "shot"), buckets=4)
    log(spark, [("a", "1", "2024-01-01", "CREATE", "x")]).coalesce(1).write.parquet(str(tmp_path / "log"))
    assert shot.refresh_if_stale("1 HOUR") == {"files": 1, "buckets": 1}
    log(spark, [("a", "2", "2024-01-02", "UPDATE", "y")]).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    assert shot.refresh_if_stale("1 HOUR") is None and state(shot.read()) == [("a", "1", "x")]
    assert shot.refresh_if_stale("1 HOUR", now=F.lit("2999-01-01").cast("timestamp"))["files"] == 1
    assert state(shot.read()) == [("a", "2", "y")]


def test_old_versions_go(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "k", 2)
    for n in range(6):
        table.merge(spark.createDataFrame([(str(n % 3), n)], "k string, v long"), lambda new, old: new if old is None else old.unionByName(new))
    assert sorted(r.v for r in table.read().collect()) == list(range(6))
    assert len(list((tmp_path / "t" / "manifest").glob("version=*"))) == 3
    assert len(list((tmp_path / "t" / "data").glob("version=*/_bucket=*"))) <= 2 * 3


def test_events_are_appended_once_whatever_their_time(spark, tmp_path):
    path = str(tmp_path / "log")
    first = log(spark, [("a", "1", None, "CREATE", "x"), ("a", "2", "2024-01-01", "UPDATE", "y"), ("a", "2", "2024-01-01", "UPDATE", "y"), ("a", "", None, "IMPORT", "i"), ("a", None, None, "IMPORT", "n")])
    assert append_once(first, path, 1, 8).count() == 4
    again = log(spark, [("a", "1", "2024-05-05", "CREATE", "x"), ("a", "2", None, "UPDATE", "y"), ("b", "3", None, "CREATE", "z"), ("a", "", None, "IMPORT", "i")])
    assert sorted(r.event_id for r in append_once(again, path, 2, 8).collect()) == ["", "3"]
    assert sorted(r.event_id for r in append_once(again, path, 2, 8).collect()) == ["", "3"]  # the batch repeated
    assert spark.read.parquet(path).count() == 6


def test_an_append_reads_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "log")
    append_once(log(spark, [("a", str(i), None, "CREATE", "x") for i in range(500)]), path, 1, 32)
    before = BucketTable(spark, f"{path}/_ids", "event_id", 32).manifest()
    append_once(log(spark, [("a", "7", None, "CREATE", "x"), ("a", "new", None, "CREATE", "x")]), path, 2, 32)
    after = BucketTable(spark, f"{path}/_ids", "event_id", 32).manifest()
    assert len(before) == 32 and sum(before[b] != after[b] for b in before) == 1
