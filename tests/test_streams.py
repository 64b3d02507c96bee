"""Streams over several runs: state that ends, what a batch writes, and what is tried again."""

import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import counters
from docflow.plans.runs import run_stream
from docflow.streaming import streams


UPDATE = "counter string, leaf array<string>, value double, reset boolean, batch long"


def run_updates(spark, updates, at, out, stored=None):
    """Each leaf's last emitted value."""
    streams.stream_counters(updates, at, lambda b, e: b.withColumn("_b", F.lit(e)).write.mode("overwrite").parquet(f"{out}/b{e}"), stored).awaitTermination()
    return {(r.counter, tuple(r.leaf)): r.value for r in sorted(rows_in(spark, out), key=lambda r: r._b)}


def rows_in(spark, out):
    return [r for r in spark.read.option("recursiveFileLookup", "true").parquet(out).collect()]


def test_counter_batches_follow_the_last_kind_and_emit_only_changes(spark, tmp_path):
    base, out = str(tmp_path / "updates"), str(tmp_path / "out")
    docs = [
        [("c/x/_s_/1", '{"a": 1, "k": 1}'), ("c/y/_s_/1", '{"a": 5}')],
        [("c/x/_s_/2", '{"a": {"b": 2}}'), ("c/x/_s_/3", '{"a": 4}')],  # an object between two numbers: the first number is gone
        [("c/x/_s_/4", '{"a": {"b": 7}}')],
        [("c/x/_s_/5", '{"k": 1}')],
    ]
    run_stream(spark, [spark.createDataFrame(d, "shard_path string, data string").coalesce(1) for d in docs], "parquet", lambda df, sink, at: streams.stream_updates(df, at, base))
    updates = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(base)
    stored = spark.createDataFrame([("c/x", ["k"], 10.0), ("c/z", ["a"], 3.0)], "counter string, leaf array<string>, value double")
    emitted = run_updates(spark, updates, str(tmp_path / "at"), out, stored)
    assert {k: v for k, v in emitted.items() if v is not None} == {("c/x", ("a", "b")): 7.0, ("c/x", ("k",)): 12.0, ("c/y", ("a",)): 5.0}
    assert emitted[("c/x", ("a",))] is None and ("c/z", ("a",)) not in emitted  # gone, and untouched
    sizes = [sum(1 for r in rows_in(spark, out) if r._b == n) for n in {r._b for r in rows_in(spark, out)}]
    assert len(sizes) >= 3 and max(sizes) <= 3  # what changed, and no more


def test_counters_in_state_equal_one_aggregation(spark, tmp_path):
    rng = random.Random(2)
    docs = [f'{{"n": {rng.randrange(9)}, "f": {rng.choice(["2", "{}", "3"]).replace("{}", chr(123) + chr(34) + "g" + chr(34) + ": 1" + chr(125))}}}' for _ in range(60)]
    shards = spark.createDataFrame([(f"c/{i % 2}/_s_/{i:03}", d) for i, d in enumerate(docs)], "shard_path string, data string")
    want = {(r.counter, tuple(r.leaf)): r.value for r in counters.sum_leaves(counters.drop_overridden(counters.shard_leaves(shards))).collect()}
    base, out = str(tmp_path / "updates"), str(tmp_path / "out")
    number = F.substring("shard_path", -3, 3).cast("int")
    parts = [shards.where((number >= lo) & (number < lo + 15)).coalesce(1) for lo in range(0, 60, 15)]
    run_stream(spark, parts, "parquet", lambda df, sink, cp: streams.stream_updates(df, cp, base))
    updates = spark.readStream.schema(UPDATE).option("maxFilesPerTrigger", 1).parquet(base)
    last = run_updates(spark, updates, str(tmp_path / "at"), out)
    assert {k: v for k, v in last.items() if v is not None} == want


@pytest.mark.parametrize("ids", [("long", [1, 2, 3, 4]), ("string", ["a", "b", "c", "d"])])
def test_mail_state_ends_and_ids_keep_their_type(spark, tmp_path, ids):
    kind, (sent, failed, opened, late) = ids
    schema = f"mail_id {kind}, seq int, event string"
    batches = [
        [(sent, 0, "start"), (sent, 1, "sent"), (failed, 0, "start"), (failed, 1, "failed"), (opened, 0, "start")],
        [(late, 0, "start"), (failed, 2, "retry")],
        [(sent, 5, "failed"), (late, 1, "sent")],
    ]
    progress = []

    def start(df, sink, at):
        q = streams.stream_mail(df, at, sink, lease_ms=10_000_000, keep_ms=1)
        progress.append(q)
        return q

    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        rows = run_stream(spark, [spark.createDataFrame(b, schema).coalesce(1) for b in batches], "parquet", start)
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    got = {}
    for r in sorted(rows.collect(), key=lambda r: r._batch):
        got.setdefault(r.mail_id, []).append((r.state, r.attempts))
    assert got == {sent: [("SUCCESS", 1)], failed: [("ERROR", 1), ("PROCESSING", 0)], opened: [("PROCESSING", 0)], late: [("PROCESSING", 0), ("SUCCESS", 1)]}
    # What was told late of ended state changed nothing; open mail has a state and a timer, and what has just closed a state.
    assert progress[-1].lastProgress["stateOperators"][0]["numRowsTotal"] <= 6


def test_mail_of_a_bucket_is_told_apart(spark, tmp_path):
    rng = random.Random(5)
    ids = [None, 2**60 + 1, 2**60, 0, *range(10, 3000)]
    batches = [[(i, n, rng.choice(["start", "sent", "failed", "retry"])) for i in ids for n in range(rng.randrange(4))] for _ in range(3)]
    want, state = [], {}
    for number, batch in enumerate(batches):
        began, before = set(), dict(state)
        for i, _, event in batch:
            s, n = state.get(i, ("PENDING", 0))
            s = "RETRY" if (event, s) == ("retry", "ERROR") else s
            if event in ("start", "retry") and s in ("PENDING", "RETRY"):
                began.add(i)
                s = "PROCESSING"
            elif event in ("sent", "failed") and s == "PROCESSING":
                s, n = "SUCCESS" if event == "sent" else "ERROR", n + 1
            state[i] = s, n
        want += [(i, *r, number) for i, r in state.items() if i in began or r != before.get(i, ("PENDING", 0))]
    progress = []

    def start(df, sink, at):
        progress.append(streams.stream_mail(df, at, sink, lease_ms=10_000_000))
        return progress[-1]

    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        rows = run_stream(spark, [spark.createDataFrame(b, "mail_id long, seq int, event string") for b in batches], "parquet", start).collect()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    number = {b: n for n, b in enumerate(sorted({r._batch for r in rows}))}
    assert sorted(((r.mail_id, r.state, r.attempts, number[r._batch]) for r in rows), key=repr) == sorted(want, key=repr)
    # State is rows and timers of buckets, not of mail.
    assert progress[-1].lastProgress["stateOperators"][0]["numRowsTotal"] <= 2048


def test_trimming_takes_null_keys_and_any_type(spark, tmp_path):
    rows = [[("p", 3), ("p", None), ("p", 1), ("q", 5)], [("p", 2), ("p", 9), ("p", 3)]]
    out = run_stream(spark, [spark.createDataFrame(r, "parent string, key long").coalesce(1) for r in rows], "parquet", lambda df, sink, at: streams.stream_keep_last_n(df, at, 2, sink))
    assert sorted(((r.parent, r.key) for r in out.collect()), key=repr) == sorted([("p", None), ("p", 1), ("p", 2)], key=repr)


def test_events_come_once_with_null_or_changed_times(spark, tmp_path):
    schema = "timestamp timestamp, event_id string, before_path string, after_path string, before string, after string"
    t = F.lit("2024-01-01").cast("timestamp")
    one = spark.createDataFrame([(None, "1", None, "u/1", None, "{}"), (None, "2", None, "u/1", None, "{}"), (None, "", None, "u/1", None, "{}")], schema)
    out = str(tmp_path / "log")
    run_stream(spark, [one.coalesce(1), one.withColumn("timestamp", t).coalesce(1)], "parquet", lambda df, sink, at: streams.stream_changelog(df, at, out, "p"))
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["", "", "1", "2"]


def test_retries_end_and_a_raising_sink_fails_all(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), i) for i in range(12)], "event_id string, v long")
    dead, final, out = (str(tmp_path / x) for x in ("dead", "final", "out"))
    streams.dead_letters(rows).write.parquet(f"{dead}/first")
    calls = []

    def write(due, epoch):
        calls.append(epoch)
        if len(calls) == 1:
            raise RuntimeError("the sink is away")
        bad = F.col("v") == 7
        due.where(~bad).write.mode("overwrite").parquet(f"{out}/batch={epoch}")
        return due.where(bad)

    streams.until_drained(streams.retry_loop(spark, dead, final, str(tmp_path / "at"), rows.schema, write, most=2))
    sent = rows_in(spark, out)
    assert sorted(r.v for r in sent) == [i for i in range(12) if i != 7]
    assert {(r.event_id, r.attempts) for r in spark.read.parquet(final).collect()} == {("7", 2)}
    assert [streams.retry_delay(n) for n in (0, 1, 5, 9)] == [100, 200, 3200, 5000]
