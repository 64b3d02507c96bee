"""Streaming forms: capture, latest state, counters, retention, mail, retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from docflow.operators import capture, counters, enrich, latest
from docflow.operators.mail import LEASE_ERROR
from docflow.sources.tables import dead_letter


def _start(df: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).foreachBatch(batch).start()


def _version(path: str, epoch: int) -> str:
    """A batch's own folder, so that a repeated batch replaces what it wrote before."""
    return f"{path}/batch={epoch}"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB; the session's own setting comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def first_of_each(changes: DataFrame) -> DataFrame:
    """Each event_id once, however late or with whatever time it comes again.

    Known ids are state by key, so a batch costs what it brings and reads nothing of what was written. Rows
    with a null or empty event_id cannot be told apart and all stay.
    """
    named = F.coalesce(F.col("event_id") != "", F.lit(False))
    return changes.where(named).dropDuplicates(["event_id"]).unionByName(changes.where(~named))


def stream_changelog(changes: DataFrame, checkpoint: str, path: str, project: str, dead: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Captured changes into the changelog at path, each event_id once.

    A batch is written to a folder of its own; if that fails twice its rows go to `dead`, and the error
    is raised.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        rows = capture.changelog_rows(batch, project)
        rows.persist()
        try:
            for last in (False, True):
                try:
                    rows.write.mode("overwrite").parquet(_version(path, epoch))
                    return
                except Exception as e:
                    if last:
                        if dead:
                            dead_letter(rows, str(e)).write.mode("overwrite").parquet(_version(dead, epoch))
                        raise
        finally:
            rows.unpersist()

    with _state_on_disk(changes.sparkSession):
        return _start(first_of_each(changes), checkpoint, write, trigger=trigger)


def stream_latest(log: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], trigger: dict | None = None) -> StreamingQuery:
    """Each batch's changed documents in their latest state, by timestamp and not by arrival."""
    return _start(latest_late_safe(log), checkpoint, sink, mode="update", trigger=trigger)


def latest_late_safe(log: DataFrame) -> DataFrame:
    """The grouped latest state: a late event never replaces a newer one."""
    return latest.latest_incremental(log)


def stream_updates(shards: DataFrame, checkpoint: str, path: str, trigger: dict | None = None) -> StreamingQuery:
    """What each batch of shards adds to its counters, as counter, leaf, value, reset, batch at path.

    The batch's own conflicts are settled here, by distributed sums; `reset` tells the leaves that it turned
    from a number into an object or back, of which nothing from before may stay. Such a leaf has no value if
    nothing of it is left.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        leaves = counters.shard_leaves(batch)
        turned = counters.overrides(leaves).select("counter", "leaf", F.lit(True).alias("reset"))
        sums = counters.sum_leaves(counters.drop_overridden(leaves))
        rows = sums.join(turned, ["counter", "leaf"], "full_outer").withColumn("reset", F.coalesce("reset", F.lit(False)))
        rows.select("counter", "leaf", "value", "reset", F.lit(epoch).cast("long").alias("batch")).write.mode("overwrite").parquet(_version(path, epoch))

    return _start(shards, checkpoint, write, trigger=trigger)


class CounterState(StatefulProcessor):
    """A counter's leaves as a map; what an update changes is emitted, a leaf that is gone with a null value."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.leaves = handle.getMapState("leaves", "leaf array<string>", "value double")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        for leaf, value in zip(initialState["leaf"], initialState["value"], strict=True):
            self.leaves.updateValue((list(leaf),), (float(value),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        told = pd.concat(list(rows))
        held = {tuple(k[0]): v[0] for k, v in self.leaves.iterator()}
        before = dict(held)
        for _, update in told.groupby("batch", sort=True):
            leaves = [tuple(x) for x in update["leaf"]]
            for leaf, reset in zip(leaves, update["reset"], strict=True):
                if reset:
                    held.pop(leaf, None)
            new = {x for x, v in zip(leaves, update["value"], strict=True) if not pd.isna(v)}
            over = {x[:n] for x in new for n in range(1, len(x))}
            for leaf in [x for x in held if x not in new and (x in over or any(x[:n] in new for n in range(1, len(x))))]:
                del held[leaf]
            for leaf, value in zip(leaves, update["value"], strict=True):
                if not pd.isna(value):
                    held[leaf] = held.get(leaf, 0.0) + value
        changed = [x for x in {*held, *before} if held.get(x) != before.get(x)]
        for leaf in changed:
            if leaf in held:
                self.leaves.updateValue((list(leaf),), (held[leaf],))
            else:
                self.leaves.removeKey((list(leaf),))
        if changed:
            yield pd.DataFrame({"counter": [key[0]] * len(changed), "leaf": [list(x) for x in changed], "value": [held.get(x) for x in changed]}).astype({"value": "float64"})

    def close(self) -> None:
        pass


def stream_counters(updates: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], stored: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Changed leaves (counter, leaf, value) of counters held as state, as updates from `stream_updates` arrive.

    An update has a row for each leaf of a batch, whatever the number of shards, so a counter with most of
    them is little work here; a counter is a document, which bounds its leaves. Updates apply in the order
    of their batches. stored(counter, leaf, value) are the counters to begin with.
    """
    begin = None if stored is None else stored.select("counter", "leaf", "value").groupBy("counter")
    with _state_on_disk(updates.sparkSession):
        out = updates.groupBy("counter").transformWithStateInPandas(statefulProcessor=CounterState(), outputStructType="counter string, leaf array<string>, value double", outputMode="update", timeMode="none", initialState=begin)
        return _start(out, checkpoint, sink, mode="update", trigger=trigger)


class KeepLast(StatefulProcessor):
    """Holds each parent's last n keys; emits the keys that fall out. A null key is the least."""

    def __init__(self, n: int, schema: str, whole: bool, keep_ms: int | None):
        self.n, self.schema, self.whole, self.keep_ms = n, schema, whole, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.keys = handle.getListState("keys", self.schema, self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        held = {r[0] for r in self.keys.get()} if self.keys.exists() else set()
        for batch in rows:
            # A batch with a null has its integers as floats.
            held |= {None if pd.isna(k) else int(k) if self.whole else k for k in batch["key"].tolist()}
        ordered = sorted(held, key=lambda k: (k is not None, k))
        self.keys.put([(k,) for k in ordered[-self.n :]])
        gone = ordered[: -self.n]
        if gone:
            yield pd.DataFrame({"parent": [key[0]] * len(gone), "key": pd.Series(gone, dtype="Int64" if self.whole else "object")})

    def close(self) -> None:
        pass


def _ddl(df: DataFrame, **columns: str) -> str:
    """Fields of the given columns under new names, as a schema."""
    return ", ".join(f"{name} {df.schema[c].dataType.simpleString()}" for name, c in columns.items())


def stream_keep_last_n(children: DataFrame, checkpoint: str, n: int, sink: Callable[[DataFrame, int], None], keep_ms: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """The (parent, key) rows to remove as children(parent, key) arrive; a state of n keys each.

    With keep_ms, the state of a parent that gained no child for so long ends; the children that it has then
    are not counted any more.
    """
    with _state_on_disk(children.sparkSession):
        kept = KeepLast(n, _ddl(children, key="key"), isinstance(children.schema["key"].dataType, T.IntegralType), keep_ms)
        out = children.groupBy("parent").transformWithStateInPandas(statefulProcessor=kept, outputStructType=_ddl(children, parent="parent", key="key"), outputMode="append", timeMode="ProcessingTime" if keep_ms else "none")
        return _start(out, checkpoint, sink, trigger=trigger)


class MailLease(StatefulProcessor):
    """Delivery states of a bucket of mail, with a processing-time timer for what ends first of it.

    A bucket's mail is one value, a table in Arrow form, so that a batch costs a few calls for each bucket and not
    for each mail. Mail that is open stays without an end; its `at` is when its lease ends. Once it is SUCCESS
    or ERROR its `at` is keep_ms later; what is told of it then finds it new.
    """

    def __init__(self, lease_ms: int, keep_ms: int, whole: bool):
        self.lease_ms, self.keep_ms, self.whole = lease_ms, keep_ms, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mail = handle.getValueState("mail", "rows binary")

    def _held(self, now: int) -> dict[object, tuple[str, int, int]]:
        """State, attempts and `at` by id, without mail whose time is over."""
        if not self.mail.exists():
            return {}
        rows = pa.ipc.open_stream(bytes(self.mail.get()[0])).read_all()
        columns = (rows[c].to_pylist() for c in ("id", "state", "attempts", "at"))
        return {i: (s, n, at) for i, s, n, at in zip(*columns, strict=True) if s == "PROCESSING" or at > now}

    def _keep(self, held: dict[object, tuple[str, int, int]], timers: set[int]) -> None:
        """Stores the mail, with one timer in place of `timers`: at the first lease's end, or some time after the first mail's."""
        due = min((at if s == "PROCESSING" else at + self.keep_ms // 8 for s, _, at in held.values()), default=None)
        for old in timers - {due}:
            self.handle.deleteTimer(old)
        if not held:
            self.mail.clear()
            return
        if due not in timers:
            self.handle.registerTimer(due)
        states, attempts, ends = zip(*held.values(), strict=True)
        rows = pa.table({"id": pa.array(list(held)), "state": pa.array(states).dictionary_encode(), "attempts": pa.array(attempts, pa.int32()), "at": pa.array(ends, pa.int64())})
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema) as stream:
            stream.write_table(rows)
        self.mail.update((out.getvalue().to_pybytes(),))

    def _told(self, rows: list[tuple[object, str, int, str | None]]) -> pd.DataFrame:
        ids, states, attempts, errors = zip(*rows, strict=True)
        kind = "Int64" if self.whole else "object"
        return pd.DataFrame({"mail_id": pd.Series(list(ids), dtype=kind), "state": states, "attempts": attempts, "error": pd.Series(list(errors), dtype="object")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = timers.getCurrentProcessingTimeInMs()
        held = self._held(now)
        told = pd.concat(list(rows)).sort_values("seq", kind="stable")
        ids = [None if nameless else i for i, nameless in zip(told["mail_id"].tolist(), told["nameless"].tolist(), strict=True)]
        found: dict[object, tuple[str, int]] = {}
        began = set()
        for i, event in zip(ids, told["event"].tolist(), strict=True):
            state, attempts = found.get(i) or held.get(i, ("PENDING", 0))[:2]
            if event == "retry" and state == "ERROR":
                state = "RETRY"
            if event in ("start", "retry") and state in ("PENDING", "RETRY"):
                state = "PROCESSING"
                began.add(i)
            elif event in ("sent", "failed") and state == "PROCESSING":
                state, attempts = ("SUCCESS" if event == "sent" else "ERROR"), attempts + 1
            found[i] = state, attempts
        changed = {i: r for i, r in found.items() if i in began or r != held.get(i, ("PENDING", 0))[:2]}
        held |= {i: (s, n, now + (self.lease_ms if s == "PROCESSING" else self.keep_ms)) for i, (s, n) in changed.items()}
        self._keep(held, set(self.handle.listTimers()))
        if changed:
            yield self._told([(i, s, n, None) for i, (s, n) in changed.items()])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        held = self._held(now)
        ended = [(i, n) for i, (s, n, at) in held.items() if s == "PROCESSING" and at <= now]
        held |= {i: ("ERROR", n, now + self.keep_ms) for i, n in ended}
        self._keep(held, set())  # the timer that has come goes by itself
        if ended:
            yield self._told([(i, "ERROR", n, LEASE_ERROR) for i, n in ended])

    def close(self) -> None:
        pass


def stream_mail(events: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], lease_ms: int = 60_000, keep_ms: int = 7 * 86_400_000, buckets: int = 1024, trigger: dict | None = None) -> StreamingQuery:
    """Delivery states of mail as events(mail_id, seq, event) arrive: start, sent, failed, retry.

    Mail whose lease runs out while it is PROCESSING becomes an ERROR by a timer, without any
    further event; timers are looked at in each batch, so a stream that is to notice them without new
    events runs with a processing-time trigger. The sink gets each change: mail_id, state, attempts, error.

    The state of mail that is SUCCESS or ERROR ends after keep_ms, so that open mail bounds it; a start or
    retry after that begins anew with no attempts, and whatever else is told changes nothing. State is kept in
    buckets of ids, of which a task holds one at a time with what is told of it. A checkpoint keeps its
    number of buckets.
    """
    with _state_on_disk(events.sparkSession):
        schema = f"{_ddl(events, mail_id='mail_id')}, state string, attempts int, error string"
        whole = isinstance(events.schema["mail_id"].dataType, T.IntegralType)
        # A column with a null would have its integers as floats.
        mail_id = F.coalesce("mail_id", F.lit(0).cast(events.schema["mail_id"].dataType)) if whole else F.col("mail_id")
        dealt = events.select(mail_id.alias("mail_id"), F.col("mail_id").isNull().alias("nameless"), "seq", "event", F.pmod(F.xxhash64("mail_id"), F.lit(buckets)).alias("bucket"))
        kept = MailLease(lease_ms, keep_ms, whole)
        out = dealt.groupBy("bucket").transformWithStateInPandas(statefulProcessor=kept, outputStructType=schema, outputMode="update", timeMode="ProcessingTime")
        return _start(out, checkpoint, sink, mode="update", trigger=trigger)


def uppercase_stream(documents: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], original: str = "original", output: str = "upper", trigger: dict | None = None) -> StreamingQuery:
    """Documents that have the original and lack the result, upper-cased as they are written."""
    return _start(enrich.uppercase_backfill(documents, original, output, per_pass=None), checkpoint, sink, trigger=trigger)


def retry_delay(attempts: int) -> int:
    """Milliseconds before the next attempt: the lesser of 5 seconds and 100 ms times two to the attempts so far."""
    return min(100 * 2**attempts, 5000)


class Requeue(StatefulProcessor):
    """Holds a bucket's failed rows until their delays are over; then they are due, or final if their attempts are used up.

    Rows are put into state and taken out of it together, so that a batch costs a few calls for each bucket.
    """

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"{DEAD}, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = timers.getCurrentProcessingTimeInMs()
        for batch in rows:
            over = batch["attempts"] >= self.most
            if over.any():
                yield self._rows(batch[over], True)
            wait = batch[~over]
            if len(wait):
                due = [now + retry_delay(int(n)) for n in wait["attempts"]]
                self.waiting.appendList([(*r, d) for r, d in zip(wait[["event_id", "payload", "attempts"]].itertuples(index=False, name=None), due, strict=True)])
                for at in set(due):
                    self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = pd.DataFrame([tuple(r) for r in self.waiting.get()] if self.waiting.exists() else [], columns=["event_id", "payload", "attempts", "due"])
        due = held["due"] <= expiredTimerInfo.getExpiryTimeInMs()
        if not due.any():
            return
        rest = held[~due]
        if len(rest):
            self.waiting.put([tuple(r) for r in rest.itertuples(index=False, name=None)])
        else:
            self.waiting.clear()
        yield self._rows(held[due], False)

    @staticmethod
    def _rows(rows: pd.DataFrame, final: bool) -> pd.DataFrame:
        # A dead letter that was read twice is tried once.
        return rows[["event_id", "payload", "attempts"]].drop_duplicates(["event_id", "attempts"]).astype({"attempts": "int32"}).assign(final=final)

    def close(self) -> None:
        pass


DEAD = "event_id string, payload string, attempts int"


def dead_letters(rows: DataFrame, attempts: Column | None = None) -> DataFrame:
    """Failed rows as the retry loop reads them: event_id, all columns as payload, attempts so far."""
    payload = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select("event_id", payload.alias("payload"), (attempts if attempts is not None else F.lit(0)).cast("int").alias("attempts"))


def retry_loop(spark: SparkSession, dead: str, final: str, checkpoint: str, schema: T.StructType, write: Callable[[DataFrame, int], DataFrame | None], most: int = 3, buckets: int = 256, trigger: dict | None = None) -> StreamingQuery:
    """Tries the dead letters in the folder `dead` again, each after its delay, until `most` attempts have failed.

    write(rows, batch) gets the rows that are due, with their attempts so far, and returns those that failed
    again (event_id is enough), or raises, which fails them all; they go back to `dead` with one attempt more. What
    failed for good is in `final`. State is what waits, and nothing else; a bucket of ids, of which a task holds
    one at a time, is a parameter's share of it. A batch that is repeated after a loss calls write again
    with the same number: a sink that replaces what it wrote under a number has each row once.
    """

    def handle(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            batch.where("final").drop("final").write.mode("overwrite").parquet(f"{final}/batch={epoch}")
            due = batch.where("NOT final")
            if due.isEmpty():
                return
            rows = due.select(F.from_json("payload", schema).alias("r"), "attempts").select("r.*", "attempts")
            try:
                failed = write(rows, epoch)
            except Exception:
                failed = rows
            if failed is not None:
                again = due.join(failed.select("event_id").distinct(), "event_id", "left_semi")
                again.select("event_id", "payload", (F.col("attempts") + 1).alias("attempts")).write.mode("overwrite").parquet(f"{dead}/again={epoch}")
        finally:
            batch.unpersist()

    letters = spark.readStream.schema(DEAD).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(dead)
    with _state_on_disk(spark):
        dealt = letters.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(buckets)))
        out = dealt.groupBy("bucket").transformWithStateInPandas(statefulProcessor=Requeue(most), outputStructType=f"{DEAD}, final boolean", outputMode="update", timeMode="ProcessingTime")
        return _start(out, checkpoint, handle, mode="update", trigger=trigger or {"processingTime": "200 milliseconds"})


def until_drained(query: StreamingQuery, seconds: float = 300) -> None:
    """Waits until two batches in a row found nothing new and no state, then stops the stream.

    One is not enough, as a batch may itself have written what the next one reads.
    """
    end = time.monotonic() + seconds
    while query.isActive and time.monotonic() < end:
        last = query.recentProgress[-2:]
        if len(last) == 2 and not any(p["numInputRows"] or s["numRowsTotal"] or s["numRowsRemoved"] for p in last for s in p["stateOperators"]):
            query.stop()
            return
        time.sleep(0.2)
    if e := query.exception():
        raise e
    query.stop()
    raise TimeoutError("the stream still has work")


def quiet_for(df: DataFrame, column: str = "updated_at", interval: str = "30 SECONDS", now: F.Column | None = None) -> DataFrame:
    """Items that were not updated within the interval."""
    return df.where(F.col(column) < (now if now is not None else F.current_timestamp()) - F.expr(f"INTERVAL {interval}"))
