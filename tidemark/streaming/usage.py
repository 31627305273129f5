"""Counters, latency histograms, rate limits and quotas.  Each works on a table or on a stream."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.ordering import number_rows, slice_rows

# fixed values: upper bounds of the latency buckets in milliseconds
BUCKETS = (1, 5, 15, 50, 100, 200, 300, 400, 500)


def _timed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def request_counters(events: DataFrame, window: str = "1 hour") -> DataFrame:
    """Requests (ts, name, status) per window, name and status."""
    return (
        _timed(events).groupBy(F.window("ts", window), "name", "status").agg(F.count(F.lit(1)).alias("requests"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "name", "status", "requests")
    )


def latency_histogram(
    events: DataFrame, by: Sequence[str], window: str = "1 hour", buckets: Sequence[float] = BUCKETS,
) -> DataFrame:
    """Cumulative bucket counts of `latency` (ms) per window and label set, with sum and count."""
    le = [F.count(F.when(F.col("latency") <= b, 1)).alias(f"le_{b:g}") for b in buckets]
    out = _timed(events).groupBy(F.window("ts", window), *by).agg(
        *le, F.count("latency").alias("le_inf"), F.sum("latency").alias("latency_sum"),
        F.count("latency").alias("latency_count"))
    return out.select(
        F.col("window.start").alias("window_start"), *by, *[f"le_{b:g}" for b in buckets], "le_inf", "latency_sum",
        "latency_count")


def partial_counts(
    stream: DataFrame, path: str, checkpoint: str, count: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Write `count(batch)` of every micro-batch to a folder of its own; a repeated batch writes the same folder.

    Counts and sums of batches add up, so no state is kept, open windows are there at once and a row is
    never too late.
    """

    def write(batch: DataFrame, run: int) -> None:
        count(batch).write.mode("overwrite").parquet(f"{path}/run={run}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged_counts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up the partial counts of all batches; every column but `keys` is a count or a sum."""
    sums = [c for c in parts.columns if c not in (*keys, "run")]
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


# ---- sliding log -----------------------------------------------------------------------------

def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000.0)


class _Log:
    """The times of the recorded hits of one key, oldest first."""

    def __init__(self, times: Sequence[float], max_requests: int, window_s: float):
        self.times, self.max_requests, self.window_s = deque(times), max_requests, window_s

    def hit(self, now: float) -> bool:
        while self.times and self.times[0] <= now - self.window_s:
            self.times.popleft()
        allowed = len(self.times) < self.max_requests
        if allowed:
            self.times.append(now)
        return allowed


def _walked(sliced: DataFrame, starts: dict[int, list[float]], max_requests: int, window_s: float, kept: list[str] | None,
            schema: str) -> DataFrame:
    """Read each slice in order, its first key from the log `starts` gives it.

    With `kept`, these columns and `allowed` of every row; else one row per slice: its first and last key, whether it
    holds one key only, and the log at its end.
    """
    ordered = sliced.repartition("_ord_slice").sortWithinPartitions("_ord_slice", "key", "_t", "id")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = first = key = log = None
        single = True

        def end() -> pa.RecordBatch:
            row = {"_ord_slice": at, "first": first, "last": key, "single": single, "log": list(log.times)}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("_ord_slice", pa.int32()), ("first", kind), ("last", kind), ("single", pa.bool_()), ("log", pa.list_(pa.float64()))]))

        for batch in batches:
            kind, allowed = batch.schema.field("key").type, []
            for now_at, now_key, now in zip(*(batch.column(c).to_pylist() for c in ("_ord_slice", "key", "_t"))):
                if now_at != at:
                    if at is not None and kept is None:
                        yield end()
                    at, first, key, single = now_at, now_key, now_key, True
                    log = _Log(starts.get(at, ()), max_requests, window_s)
                elif now_key != key:
                    key, single, log = now_key, False, _Log((), max_requests, window_s)
                allowed.append(log.hit(now))
            if kept is not None:
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in kept], pa.array(allowed, pa.bool_())], names=[*kept, "allowed"])
        if at is not None and kept is None:
            yield end()

    return ordered.mapInArrow(walk, schema)


def rate_limit(events: DataFrame, max_requests: int, window_s: float, slices: int | None = None) -> DataFrame:
    """Add `allowed` by a sliding log per key (key, ts, id); blocked hits are not recorded.

    The hits are dealt out once by ranges of (key, time).  A key that began in an earlier slice needs the log at
    the end of the slice before.  All slices are walked from an empty log first; then the logs found are
    passed on, and the slices inside one key, whose end may change with their start, are walked again at the same
    time until no start changes.  Logs forget what is older than the window, so a few rounds do for most
    data; a key whose hits stay in step for ever takes a round per slice, no longer than one task would.
    At most `max_requests` times per slice reach the driver.
    """
    kept = list(events.columns)
    sliced = slice_rows(events.withColumn("_t", _seconds(F.col("ts"))), ["key"], ["_t", "id"], slices)
    key_type = events.schema["key"].dataType.simpleString()
    end_schema = f"_ord_slice int, first {key_type}, last {key_type}, single boolean, log array<double>"
    keys_only = sliced.select("_ord_slice", "key", "_t", "id")
    starts: dict[int, list[float]] = {}
    ends = {r["_ord_slice"]: r for r in _walked(keys_only, starts, max_requests, window_s, None, end_schema).collect()}
    order = sorted(ends)
    while True:
        given = {b: ends[a]["log"] for a, b in zip(order, order[1:]) if ends[a]["last"] == ends[b]["first"]}
        again = [b for b, log in given.items() if ends[b]["single"] and log != starts.get(b, [])]
        starts = given
        if not again:
            break
        part = keys_only.where(F.col("_ord_slice").isin(again))
        ends.update((r["_ord_slice"], r) for r in _walked(part, starts, max_requests, window_s, None, end_schema).collect())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema)
    return _walked(sliced, starts, max_requests, window_s, kept, f"{fields}, allowed boolean")


class SlidingLog(StatefulProcessor):
    """The times of the recorded hits of a key, as a list that leaves `ttl_ms` after its last change."""

    def __init__(self, max_requests: int, window_s: float, ttl_ms: int):
        self.max_requests, self.window_s, self.ttl_ms = max_requests, window_s, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.log = handle.getListState("hits", "t double", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the hits of a key in one micro-batch, three numbers each; the source's rate bounds them
        hits = pd.concat(list(rows)).sort_values(["t", "id"])
        log = _Log([t for (t,) in self.log.get()], self.max_requests, self.window_s)
        allowed = [log.hit(now) for now in hits["t"]]
        if log.times:
            self.log.put([(t,) for t in log.times])
        else:
            self.log.clear()
        yield pd.DataFrame({"id": hits["id"], "key": key[0], "allowed": allowed})

    def close(self) -> None:
        pass


def rate_limit_stream(events: DataFrame, max_requests: int, window_s: float, idle: str = "1 hour") -> DataFrame:
    """The sliding log on a stream: the times of the recorded hits, `max_requests` at most, are the state of a key.

    Every hit gets a verdict; one that arrives late is held against the log as it stands.  The state of a
    key leaves when no hit has come for the window and `idle` of the clock on the wall.  Needs the RocksDB
    state store; `run_available` sets it and ends when all that is there has been read.
    """
    ttl_ms = int(window_s * 1000) + int(pd.Timedelta(idle).total_seconds() * 1000)
    key_type, id_type = (events.schema[c].dataType.simpleString() for c in ("key", "id"))
    return (
        events.withColumn("t", _seconds(F.col("ts"))).select("key", "id", "t").groupBy("key")
        .transformWithStateInPandas(
            SlidingLog(max_requests, window_s, ttl_ms), f"id {id_type}, key {key_type}, allowed boolean", "append", "ProcessingTime")
    )


#: a state that leaves by the clock makes Spark ask for one empty batch after the other, so an `availableNow`
#: run with it ends only without them
_BOUNDED = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Start a stream to Parquet that ends when all that is there has been read.

    A stream keeps the options of its start, so the session has its own back at once.
    """
    conf = stream.sparkSession.conf
    before = {k: conf.get(k, None) for k in _BOUNDED}
    try:
        for k, v in _BOUNDED.items():
            conf.set(k, v)
        return (
            stream.writeStream.format("parquet").outputMode(mode).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def rate_limit_fixed(events: DataFrame, max_requests: int, window_s: int, slices: int | None = None) -> DataFrame:
    """Add `allowed`: the first hits of every key in each epoch-aligned window."""
    windowed = events.withColumn("_w", F.floor(_seconds(F.col("ts")) / window_s))
    numbered = number_rows(windowed, ["key", "_w"], ["ts", "id"], "_rn", slices=slices)
    return numbered.withColumn("allowed", F.col("_rn") <= max_requests).drop("_w", "_rn")


# ---- quotas ----------------------------------------------------------------------------------

PERIOD_DAYS = 30


def quota_usage(events: DataFrame, subscriptions: DataFrame, mode: str = "reference") -> DataFrame:
    """Requests per organisation and 30-day period since its subscription, against its limit.

    Events: org_id, ts.  Subscriptions: org_id, created, quota (-1 is unlimited; in `reference` mode the
    counter of an unlimited one sticks at -1 after the first request, `fixed` counts on).
    """
    if mode not in ("reference", "fixed"):
        raise ValueError("mode is reference or fixed")
    # seconds first, so the join with the subscriptions meets one row per organisation and second
    per_second = events.groupBy("org_id", F.date_trunc("second", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("_c"))
    joined = per_second.join(subscriptions, "org_id")
    period = F.floor((F.unix_seconds("ts") - F.unix_seconds("created")) / (PERIOD_DAYS * 86400))
    used = joined.withColumn("period", period).groupBy("org_id", "period").agg(
        F.sum("_c").alias("requests"), F.max("quota").alias("quota"))
    free = F.col("quota") == -1
    stuck = F.when(F.col("requests") > 1, F.lit(-1)).otherwise(F.col("requests"))
    open_usage = stuck if mode == "reference" else F.col("requests")
    return used.withColumns({
        "usage": F.when(free, open_usage).otherwise(F.least("requests", "quota")).cast("bigint"),
        "blocked": ~free & (F.col("requests") >= F.col("quota")),
    })


def storage_usage(events: DataFrame) -> DataFrame:
    """Last reported size per organisation (org_id, ts, id, size)."""
    return events.groupBy("org_id").agg(F.max_by("size", F.struct("ts", "id")).alias("size"))
