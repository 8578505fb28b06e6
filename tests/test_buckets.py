"""State of replayed messages in buckets of keys."""

import datetime as dt
import hashlib

from pyspark.sql import Row

from metframe.streaming import feeds


class Value:
    def __init__(self):
        self.value, self.calls = None, 0

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None


class Handle:
    def __init__(self):
        self.state, self.timers = Value(), []

    def getValueState(self, name, schema):
        return self.state

    def registerTimer(self, ms):
        self.timers.append(ms)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def row(key, ms):
    return Row(key, ms, hashlib.sha256(key.encode()).digest(), 0)


def test_calls_to_the_state_do_not_grow_with_the_keys():
    told, handle = feeds.Arrivals(1000, ["key", "kind"]), Handle()
    told.init(handle)
    first = [row(f"k{i}", 5000 + i) for i in range(500)]
    kinds = [r[1] for r in told.handleInputRows((0,), iter([*first, first[3], row("x", None), row("y", 10)]), At(100))]
    assert kinds == [*["first"] * 500, "replay", "late", "late"]
    assert handle.state.calls <= 4 and len(handle.timers) == 1
    # By 6100 the keys up to k100 are no longer known, though their bucket still is.
    later = [r[1] for r in told.handleInputRows((0,), iter([row("k100", 9000), row("k101", 9000), row("k5", 6100)]), At(6100))]
    assert later == ["first", "replay", "late"] and handle.state.calls <= 8
    list(told.handleExpiredTimer((0,), At(6499), None))
    assert len(handle.state.value[0]) == 40
    list(told.handleExpiredTimer((0,), At(10_000), None))
    assert handle.state.value is None


def test_keys_that_differ_by_a_microsecond_or_a_null(spark, folder):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t), ("a", t + dt.timedelta(microseconds=1)), (None, t), ("null", t), ("", t), ("a", t)]
    spark.createDataFrame(rows, "k string, at timestamp").coalesce(1).write.parquet(folder("in"))
    stream = feeds.read_parquet_stream(spark, folder("in"), spark.read.parquet(folder("in")).schema)
    with feeds.keyed_state(spark):
        feeds.drain(feeds.append_stream(feeds.mark_replays(stream, ["k", "at"], "at", 60, buckets=2), folder("out"), folder("check")))
    assert sorted(r["kind"] for r in spark.read.parquet(folder("out")).collect()) == [*["first"] * 5, "replay"]
