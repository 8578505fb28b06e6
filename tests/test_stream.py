"""Streams against the same work done in batch, over several micro-batches."""

import datetime as dt
import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from metframe import schemas
from metframe.operators.quality import decode_messages
from metframe.sources import readers
from metframe.streaming import feeds
from tests.compare import rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = schemas.struct(city_name=schemas.S, time=schemas.TS, v=schemas.D, seq=schemas.L)


def drop_file(folder, number, records):
    Path(folder).mkdir(exist_ok=True)
    file = Path(folder, f"{number:03d}.json")
    file.write_text("".join(json.dumps(r) + "\n" for r in records))
    # The file source goes by modification time; files of one moment would come in any order.
    os.utime(file, (1_700_000_000 + 10 * number,) * 2)


def message(city, minute, v, seq=0):
    return {"city_name": city, "time": (T0 + dt.timedelta(minutes=minute)).isoformat(), "v": v, "seq": seq}


def decoded(spark, folder, per_batch=1):
    records, _ = decode_messages(feeds.read_message_stream(spark, folder, per_batch), SCHEMA)
    return records


def test_replays_and_late_rows(spark, folder):
    topic, out, check = folder("topic"), folder("out"), folder("check")

    def run():
        once = feeds.drop_replays(decoded(spark, topic), schemas.OBSERVATION_KEY, "time", "30 minutes")
        feeds.drain(feeds.append_stream(once, out, check))

    drop_file(topic, 1, [message("a", 0, 1.0), message("a", 0, 1.0), message("b", 0, 2.0)])
    run()
    drop_file(topic, 2, [message("a", 0, 1.0), message("a", 10, 3.0)])  # a replay in a later batch
    run()
    assert rows(readers.read_table(spark, out), "city_name", "time") == [
        ("a", T0, 1.0, 0), ("a", T0 + dt.timedelta(minutes=10), 3.0, 0), ("b", T0, 2.0, 0),
    ]
    drop_file(topic, 3, [message("a", 300, 4.0)])
    run()
    drop_file(topic, 4, [message("a", 20, 5.0), message("a", 310, 6.0)])  # the first is later than the watermark
    run()
    values = [r[2] for r in rows(readers.read_table(spark, out), "time", "city_name")]
    assert values == [1.0, 2.0, 3.0, 4.0, 6.0]


def test_blend_streams_is_the_batch_join(spark, folder):
    topics = folder("ta"), folder("tb")
    feeds_in = [[], []]
    for batch in range(4):
        for side, topic in enumerate(topics):
            part = [message(c, batch * 40 + m + side * 4, float(m + side)) for c in "abc" for m in range(0, 40, 7)]
            feeds_in[side] += part
            drop_file(topic, batch, part)
    a, b = (decoded(spark, t) for t in topics)
    a = a.select("city_name", F.col("time").alias("ta"), F.col("v").alias("va"))
    b = b.select("city_name", F.col("time").alias("tb"), F.col("v").alias("vb"))
    pairs = feeds.blend_streams(a, b, "city_name", "ta", "tb", 300, "2 hours")
    feeds.drain(feeds.append_stream(pairs, folder("out"), folder("check")))
    got = {(r["city_name"], r["ta"], r["tb"]) for r in readers.read_table(spark, folder("out")).collect()}
    want = set()
    for x in feeds_in[0]:
        for y in feeds_in[1]:
            tx, ty = dt.datetime.fromisoformat(x["time"]), dt.datetime.fromisoformat(y["time"])
            if x["city_name"] == y["city_name"] and abs(tx - ty) <= dt.timedelta(seconds=300):
                want.add((x["city_name"], tx, ty))
    assert got == want and readers.read_table(spark, folder("out")).count() == len(want)


@pytest.mark.parametrize(("per_batch", "turned"), [(1, False), (1, True), (3, False)])
def test_upsert_stream_is_the_batch_upsert(spark, folder, per_batch, turned):
    topic, path = folder("topic"), folder(f"table{per_batch}")
    sent = [
        [message("a", 0, 1.0, 1), message("b", 0, 2.0, 1)],
        [message("a", 0, None, 2), message("a", 1500, 3.0, 3)],
        [message("b", 0, 4.0, 5), message("b", 0, 5.0, 4)],
    ]
    for i, part in enumerate(reversed(sent) if turned else sent):
        drop_file(topic, i, part)
    stored = schemas.struct(city_name=schemas.S, time=schemas.TS, v=schemas.D)
    feeds.drain(feeds.upsert_stream(
        decoded(spark, topic, per_batch), path, schemas.OBSERVATION_KEY, ["seq"], stored, folder("check")
    ))
    assert rows(readers.read_table(spark, path).select("city_name", "time", "v"), "city_name", "time") == [
        ("a", T0, None), ("a", T0 + dt.timedelta(minutes=1500), 3.0), ("b", T0, 4.0),
    ]


def test_cadence_and_restart(spark, folder):
    """A query at the ten-minute cadence takes what is there; a restart goes on behind it."""
    topic, out, check = folder("topic"), folder("out"), folder("check")
    drop_file(topic, 1, [message("a", 0, 1.0)])
    query = feeds.every_step(feeds.append_stream(decoded(spark, topic), out, check))
    # Waiting for all there is would last until the next round of the cadence; the first batch comes at once.
    end = time.monotonic() + 60
    while query.lastProgress is None and query.isActive and time.monotonic() < end:
        time.sleep(0.1)
    query.stop()
    assert readers.read_table(spark, out).count() == 1
    drop_file(topic, 2, [message("a", 10, 2.0)])
    feeds.drain(feeds.append_stream(decoded(spark, topic), out, check))
    assert readers.read_table(spark, out).count() == 2


def test_first_replayed_and_late_rows_are_told_apart(spark, folder):
    topic, out, check = folder("topic"), folder("out"), folder("check")

    def run(number, *records):
        drop_file(topic, number, records)
        marked = feeds.mark_replays(decoded(spark, topic), schemas.OBSERVATION_KEY, "time", 1800)
        with feeds.keyed_state(spark):
            feeds.drain(feeds.append_stream(marked, out, check, ["kind"]))
        return sorted((r["v"], r["kind"]) for r in readers.read_table(spark, out).collect())

    seen = run(1, message("a", 0, 1.0), message("a", 0, 1.0), message("b", 0, 2.0))
    assert seen == [(1.0, "first"), (1.0, "replay"), (2.0, "first")]
    run(2, message("a", 0, 1.0), message("a", 29, 3.0), message("a", 10, 4.0))  # the watermark stands before all
    seen = run(3, message("a", 300, 5.0), message("b", 0, 2.0))  # at -1 minute still, a replay
    assert seen[2:] == [(1.0, "replay"), (2.0, "first"), (2.0, "replay"), (3.0, "first"), (4.0, "first"), (5.0, "first")]
    # At 270 now: late, replayed or not; what is not late goes on as before.
    run(4, message("a", 20, 6.0), message("a", 29, 3.0), message("a", 270, 7.0), message("a", 271, 8.0),
        {"city_name": "a", "v": 9.0}, message("a", 300, 5.0))
    seen = run(5, message("a", 271, 8.0))
    assert seen[5:] == [
        (3.0, "first"), (3.0, "late"), (4.0, "first"), (5.0, "first"), (5.0, "replay"), (6.0, "late"), (7.0, "late"),
        (8.0, "first"), (8.0, "replay"), (9.0, "late"),
    ]
    assert spark.conf.get(feeds.STATE_STORE, None) != feeds.ROCKS
