"""The pipeline as streams: decode, drop replays, join two feeds in time, upsert."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from metframe import schemas
from metframe.functions.expr import slot
from metframe.sources.writers import upsert


def read_message_stream(spark: SparkSession, source: Mapping[str, str] | str,
                        per_batch: int | None = None) -> DataFrame:
    """Messages of a topic from the earliest offset, or of a folder of JSON lines, as ``value``.

    ``per_batch`` bounds one micro-batch: offsets of a topic, files of a folder.
    """
    if isinstance(source, str):
        reader = spark.readStream.format("text")
        if per_batch:
            reader = reader.option("maxFilesPerTrigger", per_batch)
        return reader.load(source)
    reader = spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**source)
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().withColumn("value", F.col("value").cast("string"))


def read_parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                        per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def drop_replays(stream: DataFrame, keys: Sequence[str], time: str, delay: str = "30 minutes") -> DataFrame:
    """One row per key; the state of a key is let go once the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


class Arrivals(StatefulProcessor):
    """Tells the first message of a key from its replays, and both from messages that came too late.

    A group is a bucket of many keys, as every call to the state takes longer than a row does. Its state is one value,
    the digest of each known key and the time of its first row.
    """

    def __init__(self, delay_ms: int, names: Sequence[str]):
        self.delay_ms, self.names = delay_ms, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "known binary")

    def known(self, passed: int) -> dict[bytes, int]:
        """The keys of the bucket that the watermark has not yet passed by the delay."""
        if not self.seen.exists():
            return {}
        each = struct.iter_unpack(ENTRY, bytes(self.seen.get()[0]))
        return {key: ms for key, ms in each if ms + self.delay_ms > passed}

    def keep(self, known: dict[bytes, int]) -> None:
        self.seen.update((b"".join(struct.pack(ENTRY, key, ms) for key, ms in known.items()),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        known, told, newest = self.known(passed), Row(*self.names), None
        for row in rows:
            *values, ms, digest, _ = row
            digest = bytes(digest)
            if ms is None or ms <= passed:
                kind = LATE
            elif digest in known:
                kind = REPLAY
            else:
                kind, known[digest] = FIRST, ms
                newest = ms if newest is None else max(newest, ms)
            yield told(*values, kind)
        if newest is not None:
            self.keep(known)
            self.handle.registerTimer(newest + self.delay_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.known(timerValues.getCurrentWatermarkInMs())
        self.keep(known) if known else self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


ENTRY = "<32sq"  # of a bucket's state: the digest of a key and a time
BUCKETS = 2_048  # of keys; each has one value of state
FIRST, REPLAY, LATE = "first", "replay", "late"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def mark_replays(stream: DataFrame, keys: Sequence[str], time: str, delay_seconds: int = 1800, kind: str = "kind",
                 buckets: int = BUCKETS) -> DataFrame:
    """Every row, with what it is: the ``first`` of its key, a ``replay``, or ``late``.

    ``drop_replays`` loses late rows without a trace; here they come out beside the others. A row is late if its time
    is not after the watermark, which is the greatest time of the micro-batches before less the delay, or if it has no
    time. A key is known for the delay after the time of its first row; then it is let go. Late rows are
    not remembered. Of equal keys within one micro-batch any may be the first. Rows are looked at one by one, none is held;
    keys are known by their SHA-256, 40 bytes each, in ``buckets`` values that a checkpoint fixes. The query that runs it needs the state store of ``keyed_state``.
    """
    names = stream.columns
    plain = F.timestamp_micros(F.unix_micros(time))  # without the mark of an event time, by which late rows are dropped
    exact = [F.unix_micros(k) if isinstance(stream.schema[k].dataType, T.TimestampType) else F.col(f"`{k}`") for k in keys]
    marked = stream.withWatermark(time, f"{int(delay_seconds)} seconds").select(
        *[plain.alias(c) if c == time else F.col(f"`{c}`") for c in names], F.unix_millis(time).alias("_ms"),
        F.unhex(F.sha2(F.to_json(F.array(*[k.cast("string") for k in exact])), 256)).alias("_key"))
    bucketed = marked.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(int(buckets))).cast("int"))
    out = T.StructType([*stream.schema, T.StructField(kind, T.StringType())])
    return bucketed.groupBy("_bucket").transformWithState(Arrivals(int(delay_seconds) * 1000, out.names), out, "append", "EventTime")


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started meanwhile keep their state where ``mark_replays`` needs it."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def blend_streams(a: DataFrame, b: DataFrame, key: str, time_a: str, time_b: str, seconds: int,
                  delay: str = "30 minutes") -> DataFrame:
    """Pairs of the same key whose times are at most ``seconds`` apart.

    Equal keys alone would keep all state of a busy key in one task. Each time falls into a slot of
    that width and ``b`` is offered to the slots around its own, so the equality also spans the
    slot and a key is spread over its slots. Columns other than the key must differ in name.
    """
    left = a.withWatermark(time_a, delay).withColumn("_slot", slot(time_a, seconds))
    own = slot(time_b, seconds)
    right = (
        b.withWatermark(time_b, delay).withColumnRenamed(key, "_key")
        .withColumn("_slot_b", F.explode(F.array(own - 1, own, own + 1)))
    )
    gap = F.expr(f"INTERVAL {int(seconds)} SECONDS")
    return left.join(
        right,
        (F.col(key) == F.col("_key")) & (F.col("_slot") == F.col("_slot_b"))
        & (F.col(time_b) >= F.col(time_a) - gap) & (F.col(time_b) <= F.col(time_a) + gap),
    ).drop("_key", "_slot", "_slot_b")


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], seq: Sequence[str],
                  schema: T.StructType, checkpoint: str, time: str = "time") -> DataStreamWriter:
    """Each micro-batch is upserted; a batch that is run again gives the same table."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch.sparkSession, path, batch, keys, seq, schema, time)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def append_stream(stream: DataFrame, path: str, checkpoint: str, partition: Sequence[str] = ()) -> DataStreamWriter:
    """Append to the Parquet data at ``path``, each micro-batch once. Partitioned by what rows are, first, replayed and
    late ones are written apart in one pass."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
    )
    return writer.partitionBy(*partition) if partition else writer


def every_step(writer: DataStreamWriter, step: str = schemas.STEP):
    """Start a query that takes a micro-batch at the fixed cadence."""
    return writer.trigger(processingTime=step).start()


def drain(writer: DataStreamWriter) -> None:
    """Process what is there now, in as many micro-batches as it takes, and stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def on_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
