"""The stages of one batch, in the order in which they depend on each other.

Prediction reads the snapshot, which is taken before the new batch is merged: it sees the table as
the batch before left it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from metframe import schemas
from metframe.functions.expr import slot
from metframe.operators.blend import blend_columns, flatten_a, flatten_b
from metframe.operators.forecast import arima_models, predict, select_model, series_rows
from metframe.operators.quality import decode_messages
from metframe.operators.refine import ARIMA, SARIMA, fit_css
from metframe.operators.seasonal import sarima_models
from metframe.operators.series import latest_per, top_n
from metframe.operators.skew import HOT_ROWS
from metframe.operators.stations import nearest_station, only_keys
from metframe.sources.readers import (
    path_exists, read_history, read_messages, read_or_empty, read_raw, read_table,
)
from metframe.sources.writers import mark, store_observations, write_csv, write_models, write_replace
from metframe.streaming.feeds import on_batch


SLOT = 600  # seconds between two batches of a provider


@dataclass
class Places:
    """Folders of one deployment."""

    raw_a: str
    raw_b: str
    table: str
    snapshot: str
    predictions: str
    models: str
    ledger: str = ""  # of the stages that numbered batches have finished


# A later version of an observation is the one of which provider B was read later, or else a later batch.
ORDER = ["read_at", "batch"]


def snapshot(table: DataFrame, n: int = 37) -> DataFrame:
    """The ``n`` newest rows of the table; equal times in order of the city name."""
    return top_n(table, n, [F.desc("time"), F.asc("city_name")])


def newest_per_city(table: DataFrame) -> DataFrame:
    return latest_per(table, ["city_name"], [F.desc("time")])


def label_by_place(records: DataFrame, cities: DataFrame) -> DataFrame:
    """Records of provider B, which was asked by coordinates, with the name of the nearest city."""
    named = nearest_station(
        records.drop("city_name"), cities, "latitude", "longitude", "city", "latitude", "longitude",
        out="city_name", km="_km",
    )
    return named.select(*schemas.PROVIDER_B.fieldNames())


def land(spark: SparkSession, source, schema: T.StructType, path: str, cities: DataFrame | None = None) -> DataFrame:
    """Decode the messages of a topic, or of a frame of them, into Parquet; returns those that are no such record.

    With a city list, the records are named by their coordinates.
    """
    messages = source if isinstance(source, DataFrame) else read_messages(spark, source)
    records, bad = decode_messages(messages, schema)
    records = records.select(*schema.fieldNames())
    write_replace(records if cities is None else label_by_place(records, cities), path)
    return bad


def merge(raw_a: DataFrame, raw_b: DataFrame) -> DataFrame:
    """Flatten, join and blend one batch of both providers.

    The providers meet by city and ten-minute slot of their own times, so a batch may span many slots. A
    repeated message is taken once: of provider A one per city and time, which is the key of the table, of
    provider B the newest per city and slot. So the join has one partner per row. ``read_at`` is the time of
    provider B's reading.
    """
    a = flatten_a(raw_a)
    a = latest_per(a, ["city_name", "time"], [F.desc(F.xxhash64(*a.columns))])
    b = flatten_b(raw_b.select("*", F.col("current.time").alias("_at")), ["_at"])
    b = b.withColumn("read_at", F.col("_at").try_cast("timestamp")).withColumn("_slot", slot("read_at", SLOT))
    b = latest_per(b, ["city_name", "_slot"], [F.desc("_at"), F.desc(F.xxhash64(*schemas.PATHS_B))])
    return blend_columns(a.withColumn("_slot", slot("time", SLOT)).join(b.drop("_at"), ["city_name", "_slot"]).drop("_slot"))


def train(history: DataFrame, cities: DataFrame | None = None, hot: int = HOT_ROWS) -> DataFrame:
    """Both kinds of model per city and variable fitted by least squares, the better one kept.

    With a city list (column ``city_name``), only its cities; ``missing_keys`` reports the others.
    """
    if cities is not None:
        history = only_keys(history, cities, ["city_name"])
    rows = series_rows(history, ["city_name"], "time", schemas.FORECAST_VARIABLES, hot=hot).written()
    plain, with_season = fit_css(rows, ARIMA), fit_css(rows, SARIMA)
    both = arima_models(rows, plain).unionByName(sarima_models(rows, with_season))
    return select_model(both, rows.series)


def train_from_csv(spark: SparkSession, path: str, models: str) -> None:
    write_models(train(read_history(spark, path)), models)


def run_batch(spark: SparkSession, source_a, source_b, places: Places, n: int = 37, cities: DataFrame | None = None,
              batch: int | None = None, after: Callable[[str], None] | None = None) -> dict[str, DataFrame]:
    """Snapshot, land both feeds, predict, merge and upsert. Returns what was rejected.

    With a number, each stage is entered in the ledger when it has finished, and a batch that is run again goes on
    behind the last one entered: the snapshot is not taken from a table that holds the batch already, and a finished
    batch changes nothing. Each stage replaces what it writes, or upserts it, so one that failed halfway is repeated
    whole. Numbers ascend with the messages; an older batch run late does not replace what a newer one has written.
    Only stages that ran have rejected rows. ``after`` is called with the name of a stage that has run, before it
    is entered.
    """
    if batch is not None and not places.ledger:
        raise ValueError("a numbered batch needs a ledger")
    rejected = {}

    def take() -> None:
        if path_exists(spark, places.table):
            newest = snapshot(read_table(spark, places.table), n)
            write_csv(newest.select(*schemas.HISTORY.fieldNames()), places.snapshot)

    def land_both() -> None:
        rejected["provider_a"] = land(spark, source_a, schemas.PROVIDER_A, places.raw_a)
        rejected["provider_b"] = land(spark, source_b, schemas.PROVIDER_B, places.raw_b, cities)

    def forecast() -> None:
        if path_exists(spark, places.snapshot):
            rows = read_history(spark, places.snapshot)
            models = read_or_empty(spark, places.models, schemas.MODELS)
            write_csv(
                predict(rows, models, ["city_name"], "time", schemas.FORECAST_VARIABLES), places.predictions,
                "yyyy-MM-dd HH:mm:ss",
            )

    def store() -> None:
        merged = merge(
            read_or_empty(spark, places.raw_a, schemas.PROVIDER_A), read_or_empty(spark, places.raw_b, schemas.PROVIDER_B)
        )
        rejected["observations"] = store_observations(
            spark, places.table, merged.withColumn("batch", F.lit(batch).cast("long")), ORDER
        )

    for name, work in (("snapshot", take), ("land", land_both), ("predict", forecast), ("merge", store)):
        entered = f"{places.ledger}/{batch}/{name}"
        if batch is not None and path_exists(spark, entered):
            continue
        work()
        if after is not None:
            after(name)
        if batch is not None:
            mark(spark, entered)
    return rejected


def run_stream(a: DataFrame, b: DataFrame, places: Places, checkpoint: str, n: int = 37, cities: DataFrame | None = None,
               after: Callable[[str], None] | None = None) -> DataStreamWriter:
    """The same over two streams of messages (``value``): what both have brought since the last micro-batch is one
    batch, its number that of the micro-batch. A micro-batch that is run again changes every output once.

    The checkpoint and the ledger belong together: a new checkpoint counts from 0 again and needs a new ledger.
    """
    both = a.select("value", F.lit("a").alias("feed")).unionByName(b.select("value", F.lit("b").alias("feed")))

    def work(messages: DataFrame, number: int) -> None:
        one, other = (messages.where(F.col("feed") == feed).select("value") for feed in "ab")
        run_batch(messages.sparkSession, one, other, places, n, cities, number, after)

    return on_batch(both, work, checkpoint)
