"""Sinks. Rows are written by the tasks that hold them; none passes the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from metframe import schemas
from metframe.operators.blend import merge_latest
from metframe.operators.quality import conform
from metframe.operators.series import latest_per
from metframe.session import cut_lineage, scratch_path
from metframe.sources.readers import path_exists, read_raw, read_table

DAY = "date"


def to_messages(df: DataFrame, key: Column | str) -> DataFrame:
    """One row per message: its key and the whole row as JSON."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def publish(messages: DataFrame, target: Mapping[str, str] | str) -> None:
    """To a Kafka topic (options of the Kafka writer) or to a folder of JSON lines."""
    if isinstance(target, str):
        messages.select("value").write.mode("append").text(target)
    else:
        messages.write.format("kafka").options(**target).save()


def write_replace(df: DataFrame, path: str, partition: Sequence[str] = ()) -> bool:
    """Replace the Parquet data at ``path``. An empty frame leaves what is there and says False."""
    if df.isEmpty():
        return False
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    return True


def write_csv(df: DataFrame, path: str, time_format: str | None = None) -> bool:
    """Replace the CSV folder at ``path``, with header; an empty frame leaves it as it is."""
    if df.isEmpty():
        return False
    writer = df.write.mode("overwrite").option("header", True)
    (writer.option("timestampFormat", time_format) if time_format else writer).csv(path)
    return True


def write_models(models: DataFrame, path: str) -> None:
    """Model table: one Parquet row per series."""
    models.select(*schemas.MODELS.fieldNames()).write.mode("overwrite").parquet(path)


def with_day(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn(DAY, F.to_date(time))


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], seq: Sequence[str],
           schema: T.StructType, time: str = "time") -> int:
    """Write rows into the table at ``path``, the last write of a key winning as a whole row.

    Last is the highest value of the ``seq`` columns of the updates, which the table keeps, so the result
    does not depend on how the updates are cut into calls; of equal ones the later call wins. The table is
    partitioned by day. Only the days the updates touch are read, merged, staged in the shared folder and
    then written over the old ones; a run that failed can be repeated with the same result. Large days are
    split over several tasks and files. Rows without a time have no day and are not stored. Frames opened
    before hold the old list of files. Returns the number of touched days.
    """
    names, order = schema.fieldNames(), [f"_seq_{s}" for s in seq]
    numbered = updates.select(*names, *[F.col(s).alias(o) for s, o in zip(seq, order)])
    new = cut_lineage(with_day(numbered, time).where(F.col(DAY).isNotNull()))
    # Distinct days: bounded by the time range, not by the rows.
    days = [r[0] for r in new.select(DAY).distinct().collect()]
    if not days:
        return 0
    written = [d for d in days if path_exists(spark, f"{path}/{DAY}={d}")]
    if not written:
        # Nothing to read back, so the rows go straight to their new days.
        fresh = latest_per(new, keys, [*[F.desc_nulls_last(o) for o in order], F.desc(F.xxhash64(*names))])
        write_days(fresh.hint("rebalance", DAY), path)
        return len(days)
    # By a given schema, as files from before the order columns lack them.
    old = read_raw(spark, path, new.schema).where(F.col(DAY).isin(written)).select(*names, *order, DAY)
    staged = scratch_path(spark, "upsert")
    write_days(merge_latest(old, new, list(keys), order).hint("rebalance", DAY), staged)
    write_days(read_table(spark, staged).select(*old.columns), path)
    remove(spark, staged)
    return len(days)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder, on any Hadoop file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, on any Hadoop file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop_path, True).close()


def write_days(df: DataFrame, path: str) -> None:
    """Write the days the frame holds over those at ``path``; other days stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def store_observations(spark: SparkSession, path: str, merged: DataFrame, seq: Sequence[str] = ()) -> DataFrame:
    """Upsert blended observations into the observation table; returns the rejected rows: those with a value
    that does not fit, and those without a key. ``seq`` names further columns that tell which version is the last."""
    further = [merged.schema[s] for s in seq if s not in schemas.OBSERVATIONS.fieldNames()]
    raw = merged.select(*schemas.OBSERVATIONS.fieldNames(), *[f.name for f in further])
    keyless = F.col(schemas.OBSERVATION_KEY[0]).isNull() | F.col(schemas.OBSERVATION_KEY[1]).isNull()
    rows, rejected = conform(raw.where(~keyless), T.StructType([*schemas.OBSERVATIONS, *further]))
    upsert(spark, path, rows, schemas.OBSERVATION_KEY, list(seq), schemas.OBSERVATIONS)
    return rejected.unionByName(raw.where(keyless)).select(*schemas.OBSERVATIONS.fieldNames())
