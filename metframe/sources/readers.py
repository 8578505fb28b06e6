"""Reading the feeds, the table, histories and predictions. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from metframe import schemas
from metframe.operators.quality import CORRUPT, conform
from metframe.operators.series import first_per, top_n
from metframe.operators.skew import lookup_join
from metframe.operators.stations import only_keys
from metframe.session import cut_lineage


def path_exists(spark: SparkSession, path: str) -> bool:
    """Also true for a pattern that matches something, on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a narrow nested schema: other columns are not read, absent ones are null."""
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The data if it is there, else a frame of the same columns without rows."""
    if path_exists(spark, path):
        return read_raw(spark, path, schema)
    return spark.createDataFrame([], schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """CSV with a header; columns are found by name, whatever their order and case.

    Other columns are left out, absent ones and values that do not fit are null. A header without the
    keys is an error, as is one that differs between the files of a folder.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    names = {c.strip().lower(): c for c in raw.columns}
    missing = [k for k in keys if k.lower() not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[
        (F.col(f"`{names[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in names else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def read_history(spark: SparkSession, path: str, schema: T.StructType = schemas.HISTORY) -> DataFrame:
    """History or snapshot, by column names."""
    return read_csv(spark, path, schema, schemas.OBSERVATION_KEY)


PART_KEYS = ["city_name", "variable"]
FILE = "_file"


def part_headers(spark: SparkSession, folder: str) -> DataFrame:
    """(``_file``, ``_header``): the first line of each part as column names. Parts that cannot be read have none."""
    first = _lines(spark, folder).where(F.col("_metadata.file_block_start") == 0).select(
        "value", F.col("_metadata.file_path").alias(FILE), F.monotonically_increasing_id().alias("_nth"))
    heads = first.groupBy(FILE).agg(F.min_by("value", "_nth").alias("_line"))
    bare = F.regexp_replace(F.regexp_replace("_line", "^\ufeff", ""), '[\r"]', "")
    return heads.select(FILE, "_line", F.transform(F.split(bare, ","), lambda c: F.lower(F.trim(c))).alias("_header"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("ignoreCorruptFiles", True).option("pathGlobFilter", "*.csv").text(folder)


def has_keys(header: Column) -> Column:
    return F.coalesce(F.forall(F.array(*map(F.lit, PART_KEYS)), lambda k: F.array_contains(header, k)), F.lit(False))


def read_predictions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All ``*.csv`` parts of a prediction folder, and the lines that could not be read.

    Every part has its own header, which tells its columns, in any order; columns that a part lacks are null, others are
    left out. A line with more or fewer fields than its header, or with a value of another type, could not be read.
    Parts that are broken, or whose header lacks city or variable, are passed over; ``unread_parts`` lists them.
    """
    heads = part_headers(spark, folder).where(has_keys(F.col("_header")))
    heads = cut_lineage(heads)
    most = heads.agg(F.max(F.size("_header"))).first()[0] or 1
    lines = _lines(spark, folder).select("value", F.col("_metadata.file_path").alias(FILE))
    lines = lookup_join(lines, heads, [FILE]).where(F.col("value") != F.col("_line"))
    # Fields beyond the widest header must not be lost unseen, so they are counted in the text.
    bare = F.regexp_replace("value", r'"(?:[^"\\]|\\.|"")*"', "")
    fits = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1 == F.size("_header")
    named = ", ".join(f"_c{i} string" for i in range(most))
    fields = F.from_csv("value", named)
    rows = lines.withColumn("_f", F.array(*[fields[f"_c{i}"] for i in range(most)])).withColumn("_fits", fits)
    texts = {f.name: F.get("_f", F.array_position("_header", f.name).cast("int") - 1) for f in schemas.PREDICTIONS}
    rows = rows.select("value", "_fits", *[
        F.when(F.array_contains("_header", n), c).alias(n) for n, c in texts.items()
    ])
    good, lost = conform(rows.where("_fits").select("value", *texts), T.StructType([T.StructField("value", T.StringType()), *schemas.PREDICTIONS]))
    bad = rows.where("not _fits").select(F.col("value").alias(CORRUPT)).union(lost.select("value"))
    return good.drop("value"), bad


def unread_parts(spark: SparkSession, folder: str) -> DataFrame:
    """(``part``, ``bytes``, ``reason``) of the ``*.csv`` parts that ``read_predictions`` passes over. Only their names
    and sizes are listed, their content is not read as a whole; empty parts have nothing to pass over."""
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", "length")
    heads = part_headers(spark, folder)
    reason = F.when(F.col("_header").isNull(), "unreadable").when(~has_keys(F.col("_header")), "other columns")
    plain = F.regexp_replace("path", "^file:/+", "/")
    found = parts.withColumn(FILE, plain).join(heads.withColumn(FILE, F.regexp_replace(F.url_decode(FILE), "^file:/+", "/")), FILE, "left")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("part"), F.col("length").alias("bytes"), reason.alias("reason")).dropna(subset=["reason"])


def first_predictions(predictions: DataFrame) -> DataFrame:
    """First prediction per city and variable, by time."""
    return first_per(
        predictions, ["city_name", "variable"], ["time", "time_of_prediction", "predicted_value"], ["time", "predicted_value", "time_of_prediction"]
    )


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """City list with its coordinates; the CSV header has City, Latitude and Longitude."""
    return read_csv(spark, path, schemas.CITIES, ["city"])


def city_key(name: Column | str) -> Column:
    """Spelling-tolerant key of a city name: case and accents do not count."""
    name = F.col(name) if isinstance(name, str) else name
    plain = F.translate(F.lower(F.trim(name)), "àâäáãçéèêëíîïìñóôöòõúùûü", "aaaaaceeeeiiiinooooouuuu")
    return F.regexp_replace(plain, r"[\s\-']+", " ")


def read_messages(spark: SparkSession, source: Mapping[str, str] | str) -> DataFrame:
    """All messages of a topic from the earliest offset on, as rows with ``value`` text.

    ``source`` holds the options of the Kafka reader (which needs its connector on the class path),
    or is a folder of JSON lines, one message per line.
    """
    if isinstance(source, str):
        return spark.read.text(source)
    reader = spark.read.format("kafka").option("startingOffsets", "earliest")
    return reader.options(**source).load().withColumn("value", F.col("value").cast("string"))


def take_messages(messages: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` messages of a topic in the order of their partitions and offsets."""
    return top_n(messages, n, [F.col(c) for c in order])


def lookup(df: DataFrame, key: Mapping[str, object]) -> DataFrame:
    """Rows with exactly this key; the equalities reach the Parquet scan."""
    for name, value in key.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def lookup_many(df: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is among the wanted ones."""
    return only_keys(df, wanted, on)
