"""Weather-shaped feeds made by Spark from the ``events`` table, for the registered queries.

A user is a station. Views, clicks and sign-ups are readings of provider A, purchases and errors
readings of provider B; every event is a reading, so the feeds grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TYPES_A = ["view", "click", "signup"]
TYPES_B = ["purchase", "error"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a zoned timestamp and the number inside the JSON property."""
    df = table(spark, sf_dir, "events")
    return with_reading(df)


def with_reading(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.from_json("props", "k long")["k"],
        "station": station("user_id"),
    })


def station(user: str) -> Column:
    return F.concat(F.lit("S"), F.col(user).cast("string"))


def nested_a(df: DataFrame) -> DataFrame:
    """Records of provider A; every tenth value of k stands for a record without its main part."""
    u, k, v = F.col("user_id"), F.col("k"), F.col("value")
    day = F.floor(F.unix_seconds("ts") / 86_400) * 86_400
    main = F.struct(
        (v / 10 - 10).alias("temp"), (v / 10 - 12).alias("feels_like"),
        (v / 10 - 13).alias("temp_min"), (v / 10 - 8).alias("temp_max"),
        k.alias("humidity"), (F.lit(1000) + k % 40).alias("pressure"),
        F.when(F.col("event_type") != "signup", F.lit(1010) + k % 7).alias("sea_level"),
        (F.lit(950) + k % 50).alias("grnd_level"),
    )
    return df.where(F.col("event_type").isin(TYPES_A)).select(
        F.struct((F.lit(30) + (u % 50) / 10).alias("lat"), (F.lit(-10) + (u % 70) / 10).alias("lon")).alias("coord"),
        F.array(
            F.struct(F.col("event_type").alias("description"), F.lit("x").alias("icon")),
            F.struct(F.concat(F.lit("k"), (k % 3).cast("string")).alias("description"), F.lit("y").alias("icon")),
        ).alias("weather"),
        F.lit("stations").alias("base"),
        F.when(k % 10 != 9, main).alias("main"),
        (F.lit(10_000) - k * 50).alias("visibility"),
        F.struct((k / 10).alias("speed"), (k * 3).alias("deg")).alias("wind"),
        F.struct(k.alias("all")).alias("clouds"),
        F.struct(
            F.concat(F.lit("N"), (u % 25).cast("string")).alias("country"),
            (day + 21_600).alias("sunrise"), (day + 64_800).alias("sunset"),
        ).alias("sys"),
        F.col("station").alias("name"), F.unix_seconds("ts").alias("dt"), "event_id", "ts",
    )


def nested_b(df: DataFrame) -> DataFrame:
    u, k, v = F.col("user_id"), F.col("k"), F.col("value")
    hour = F.hour("ts")
    current = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        (v / 10 - 11).alias("apparent_temperature"),
        F.when(hour.between(6, 17), F.lit(1)).otherwise(0).cast("long").alias("is_day"),
        (k / 100).alias("rain"), (k / 50).alias("precipitation"), (k / 200).alias("showers"),
        F.lit(0.0).alias("snowfall"), (v / 10 - 9).alias("temperature_2m"),
        (F.lit(100) - k).alias("relative_humidity_2m"), (F.lit(1000) + k / 4).alias("pressure_msl"),
        (F.lit(960) + k / 5).alias("surface_pressure"), k.alias("cloud_cover"), (k % 10).alias("weather_code"),
    )
    return df.where(F.col("event_type").isin(TYPES_B)).select(
        (F.lit(30.01) + (u % 50) / 10).alias("latitude"), (F.lit(-9.99) + (u % 70) / 10).alias("longitude"),
        current.alias("current"), F.struct(F.lit("°C").alias("temperature_2m")).alias("current_units"),
        F.lit(0).alias("utc_offset_seconds"), F.col("station").alias("city_name"),
        (u * F.lit(1.5)).alias("elevation"), "event_id", "ts",
    )


def raw_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_a(events(spark, sf_dir))


def raw_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_b(events(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str, by: str = "station") -> DataFrame:
    """Wide series per station: one row per event, gaps where the event type has no such reading.

    ``by="event_type"`` gives five long series, each a fifth of all rows.
    """
    k, v = F.col("k"), F.col("value")
    return events(spark, sf_dir).select(
        F.col(by).alias("city_name"), F.col("ts").alias("time"),
        F.when(F.col("event_type") != "error", k.cast("double")).alias("humidity"),
        (F.lit(1000.0) + k % 40).alias("pressure"),
        F.when(F.col("event_type") != "signup", F.lit(1010.0) + k % 7).alias("sea_level"),
        (v / 10 - 10).alias("temp"),
        (F.lit(10_000.0) - k * 50).alias("visibility"),
        (k / 10).alias("wind_speed"),
    )
