"""The two nested feeds: small rows with the awkward cases, worked by hand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from metframe import schemas
from metframe.operators.blend import blend_sources, flatten_a, flatten_b, merge_latest, table_columns
from metframe.operators.quality import conform, decode_messages
from metframe.operators.shape import drop_columns, suffix_except, to_long, to_wide
from metframe.plans import charts
from tests.compare import rows

A = [
    {"name": "Nord", "dt": 1_700_000_000, "coord": {"lat": 33.5, "lon": -7.5}, "visibility": 10000,
     "weather": [{"description": "clear", "id": 1}, {"description": "haze", "id": 2}],
     "main": {"temp": 20.0, "feels_like": 19, "humidity": 60, "pressure": 1013, "temp_min": 18, "temp_max": 22},
     "wind": {"speed": 3, "deg": 270}, "clouds": {"all": 5},
     "sys": {"country": "XX", "sunrise": 1_699_990_000, "sunset": 1_700_030_000}, "base": "stations"},
    {"name": "Süd", "dt": 1_700_000_000, "main": None, "weather": [], "wind": {"speed": 1.5}},
    {"name": "Ost", "dt": 1_700_000_000, "main": {"temp": 10.5}, "weather": None},
    {"name": None, "dt": 1_700_000_000, "main": {"temp": 1.0}},
]
B = [
    {"city_name": "Nord", "elevation": 50, "current": {"time": "2023-11-14T22:15", "temperature_2m": 22,
     "relative_humidity_2m": 61, "apparent_temperature": 20.0, "is_day": 0, "rain": 0.5}},
    {"city_name": "Süd", "elevation": 10.5, "current": {"temperature_2m": 30.0, "relative_humidity_2m": 40}},
    {"city_name": "West", "current": {"temperature_2m": 5.0}},
    {"city_name": None, "current": {"temperature_2m": 5.0}},
]


def messages(spark, records, *broken):
    texts = [json.dumps(r) for r in records] + list(broken)
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.fixture()
def raw_a(spark):
    return decode_messages(messages(spark, A), schemas.PROVIDER_A)[0]


@pytest.fixture()
def raw_b(spark):
    return decode_messages(messages(spark, B), schemas.PROVIDER_B)[0]


def test_flatten_a(raw_a):
    flat = flatten_a(raw_a)
    assert flat.columns == list(schemas.PATHS_A)
    got = {r["city_name"]: r for r in flat.collect()}
    nord = got["Nord"]
    assert nord["weather_description"] == ["clear", "haze"]
    assert (nord["wind_speed"], nord["feels_like"]) == (3.0, 19.0)  # whole numbers in double fields
    assert nord["time"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert nord["sunrise"] == dt.datetime(2023, 11, 14, 19, 26, 40)
    assert got["Süd"]["temp"] is None and got["Süd"]["wind_speed"] == 1.5
    assert got["Süd"]["weather_description"] == [] and got["Ost"]["weather_description"] is None
    assert got["Ost"]["temp"] == 10.5 and got["Ost"]["humidity"] is None


def test_blend(raw_a, raw_b):
    got = blend_sources(flatten_a(raw_a), flatten_b(raw_b), ["city_name"])
    assert "latitude" in got.columns and got.columns.count("city_name") == 1
    by = {r["city_name"]: r for r in got.collect()}
    assert set(by) == {"Nord", "Süd"}  # one-sided and null cities drop
    assert by["Nord"]["humidity"] == 60.5
    assert by["Nord"]["temperature_2m"] == 21.0
    assert by["Nord"]["temperature_feels_like"] == 19.5
    assert by["Nord"]["temp"] == 20.0 and by["Nord"]["relative_humidity_2m"] == 61
    assert by["Süd"]["humidity"] is None and by["Süd"]["temperature_2m"] is None
    kept = blend_sources(flatten_a(raw_a), flatten_b(raw_b), ["city_name"], keep_single=True)
    assert {r["city_name"]: r["temperature_2m"] for r in kept.collect()} == {"Nord": 21.0, "Süd": 30.0}


def test_repeated_city_multiplies(raw_a, raw_b):
    twice = flatten_b(raw_b).unionByName(flatten_b(raw_b))
    assert blend_sources(flatten_a(raw_a), twice, ["city_name"]).count() == 4


def test_table_columns(raw_a, raw_b):
    stored = table_columns(blend_sources(flatten_a(raw_a), flatten_b(raw_b), ["city_name"]))
    assert len(stored.columns) == 28
    assert "weather_description" not in stored.columns and "temperature_feels_like" not in stored.columns
    good, bad = conform(stored, schemas.OBSERVATIONS)
    assert good.schema.simpleString() == schemas.OBSERVATIONS.simpleString() and bad.count() == 0


def test_malformed_messages_are_set_aside(spark):
    sent = messages(spark, A, "{\"name\": \"cut", "", "[1")
    records, bad = decode_messages(sent, schemas.PROVIDER_A)
    assert records.count() == 4
    assert sorted(r["value"] for r in bad.collect()) == ["", "[1", "{\"name\": \"cut"]


def test_wrong_type_is_set_aside(spark):
    records, bad = decode_messages(messages(spark, [{"name": "X", "dt": "soon"}]), schemas.PROVIDER_A)
    assert records.count() == 0 and bad.count() == 1


def test_conform_rejects(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "n string, s string")
    good, bad = conform(df, schemas.struct(n=schemas.L, s=schemas.S))
    assert rows(good, "s") == [(1, "a"), (None, "c")] and rows(bad) == [("x", "b")]


def test_merge_latest_takes_whole_rows(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, t int, v double")
    new = spark.createDataFrame(
        [("a", 1, None, 7), ("a", 1, 9.0, 6), ("c", 1, 3.0, 1)], "k string, t int, v double, seq int"
    )
    got = merge_latest(old, new, ["k", "t"], ["seq"])
    assert rows(got, "k") == [("a", 1, None), ("b", 1, 2.0), ("c", 1, 3.0)]


def test_presentation_tables(raw_a, raw_b):
    a = charts.presentation_a(raw_a.withColumn("base", F.lit("stations")))
    assert not {"main", "coord", "wind", "sys", "dt", "weather", "base"} & set(a.columns)
    nord = a.where("city = 'Nord'").first()
    assert (nord["temperature"], nord["clouds"], nord["latitude"]) == (20.0, 5, 33.5)
    assert charts.presentation_a(raw_a.withColumn("x", F.lit(1))).where("city = 'Ost'").first()["clouds"] is None
    b = charts.presentation_b(raw_b)
    assert "current" not in b.columns and b.where("city = 'Nord'").first()["time"] == "2023-11-14T22:15"


def test_reshaping(spark):
    df = spark.createDataFrame([(1, 2, 3.5), (2, None, 4.5)], "id int, a int, b double")
    long = to_long(df, ["id"], ["a", "b", "absent"])
    assert rows(long, "id", "variable") == [(1, "a", 2.0), (1, "b", 3.5), (2, "a", None), (2, "b", 4.5)]
    assert rows(to_wide(long, ["id"], ["a", "b"]), "id") == [(1, 2.0, 3.5), (2, None, 4.5)]
    with pytest.raises(ValueError):
        to_long(df, ["id"], ["absent"])
    assert suffix_except(df, ["id"], "_x").columns == ["id", "a_x", "b_x"]
    assert drop_columns(df, ["b", "absent"]).columns == ["id", "a"]


def test_comparison_of_providers(raw_a, raw_b):
    got = charts.provider_comparison(raw_a, raw_b, "temperature")
    assert rows(got, "source", "name") == [
        ("Nord", 20.0, "provider_a"), ("Ost", 10.5, "provider_a"), ("Süd", None, "provider_a"),
        ("Nord", 22.0, "provider_b"), ("Süd", 30.0, "provider_b"), ("West", 5.0, "provider_b"),
    ]
