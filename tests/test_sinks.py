"""Sources and sinks on files."""

import datetime as dt
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from metframe import schemas
from metframe.session import shared_folder
from metframe.sources import readers, writers
from tests.compare import rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = schemas.struct(city_name=schemas.S, time=schemas.TS, v=schemas.D)
UPDATES = "city_name string, time timestamp, v double, seq int"
KEYS = schemas.OBSERVATION_KEY


def batch(spark, *data):
    return spark.createDataFrame([(c, T0 + dt.timedelta(hours=h), v, s) for c, h, v, s in data], UPDATES)


def put(spark, path, df):
    return writers.upsert(spark, path, df, KEYS, ["seq"], SCHEMA)


def read(spark, path):
    return rows(readers.read_table(spark, path).select("city_name", "time", "v"), "city_name", "time")


def test_upsert(spark, folder):
    path = folder("t")
    first = batch(spark, ("a", 0, 1.0, 1), ("a", 30, 2.0, 1), ("b", 0, 3.0, 1))
    assert put(spark, path, first) == 2
    second = batch(spark, ("a", 0, None, 2), ("c", 1, 5.0, 1), ("a", 0, 9.0, 1))
    assert put(spark, path, second) == 1
    want = [("a", T0, None), ("a", T0 + dt.timedelta(hours=30), 2.0), ("b", T0, 3.0),
            ("c", T0 + dt.timedelta(hours=1), 5.0)]
    assert read(spark, path) == want
    put(spark, path, second)
    assert read(spark, path) == want  # idempotent
    assert put(spark, path, second.limit(0)) == 0
    assert read(spark, path) == want
    assert sorted(p.name for p in Path(path).glob("date=*")) == ["date=2024-01-01", "date=2024-01-02"]


def test_upsert_leaves_other_days_alone(spark, folder):
    path = folder("t")
    put(spark, path, batch(spark, ("a", 0, 1.0, 1), ("a", 24, 2.0, 1)))
    before = sorted(str(p) for p in Path(path).glob("date=2024-01-02/*.parquet"))
    put(spark, path, batch(spark, ("a", 1, 3.0, 1)))
    assert sorted(str(p) for p in Path(path).glob("date=2024-01-02/*.parquet")) == before
    assert len(read(spark, path)) == 3


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50), st.one_of(st.none(), st.floats(0, 9)),
                          st.integers(0, 10_000)), min_size=1, max_size=20, unique_by=lambda r: r[3]))
def test_upsert_takes_the_last_write_in_any_order(spark, tmp_path_factory, data):
    path = str(tmp_path_factory.mktemp("u") / "t")
    put(spark, path, batch(spark, *reversed(data)))
    want = {}
    for c, h, v, s in sorted(data, key=lambda r: r[3]):
        want[c, T0 + dt.timedelta(hours=h)] = v
    assert {(c, t): v for c, t, v in read(spark, path)} == want


def test_store_observations_rejects_without_losing_the_rest(spark, folder):
    names = schemas.OBSERVATIONS.fieldNames()
    good = {n: None for n in names} | {"city_name": "a", "time": "2024-01-01 00:10:00", "temp": "3", "is_day": "1"}
    bad = good | {"city_name": "b", "temp": "warm"}
    keyless = [good | {"city_name": None}, good | {"city_name": "c", "time": None}]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in (good, bad, *keyless)], ", ".join(f"{n} string" for n in names))
    rejected = writers.store_observations(spark, folder("obs"), df)
    assert sorted(str(r["city_name"]) for r in rejected.collect()) == ["None", "b", "c"]
    row = readers.read_table(spark, folder("obs")).first()
    assert (row["city_name"], row["temp"], row["is_day"]) == ("a", 3.0, 1)
    assert row["time"] == T0 + dt.timedelta(minutes=10)


def test_replace_keeps_the_old_data_if_there_is_nothing_new(spark, folder):
    df = spark.range(5)
    assert writers.write_replace(df, folder("p")) and writers.write_replace(df.where("id > 2"), folder("p"))
    assert not writers.write_replace(df.where("id > 9"), folder("p"))
    assert readers.read_table(spark, folder("p")).count() == 2
    assert writers.write_csv(df, folder("c")) and not writers.write_csv(df.limit(0), folder("c"))
    assert spark.read.option("header", True).csv(folder("c")).count() == 5


def test_history_types_do_not_depend_on_the_data(spark, folder):
    Path(folder("h.csv")).write_text("city_name,time,humidity,pressure,sea_level,temp,visibility,wind_speed\n"
                                     "Fès,2024-01-01,50,1010,,20,10000,x\n")
    df = readers.read_history(spark, folder("h.csv"))
    row = df.first()
    assert df.schema["time"].dataType == schemas.TS and row["time"] == T0
    assert (row["humidity"], row["sea_level"], row["wind_speed"], row["city_name"]) == (50.0, None, None, "Fès")


def test_csv_columns_are_found_by_name(spark, folder):
    Path(folder("h.csv")).write_text("city_name,time,Temp,humidity,country\nA,2024-01-01,21.5,40,XX\n")
    row = readers.read_history(spark, folder("h.csv")).first()
    assert (row["temp"], row["humidity"], row["pressure"], row["time"]) == (21.5, 40.0, None, T0)
    Path(folder("c.csv")).write_text("Longitude,City,Latitude\n1,B,2\n")
    assert rows(readers.read_cities(spark, folder("c.csv"))) == [("B", 2.0, 1.0)]
    Path(folder("p")).mkdir()
    Path(folder("p"), "1.csv").write_text("variable,extra,city_name,predicted_value,time,time_of_prediction\ntemp,x,a,2.5,2024-01-01,2024-01-02\n")
    good, bad = readers.read_predictions(spark, folder("p"))
    assert [(r["city_name"], r["predicted_value"], r["time"]) for r in good.collect()] == [("a", 2.5, T0)] and bad.isEmpty()
    Path(folder("n.csv")).write_text("temp,humidity\n1,2\n")
    with pytest.raises(ValueError, match="city_name"):
        readers.read_history(spark, folder("n.csv"))


def test_an_older_version_never_replaces_a_newer_one(spark, folder):
    for order in ((1, 2, 3), (3, 2, 1), (2, 3, 1)):
        path = folder(f"t{order[0]}{order[1]}")
        for s in order:
            put(spark, path, batch(spark, ("a", 0, float(s), s)))
        assert read(spark, path) == [("a", T0, 3.0)]


def test_predictions_folder(spark, folder):
    Path(folder("p")).mkdir()
    header = "city_name,time,variable,predicted_value,time_of_prediction\n"
    Path(folder("p"), "1.csv").write_text(
        header + "a,2024-01-01 00:10:00,temp,2.5,2024-01-01 00:20:00\n"
                 "a,2024-01-01 00:00:00,temp,,2024-01-01 00:10:00\n"
                 "a,2024-01-01 00:00:00,temp,oops,2024-01-01 00:10:00\n")
    Path(folder("p"), "2.csv").write_text(header + "a,2024-01-01 00:00:00,humidity,50,2024-01-01 00:10:00\n")
    Path(folder("p"), "notes.txt").write_text("not a part")
    good, bad = readers.read_predictions(spark, folder("p"))
    assert good.count() == 3 and "oops" in bad.first()[0] and bad.count() == 1
    first = {r["variable"]: r["predicted_value"] for r in readers.first_predictions(good).collect()}
    assert first == {"temp": 2.5, "humidity": 50.0}


def test_prediction_parts_have_headers_of_their_own(spark, folder):
    Path(folder("p")).mkdir()
    part = lambda name, text: Path(folder("p"), name).write_bytes(text.encode() if isinstance(text, str) else text)
    part("1.csv", "city_name,time,variable,predicted_value,time_of_prediction\nX,2024-01-01,temp,1.5,2024-01-02\n")
    part("2.csv", "variable,time,city_name,time_of_prediction,predicted_value\ntemp,2024-01-01,Y,2024-01-02,2.5\n")
    part("3.csv", '\ufeffnote,"Variable",city_name , predicted_value\r\n"a, ""b""",temp,Z,3.5\r\nshort,temp,Z\r\nlong,temp,Z,1,2,3,4,5\r\n')
    part("4.csv", "city_name,variable\nQ,temp\nQ,temp,7\n")
    part("other.csv", "a,b\n1,2\n")
    part("empty.csv", "")
    part("broken.csv", bytes(range(128, 256)))
    good, bad = readers.read_predictions(spark, folder("p"))
    assert rows(good.select("city_name", "variable", "predicted_value", "time"), "city_name") == [
        ("Q", "temp", None, None), ("X", "temp", 1.5, T0), ("Y", "temp", 2.5, T0), ("Z", "temp", 3.5, None)]
    assert sorted(r[0].strip() for r in bad.collect()) == ["Q,temp,7", "long,temp,Z,1,2,3,4,5", "short,temp,Z"]
    parts = {r["part"]: (r["bytes"], r["reason"]) for r in readers.unread_parts(spark, folder("p")).collect()}
    assert parts == {"other.csv": (8, "other columns"), "broken.csv": (128, "other columns")}


def test_read_or_empty(spark, folder):
    schema = schemas.struct(a=schemas.L)
    assert readers.read_or_empty(spark, folder("none"), schema).collect() == []
    spark.range(3).select(F.col("id").alias("a")).write.parquet(folder("some"))
    assert readers.read_or_empty(spark, folder("some"), schema).count() == 3


def test_narrow_schema(spark, folder):
    spark.sql("select named_struct('a', 1L, 'b', 2L) s, 3L x").write.parquet(folder("n"))
    got = readers.read_raw(spark, folder("n"), schemas.struct(s=schemas.struct(a=schemas.L, c=schemas.D), y=schemas.L))
    assert got.first().asDict(True) == {"s": {"a": 1, "c": None}, "y": None}


def test_lookups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, t int")
    assert rows(readers.lookup(df, {"k": "a", "t": 2})) == [("a", 2)]
    wanted = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(readers.lookup_many(df, wanted, ["k"]), "t") == [("a", 1), ("a", 2)]


def test_cities(spark, folder):
    Path(folder("c.csv")).write_text("City,Latitude,Longitude\nFès,34.0,-5.0\nBad Ort,x,1\n")
    got = readers.read_cities(spark, folder("c.csv"))
    assert rows(got, "city") == [("Bad Ort", None, 1.0), ("Fès", 34.0, -5.0)]
    names = spark.createDataFrame([("Fès",), ("fes",), (" FÉS",), ("Ksar El-Kebir",), ("ksar el kebir",)], "n string")
    assert [r[0] for r in names.select(readers.city_key("n")).collect()] == ["fes"] * 3 + ["ksar el kebir"] * 2


def test_messages(spark, folder):
    df = spark.createDataFrame([("a", 1.5, None), ("b", 2.0, "x")], "k string, v double, s string")
    sent = writers.to_messages(df, "k")
    assert rows(sent, "key") == [("a", '{"k":"a","v":1.5}'), ("b", '{"k":"b","v":2.0,"s":"x"}')]
    writers.publish(sent, folder("topic"))
    assert readers.read_messages(spark, folder("topic")).count() == 2


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
