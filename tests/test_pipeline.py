"""Two batches through all stages."""

import datetime as dt
import json
from pathlib import Path

from metframe import schemas
from metframe.plans import pipeline
from metframe.sources import readers
from tests.compare import rows

T0 = 1_700_000_000


def reading_a(city, step, temp):
    return {"name": city, "dt": T0 + 600 * step, "coord": {"lat": 1.0, "lon": 2.0}, "weather": [{"description": "x"}],
            "main": {"temp": temp, "feels_like": temp, "humidity": 50, "pressure": 1010, "sea_level": 1012},
            "visibility": 9000, "wind": {"speed": 2, "deg": 10}, "clouds": {"all": 3},
            "sys": {"country": "XX", "sunrise": T0, "sunset": T0}}


def reading_b(city, temp, step=0):
    at = dt.datetime.fromtimestamp(T0 + 600 * step, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M")
    return {"city_name": city, "elevation": 3, "current": {
        "time": at, "temperature_2m": temp, "relative_humidity_2m": 60, "apparent_temperature": temp, "is_day": 1}}


def topic(folder, name, records, *broken):
    Path(folder(name)).mkdir()
    Path(folder(name), "0.json").write_text("\n".join([*map(json.dumps, records), *broken]))
    return folder(name)


def test_two_batches(spark, folder):
    places = pipeline.Places(*[folder(n) for n in ("a", "b", "table", "snapshot", "predictions", "models")])
    models = spark.createDataFrame(
        [("Nord", "temp", "arima", {"phi": 0.1}, 10, None, [1.0], 25.0, 0.5)], schemas.MODELS
    )
    models.write.parquet(places.models)
    one = pipeline.run_batch(
        spark, topic(folder, "a1", [reading_a("Nord", 0, 20.0), reading_a("Süd", 0, 30.0)], "broken"),
        topic(folder, "b1", [reading_b("Nord", 22.0), reading_b("Süd", 31.0)]), places,
    )
    assert one["provider_a"].count() == 1 and one["provider_b"].count() == 0 and one["observations"].count() == 0
    assert not readers.path_exists(spark, places.predictions)  # nothing to predict from yet
    pipeline.run_batch(
        spark, topic(folder, "a2", [reading_a("Nord", 1, 21.0)]), topic(folder, "b2", [reading_b("Nord", 23.0, 1)]), places,
    )
    table = readers.read_table(spark, places.table)
    assert rows(table.select("city_name", "temp", "temperature_2m", "humidity"), "city_name", "temp") == [
        ("Nord", 20.0, 21.0, 55.0), ("Nord", 21.0, 22.0, 55.0), ("Süd", 30.0, 30.5, 55.0),
    ]
    # The prediction of the second batch saw the table of the first.
    good, bad = readers.read_predictions(spark, places.predictions)
    assert good.count() == 12 and bad.count() == 0
    hit = good.where("predicted_value is not null").collect()
    assert [(r["city_name"], r["variable"], r["predicted_value"]) for r in hit] == [("Nord", "temp", 25.0)]
    assert (hit[0]["time_of_prediction"] - hit[0]["time"]).total_seconds() == 600
    # The same batch again changes nothing.
    pipeline.run_batch(spark, folder("a2"), folder("b2"), places)
    table = readers.read_table(spark, places.table)
    assert table.count() == 3
    assert rows(pipeline.newest_per_city(table).select("city_name", "temp"), "city_name") == [("Nord", 21.0), ("Süd", 30.0)]
    assert pipeline.snapshot(table, 2).count() == 2


def test_provider_b_is_named_by_its_coordinates(spark, folder):
    places = pipeline.Places(*[folder(n) for n in ("a", "b", "table", "snapshot", "predictions", "models")])
    cities = spark.createDataFrame([("Nord", 60.0, 5.0), ("Süd", 40.0, 5.0)], schemas.CITIES)
    unnamed = [reading_b(None, 31.0) | {"latitude": 40.2, "longitude": 5.1},
               reading_b(None, 22.0) | {"latitude": 59.8, "longitude": 4.9}]
    pipeline.run_batch(
        spark, topic(folder, "a1", [reading_a("Nord", 0, 20.0), reading_a("Nord", 0, 20.0), reading_a("Süd", 0, 30.0)]),
        topic(folder, "b1", [*unnamed, *unnamed]), places, cities=cities,
    )
    table = readers.read_table(spark, places.table)
    assert rows(table.select("city_name", "temperature_2m"), "city_name") == [("Nord", 21.0), ("Süd", 30.5)]


def test_each_reading_meets_the_one_of_its_slot(spark, folder):
    places = pipeline.Places(*[folder(n) for n in ("a", "b", "table", "snapshot", "predictions", "models")])
    pipeline.run_batch(
        spark, topic(folder, "a1", [reading_a("Nord", 0, 10.0), reading_a("Nord", 144, 30.0), reading_a("Nord", 300, 5.0)]),
        topic(folder, "b1", [reading_b("Nord", 12.0), reading_b("Nord", 34.0, 144)]), places,
    )
    assert rows(readers.read_table(spark, places.table).select("temp", "temperature_2m"), "temp") == [(10.0, 11.0), (30.0, 32.0)]


def test_training_keeps_the_listed_cities(spark):
    import math

    data = [
        (c, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=10 * i), float(50 + 10 * math.sin(i * i + k)))
        for k, c in enumerate(("Nord", "Ost")) for i in range(80)
    ]
    history = spark.createDataFrame(data, "city_name string, time timestamp, temp double")
    models = pipeline.train(history, spark.createDataFrame([("Nord",), ("West",)], "city_name string")).collect()
    assert [(m["city_name"], m["variable"], m["n_train"]) for m in models] == [("Nord", "temp", 64)]
    assert set(models[0].asDict()) == set(schemas.MODELS.fieldNames())


def outputs(spark, places):
    good, _ = readers.read_predictions(spark, places.predictions)
    return [
        rows(readers.read_table(spark, places.table).select("city_name", "time", "temp", "temperature_2m"), "city_name", "time"),
        rows(readers.read_history(spark, places.snapshot).select("city_name", "time", "temp"), "city_name", "time"),
        rows(good.select("city_name", "time", "variable", "predicted_value"), "city_name", "time", "variable"),
    ]


def test_a_batch_that_failed_after_any_stage_counts_once(spark, folder):
    topics = [
        (topic(folder, f"a{i}", [reading_a("Nord", i, 20.0 + i), reading_a("Ost", i, 9.0)]),
         topic(folder, f"b{i}", [reading_b("Nord", 22.0 + i, i), reading_b("Ost", 9.0, i)])) for i in range(2)
    ]
    models = spark.createDataFrame([("Nord", "temp", "arima", {"phi": 0.1}, 10, None, [1.0], 25.0, 0.5)], schemas.MODELS)
    seen = []
    for failing in ("none", "snapshot", "land", "predict", "merge"):
        places = pipeline.Places(*[folder(f"{failing}-{n}") for n in ("a", "b", "table", "snapshot", "predictions", "models", "ledger")])
        models.write.parquet(places.models)
        pipeline.run_batch(spark, *topics[0], places, batch=0)

        def fail(stage):
            if stage == failing:
                raise RuntimeError(stage)

        try:
            pipeline.run_batch(spark, *topics[1], places, batch=1, after=fail)
        except RuntimeError:
            assert failing != "none"
            pipeline.run_batch(spark, *topics[1], places, batch=1)
        assert pipeline.run_batch(spark, *topics[1], places, batch=1) == {}
        seen.append(outputs(spark, places))
    assert len(seen[0][0]) == 4 and len(seen[0][1]) == 2 and len(seen[0][2]) == 12
    assert all(s == seen[0] for s in seen)


def test_an_older_batch_run_late_changes_nothing_newer(spark, folder):
    places = pipeline.Places(*[folder(n) for n in ("a", "b", "table", "snapshot", "predictions", "models", "ledger")])
    for batch, temp in ((5, 20.0), (3, 40.0), (6, 30.0)):
        pipeline.run_batch(spark, topic(folder, f"a{batch}", [reading_a("Nord", 0, temp), reading_a("Ost", batch, temp)]),
                           topic(folder, f"b{batch}", [reading_b("Nord", temp), reading_b("Ost", temp, batch)]), places, batch=batch)
        table = readers.read_table(spark, places.table)
        assert table.where("city_name = 'Nord'").first()["temp"] == (30.0 if batch == 6 else 20.0)
    assert table.where("city_name = 'Ost'").count() == 3


def test_a_numbered_batch_needs_a_ledger(spark, folder):
    import pytest

    places = pipeline.Places(*[folder(n) for n in ("a", "b", "table", "snapshot", "predictions", "models")])
    with pytest.raises(ValueError):
        pipeline.run_batch(spark, "a", "b", places, batch=0)


def test_order_columns_are_added_to_a_table_without_them(spark, folder):
    from metframe.sources import writers

    schema = schemas.struct(city_name=schemas.S, time=schemas.TS, temp=schemas.D, number=schemas.L)
    one = spark.createDataFrame([("Nord", dt.datetime(2024, 1, 1), 1.0, 1), ("Ost", dt.datetime(2024, 1, 2), 1.0, 1)], schema)
    two = spark.createDataFrame([("Nord", dt.datetime(2024, 1, 1), 2.0, 2)], schema)
    three = spark.createDataFrame([("Nord", dt.datetime(2024, 1, 1), 3.0, 1), ("Ost", dt.datetime(2024, 1, 2), 3.0, 1)], schema)
    table = schemas.struct(city_name=schemas.S, time=schemas.TS, temp=schemas.D)
    for updates, seq in ((one, []), (two, ["number"]), (three, ["number"])):
        writers.upsert(spark, folder("t"), updates, ["city_name", "time"], seq, table)
    assert rows(readers.read_table(spark, folder("t")).select("city_name", "temp"), "city_name") == [("Nord", 2.0), ("Ost", 3.0)]
