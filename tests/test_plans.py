"""What the physical plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name, mode="formatted"):
    df = entry.queries()[name](spark, SF_DIR)
    jvm_mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(jvm_mode)


ALL_JVM = [
    "blend_join", "blend_observations", "histogram30", "source_compare", "ffill_hot", "differences_hot",
    "arima_score", "positional_label",
]


@pytest.mark.parametrize("name", ALL_JVM)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for word in ("InPandas", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word


@pytest.mark.parametrize("name,shuffles", [
    ("flatten_a", 0), ("wide_to_long", 0), ("nearest_station", 0), ("scalar_expressions", 0), ("bin_labels", 0),
    ("bin_counts", 1), ("long_to_wide", 1), ("latest_per_key", 1), ("ffill", 1), ("chrono_split", 1),
    ("arima_fit", 1), ("differences", 1), ("first_nonnull", 1),
])
def test_shuffles(spark, name, shuffles):
    assert len(re.findall(r"^[ :+-]*Exchange ", plan(spark, name, "simple"), re.M)) == shuffles


def test_group_limit_is_below_the_shuffle(spark):
    text = plan(spark, "latest_per_key", "simple")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "Partial" in plan(spark, "positional_label", "simple")
    assert "TakeOrderedAndProject" in plan(spark, "top_n_latest", "simple")


def test_scans_read_what_they_need(spark):
    assert re.search(r"ReadSchema: struct<event_id:bigint,event_type:string,value:double>", plan(spark, "series_filter"))
    assert "EqualTo(event_type,purchase)" in plan(spark, "series_filter")
    assert "EqualTo(user_id," in plan(spark, "point_lookup")
    assert re.search(r"ReadSchema: struct<value:double>", plan(spark, "bin_counts"))


def test_nested_columns_are_pruned(spark, folder):
    from metframe import schemas
    from metframe.plans import charts, views
    from metframe.sources import readers

    views.raw_a(spark, SF_DIR).write.parquet(folder("raw"))
    df = charts.visibility_per_city(readers.read_raw(spark, folder("raw"), schemas.PROVIDER_A))
    jvm_mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(jvm_mode)
    assert "ReadSchema: struct<visibility:bigint,name:string>" in text
    df = charts.temperature_and_felt(readers.read_raw(spark, folder("raw"), schemas.PROVIDER_A))
    text = df._jdf.queryExecution().explainString(jvm_mode)
    assert "main:struct<temp:double,feels_like:double>" in text and "wind" not in text


def test_day_partitions_are_pruned(spark, folder):
    from pyspark.sql import functions as F

    from metframe.sources import readers, writers
    from metframe.plans import views
    from metframe.plans.catalog.feeds import DAILY, daily

    writers.upsert(spark, folder("t"), daily(views.events(spark, SF_DIR)), ["city_name", "time"], ["event_id"], DAILY)
    df = readers.read_table(spark, folder("t")).where("date = date'2024-01-05'")
    jvm_mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "PartitionFilters: [isnotnull(date" in df._jdf.queryExecution().explainString(jvm_mode)
