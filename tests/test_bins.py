import pandas as pd
from hypothesis import HealthCheck, given, settings, strategies as st

from metframe import schemas
from metframe.functions.expr import bin_index, cut
from metframe.operators.bins import bin_counts, histogram
from metframe.operators.summary import mean_by
from tests.compare import rows

EDGES, LABELS = schemas.TEMPERATURE_EDGES, schemas.TEMPERATURE_LABELS


def values(spark, xs):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")


def test_edges(spark):
    xs = [-10.0, -10.1, 0.0, 39.9, 40.0, 49.9, 50.0, None, float("nan")]
    got = [r[0] for r in values(spark, xs).orderBy("i").select(cut("x", EDGES, LABELS)).collect()]
    assert got == ["<0°C", None, "0-10°C", "30-40°C", ">=40°C", ">=40°C", None, None, None]


def test_humidity_of_100_is_in_no_bin_unless_closed(spark):
    df = values(spark, [0.0, 30.0, 99.9, 100.0])
    edges, labels = schemas.HUMIDITY_EDGES, schemas.HUMIDITY_LABELS
    got = dict(rows(bin_counts(df, "x", edges, labels)))
    assert got == {"<30%": 1, "30-60%": 1, "60-90%": 0, ">=90%": 1}
    assert dict(rows(bin_counts(df, "x", edges, labels, include_upper=True)))[">=90%"] == 2


def test_counts_are_in_order_and_keep_empty_bins(spark):
    got = bin_counts(values(spark, [5.0, 6.0, 15.0]), "x", EDGES, LABELS).collect()
    assert [tuple(r) for r in got] == [
        ("0-10°C", 2), ("10-20°C", 1), ("<0°C", 0), ("20-30°C", 0), ("30-40°C", 0), (">=40°C", 0),
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-60, 60), st.sampled_from([float(e) for e in EDGES])), min_size=1, max_size=40))
def test_same_as_pandas(spark, xs):
    want = pd.cut(pd.Series(xs, dtype=float), bins=EDGES, labels=LABELS, right=False)
    df = values(spark, xs)
    got = [r[0] for r in df.orderBy("i").select(cut("x", EDGES, LABELS)).collect()]
    assert got == [None if pd.isna(w) else w for w in want]
    counts = dict(rows(bin_counts(df, "x", EDGES, LABELS)))
    assert counts == want.value_counts().to_dict()
    outside = df.where(bin_index("x", EDGES).isNull()).count()
    assert sum(counts.values()) + outside == len(xs)


def test_histogram(spark):
    got = rows(histogram(values(spark, [0.0, 1.0, 2.9, 3.0, 3.0, None]), "x", 3))
    assert got == [(0, 1), (1, 1), (2, 3)]
    assert rows(histogram(values(spark, [4.0, 4.0]), "x", 30)) == [(0, 2)]
    assert rows(histogram(values(spark, [None]), "x", 30)) == []


def test_means_skip_nulls_and_null_keys(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", None), ("a", 3.0), (None, 9.0), ("c", None)], "k string, x double")
    assert rows(mean_by(df, ["k"], ["x"])) == [("a", 3.0), ("b", 1.0), ("c", None)]
    pdf = df.toPandas().groupby("k")["x"].mean().reset_index()
    assert list(pdf["k"]) == ["a", "b", "c"]
    assert mean_by(df, ["k"], {"m": "x"}).columns == ["k", "m"]
