"""Schemas of the two provider feeds, the observation table and the model table."""

from __future__ import annotations

from pyspark.sql import types as T

D, L, S, TS, I = T.DoubleType(), T.LongType(), T.StringType(), T.TimestampType(), T.IntegerType()


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


PROVIDER_A = struct(
    coord=struct(lat=D, lon=D),
    weather=T.ArrayType(struct(description=S)),
    main=struct(
        temp=D, feels_like=D, temp_min=D, temp_max=D,
        humidity=L, pressure=L, sea_level=L, grnd_level=L,
    ),
    visibility=L,
    wind=struct(speed=D, deg=L),
    clouds=struct(all=L),
    sys=struct(country=S, sunrise=L, sunset=L),
    name=S,
    dt=L,
)

PROVIDER_B = struct(
    latitude=D,
    longitude=D,
    current=struct(
        time=S, apparent_temperature=D, is_day=L, rain=D, precipitation=D, showers=D, snowfall=D,
        temperature_2m=D, relative_humidity_2m=L, pressure_msl=D, surface_pressure=D,
        cloud_cover=L, weather_code=L,
    ),
    city_name=S,
    elevation=D,
)

# Output column -> path in the nested record.
PATHS_A = {
    "latitude": "coord.lat",
    "longitude": "coord.lon",
    "weather_description": "weather.description",
    "temp": "main.temp",
    "feels_like": "main.feels_like",
    "humidity": "main.humidity",
    "pressure": "main.pressure",
    "sea_level": "main.sea_level",
    "grnd_level": "main.grnd_level",
    "visibility": "visibility",
    "wind_speed": "wind.speed",
    "wind_deg": "wind.deg",
    "clouds_all": "clouds.all",
    "country": "sys.country",
    "sunrise": "sys.sunrise",
    "sunset": "sys.sunset",
    "city_name": "name",
    "time": "dt",
}

PATHS_B = {
    c: f"current.{c}"
    for c in (
        "apparent_temperature", "is_day", "rain", "precipitation", "showers", "snowfall",
        "temperature_2m", "relative_humidity_2m", "pressure_msl", "surface_pressure",
    )
} | {"city_name": "city_name", "elevation": "elevation"}

# What the presentation tables read beyond the columns above.
PATHS_A_CHART = {
    "sea_level": "main.sea_level",
    "humidity": "main.humidity",
    "grnd_level": "main.grnd_level",
    "feels_like": "main.feels_like",
    "temperature": "main.temp",
    "temperature_max": "main.temp_max",
    "temperature_min": "main.temp_min",
    "wind_speed": "wind.speed",
    "wind_deg": "wind.deg",
    "clouds": "clouds.all",
    "country": "sys.country",
    "latitude": "coord.lat",
    "longitude": "coord.lon",
}

PATHS_B_CHART = {
    c: f"current.{c}"
    for c in (
        "apparent_temperature", "cloud_cover", "precipitation", "pressure_msl", "rain",
        "relative_humidity_2m", "showers", "snowfall", "surface_pressure", "temperature_2m",
        "time", "weather_code",
    )
}

OBSERVATION_KEY = ["city_name", "time"]

OBSERVATIONS = struct(
    latitude=D, longitude=D, temperature_2m=D, temp=D, feels_like=D, humidity=D, pressure=D,
    sea_level=D, grnd_level=D, visibility=D, wind_speed=D, wind_deg=D, clouds_all=D, country=S,
    sunrise=TS, sunset=TS, city_name=S, time=TS, apparent_temperature=D, is_day=I, rain=D,
    precipitation=D, showers=D, snowfall=D, relative_humidity_2m=D, pressure_msl=D,
    surface_pressure=D, elevation=D,
)

# The variables that are forecast, and those compared with what was observed.
FORECAST_VARIABLES = ["humidity", "pressure", "sea_level", "temp", "visibility", "wind_speed"]
COMPARED_VARIABLES = ["temp", "humidity", "pressure", "sea_level"]

# Bin edges (left closed) and labels of the two distribution reports.
TEMPERATURE_EDGES = [-10, 0, 10, 20, 30, 40, 50]
TEMPERATURE_LABELS = ["<0°C", "0-10°C", "10-20°C", "20-30°C", "30-40°C", ">=40°C"]
HUMIDITY_EDGES = [0, 30, 60, 90, 100]
HUMIDITY_LABELS = ["<30%", "30-60%", "60-90%", ">=90%"]

# Batch cadence, share held out, seasonal period.
STEP = "10 minutes"
TEST_SHARE = 0.2
SEASON = 12

HISTORY = struct(city_name=S, time=TS, **{v: D for v in FORECAST_VARIABLES})

PREDICTIONS = struct(
    city_name=S, time=TS, variable=S, predicted_value=D, time_of_prediction=TS,
)

CITIES = struct(city=S, latitude=D, longitude=D)

MODELS = struct(
    city_name=S, variable=S, model=S, coefs=T.MapType(S, D), n_train=L, last_time=TS,
    state=T.ArrayType(D), next_value=D, rmse=D,
)
