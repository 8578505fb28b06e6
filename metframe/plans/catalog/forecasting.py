"""Forecast queries: one series per station and variable of the history view."""

from __future__ import annotations

from pyspark.sql import functions as F

from metframe import schemas
from metframe.functions.expr import time_text
from metframe.operators import forecast as fc
from metframe.operators import seasonal
from metframe.operators.refine import ARIMA, LEVELS, SARIMA, SHRINK, axis, fit_css
from metframe.operators.skew import HOT_ROWS
from metframe.plans import charts, views
from metframe.plans.catalog.ordered import SMALL_PIECE
from metframe.plans.catalog.registry import A, EV, fixed, query, r, rounded, text
from metframe.plans.pipeline import newest_per_city, train
from metframe.session import cut_lineage, scratch_path
from metframe.sources import readers, writers

KEYS, SERIES = ["city_name"], ["city_name", "variable"]
VARIABLES = schemas.FORECAST_VARIABLES

HISTORY_SQL = f"""{EV}, hist as (
  select station as city_name, ts as time, case when event_type <> 'error' then k end as humidity,
         1000 + k % 40 as pressure, case when event_type <> 'signup' then 1010 + k % 7 end as sea_level,
         value / 10 - 10 as temp, 10000 - k * 50 as visibility, k / 10 as wind_speed
  from ev)"""

LAGS_SQL = f"""{HISTORY_SQL}, filled as (
  select city_name, time, last_value(humidity ignore nulls) over w as humidity, pressure,
         last_value(sea_level ignore nulls) over w as sea_level, temp, visibility, wind_speed
  from hist window w as (partition by city_name order by time rows between unbounded preceding and current row)),
stacked as ({' union all '.join(
    f"select city_name, time, '{v}' as variable, {v}::double as y from filled" for v in VARIABLES)}),
placed as (
  select *, row_number() over w as pos, count(*) over (partition by city_name, variable) as n_rows,
         {', '.join(f'lag(y, {i}) over w - lag(y, {i + 1}) over w as w{i}' for i in range(4))}
  from stacked window w as (partition by city_name, variable order by time)),
series as (select *, n_rows - ceil(0.2::double * n_rows)::bigint as n_train from placed)"""

FIT_SQL = f"""{LAGS_SQL}, sums as (
  select city_name, variable, count(*) as n_obs,
         {', '.join(f'sum(w{i} * w{j}) as s{i}{j}' for i in range(4) for j in range(i, 4))}
  from series
  where pos <= n_train and w0 is not null and w1 is not null and w2 is not null and w3 is not null
  group by city_name, variable),
step1 as (
  select *, (s01 * s22 - s02 * s12) / d1 as a1, (s02 * s11 - s01 * s12) / d1 as a2
  from (select *, case when abs(s11 * s22 - s12 * s12) > 1e-9 * abs(s11 * s22)
                  then s11 * s22 - s12 * s12 end as d1 from sums)),
step2 as (
  select *, s11 - a1 * s12 - a2 * s13 as we,
         s11 + a1 * a1 * s22 + a2 * a2 * s33 - 2 * a1 * s12 - 2 * a2 * s13 + 2 * a1 * a2 * s23 as ee,
         s01 - a1 * s02 - a2 * s03 as ye
  from step1),
step3 as (
  select *, case when n_obs >= 8 then (s01 * ee - ye * we) / d2 end as phi0,
            case when n_obs >= 8 then (ye * s11 - s01 * we) / d2 end as theta0
  from (select *, case when abs(s11 * ee - we * we) > 1e-9 * abs(s11 * ee) then s11 * ee - we * we end as d2 from step2)),
fit as (
  select city_name, variable, n_obs,
         case when phi0 is not null then greatest(-0.99::double, least(0.99::double, phi0)) end as phi,
         case when theta0 is not null then greatest(-0.99::double, least(0.99::double, theta0)) end as theta
  from step3)"""


def state_sql(name, end):
    return f"""{name} as (
  select s.city_name, s.variable, f.phi, f.theta, count(*) as n_train,
         max(case when pos = {end} then time end) as last_time,
         max(case when pos = {end} then y end) as last_value, max(case when pos = {end} then w0 end) as last_diff,
         sum(pow(-f.theta, ({end} - pos)::double) * (w0 - f.phi * w1)) as last_residual
  from series s join fit f on s.city_name = f.city_name and s.variable = f.variable
  where f.phi is not null and f.theta is not null and pos <= {end}
  group by s.city_name, s.variable, f.phi, f.theta)"""


def ahead_sql(h, alias=""):
    p = f"{alias}." if alias else ""
    return (f"({p}last_value + ({p}phi * {p}last_diff + {p}theta * {p}last_residual) "
            f"* (1 - pow({p}phi, {h})) / (1 - {p}phi))")


STATE_SQL = f"{FIT_SQL}, {state_sql('state', 'n_train')}"
SCORE_SQL = f"""{STATE_SQL}, score as (
  select s.city_name, s.variable,
         case when count(*) = count(s.y) then sqrt(avg(pow(s.y - {ahead_sql('(s.pos - s.n_train)', 't')}, 2))) end as rmse,
         case when count(*) = count(s.y) then sqrt(avg(pow(s.y - t.last_value, 2))) end as walk
  from series s join state t on s.city_name = t.city_name and s.variable = t.variable
  where s.pos > s.n_train group by s.city_name, s.variable)"""


def rows_of(spark, sf, hot=HOT_ROWS):
    return fc.series_rows(views.history(spark, sf), KEYS, "time", VARIABLES, hot=hot)


ARIMA_FIT = f"with {FIT_SQL} select city_name, variable, n_obs, {r('phi', 4)} as phi, {r('theta', 4)} as theta from fit"


@query("arima_fit", ARIMA_FIT)
def arima_fit(spark, sf):
    """All series fitted from one set of sums."""
    rows = rows_of(spark, sf)
    return rounded(fc.fit_arima(rows.with_lags(range(5)), SERIES), ["phi", "theta"], 4)


@query("arima_fit_hot", ARIMA_FIT)
def arima_fit_hot(spark, sf):
    """G1 with every series cut into pieces."""
    rows = rows_of(spark, sf, SMALL_PIECE)
    return rounded(fc.fit_arima(rows.with_lags(range(5)), SERIES), ["phi", "theta"], 4)


def shown_state(states):
    out = states.select(
        *SERIES, "n_train", time_text("last_time").alias("last_time"), "last_value", "last_diff", "last_residual"
    )
    return rounded(out, ["last_value", "last_diff", "last_residual"], 4)


STATE_SHOWN = f"""select city_name, variable, n_train, {text('last_time')} as last_time, {r('last_value', 4)} as last_value,
       {r('last_diff', 4)} as last_diff, {r('last_residual', 4)} as last_residual from state"""


@query("arima_state", f"with {STATE_SQL} {STATE_SHOWN}")
def arima_state(spark, sf):
    """What a model keeps of its train part."""
    return shown_state(fc.arima_states(rows_of(spark, sf)))


@query("arima_forecast", f"""
with {STATE_SQL}
select city_name, variable, h::integer as h, {r(ahead_sql('h'), 4)} as forecast
from state, (select unnest(range(1, 7)) as h)""")
def arima_forecast(spark, sf):
    """Six steps ahead in closed form."""
    return rounded(fc.forecast(fc.arima_states(rows_of(spark, sf)), SERIES, 6), ["forecast"], 4)


ARIMA_SCORE = f"with {SCORE_SQL} select city_name, variable, {r('rmse', 4)} as rmse from score"


@query("arima_score", ARIMA_SCORE)
def arima_score(spark, sf):
    """Forecasts over the held-out part."""
    rows = rows_of(spark, sf)
    return rounded(fc.score_arima(rows, fc.arima_states(rows)), ["rmse"], 4)


@query("arima_score_hot", ARIMA_SCORE)
def arima_score_hot(spark, sf):
    """G3, G4, A10 with every series cut into pieces."""
    rows = rows_of(spark, sf, SMALL_PIECE)
    return rounded(fc.score_arima(rows, fc.arima_states(rows)), ["rmse"], 4)


def two_candidates(spark, sf):
    """The fitted model, and the same with both coefficients zero under the seasonal model's name:
    candidates whose scores SQL can work out."""
    rows = rows_of(spark, sf)
    states = fc.arima_states(rows)
    zero = states.withColumns({"phi": F.lit(0.0), "theta": F.lit(0.0)})
    fitted = fc.score_arima(rows, states).withColumn("model", F.lit("arima"))
    return fitted.unionByName(fc.score_arima(rows, zero).withColumn("model", F.lit("sarimax")))


@query("model_select", f"""
with {SCORE_SQL}
select city_name, variable, case when rmse < walk then 'arima' else 'sarimax' end as model,
       {r('least(rmse, walk)', 4)} as rmse from score where rmse is not null""")
def model_select(spark, sf):
    """Smallest score wins, a failed score never."""
    return rounded(fc.select_model(two_candidates(spark, sf), SERIES).select(*SERIES, "model", "rmse"), ["rmse"], 4)


@query("model_lookup", f"""
with {SCORE_SQL} select city_name, variable, 'arima' as model, {r('rmse', 4)} as rmse from score""")
def model_lookup(spark, sf):
    """By kind alone, where a table holds several models of a series."""
    return rounded(fc.lookup_model(two_candidates(spark, sf), SERIES).select(*SERIES, "model", "rmse"), ["rmse"], 4)


def stored_models(spark, sf):
    path = scratch_path(spark, "models")
    writers.write_models(fc.arima_models(rows_of(spark, sf)), path)
    return readers.read_table(spark, path)


@query("model_table", f"""
with {SCORE_SQL}
select t.city_name, t.variable, 'arima' as model, {r('phi', 4)} as phi, {r('theta', 4)} as theta, n_train,
       {r(ahead_sql('1', 't'), 4)} as next_value, {r('rmse', 4)} as rmse
from state t join score s on t.city_name = s.city_name and t.variable = s.variable""")
def model_table(spark, sf):
    """One row per series, written and read back."""
    out = stored_models(spark, sf).select(
        *SERIES, "model", F.col("coefs.phi").alias("phi"), F.col("coefs.theta").alias("theta"), "n_train",
        "next_value", "rmse",
    )
    return rounded(out, ["phi", "theta", "next_value", "rmse"], 4)


def predictions(spark, sf):
    """Predictions for the newest row of each station; visibility has no model here."""
    models = stored_models(spark, sf).where(F.col("variable") != "visibility")
    return fc.predict(newest_per_city(views.history(spark, sf)), models, KEYS, "time", VARIABLES)


PREDICT_SQL = f"""{STATE_SQL}, newest as (select city_name, max(time) as time from hist group by city_name),
guess as (
  select n.city_name, n.time, v.variable, case when t.phi is not null then {ahead_sql('1', 't')} end as predicted_value,
         case when t.phi is not null then n.time + interval 10 minute end as time_of_prediction
  from newest n cross join (select unnest({VARIABLES!r}) as variable) v
  left join state t on t.city_name = n.city_name and t.variable = v.variable and t.variable <> 'visibility')"""


@query("predict_next", f"""
with {PREDICT_SQL}
select city_name, {text('time')} as time, variable, {r('predicted_value', 4)} as predicted_value,
       {text('time_of_prediction')} as time_of_prediction from guess""")
def predict_next(spark, sf):
    """One step ahead for every station and variable, null without a model."""
    out = predictions(spark, sf).withColumns({c: time_text(c) for c in ("time", "time_of_prediction")})
    return rounded(out, ["predicted_value"], 4)


@query("predict_latest", f"""
with {FIT_SQL}, {state_sql('state', 'n_rows')}
select city_name, variable, {text('last_time')} as last_time, {r(ahead_sql('1'), 4)} as next_value from state""")
def predict_latest(spark, sf):
    """G8, other mode: the same models from the newest observation on."""
    moved = fc.reanchor(stored_models(spark, sf), views.history(spark, sf), KEYS, "time", VARIABLES)
    return rounded(
        moved.select(*SERIES, time_text("last_time").alias("last_time"), "next_value"), ["next_value"], 4
    )


ACTUAL_SQL = f"""{PREDICT_SQL}, act as (
  select station as city, event_id, case when k % 10 <> 9 then value / 10 - 10 end as temp,
         case when k % 10 <> 9 then k end as humidity, case when k % 10 <> 9 then 1000 + k % 40 end as pressure,
         case when k % 10 <> 9 and event_type <> 'signup' then 1010 + k % 7 end as sea_level
  from ev where event_type in ('view', 'click', 'signup')),
err as (
  select a.city, g.variable, g.time_of_prediction, a.actual, g.predicted_value as predicted,
         abs(a.actual - g.predicted_value) as error
  from ({' union all '.join(
      f"select city, '{v}' as variable, {v}::double as actual from act" for v in schemas.COMPARED_VARIABLES)}) a
  join guess g on a.city = g.city_name and a.variable = g.variable)"""


def errors(spark, sf):
    return fc.forecast_errors(
        charts.compared_actuals(views.raw_a(spark, sf)), cut_lineage(predictions(spark, sf)), "city",
        schemas.COMPARED_VARIABLES,
    )


@query("forecast_errors", f"""
with {ACTUAL_SQL}
select city, variable, {text('time_of_prediction')} as time_of_prediction, {r('actual', 4)} as actual,
       {r('predicted', 4)} as predicted, {r('error', 4)} as error from err""")
def forecast_errors(spark, sf):
    """G9, E10, P6, J3 in long form."""
    out = errors(spark, sf).withColumn("time_of_prediction", time_text("time_of_prediction"))
    return rounded(out, ["actual", "predicted", "error"], 4)


@query("error_trend", f"""
with {ACTUAL_SQL}
select {text('time_of_prediction')} as time_of_prediction, variable, {r('avg(error)', 3)} as mean_error
from err group by 1, 2""")
def error_trend(spark, sf):
    """G10, C13."""
    out = fc.error_trend(errors(spark, sf)).withColumn("time_of_prediction", time_text("time_of_prediction"))
    return rounded(out, ["mean_error"], 3)


@query("actual_and_predicted", f"""
with {ACTUAL_SQL}
select city, variable, {text('time_of_prediction')} as time_of_prediction, 'actual' as kind, {r('actual', 4)} as value from err
union all select city, variable, {text('time_of_prediction')}, 'predicted', {r('predicted', 4)} from err""")
def actual_and_predicted(spark, sf):
    """G11, C13."""
    out = fc.actual_and_predicted(errors(spark, sf), "city").withColumn(
        "time_of_prediction", time_text("time_of_prediction")
    )
    return rounded(out, ["value"], 4)


@query("merge_predictions", f"""
with {ACTUAL_SQL}, wide as (
  select city_name as city, max(time_of_prediction) as time_of_prediction,
         {', '.join(f"min(predicted_value) filter (where variable = '{v}') as {v}" for v in schemas.COMPARED_VARIABLES)}
  from guess group by city_name)
select a.city, {text('w.time_of_prediction')} as time_of_prediction_predit,
       {', '.join(f"{r(f'a.{v}', 4)} as {v}_reel, {r(f'w.{v}', 4)} as {v}_predit" for v in schemas.COMPARED_VARIABLES)}
from act a join wide w on a.city = w.city""")
def merge_predictions(spark, sf):
    """J3, A8, P10, C13 in wide form."""
    out = fc.merge_predictions(
        charts.compared_actuals(views.raw_a(spark, sf)), cut_lineage(predictions(spark, sf)), "city",
        schemas.COMPARED_VARIABLES,
    ).withColumn("time_of_prediction_predit", time_text("time_of_prediction_predit"))
    return rounded(out, [c for c in out.columns if c not in ("city", "time_of_prediction_predit")], 4)


def seasonal_sql(history):
    """Rows ``sd`` of every series with the twice-differenced value ``w0`` and its lags ``w1`` to ``w26``."""
    lags = ", ".join(f"lag(w0, {k}) over w as w{k}" for k in seasonal.LAGS[1:])
    return f"""{LAGS_SQL.replace(HISTORY_SQL, history)},
sy as (
  select city_name, variable, time, y, pos, n_train, (y - lag(y, 1) over w) - (lag(y, 12) over w - lag(y, 13) over w) as w0
  from series window w as (partition by city_name, variable order by pos)),
sd as (select *, {lags} from sy window w as (partition by city_name, variable order by pos))"""


def eliminated(name, source, n, keep):
    """Tables that solve the symmetric systems m_i_j x = b_i of ``source`` by elimination: ``name`` has x0 and so on."""
    steps, before = [], source
    for k in range(n - 1):
        columns = [f"m_{i}_{j} - m_{i}_{k} / m_{k}_{k} * m_{k}_{j} as m_{i}_{j}" for i in range(k + 1, n) for j in range(k + 1, n)]
        columns += [f"b_{i} - m_{i}_{k} / m_{k}_{k} * b_{k} as b_{i}" for i in range(k + 1, n)]
        steps.append(f"{name}_{k} as (select * replace ({', '.join(columns)}) from {before})")
        before = f"{name}_{k}"
    for i in reversed(range(n)):
        known = "".join(f" - m_{i}_{j} * x{j}" for j in range(i + 1, n))
        steps.append(f"{name}_x{i} as (select *, (b_{i}{known}) / m_{i}_{i} as x{i} from {before})")
        before = f"{name}_x{i}"
    return ", ".join([*steps, f"{name} as (select {keep}, {', '.join(f'x{i}' for i in range(n))} from {before})"])


def regressed(regressors):
    """Sums of products for a regression of w0, as the matrix m and the right side b."""
    n = range(len(regressors))
    return ", ".join([
        *[f"sum({regressors[i]} * {regressors[j]}) as m_{i}_{j}" for i in n for j in n],
        *[f"sum({c} * w0) as b_{i}" for i, c in enumerate(regressors)],
    ])


LONG_SQL = HISTORY_SQL.replace("select station as city_name", "select event_type as city_name")

# First the lags of w alone; then w and what the first step left over, one step and one season back.
SARIMA_SQL = f"""{seasonal_sql(LONG_SQL)},
used as (select * from sd where pos <= n_train and w26 is not null),
ar_sums as (select city_name, variable, {regressed(['w1', 'w12', 'w13'])} from used group by city_name, variable),
{eliminated('ar', 'ar_sums', 3, 'city_name, variable')},
left_over as (
  select u.*, w1 - x0 * w2 - x1 * w13 - x2 * w14 as r1, w12 - x0 * w13 - x1 * w24 - x2 * w25 as r12
  from used u join ar using (city_name, variable)),
ma_sums as (
  select city_name, variable, {regressed(['w1', 'r1', 'w12', 'r12'])} from left_over group by city_name, variable having count(*) >= 36),
{eliminated('ma', 'ma_sums', 4, 'city_name, variable')},
sfit as (select city_name, variable, {', '.join(
    f"greatest(-0.95::double, least(0.95::double, x{i})) as {c}" for i, c in enumerate(('phi', 'theta', 'sphi', 'stheta')))} from ma)"""

# Over positions, the newest 13 values first: the residuals of the train part, then the forecasts.
WALK_SQL = f"""path as (select *, row_number() over (partition by city_name, variable order by pos) as step from sy where y is not null),
walked as (
  select city_name, variable, 0::bigint as step, [0::double for i in range(13)] as ys, [0::double for i in range(13)] as ws,
         [0::double for i in range(13)] as es, phi, theta, sphi, stheta from sfit
  union all
  select city_name, variable, step, list_prepend(case when known then y else ahead + ys[1] + ys[12] - ys[13] end, ys[:12]),
         list_prepend(case when not known then ahead when step < 14 then 0 else w end, ws[:12]),
         list_prepend(case when known and step >= 27 then w - ahead else 0 end, es[:12]), phi, theta, sphi, stheta
  from (
    select r.city_name, r.variable, s.step, s.y, s.pos <= s.n_train as known,
           s.y - ys[1] - ys[12] + ys[13] as w, ys, ws, es, phi, theta, sphi, stheta,
           phi * ws[1] + sphi * ws[12] - phi * sphi * ws[13] + theta * es[1] + stheta * es[12] + theta * stheta * es[13] as ahead
    from walked r join path s on r.city_name = s.city_name and r.variable = s.variable and s.step = r.step + 1)),
ended as (select w.*, p.y, p.pos, p.n_train from walked w join path p using (city_name, variable, step)),
heads as (
  select city_name, variable, n_train,
         ys[1] + ys[12] - ys[13] + phi * ws[1] + sphi * ws[12] - phi * sphi * ws[13]
           + theta * es[1] + stheta * es[12] + theta * stheta * es[13] as next_value
  from ended where pos = n_train),
scores as (select city_name, variable, sqrt(avg(pow(y - ys[1], 2))) as rmse from ended where pos > n_train group by 1, 2)"""


@query("sarima_sums", f"""
with {seasonal_sql(HISTORY_SQL)}
select city_name, variable, count(*) as n_obs, {', '.join(
    f"{r(f'sum(w{a} * w{b})', 3)} as s_{a}_{b}" for i, a in enumerate(seasonal.LAGS) for b in seasonal.LAGS[i:])}
from sd where pos <= n_train and w26 is not null group by city_name, variable""")
def sarima_sums(spark, sf):
    """All the sums that the seasonal fit is solved from, for every variable."""
    sums = seasonal.lag_sums(rows_of(spark, sf).with_lags(seasonal.Y_LAGS), SERIES)
    pairs = [(a, b) for i, a in enumerate(seasonal.LAGS) for b in seasonal.LAGS[i:]]
    return sums.select(*SERIES, "n_obs", *[fixed(F.col("sums")[i], 3).alias(f"s_{a}_{b}") for i, (a, b) in enumerate(pairs)])


def long_rows(spark, sf):
    """Five long series, each a fifth of all rows."""
    return fc.series_rows(views.history(spark, sf, "event_type"), KEYS, "time", VARIABLES)


def searched(name, kind, values):
    """Tables of the search in ``refine``, the last one ``name`` with the best coefficients of every series; the
    moving-average part is undone by recursion over the rows of ``values`` (city_name, variable, pos, w)."""
    pairs = [(a, b) for i, a in enumerate(kind.lags) for b in kind.lags[i:]]
    key, lim = "city_name, variable, theta, stheta", f"{kind.limit:e}"
    out = [f"{name}_path as materialized (select *, row_number() over (partition by city_name, variable order by pos) as step from {values})"]
    for level in range(LEVELS):
        n, before = f"{name}{level}", f"{name}{level - 1}"
        if level == 0:
            coarse = "[" + ", ".join(f"{x:.17e}" for x in axis(kind.limit, kind.points, 0, None)) + "]"
            every = (f"cross join (select unnest({coarse}) as theta) "
                     f"cross join (select unnest({coarse if kind.seasonal else '[0e0]'}) as stheta)")
            points = f"select city_name, variable, theta, stheta from (select distinct city_name, variable from {name}_path) {every}"
        else:
            step = 2 * kind.limit / (kind.points - 1) / SHRINK**level
            near = f"cross join (select unnest(range(-2, 3)) as i) cross join (select unnest({'range(-2, 3)' if kind.seasonal else '[0]'}) as j)"
            moved = [f"greatest(-{lim}, least({lim}, {c} + {i} * {step:.17e})) as {c}" for c, i in (("theta", "i"), ("stheta", "j"))]
            points = f"select distinct city_name, variable, {', '.join(moved)} from {before} {near}"
        out += [
            f"{n}_points as materialized ({points})",
            f"""{n}_inner as (
  select distinct city_name, variable, theta, 0::bigint as step, 0::double as u from {n}_points
  union all
  select r.city_name, r.variable, r.theta, s.step, s.w - r.theta * r.u
  from {n}_inner r join {name}_path s on r.city_name = s.city_name and r.variable = s.variable and s.step = r.step + 1)""",
            f"""{n}_outer as (
  select p.city_name, p.variable, p.theta, p.stheta, step, u
  from {n}_points p join {n}_inner i on p.city_name = i.city_name and p.variable = i.variable and p.theta = i.theta
  where step between 1 and 12
  union all
  select r.city_name, r.variable, r.theta, r.stheta, i.step, i.u - r.stheta * r.u
  from {n}_outer r join {n}_inner i
    on r.city_name = i.city_name and r.variable = i.variable and r.theta = i.theta and i.step = r.step + 12)""",
            f"{n}_lags as (select *, {', '.join(f'lag(u, {k}) over w as u{k}' for k in kind.lags)} from {n}_outer window w as (partition by {key} order by step))",
            f"{n}_sums as materialized (select {key}, count(*) as n, {', '.join(f'sum(u{a} * u{b}) as s_{a}_{b}' for a, b in pairs)} "
            f"from {n}_lags where u{max(kind.lags)} is not null group by {key} having count(*) >= {kind.min_obs} and sum(u0 * u0) > 0)",
            *(turns(n, lim) if kind.seasonal else [
                f"{n}_ar as (select *, 0e0 as sphi, case when s_1_1 > 0 then greatest(-{lim}, least({lim}, s_0_1 / s_1_1)) end as phi from {n}_sums)"]),
            f"{n}_sse as (select *, s_0_0 - 2 * phi * s_0_1 + phi * phi * s_1_1 as sse from {n}_ar)" if not kind.seasonal else
            f"{n}_sse as (select *, {' + '.join(f'{1 if a == b else 2} * {WEIGHTS[a]} * {WEIGHTS[b]} * s_{a}_{b}' for a, b in pairs)} as sse from {n}_ar)",
            f"{n} as materialized (select city_name, variable, phi, theta, sphi, stheta, n from {n}_sse where sse is not null "
            "qualify row_number() over (partition by city_name, variable order by sse, abs(theta), abs(stheta), theta, stheta) = 1)",
        ]
    return ", ".join([*out, f"{name} as (select * from {name}{LEVELS - 1})"])


WEIGHTS = {0: "1", 1: "-phi", 12: "-sphi", 13: "phi * sphi"}


def turns(n, lim):
    """phi and the seasonal phi by turns, 25 times."""
    def ratio(top, bottom):
        return f"case when {bottom} > 0 then greatest(-{lim}, least({lim}, ({top}) / ({bottom}))) else 0 end"
    phi = ratio("s_0_1 - sphi * s_0_13 - sphi * s_1_12 + sphi * sphi * s_12_13", "s_1_1 - 2 * sphi * s_1_13 + sphi * sphi * s_13_13")
    sphi = ratio("s_0_12 - phi * s_0_13 - phi * s_1_12 + phi * phi * s_1_13", "s_12_12 - 2 * phi * s_12_13 + phi * phi * s_13_13")
    return [
        f"""{n}_turns as (
  select *, 0 as turn, 0e0 as phi, 0e0 as sphi from {n}_sums
  union all
  select * replace ({sphi} as sphi) from (select * replace (turn + 1 as turn, {phi} as phi) from {n}_turns where turn < 25))""",
        f"{n}_ar as (select * from {n}_turns where turn = 25)",
    ]


CHOSEN_SQL = f"{state_sql('state', 'n_train').replace('join fit f', 'join css f')}, {SCORE_SQL.split(STATE_SQL + ', ')[1]}"
ARIMA_CSS = f"""{LAGS_SQL.replace(HISTORY_SQL, LONG_SQL)},
css_w as (select city_name, variable, pos, w0 as w from series where pos <= n_train and w0 is not null),
{searched('css', ARIMA, 'css_w')}"""
SARIMA_CSS = f"""{seasonal_sql(LONG_SQL)},
scss_w as (select city_name, variable, pos, w0 as w from sd where pos <= n_train and w0 is not null),
{searched('scss', SARIMA, 'scss_w')}"""


@query("arima_css", f"with recursive {ARIMA_CSS} select city_name, variable, {r('phi', 4)} as phi, {r('theta', 6)} as theta, n from css")
def arima_css(spark, sf):
    """G1 by least squares instead of sums."""
    return rounded(rounded(fit_css(long_rows(spark, sf), ARIMA).select(*SERIES, "phi", "theta", "n"), ["phi"], 4), ["theta"])


@query("sarima_css", f"""
with recursive {SARIMA_CSS} select city_name, variable, {r('phi', 4)} as phi, {r('theta', 6)} as theta,
  {r('sphi', 4)} as seasonal_phi, {r('stheta', 6)} as seasonal_theta, n from scss""")
def sarima_css(spark, sf):
    """G2 by least squares."""
    out = fit_css(long_rows(spark, sf), SARIMA).select(*SERIES, *seasonal.COEFS, "n")
    return rounded(rounded(out, ["phi", "seasonal_phi"], 4), ["theta", "seasonal_theta"])


@query("sarima_models", f"""
with recursive {SARIMA_SQL}, {WALK_SQL}
select city_name, variable, 'sarimax' as model, n_train, {r('phi', 4)} as phi, {r('theta', 4)} as theta, {r('sphi', 4)} as seasonal_phi,
       {r('stheta', 4)} as seasonal_theta, {r('next_value', 3)} as next_value, {r('rmse', 3)} as rmse
from heads join scores using (city_name, variable) join sfit using (city_name, variable)""")
def sarima_models(spark, sf):
    """Seasonal models from sums; coefficients, the next value and the score."""
    models = seasonal.sarima_models(long_rows(spark, sf))
    out = models.select(*SERIES, "model", "n_train", *[F.col("coefs")[c].alias(c) for c in seasonal.COEFS], "next_value", "rmse")
    return rounded(rounded(out, seasonal.COEFS, 4), ["next_value", "rmse"], 3)


@query("train_models", f"""
with recursive {SARIMA_CSS},
css_w as (select city_name, variable, pos, w0 as w from series where pos <= n_train and w0 is not null),
{searched('css', ARIMA, 'css_w')}, {CHOSEN_SQL},
sfit as (select * from scss), {WALK_SQL},
found as (
  select city_name, variable, 'arima' as model, n_train, {ahead_sql('1')} as next_value, rmse, 2 as rank from state join score using (city_name, variable)
  union all select city_name, variable, 'sarimax', n_train, next_value, rmse, 1 from heads join scores using (city_name, variable))
select city_name, variable, model, n_train, {r('next_value', 3)} as next_value, {r('rmse', 3)} as rmse from found where rmse is not null
qualify row_number() over (partition by city_name, variable order by rmse, rank) = 1""")
def train_models(spark, sf):
    """Both kinds fitted, the better one kept and stored."""
    path = scratch_path(spark, "models")
    writers.write_models(train(views.history(spark, sf, "event_type")), path)
    return rounded(readers.read_table(spark, path).select(*SERIES, "model", "n_train", "next_value", "rmse"), ["next_value", "rmse"], 3)
