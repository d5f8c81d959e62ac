"""Rolling-origin evaluation, naive and ridge forecasts, intervals, reasons and reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rolling import Step, rolled
from ..functions.windows import ordered
from . import quantiles

HORIZONS = [1, 3, 5, 7, 10]


def _is_cutoff(row: Column, n: Column, windows: int, horizon: int) -> Column:
    back = n - 1 - row
    return (back % horizon == 0) & (back > 0) & (back <= windows * horizon)


def _trained(cutoff: Column, step: Column, train: int) -> tuple[Column, Column]:
    """The first and last row that a fit for a step may see."""
    end = cutoff - step
    return F.greatest(F.lit(0), end - (train - 1)).alias("train_start"), end.alias("train_end")


def rolling_origins(df: DataFrame, *, keys: list[str], time: str, windows: int = 6, horizon: int = 10) -> DataFrame:
    """Each series' last ``windows`` cutoffs, ``horizon`` rows apart, with every step ahead, its date, current close and actual open.
    Series that are too short have fewer."""
    o = ordered(keys, time)
    n = F.count("*").over(Window.partitionBy(*keys))
    ahead = F.array(*(F.struct(F.lit(h).alias("step"), F.lead(time, h).over(o).alias("forecast_date"), F.lead("open", h).over(o).alias("actual_price")) for h in range(1, horizon + 1)))
    df = df.withColumns({"row": F.row_number().over(o) - 1, "_n": n, "_a": ahead})
    df = df.where(_is_cutoff(F.col("row"), F.col("_n"), windows, horizon)).withColumn("window", windows - (F.col("_n") - 1 - F.col("row")) / horizon)
    return df.select(*keys, F.col("window").cast("int").alias("window"), F.col("row").cast("long").alias("cutoff_row"), F.col(time).alias("cutoff_date"), F.col("close").alias("current_price"), F.explode("_a").alias("a")).select("*", "a.*").drop("a")


def history_guard(df: DataFrame, *, keys: list[str], train: int = 1260, windows: int = 6, horizon: int = 10, strict: bool = False) -> DataFrame:
    """Rows of each series and how many it needs: the training window, the horizon of each origin, and one more for the labels. With
    ``strict``, raise if any series is too short."""
    need = train + windows * horizon + horizon
    out = df.groupBy(*keys).agg(F.count("*").alias("rows")).withColumns({"needed": F.lit(need).cast("long"), "ok": F.col("rows") >= need})
    if strict and (short := out.where("not ok").orderBy(*keys).limit(20).collect()):
        raise ValueError(f"series of fewer than {need} rows, among them: " + ", ".join(str(tuple(r[k] for k in keys)) for r in short))
    return out


def federal_holidays(years: DataFrame, *, year: str = "year") -> DataFrame:
    """(date, name) of the US federal holidays of each year, observed on the nearest workday; Juneteenth from 2021 on."""
    y = F.col(year)
    day = lambda m, d: F.make_date(y, F.lit(m), F.lit(d))
    # The n-th given weekday (0: Monday) on or after a date.
    nth = lambda m, wd, n: F.date_add(day(m, 1), (F.lit(7 + wd) - F.weekday(day(m, 1))) % 7 + 7 * (n - 1))
    observed = lambda d: F.when(F.weekday(d) == 5, F.date_sub(d, 1)).when(F.weekday(d) == 6, F.date_add(d, 1)).otherwise(d)
    last_monday = F.date_sub(day(5, 31), F.weekday(day(5, 31)))
    all_ = {
        "new year": observed(day(1, 1)), "king": nth(1, 0, 3), "presidents": nth(2, 0, 3), "memorial": last_monday, "juneteenth": F.when(y >= 2021, observed(day(6, 19))), "independence": observed(day(7, 4)),
        "labor": nth(9, 0, 1), "columbus": nth(10, 0, 2), "veterans": observed(day(11, 11)), "thanksgiving": nth(11, 3, 4), "christmas": observed(day(12, 25)),
    }
    rows = F.array(*(F.struct(d.alias("date"), F.lit(n).alias("name")) for n, d in all_.items()))
    return years.select(F.explode(rows).alias("x")).select("x.*").where("date is not null")


def training_bounds(origins: DataFrame, *, train: int = 1260) -> DataFrame:
    """Rows that a fit for a step may see: none whose label lies after the cutoff."""
    start, end = _trained(F.col("cutoff_row"), F.col("step"), train)
    return origins.withColumns({"train_end": end, "train_start": start, "train_rows": end - start + 1})


def with_folds(features: DataFrame, *, keys: list[str], time: str, horizons: list[int], windows: int = 6, horizon: int = 10, train: int = 1260, before: int = 0) -> DataFrame:
    """Each series' rows from the first that a fold sees, or ``before`` rows before it, to the last cutoff, with ``folds`` at the cutoffs of :func:`rolling_origins`: steps, actual prices and :func:`training_bounds`; null at other rows. Series that are
    too short have no rows. ``features`` has ``row`` and ``open``. Folds that travel on their series' own rows need no join, so rows dealt by series stay where they are."""
    o, every = ordered(keys, time), Window.partitionBy(*keys)
    ahead = F.array(*(F.struct(F.lit(h).alias("step"), F.lead("open", h).over(o).alias("actual_price"), *_trained(F.col("row"), F.lit(h), train)) for h in horizons))
    df = features.withColumns({"_n": F.count("*").over(every), "_a": ahead})
    df = df.withColumn("folds", F.when(_is_cutoff(F.col("row"), F.col("_n"), windows, horizon), F.col("_a"))).drop("_n", "_a")
    cut = lambda x: F.when(F.col("folds").isNotNull(), x)
    first = F.least("row", F.array_min(F.transform("folds", lambda f: f["train_start"])))
    df = df.withColumns({"_from": F.min(cut(first)).over(every) - before, "_to": F.max(cut(F.col("row"))).over(every)})
    return df.where(F.col("row").between(F.col("_from"), F.col("_to"))).drop("_from", "_to")


def production_bounds(df: DataFrame, *, keys: list[str], time: str, horizons: list[int], train: int = 1260) -> DataFrame:
    """The fold of a forecast from each series' last row: its actual prices aren't known yet."""
    o = ordered(keys, time)
    last = df.withColumns({"row": (F.row_number().over(o) - 1).cast("long"), "_n": F.count("*").over(Window.partitionBy(*keys))}).where("row = _n - 1")
    last = last.select(*keys, F.col("row").alias("cutoff_row"), F.col(time).alias("cutoff_date"), F.col("close").alias("current_price"), F.lit(None).cast("double").alias("actual_price"), F.explode(F.array(*map(F.lit, horizons))).alias("step"))
    return training_bounds(last, train=train)


def direct_target(df: DataFrame, *, keys: list[str], time: str, horizons: list[int]) -> DataFrame:
    o = ordered(keys, time)
    log = lambda x: F.when(x > 0, F.log(F.when(x > 0, x)))
    df = df.withColumns({f"target_{h}": log(F.lead("open", h).over(o)) - log(F.col("close")) for h in horizons})
    return df.withColumns({f"price_{h}": F.col("close") * F.exp(f"target_{h}") for h in horizons})


def future_calendar(df: DataFrame, *, keys: list[str], time: str, horizons: list[int]) -> DataFrame:
    """Calendar of the forecast date and the horizon, one row for each step."""
    o = ordered(keys, time)
    rows = F.array(*(F.struct(F.lit(h).alias("step"), F.lead(time, h).over(o).alias("forecast_date")) for h in horizons))
    df = df.withColumn("_rows", rows).select(*keys, time, F.explode("_rows").alias("x")).select(*keys, time, "x.*").where("forecast_date is not null")
    m, d = 2 * F.pi() * F.month("forecast_date") / 12, 2 * F.pi() * F.dayofyear("forecast_date") / 365.25
    return df.withColumns({"month_sin": F.sin(m), "month_cos": F.cos(m), "day_sin": F.sin(d), "day_cos": F.cos(d), "gap_days": F.datediff("forecast_date", time)})


def next_sessions(last: DataFrame, holidays: DataFrame, *, keys: list[str], time: str, n: int = 10) -> DataFrame:
    """The next n business days that are no holiday, after each series' last date. ``holidays``: a calendar's dates, a few for each year."""
    days = last.select(*keys, F.explode(F.sequence(F.date_add(time, 1), F.date_add(time, 2 * n + 14))).alias("forecast_date"))
    days = days.where(F.weekday("forecast_date") < 5).join(F.broadcast(holidays.select(F.col("date").alias("forecast_date"))), "forecast_date", "left_anti")
    return days.withColumn("step", F.row_number().over(Window.partitionBy(*keys).orderBy("forecast_date"))).where(F.col("step") <= n).select(*keys, "step", "forecast_date")


def forecast_metrics(pred: DataFrame, *, by: list[str], horizons: list[int] | None = None) -> DataFrame:
    """RMSE, MAE, MAPE, symmetric MAPE, RMSE by mean price and direction accuracy, in one pass."""
    a, p, c = F.col("actual_price"), F.col("predicted"), F.col("current_price")
    df = pred.where(a.isNotNull() & p.isNotNull())
    df = df.where(F.col("step").isin(horizons)) if horizons else df
    e, m = p - a, (F.abs(a) + F.abs(p)) / 2
    out = df.groupBy(*by).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(F.when(a != 0, 100 * F.abs(e) / F.abs(F.when(a != 0, a)))).alias("mape"), F.avg(F.when(m > 0, 100 * F.abs(e) / F.when(m > 0, m))).alias("smape"),
        F.avg(a).alias("_mean"), F.avg(F.when(F.signum(p - c) == F.signum(a - c), 100.0).otherwise(0.0)).alias("direction"), F.count("*").alias("n"),
    )
    return out.withColumn("nrmse", F.when(F.col("_mean") != 0, 100 * F.col("rmse") / F.when(F.col("_mean") != 0, F.col("_mean")))).drop("_mean")


METRICS = ["rmse", "mae", "mape", "smape", "nrmse", "direction"]


def leaderboard(metrics: DataFrame, *, model: str = "model") -> DataFrame:
    """Plain mean of each metric over horizons; the least RMSE, then MAE, then name, is selected. Few rows: one for each model."""
    df = metrics.groupBy(model).agg(*(F.avg(c).alias(c) for c in METRICS))
    best = df.agg(F.min(F.struct("rmse", "mae", model)).alias("b")).select(F.col(f"b.{model}"))
    return df.withColumn("selected", F.col(model) == best.scalar())


def predictions_wide(pred: DataFrame, *, ids: list[str], models: list[str]) -> DataFrame:
    return pred.groupBy(*ids).agg(*(F.max(F.when(F.col("model") == m, F.col("predicted"))).alias(m) for m in models))


def blend(pred: DataFrame, *, ids: list[str], name: str = "blend") -> DataFrame:
    """Equal weights of all component models."""
    return pred.groupBy(*ids).agg(F.avg("predicted").alias("predicted")).withColumn("model", F.lit(name))


def prediction_intervals(future: DataFrame, past: DataFrame, *, by: list[str], levels: tuple[float, ...] = (0.8, 0.95), large: int = quantiles.LARGE) -> DataFrame:
    """The point plus and minus quantiles of past absolute errors of the same step; those of more than ``large`` errors are selected in ranges."""
    errors = past.where("actual_price is not null and predicted is not null").withColumn("_e", F.abs(F.col("actual_price") - F.col("predicted")))
    names = [f"_q{round(100 * level)}" for level in levels]
    out = future.join(quantiles.quantiles(errors, by=by, value="_e", shares=list(levels), out=names, large=large), by, "left")
    for level, q in zip(levels, names, strict=True):
        out = out.withColumns({f"lower_{round(100 * level)}": F.col("predicted") - F.col(q), f"upper_{round(100 * level)}": F.col("predicted") + F.col(q)})
    return out.drop(*names)


def direction(current: Column, predicted: Column, band: float = 0.05) -> Column:
    change = 100 * (predicted / F.when(current != 0, current) - 1)
    return F.when(change > band, "UP").when(change < -band, "DOWN").when(change.isNotNull(), "FLAT")


@dataclass(frozen=True)
class Driver:
    """How a column speaks for or against a rise: its score is sign * value / scale, held within 3. ``rose`` and ``fell`` are its sentences for values above and below zero, with ``{}`` for the number (its
    size, or with a sign if ``signed``) and ``{also}`` for what another column adds: ``also`` is that column and its clause, left out where it is missing. A value of zero is said to have risen or fallen as ``zero_rose`` tells."""

    scale: float
    sign: int
    name: str
    rose: str
    fell: str
    zero_rose: bool = True
    signed: bool = False
    also: tuple[str, str] | None = None


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf"))


def _number(x: Column, signed: bool) -> Column:
    text = F.round(F.abs(x), 2).cast("decimal(30,2)").cast("string")
    return F.concat(F.when(x < 0, "-").otherwise("+"), text) if signed else text


def _put(template: str, parts: dict[str, Column]) -> Column:
    """``template`` with columns in place of its marks."""
    import re

    return F.concat(*(parts[p] if p in parts else F.lit(p) for p in re.split(r"(\{\}|\{also\})", template) if p))


def driver_evidence(df: DataFrame, *, drivers: dict[str, Driver]) -> DataFrame:
    """``evidence``: for each driver whose column holds a finite number, in order, its score, number, name and a sentence that says which way it went and what that means."""
    made = []
    for i, (c, d) in enumerate(drivers.items()):
        x = F.col(c).cast("double")
        score = F.greatest(F.lit(-3.0), F.least(F.lit(3.0), d.sign * x / d.scale))
        marks = {"{}": _number(x, d.signed)}
        if d.also:
            marks["{also}"] = F.when(_finite(d.also[0]), _put(d.also[1], {"{}": _number(F.col(d.also[0]).cast("double"), True)})).otherwise("")
        text = F.when((x >= 0) if d.zero_rose else (x > 0), _put(d.rose, marks)).otherwise(_put(d.fell, marks))
        made.append(F.when(_finite(c), F.struct(score.alias("score"), F.lit(i).alias("no"), F.lit(d.name).alias("driver"), text.alias("text"))))
    return df.withColumn("evidence", F.filter(F.array(*made), lambda x: x.isNotNull()))


COUNTER = "Counter-signal: "


def top_reasons(df: DataFrame, *, toward: str, k: int = 3) -> DataFrame:
    """The k strongest reasons for the forecast's direction. Where an UP or DOWN has fewer, the strongest that don't support it fill up, marked as counter-signals; a FLAT or unknown direction
    has the k of largest score, either way."""
    sign = F.when(F.col(toward) == "UP", 1.0).when(F.col(toward) == "DOWN", -1.0)
    against = lambda x: F.coalesce(sign * x["score"] <= 0, F.lit(False))
    said = lambda x: F.concat(F.when(against(x), COUNTER).otherwise(""), x["text"])
    ranked = F.transform("evidence", lambda x: F.struct(against(x).alias("against"), (-F.abs(x["score"])).alias("weak"), x["no"].alias("no"), said(x).alias("text")))
    return df.withColumn("reasons", F.transform(F.slice(F.array_sort(ranked), 1, k), lambda x: x["text"]))


def forecast_context(pred: DataFrame, drivers: DataFrame, *, keys: list[str], evidence: dict[str, Driver]) -> DataFrame:
    """Change, direction and reasons of each forecast, from its series' latest driver row."""
    df = driver_evidence(pred.join(drivers, keys, "left"), drivers=evidence)
    df = df.withColumns({"change": F.col("predicted") - F.col("current_price"), "change_pct": 100 * (F.col("predicted") / F.when(F.col("current_price") != 0, F.col("current_price")) - 1), "direction": direction(F.col("current_price"), F.col("predicted"))})
    return top_reasons(df, toward="direction").withColumn("method", F.lit("driver scores")).drop("evidence")


def reconcile(pred: DataFrame, actuals: DataFrame, *, on: list[str]) -> DataFrame:
    """Fill actual prices that are missing and known by now; those that are there stay."""
    df = pred.join(actuals.select(*on, F.col("open").alias("_now")), on, "left")
    return df.withColumn("actual_price", F.when(F.col("actual_price").isNull(), F.col("_now")).otherwise(F.col("actual_price"))).drop("_now")


def live_errors(pred: DataFrame, runs: DataFrame) -> DataFrame:
    """Errors of each forecast of a run's selected model whose actual price is known."""
    df = pred.join(runs.withColumnRenamed("selected_model", "model"), "model").where("actual_price is not null")
    e = F.col("predicted") - F.col("actual_price")
    ids = [c for c in ("run_id", "model", "series", "cutoff_date", "step") if c in df.columns]
    return df.select(*ids, F.abs(e).alias("absolute_error"), (e * e).alias("squared_error"), F.when(F.col("actual_price") != 0, 100 * F.abs(e) / F.col("actual_price")).alias("percent_error"))


def live_forecast_metrics(pred: DataFrame, runs: DataFrame) -> DataFrame:
    """One row for each forecast and metric (n 1), in long form, for :func:`upsert_results`."""
    one = live_errors(pred, runs).withColumns({"rmse": F.sqrt("squared_error"), "mae": F.col("absolute_error"), "mape": F.col("percent_error"), "n": F.lit(1).cast("long")})
    ids = [c for c in one.columns if c in ("run_id", "model", "series", "cutoff_date", "step", "n")]
    return one.select(*ids, "rmse", "mae", "mape").unpivot(ids, ["rmse", "mae", "mape"], "metric", "value")


def live_metrics(pred: DataFrame, runs: DataFrame) -> DataFrame:
    """Per step and per run (step 0) errors in long form, rolled up from those of :func:`live_errors`."""
    one = live_errors(pred, runs)
    errors = [F.sqrt(F.avg("squared_error")).alias("rmse"), F.avg("absolute_error").alias("mae"), F.avg("percent_error").alias("mape"), F.count("*").alias("n")]
    both = one.groupBy("run_id", "model", "step").agg(*errors).unionByName(one.groupBy("run_id", "model").agg(*errors).withColumn("step", F.lit(0)))
    return both.unpivot(["run_id", "model", "step", "n"], ["rmse", "mae", "mape"], "metric", "value")


#: The keys of the result tables.
RESULT_KEYS = {"candidates": ["run_id", "model"], "metrics": ["run_id", "model", "split", "horizon", "metric"], "predictions": ["run_id", "step"], "live_metrics": ["run_id", "model", "series", "cutoff_date", "step", "metric"]}


def upsert_results(base: DataFrame, new: DataFrame, *, table: str, arrival: str) -> DataFrame:
    """``base`` with the rows of ``new`` under the table's keys: of rows of one key the one of the latest ``arrival`` replaces the base's. Running it again
    with the same rows gives the same table. ``arrival`` isn't kept."""
    on = RESULT_KEYS[table]
    if missing := [c for c in [*on, arrival] if c not in new.columns]:
        raise ValueError(f"{table} needs {missing}")
    rank = lambda old, at: F.struct(F.lit(old).alias("new"), at.cast(new.schema[arrival].dataType).alias("at")).alias("_rank")
    both = base.select("*", rank(0, F.lit(None))).unionByName(new.select(*base.columns, rank(1, F.col(arrival))))
    latest = F.max_by(F.struct(*(c for c in base.columns if c not in on)), "_rank").alias("_x")
    return both.groupBy(*on).agg(latest).select(*on, "_x.*").select(*base.columns)


def sequence_frame(df: DataFrame, *, keys: list[str], time: str, cols: list[str], price: str = "close") -> DataFrame:
    """Log price as target, causally filled features, only complete rows, and a dense time index."""
    w = Window.partitionBy(*keys).orderBy(time)
    fill = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.select(*keys, time, F.when(F.col(price) > 0, F.log(F.when(F.col(price) > 0, F.col(price)))).alias("y"), *(F.last(c, ignorenulls=True).over(fill).alias(c) for c in cols)).na.drop(subset=["y", *cols])
    return df.withColumn("time_idx", (F.row_number().over(w) - 1).cast("long"))


def _middle(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The median and the quartile range of each column, as numpy's, from one sort."""
    x, n = np.sort(x, axis=0), len(x)

    def quantile(q: float) -> np.ndarray:
        i, t = int(q * (n - 1)), q * (n - 1) % 1
        a, b = x[i], x[min(i + 1, n - 1)]
        return a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t)

    return (x[(n - 1) // 2] + x[n // 2]) / 2, quantile(0.75) - quantile(0.25)


def ridge_fit(x: np.ndarray, y: np.ndarray, alpha: float) -> tuple:
    """Robust ridge: medians fill gaps, which are marked; columns and target are scaled by median and quartile range of the training rows."""
    missing = np.isnan(x)
    n, have = len(x), len(x) - missing.sum(0)
    low = np.sort(x, axis=0)  # gaps last
    at = lambda i: np.take_along_axis(low, np.clip(i, 0, n - 1)[None], 0)[0]
    med = np.nan_to_num(np.where(have, (at((have - 1) // 2) + at(have // 2)) / 2, 0.0))
    z = np.column_stack([np.where(missing, med, x), missing.astype(float)])
    center, scale = _middle(z)
    scale[scale == 0] = 1
    ym, ys = (float(v[0]) for v in _middle(y[:, None]))
    ys = ys or 1.0
    z, t = (z - center) / scale, (y - ym) / ys
    zm, tm = z.mean(0), t.mean()
    z -= zm
    w = np.linalg.solve(z.T @ z + alpha * np.eye(z.shape[1]), z.T @ (t - tm))
    return med, center, scale, ym, ys, w, tm - zm @ w


def ridge_predict(model: tuple, x: np.ndarray) -> np.ndarray:
    med, center, scale, ym, ys, w, b = model
    missing = np.isnan(x)
    z = (np.column_stack([np.where(missing, med, x), missing.astype(float)]) - center) / scale
    return (z @ w + b) * ys + ym


def _steps(features: DataFrame) -> list[int]:
    return sorted(int(c.removeprefix("target_")) for c in features.columns if c.startswith("target_"))


def _forecast_schema(features: DataFrame, keys: list[str], more: str) -> str:
    own = "cutoff_date date, step int, current_price double, actual_price double, predicted double, train_rows long"
    return ", ".join([*(f"`{k}` {features.schema[k].dataType.simpleString()}" for k in keys), own, *([more] if more else [])])


def _cut_folds(rows: pa.Table, folds: list[dict], fit, *, keys: list[str], cols: list[str], more: str) -> pa.Table:
    """The forecasts of a series' ``folds``, cut from its ``rows``."""
    row = rows["row"].to_numpy()
    order = np.argsort(row, kind="stable")
    row, out = row[order], []
    numbers = lambda c: rows[c].cast(pa.float64()).to_numpy()[order]
    x = np.column_stack([numbers(c) for c in cols])
    own = ["cutoff_date", "step", "current_price", "actual_price"]
    for f in folds:
        inside, at = (row >= f["train_start"]) & (row <= f["train_end"]), row == f["cutoff_row"]
        if not inside.any() and not at.any():
            continue
        y = numbers(f"target_{f['step']}")
        train = inside & ~np.isnan(y)
        value, *rest = fit(x[train], y[train], x[at][:1]) if train.sum() > 2 and at.any() else (float("nan"), *([None] if more else []))
        price = float("nan") if f["current_price"] is None else f["current_price"]
        out.append([*(f[k] for k in keys), *(f[c] for c in own), float(price * np.exp(value)), int(train.sum()), *rest])
    names = [*keys, *own, "predicted", "train_rows", *([more.split()[0]] if more else [])]
    kinds = [*(rows.schema.field(k).type for k in keys), pa.date32(), pa.int32(), *[pa.float64()] * 3, pa.int64(), *([pa.list_(pa.float64())] if more else [])]
    return pa.table([pa.array([r[i] for r in out], t, from_pandas=True) for i, t in enumerate(kinds)], names=names)


def _each_fold(features: DataFrame, bounds: DataFrame, fit, *, keys: list[str], cols: list[str], more: str, parts: int) -> DataFrame:
    """A row for each fold: its keys and prices, what ``fit(train x, train y, x at the cutoff)`` forecasts as log return and adds in columns ``more``, and the number of training rows.

    A series is one group that holds its rows once, from the first training row to the last cutoff, and cuts all folds from them; with ``parts`` above one, its folds are dealt over as many groups, each with a copy."""
    steps = _steps(features)
    fold = bounds.where(F.col("step").isin(steps)).select(*keys, "cutoff_row", "cutoff_date", "step", "current_price", "actual_price", "train_start", "train_end")
    reach = fold.groupBy(*keys).agg(F.least(F.min("train_start"), F.min("cutoff_row")).alias("_from"), F.greatest(F.max("train_end"), F.max("cutoff_row")).alias("_to"))
    rows = features.select(*keys, "row", *dict.fromkeys([*cols, *(f"target_{h}" for h in steps)])).join(reach, keys).where(F.col("row").between(F.col("_from"), F.col("_to"))).drop("_from", "_to")
    rows = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    fold = fold.withColumn("_part", F.pmod(F.xxhash64("cutoff_row", "step"), F.lit(parts)).cast("int"))
    by = [*keys, "_part"]

    def group(rows: pa.Table, folds: pa.Table) -> pa.Table:
        return _cut_folds(rows, folds.to_pylist(), fit, keys=keys, cols=cols, more=more)

    return rows.groupBy(*by).cogroup(fold.groupBy(*by)).applyInArrow(group, _forecast_schema(features, keys, more))


def ridge_forecasts(features: DataFrame, bounds: DataFrame, *, keys: list[str], cols: list[str], alpha: float = 20.0, parts: int = 1) -> DataFrame:
    """One small fit for each (series, cutoff, step); a series' rows are sent once. ``features``: keys, row, close, ``cols`` and target_<step>."""
    return _each_fold(features, bounds, lambda x, y, at: (float(ridge_predict(ridge_fit(x, y, alpha), at)[0]),), keys=keys, cols=cols, more="", parts=parts)


def ridge_forecasts_within(rows: DataFrame, *, keys: list[str], time: str, cols: list[str], steps: list[Step], alpha: float = 20.0) -> DataFrame:
    """The forecasts of :func:`ridge_forecasts` for folds that travel on the rows (:func:`with_folds`). A series is one group, in which ``steps`` over full windows are made of its rows and of those before the first that
    a fold sees; ``cols`` may name them. Rows dealt by series aren't shuffled."""
    own = [*keys, "row", time, "close", "folds"]
    stats = {o: c for s in steps if isinstance(s, dict) for o, (_, c, _) in s.items()}
    made = {*stats, *(s[0] for s in steps if not isinstance(s, dict))}
    rows = rows.select(*dict.fromkeys([*own, *(c for c in [*cols, *stats.values()] if c not in made), *(f"target_{h}" for h in _steps(rows))]))

    def group(rows: pa.Table) -> pa.Table:
        rows = rolled(rows.sort_by("row"), steps, row="row", whole=True)
        cutoffs = rows.select(own).filter(rows["folds"].is_valid()).to_pylist()
        folds = [{**{k: c[k] for k in keys}, "cutoff_row": c["row"], "cutoff_date": c[time], "current_price": c["close"], **f} for c in cutoffs for f in c["folds"]]
        return _cut_folds(rows, folds, lambda x, y, at: (float(ridge_predict(ridge_fit(x, y, alpha), at)[0]),), keys=keys, cols=cols, more="")

    return rows.groupBy(*keys).applyInArrow(group, _forecast_schema(rows, keys, ""))


TREES = {"trees": 240, "rate": 0.03, "depth": 3, "leaf": 12, "row_share": 0.8, "col_share": 0.75, "alpha": 0.1, "lam": 12.0}
BINS = 64


def _codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value; the last one is for those that are missing."""
    return np.column_stack([np.where(np.isnan(x[:, j]), BINS, np.searchsorted(e, x[:, j], side="left")) for j, e in enumerate(edges)])


def gbt_fit(x: np.ndarray, y: np.ndarray, *, trees: int, rate: float, depth: int, leaf: int, row_share: float, col_share: float, alpha: float, lam: float, seed: int = 7) -> tuple:
    """Boosted regression trees of squared error on binned columns; missing values go to the side of higher gain. Returns bin edges,
    the start value, the trees (column, bin, side of missing values and value of each node, in heap order) and each column's mean gain."""
    rng, (n, m) = np.random.default_rng(seed), x.shape
    edges = [np.unique(np.quantile(v, np.arange(1, BINS) / BINS)) if len(v := x[~np.isnan(x[:, j]), j]) else np.empty(0) for j in range(m)]
    code, start, made, gains, used = _codes(x, edges), float(y.mean()), [], np.zeros(m), np.zeros(m)
    at, width, pred = np.arange(m) * (BINS + 1), m * (BINS + 1), np.full(n, float(y.mean()))
    shrunk = lambda g: np.sign(g) * np.maximum(np.abs(g) - alpha, 0)
    score = lambda g, h: shrunk(g) ** 2 / (h + lam)
    for _ in range(trees):
        left = y - pred
        rows, cols = np.flatnonzero(rng.random(n) < row_share), rng.permutation(m)[: max(1, int(col_share * m))]
        node, nodes = np.zeros(n, dtype=np.int64), 2 ** (depth + 1) - 1
        col, cut, side, value = np.full(nodes, -1), np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=bool), np.zeros(nodes)
        for level in range(depth):
            first, k = 2**level - 1, 2**level
            live = rows[node[rows] >= first]
            key = ((node[live] - first)[:, None] * width + at + code[live]).ravel()
            h = np.bincount(key, minlength=k * width).reshape(k, m, BINS + 1).astype(float)
            g = np.bincount(key, np.repeat(left[live], m), minlength=k * width).reshape(k, m, BINS + 1)
            gt, ht = g.sum(2, keepdims=True), h.sum(2, keepdims=True)
            best = np.full((2, k, m, BINS), -np.inf)
            for s in (0, 1):  # missing values right, then left
                gl, hl = np.cumsum(g[:, :, :BINS], 2) + s * g[:, :, BINS:], np.cumsum(h[:, :, :BINS], 2) + s * h[:, :, BINS:]
                ok = (hl >= leaf) & (ht - hl >= leaf)
                best[s][:, cols] = np.where(ok, score(gl, hl) + score(gt - gl, ht - hl) - score(gt, ht), -np.inf)[:, cols]
            for i in range(k):
                s, j, b = np.unravel_index(np.argmax(best[:, i]), (2, m, BINS))
                if best[s, i, j, b] > 1e-12:
                    col[first + i], cut[first + i], side[first + i] = j, b, bool(s)
                    gains[j] += best[s, i, j, b]
                    used[j] += 1
            node = _step(node, code, col, cut, side)
        value = rate * shrunk(np.bincount(node[rows], left[rows], minlength=nodes)) / (np.bincount(node[rows], minlength=nodes) + lam)
        pred += value[node]
        made.append((col, cut, side, value))
    return edges, start, made, gains / np.maximum(used, 1)


def _step(node: np.ndarray, code: np.ndarray, col: np.ndarray, cut: np.ndarray, side: np.ndarray) -> np.ndarray:
    c = code[np.arange(len(node)), np.maximum(col[node], 0)]
    goes_left = np.where(c == BINS, side[node], c <= cut[node])
    return np.where(col[node] < 0, node, 2 * node + np.where(goes_left, 1, 2))


def gbt_predict(model: tuple, x: np.ndarray, depth: int = TREES["depth"]) -> np.ndarray:
    edges, start, made, _ = model
    code, out = _codes(x, edges), np.full(len(x), start)
    for col, cut, side, value in made:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            node = _step(node, code, col, cut, side)
        out += value[node]
    return out


def gbt_forecasts(features: DataFrame, bounds: DataFrame, *, keys: list[str], cols: list[str], parts: int = 8) -> DataFrame:
    """Boosted trees for each (series, cutoff, step), as ``ridge_forecasts``, with each fit's importances: mean gains that sum to one. A fit takes far longer than sending its rows, so a series' folds
    are dealt over ``parts`` groups."""

    def fit(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> tuple:
        m = gbt_fit(x, y, **TREES)
        return float(gbt_predict(m, at)[0]), (m[3] / (m[3].sum() or 1.0)).tolist()

    return _each_fold(features, bounds, fit, keys=keys, cols=cols, more="importance array<double>", parts=parts)
