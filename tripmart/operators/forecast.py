"""Daily demand forecast: additive trend and Fourier seasonality.

The model is linear in columns that depend on the date only: intercept, slope,
trend hinges, yearly and weekly sine/cosine pairs (the additive form of Taylor
and Letham, "Forecasting at Scale", 2018), fitted by ridge regression.

* Series share their design, so a zone's fit needs just the sums of demand times
  each column.  Those are ordinary aggregates, combined before the shuffle; the
  series themselves are never gathered.  What is left per zone is one small
  solve, done for a whole Arrow batch of zones at a time.
* The design depends on the day only, so it is made once per day and joined.
* The city is one more series, fitted by the same sums and penalties; a day
  without a row is a day without trips there too, so the coefficients of the
  zones add up to those of the city.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator
from functools import reduce
from operator import add, and_
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tripmart.config import ForecastConfig
from tripmart.functions.exact import ratio_half_up, whole_trips

YEAR_DAYS, WEEK_DAYS = 365.25, 7


# -- calendar and design ----------------------------------------------------


class History(NamedTuple):
    """First and last day a model is fitted on."""

    first: dt.date
    last: dt.date

    @property
    def span(self) -> int:
        return max((self.last - self.first).days, 1)


def history_of(series: DataFrame) -> History:
    """Bounds of a series.  The one row fetched makes every design column an
    expression of the date and constants."""
    row = series.agg(F.min("ds").alias("first"), F.max("ds").alias("last")).first()
    if row.first is None:
        raise ValueError("no history to fit a forecast on")
    return History(row["first"], row["last"])


def spine(series: DataFrame, horizon: int = 0) -> DataFrame:
    """Every day from the first to the last of the series, plus ``horizon``.

    Each day carries the bounds ``lo`` and ``hi`` of the series.
    """
    ends = series.agg(F.min("ds").alias("lo"), F.max("ds").alias("hi")).where("lo is not null")
    return ends.select(_days(F.col("lo"), F.col("hi"), horizon).alias("ds"), "lo", "hi")


def _days(first: Column, last: Column, horizon: int) -> Column:
    return F.explode(F.sequence(first, F.date_add(last, horizon), F.expr("interval 1 day")))


def _day(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def fourier(day: Column, period: float, order: int, prefix: str) -> dict[str, Column]:
    out = {}
    for k in range(1, order + 1):
        angle = F.unix_date(day) * F.lit(2 * math.pi * k / period)
        out[f"{prefix}_sin_{k}"] = F.sin(angle)
        out[f"{prefix}_cos_{k}"] = F.cos(angle)
    return out


def design(day: Column, history: History, cfg: ForecastConfig) -> dict[str, Column]:
    """Design columns of a day, in fixed order; time runs from 0 to 1 over
    the history, and the hinges are spread over its first part."""
    t = F.date_diff(day, _day(history.first)) / F.lit(history.span)
    columns = {"one": F.lit(1.0), "t": t}
    for j in range(1, cfg.hinges + 1):
        at = cfg.hinge_range * j / cfg.hinges
        columns[f"hinge_{j}"] = F.greatest(t - F.lit(at), F.lit(0.0))
    columns |= fourier(day, YEAR_DAYS, cfg.yearly_order, "year")
    columns |= fourier(day, WEEK_DAYS, cfg.weekly_order, "week")
    return columns


def design_matrix(history: History, cfg: ForecastConfig, horizon: int = 0) -> np.ndarray:
    """The same columns for every day of the history and ``horizon`` more, inside a task."""
    first = (history.first - dt.date(1970, 1, 1)).days
    length = (history.last - history.first).days + 1 + horizon
    days = np.arange(first, first + length)
    t = (days - first) / history.span
    columns = [np.ones(len(days)), t]
    columns += [np.maximum(t - cfg.hinge_range * j / cfg.hinges, 0.0) for j in range(1, cfg.hinges + 1)]
    for period, order in ((YEAR_DAYS, cfg.yearly_order), (WEEK_DAYS, cfg.weekly_order)):
        for k in range(1, order + 1):
            angle = days * (2 * math.pi * k / period)
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def penalties(cfg: ForecastConfig) -> np.ndarray:
    seasonal = 2 * (cfg.yearly_order + cfg.weekly_order)
    return np.array([0.0, 0.0] + [cfg.hinge_penalty] * cfg.hinges + [cfg.season_penalty] * seasonal)


def with_band(df: DataFrame, value: Column, sigma: Column, cfg: ForecastConfig) -> DataFrame:
    """Whole, non-negative forecast and band columns."""
    half = sigma * cfg.band
    return df.withColumns(
        {
            "yhat": whole_trips(value),
            "yhat_lower": whole_trips(value - half),
            "yhat_upper": whole_trips(value + half),
        }
    )


# -- many series ------------------------------------------------------------


def _solver(keys: list[str], history: History, cfg: ForecastConfig):
    """Ridge solve of a batch of keys from their demand-by-column sums."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = design_matrix(history, cfg)
        gram = matrix.T @ matrix
        ridge = gram + np.diag(penalties(cfg))
        for batch in batches:
            if batch.empty:
                continue
            sums = np.vstack(batch["sums"].to_list())
            beta = np.linalg.lstsq(ridge, sums.T, rcond=None)[0].T
            # Residual sum of squares from the same sums, without a second pass.
            rss = (
                batch["squares"].to_numpy()
                - 2 * np.einsum("ij,ij->i", beta, sums)
                + np.einsum("ij,jk,ik->i", beta, gram, beta)
            )
            out = batch[keys].copy()
            out["beta"] = list(beta)
            out["sigma"] = np.sqrt(np.maximum(rss, 0.0) / len(matrix))
            yield out

    return solve


def fit_many(
    series: DataFrame, keys: list[str], history: History, cfg: ForecastConfig = ForecastConfig()
) -> DataFrame:
    """Coefficients and residual deviation per key of a ``keys, ds, y`` table.

    A day without a row is a day without trips, so it adds nothing to any sum
    and the table need not be filled up.
    """
    y = F.col("y").cast("double")
    columns = design(F.col("ds"), history, cfg)
    # One row per calendar day of the history, so its size is bounded.
    days = series.sparkSession.range(1).select(_days(_day(history.first), _day(history.last), 0).alias("ds"))
    days = days.select("ds", *[c.alias(f"design_{n}") for n, c in columns.items()])
    sums = series.join(F.broadcast(days), "ds").groupBy(*keys).agg(
        F.array(*[F.sum(y * F.col(f"design_{n}")) for n in columns]).alias("sums"),
        F.sum(y * y).alias("squares"),
    )
    schema = StructType(
        [sums.schema[k] for k in keys]
        + [StructField("beta", ArrayType(DoubleType())), StructField("sigma", DoubleType())]
    )
    return sums.mapInPandas(_solver(keys, history, cfg), schema)


def forecast_many(
    fitted: DataFrame,
    keys: list[str],
    history: History,
    horizon: int,
    cfg: ForecastConfig = ForecastConfig(),
) -> DataFrame:
    """Fitted history and future of every key, from its coefficients.

    The values of all days are one product of matrices per batch of keys; each
    key then unfolds its own days, so no key x day join is needed.
    """

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = design_matrix(history, cfg, horizon)
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.iloc[i : i + 512]
                out = part[[*keys, "sigma"]].copy()
                out["value"] = list(np.vstack(part["beta"].to_list()) @ matrix.T)
                yield out

    schema = StructType(
        [fitted.schema[k] for k in keys]
        + [StructField("sigma", DoubleType()), StructField("value", ArrayType(DoubleType()))]
    )
    days = fitted.select(*keys, "sigma", "beta").mapInPandas(values, schema)
    flat = days.select(*keys, "sigma", F.posexplode("value").alias("at", "value"))
    dated = flat.withColumn("ds", F.date_add(_day(history.first), F.col("at")))
    return with_band(dated, F.col("value"), F.col("sigma"), cfg).select(
        *keys, "ds", "yhat", "yhat_lower", "yhat_upper"
    )


# -- checks of a fit -----------------------------------------------------------


def _design_days(spark: SparkSession, history: History, cfg: ForecastConfig, first: dt.date, last: dt.date) -> DataFrame:
    """``ds`` and one design column per term for the days from ``first`` to ``last``."""
    days = spark.range(1).select(_days(_day(first), _day(last), 0).alias("ds"))
    return days.select("ds", *[c.alias(f"design_{n}") for n, c in design(F.col("ds"), history, cfg).items()])


def _same(left: str, right: str, names: list[str]) -> Column:
    """Equality of ``names`` where null equals null."""
    return reduce(and_, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def certificate(
    series: DataFrame,
    fitted: DataFrame,
    keys: list[str],
    history: History,
    cfg: ForecastConfig = ForecastConfig(),
) -> DataFrame:
    """How far each fit is from the ridge optimum: ``X'(y - Xb) = Lb`` must hold.

    Residuals are formed row by row, one per key and day of the history (a day
    without a row has demand 0), so nothing the solver worked with is used
    again.  ``gap`` is the largest deviation over the terms, as a share of
    ``sqrt(days * sum of y squared)`` (by which no such sum can be larger for
    columns between -1 and 1); ``sigma_rows`` is the deviation of the residuals.
    """
    days = F.broadcast(_design_days(series.sparkSession, history, cfg, history.first, history.last))
    names = list(design(F.col("ds"), history, cfg))
    each = fitted.select(*keys, "beta", "sigma", _days(_day(history.first), _day(history.last), 0).alias("ds"))
    rows = each.alias("f").join(series.alias("s"), _same("f", "s", [*keys, "ds"]), "left")
    y = F.coalesce(F.col("s.y").cast("double"), F.lit(0.0)).alias("y")
    rows = rows.select(*[F.col(f"f.{c}").alias(c) for c in (*keys, "beta", "sigma", "ds")], y).join(days, "ds")
    fit = reduce(add, [F.get("beta", F.lit(i)) * F.col(f"design_{n}") for i, n in enumerate(names)])
    rows = rows.withColumn("left_over", F.col("y") - fit)
    sums = rows.groupBy(*keys).agg(
        F.first("beta").alias("beta"),
        F.first("sigma").alias("sigma"),
        F.count(F.lit(1)).alias("days"),
        F.sum(F.col("y") * F.col("y")).alias("squares"),
        F.sum(F.col("left_over") * F.col("left_over")).alias("rss"),
        *[F.sum(F.col("left_over") * F.col(f"design_{n}")).alias(f"sum_{n}") for n in names],
    )
    gaps = [
        F.abs(F.col(f"sum_{n}") - F.lit(float(w)) * F.get("beta", F.lit(i)))
        for i, (n, w) in enumerate(zip(names, penalties(cfg)))
    ]
    scale = F.greatest(F.sqrt(F.col("squares") * F.col("days")), F.lit(1.0))
    return sums.select(
        *keys,
        "days",
        (F.greatest(*gaps) / scale).alias("gap"),
        "sigma",
        F.sqrt(F.col("rss") / F.col("days")).alias("sigma_rows"),
        F.sqrt(F.col("squares") / F.col("days")).alias("size"),
    )


def cut_offs(history: History, horizon: int, count: int) -> list[dt.date]:
    """The ``count`` latest last days of training that leave ``horizon`` whole days each, without overlap."""
    days = [history.last - dt.timedelta(days=horizon * i) for i in range(count, 0, -1)]
    return [d for d in days if d > history.first]


def fit_at(
    series: DataFrame,
    keys: list[str],
    first: dt.date,
    origins: list[dt.date],
    cfg: ForecastConfig = ForecastConfig(),
) -> DataFrame:
    """One fit per key and origin, each on the days up to its origin only.

    One pass over the series: a row meets the design of every origin it lies
    before (at most ``len(origins)`` rows), and is summed before the shuffle.
    A key without rows up to an origin has no fit there.
    """
    histories = {o: History(first, o) for o in origins}
    spark = series.sparkSession
    parts = [_design_days(spark, h, cfg, first, o).withColumn("origin", _day(o)) for o, h in histories.items()]
    names = list(design(F.col("ds"), histories[origins[0]], cfg))
    days = F.broadcast(reduce(DataFrame.unionByName, parts))
    y = F.col("y").cast("double")
    sums = series.join(days, "ds").groupBy(*keys, "origin").agg(
        F.array(*[F.sum(y * F.col(f"design_{n}")) for n in names]).alias("sums"),
        F.sum(y * y).alias("squares"),
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for origin, part in batch.groupby("origin"):
                yield from _solver([*keys, "origin"], histories[origin], cfg)(iter([part]))

    schema = StructType(
        [sums.schema[k] for k in (*keys, "origin")]
        + [StructField("beta", ArrayType(DoubleType())), StructField("sigma", DoubleType())]
    )
    return sums.mapInPandas(solve, schema)


def back_test(
    series: DataFrame,
    keys: list[str],
    first: dt.date,
    origins: list[dt.date],
    horizon: int,
    cfg: ForecastConfig = ForecastConfig(),
    weeks: int = 4,
) -> DataFrame:
    """Forecast, weekday baseline and actual demand of the ``horizon`` days after every origin.

    One row per key, origin and day: ``y`` (0 where there is no row),
    ``yhat`` with its band, and ``recent``, the demand of the same weekday in the
    last ``weeks`` weeks before the origin added up (the baseline is
    ``recent / weeks``).  Tables of days are bounded by origins and horizon.
    """
    spark = series.sparkSession
    fitted = fit_at(series, keys, first, origins, cfg)
    shapes, uses = [], []
    for o in origins:
        span = [o + dt.timedelta(days=h) for h in range(1, horizon + 1)]
        ahead = _design_days(spark, History(first, o), cfg, span[0], span[-1])
        shapes.append(ahead.withColumn("origin", _day(o)))
        uses += [(o, d, d, True) for d in span]
        back = [o - dt.timedelta(days=i) for i in range(7 * weeks)]
        uses += [(o, d, b, False) for d in span for b in back if (d - b).days % 7 == 0]
    names = [c for c in shapes[0].columns if c.startswith("design_")]
    value = reduce(add, [F.get("beta", F.lit(i)) * F.col(n) for i, n in enumerate(names)])
    ahead = fitted.join(F.broadcast(reduce(DataFrame.unionByName, shapes)), "origin")
    ahead = with_band(ahead, value, F.col("sigma"), cfg).select(
        *keys, "origin", F.col("ds").alias("day"), "yhat", "yhat_lower", "yhat_upper"
    )
    # Which days of the series count for which forecast day, as the day itself or as its past.
    used = spark.createDataFrame(uses, "origin date, day date, ds date, itself boolean")
    seen = series.join(F.broadcast(used), "ds").groupBy(*keys, "origin", "day").agg(
        F.sum(F.when(F.col("itself"), F.col("y"))).alias("y"),
        F.sum(F.when(~F.col("itself"), F.col("y"))).alias("recent"),
    )
    both = ahead.alias("a").join(seen.alias("s"), _same("a", "s", [*keys, "origin", "day"]), "left")
    zero = F.lit(0).cast("bigint")
    return both.select(
        *[F.col(f"a.{c}").alias(c) for c in ahead.columns],
        F.coalesce("s.y", zero).alias("y"),
        F.coalesce("s.recent", zero).alias("recent"),
    )


def back_test_scores(tested: DataFrame, keys: list[str], weeks: int = 4) -> DataFrame:
    """Per key: days tested, percent of them inside the band, mean error of the forecast and of the baseline.

    Errors are sums of whole trips, divided once.
    """
    inside = (F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))
    n = F.count(F.lit(1))
    error = F.sum(F.abs(F.col("y") - F.col("yhat")))
    naive_error = F.sum(F.abs(F.col("y") * weeks - F.col("recent")))
    return tested.groupBy(*keys).agg(
        n.alias("days"),
        ratio_half_up(F.count_if(inside), n, factor=100).cast("double").alias("inside_pct"),
        ratio_half_up(error, n).cast("double").alias("mae"),
        ratio_half_up(naive_error, n * weeks).cast("double").alias("mae_naive"),
    )


# -- one series -------------------------------------------------------------

CITY = "series"


def fit_city(series: DataFrame, history: History, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Coefficients and residual deviation of one ``ds, y`` series, as one row."""
    return fit_many(series.withColumn(CITY, F.lit("city")), [CITY], history, cfg)


def forecast_city(
    model: DataFrame,
    series: DataFrame,
    history: History,
    horizon: int,
    cfg: ForecastConfig = ForecastConfig(),
) -> DataFrame:
    """Fitted history and ``horizon`` future days, with the actual ``y``
    beside them (null on future and unobserved days)."""
    fitted = forecast_many(model, [CITY], history, horizon, cfg).drop(CITY)
    return fitted.join(series, "ds", "left")


# -- baseline ---------------------------------------------------------------


def naive(series: DataFrame, horizon: int, weeks: int = 4) -> DataFrame:
    """Mean of the same weekday's last ``weeks`` values, for every future day.

    Works on one series (one row per calendar day); the weekday means are seven
    rows.
    """
    weekday = F.dayofweek("ds")
    newest = Window.partitionBy("dow").orderBy(F.desc("ds"))
    means = (
        series.select("ds", "y", weekday.alias("dow"))
        .withColumn("rank", F.row_number().over(newest))
        .where(F.col("rank") <= weeks)
        .groupBy("dow")
        .agg((F.sum("y").cast("double") / F.count("y")).alias("mean"))
    )
    future = spine(series, horizon).where(F.col("ds") > F.col("hi")).select("ds", weekday.alias("dow"))
    return future.join(F.broadcast(means), "dow", "left").select(
        "ds", F.col("mean").alias("yhat_naive")
    )
