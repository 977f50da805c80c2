"""Imputation, scaling and category codes for feature tables.

Fitting is one aggregation over all features; what it returns (a few numbers
per feature) goes into the plan as constants, as a fitted transformer would.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from spendcast.operators.evaluate import seeded_hash
from spendcast.operators.quantiles import exact_quantiles, long_rows, quantile_knots
from spendcast.operators.scan import DEFAULT_LIMITS, ScanLimits, scan

KNOTS = 1000


def string_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Features to treat as categories: those of string type."""
    return [c for c, t in df.dtypes if c in set(features) and t == "string"]


def categorical_index(
    df: DataFrame, column: str, limits: ScanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Add ``{column}_index``: the 1-based alphabetical place of each category."""
    categories = df.select(column).filter(F.col(column).isNotNull()).distinct()
    codes = scan(categories, [], [column], position=f"{column}_index", limits=limits)
    return df.join(codes, column, "left")


def ordered_target(
    df: DataFrame, columns: Sequence[str], *, label: str = "label", key: str = "customer_id", seed: int = 42,
    prior: float = 0.5, weight: float = 1.0, limits: ScanLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``{column}_target``: the mean label of the category's rows that come earlier
    in a seeded random order, with ``weight`` rows of ``prior`` added.

    No row sees its own label, so the mean can be a feature of the rows it is made
    from. Nulls are a category. A category of any size is split by the scan."""
    done = df.withColumn("__hash", seeded_hash(key, seed))
    for c in columns:
        placed = scan(done, [c], ["__hash", key], position="__rn", sums={"__sum": label}, limits=limits)
        earlier = f"(__sum - `{label}` + {prior * weight!r}D) / (__rn - 1 + {weight!r}D)"
        done = placed.withColumn(f"{c}_target", F.expr(earlier)).drop("__rn", "__sum")
    return done.drop("__hash")


def target_means(
    train: DataFrame, df: DataFrame, columns: Sequence[str], *, label: str = "label", prior: float = 0.5, weight: float = 1.0
) -> DataFrame:
    """Add ``{column}_target`` to other rows: the mean label of all train rows of the
    category, the prior for one that train has not."""
    for c in columns:
        means = train.groupBy(F.col(c).alias("__category")).agg(
            F.expr(f"(sum(`{label}`) + {prior * weight!r}D) / (count(1) + {weight!r}D)").alias(f"{c}_target")
        )
        df = df.join(means, F.col(c).eqNullSafe(F.col("__category")), "left").drop("__category").fillna(prior, [f"{c}_target"])
    return df


def encode_categories(train: DataFrame, test: DataFrame, columns: Sequence[str], **options) -> tuple[DataFrame, DataFrame]:
    """String features of both tables as label means, in place of the strings: ordered
    ones for train, those of the whole train table for test."""
    limits = options.pop("limits", DEFAULT_LIMITS)
    keyed = {k: v for k, v in options.items() if k not in ("key", "seed")}
    encoded = ordered_target(train, columns, limits=limits, **options), target_means(train, test, columns, **keyed)
    return tuple(df.drop(*columns) for df in encoded)


def _map_features(df: DataFrame, formulas: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{formulas[c]} AS `{c}`" if c in formulas else f"`{c}`" for c in df.columns))


def _fit(df: DataFrame, features: Sequence[str], *aggregates: str) -> dict[str, tuple]:
    """Values of SQL aggregates (of ``value``) per feature."""
    rows = long_rows(df, features).groupBy("place").agg(*(F.expr(a).alias(f"a{k}") for k, a in enumerate(aggregates)))
    found = {features[r["place"]]: tuple(r[f"a{k}"] for k in range(len(aggregates))) for r in rows.collect()}
    return {c: found.get(c, (None,) * len(aggregates)) for c in features}


def _quantiles(df, features, probabilities, limits) -> dict[str, dict[str, float]]:
    found = {r["column"]: r.asDict() for r in exact_quantiles(df, features, probabilities, limits).collect()}
    return {c: found.get(c, dict.fromkeys(probabilities)) for c in features}


def _number(value: float | None) -> str:
    return "double(null)" if value is None else f"double('{float(value)!r}')"


def impute(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    strategy: str = "zero",
    limits: ScanLimits = DEFAULT_LIMITS,
) -> tuple[DataFrame, DataFrame]:
    """Fill nulls with 0, the train mean or the exact train median."""
    if strategy == "zero":
        fills = {c: 0.0 for c in features}
    elif strategy == "mean":
        fills = {c: v[0] for c, v in _fit(train, features, "avg(value)").items()}
    elif strategy == "median":
        fills = {c: q["m"] for c, q in _quantiles(train, features, {"m": 0.5}, limits).items()}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    formulas = {c: f"coalesce(double(`{c}`), {_number(v)})" for c, v in fills.items()}
    return _map_features(train, formulas), _map_features(test, formulas)


def _min_max(df, features, limits):
    fitted = _fit(df, features, "min(value)", "max(value)")
    return {
        c: f"(`{c}` - {_number(lo)}) / {_number(hi - lo if hi != lo else 1.0)} * 2 - 1"
        for c, (lo, hi) in fitted.items()
        if lo is not None
    }


def _standard(df, features, limits):
    fitted = _fit(df, features, "avg(value)", "stddev_pop(value)")
    return {
        c: f"(`{c}` - {_number(m)}) / {_number(s or 1.0)}"
        for c, (m, s) in fitted.items()
        if m is not None
    }


def _robust(df, features, limits):
    fitted = _quantiles(df, features, {"q1": 0.25, "m": 0.5, "q3": 0.75}, limits)
    return {
        c: f"(`{c}` - {_number(q['m'])}) / {_number(q['q3'] - q['q1'] or 1.0)}"
        for c, q in fitted.items()
        if q["m"] is not None
    }


SCALERS = {"min_max": _min_max, "standard": _standard, "robust": _robust}


def scale(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    method: str,
    fit_on: str = "each",
    limits: ScanLimits = DEFAULT_LIMITS,
) -> tuple[DataFrame, DataFrame]:
    """Scale features. ``min_max`` to [-1, 1], ``standard`` by population
    deviation, ``robust`` by median and quartile range, ``quantile`` to uniform.

    ``fit_on="each"`` fits each table on itself; ``"train"`` reuses the train fit.
    """
    if fit_on not in ("each", "train"):
        raise ValueError("fit_on must be 'each' or 'train'")
    if method == "quantile":
        fits = [_knots(train, features, limits)]
        fits.append(fits[0] if fit_on == "train" else _knots(test, features, limits))
        return tuple(_interpolate(df, k) for df, k in zip((train, test), fits))
    if method not in SCALERS:
        raise ValueError(f"unknown method {method!r}")
    fit = SCALERS[method]
    fitted = fit(train, features, limits)
    again = fitted if fit_on == "train" else fit(test, features, limits)
    return _map_features(train, fitted), _map_features(test, again)


def _knots(df: DataFrame, features: Sequence[str], limits: ScanLimits) -> dict[str, np.ndarray]:
    """At most ``KNOTS`` values per feature, in order."""
    rows = quantile_knots(df, features, KNOTS, limits).collect()
    values: dict[str, dict[int, float]] = {}
    for r in rows:
        values.setdefault(r["column"], {})[r["knot"]] = r["value"]
    return {c: np.array([v for _, v in sorted(k.items())]) for c, k in values.items()}


def uniform_place(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Place of each value between the knots, in [0, 1]; mid-point on ties."""
    places = np.linspace(0, 1, len(knots))
    up = np.interp(x, knots, places)
    down = -np.interp(-x, -knots[::-1], -places[::-1])
    place = (up + down) / 2
    # The lower bound is set last: a constant column becomes 0.
    place = np.where(x <= knots[0], 0.0, np.where(x >= knots[-1], 1.0, place))
    return np.where(np.isnan(x), np.nan, place)


def _interpolate(df: DataFrame, knots: dict[str, np.ndarray]) -> DataFrame:
    schema = T.StructType(
        [T.StructField(f.name, T.DoubleType()) if f.name in knots else f for f in df.schema]
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c, k in knots.items():
                pdf[c] = uniform_place(pdf[c].to_numpy(dtype=float), k)
            yield pdf

    return df.mapInPandas(place, schema)
