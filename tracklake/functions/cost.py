"""Costs of taking two fragments for one vehicle, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_OVERLAP = 1e5
INFEASIBLE = 1e6


def bhattacharyya(deltas: list[Column], variances: list[tuple[Column, Column]]) -> Column:
    """Distance of two normal distributions with diagonal covariances, one entry per component."""
    out = F.lit(0.0)
    for d, (a, b) in zip(deltas, variances, strict=True):
        mid = (a + b) / 2
        out = out + d * d / mid / 8 + F.log(mid / F.sqrt(a * b)) / 2
    return out


def coefficient(distance: Column) -> Column:
    return F.exp(-distance)


def sums(t: Column, v: Column, w: Column) -> dict[str, Column]:
    """The weighted sums of a line fit, as aggregates."""
    return {"sw": F.sum(w), "st": F.sum(w * t), "sv": F.sum(w * v), "stt": F.sum(w * t * t), "stv": F.sum(w * t * v)}


def slope(s: dict[str, Column]) -> Column:
    return (s["sw"] * s["stv"] - s["st"] * s["sv"]) / F.nullif(s["sw"] * s["stt"] - s["st"] * s["st"], F.lit(0.0))


def intercept(s: dict[str, Column]) -> Column:
    return (s["sv"] - slope(s) * s["st"]) / F.nullif(s["sw"], F.lit(0.0))


def fold(array: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda total, x: total + value(x))


def fit(samples: Column, value: str, weight: str = "w") -> Column:
    """Weighted line through an array of (t, value, w): struct of slope and intercept."""
    total = lambda f: fold(samples, f)
    s = {
        "sw": total(lambda p: p[weight]),
        "st": total(lambda p: p[weight] * p["t"]),
        "sv": total(lambda p: p[weight] * p[value]),
        "stt": total(lambda p: p[weight] * p["t"] * p["t"]),
        "stv": total(lambda p: p[weight] * p["t"] * p[value]),
    }
    return F.struct(slope(s).alias("slope"), intercept(s).alias("intercept"))


def nll(delta: Column, variance: Column) -> Column:
    """Negative log-likelihood of a normal error, without its constant."""
    return (F.log(variance) + delta * delta / variance) / 2
