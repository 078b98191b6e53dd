"""Customer lifetime value: BG/NBD purchases and Gamma-Gamma spend.

Formulas: Fader, Hardie and Lee 2005 (BG/NBD), Fader and Hardie 2013 (Gamma-Gamma). Fits are by
Newton's method: one pass over counts sums the likelihood with its exact first and second
derivatives, and the driver sees these few numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.config import CustomerConfig
from tillwise.operators.customers import add_linear_clv
from tillwise.staging import stage

WEEKS_PER_MONTH = 4.345

Likelihood = Callable[[Sequence, pd.DataFrame], "Jet | np.ndarray"]


def lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive arguments, by Stirling's series."""
    z = np.asarray(x, dtype=float)
    shift = sum(np.log(z + i) for i in range(8))
    z = z + 8
    inverse = 1.0 / (z * z)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse * (1 / 1680 - inverse / 1188)))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - shift


def hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray, limit: int = 20_000) -> np.ndarray:
    """Gauss hypergeometric series for 0 <= z < 1."""
    term = np.ones(np.broadcast(a, b, c, z).shape)
    total = term.copy()
    for j in range(limit):
        term = term * (a + j) * (b + j) / (c + j) * z / (j + 1)
        total += term
        if np.all(np.abs(term) <= 1e-13 * np.abs(total)):
            return total
    raise ArithmeticError(f"the series has not converged after {limit} terms")


def digamma(x: np.ndarray) -> np.ndarray:
    """First derivative of ``lgamma`` for positive arguments."""
    z = np.asarray(x, dtype=float)
    shift = sum(1 / (z + i) for i in range(8))
    z = z + 8
    inverse = 1.0 / (z * z)
    series = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse * (1 / 240 - inverse / 132))))
    return np.log(z) - 0.5 / z - series - shift


def trigamma(x: np.ndarray) -> np.ndarray:
    """Second derivative of ``lgamma`` for positive arguments."""
    z = np.asarray(x, dtype=float)
    shift = sum(1 / (z + i) ** 2 for i in range(8))
    z = z + 8
    inverse = 1.0 / (z * z)
    series = (1 / 6 - inverse * (1 / 30 - inverse * (1 / 42 - inverse * (1 / 30 - inverse * 5 / 66)))) / z
    return 1 / z + inverse / 2 + series * inverse + shift


@dataclass
class Jet:
    """Values for all rows with exact first and second derivatives by the parameters."""

    value: np.ndarray
    slope: np.ndarray  # parameters x rows
    curve: np.ndarray  # parameters x parameters x rows

    def through(self, f: np.ndarray, f1: np.ndarray, f2: np.ndarray) -> Jet:
        """A function of this one, from its value and derivatives here."""
        return Jet(f, f1 * self.slope, f1 * self.curve + f2 * self.slope[:, None] * self.slope[None, :])

    def __add__(self, other: Jet | float | np.ndarray) -> Jet:
        if isinstance(other, Jet):
            return Jet(self.value + other.value, self.slope + other.slope, self.curve + other.curve)
        return Jet(self.value + other, self.slope + 0 * other, self.curve + 0 * other)

    def __mul__(self, other: Jet | float | np.ndarray) -> Jet:
        if isinstance(other, Jet):
            cross = self.slope[:, None] * other.slope[None, :]
            return Jet(
                self.value * other.value, self.slope * other.value + other.slope * self.value,
                self.curve * other.value + other.curve * self.value + cross + cross.swapaxes(0, 1),
            )
        return Jet(self.value * other, self.slope * other, self.curve * other)

    def __neg__(self) -> Jet:
        return self * -1.0

    def __sub__(self, other: Jet | float | np.ndarray) -> Jet:
        return self + (-other)

    __radd__, __rmul__ = __add__, __mul__


def log(x: Jet | np.ndarray) -> Jet | np.ndarray:
    return x.through(np.log(x.value), 1 / x.value, -1 / x.value**2) if isinstance(x, Jet) else np.log(x)


def log_gamma(x: Jet | np.ndarray) -> Jet | np.ndarray:
    return x.through(lgamma(x.value), digamma(x.value), trigamma(x.value)) if isinstance(x, Jet) else lgamma(x)


def soft_plus(x: Jet | np.ndarray) -> Jet | np.ndarray:
    """log(1 + exp(x))."""
    if not isinstance(x, Jet):
        return np.logaddexp(0.0, x)
    share = 0.5 * (1 + np.tanh(x.value / 2))
    return x.through(np.logaddexp(0.0, x.value), share, share * (1 - share))


def bgnbd_likelihood(theta: Sequence, rows: pd.DataFrame) -> Jet | np.ndarray:
    """Log-likelihood per row for one (r, alpha, a, b), numbers or jets."""
    r, alpha, a, b = theta
    x, recent, age = (rows[c].to_numpy(dtype=float) for c in ("frequency", "recency", "T"))
    active = -(r + x) * log(alpha + age)
    # Without a repeat purchase nobody can have lapsed; the other rows' terms are finite.
    repeat = x > 0
    lapsed = log(a) - log(b + np.where(repeat, x - 1, 0.0)) - (r + x) * log(alpha + recent)
    either = active + soft_plus(lapsed - active) * repeat.astype(float)
    return log_gamma(r + x) - log_gamma(r + 0 * x) + r * log(alpha) + log_gamma(a + b) + log_gamma(b + x) - log_gamma(b + 0 * x) - log_gamma(a + b + x) + either


def gamma_gamma_likelihood(theta: Sequence, rows: pd.DataFrame) -> Jet | np.ndarray:
    """Log-likelihood per row for one (p, q, v), numbers or jets."""
    p, q, v = theta
    x, m = rows["frequency"].to_numpy(dtype=float), rows["monetary_value"].to_numpy(dtype=float)
    return (
        log_gamma(p * x + q) - log_gamma(p * x) - log_gamma(q + 0 * x) + q * log(v)
        + (p * x - 1.0) * np.log(m) + p * (x * np.log(x)) - (p * x + q) * log(v + x * m)
    )


def sum_likelihoods(rows: DataFrame, likelihood: Likelihood, thetas: np.ndarray) -> np.ndarray:
    """Mean log-likelihood of every candidate vector in one pass over weighted rows."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, weight = np.zeros(len(thetas)), 0.0
        for batch in batches:
            w = batch["n"].to_numpy(dtype=float)
            weight += w.sum()
            sums += [float(np.dot(w, likelihood(theta, batch))) for theta in thetas]
        yield pd.DataFrame({"candidate": range(len(thetas)), "total": sums, "weight": weight})

    parts = rows.mapInPandas(partial, "candidate long, total double, weight double")
    found = parts.groupBy("candidate").agg(F.sum("total"), F.sum("weight")).collect()
    out = np.empty(len(thetas))
    for candidate, total, weight in found:
        out[candidate] = total / weight if weight else np.nan
    return out


def sum_derivatives(rows: DataFrame, likelihood: Likelihood, at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log-likelihood with gradient and Hessian by the logarithms of the parameters, in one pass.

    Each task sums one vector (1 + k + k x k numbers and the weight), whatever its rows.
    """
    k = len(at)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, weight = np.zeros(1 + k + k * k), 0.0
        for batch in batches:
            w, n = batch["n"].to_numpy(dtype=float), len(batch)
            theta = []
            for i, u in enumerate(at):
                slope, curve = np.zeros((k, n)), np.zeros((k, k, n))
                slope[i] = curve[i, i] = np.exp(u)
                theta.append(Jet(np.full(n, np.exp(u)), slope, curve))
            found = likelihood(theta, batch)
            parts = np.vstack([found.value[None], found.slope, found.curve.reshape(k * k, n)])
            total, weight = total + parts @ w, weight + w.sum()
        yield pd.DataFrame({"total": [total.tolist()], "weight": [weight]})

    each = [F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(1 + k + k * k)]
    *sums, weight = rows.mapInPandas(partial, "total array<double>, weight double").agg(*each, F.sum("weight")).first()
    if not weight:
        raise ValueError("no rows to fit")
    mean = np.array(sums) / weight
    return float(mean[0]), mean[1 : 1 + k], mean[1 + k :].reshape(k, k)


def _spread(rows: DataFrame) -> DataFrame:
    """Cached rows over as many tasks as their number is worth: the passes are all
    arithmetic, and a small file would leave them to one task."""
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // 4000 + 1)
    return rows.repartition(max(tasks, 1)).persist()


def maximise(
    staged: DataFrame, likelihood: Likelihood, start: np.ndarray, penalizer: float, passes: int = 40, tolerance: float = 1e-6
) -> np.ndarray:
    """Newton's method on log parameters for mean likelihood less ``penalizer`` times the
    squared parameters; a fit that does not converge is an error.

    A pass gives value, gradient and Hessian at one point. A step that does not rise is cut to a
    quarter. The end is where the next step promises less than ``tolerance`` of the value.
    """
    rows = _spread(staged)

    def objective(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        value, slope, curve = sum_derivatives(rows, likelihood, at)
        weight = penalizer * np.exp(2 * at)
        return value - weight.sum(), slope - 2 * weight, curve - 4 * np.diag(weight)

    try:
        at = np.log(np.asarray(start, dtype=float))
        here, slope, curve = objective(at)
        length = 1.0
        for _ in range(passes):
            values, vectors = np.linalg.eigh(-curve)
            step = vectors @ ((vectors.T @ slope) / np.maximum(np.abs(values), 1e-4))
            step *= length * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
            if slope @ step < tolerance * max(1.0, abs(here)):
                return np.exp(at)
            moved = objective(np.clip(at + step, -15, 15))
            if np.isfinite(moved[0]) and moved[0] >= here:
                at, length = np.clip(at + step, -15, 15), 1.0
                here, slope, curve = moved
            else:
                length /= 4
    finally:
        rows.unpersist()
    raise ArithmeticError(f"the likelihood still rose after {passes} passes")


def fit_bgnbd(summary: DataFrame, penalizer: float = 0.01, fit_on: str = "repeat_only") -> dict[str, float]:
    """Purchase and dropout parameters r, alpha, a, b.

    The rows first collapse to counts per (frequency, recency, T). ``fit_on`` chooses
    customers with a repeat purchase ("repeat_only") or "all" of them.
    """
    if fit_on not in ("repeat_only", "all"):
        raise ValueError(f"unknown choice {fit_on}")
    rows = summary if fit_on == "all" else summary.where("frequency > 0")
    counts = stage(rows.groupBy("frequency", "recency", "T").agg(F.count("*").alias("n")), "purchase-counts")
    mean = counts.agg(F.sum(F.col("T") * F.col("n")) / F.sum(F.col("frequency") * F.col("n"))).first()[0]
    theta = maximise(counts, bgnbd_likelihood, np.array([1.0, mean or 1.0, 1.0, 2.0]), penalizer)
    return dict(zip(("r", "alpha", "a", "b"), map(float, theta)))


def fit_gamma_gamma(summary: DataFrame, penalizer: float = 0.01) -> dict[str, float]:
    """Spend parameters p, q, v from customers with repeat purchases and positive spend."""
    rows = stage(
        summary.where("frequency > 0 AND monetary_value > 0")
        .groupBy("frequency", "monetary_value").agg(F.count("*").alias("n")),
        "spend",
    )
    mean = rows.agg(F.sum(F.col("monetary_value") * F.col("n")) / F.sum("n")).first()[0]
    if mean is None:
        raise ValueError("no customer with repeat purchases and positive spend")
    # Spend is scaled to mean 1 for the fit; v carries the scale back.
    scaled = rows.withColumn("monetary_value", F.col("monetary_value") / mean)
    p, q, v = maximise(scaled, gamma_gamma_likelihood, np.array([2.0, 3.0, 1.0]), penalizer)
    return {"p": float(p), "q": float(q), "v": float(v * mean)}


def expected_purchases(t: float, x, recent, age, bg: dict[str, float]) -> np.ndarray:
    """Expected purchases in the next ``t`` periods given the past."""
    r, alpha, a, b = (bg[k] for k in ("r", "alpha", "a", "b"))
    if abs(a - 1) < 1e-6:
        a = 1 + 1e-6
    series = hyp2f1(r + x, b + x, a + b + x - 1, t / (alpha + age + t))
    decay = np.exp((r + x) * (np.log(alpha + age) - np.log(alpha + age + t)))
    lapsed = np.where(x > 0, a / (b + np.maximum(x, 1) - 1) * np.exp((r + x) * (np.log(alpha + age) - np.log(alpha + recent))), 0.0)
    return (a + b + x - 1) / (a - 1) * (1 - decay * series) / (1 + lapsed)


def score_clv(
    summary: DataFrame, bg: dict[str, float], gg: dict[str, float], months: int = 12, rate: float = 0.10 / 12, weeks: int = 52
) -> DataFrame:
    """Expected purchases and discounted value for repeat customers, in Arrow batches."""
    p, q, v = gg["p"], gg["q"], gg["v"]

    @F.pandas_udf("predicted_purchases double, expected_spend double, clv double")
    def score(x: pd.Series, recent: pd.Series, age: pd.Series, m: pd.Series) -> pd.DataFrame:
        n, last, total, spend = (s.to_numpy(dtype=float) for s in (x, recent, age, m))
        mean = p * (v + n * spend) / (p * n + q - 1)
        value, before = np.zeros(len(n)), np.zeros(len(n))
        for month in range(1, months + 1):
            so_far = expected_purchases(month * WEEKS_PER_MONTH, n, last, total, bg)
            value += mean * (so_far - before) / (1 + rate) ** month
            before = so_far
        ahead = expected_purchases(float(weeks), n, last, total, bg)
        return pd.DataFrame({"predicted_purchases": ahead, "expected_spend": mean, "clv": value})

    scored = score("frequency", "recency", "T", "monetary_value").alias("s")
    return summary.where("frequency > 0 AND monetary_value > 0").select("customer_id", scored).select(
        "customer_id", "s.predicted_purchases", "s.expected_spend", "s.clv"
    )


def customer_clv(base: DataFrame, summary: DataFrame, config: CustomerConfig = CustomerConfig()) -> DataFrame:
    """Projected value per customer: modelled for repeat customers, linear for the rest."""
    bg = fit_bgnbd(summary, config.penalizer)
    gg = fit_gamma_gamma(summary, config.penalizer)
    modelled = score_clv(
        summary, bg, gg, config.clv_months, config.annual_discount / 12, config.projection_weeks
    ).select("customer_id", "predicted_purchases", "clv")
    return (
        add_linear_clv(base).join(modelled, "customer_id", "left")
        .withColumn("clv_projected_12m", F.coalesce(F.bround("clv", 2), "clv_projected_12m"))
        .withColumn("clv_model_type", F.lit("BG/NBD + Gamma-Gamma"))
        .drop("clv")
    )
