"""Association statistics. Closed forms are column expressions; the rest are Arrow-batched or grouped pandas."""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Z = 1.96


def odds_ratio(a: str, b: str, c: str, d: str) -> Column:
    """struct(odds_ratio, ci_low, ci_high) of [[a, b], [c, d]].

    The ratio is raw: infinite if only b*c is 0, null if both products are. The interval adds a half
    to every cell if any is 0.
    """
    cells = [F.col(x).cast("double") for x in (a, b, c, d)]
    ad, bc = cells[0] * cells[3], cells[1] * cells[2]
    raw = F.when(bc != 0, ad / bc).when(ad > 0, F.lit(float("inf")))
    half = F.when(F.least(*cells) == 0, 0.5).otherwise(0.0)
    k = [x + half for x in cells]
    log_or = F.log(k[0] * k[3] / (k[1] * k[2]))
    error = F.sqrt(1 / k[0] + 1 / k[1] + 1 / k[2] + 1 / k[3])
    return F.struct(raw.alias("odds_ratio"), F.exp(log_or - Z * error).alias("ci_low"), F.exp(log_or + Z * error).alias("ci_high"))


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Sum of the probabilities of all tables with the same margins that are no likelier than the given one."""
    n, r, k = a + b + c + d, a + b, a + c
    if n == 0 or r in (0, n) or k in (0, n):
        return 1.0
    low, high = max(0, r + k - n), min(r, k)
    x = np.arange(low, high + 1)
    lg = np.vectorize(math.lgamma, otypes=[float])
    log_p = -(lg(x + 1) + lg(r - x + 1) + lg(k - x + 1) + lg(n - r - k + x + 1))
    p = np.exp(log_p - log_p.max())
    own = p[a - low]
    return float(min(1.0, p[p <= own * (1 + 1e-7)].sum() / p.sum()))


def fisher_p(a: str, b: str, c: str, d: str) -> Column:
    """Two-sided Fisher p of four count columns (Spark SQL has no log-gamma)."""

    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        seen: dict[tuple, float] = {}
        out = []
        for t in zip(a, b, c, d):
            if t not in seen:
                seen[t] = fisher_two_sided(*map(int, t))
            out.append(seen[t])
        return pd.Series(out, dtype=float)

    return run(a, b, c, d)


@F.pandas_udf(DoubleType())
def chi2_1_p(x: pd.Series) -> pd.Series:
    """Upper tail of chi-squared with one degree of freedom."""
    return x.map(lambda v: math.erfc(math.sqrt(v / 2)) if v is not None and v >= 0 else None).astype(float)


def mantel_haenszel(df: DataFrame, group: Sequence[str], a: str = "a", b: str = "b", c: str = "c", d: str = "d") -> DataFrame:
    """(group, strata, odds_ratio_mh, ci_low, ci_high, cmh_chi2, cmh_p) pooled over rows as strata.

    Strata of one item or none are left out; the interval is that of Robins, Breslow and Greenland,
    the test has no continuity correction.
    """
    A, B, C, D = (F.col(x).cast("double") for x in (a, b, c, d))
    n = A + B + C + D
    r, s = A * D / n, B * C / n
    p, q = (A + D) / n, (B + C) / n
    sums = {
        "r": r, "s": s, "pr": p * r, "mixed": p * s + q * r, "qs": q * s, "dev": A - (A + B) * (A + C) / n,
        "var": F.when(n > 1, (A + B) * (C + D) * (A + C) * (B + D) / (n * n * (n - 1))),
    }
    t = df.where(n > 1).groupBy(*group).agg(F.count("*").alias("strata"), *(F.sum(x).alias(f"_{k}") for k, x in sums.items()))
    ratio = F.when(F.col("_s") > 0, F.col("_r") / F.col("_s")).when(F.col("_r") > 0, F.lit(float("inf")))
    both = (F.col("_r") > 0) & (F.col("_s") > 0)
    variance = (
        F.col("_pr") / (2 * F.col("_r") ** 2) + F.col("_mixed") / (2 * F.col("_r") * F.col("_s")) + F.col("_qs") / (2 * F.col("_s") ** 2)
    )
    error = F.when(both, F.sqrt(variance))
    chi2 = F.when(F.col("_var") > 0, F.col("_dev") ** 2 / F.col("_var"))
    out = t.select(
        *group, "strata", ratio.alias("odds_ratio_mh"), F.exp(F.log(F.when(both, ratio)) - Z * error).alias("ci_low"),
        F.exp(F.log(F.when(both, ratio)) + Z * error).alias("ci_high"), chi2.alias("cmh_chi2"),
    )
    return out.withColumn("cmh_p", chi2_1_p("cmh_chi2"))


def benjamini_hochberg(df: DataFrame, group: Sequence[str], p: str, out: str = "q") -> DataFrame:
    """Adjusted p by group; null and NaN p stay null. Ties are safe: the running minimum comes from the largest p."""
    ok = F.col(p).isNotNull() & ~F.isnan(p)
    part = Window.partitionBy(*group, ok) if group else Window.partitionBy(ok)
    m = F.count("*").over(part)
    rank = F.row_number().over(part.orderBy(p))
    ranked = df.withColumns({"_raw": F.when(ok, F.col(p) * m / rank)})
    running = F.min("_raw").over(part.orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn(out, F.when(ok, F.least(running, F.lit(1.0)))).drop("_raw")


# ---------------------------------------------------------------- grouped models


def spline_basis(x: np.ndarray, df: int = 3) -> np.ndarray:
    """Natural cubic spline basis: boundary knots at the range, inner knots at equal quantiles, no intercept."""
    inner = np.quantile(x, np.linspace(0, 1, df + 1)[1:-1])
    knots = np.concatenate(([x.min()], inner, [x.max()]))
    scale = knots[-1] - knots[0] or 1.0
    z, k = (x - knots[0]) / scale, (knots - knots[0]) / scale
    cube = lambda v: np.maximum(v, 0) ** 3
    d = [(cube(z - k[j]) - cube(z - k[-1])) / (k[-1] - k[j]) for j in range(len(k) - 1)]
    return np.column_stack([z, *(d[j] - d[-1] for j in range(len(k) - 2))])


def firth(x: np.ndarray, y: np.ndarray, offset: np.ndarray | None = None, steps: int = 200) -> tuple[np.ndarray, float, bool]:
    """(coefficients, penalised log-likelihood, converged) of logistic regression with Jeffreys' prior."""
    beta = np.zeros(x.shape[1])
    base = np.zeros(len(y)) if offset is None else offset

    def fitted(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        eta = base + x @ b
        p = 1 / (1 + np.exp(-np.clip(eta, -35, 35)))
        info = (x * (p * (1 - p))[:, None]).T @ x
        sign, logdet = np.linalg.slogdet(info)
        ll = float((y * eta - np.logaddexp(0, eta)).sum())
        return p, info, ll + 0.5 * logdet if sign > 0 else -math.inf

    p, info, value = fitted(beta)
    for _ in range(steps):
        w = p * (1 - p)
        inverse = np.linalg.pinv(info)
        leverage = w * np.einsum("ij,jk,ik->i", x, inverse, x)
        step = inverse @ (x.T @ (y - p + leverage * (0.5 - p)))
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        for _ in range(20):
            np_, ninfo, nvalue = fitted(beta + step)
            if nvalue >= value - 1e-10:
                break
            step = step / 2
        beta, p, info, value = beta + step, np_, ninfo, nvalue
        if np.abs(step).max() < 1e-8:
            return beta, value, True
    return beta, value, False


def profile_interval(x: np.ndarray, y: np.ndarray, term: int, level: float = 3.841458820694124) -> tuple[float, float, float, str]:
    """(estimate, low, high, status) of one coefficient by penalised profile likelihood."""
    beta, best, ok = firth(x, y)
    others = np.delete(x, term, axis=1)

    def drop(b: float) -> float:
        return 2 * (best - firth(others, y, x[:, term] * b)[1]) - level

    def bound(direction: int) -> float:
        inside, width = beta[term], 1.0
        for _ in range(12):
            outside = inside + direction * width
            if drop(outside) > 0:
                break
            inside, width = outside, width * 2
        else:
            return math.nan
        for _ in range(60):
            mid = (inside + outside) / 2
            inside, outside = (mid, outside) if drop(mid) <= 0 else (inside, mid)
        return (inside + outside) / 2

    low, high = bound(-1), bound(1)
    status = "estimated" if ok and math.isfinite(low) and math.isfinite(high) else "warning"
    return float(beta[term]), low, high, status


def firth_by_group(df: DataFrame, group: Sequence[str], label: str, observed: str, score: str, spline_df: int = 3) -> DataFrame:
    """(group, rows, odds_ratio, ci_low, ci_high, status) of label ~ observed + spline(score), one task per group;
    with ``spline_df`` 0 of label ~ observed.

    A group is one model, so its rows must fit into one task.
    """
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{g}` {kinds[g]}" for g in group) + ", rows long, odds_ratio double, ci_low double, ci_high double, status string"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=[label, observed, score])
        y, o, s = (pdf[c].to_numpy(float) for c in (label, observed, score))
        status = (
            "no rows" if not len(pdf) else "one label" if len(set(y)) < 2 else "one observation state" if len(set(o)) < 2
            else "too few scores" if spline_df and len(set(s)) < spline_df + 1 else ""
        )
        if status:
            return pd.DataFrame([[*key, len(pdf), None, None, None, status]])
        design = np.column_stack([np.ones(len(y)), o, *([spline_basis(s, spline_df)] if spline_df else [])])
        estimate, low, high, status = profile_interval(design, y, 1)
        return pd.DataFrame([[*key, len(pdf), math.exp(estimate), math.exp(low), math.exp(high), status]])

    columns = df.select(*group, *(F.col(c).cast("double") for c in (label, observed, score)))
    return columns.groupBy(*group).applyInPandas(run, schema)


def paired_bootstrap(df: DataFrame, group: Sequence[str], focal: str, role: str, score: str, resamples: int = 1000, seed: int = 0) -> DataFrame:
    """(group, matched_focals, observed_median, control_median, difference, ci_low, ci_high, valid_resamples).

    Each resample draws focals with replacement and one control of each at random. Seeds come from
    the group's key, so runs agree. Roles are ``observed`` and ``control``.
    """
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{g}` {kinds[g]}" for g in group)
    schema += ", matched_focals long, observed_median double, control_median double, difference double, ci_low double, ci_high double, valid_resamples long"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=[score]).sort_values([focal, role, score], kind="stable")
        seen = {k: v for k, v in pdf.groupby(focal)}
        pairs = [(v[score][v[role] == "observed"].to_numpy(), v[score][v[role] == "control"].to_numpy()) for v in seen.values()]
        pairs = [(o[0], c) for o, c in pairs if len(o) and len(c)]
        if not pairs:
            return pd.DataFrame([[*key, 0, None, None, None, None, None, 0]])
        own = np.array([o for o, _ in pairs])
        sizes = np.array([len(c) for _, c in pairs])
        flat = np.concatenate([c for _, c in pairs])
        first = np.cumsum(sizes) - sizes
        rng = np.random.default_rng([seed, zlib.crc32(repr(key).encode())])
        draws, medians = [], []
        for _ in range(resamples):
            at = rng.integers(0, len(own), len(own))
            control = flat[first[at] + (rng.random(len(own)) * sizes[at]).astype(int)]
            medians.append(np.median(control))
            draws.append(np.median(own[at]) - medians[-1])
        low, high = np.quantile(draws, [0.025, 0.975])
        middle = float(np.median(own))
        return pd.DataFrame([[*key, len(own), middle, float(np.mean(medians)), middle - float(np.mean(medians)), low, high, resamples]])

    return df.select(*group, focal, role, score).groupBy(*group).applyInPandas(run, schema)


def weighted_ecdf(df: DataFrame, group: Sequence[str], focal: str, role: str, score: str, points: int = 121) -> DataFrame:
    """(group, role, x, fraction): shares at most x over a grid of the 0.5 to 99.5 percentiles; controls weigh 1/n of their focal."""
    n = F.count("*").over(Window.partitionBy(*group, focal, role))
    rows = df.where(F.col(score).isNotNull()).withColumn("_w", 1 / n)
    ends = rows.groupBy(*group).agg(F.percentile(score, F.array(F.lit(0.005), F.lit(0.995))).alias("_q"))
    step = (F.col("_q")[1] - F.col("_q")[0]) / (points - 1)
    grid = ends.select(*group, F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: F.struct(k.alias("k"), (F.col("_q")[0] + k * step).alias("x")))).alias("_g"))
    grid = grid.select(*group, "_g.k", "_g.x")
    # one pass: each score goes to the first grid point that is not below it, then running sums
    start = ends.select(*group, F.col("_q")[0].alias("_lo"), step.alias("_step"))
    placed = rows.join(F.broadcast(start) if not group else start, list(group)) if group else rows.crossJoin(F.broadcast(start))
    k = F.when(F.col("_step") > 0, F.ceil((F.col(score) - F.col("_lo")) / F.col("_step") - 1e-9)).otherwise(F.when(F.col(score) <= F.col("_lo"), 0).otherwise(points))
    cells = placed.groupBy(*group, role, F.greatest(k, F.lit(0)).cast("int").alias("k")).agg(F.sum("_w").alias("_w"))
    roles = rows.groupBy(*group, role).agg(F.sum("_w").alias("_total"))
    base = grid.join(roles, list(group)) if group else grid.crossJoin(F.broadcast(roles))
    filled = base.join(cells, [*group, role, "k"], "left").withColumn("_w", F.coalesce("_w", F.lit(0.0)))
    run = Window.partitionBy(*group, role).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return filled.withColumn("fraction", F.sum("_w").over(run) / F.col("_total")).select(*group, role, "k", "x", "fraction")


def matching_rate(df: DataFrame, group: Sequence[str], focal: str, matched: Column) -> DataFrame:
    """(group, eligible, matched, rate) of distinct focals."""
    t = df.groupBy(*group).agg(F.countDistinct(focal).alias("eligible"), F.countDistinct(F.when(matched, F.col(focal))).alias("matched"))
    return t.withColumn("rate", F.when(F.col("eligible") > 0, F.col("matched") / F.col("eligible")))
