"""Negative-binomial test of count matrices (two conditions).

Spark shuffles the matrix once into one row per feature; batches of features are fitted together by numpy
inside the tasks (Newton steps on whole batches, no loop over features). Between the steps only a short
table of bin summaries reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import nan_to_null
from ..functions.tails import STIRLING, normal_two_sided, once
from ..sources.staging import stage
from .adjust import adjust_bh
from .ordered import distinct_counts, exact_quantiles, running
from .similarity import by_feature

MIN_DISPERSION, MAX_DISPERSION = 1e-8, 10.0  # the upper end is the number of samples where that is larger


# --- small numpy helpers, all over (features × samples) blocks -----------------------------------


def _ln_gamma(z: np.ndarray) -> np.ndarray:
    w = z + 8.0
    down = np.ones_like(z)
    for i in range(8):
        down = down * (z + i)
    inv = 1.0 / w
    series = np.zeros_like(z)
    for c in reversed(STIRLING):
        series = series * inv * inv + c
    return (w - 0.5) * np.log(w) - w + 0.5 * math.log(2 * math.pi) + series * inv - np.log(down)


def _trigamma(x: float) -> float:
    total = 0.0
    while x < 10:
        total += 1 / (x * x)
        x += 1
    return total + 1 / x + 1 / (2 * x**2) + 1 / (6 * x**3) - 1 / (30 * x**5) + 1 / (42 * x**7)


def _group_means(k: np.ndarray, s: np.ndarray, second: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Fitted ln means (features × 2 groups) at a dispersion: Newton steps on each group's score."""
    out = np.empty((len(k), 2))
    for g, members in enumerate((~second, second)):
        kg, sg = k[:, members], s[members]
        beta = np.log(np.maximum((kg / sg).mean(axis=1), 1e-8))
        for _ in range(30):
            mu = np.exp(beta)[:, None] * sg
            d = 1 + alpha[:, None] * mu
            step = ((kg - mu) / d).sum(axis=1) / np.maximum((mu / d).sum(axis=1), 1e-12)
            step = np.clip(step, -2, 2)
            beta = np.clip(beta + step, -30, 60)
            if np.abs(step).max(initial=0) < 1e-10:
                break
        out[:, g] = beta
    return out


def _profile(k: np.ndarray, mu: np.ndarray, second: np.ndarray, ln_alpha: np.ndarray) -> np.ndarray:
    """Cox-Reid adjusted log likelihood of a dispersion at fixed means."""
    alpha = np.exp(ln_alpha)[:, None]
    r = 1 / alpha
    like = _ln_gamma(k + r) - _ln_gamma(r) - k * np.log1p(r / mu) - r * np.log1p(alpha * mu)
    w = mu / (1 + alpha * mu)
    return like.sum(axis=1) - 0.5 * (np.log(w[:, ~second].sum(axis=1)) + np.log(w[:, second].sum(axis=1)))


_CELLS = 1 << 13  # counts whose dispersions are searched at a time: their arrays stay in a core's cache


def _best_dispersion(k, mu, second, centre=None, prior_var=None) -> np.ndarray:
    """ln dispersion that maximises the adjusted likelihood, with a normal prior around ``centre`` if given."""
    step = max(64, _CELLS // max(1, k.shape[1]))
    parts = [slice(i, i + step) for i in range(0, len(k), step)]
    found = [_best_of_block(k[p], mu[p], second, None if centre is None else centre[p], prior_var) for p in parts]
    return np.concatenate(found) if found else np.zeros(0)


def _best_of_block(k, mu, second, centre, prior_var) -> np.ndarray:
    low, high = math.log(MIN_DISPERSION), math.log(max(MAX_DISPERSION, k.shape[1]))
    grid = np.linspace(low, high, 25)

    def value(x: np.ndarray) -> np.ndarray:
        v = _profile(k, mu, second, x)
        return v if centre is None else v - (x - centre) ** 2 / (2 * prior_var)

    scores = np.stack([value(np.full(len(k), g)) for g in grid])
    best = grid[scores.argmax(axis=0)]
    width = grid[1] - grid[0]
    a, b = np.maximum(best - width, low), np.minimum(best + width, high)
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        left = value(c) >= value(d)
        a, b = np.where(left, a, c), np.where(left, d, b)
    return (a + b) / 2


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for batch in batches:
        if len(batch):
            yield batch, np.stack(batch["k"].to_numpy()).astype("float64")


# --- operators -----------------------------------------------------------------------------------


def _design(samples: DataFrame, factors: DataFrame, levels: tuple[str, str]):
    rows = samples.join(factors, "sample").select("sample", "condition", "size_factor").distinct().orderBy("sample").collect()
    unknown = {r["condition"] for r in rows} - set(levels)
    if unknown:
        raise ValueError(f"conditions other than {levels}: {sorted(unknown)}")
    names = [r["sample"] for r in rows]
    return names, np.array([r["size_factor"] for r in rows]), np.array([r["condition"] == levels[1] for r in rows])


def count_vectors(long: DataFrame, names: list) -> DataFrame:
    """One row per feature: counts in sample order, a missing cell is zero."""
    v = F.coalesce(nan_to_null("value"), F.lit(0.0))
    cells = F.map_from_entries(F.collect_list(F.struct("sample", v.alias("v"))))
    wanted = F.array(*[F.lit(n) for n in names])
    rows = by_feature(long).groupBy("feature").agg(cells.alias("_m"))
    return rows.select("feature", F.transform(wanted, lambda s: F.coalesce(F.try_element_at("_m", s), F.lit(0.0))).alias("k"))


#: Genes beyond these multiples of the trend do not shape it.
TREND_RANGE = (1e-4, 15.0)
#: The least level of the trend.
LEAST_LEVEL = 1e-8
#: Genes whose own dispersion lies at the lower end carry no information on the trend.
INFORMATIVE = 100 * MIN_DISPERSION


def fit_trend(genes: DataFrame, rounds: int = 200, tol: float = 1e-11) -> tuple[float, float]:
    """a1 and a0 of disp_gene = a1 / base_mean + a0: a gamma regression with identity link on all genes (base_mean, disp_gene).

    Every round solves the normal equations weighted by 1 / fit^2, whose sums are one aggregate over the genes; genes
    beyond ``TREND_RANGE`` times the fit of the round before are left out. Repeated until neither the fit nor so the genes
    left out change. A slope that would be negative is 0, such a level ``LEAST_LEVEL``, and the other one is solved alone.
    """
    usable = genes.filter(F.col("disp_gene") > INFORMATIVE).select((1 / F.col("base_mean")).alias("x"), F.col("disp_gene").alias("y"))
    a1, a0 = 1.0, 0.1
    for _ in range(rounds):
        fit = F.lit(a1) * F.col("x") + F.lit(a0)
        w = 1 / fit**2
        kept = usable.filter((F.col("y") > fit * TREND_RANGE[0]) & (F.col("y") < fit * TREND_RANGE[1]))
        x, y = F.col("x"), F.col("y")
        r = kept.agg(F.sum(w).alias("w"), F.sum(w * x).alias("x"), F.sum(w * x * x).alias("xx"), F.sum(w * y).alias("y"), F.sum(w * x * y).alias("xy")).first()
        if r["w"] is None:
            return 0.0, 0.1
        det = r["w"] * r["xx"] - r["x"] ** 2
        slope = (r["w"] * r["xy"] - r["x"] * r["y"]) / det if det > 1e-12 * r["w"] * r["xx"] else 0.0
        if slope <= 0:
            slope, level = 0.0, r["y"] / r["w"]
        elif (level := (r["y"] - slope * r["x"]) / r["w"]) <= 0:
            slope, level = (r["xy"] - LEAST_LEVEL * r["x"]) / r["xx"], LEAST_LEVEL
        done = abs(slope - a1) <= tol * max(a1, slope) and abs(level - a0) <= tol * max(a0, level)
        a1, a0 = slope, level
        if done:
            break
    return a1, a0


def _gene_wise(k: np.ndarray, s: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean normalised count, own dispersion and fitted means of each feature."""
    q = k / s
    mean = q.mean(axis=1)
    moment = (q.var(axis=1, ddof=1) - mean * (1 / s).mean()) / mean**2
    mu = np.exp(_group_means(k, s, second, np.clip(moment, MIN_DISPERSION, max(MAX_DISPERSION, k.shape[1]))))
    mu = np.maximum(np.where(second, mu[:, [1]], mu[:, [0]]) * s, 1e-6)
    return mean, np.exp(_best_dispersion(k, mu, second)), mu


def _shrunk(k: np.ndarray, mu: np.ndarray, second: np.ndarray, own: np.ndarray, trend: np.ndarray, prior_var: float, limit: float) -> np.ndarray:
    """Dispersions drawn to the trend; one more than ``limit`` above it (in logarithms) keeps its own value."""
    centre, own = np.log(trend), np.log(own)
    return np.exp(np.where(own > centre + limit, own, _best_dispersion(k, mu, second, centre, prior_var)))


def nb_dispersion(long: DataFrame, samples: DataFrame, factors: DataFrame, levels: tuple[str, str]) -> DataFrame:
    """Per feature: mean normalised count, gene-wise, trend and final dispersion (features without counts left out).

    The trend a1 / mean + a0 is fitted to all genes (:func:`fit_trend`); the prior width comes from the spread around
    it; a feature more than two residual deviations above the trend keeps its own value. prior_var and own_limit, the same
    in all rows, say by what width and limit that was done.
    """
    names, s, second = _design(samples, factors, levels)
    kind = dict(long.dtypes)["feature"]
    vectors = count_vectors(long, names).filter(F.exists("k", lambda x: x > 0))

    def gene_wise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, k in _blocks(batches):
            mean, own, mu = _gene_wise(k, s, second)
            yield pd.DataFrame({"feature": batch["feature"], "k": batch["k"], "base_mean": mean, "disp_gene": own, "mu": list(mu)})

    genes = stage(vectors.mapInPandas(gene_wise, f"feature {kind}, k array<double>, base_mean double, disp_gene double, mu array<double>"))
    a1, a0 = fit_trend(genes)
    trended = genes.withColumn("disp_trend", F.lit(a1) / F.col("base_mean") + F.lit(a0))

    residual = trended.filter(F.col("disp_gene") > INFORMATIVE).select(F.abs(F.ln("disp_gene") - F.ln("disp_trend")).alias("_r"))
    mad = exact_quantiles(residual, [], "_r", {"m": 0.5}).first()
    spread = (1.4826 * mad["m"]) ** 2 if mad and mad["m"] is not None else 1.0
    prior_var = max(spread - _trigamma(max(len(s) - 2, 1) / 2), 0.25)
    limit = 2 * math.sqrt(max(spread, 1e-12))

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, k in _blocks(batches):
            mu = np.stack(batch["mu"].to_numpy())
            final = _shrunk(k, mu, second, batch["disp_gene"].to_numpy(), batch["disp_trend"].to_numpy(), prior_var, limit)
            yield batch[["feature", "base_mean", "disp_gene", "disp_trend"]].assign(dispersion=final, prior_var=prior_var, own_limit=limit)

    return by_feature(trended).mapInPandas(
        shrink, f"feature {kind}, base_mean double, disp_gene double, disp_trend double, dispersion double, prior_var double, own_limit double"
    )


def trend_scores(dispersions: DataFrame) -> DataFrame:
    """(coefficient, score): the score equations of the trend at the fit, relative to the sums of their positive terms.

    At the fit both are 0. Of a coefficient at its lower bound only a score that would raise it counts.
    """
    x, y, fit = 1 / F.col("base_mean"), F.col("disp_gene"), F.col("disp_trend")
    kept = dispersions.filter((y > INFORMATIVE) & (y > fit * TREND_RANGE[0]) & (y < fit * TREND_RANGE[1]))
    sums = kept.agg(*[(F.sum(v * (y - fit) / fit**2) / F.sum(v * y / fit**2)).alias(c) for c, v in (("a0", F.lit(1.0)), ("a1", x))])
    line = dispersions.agg(F.struct(F.regr_intercept(fit, x).alias("a0"), F.regr_slope(fit, x).alias("a1")))
    bound = {"a0": 10 * LEAST_LEVEL, "a1": 1e-12}
    sums = sums.withColumn("_line", line.scalar()).select(*[F.when(F.col(f"_line.{c}") <= bound[c], F.greatest(c, F.lit(0.0))).otherwise(F.col(c)).alias(c) for c in ("a0", "a1")])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("coefficient"), F.col(c).alias("score")) for c in ("a0", "a1")])))


#: Replicates of a condition from which an outlying count is replaced, and those from which it is looked for.
REPLACED_FROM, SEEN_FROM = 7, 3
_TRIM = 0.2


# fixed values: up to how many replicates which share is trimmed at either end, and what makes up for it in a variance
_CELL_TRIM = ((3, 1 / 3, 2.04), (23, 1 / 4, 1.86), (math.inf, 1 / 8, 1.51))


def _trimmed_mean(x: np.ndarray, share: float) -> np.ndarray:
    cut = int(x.shape[1] * share)
    return np.sort(x, axis=1)[:, cut : x.shape[1] - cut].mean(axis=1)


def _robust_dispersion(k: np.ndarray, s: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dispersion from trimmed variances within the conditions (the larger one), which a single count cannot raise."""
    q = k / s
    variance = np.zeros(len(k))
    for members in (~second, second):
        n = int(members.sum())
        if n >= SEEN_FROM:
            share, scale = next((t, c) for most, t, c in _CELL_TRIM if n <= most)
            own = q[:, members]
            variance = np.maximum(variance, scale * _trimmed_mean((own - _trimmed_mean(own, share)[:, None]) ** 2, share))
    mean = np.maximum(q.mean(axis=1), 1e-12)
    return np.maximum((variance - mean) / mean**2, 0.04)


def _wald(k: np.ndarray, s: np.ndarray, second: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log2 fold change, its error, and Cook's distance of every count, at a dispersion that outliers do not raise."""
    beta = _group_means(k, s, second, alpha)
    mu = np.exp(np.where(second, beta[:, [1]], beta[:, [0]])) * s
    w = mu / (1 + alpha[:, None] * mu)
    w1, w2 = w[:, ~second].sum(axis=1), w[:, second].sum(axis=1)
    hat = w / np.where(second, w2[:, None], w1[:, None])
    pearson = (k - mu) ** 2 / (mu + _robust_dispersion(k, s, second)[:, None] * mu**2)
    cook = pearson / 2 * hat / np.maximum(1 - hat, 1e-12) ** 2
    return (beta[:, 1] - beta[:, 0]) / math.log(2), np.sqrt(1 / w1 + 1 / w2) / math.log(2), cook


def trimmed_counts(k: np.ndarray, s: np.ndarray) -> np.ndarray:
    """What stands in for an outlying count: the trimmed mean of the feature's normalised counts times the size factor."""
    return np.trunc(_trimmed_mean(k / s, _TRIM)[:, None] * s)


def nb_wald_test(
    long: DataFrame, samples: DataFrame, factors: DataFrame, levels: tuple[str, str], dispersions: DataFrame | None = None, refit: bool = True
) -> DataFrame:
    """Per feature: base_mean, log2 fold change (second level over first), its error, z and two-sided p.

    A count dominates its fit where Cook's distance exceeds the 99 % point of F with 2 and n - 2 degrees of freedom and
    its condition has at least three replicates. In conditions of seven and more such a count is replaced by a trimmed
    mean, and the feature is fitted again: own dispersion, shrinking to the given trend with the given width, test. p is
    null where dominating counts remain, or nothing but zeros. ``refit`` needs the columns of :func:`nb_dispersion`.
    """
    names, s, second = _design(samples, factors, levels)
    kind = dict(long.dtypes)["feature"]
    if dispersions is None:
        dispersions = stage(nb_dispersion(long, samples, factors, levels))
    a1 = a0 = prior_var = own_limit = 0.0
    refit = refit and {"disp_trend", "prior_var", "own_limit"} <= set(dispersions.columns)
    if refit:
        x = 1 / F.col("base_mean")
        line = dispersions.agg(F.regr_slope("disp_trend", x).alias("a1"), F.regr_intercept("disp_trend", x).alias("a0"), F.avg("disp_trend").alias("mean"), F.max("prior_var").alias("v"), F.max("own_limit").alias("l")).first()
        refit = line["v"] is not None
        if refit:
            a1, a0 = (line["a1"], line["a0"]) if line["a1"] is not None else (0.0, line["mean"])
            prior_var, own_limit = line["v"], line["l"]
    rows = count_vectors(long, names).join(dispersions.select("feature", "base_mean", "dispersion"), "feature")
    n = len(s)
    rest = n - 2
    limit = rest / 2 * (0.01 ** (-2 / rest) - 1) if rest > 0 else float("inf")
    replicates = np.where(second, second.sum(), (~second).sum())

    def wald(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, k in _blocks(batches):
            mean = batch["base_mean"].to_numpy().copy()
            lfc, se, cook = _wald(k, s, second, batch["dispersion"].to_numpy())
            far = (cook > limit) & (replicates >= SEEN_FROM)
            outlier = far.any(axis=1)
            again = np.flatnonzero((far & (replicates >= REPLACED_FROM)).any(axis=1)) if refit else np.zeros(0, np.int64)
            if len(again):
                new = far[again] & (replicates >= REPLACED_FROM)
                k2 = np.where(new, trimmed_counts(k[again], s), k[again])
                some = k2.any(axis=1)
                again, new, k2 = again[some], new[some], k2[some]
            if len(again):
                mean[again], own, mu = _gene_wise(k2, s, second)
                alpha = _shrunk(k2, mu, second, own, np.maximum(a1 / mean[again] + a0, MIN_DISPERSION), prior_var, own_limit)
                lfc[again], se[again], cook2 = _wald(k2, s, second, alpha)
                outlier[again] = ((cook2 > limit) & (replicates >= SEEN_FROM) & ~new).any(axis=1)
            yield batch[["feature"]].assign(base_mean=mean, log2fc=lfc, lfc_se=se, stat=lfc / se, outlier=outlier)

    fitted = rows.mapInPandas(wald, f"feature {kind}, base_mean double, log2fc double, lfc_se double, stat double, outlier boolean")
    p = once(F.when(~F.col("outlier"), normal_two_sided("stat")))
    return fitted.withColumn("p", p).drop("outlier")


def local_line(x: np.ndarray, y: np.ndarray, span: float = 0.2, robust: int = 3) -> np.ndarray:
    """A locally weighted line through each point: tricube weights over the nearest ``span`` of the points, and ``robust``
    repeats in which points far from the curve weigh less (bisquare)."""
    n = len(x)
    near = min(n, max(2, int(span * n + 1e-9)))
    gap = np.abs(x[:, None] - x[None, :])
    width = np.sort(gap, axis=1)[:, near - 1]
    base = np.clip(1 - (gap / np.maximum(width, 1e-300)[:, None]) ** 3, 0, 1) ** 3
    trust, out = np.ones(n), y.astype(float)
    for _ in range(robust + 1):
        w = base * trust
        total = np.maximum(w.sum(axis=1), 1e-300)
        mx, my = w @ x / total, w @ y / total
        dx = x[None, :] - mx[:, None]
        var = (w * dx**2).sum(axis=1)
        flat = var <= 1e-18 * total * max(float(np.ptp(x)), 1e-300) ** 2
        slope = np.where(flat, 0, (w * dx * (y[None, :] - my[:, None])).sum(axis=1) / np.where(flat, 1, var))
        out = my + slope * (x - mx)
        left = np.abs(y - out)
        middle = 6 * np.median(left)
        if middle <= 1e-12 * max(1.0, float(np.abs(y).max())):
            break
        trust = np.clip(1 - (left / middle) ** 2, 0, 1) ** 2
    return out


def smoothed_cut(shares: np.ndarray, rejected: np.ndarray) -> int:
    """The first cut whose rejections lie within the curve's residual of its maximum; the first of all where at most ten are rejected."""
    if rejected.max(initial=0) <= 10:
        return 0
    curve = local_line(shares, rejected)
    some = rejected > 0
    least = curve.max() - math.sqrt(float(((rejected - curve)[some] ** 2).mean()))
    return int(np.argmax(rejected > least)) if (rejected > least).any() else 0


def de_results(tests: DataFrame, alpha: float = 0.1, cuts: int = 50) -> DataFrame:
    """Add padj: BH over the features above a base-mean cut. padj is null below it.

    The cuts are quantiles of the base mean, from the share of features without counts to 95 %. All are tried in one job, as
    one group of p-values each; a local regression smooths their numbers of rejections at ``alpha``, and the first cut within
    the residual of the curve's maximum is taken.
    """
    tests = stage(tests)
    names = [f"c{i}" for i in range(cuts)]
    empty = tests.agg(F.avg((F.col("base_mean") == 0).cast("double"))).first()[0] or 0.0
    shares = np.linspace(min(empty, 0.95), 0.95, cuts)
    levels = exact_quantiles(tests, [], "base_mean", {c: float(x) for c, x in zip(names, shares, strict=True)})
    grid = levels.select(F.array(*names)).scalar()
    tried = (
        tests.filter(F.col("p").isNotNull())
        .withColumn("_grid", grid)
        .select("p", "base_mean", F.posexplode("_grid").alias("_cut", "_level"))
        .filter(F.col("base_mean") >= F.col("_level"))
    )
    ranked = running(distinct_counts(tried, ["_cut"], "p"), ["_cut"], "p")
    rejected = ranked.filter(F.col("p") * F.col("total") / F.col("upto") < alpha).groupBy("_cut").agg(F.max("upto").alias("_n"))
    counts = np.zeros(cuts)
    for cut, n in rejected.collect():  # one row a cut
        counts[cut] = n
    chosen = tests.withColumn("_grid", grid).withColumn("_at", F.lit(smoothed_cut(shares, counts)))
    chosen = stage(chosen.withColumn("_kept", F.col("base_mean") >= F.get("_grid", F.col("_at"))).drop("_grid", "_at"))
    kept = adjust_bh(chosen.filter("_kept").drop("_kept"), "p")
    rest = chosen.filter("not _kept").drop("_kept").withColumn("padj", F.lit(None).cast("double"))
    return kept.unionByName(rest)
