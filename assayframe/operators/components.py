"""PCA, PLS and what is read off them.

Features far outnumber samples. Every round is one pass in which Spark adds up the Gram matrix of the samples times a few
columns; the driver holds samples × columns. Loadings come from one more scan. The features' value lists are staged
once, because all passes read them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import pct
from ..sources.staging import stage
from .similarity import _block, feature_vectors


class Components(NamedTuple):
    scores: DataFrame
    variance: DataFrame
    loadings: DataFrame


def _sample_names(samples: DataFrame) -> list:
    return [r[0] for r in samples.select("sample").distinct().orderBy("sample").collect()]


def _gram_times(vectors: DataFrame, columns: np.ndarray) -> tuple[np.ndarray, float]:
    """The centred Gram matrix of the samples times some columns, and its trace: one pass, n × columns sums per task."""
    n, width = columns.shape

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n, width))
        squares = 0.0
        for batch in batches:
            if len(batch):
                x = _block(batch, "x")
                x = x - x.mean(axis=1, keepdims=True)
                total += x.T @ (x @ columns)
                squares += float((x * x).sum())
        yield pd.DataFrame({"i": np.arange(n), "row": list(total), "squares": [squares] + [0.0] * (n - 1)})

    parts = vectors.select("x").mapInPandas(partial, "i int, row array<double>, squares double")
    cells = parts.select("i", "squares", F.posexplode("row").alias("j", "v"))
    summed = cells.groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("squares").alias("sq")).toPandas()
    image = np.zeros((n, width))
    image[summed["i"], summed["j"]] = summed["v"]
    return image, float(summed.loc[(summed["i"] == 0) & (summed["j"] == 0), "sq"].sum())


#: Components with less than this share of the largest one's variance are rounding noise: scores and loadings of zero.
NO_VARIANCE = 1e-12


def _iterated_scores(vectors: DataFrame, n: int, k: int, rounds: int = 500, tol: float = 1e-10):
    """Leading eigenpairs of the centred Gram matrix by block power iteration, and its trace.

    A block of as many columns as samples spans everything, so its first round is exact. Otherwise a round is the last one
    when no eigenvalue moved by more than ``tol`` of the largest one, the yardstick that rounding obeys, or when every
    vector is one up to that size. Vectors without variance are zero. Not to converge is an error.
    """
    width = min(n, k + 5)
    basis = np.linalg.qr(np.cos(np.outer(np.arange(1, n + 1), np.arange(1, width + 1))))[0] if width < n else np.eye(n)
    previous = None
    for _ in range(rounds):
        image, trace = _gram_times(vectors, basis)
        small = basis.T @ image
        values, rotation = np.linalg.eigh((small + small.T) / 2)
        values, rotation = values[::-1][:k], rotation[:, ::-1][:, :k]
        vectors_k = basis @ rotation
        size = max(float(values[0]), 0.0)
        left = np.abs(image @ rotation - vectors_k * values).max()
        moved = np.inf if previous is None else np.abs(values - previous).max()
        if width == n or min(left, moved) <= tol * size:
            break
        basis, previous = np.linalg.qr(image)[0], values
    else:
        raise ArithmeticError(f"the scores did not converge in {rounds} rounds")
    none = values <= NO_VARIANCE * size
    return np.where(none, 0.0, values), np.where(none, 0.0, vectors_k), trace


def _project(vectors: DataFrame, coefficients: dict[str, np.ndarray]) -> DataFrame:
    """Per feature: the centred values times each coefficient vector, a scan without a shuffle."""
    spark = vectors.sparkSession
    table = spark.createDataFrame([tuple([float(v) for v in c] for c in coefficients.values())], [f"_c_{c}" for c in coefficients])
    one = table.select(F.struct("*")).scalar()
    x = F.col("x")
    mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x)
    centred = vectors.withColumn("_mean", mean).withColumn("_c", one)

    def dot(c: str) -> Column:
        terms = F.zip_with("x", F.col("_c")[f"_c_{c}"], lambda v, w: (v - F.col("_mean")) * w)
        return F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)

    return centred.select("feature", *[dot(c).alias(c) for c in coefficients])


def _largest_sign(loadings: DataFrame, names: list[str]) -> list[float]:
    """The sign that makes the largest loading of each component positive (ties by feature)."""
    row = loadings.agg(
        *[F.max_by(F.col(c), F.struct(F.bround(F.abs(F.col(c)), 9), F.col("feature"))).alias(c) for c in names]
    ).first()
    return [1.0 if row[c] is None or row[c] >= 0 else -1.0 for c in names]


def pca(long: DataFrame, samples: DataFrame, k: int = 2) -> Components:
    """Centred, unscaled PCA of the samples.

    scores: sample, condition, pc1…; variance: pc, sd, share, percent, cumulative; loadings: feature, pc1….
    """
    spark = long.sparkSession
    names = _sample_names(samples)
    n = len(names)
    k = min(k, n)
    vectors = stage(feature_vectors(long, samples))
    values, vecs, trace = _iterated_scores(vectors, n, k)
    scale = np.sqrt(values)
    cols = [f"pc{i + 1}" for i in range(k)]

    coefficients = spark.createDataFrame(pd.DataFrame(vecs, columns=cols).assign(sample=names)).withColumn(
        "sample", F.col("sample").cast(samples.schema["sample"].dataType)
    )
    raw = _project(vectors, {c: vecs[:, i] for i, c in enumerate(cols)})
    signs = _largest_sign(raw, cols)
    loadings = raw.select(
        "feature", *[(F.col(c) * (s / w if w > 0 else 0.0)).alias(c) for c, s, w in zip(cols, signs, scale)]
    )
    scores = coefficients.select(
        "sample", *[(F.col(c) * float(s * w)).alias(c) for c, s, w in zip(cols, signs, scale)]
    ).join(samples.select("sample", "condition").distinct(), "sample")
    share = values / trace if trace > 0 else values * 0
    variance = spark.createDataFrame(
        pd.DataFrame({"pc": range(1, k + 1), "sd": np.sqrt(values / max(n - 1, 1)), "share": share, "cumulative": np.cumsum(share)})
    ).withColumn("percent", pct("share"))
    return Components(scores.select("sample", "condition", *cols), variance, loadings)


def score_ellipse(scores: DataFrame, x: str = "pc1", y: str = "pc2", group: str = "condition", level: float = 0.95) -> DataFrame:
    """Per group: centre, half axes and angle of the ellipse that holds ``level`` of a normal cloud."""
    radius = float(np.sqrt(-2 * np.log(1 - level)))  # square root of the chi-square quantile for two dimensions
    g = scores.groupBy(group).agg(
        F.avg(x).alias("centre_x"),
        F.avg(y).alias("centre_y"),
        F.var_samp(x).alias("_vx"),
        F.var_samp(y).alias("_vy"),
        F.covar_samp(x, y).alias("_cxy"),
    )
    half = (F.col("_vx") + F.col("_vy")) / 2
    root = F.sqrt(((F.col("_vx") - F.col("_vy")) / 2) ** 2 + F.col("_cxy") ** 2)
    return g.select(
        group,
        "centre_x",
        "centre_y",
        (F.sqrt(half + root) * radius).alias("major"),
        (F.sqrt(F.greatest(half - root, F.lit(0.0))) * radius).alias("minor"),
        (F.atan2(2 * F.col("_cxy"), F.col("_vx") - F.col("_vy")) / 2).alias("angle"),
    )


class Pls(NamedTuple):
    scores: DataFrame
    loadings: DataFrame
    weights: DataFrame
    fit: DataFrame


def pls(long: DataFrame, samples: DataFrame, levels: tuple[str, str], ncomp: int = 2) -> Pls:
    """PLS regression of the class (second level over first, as 1 and 0) on the features.

    Each component is one pass: the centred Gram matrix times the response without the components before. These are
    orthogonal, so taking them out of a vector deflates the matrix, and the driver holds n × ncomp numbers.
    """
    spark = long.sparkSession
    rows = samples.select("sample", "condition").distinct().orderBy("sample").collect()
    names = [r[0] for r in rows]
    n = len(names)
    y = np.array([float(r[1] == levels[1]) for r in rows])
    y = y - y.mean()
    vectors = stage(feature_vectors(long, samples))
    total_y = float(y @ y)
    score, weight_of, fits = [], [], []

    def deflated(v: np.ndarray) -> np.ndarray:
        for t in score:
            v = v - t * (t @ v) / (t @ t)
        return v

    for _ in range(min(ncomp, n - 1)):
        wanted = deflated(y)
        image, trace = _gram_times(vectors, wanted[:, None])
        size = float(np.sqrt(max(wanted @ image[:, 0], 0.0)))
        if size <= 1e-12 * max(1.0, np.sqrt(trace)):
            break
        weight_of.append(wanted / size)
        t = deflated(image[:, 0]) / size
        q = float(y @ t / (t @ t))
        fits.append((q, float(t @ t)))
        y = y - q * t
        score.append(t)
    a = len(score)
    cols = [f"comp{i + 1}" for i in range(a)]
    kind = samples.schema["sample"].dataType

    def table(columns: list[np.ndarray]) -> DataFrame:
        pdf = pd.DataFrame(dict(zip(cols, columns))).assign(sample=names)
        return spark.createDataFrame(pdf).withColumn("sample", F.col("sample").cast(kind))

    weights = _project(vectors, dict(zip(cols, weight_of)))
    signs = _largest_sign(weights, cols)
    signed = [F.col(c) * s for c, s in zip(cols, signs)]
    weights = weights.select("feature", *[x.alias(c) for x, c in zip(signed, cols)])
    loadings = _project(vectors, {c: t / (t @ t) for c, t in zip(cols, score)})
    loadings = loadings.select("feature", *[x.alias(c) for x, c in zip(signed, cols)])
    scores = table(score).join(samples.select("sample", "condition").distinct(), "sample")
    scores = scores.select("sample", "condition", *[x.alias(c) for x, c in zip(signed, cols)])
    fit = spark.createDataFrame(
        [(i + 1, q * s, q * q * tt, q * q * tt / total_y) for i, ((q, tt), s) in enumerate(zip(fits, signs))],
        "comp int, y_loading double, ss double, y_share double",
    )
    return Pls(scores, loadings, weights, fit)


def vip(model: Pls, ncomp: int = 1) -> DataFrame:
    """Variable importance: weights of the components weighted by the response variance they explain."""
    fits = {r["comp"]: r["ss"] for r in model.fit.collect()}
    used = [i for i in range(1, ncomp + 1) if i in fits]
    total = sum(fits[i] for i in used)
    n_features = model.weights.agg(F.count(F.lit(1))).scalar()
    mass: Column = sum((F.col(f"comp{i}") ** 2 * (fits[i] / total) for i in used), F.lit(0.0))
    return model.weights.withColumn("_n", n_features).select("feature", F.sqrt(mass * F.col("_n")).alias("vip"))


def top_vip(importance: DataFrame, k: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("vip"), "feature").limit(k)
