"""Logistic models: fit over a grid, champion by validation log-loss, prediction as plain expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def linear(columns: Sequence[str], weights: Sequence[float], intercept: float) -> Column:
    """A dot product the optimizer sees, instead of a model object in the plan."""
    out = F.lit(float(intercept))
    for c, w in zip(columns, weights, strict=True):
        out = out + F.col(c) * float(w)
    return out


def log_loss(p: Column, y: Column) -> Column:
    q = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), p))
    return -F.avg(y * F.log(q) + (1 - y) * F.log(1 - q))


def fit_grid(rows: DataFrame, columns: Sequence[str], strengths: Sequence[float]) -> DataFrame:
    """``rows`` have ``train``, ``label`` and the columns.  One row per inverse strength, the champion marked."""
    ready = VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows).persist()
    train, rest = ready.where("train"), ready.where("NOT train")
    n = train.count()
    out = []
    for c in strengths:
        m = LogisticRegression(regParam=1 / (c * max(1, n)), elasticNetParam=0.0, standardization=False, maxIter=100).fit(train)
        loss = rest.agg(log_loss(sigmoid(linear(columns, m.coefficients, m.intercept)), F.col("label"))).first()[0]
        out.append((float(c), float(m.intercept), [float(w) for w in m.coefficients], loss))
    ready.unpersist()
    best = min(out, key=lambda r: (r[3] is None, r[3]))
    return rows.sparkSession.createDataFrame([(*r, r is best) for r in out], "strength double, intercept double, weights array<double>, log_loss double, champion boolean")


def band(p: Column, std: Column) -> tuple[Column, Column]:
    """95 % band, kept inside 0 to 1."""
    return F.greatest(F.lit(0.0), p - 1.96 * std), F.least(F.lit(1.0), p + 1.96 * std)


def surface(spark, phases: Sequence[float], leads: Sequence[int], z: Column) -> DataFrame:
    """Win probability on a phase by lead grid; ``z`` is an expression of ``phase`` and ``lead``."""
    cells = spark.range(1).select(F.explode(F.array(*[F.lit(float(p)) for p in phases])).alias("phase")).withColumn("lead", F.explode(F.array(*[F.lit(int(x)) for x in leads])))
    return cells.withColumn("p", sigmoid(z))


def uniform(row_id: Column, salt: Column | int) -> Column:
    """A number in [0, 1) that depends on a row's id and a salt alone: the same on every run and every cluster.

    A multiplicative hash of 32 bits, which plain SQL can compute, too.
    """
    mixed = (row_id.cast("long") % 1_000_003 * 2_654_435 + F.lit(salt).cast("long") * 40_503 + 12_345) % 1_000_003
    return (mixed * mixed % 1_000_003).cast("double") / 1_000_003


def synthetic(frame: DataFrame, row_id: str) -> DataFrame:
    """Games with a known truth: ``phase`` and ``lead`` from hashes, ``p`` from the analytic reference, ``label`` drawn from it."""
    rows = frame.withColumns({"phase": uniform(F.col(row_id), 1), "lead": F.floor(uniform(F.col(row_id), 2) * 21) - 10})
    return rows.withColumn("p", reference(F.col("phase"), F.col("lead"))).withColumn("label", (uniform(F.col(row_id), 3) < F.col("p")).cast("double"))


def reference(phase: Column, lead: Column, scale: float = 0.25) -> Column:
    """The analytic win probability: a lead counts more the less of the game is left."""
    return sigmoid(lead * scale / F.sqrt(1.0 - phase + 0.05))


def bootstrap_ensemble(rows: DataFrame, columns: Sequence[str], row_id: str, members: int = 8, strength: float = 1.0) -> DataFrame:
    """``member``, ``intercept`` and ``weights`` of models fitted on resampled rows.

    A row's weight in a member is a Poisson draw by hash, which is what resampling with replacement tends to; the rows
    are neither copied nor moved.  There are as many fits as members, each a distributed one.
    """
    ready = VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows).persist()
    n, out = max(1, ready.count()), []
    for m in range(members):
        u = uniform(F.col(row_id), 100 + m)
        weight = F.when(u < 0.36788, 0).when(u < 0.73576, 1).when(u < 0.91970, 2).when(u < 0.98101, 3).when(u < 0.99634, 4).otherwise(5)
        fit = LogisticRegression(regParam=1 / (strength * n), standardization=False, maxIter=100, weightCol="weight").fit(ready.withColumn("weight", weight.cast("double")))
        out.append((m, float(fit.intercept), [float(w) for w in fit.coefficients]))
    ready.unpersist()
    return rows.sparkSession.createDataFrame(out, "member int, intercept double, weights array<double>")


def ensemble(columns: Sequence[str], fitted: Sequence) -> tuple[Column, Column]:
    """(mean, standard deviation) of the members' predictions, as expressions; ``fitted`` are the ensemble's few rows."""
    ps = F.array(*[sigmoid(linear(columns, r["weights"], r["intercept"])) for r in fitted])
    mean = F.aggregate(ps, F.lit(0.0), lambda s, p: s + p) / len(fitted)
    return mean, F.sqrt(F.aggregate(ps, F.lit(0.0), lambda s, p: s + (p - mean) * (p - mean)) / len(fitted))


def training_run(rows: DataFrame, columns: Sequence[str], order: Sequence[str], row_id: str, strengths: Sequence[float] = (0.3, 1.0, 3.0), members: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train on the first 70 % in time, whose inner 80/20 split chooses the champion, and score the rest.

    Returns the scored rows (``p``, ``std``, ``low``, ``high``, ``out_of_bounds``) and the grid with its champion.  What
    reaches the driver are the coefficients.
    """
    from tidemark.operators.stats import out_of_bounds, trained_bounds
    from tidemark.operators.windows import chronological_split

    split = chronological_split(rows, list(order), 0.7)
    train, rest = split.where("train").drop("train"), split.where("NOT train").drop("train")
    grid = fit_grid(chronological_split(train, list(order), 0.8), columns, strengths)
    best = grid.where("champion").first()
    members_ = bootstrap_ensemble(train, columns, row_id, members, best["strength"]).collect()
    _, std = ensemble(columns, members_)
    scored = out_of_bounds(rest, trained_bounds(train, columns), columns).withColumns({"p": sigmoid(linear(columns, best["weights"], best["intercept"])), "std": std})
    low, high = band(F.col("p"), F.col("std"))
    return scored.withColumns({"low": low, "high": high}), grid
