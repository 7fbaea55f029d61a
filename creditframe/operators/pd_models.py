"""PD models, hazard fits and unsupervised segments on Spark ML."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creditframe.functions.hazards import Hazard
from creditframe.functions.scalars import key_fraction, round_half_up, sigmoid
from creditframe.operators import boosting, isotonic
from creditframe.operators.features import CATEGORICAL, NUMERIC
from creditframe.operators.target import LOAN
from creditframe.session import ensure_checkpoint_dir

# Hazard covariates.
AGE_FEATURES = ["loan_age_q", "loan_age_q_sq"]
DEFAULT_FEATURES = [*AGE_FEATURES, "fico", "current_ltv", "odti", "orig_rate", "unemployment_rate"]
PREPAY_FEATURES = [*AGE_FEATURES, "fico", "orig_rate", "unemployment_rate", "hpi_yoy", "mortgage_rate"]
EXPECTED_SIGNS = {"unemployment_rate": 1, "current_ltv": 1, "fico": -1, "odti": 1}
SEGMENT_FEATURES = ["fico", "oltv", "ocltv", "odti", "orig_rate", "orig_upb", "loan_term"]
RARE_BELOW = 50
MEDIAN_ERROR = 0.001
#: Training rows of a boosted fit that one task holds; it only spreads the work.
ROWS_PER_TASK = 50_000


def _doubles(df: DataFrame, names) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _numeric_stages(names) -> list:
    """Median impute, assemble and standardise."""
    filled = [f"{name}_filled" for name in names]
    return [
        Imputer(strategy="median", inputCols=list(names), outputCols=filled, relativeError=MEDIAN_ERROR),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
    ]


# --- hazards ----------------------------------------------------------------------------------


def fit_hazard(panel: DataFrame, target: str, features: list[str], penalty: float = 1.0, steps: int = 100, tol: float = 1e-10) -> Hazard:
    """One hazard fitted on a panel; see ``fit_hazards``."""
    return fit_hazards(panel, {target: features}, penalty, steps, tol)[target]


def fit_hazards(panel: DataFrame, wanted: dict[str, list[str]], penalty: float = 1.0, steps: int = 100, tol: float = 1e-10) -> dict[str, Hazard]:
    """One hazard for each target and its features, all from one reading of the panel.

    The columns that any of the fits needs are cached, spilling to disk, before the first pass: a panel comes
    from joins and shuffles, and every pass of every fit reads the cached columns instead of running them again.
    """
    columns = list(dict.fromkeys([*wanted, *[f for features in wanted.values() for f in features]]))
    data = panel.select(*columns).persist()
    try:
        return {target: _fit_hazard(data, target, features, penalty, steps, tol) for target, features in wanted.items()}
    finally:
        data.unpersist()


def _fit_hazard(panel: DataFrame, target: str, features: list[str], penalty: float, steps: int, tol: float) -> Hazard:
    """Median impute, standardise, ridge logit with ``penalty`` on the summed loss (not on the intercept).

    Medians are exact (``percentile``), means and sample standard deviations come from one aggregate,
    and each Newton step is one more: the gradient and the Hessian as ``(k + 1)(k + 4) / 2`` sums over
    the rows, solved on the driver for ``k + 1`` parameters. Rows without a label are left out; a feature
    without any value is imputed by 0; a constant feature is scaled by 1, so it is 0 after centring and
    its coefficient is 0.
    """
    labelled = panel.where(F.col(target).isNotNull())
    medians = labelled.agg(*[F.percentile(F.col(f).cast("double"), F.lit(0.5)).alias(f) for f in features]).first()
    filled = labelled.select(
        *[F.coalesce(F.col(f).cast("double"), F.lit(float(medians[f] or 0.0))).alias(f) for f in features],
        F.col(target).cast("double").alias("label"),
    )
    moments = filled.agg(*[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    mean = {f: float(moments[f"m_{f}"] or 0.0) for f in features}
    scale = {f: float(moments[f"s_{f}"] or 0.0) or 1.0 for f in features}
    # The intercept and every feature that varies; a constant one keeps its coefficient at 0.
    free = np.array([True] + [bool(moments[f"s_{f}"]) for f in features])
    z = [(F.col(f) - F.lit(mean[f])) / F.lit(scale[f]) for f in features]
    data = filled.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], "label")
    k = len(features)
    ridge = np.diag([0.0] + [penalty] * k)
    w = np.zeros(k + 1)
    for _ in range(steps):
        eta = reduce(lambda a, b: a + b, [F.lit(float(w[i + 1])) * F.col(f"z{i}") for i in range(k)], F.lit(float(w[0])))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        rows = data.select(*[f"z{i}" for i in range(k)], "label", p.alias("p"))
        cols = [F.lit(1.0)] + [F.col(f"z{i}") for i in range(k)]
        residual, curvature = F.col("p") - F.col("label"), F.col("p") * (F.lit(1.0) - F.col("p"))
        sums = [F.sum(residual * c).alias(f"g{i}") for i, c in enumerate(cols)]
        sums += [F.sum(curvature * cols[i] * cols[j]).alias(f"h{i}_{j}") for i in range(k + 1) for j in range(i, k + 1)]
        row = rows.agg(*sums).first()
        gradient = np.array([row[f"g{i}"] or 0.0 for i in range(k + 1)]) + ridge @ w
        hessian = np.zeros((k + 1, k + 1))
        for i in range(k + 1):
            for j in range(i, k + 1):
                hessian[i, j] = hessian[j, i] = row[f"h{i}_{j}"] or 0.0
        step = np.zeros(k + 1)
        step[free] = np.linalg.solve((hessian + ridge)[np.ix_(free, free)], gradient[free])
        w = w - step
        if np.max(np.abs(step)) < tol:
            break
    return Hazard(intercept=float(w[0]), coef={f: float(w[i + 1]) for i, f in enumerate(features)}, mean=mean, scale=scale)


def parameter_table(spark, hazard: Hazard) -> DataFrame:
    """Every parameter of a fitted hazard: the intercept, then each covariate's coefficient, mean and scale.

    ``hazard_at_mean`` is the hazard of the representative loan, whose covariates all equal their means.
    """
    rows = [("(intercept)", hazard.intercept, None, None)]
    rows += [(name, hazard.coef[name], hazard.mean[name], hazard.scale[name]) for name in hazard.features]
    table = spark.createDataFrame(rows, "term string, coefficient double, mean double, scale double")
    return table.withColumn("hazard_at_mean", sigmoid(F.lit(hazard.intercept)))


def coefficient_table(spark, hazard: Hazard) -> DataFrame:
    """Standardised coefficients with the sign each is expected to have."""
    rows = [(name, hazard.coef[name], EXPECTED_SIGNS.get(name)) for name in hazard.features]
    table = spark.createDataFrame(rows, "feature string, coefficient double, expected_sign int")
    return table.withColumn("sign_ok", F.signum("coefficient") == F.col("expected_sign").cast("double"))


# --- default models ---------------------------------------------------------------------------


def categories(df: DataFrame, columns=CATEGORICAL, rare_below: int = RARE_BELOW) -> dict[str, tuple[list, list]]:
    """Frequent and rare categories of each coded column; one grouped pass over all columns.

    They become encoder labels, which a Spark ML encoder keeps on the driver as well; all are kept,
    however many there are.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    counts = df.select(F.inline(entries)).groupBy("name", "value").agg(F.count("*").alias("n"))
    rows = counts.collect()  # one row per category: the encoder keeps them all on the driver anyway
    out: dict[str, tuple[list, list]] = {c: ([], []) for c in columns}
    for row in sorted(rows):
        out[row["name"]][row["n"] < rare_below].append(row["value"])
    return out


@dataclass
class PdModel:
    """A fitted pipeline with the categories it was trained on."""

    pipeline: PipelineModel
    known: dict[str, tuple[list, list]]
    #: Boosted trees on the pipeline's columns, where the pipeline itself ends before the classifier.
    trees: boosting.Trees | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Frequent categories as they are, rare ones pooled; others become an unseen label."""
        out = df.fillna("missing", subset=list(self.known))
        for name, (frequent, rare) in self.known.items():
            value = F.col(name)
            pooled = F.when(value.isin(frequent), value).when(value.isin(rare), "(rare)").otherwise("(unseen)")
            out = out.withColumn(name, pooled)
        return _doubles(out, NUMERIC)

    def score(self, df: DataFrame, name: str = "pd") -> DataFrame:
        """Input rows with the probability of default as ``name``."""
        keep = [F.col(c).alias(f"_in_{c}") for c in df.columns]
        prepared = self.prepare(df.select("*", *keep))
        scored = self.pipeline.transform(prepared)
        originals = [F.col(f"_in_{c}").alias(c) for c in df.columns]
        probability = self.trees.probability() if self.trees else vector_to_array("probability")[1]
        return scored.select(*originals, probability.alias(name))


def _labelled(df: DataFrame) -> tuple[DataFrame, PdModel]:
    rows = df.where(F.col("default_flag").isNotNull())
    return rows, PdModel(None, categories(rows.fillna("missing", subset=CATEGORICAL)))


def _class_counts(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.count("*").alias("n"), F.sum("default_flag").alias("p")).first()
    return row["n"], row["p"]


def fit_logit(train: DataFrame) -> PdModel:
    """Logistic benchmark with one-hot categories and balanced class weights."""
    filled, model = _labelled(train)
    n, p = _class_counts(filled)
    weight = F.when(F.col("default_flag") == 1, n / (2.0 * max(p, 1))).otherwise(n / (2.0 * max(n - p, 1)))
    data = model.prepare(filled).withColumn("weight", weight).withColumn("label", F.col("default_flag").cast("double"))
    indexed, encoded = [f"{c}_index" for c in CATEGORICAL], [f"{c}_hot" for c in CATEGORICAL]
    stages = [
        *_numeric_stages(NUMERIC),
        StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
        # The last index is the unknown category; dropping it encodes an unknown as all zeros.
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
        LogisticRegression(
            # A unit penalty on the summed loss and 200 iterations.
            labelCol="label", weightCol="weight", regParam=1.0 / n, standardization=False, maxIter=200
        ),
    ]
    data = data.persist()
    try:
        model.pipeline = Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()
    return model


def _stored_for_trees(rows: DataFrame, n: int) -> DataFrame:
    """The rows in one task for each ``ROWS_PER_TASK`` of them, stored apart from the plan that made them.

    A boosted fit runs five jobs a tree over the same few columns, so its time is mostly the tasks' start and
    the plan that each of them carries: as many tasks as the rows fill, at least two a core, never more than
    there were. Rows are drawn for each tree per task, so a layout of few tasks is left as it is.
    """
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    # ``coalesce`` would put even an unchanged number of cached tasks in another order.
    return (rows.coalesce(tasks) if rows.rdd.getNumPartitions() > tasks else rows).checkpoint()


def fit_boosted(train: DataFrame, trees: int = 400, seed: int = 42, share: int = 1) -> PdModel:
    """Boosted-tree challenger with the positive class weighted up to the negative one.

    The training rows are computed once: categories, class counts and the stored rows of the fit all come
    from the cached input columns. The trees are grown by ``boosting.fit``, where ``share`` fits at the same
    time leave each other room, or by Spark's classifier where that cannot run; they are the same trees.
    """
    ensure_checkpoint_dir(train.sparkSession)
    train = train.where(F.col("default_flag").isNotNull()).persist()
    try:
        filled, model = _labelled(train)
        n, p = _class_counts(filled)
        weight = F.when(F.col("default_flag") == 1, (n - p) / float(max(p, 1))).otherwise(1.0)
        data = model.prepare(filled).withColumn("weight", weight).withColumn("label", F.col("default_flag").cast("double"))
        data = _stored_for_trees(data.select("label", "weight", *NUMERIC, *CATEGORICAL), n)
    finally:
        train.unpersist()
    # A split needs a bin for each category; the indexer adds one for the unknown.
    bins = max(64, *(len(frequent) + 4 for frequent, _ in model.known.values()))
    indexed = [f"{c}_index" for c in CATEGORICAL]
    numbers = [f"{c}_filled" for c in NUMERIC]
    stages = [
        Imputer(strategy="median", inputCols=NUMERIC, outputCols=numbers, relativeError=MEDIAN_ERROR),
        StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
    ]
    # The challenger's published settings (depth 5, step 0.05, row and feature shares 0.8,
    # at least 5 rows a leaf); the tree count is the parameter ``trees`` (400).
    settings = boosting.Settings(trees, seed, depth=5, step=0.05, row_share=0.8, feature_share=0.8, min_rows=5, bins=bins)
    if boosting.possible(data.sparkSession):
        model.pipeline = Pipeline(stages=stages).fit(data)
        coded = {c: len(labels) + 1 for c, labels in zip(indexed, model.pipeline.stages[-1].labelsArray)}
        model.trees = boosting.fit(model.pipeline.transform(data), numbers, coded, settings, n, share)
    else:
        model.pipeline = Pipeline(stages=[*stages, *_spark_trees([*numbers, *indexed], settings)]).fit(data)
    return model


def _spark_trees(columns: list[str], settings: boosting.Settings) -> list:
    """Stages of Spark's own classifier with the same settings."""
    return [
        VectorAssembler(inputCols=columns, outputCol="features"),
        GBTClassifier(
            labelCol="label", weightCol="weight", maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.step,
            subsamplingRate=settings.row_share, featureSubsetStrategy=str(settings.feature_share),
            minInstancesPerNode=settings.min_rows, maxBins=settings.bins, seed=settings.seed, checkpointInterval=10,
        ),
    ]


@dataclass
class Calibrated:
    """Mean of fold models, each corrected by the isotonic fit (its pools) of its held-out fold."""

    folds: list

    def score(self, df: DataFrame, name: str = "pd") -> DataFrame:
        out, names = df, []
        for i, (model, pools) in enumerate(self.folds):
            scored = model.score(out, f"_raw_{i}")
            out = scored.withColumn(f"_fold_{i}", isotonic.predict(pools, F.col(f"_raw_{i}"))).drop(f"_raw_{i}")
            names.append(f"_fold_{i}")
        mean = reduce(lambda a, b: a + b, [F.col(c) for c in names]) / F.lit(float(len(names)))
        return out.withColumn(name, mean).drop(*names)


def calibrate(train: DataFrame, folds: int = 3, trees: int = 400, seed: int = 42) -> Calibrated:
    """Isotonic calibration over key-hashed folds.

    Each fold is scored by a model that did not see it. The labelled rows are stored once and the fold
    models are fitted at the same time, each from its own driver thread. The isotonic fits pool ranges
    of scores on the executors and merge them pairwise (``isotonic.fit``).
    """
    fold = F.floor(key_fraction(F.col(LOAN), seed) * F.lit(float(folds))).cast("int")
    labelled = train.where(F.col("default_flag").isNotNull()).withColumn("_fold", fold).persist()

    def one(i: int):
        model = fit_boosted(labelled.where(F.col("_fold") != i).drop("_fold"), trees, seed, share=folds)
        held = model.score(labelled.where(F.col("_fold") == i).drop("_fold"), "raw")
        return model, isotonic.fit(held, "raw", "default_flag")

    try:
        with ThreadPoolExecutor(max_workers=folds) as pool:
            fitted = list(pool.map(one, range(folds)))
    finally:
        labelled.unpersist()
    return Calibrated(fitted)


def fit_platt(holdout: DataFrame, y: str, score: str) -> PipelineModel:
    """Platt scaling: an unpenalised logit of the outcome on the score of a holdout."""
    rows = holdout.where(F.col(score).isNotNull() & F.col(y).isNotNull())
    data = rows.select(F.col(score).cast("double").alias("raw"), F.col(y).cast("double").alias("label")).persist()
    stages = [VectorAssembler(inputCols=["raw"], outputCol="features"), LogisticRegression(labelCol="label")]
    try:
        # The moments, the blocks of the fit and its two summaries each read the rows: two cached columns.
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def platt_scaled(model: PipelineModel, df: DataFrame, score: str, name: str = "pd") -> DataFrame:
    """The score mapped to a calibrated probability; the fit is two numbers applied as an expression."""
    logit = model.stages[-1]
    slope, intercept = float(logit.coefficients[0]), float(logit.intercept)
    return df.withColumn(name, sigmoid(F.lit(intercept) + F.lit(slope) * F.col(score)))


# The signs the PD logit's coefficients are expected to have.
PD_EXPECTED_SIGNS = {"fico": -1, "oltv": 1, "ocltv": 1, "odti": 1, "orig_rate": 1}


def logit_contributions(model: PdModel, df: DataFrame) -> DataFrame:
    """Log-odds contributions of the fitted PD logit, per feature group, over the rows of ``df``.

    A numeric feature contributes its coefficient times its standardised, imputed value; a coded
    feature the coefficient of its category (0 for the dropped last level). Per group: the mean
    absolute contribution, its rank, the correlation with the raw value (numeric features), the
    coefficient (numeric features) and whether its sign is the expected one. One aggregate.
    """
    imputer, scaler, indexer, logit = model.pipeline.stages[0], model.pipeline.stages[2], model.pipeline.stages[3], model.pipeline.stages[-1]
    medians = imputer.surrogateDF.first()
    coef = [float(c) for c in logit.coefficients]
    prepared = model.prepare(df)
    terms: dict[str, Column] = {}
    for i, name in enumerate(NUMERIC):
        filled = F.coalesce(F.col(name), F.lit(float(medians[name])))
        std = float(scaler.std[i]) or 1.0
        terms[name] = F.lit(coef[i]) * (filled - F.lit(float(scaler.mean[i]))) / F.lit(std)
    at = len(NUMERIC)
    for name, labels in zip(CATEGORICAL, indexer.labelsArray):
        weights = {label: coef[at + j] for j, label in enumerate(labels)}
        at += len(labels)
        lookup = F.create_map(*[x for label, w in weights.items() for x in (F.lit(label), F.lit(w))]) if weights else None
        terms[name] = F.coalesce(lookup[F.col(name)], F.lit(0.0)) if lookup is not None else F.lit(0.0)
    sums = prepared.agg(
        *[F.avg(F.abs(t)).alias(f"a_{n}") for n, t in terms.items()],
        *[F.corr(F.col(n), t).alias(f"r_{n}") for n, t in terms.items() if n in NUMERIC],
    ).first()
    rows = []
    for n in terms:
        c = coef[NUMERIC.index(n)] if n in NUMERIC else None
        sign = PD_EXPECTED_SIGNS.get(n)
        rows.append((n, float(sums[f"a_{n}"] or 0.0), sums[f"r_{n}"] if n in NUMERIC else None, c, sign, None if sign is None or c is None else bool(np.sign(c) == sign)))
    table = df.sparkSession.createDataFrame(rows, "feature string, mean_abs double, correlation double, coefficient double, expected_sign int, sign_ok boolean")
    # One row per feature group reaches this window.
    return table.withColumn("importance_rank", F.row_number().over(W.orderBy(F.col("mean_abs").desc(), "feature")))


def contributions(df: DataFrame, hazard: Hazard) -> DataFrame:
    """Mean absolute log-odds contribution of each feature, its rank, and its correlation with the feature."""
    names = hazard.features
    sums = df.agg(
        *[F.avg(F.abs(hazard.contribution(f))).alias(f"a_{f}") for f in names],
        *[F.corr(F.col(f).cast("double"), hazard.contribution(f)).alias(f"r_{f}") for f in names],
    )
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f"a_{f}").alias("mean_abs"), F.col(f"r_{f}").alias("correlation"))
            for f in names
        ]
    )
    # One row per feature reaches this window.
    order = F.row_number().over(W.orderBy(F.col("mean_abs").desc(), "feature"))
    return sums.select(F.inline(entries)).withColumn("importance_rank", order)


# --- segments ---------------------------------------------------------------------------------


def standardised_columns(df: DataFrame, names=SEGMENT_FEATURES) -> dict[str, Column]:
    """Each feature with exact median imputation, centred and divided by its sample deviation (1 if constant).

    Two aggregates: the medians, then the means and deviations of the filled values.
    """
    medians = df.agg(*[F.percentile(F.col(f).cast("double"), F.lit(0.5)).alias(f) for f in names]).first()
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(float(medians[f] or 0.0))) for f in names}
    moments = df.agg(*[F.avg(c).alias(f"m_{f}") for f, c in filled.items()], *[F.stddev_samp(c).alias(f"s_{f}") for f, c in filled.items()]).first()
    return {f: (c - F.lit(float(moments[f"m_{f}"] or 0.0))) / F.lit(float(moments[f"s_{f}"] or 0.0) or 1.0) for f, c in filled.items()}


def pca(df: DataFrame, k: int = 3) -> tuple[DataFrame, list[float]]:
    """Rows with their first ``k`` principal components, and the share of variance each explains.

    The covariance of the standardised features is one aggregate of their cross products (a fixed
    width of ``d (d + 1) / 2`` sums); its eigenvectors are solved on the driver, ordered by eigenvalue
    and signed so that the largest entry of each is positive.
    """
    z = standardised_columns(df)
    names = list(z)
    d = len(names)
    sums = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(z[names[i]] * z[names[j]]).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)]).first()
    covariance = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            covariance[i, j] = covariance[j, i] = (sums[f"c{i}_{j}"] or 0.0) / max(sums["n"] - 1, 1)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), range(d)] < 0, -1.0, 1.0)
    total = values.sum()
    components = [reduce(lambda a, b: a + b, [F.lit(float(vectors[i, c])) * z[n] for i, n in enumerate(names)]).alias(f"pc{c + 1}") for c in range(k)]
    explained = [float(v / total) if total > 0 else 0.0 for v in values[:k]]
    return df.select(*df.columns, *components), explained


def explained_variance(spark, df: DataFrame, k: int = 3) -> DataFrame:
    """One row per component: its number and the share of variance it explains."""
    _, shares = pca(df, k)
    return spark.createDataFrame([(c + 1, share) for c, share in enumerate(shares)], "component int, explained_variance double")


def _nearest(z: list[Column], centres: np.ndarray) -> Column:
    """Struct (squared distance, number) of the nearest of ``centres``; ties go to the smaller number."""
    options = [
        F.struct(reduce(lambda a, b: a + b, [(v - F.lit(float(c[i]))) * (v - F.lit(float(c[i]))) for i, v in enumerate(z)]).alias("d"), F.lit(j).alias("c"))
        for j, c in enumerate(centres)
    ]
    return F.least(*options) if len(options) > 1 else options[0]


def _lloyd_sums(centres: np.ndarray):
    """Per task: for every start, each row's nearest centre, summed per (start, centre) before any shuffle."""
    starts, k, d = centres.shape

    def run(frames):
        sums, counts, cost = np.zeros((starts, k, d)), np.zeros((starts, k), np.int64), np.zeros((starts, k))
        for frame in frames:
            x = frame.to_numpy(np.float64)
            for s in range(starts):
                distance = ((x[:, None, :] - centres[s][None, :, :]) ** 2).sum(axis=2)
                nearest = distance.argmin(axis=1)  # ties: the smaller centre
                np.add.at(sums[s], nearest, x)
                counts[s] += np.bincount(nearest, minlength=k)
                cost[s] += np.bincount(nearest, weights=distance[np.arange(len(x)), nearest], minlength=k)
        s_index, c_index = np.nonzero(counts)
        out = pd.DataFrame({"s": s_index, "c": c_index, "n": counts[s_index, c_index], "cost": cost[s_index, c_index]})
        for i in range(d):
            out[f"m{i}"] = sums[s_index, c_index, i]
        yield out

    return run


def segments(df: DataFrame, k: int = 5, seed: int = 42, starts: int = 10, steps: int = 20, tol: float = 1e-4) -> DataFrame:
    """K-means on the standardised features; the best of several starts by cost, all starts in one pass.

    Start ``s`` seeds centre ``j`` with the row of least ``xxhash64(key, seed, s, j)``: one aggregate of
    ``starts * k`` ``min_by`` columns. Each Lloyd step is one pass for all starts together: every task
    finds, for each start, the nearest centre of its rows and sums them per (start, centre), so at most
    ``starts * k`` rows a task are shuffled and collected. A start stops once no centre moves by more than
    ``tol`` (or after ``steps``, Spark's defaults); an empty centre stays where it is. The start of least
    total squared distance wins (ties: the smaller start). Rows are then assigned to its centres by an
    expression over the input, so no model reaches the executors and nothing stays cached.
    """
    z = standardised_columns(df)
    names = list(z)
    d = len(names)
    data = df.select(*[c.alias(f"_z{i}") for i, c in enumerate(z.values())], F.col(LOAN)).persist()
    zs = [F.col(f"_z{i}") for i in range(d)]
    step_schema = "s long, c long, n long, cost double, " + ", ".join(f"m{i} double" for i in range(d))
    try:
        picks = data.agg(*[
            F.min_by(F.array(*zs), F.xxhash64(F.col(LOAN), F.lit(seed), F.lit(s), F.lit(j))).alias(f"p{s}_{j}")
            for s in range(starts) for j in range(k)
        ]).first()
        if picks is None or picks[0] is None:
            return df.select(*df.columns, F.lit(None).cast("int").alias("cluster"))
        centres = np.array([[picks[f"p{s}_{j}"] for j in range(k)] for s in range(starts)], np.float64)
        moving = np.ones(starts, bool)
        cost = np.zeros(starts)
        for _ in range(steps + 1):
            partial = data.select(*zs).mapInPandas(_lloyd_sums(centres), step_schema)
            sums = partial.groupBy("s", "c").agg(*[F.sum(c).alias(c) for c in ["n", "cost", *[f"m{i}" for i in range(d)]]]).collect()
            moved = centres.copy()
            cost[:] = 0.0
            for row in sums:  # at most starts * k rows
                cost[row["s"]] += row["cost"]
                moved[row["s"], row["c"]] = [row[f"m{i}"] / row["n"] for i in range(d)]
            if not moving.any():
                break  # this pass only measured the cost of the final centres
            shift = np.sqrt(((moved - centres) ** 2).sum(axis=2)).max(axis=1)
            centres = np.where(moving[:, None, None], moved, centres)
            moving &= shift > tol
            moving &= _ < steps - 1
        best = int(min(range(starts), key=lambda s: (cost[s], s)))
    finally:
        data.unpersist()
    return df.select(*df.columns, _nearest([z[n] for n in names], centres[best]).getField("c").alias("cluster"))


def profiles(clustered: DataFrame) -> DataFrame:
    """Size, mean features and default rate per segment, ranked from the riskiest down."""
    table = clustered.groupBy("cluster").agg(
        F.count("*").alias("loans"),
        round_half_up(F.avg("fico"), 2).alias("avg_fico"),
        round_half_up(F.avg("oltv"), 2).alias("avg_oltv"),
        round_half_up(F.avg("odti"), 2).alias("avg_dti"),
        round_half_up(F.avg("orig_rate"), 2).alias("avg_rate"),
        round_half_up(F.lit(100.0) * F.avg("default_flag"), 2).alias("default_rate_pct"),
    )
    # One row per segment reaches this window.
    rank = F.row_number().over(W.orderBy(F.col("default_rate_pct").desc(), "cluster"))
    return table.withColumn("risk_rank", rank)
