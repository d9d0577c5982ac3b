"""Learning jobs on the tables (O-M*): Spark MLlib for fits, SQL aggregates for metrics."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strokelab.operators import sampling
from strokelab.sources import shared

#: The scores that models learn from.
FEATURES = ("timing_accuracy", "timing_consistency", "tempo_stability", "subdivision_evenness", "velocity_control", "accent_differentiation", "accent_accuracy", "hand_balance")


#: What the tier is learned from, and what the overall score is (no score itself: it is their weighted sum).
TIER_FEATURES = (*FEATURES, "tempo_bpm")
SCORE_FEATURES = ("tempo_bpm", "timing_error_mean", "timing_error_std", "timing_error_max", "velocity_mean", "velocity_std")
#: Rows of a partition of learning data: a fit passes over them many times, so small tables are few tasks.
PART_ROWS = 50_000


def classification_data(samples: DataFrame, exercises: DataFrame, key: str = "sample_id", label: str = "skill_tier") -> DataFrame:
    """Scores and tempo as columns beside the label (O-M01)."""
    return samples.select(key, label, F.col("tempo_bpm").cast("double").alias("tempo_bpm")).join(exercises.select(key, *FEATURES), key)


def regression_data(samples: DataFrame, strokes: DataFrame, exercises: DataFrame, target: str = "overall_score", key: str = "sample_id") -> DataFrame:
    """Tempo and statistics of the strokes (sample deviations) beside the score to learn (O-M01, O-M04)."""
    e, v = F.col("timing_error_ms"), F.col("actual_velocity")
    facts = strokes.groupBy(key).agg(
        F.avg(e).alias("timing_error_mean"), F.stddev_samp(e).alias("timing_error_std"), F.max(e).alias("timing_error_max"), F.avg(v).alias("velocity_mean"), F.stddev_samp(v).alias("velocity_std")
    )
    return samples.select(key, F.col("tempo_bpm").cast("double").alias("tempo_bpm")).join(facts, key).join(exercises.select(key, target), key)


def _parted(df: DataFrame) -> DataFrame:
    """Written once, in partitions of about ``PART_ROWS`` rows."""
    once = shared.written(df)
    return shared.written(once.repartition(max(1, -(-once.count() // PART_ROWS))))


def standardised(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column less its mean, by its population deviation; constant columns become zero (O-M02)."""
    facts = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])  # one row
    j = df.crossJoin(F.broadcast(facts))
    return j.select(*[c for c in df.columns if c not in columns], *[F.coalesce(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.nullif(F.col(f"_s_{c}"), F.lit(0.0))), F.lit(0.0)).alias(c) for c in columns])


def _assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(df)


def classify(df: DataFrame, columns: list[str], label: str, key: str, seed: int = 42, trees: int = 100) -> dict[str, DataFrame]:
    """Test predictions (key, truth, predicted) of logistic regression and a forest (O-M03)."""
    names = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(df)
    split = sampling.train_test(names.transform(_assembled(standardised(df, columns), columns)), key, seed=seed)
    split = _parted(split)
    train, test = split.where("part = 'train'"), split.where("part = 'test'")
    back = F.element_at(F.array(*map(F.lit, names.labels)), F.col("prediction").cast("int") + 1)
    models = {"logistic": LogisticRegression(maxIter=50), "forest": RandomForestClassifier(numTrees=trees, seed=seed)}
    return {n: m.fit(train).transform(test).select(key, F.col(label).alias("truth"), back.alias("predicted")) for n, m in models.items()}


def regress(df: DataFrame, columns: list[str], target: str, key: str, seed: int = 42, trees: int = 100, alpha: float = 1.0) -> dict[str, DataFrame]:
    """Test predictions of ridge regression and a forest (O-M04); the ridge penalty alpha is per row in MLlib."""
    split = sampling.train_test(_assembled(standardised(df, columns), columns).withColumn("label", F.col(target).cast("double")), key, seed=seed)
    split = _parted(split)
    train, test = split.where("part = 'train'"), split.where("part = 'test'")
    n = max(1, train.count())
    models = {"ridge": LinearRegression(regParam=alpha / n, elasticNetParam=0.0), "forest": RandomForestRegressor(numTrees=trees, seed=seed)}
    return {k: m.fit(train).transform(test).select(key, F.col("label").alias("truth"), F.col("prediction").alias("predicted")) for k, m in models.items()}


def confusion(p: DataFrame) -> DataFrame:
    """O-M05."""
    return p.groupBy("truth", "predicted").agg(F.count(F.lit(1)).alias("n"))


def class_report(p: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class (O-M05, O-M06)."""
    hit = (F.col("truth") == F.col("predicted")).cast("long")
    t = p.groupBy(F.col("truth").alias("class")).agg(F.count(F.lit(1)).alias("support"), F.sum(hit).alias("hits"))
    q = p.groupBy(F.col("predicted").alias("class")).agg(F.count(F.lit(1)).alias("said"))
    j = t.join(q, "class", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    j = j.withColumn("precision", zero(F.try_divide("hits", "said"))).withColumn("recall", zero(F.try_divide("hits", "support")))
    return j.withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0))))).select("class", "support", "precision", "recall", "f1")


def class_metrics(p: DataFrame) -> DataFrame:
    """accuracy, balanced accuracy, macro and weighted F1, one row (O-M05, O-M06)."""
    n = F.sum("support")
    return class_report(p).agg(
        F.try_divide(F.sum(F.col("recall") * F.col("support")), n).alias("accuracy"), F.avg("recall").alias("balanced_accuracy"), F.avg("f1").alias("macro_f1"), F.try_divide(F.sum(F.col("f1") * F.col("support")), n).alias("weighted_f1")
    )


def regression_metrics(p: DataFrame) -> DataFrame:
    """MAE, MSE, RMSE and R squared, one row (O-M07)."""
    e = F.col("truth") - F.col("predicted")
    return p.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.try_divide(F.avg(e * e), F.nullif(F.var_pop("truth"), F.lit(0.0)))).alias("r2"))


#: Shares of the training rows at which a learning curve is drawn.
SIZES = tuple(i / 10 for i in range(1, 11))


def learning_curve(df: DataFrame, columns: list[str], label: str, key: str, sizes: Sequence[float] = SIZES, folds: int = 5, trees: int = 50, seed: int = 42, regression: bool = False, threads: int = 4) -> list[dict]:
    """Scores of each fold with their mean, at shares of the training rows (O-M08): accuracy, or R squared for regression.

    A forest is fitted per size and fold; ``threads`` fits run at once, each a Spark job of its own.
    """
    data = _assembled(standardised(df, columns), columns)
    if regression:
        data, model = data.withColumn("label", F.col(label).cast("double")), RandomForestRegressor(numTrees=trees, seed=seed)
    else:
        data, model = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(df).transform(data), RandomForestClassifier(numTrees=trees, seed=seed)
    data = data.select("features", "label", sampling.pick(key, folds, seed).alias("_fold"), (sampling.pick(key, 1000, f"{seed}-size") / 1000).alias("_u"))
    data = _parted(data)

    def score(size: float, fold: int) -> float | None:
        p = model.fit(data.where((F.col("_fold") != fold) & (F.col("_u") < size))).transform(data.where(F.col("_fold") == fold))
        p = p.select(F.col("label").alias("truth"), F.col("prediction").alias("predicted"))
        return regression_metrics(p).first()["r2"] if regression else p.agg(F.avg((F.col("truth") == F.col("predicted")).cast("double"))).first()[0]

    with ThreadPool(threads) as pool:
        found = pool.starmap(score, [(size, fold) for size in sizes for fold in range(folds)])
    out = []
    for i, size in enumerate(sizes):
        scores = [x for x in found[i * folds : (i + 1) * folds] if x is not None]
        out.append({"size": size, "scores": scores, "mean": sum(scores) / len(scores) if scores else 0.0})
    return out


def learnability(curve: list[dict]) -> dict:
    """What a learning curve says (O-M08): whether its second half is better than its first, how steady its last three
    sizes are (1 less their deviation by their mean), and mean, deviation and range of the folds at the largest size."""
    means, last = [r["mean"] for r in curve], curve[-1]["scores"] or [0.0]
    half, end = len(means) // 2, means[-3:]
    return {
        "improves": fmean(means[half:]) > fmean(means[:half]) if half else False,
        "convergence": 1 - pstdev(end) / (fmean(end) + 1e-10),
        "fold_mean": fmean(last),
        "fold_sd": pstdev(last),
        "fold_min": min(last),
        "fold_max": max(last),
    }


def importances(df: DataFrame, columns: list[str], label: str, seed: int = 42, trees: int = 100, regression: bool = False) -> list[tuple[str, float]]:
    """Features by importance in a forest of either task (O-M09)."""
    if regression:
        first, forest = [SQLTransformer(statement=f"SELECT *, CAST(`{label}` AS double) AS label FROM __THIS__")], RandomForestRegressor(numTrees=trees, seed=seed)
    else:
        first, forest = [StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")], RandomForestClassifier(numTrees=trees, seed=seed)
    model = Pipeline(stages=[*first, VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip"), forest]).fit(_parted(df.select(label, *columns)))
    return sorted(zip(columns, map(float, model.stages[-1].featureImportances.toArray()), strict=True), key=lambda x: (-x[1], x[0]))


def meaningful(ranked: list[tuple[str, float]], expected: set[str], top: int = 3, least: int = 2) -> bool:
    """Whether enough expected features are among the top ones (O-M09, O-U03)."""
    return len({n for n, _ in ranked[:top]} & expected) >= least


#: Features that should matter for a performer's level.
SENSIBLE = {"timing_accuracy", "timing_consistency", "timing_error_mean", "timing_error_std", "velocity_control", "hand_balance", "accent_differentiation", "subdivision_evenness"}


def verdict(accuracy: float, r2: float) -> str:
    """Verdict on a data set's use (O-M10), by the best classifier's accuracy and the best regressor's R squared."""
    if accuracy > 0.7 and r2 > 0.5:
        return "PASSED"
    return "PARTIAL" if accuracy > 0.5 or r2 > 0.3 else "NEEDS REVIEW"


def utility(tier_data: DataFrame, score_data: DataFrame, key: str = "sample_id", tier: str = "skill_tier", score: str = "overall_score", **sizes) -> list[tuple[str, str, float]]:
    """The utility report as rows (part, name, value) (O-M10): both tasks with the metrics of their models, learning curve,
    learnability and importances, then the verdict.  ``sizes`` (``sizes``, ``folds``, ``trees``, ``threads``) makes it smaller."""
    trees = {"trees": sizes["trees"]} if "trees" in sizes else {}
    rows, best, good, learns = [], {}, [], []
    for task, data, columns, label, regression in (("tier", tier_data, list(TIER_FEATURES), tier, False), ("score", score_data, list(SCORE_FEATURES), score, True)):
        models = regress(data, columns, label, key, **trees) if regression else classify(data, columns, label, key, **trees)
        for name, p in models.items():
            found = (regression_metrics if regression else class_metrics)(p).first().asDict()
            rows += [(f"{task} {name}", n, None if v is None else float(v)) for n, v in found.items()]
            best[task] = max(best.get(task, 0.0), found["r2" if regression else "accuracy"] or 0.0)
        curve = learning_curve(data, columns, label, key, regression=regression, **sizes)
        rows += [(f"{task} curve", str(r["size"]), r["mean"]) for r in curve]
        facts = learnability(curve)
        rows += [(f"{task} learnability", n, float(v)) for n, v in facts.items()]
        ranked = importances(data, columns, label, regression=regression, **trees)
        rows += [(f"{task} importance", n, v) for n, v in ranked]
        good.append(meaningful(ranked, SENSIBLE))
        learns.append(facts["improves"])
        rows.append((f"{task} importance", "sensible", float(good[-1])))
    rows += [("summary", "best accuracy", best["tier"]), ("summary", "best r2", best["score"]), ("summary", "all learn", float(all(learns))), ("summary", "all sensible", float(all(good)))]
    return [*rows, ("verdict", verdict(best["tier"], best["score"]), best["tier"])]
