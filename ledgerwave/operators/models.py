"""Winner and method models with MLlib; what is made of several is in ``ensembles``.

All rows of a bout share a fold, so a bout is never on both sides of a split.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot
from ledgerwave.operators.cards import confidence, reasoning_text
from ledgerwave.operators.careers import DECISIVE_METHODS, FEATURES, METHOD_FEATURES
from ledgerwave.operators.ensembles import (
    KEPT_OF_A_ROW,
    CrossCalibrated,
    InteractionSelector,
    LogisticPerRow,
    StackedModel,
    Stacking,
    at_once,
    dealt,
    each,
    interaction_names,
    interactions_select,
    probability,
    standardized,
)
from ledgerwave.operators.isotonic import isotonic_map

__all__ = ["interaction_names", "interactions_select", "standardized"]

FOLDS = 5
#: Models whose scores are no probabilities yet: the chosen one is calibrated.
TREE_MODELS = ("GradientBoosting", "RandomForest", "Interactions")


def with_folds(pairs: DataFrame, folds: int = FOLDS) -> DataFrame:
    return dealt(pairs, folds, "fold")


def _assembled(*stages: Estimator, inputs: tuple[str, ...] = FEATURES, scaled: bool = False) -> Pipeline:
    if not scaled:
        return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="features"), *stages])
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
            *stages,
        ]
    )


def gradient_boosting(trees: int, features: str = "features") -> GBTClassifier:
    return GBTClassifier(
        featuresCol=features, maxIter=trees, maxDepth=4, stepSize=0.03, subsamplingRate=0.8, minInstancesPerNode=20,
        seed=42, weightCol="weight",
    )


def logistic(inverse_regularization: float, rows: int) -> LogisticRegression:
    """MLlib averages the loss over rows, so an inverse strength C becomes 1 / (C rows).

    Inputs are taken as they come: the penalty is on the coefficients themselves.
    """
    strength = 1.0 / (inverse_regularization * max(rows, 1))
    return LogisticRegression(regParam=strength, maxIter=1000, standardization=False, weightCol="weight")


def candidates(rows: int, trees: int = 400, epochs: int = 500) -> dict[str, Pipeline]:
    """The winner models that are compared. All but the network, which has no such parameter, take row weights."""
    forest = RandomForestClassifier(numTrees=trees, maxDepth=8, minInstancesPerNode=15, seed=42, weightCol="weight")
    network = MultilayerPerceptronClassifier(layers=[len(FEATURES), 64, 32, 2], maxIter=epochs, seed=42)
    return {
        "GradientBoosting": _assembled(gradient_boosting(trees)),
        "RandomForest": _assembled(forest),
        "MLP": _assembled(network, scaled=True),
        "LogisticReg": _assembled(logistic(0.5, rows), scaled=True),
    }


def composites(trees: int = 400, epochs: int = 500, folds: int = FOLDS) -> dict[str, Estimator]:
    """The winner models made of others: boosting on chosen interactions, and two stacks.

    Each is one estimator, so an outer fold chooses, scales, cross-fits and weighs from its own rows alone.
    """
    forest = RandomForestClassifier(
        featuresCol="selected", numTrees=trees, maxDepth=8, minInstancesPerNode=15, seed=42, weightCol="weight"
    )
    alone = {
        name: estimator for name, estimator in candidates(1, trees, epochs).items() if name != "LogisticReg"
    } | {"LogisticReg": _assembled(LogisticPerRow(0.5), scaled=True)}
    chosen = {
        "boosting": gradient_boosting(trees, "selected"), "forest": forest, "logistic": LogisticPerRow(1.0, "selected"),
    }
    return {
        "Interactions": Pipeline(stages=[InteractionSelector(50), gradient_boosting(trees, "selected")]),
        "Stacking": Stacking(alone, 1.0, folds),
        "InteractionStacking": Pipeline(stages=[InteractionSelector(60), Stacking(chosen, 0.5, folds)]),
    }


def out_of_fold(pairs: DataFrame, estimator: Estimator, folds: int = FOLDS) -> DataFrame:
    """Predictions for every row by a model that has not seen its fold."""

    def one(k: int) -> DataFrame:
        model = estimator.fit(pairs.filter(F.col("fold") != k))
        scored = model.transform(pairs.filter(F.col("fold") == k))
        return scored.select("fight_id", "mirrored", "fold", "label", "prediction", probability().alias("score"))

    return reduce(DataFrame.unionByName, each(one, list(range(folds)), at_once(pairs)))


def fold_accuracy(scored: DataFrame) -> DataFrame:
    """Mean and spread of the accuracy over the folds."""
    right = F.avg(F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0))
    return (
        scored.groupBy("fold")
        .agg(right.alias("accuracy"), F.count("*").alias("rows"))
        .agg(F.avg("accuracy").alias("accuracy"), F.stddev_pop("accuracy").alias("spread"), F.sum("rows").alias("rows"))
    )


def calibrate(scored: DataFrame) -> IsotonicRegressionModel:
    """Isotonic map from out-of-fold score to probability."""
    return isotonic_map(scored)


def reliability(scored: DataFrame, digits: int = 2) -> DataFrame:
    """How often what was given a probability came true: rows and share won by rounded probability."""
    return scored.groupBy(F.round("score", digits).alias("probability")).agg(
        F.count("*").alias("rows"), F.avg("label").alias("share_won")
    )


@dataclass
class WinnerModel:
    """The chosen winner model, calibrated if its scores are no probabilities."""

    name: str
    model: Model
    scores: dict[str, float] = field(default_factory=dict)

    def score(self, frame: DataFrame) -> DataFrame:
        """``frame`` with ``prob_f1``, the probability that the first side wins."""
        return self.model.transform(frame).select(*frame.columns, probability().alias("prob_f1"))


def train_winner(pairs: DataFrame, estimators: dict[str, Estimator], folds: int = FOLDS) -> WinnerModel:
    """Compare the models by accuracy over the folds and fit the best on all rows.

    Any of them may be chosen, also one made of others. ``pairs`` is read once per fit and should be a written table.
    """
    folded = with_folds(pairs, folds)
    scores = {
        name: fold_accuracy(out_of_fold(folded, estimator, folds)).first()["accuracy"]
        for name, estimator in estimators.items()
    }
    best = max(scores, key=lambda name: scores[name])
    deployed = CrossCalibrated(estimators[best], folds) if best in TREE_MODELS else estimators[best]
    return WinnerModel(best, deployed.fit(pairs), scores)


def scores_frame(spark: SparkSession, winner: WinnerModel) -> DataFrame:
    rows = [(name, float(score), name == winner.name) for name, score in winner.scores.items()]
    return spark.createDataFrame(rows, "model string, accuracy double, chosen boolean")


# --- interactions and stacking ---------------------------------------------------------


def interaction_columns(pairs: DataFrame, selected: list[int], features: tuple[str, ...] = FEATURES) -> DataFrame:
    """``pairs`` with the chosen features and products as columns ``x0``, ``x1``, ..."""
    return standardized(pairs, features).withColumns(
        {f"x{i}": F.get("expanded", F.lit(p)) for i, p in enumerate(selected)}
    ).drop("expanded")


def stack(pairs: DataFrame, estimators: dict[str, Estimator], folds: int = FOLDS) -> tuple[StackedModel, DataFrame]:
    """A stack fitted on all rows, and the out-of-fold rows of its base models."""
    stacking = Stacking(estimators, 1.0, folds)
    return stacking.fit(pairs), stacking.out_of_fold(pairs)


def stack_accuracy(pairs: DataFrame, stacking: Stacking, folds: int = FOLDS) -> DataFrame:
    """(fold, model, accuracy, rows): the stack and its base models on bouts of outer folds, none of them seen.

    Each outer fold cross-fits anew inside its own rows; the held-out rows are scored once for all models.
    """
    folded = with_folds(pairs, folds)

    def one(k: int) -> DataFrame:
        model = stacking.fit(folded.filter(F.col("fold") != k))
        return model.transform(folded.filter(F.col("fold") == k)).select(
            "fold", "label", probability().alias("Stacking"), *stacking.bases
        )

    names = ["Stacking", *stacking.bases]
    scored = reduce(DataFrame.unionByName, each(one, list(range(folds)), at_once(pairs)))
    long = scored.select("fold", "label", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(n).alias("score")) for n in names
    ])))
    right = F.avg(((F.col("score") > 0.5).cast("int") == F.col("label")).cast("double"))
    return long.groupBy("fold", "model").agg(right.alias("accuracy"), F.count("*").alias("rows"))


# --- method model ----------------------------------------------------------------------


def _method_label() -> Column:
    label = F.lit(None).cast("double")
    for i, method in enumerate(DECISIVE_METHODS):
        label = F.when(F.col("method") == method, float(i)).otherwise(label)
    return label


def method_rows(pairs: DataFrame) -> DataFrame:
    """One row per bout with the winner's features, and class weights that balance the methods."""
    rows = pairs.filter(~F.col("mirrored")).select(
        "fight_id",
        "method",
        _method_label().alias("label"),
        *[F.col(f"winner_{f}").alias(f) for f in METHOD_FEATURES],
    )
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    weights = counts.select("label", (total / (classes * F.col("n"))).cast("double").alias("weight"))
    return rows.join(F.broadcast(weights), "label")  # one row per method


def train_method(pairs: DataFrame, trees: int = 200) -> PipelineModel:
    """How a bout is won, from the winner's features."""
    forest = RandomForestClassifier(numTrees=trees, maxDepth=5, weightCol="weight", seed=42)
    return _assembled(forest, inputs=METHOD_FEATURES).fit(method_rows(pairs))


def method_confusion(pairs: DataFrame, trees: int = 200, folds: int = FOLDS) -> DataFrame:
    """(fold, method, predicted_method, bouts) for bouts that the model has not seen."""
    folded = with_folds(pairs, folds)

    def one(k: int) -> DataFrame:
        model = train_method(folded.filter(F.col("fold") != k), trees)
        unseen = method_rows(folded.filter(F.col("fold") == k)).drop("label", "weight")
        return predict_method(model, unseen).withColumn("fold", F.lit(k))

    # A forest keeps a number for every row and tree.
    most = at_once(pairs.filter(~F.col("mirrored")), KEPT_OF_A_ROW + 4 * trees)
    every = reduce(DataFrame.unionByName, each(one, list(range(folds)), most))
    return every.groupBy("fold", "method", "predicted_method").agg(F.count("*").alias("bouts"))


def predict_method(model: Model, frame: DataFrame) -> DataFrame:
    kept = frame.columns
    names = F.array(*[F.lit(m) for m in DECISIVE_METHODS])
    return model.transform(frame).select(*kept, F.get(names, F.col("prediction").cast("int")).alias("predicted_method"))


# --- predictions -----------------------------------------------------------------------


def predict_card(
    card: DataFrame, profiles: DataFrame, winner: WinnerModel, method: Model, circuit: str = "UFC"
) -> DataFrame:
    """Pick, method, confidence and reasoning per bout; a bout without enough history says so."""
    fields = [c for c in profiles.columns if c not in ("fighter_url", "event_date")]

    def side(n: int) -> DataFrame:
        return profiles.select(F.col("fighter_url").alias(f"fighter{n}_url"), F.struct(*fields).alias(f"p{n}"))

    bouts = join_hot(join_hot(card, side(1), ["fighter1_url"]), side(2), ["fighter2_url"], spread=card.columns)
    known = F.col("p1").isNotNull() & F.col("p2").isNotNull()
    differences = bouts.filter(known).withColumns({f: F.col(f"p1.{f}") - F.col(f"p2.{f}") for f in FEATURES})

    first = F.col("prob_f1") >= 0.5
    picked = winner.score(differences).drop(*FEATURES).withColumns(
        {
            "pick": F.when(first, F.col("fighter1")).otherwise(F.col("fighter2")),
            "w": F.when(first, F.col("p1")).otherwise(F.col("p2")),
            "l": F.when(first, F.col("p2")).otherwise(F.col("p1")),
            "prob": F.when(first, F.col("prob_f1")).otherwise(1.0 - F.col("prob_f1")),
        }
    ).withColumns({f: F.col(f"w.{f}") for f in METHOD_FEATURES})
    predicted = predict_method(method, picked).select(
        "fighter1",
        "fighter2",
        "pick",
        F.col("predicted_method").alias("method"),
        confidence(F.col("prob")).alias("confidence"),
        reasoning_text(F.col("w"), F.col("l"), F.col("pick"), F.col("predicted_method"), F.col("prob")).alias(
            "reasoning"
        ),
    )
    missing = F.when(F.col("p1").isNull(), F.col("fighter1")).otherwise(F.col("fighter2"))
    unknown = bouts.filter(~known).select(
        "fighter1",
        "fighter2",
        F.lit("Insufficient data").alias("pick"),
        F.lit("N/A").alias("method"),
        F.lit("Low").alias("confidence"),
        F.concat(missing, F.lit(f" has insufficient {circuit} history.")).alias("reasoning"),
    )
    return predicted.unionByName(unknown).withColumns(
        {"result": F.lit("pending"), "actual_method": F.lit(None).cast("string")}
    )


# --- saved models ------------------------------------------------------------------------


def save_models(spark: SparkSession, folder: str, winner: WinnerModel, method: PipelineModel) -> None:
    """Both models and what is known about them."""
    winner.model.write().overwrite().save(f"{folder}/winner")
    method.write().overwrite().save(f"{folder}/method")
    spark.createDataFrame(
        [(winner.name, winner.scores, list(FEATURES), list(METHOD_FEATURES), 2)],
        "name string, scores map<string,double>, features array<string>, method_features array<string>, version int",
    ).write.mode("overwrite").json(f"{folder}/metadata")


def load_models(spark: SparkSession, folder: str) -> tuple[WinnerModel, PipelineModel]:
    """What ``save_models`` wrote."""
    known = spark.read.schema("name string, scores map<string,double>").json(f"{folder}/metadata").first()
    model = DefaultParamsReader.loadParamsInstance(f"{folder}/winner", spark)
    return WinnerModel(known["name"], model, dict(known["scores"])), PipelineModel.load(f"{folder}/method")


def round_trips(spark: SparkSession, folder: str, rows: DataFrame, fitted: dict[str, Model]) -> DataFrame:
    """(model, rows, changed): the models saved and loaded again, with how many probabilities differ from before."""

    def one(name: str) -> DataFrame:
        path = f"{folder}/{name}"
        fitted[name].write().overwrite().save(path)
        loaded = DefaultParamsReader.loadParamsInstance(path, spark)
        before = fitted[name].transform(rows).select(*rows.columns, probability().alias("before"))
        both = loaded.transform(before).select("before", probability().alias("after"))
        return both.agg(
            F.lit(name).alias("model"),
            F.count("*").alias("rows"),
            F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("changed"),
        )

    return reduce(DataFrame.unionByName, map(one, fitted))
