"""The registered model queries fit models of the source's sizes."""

from ledgerwave.operators import ensembles, models
from ledgerwave.plans import catalog


def sizes(estimator):
    """(folds, then trees or iterations of every part) of an estimator, whatever it is made of."""
    if isinstance(estimator, ensembles.Stacking):
        return [("folds", estimator.folds), *[s for part in estimator.bases.values() for s in sizes(part)]]
    if hasattr(estimator, "getStages"):
        return [s for stage in estimator.getStages() for s in sizes(stage)]
    if hasattr(estimator, "getNumTrees"):
        return [("forest", estimator.getNumTrees())]
    if hasattr(estimator, "getStepSize") and hasattr(estimator, "getMaxDepth"):
        return [("boosting", estimator.getMaxIter())]
    if hasattr(estimator, "getLayers"):
        return [("network", estimator.getMaxIter())]
    return []


def given(monkeypatch, query, operator):
    """What a query hands to its operator."""
    seen = []
    monkeypatch.setattr(catalog, "_training_table", lambda spark, folder: (None, Rows()))
    monkeypatch.setattr(models, "scores_frame", lambda spark, winner: None)
    monkeypatch.setattr(models, operator, lambda *args: seen.append(args))
    catalog.QUERIES[query](None, "")
    return seen[0]


class Rows:
    def count(self):
        return 1000


STACK = [("folds", 5), ("boosting", 400), ("forest", 400), ("network", 500)]


def test_stack_has_full_sizes(spark, monkeypatch):
    _, stacking, *rest = given(monkeypatch, "stack", "stack_accuracy")
    assert sizes(stacking) == STACK and not rest


def test_train_winner_has_full_sizes(spark, monkeypatch):
    _, everything, *rest = given(monkeypatch, "train_winner", "train_winner")
    assert not rest and {name: sizes(estimator) for name, estimator in everything.items()} == {
        "GradientBoosting": [("boosting", 400)],
        "RandomForest": [("forest", 400)],
        "MLP": [("network", 500)],
        "LogisticReg": [],
        "Interactions": [("boosting", 400)],
        "Stacking": STACK,
        "InteractionStacking": [("folds", 5), ("boosting", 400), ("forest", 400)],
    }
