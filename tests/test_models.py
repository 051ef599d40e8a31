"""Models: folds, separable data, calibration, saving and predictions."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerwave.operators import models
from ledgerwave.operators.careers import DECISIVE_METHODS, FEATURES, METHOD_FEATURES


@pytest.fixture(scope="module")
def training(spark):
    """Bouts the stronger striker wins, each with its mirror image; the method shows in the takedowns."""
    rng = random.Random(3)
    rows = []
    for i in range(240):
        values = {f: rng.gauss(0, 1) for f in FEATURES}
        label, kind = int(values["sig_spm"] > 0), i % 3
        winner = {f: (kind * 3 + rng.gauss(0, 0.2)) if f == "td_per_fight" else rng.random() for f in METHOD_FEATURES}
        for mirrored in (False, True):
            sign = -1 if mirrored else 1
            rows.append(
                (f"b{i}", mirrored, *[sign * values[f] for f in FEATURES], 1 - label if mirrored else label,
                 DECISIVE_METHODS[kind], *[winner[f] for f in METHOD_FEATURES])
            )
    schema = (
        "fight_id string, mirrored boolean, " + ", ".join(f"{f} double" for f in FEATURES)
        + ", label int, method string, " + ", ".join(f"winner_{f} double" for f in METHOD_FEATURES)
    )
    return spark.createDataFrame(rows, schema).withColumn("weight", F.lit(1.0)).repartition(2).cache()


def test_mirrored_rows_share_a_fold(training):
    folds = models.with_folds(training).groupBy("fight_id").agg(F.count_distinct("fold").alias("n"))
    assert folds.filter("n <> 1").count() == 0


@pytest.fixture(scope="module")
def winner(training):
    chosen = {k: v for k, v in models.candidates(480, 4, 20).items() if k in ("RandomForest", "LogisticReg")}
    return models.train_winner(training, chosen)


def test_winner_model_beats_a_coin(winner):
    assert set(winner.scores) == {"RandomForest", "LogisticReg"}
    assert winner.scores[winner.name] == max(winner.scores.values()) > 0.85


def test_out_of_fold_covers_every_row_once(training):
    forest = models.candidates(480, 3)["RandomForest"]
    scored = models.out_of_fold(models.with_folds(training), forest)
    assert scored.count() == scored.select("fight_id", "mirrored").distinct().count() == 480
    curve = models.calibrate(scored).transform(scored).select("score", "calibrated").distinct().orderBy("score")
    values = [r.calibrated for r in curve.collect()]
    assert values == sorted(values) and 0 <= values[0] and values[-1] <= 1


def test_interactions_find_the_feature_that_decides(training):
    rows = models.interactions_select(training, k=5).collect()
    assert rows[0].feature == "sig_spm" and len(rows) == 5
    assert len(models.interaction_names()) == 465
    named = models.interaction_columns(training, [r.position for r in rows]).first()
    assert named.x0 == pytest.approx(models.standardized(training).first().expanded[rows[0].position], abs=5)


def test_products_stand_where_their_names_say(training):
    row = models.standardized(training).first().expanded
    names = models.interaction_names()
    for name in ("sig_spm*sig_acc", "win_streak*log_fights", "td_acc*win_rate"):
        a, b = name.split("*")
        assert row[names.index(name)] == pytest.approx(row[names.index(a)] * row[names.index(b)])


def test_stack(training):
    chosen = {k: v for k, v in models.candidates(480, 3).items() if k in ("RandomForest", "LogisticReg")}
    model, unseen = models.stack(training, chosen, folds=3)
    assert unseen.count() == 480
    scored = model.transform(training)
    right = scored.filter("prediction = label").count()
    assert right > 400 and "probability" in scored.columns


def test_method_classes_weigh_the_same(training):
    rows = models.method_rows(training.filter("method <> 'Decision' or fight_id like 'b1%'"))
    totals = [r.s for r in rows.groupBy("label").agg(F.sum("weight").alias("s")).collect()]
    assert len(totals) == 3 and max(totals) == pytest.approx(min(totals))


def test_saved_models_predict_the_same_card(spark, training, winner, tmp_path):
    method = models.train_method(training, 10)
    models.save_models(spark, str(tmp_path), winner, method)
    winner2, method2 = models.load_models(spark, str(tmp_path))
    assert (winner2.name, winner2.scores) == (winner.name, winner.scores)

    fields = list(dict.fromkeys([*FEATURES, "opp_accuracy_against"]))
    people = [("u1", 2.0), ("u2", -2.0)]
    profiles = spark.createDataFrame(
        [(u, 5, *[v if f == "sig_spm" else 0.5 for f in fields]) for u, v in people],
        "fighter_url string, fights long, " + ", ".join(f"{f} double" for f in fields),
    ).withColumn("event_date", F.lit("2099-01-01").cast("date"))
    card = spark.createDataFrame(
        [("u2", "u1", "Two", "One"), ("u1", "u9", "One", "Nine")],
        "fighter1_url string, fighter2_url string, fighter1 string, fighter2 string",
    )
    first = sorted(map(tuple, models.predict_card(card, profiles, winner, method).collect()), key=str)
    again = sorted(map(tuple, models.predict_card(card, profiles, winner2, method2).collect()), key=str)
    assert first == again
    by_bout = {(r[0], r[1]): r for r in first}
    assert by_bout[("Two", "One")][2] == "One"
    assert by_bout[("One", "Nine")][2:6] == ("Insufficient data", "N/A", "Low", "Nine has insufficient UFC history.")
