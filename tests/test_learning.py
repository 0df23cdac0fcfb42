"""Planted signal, repeatability, saved models, and metrics against MLlib's own."""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from refrain.learning import evaluate, models, prepare
from refrain.learning.boosting import weighted_cuts
from refrain.operators import onehot
from refrain.sources.storage import fresh_path, shared_dir


@pytest.fixture(scope="module")
def planted(spark):
    """A label that follows the first of three features, with a tenth of the rows flipped."""
    rows = spark.range(2000).select(
        F.col("id").cast("string").alias("msno"),
        *[prepare.hash_share(F.col("id"), f"x{i}").alias(f"x{i}") for i in range(3)],
        (prepare.hash_share(F.col("id"), "flip") < 0.1).alias("flip"),
    )
    label = ((F.col("x0") > 0.6) != F.col("flip")).cast("int").alias("is_churn")
    labelled = rows.select("msno", label, array_to_vector(F.array("x0", "x1", "x2")).alias("features"))
    parted = prepare.with_folds(prepare.stratified_split(labelled))
    table = prepare.with_class_weights(parted).persist()
    yield table.filter("part = 'train'"), table.filter("part = 'test'")
    table.unpersist()


def auc(scored, name):
    return evaluate.report(scored, {name: F.col(name)}).first().auc


#: Fewer trees and rounds than the presets have, for the time that tests take.
SMALL = {
    "adaboost": {"rounds": 3},
    "random_forest": {"numTrees": 5, "maxDepth": 6},
    "decision_tree": {},
    "gbt_deep": {"rounds": 2, "depth": 5},
    "gbt_leafy": {"rounds": 2, "leaves": 9},
    "gbt_shallow": {"rounds": 3, "depth": 3},
}


@pytest.mark.parametrize("name", sorted(models.PRESETS))
def test_models_find_the_signal_and_survive_saving(spark, planted, name):
    train, test = planted
    model = models.fit(name, train, **SMALL[name])
    path = fresh_path(spark, name)
    models.save_model(model, path)
    both = evaluate.with_scores({"before": model, "after": models.load_model(name, path)}, test)
    assert both.filter("before <> after").count() == 0
    assert auc(both, "before") > 0.8


def test_same_seed_same_model(planted):
    train, test = planted
    pair = {n: models.fit("random_forest", train, **SMALL["random_forest"]) for n in ("one", "two")}
    assert evaluate.with_scores(pair, test).filter("one <> two").count() == 0


def test_auc_equals_the_evaluator(planted):
    train, test = planted
    model = models.fit("gbt_leafy", train, **SMALL["gbt_leafy"])
    evaluator = BinaryClassificationEvaluator(labelCol="is_churn", rawPredictionCol="probability", numBins=0)
    expected = evaluator.evaluate(model.transform(test))
    assert auc(evaluate.with_scores({"p": model}, test), "p") == pytest.approx(expected, abs=1e-9)


def test_boosting_beats_one_stump_and_checkpoints(spark, planted):
    train, test = planted
    model = models.fit("adaboost", train, rounds=12, learning_rate=1.0)
    assert 1 <= len(model.stumps) <= 12 and len(model.votes) == len(model.stumps)
    assert shared_dir(spark) in spark.sparkContext.getCheckpointDir()
    assert model.featureImportances[0] == max(model.featureImportances)


def test_boosting_weights_follow_the_rule(spark):
    """Two rounds by hand: the first stump errs on d alone, whose weight is then half of the total."""
    rows = spark.createDataFrame(
        [("a", 0.1, 0), ("b", 0.2, 0), ("c", 0.8, 1), ("d", 0.9, 0), ("e", 0.95, 1)], "msno string, x double, is_churn int"
    ).select("msno", "is_churn", F.lit(1.0).alias("weight"), array_to_vector(F.array("x")).alias("features"))
    model = models.fit("adaboost", rows, rounds=2, learning_rate=1.0)
    assert model.votes[0] == pytest.approx(1.3862943611)  # ln((1 - 1/5) / (1/5))
    # Weights are now 1/8 but 1/2 for d. Cutting between d and e errs on c alone, with weight 1/8.
    second = model.stumps[1]
    assert 0.9 <= second.threshold < 0.95 and (second.low, second.high) == (0.0, 1.0)
    assert model.votes[1] == pytest.approx(1.9459101091)  # ln((1 - 1/8) / (1/8))
    scored = model.transform(rows).select("msno", "prediction").collect()
    assert {r.msno: r.prediction for r in scored} == {"a": 0, "b": 0, "c": 0, "d": 0, "e": 1}


def mllib_stumps(rows, rounds, rate):
    """(feature, threshold) and vote of each round by a depth-1 tree of MLlib on the row weights of the round."""
    out, state = [], rows.select("features", "is_churn", F.col("weight").cast("double").alias("weight"))
    for _ in range(rounds):
        fitted = DecisionTreeClassifier(maxDepth=1, labelCol="is_churn", weightCol="weight", seed=42).fit(state)
        split = re.search(r"If \(feature (\d+) <= (\S+)\)", fitted.toDebugString)
        wrong = fitted.transform(state).select(*state.columns, (F.col("prediction") != F.col("is_churn")).alias("wrong"))
        lost, total = wrong.agg(F.sum(F.when(F.col("wrong"), F.col("weight")).otherwise(0.0)), F.sum("weight")).first()
        vote = rate * math.log((total - lost) / lost)
        out.append((int(split[1]), float(split[2]), vote) if split else (0, 0.0, vote))
        grown = total + lost * (math.exp(vote) - 1)
        factor = F.when(F.col("wrong"), math.exp(vote)).otherwise(1.0) / grown
        state = wrong.select("features", "is_churn", (F.col("weight") * factor).alias("weight"))
    return out


def test_boosted_stumps_are_those_of_mllib(spark, planted):
    """The same cuts from the same row weights, round by round, though the table is coded only once."""
    train, _ = planted
    model = models.fit("adaboost", train, rounds=6, learning_rate=0.1)
    for (feature, threshold, vote), stump, got in zip(mllib_stumps(train, 6, 0.1), model.stumps, model.votes, strict=True):
        assert (stump.feature, stump.threshold) == (feature, pytest.approx(threshold, abs=1e-12))
        assert got == pytest.approx(vote, rel=1e-9)


def test_a_boosting_round_is_one_pass(spark, planted):
    """Four more rounds of stumps are four more passes, of two jobs each at most (the sums, and the cuts)."""
    train, _ = planted
    jobs = []
    for rounds in (2, 6):
        group = f"rounds-{rounds}-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, "boosting rounds")
        assert len(models.fit("adaboost", train, rounds=rounds, learning_rate=0.1).stumps) == rounds
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 4 <= jobs[1] - jobs[0] <= 8


def test_the_forest_keeps_each_rows_nodes(spark, planted):
    """Rows keep their node of every tree between levels, checkpointed in the shared folder; the trees stay the same."""
    train, test = planted
    assert models.PRESETS["random_forest"].build().getCacheNodeIds()
    forests = {n: models.fit("random_forest", train, numTrees=4, maxDepth=12, cacheNodeIds=n == "kept") for n in ("kept", "walked")}
    assert evaluate.with_scores(forests, test).filter("kept <> walked").count() == 0


def test_cuts_part_the_weights_evenly():
    values, counts = np.arange(10.0), np.array([1, 1, 1, 1, 6, 1, 1, 1, 1, 1.0])
    assert weighted_cuts(values, counts, 15.0, 20).tolist() == [i + 0.5 for i in range(9)]
    assert weighted_cuts(values, counts, 15.0, 2).tolist() == [3.5, 4.5]
    assert weighted_cuts(values[:1], counts[:1], 1.0, 31).tolist() == []


def test_split_is_disjoint_stable_and_stratified(spark):
    df = spark.range(20000).select(F.col("id").alias("msno"), (F.col("id") % 10 == 0).cast("int").alias("is_churn"))
    split = prepare.stratified_split(df)
    shares = split.groupBy("is_churn").agg(F.avg((F.col("part") == "test").cast("int")).alias("s")).collect()
    assert {r.is_churn: round(r.s, 9) for r in shares} == {0: 0.2, 1: 0.2}
    again = prepare.stratified_split(df.repartition(5))
    assert split.exceptAll(again).count() == 0


def test_grid_search_uses_folds(planted):
    train, _ = planted
    found = models.grid_search("decision_tree", train, {"maxDepth": [1, 4]})
    assert len(found.metrics) == 2 and found.model.depth <= 4


def test_grid_search_takes_boosted_stumps(planted):
    train, _ = planted
    found = models.grid_search("adaboost", train, {"rounds": [1, 2], "learning_rate": [0.5]})
    assert found.settings == [{"rounds": 1, "learning_rate": 0.5}, {"rounds": 2, "learning_rate": 0.5}]
    assert found.metrics[found.settings.index(found.best)] == max(found.metrics) > 0.8


def test_grid_search_gives_the_same_best_setting_at_any_width(planted):
    """One and three fits at a time, over settings of a boosted tree preset."""
    train, _ = planted
    grid = {"leaves": [2, 5], "rounds": [1]}
    one, three = (models.grid_search("gbt_leafy", train, grid, at_once=n) for n in (1, 3))
    assert one.metrics == three.metrics and one.best == three.best
    assert all(len(t.leaves()) == one.best["leaves"] for t in three.model.trees)


def test_presets_have_the_settings_under_comparison():
    whole = {n: p.build() for n, p in models.PRESETS.items()}
    assert whole["adaboost"].rounds == 100 and whole["random_forest"].getNumTrees() == 200
    assert (whole["gbt_deep"].rounds, whole["gbt_deep"].depth, whole["gbt_deep"].column_share) == (250, 30, 0.7)
    assert (whole["gbt_leafy"].rounds, whole["gbt_leafy"].leaves) == (300, 127)
    assert (whole["gbt_shallow"].rounds, whole["gbt_shallow"].depth, whole["gbt_shallow"].l2) == (1000, 6, 3.0)


def test_out_of_fold_scores_cover_every_row_once(planted):
    train, _ = planted
    scored = evaluate.out_of_fold_scores(["decision_tree"], train, prepare.FOLDS)
    assert scored.count() == scored.select("msno").distinct().count() == train.count()
    meta = models.fit_meta(evaluate.stacked(scored, ["decision_tree"]))
    assert meta.coefficients[0] > 0


def test_log_loss_is_clipped(spark):
    long = spark.createDataFrame([("m", 0.0, 1), ("m", 1.0, 1)], "model string, score double, is_churn int")
    assert evaluate.log_loss(long).first().log_loss == pytest.approx(36.0436533891 / 2)


def test_importances_name_the_signal(spark, planted):
    train, _ = planted
    model = models.fit("gbt_shallow", train, **SMALL["gbt_shallow"])
    names = ["x0", "x1", "x2"]
    assert evaluate.gain_importance(model, names, spark).first().feature == "x0"
    by_split = evaluate.split_importance(model, names, spark).collect()
    assert by_split[0].splits >= 1 and {r.feature for r in by_split} <= set(names)


def test_unknown_model_is_refused(planted):
    with pytest.raises(ValueError):
        models.fit("oracle", planted[0])


def test_sparse_one_hot_reaches_the_fit(spark):
    """6,000 categories, of which every third one churns: only the one-hot block can tell."""
    rows = spark.range(24_000).select(
        F.col("id").alias("msno"),
        (F.col("id") % 6000 * 7).alias("code"),
        F.lit(1.0).alias("constant"),
        (F.col("id") % 3 == 0).cast("int").alias("is_churn"),
    )
    index = onehot.category_index(rows, ["code"])
    places = {r.value: r["index"] for r in index.collect()}
    assert [places[float(v * 7)] for v in (0, 1, 5999)] == [0, 1, 5999]
    training = prepare.assembled(onehot.one_hot_sparse(rows, index, ["code"]), ["constant"], ["code_vector"])
    first = training.filter("msno = 7").first()
    assert first.features.size == 6001 and list(first.features.indices) == [0, 8] and first.raw.size == 1
    model = LogisticRegression(labelCol="is_churn", maxIter=5).fit(training)
    right = model.transform(training).filter("prediction = is_churn").count()
    assert right == 24_000


def test_sparse_one_hot_of_unknown_and_null_codes(spark):
    known = spark.createDataFrame([(1,), (5,), (5,)], "code int")
    other = spark.createDataFrame([(5, "a"), (9, "b"), (None, "c")], "code int, name string")
    out = onehot.one_hot_sparse(other, onehot.category_index(known, ["code"]), ["code"])
    got = {r.name: (r.code, list(r.code_vector.toArray())) for r in out.collect()}
    assert out.columns == ["code", "name", "code_vector"]
    assert got == {"a": (5, [0.0, 1.0]), "b": (9, [0.0, 0.0]), "c": (None, [0.0, 0.0])}


def test_sparse_one_hot_keeps_no_attribute_per_category(spark):
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("code"))
    index = onehot.category_index(rows, ["code"])
    out = onehot.one_hot_sparse(rows, index, ["code"])
    assert out.schema["code_vector"].metadata == {"ml_attr": {"num_attrs": 2_000}}
    assert {r.code_vector.size for r in out.collect()} == {2_000}
    sums = onehot.vector_sums(out.union(out), ["code_vector"])
    assert sums.agg(F.count("*"), F.min("total"), F.max("total"), F.max("index")).first() == (2_000, 2.0, 2.0, 1_999)


def test_sums_of_sparse_vectors_of_a_wide_merged_index(spark, monkeypatch):
    monkeypatch.setattr(onehot, "WIDE", 1)
    rows = spark.createDataFrame([(5, 1), (5, None), (9, 2), (None, 2)], "a int, b int")
    out = onehot.one_hot_sparse(rows, onehot.category_index(rows, ["a", "b"]), ["a", "b"])
    got = sorted(tuple(r) for r in onehot.vector_sums(out, ["a_vector", "b_vector"]).collect())
    assert got == [("a_vector", 0, 2.0), ("a_vector", 1, 1.0), ("b_vector", 0, 1.0), ("b_vector", 1, 2.0)]


def test_report_fits_side_by_side_and_as_alone(spark, folder, monkeypatch):
    """Fits overlap, each preset is fitted once, and a model comes under its own name."""
    import threading

    from refrain.catalog import learning

    at_once, most, lock, met = [], [], threading.Lock(), threading.Barrier(2, timeout=60)

    def fit(session, where, name):
        with lock:
            at_once.append(name)
            most.append(len(at_once))
        if name in learning.LONGEST_FIRST[:2]:
            met.wait()
        # A model's nodes are tables, which a thread without a session of its own could not make.
        assert type(session).active() is not None
        with lock:
            at_once.remove(name)
        return f"model of {name}"

    monkeypatch.setattr(learning, "training", lambda *_: None)
    monkeypatch.setattr(learning, "trained", fit)
    found = learning.all_trained(spark, folder)
    assert found == {name: f"model of {name}" for name in models.PRESETS} and list(found) == list(models.PRESETS)
    assert max(most) >= 2


def test_shuffle_setting_survives_stages_written_at_the_same_time(spark):
    from refrain.sources import storage

    before = spark.conf.get(storage.SHUFFLE_CLEANUP, "false")
    first, second = storage.shuffles_removed(spark), storage.shuffles_removed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(storage.SHUFFLE_CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(storage.SHUFFLE_CLEANUP) == before
