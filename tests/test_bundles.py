"""Bundles: fitted in one process and scored in another; unfinished ones are passed over."""

from __future__ import annotations

import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest

from refrain.catalog.common import inputs
from refrain.learning import bundles, models, prepare
from refrain.plans import features

ROOT = Path(__file__).resolve().parents[1]
NAMES = {"decision_tree": {"maxDepth": 3}, "gbt_shallow": {"rounds": 2, "depth": 3}}

OTHER_PROCESS = """
import sys
from refrain.catalog.common import inputs
from refrain.learning import bundles, models
from refrain.session import build_session

root, folder, out, changes = sys.argv[1], sys.argv[2], sys.argv[3], eval(sys.argv[4])
spark = build_session("later", "local[2]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"})
found = [
    bundles.find_bundle(spark, root, n, {**models.PRESETS[n].settings, **c}, "made here") for n, c in changes.items()
]
bundles.score_inputs(found, inputs(spark, folder), "test").write.parquet(out)
spark.stop()
"""


@pytest.fixture(scope="module")
def made(spark, small_folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bundles"))
    tables = inputs(spark, small_folder)
    categories = features.learn_categories(tables, "train")
    final = features.final_dataset(tables, "train", categories)
    columns = features.feature_columns(final)
    rows = prepare.staged_training_rows(final, columns)
    return root, {n: bundles.fit_bundle(root, n, rows, columns, categories, "made here", **c) for n, c in NAMES.items()}


def find(spark, root, name, source="made here", **changes):
    return bundles.find_bundle(spark, root, name, {**models.PRESETS[name].settings, **changes}, source)


def test_another_process_finds_the_bundles_and_gives_the_same_scores(spark, small_folder, made, tmp_path):
    root, fitted = made
    here = bundles.score_inputs(list(fitted.values()), inputs(spark, small_folder), "test")
    out = str(tmp_path / "scores")
    run = [sys.executable, "-c", OTHER_PROCESS, root, small_folder, out, repr(NAMES)]
    subprocess.run(run, cwd=ROOT, check=True, capture_output=True, timeout=300)
    there = spark.read.parquet(out)
    assert here.count() == there.count() > 0
    assert here.exceptAll(there).count() == 0


def test_a_bundle_comes_back_whole(spark, made):
    root, fitted = made
    for name, changes in NAMES.items():
        back = find(spark, root, name, **changes)
        assert replace(back, model=None) == replace(fitted[name], model=None)


def test_other_input_or_settings_find_nothing(spark, made):
    root, _ = made
    assert find(spark, root, "decision_tree", maxDepth=4) is None
    assert find(spark, root, "decision_tree", source="other files", maxDepth=3) is None
    assert find(spark, root, "random_forest") is None


def test_an_unfinished_bundle_is_passed_over(spark, made, tmp_path):
    _, fitted = made
    half = Path(bundles.save_bundle(spark, str(tmp_path), fitted["decision_tree"]))
    (half / "manifest" / "_SUCCESS").unlink()
    assert find(spark, str(tmp_path), "decision_tree", maxDepth=3) is None
    bundles.save_bundle(spark, str(tmp_path), fitted["decision_tree"])
    assert find(spark, str(tmp_path), "decision_tree", maxDepth=3) is not None


def test_a_finished_bundle_is_not_fitted_again(spark, made, monkeypatch):
    root, fitted = made
    monkeypatch.setattr(models, "fit", lambda *a, **k: pytest.fail("fitted again"))
    one = fitted["decision_tree"]
    rows = spark.createDataFrame([(1,)], "x int")
    again = bundles.fit_bundle(root, one.name, rows, one.columns, one.categories, one.source, maxDepth=3)
    assert again.columns == one.columns


def test_bundles_of_different_columns_do_not_score_together(spark, made, small_folder):
    pair = list(made[1].values())
    with pytest.raises(ValueError):
        bundles.score_inputs([pair[0], replace(pair[1], columns=["bd"])], inputs(spark, small_folder), "test")
