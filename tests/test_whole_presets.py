"""Every query that fits a preset fits it at its whole settings."""

from __future__ import annotations

import uuid

import pytest

from refrain.catalog import learning
from refrain.learning import models


class Asked(Exception):
    pass


#: The queries that fit boosted trees, and the presets they need.
WHOLE = {
    "train_gbt_deep": {"gbt_deep"},
    "train_gbt_leafy": {"gbt_leafy"},
    "train_gbt_shallow": {"gbt_shallow"},
    "importance_gain": {"gbt_deep"},
    "importance_weight": {"gbt_deep"},
    "meta_coefficients": {"gbt_deep", "gbt_leafy"},
    "submission": {"gbt_deep", "gbt_leafy"},
    "stack_features": {"gbt_deep", "gbt_leafy"},
    "train_meta_lr": {"gbt_deep", "gbt_leafy"},
    "model_report": set(models.PRESETS),
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_queries_fit_whole_presets(spark, name, monkeypatch):
    """No query fits with fewer rounds than its preset has."""
    asked = {}
    made = [(i, i % 2, i % 3, "train" if i % 5 else "test", [float(i)]) for i in range(20)]
    rows = spark.createDataFrame(made, "msno int, is_churn int, fold int, part string, raw array<double>")

    def fit(preset, rows, **changes):
        asked[preset] = {**models.PRESETS[preset].settings, **changes}
        raise Asked

    monkeypatch.setattr(learning, "training", lambda *_: (rows, ["x"], {}))
    state = uuid.uuid4().int % 10**9
    monkeypatch.setattr(learning, "input_state", lambda *_: state)
    monkeypatch.setattr(models, "fit", fit)
    with pytest.raises(Asked):
        learning.QUERIES[name](spark, "nowhere")
    assert asked and set(asked) <= WHOLE[name]
    assert all(settings == models.PRESETS[preset].settings for preset, settings in asked.items())
    rounds = {"gbt_deep": 250, "gbt_leafy": 300, "gbt_shallow": 1000}
    assert all(asked[preset]["rounds"] == n for preset, n in rounds.items() if preset in asked)
