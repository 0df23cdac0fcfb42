"""Model bundles: a fitted model with all that scoring raw tables needs, found again by any later session.

A bundle is a folder ``root/name/key/attempt`` with the model and a manifest: feature columns in order, learned
one-hot categories, settings and the state of the input it was fitted on. ``key`` is a digest of input state and
settings, so another input or setting never finds it. The manifest is written last: a folder without a finished one is
no bundle, and is passed over. Sessions that fit the same bundle at the same time write attempts of their own.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from hashlib import md5
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.learning import evaluate, models, prepare
from refrain.plans import features
from refrain.sources.storage import finished_folders

#: Raised when bundles of older code must not be loaded any more.
FORMAT = 1
MODEL, MANIFEST = "model", "manifest"


@dataclass(frozen=True)
class Bundle:
    """A fitted preset, its settings, the columns and categories of its vectors, and the state of its input."""

    name: str
    settings: dict[str, Any]
    columns: list[str]
    categories: dict[str, list[int]]
    source: str
    model: Any


def _folder(root: str, name: str, settings: dict[str, Any], source: str) -> str:
    told = json.dumps({"format": FORMAT, "settings": settings, "source": source}, sort_keys=True)
    return f"{root}/{name}/{md5(told.encode()).hexdigest()}"


def save_bundle(spark: SparkSession, root: str, bundle: Bundle) -> str:
    """Write the bundle under ``root`` and return its folder."""
    folder = f"{_folder(root, bundle.name, bundle.settings, bundle.source)}/{uuid.uuid4().hex}"
    models.save_model(bundle.model, f"{folder}/{MODEL}")
    told = {
        "settings": bundle.settings,
        "columns": bundle.columns,
        "categories": bundle.categories,
        "source": bundle.source,
    }
    manifest = spark.createDataFrame([(json.dumps(told, sort_keys=True),)], "manifest string")
    manifest.coalesce(1).write.text(f"{folder}/{MANIFEST}")
    return folder


def find_bundle(spark: SparkSession, root: str, name: str, settings: dict[str, Any], source: str) -> Bundle | None:
    """The bundle of this preset, these settings and this input, or None where none was finished."""
    folder = _folder(root, name, settings, source)
    whole = finished_folders(spark, folder, MANIFEST)
    if not whole:
        return None
    attempt = f"{folder}/{whole[0]}"
    told = json.loads(spark.read.text(f"{attempt}/{MANIFEST}").first()[0])
    return Bundle(name, **told, model=models.load_model(name, f"{attempt}/{MODEL}"))


def fit_bundle(
    root: str,
    name: str,
    rows: DataFrame,
    columns: list[str],
    categories: dict[str, list[int]],
    source: str,
    **changes: Any,
) -> Bundle:
    """The bundle of a preset, fitted on ``rows`` and saved unless a finished one is there already."""
    spark, settings = rows.sparkSession, {**models.PRESETS[name].settings, **changes}
    found = find_bundle(spark, root, name, settings, source)
    if found is None:
        found = Bundle(name, settings, columns, categories, source, models.fit(name, rows, **changes))
        save_bundle(spark, root, found)
    return found


def score_inputs(bundles: list[Bundle], inputs: features.Inputs, split: str) -> DataFrame:
    """Key, label and one score column per bundle for every label row of a split, from the raw tables.

    Features are built with the categories the models were fitted with. All bundles must share columns and categories.
    """
    first, *rest = bundles
    if any((b.columns, b.categories) != (first.columns, first.categories) for b in rest):
        raise ValueError("bundles were fitted on different feature columns or categories")
    wide = features.final_dataset(inputs, split, first.categories)
    scored = evaluate.with_scores({b.name: b.model for b in bundles}, prepare.assembled(wide, first.columns))
    return scored.select(prepare.KEY, F.col(prepare.LABEL), *[b.name for b in bundles])
