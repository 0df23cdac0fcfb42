"""Catalog: splits, weights, metrics and blends, and the trained models.

Training queries share one staged training table per session, and one saved bundle of each preset per state of the
input files: a model is fitted when it is first asked for and loaded afterwards, by later sessions too if they share
the checkpoint folder. All presets are fitted at their whole settings.
"""

from __future__ import annotations

import threading
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.catalog.common import (
    ONE_HOT_DOMAIN,
    Query,
    final_steps,
    inputs,
    pivot_columns,
    rounded,
    rounded_columns,
    settle,
    total_columns,
    with_steps,
)
from refrain.catalog.features import TX_DOUBLES, TX_OTHERS
from refrain.functions.columns import hash_share
from refrain.learning import bundles, evaluate, models, prepare
from refrain.operators import joins
from refrain.plans import features
from refrain.sources import files, retail, schemas
from refrain.sources.storage import fresh_path, shared_dir, stage_table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS = retail.DUCKDB_VIEWS
_staged: dict[tuple, tuple | DataFrame] = {}
_staging = threading.Lock()
#: Tables that the training rows derive from.
SOURCES = ("customer", "orders", "lineitem", "events")


def query(name: str, sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def _share_sql(seed: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || CAST(msno AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


# Splits and weights


@query(
    "stratified_split",
    with_steps(
        {"train": VIEWS["train"]},
        f"""
SELECT msno, is_churn, CASE WHEN share < cut THEN 'test' ELSE 'train' END AS part
FROM (SELECT *, {_share_sql('42')} AS share FROM train)
JOIN (SELECT is_churn, quantile_cont({_share_sql('42')}, 0.2) AS cut FROM train GROUP BY is_churn) USING (is_churn)""",
    ),
)
def stratified_split(spark, folder):
    return prepare.stratified_split(retail.labels(spark, folder)["train"])


@query(
    "class_weights",
    with_steps(
        {"train": VIEWS["train"]},
        f"""
SELECT msno, is_churn, {rounded('total / (classes * n)')} AS weight
FROM train JOIN (SELECT is_churn, count(*) AS n FROM train GROUP BY is_churn) USING (is_churn)
CROSS JOIN (SELECT count(*) AS total, count(DISTINCT is_churn) AS classes FROM train)""",
    ),
)
def class_weights(spark, folder):
    return settle(prepare.with_class_weights(retail.labels(spark, folder)["train"]))


# Metrics and blends over six closed-form scores: balance and key hash, squeezed into (0, 1)

SCORES = list(models.PRESETS)


def _closed_form(spark, folder) -> DataFrame:
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    balance = customer.select(F.col("c_custkey").alias("msno"), F.col("c_acctbal").alias("balance"))
    rows = retail.labels(spark, folder)["train"].join(balance, "msno")
    trend = 1 / (1 + F.exp(F.col("balance") / 1e3))
    return rows.select(
        "msno",
        "is_churn",
        *[
            F.round(0.05 + 0.1 * (i + 1) * trend + 0.25 * hash_share(F.col("msno"), f"score-{i}"), 4).alias(s)
            for i, s in enumerate(SCORES)
        ],
    )


SCORE_STEPS = {
    "train": VIEWS["train"],
    "scored": "SELECT msno, is_churn, "
    + ", ".join(
        f"round(0.05::DOUBLE + {0.1 * (i + 1)!r}::DOUBLE * (1 / (1 + exp(c_acctbal / 1e3)))"
        f" + 0.25::DOUBLE * {_share_sql(f'score-{i}')}, 4) AS {s}"
        for i, s in enumerate(SCORES)
    )
    + " FROM train JOIN customer ON msno = c_custkey",
}


def _long_sql(pairs: bool) -> str:
    cells = [(s, s) for s in SCORES]
    if pairs:
        cells += [(f"{a}-{b}", f"({a} + {b}) / 2") for i, a in enumerate(SCORES) for b in SCORES[i + 1 :]]
    return " UNION ALL ".join(f"SELECT '{n}' AS model, {e} AS score, is_churn FROM scored" for n, e in cells)


METRIC_STEPS = {
    "losses": """
SELECT model, avg(-CASE WHEN is_churn = 1 THEN ln(score) ELSE ln(1 - score) END) AS log_loss
FROM long_scores GROUP BY model""",
    "placed": """
SELECT model, is_churn, rank() OVER (PARTITION BY model ORDER BY round(score, 9)) AS low,
       count(*) OVER (PARTITION BY model, round(score, 9)) AS tied FROM long_scores""",
    "aucs": """
SELECT model, (sum(CASE WHEN is_churn = 1 THEN low + (tied - 1) / 2.0 END)
               - sum(is_churn)::DOUBLE * (sum(is_churn) + 1) / 2)
              / (sum(is_churn)::DOUBLE * (count(*) - sum(is_churn))) AS auc
FROM placed GROUP BY model""",
}


@query(
    "blend_average",
    with_steps(SCORE_STEPS, f"SELECT msno, {rounded('(gbt_deep + gbt_leafy) / 2')} AS score FROM scored"),
)
def blend_average(spark, folder):
    scored = _closed_form(spark, folder)
    return settle(scored.select("msno", evaluate.blend("gbt_deep", "gbt_leafy").alias("score")))


@query(
    "log_loss",
    with_steps(
        {**SCORE_STEPS, "long_scores": _long_sql(False), "losses": METRIC_STEPS["losses"]},
        f"SELECT model, {rounded_columns(['log_loss'])} FROM losses",
    ),
)
def log_loss(spark, folder):
    long = evaluate.long_scores(_closed_form(spark, folder), {s: F.col(s) for s in SCORES})
    return settle(evaluate.log_loss(long))


@query(
    "roc_auc",
    with_steps(
        {**SCORE_STEPS, "long_scores": _long_sql(False), **METRIC_STEPS},
        f"SELECT model, {rounded_columns(['auc'])} FROM aucs",
    ),
)
def roc_auc(spark, folder):
    long = evaluate.long_scores(_closed_form(spark, folder), {s: F.col(s) for s in SCORES})
    return settle(evaluate.auc_by_model(long))


@query(
    "pairwise_blends",
    with_steps(
        {**SCORE_STEPS, "long_scores": _long_sql(True), **METRIC_STEPS},
        f"SELECT model, {rounded_columns(['auc', 'log_loss'])} FROM aucs JOIN losses USING (model)",
    ),
)
def pairwise_blends(spark, folder):
    """AUC and log-loss of six scores and their fifteen pairwise averages."""
    scored = _closed_form(spark, folder)
    # Averages of four-digit scores are rounded, so that equal ones tie in any engine.
    columns = {n: F.round(c, 9) for n, c in evaluate.singles_and_pairs(SCORES).items()}
    return settle(evaluate.report(scored, columns))


# Feature vectors

FILLED = [
    "bd",
    *TX_DOUBLES,
    *TX_OTHERS,
    *total_columns()["double"],
    *total_columns()["other"],
    "amount_of_logins",
    *pivot_columns()["double"],
    *pivot_columns()["other"],
    "diff_first_last_transaction",
    "diff_max_min_log",
    "diff_first_log_registration",
    "days_since_last_transaction",
    "days_since_registration",
    "diff_days_last_login_last_transaction",
    "days_since_last_login",
    "rare_user",
    *[f"{c}_{v}" for c, values in ONE_HOT_DOMAIN.items() for v in values],
]


@query(
    "feature_vector",
    with_steps(
        final_steps(),
        f"""
SELECT msno, is_churn, {len(FILLED)} AS size,
       {rounded(' + '.join(f'coalesce({c}, -99.0)::DOUBLE' for c in FILLED), 3)} AS total FROM final""",
    ),
)
def feature_vector(spark, folder):
    """Size and sum of each member's assembled vector, gaps at the sentinel."""
    final = features.final_dataset(inputs(spark, folder), "train")
    rows = prepare.assembled(final, features.feature_columns(final))
    values = evaluate.vector_to_array(F.col(prepare.FEATURES))
    total = F.aggregate(values, F.lit(0.0), lambda sofar, v: sofar + v)
    return settle(rows.select("msno", "is_churn", F.size(values).alias("size"), total.alias("total")), 3)


# Trained models


def input_state(spark, folder) -> int:
    """A number that changes with the path, length or time of any input file; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = files.load([f"{folder}/{name}.parquet" for name in SOURCES])
    return found.agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()[0]


def bundle(spark, folder, name: str) -> bundles.Bundle:
    """The preset fitted on the training part: loaded if any session has fitted it on these files, else fitted here."""
    root, source = f"{shared_dir(spark)}/bundles", str(input_state(spark, folder))
    found = bundles.find_bundle(spark, root, name, models.PRESETS[name].settings, source)
    if found is None:
        rows, columns, categories = training(spark, folder)
        train = rows.filter(F.col("part") == "train")
        found = bundles.fit_bundle(root, name, train, columns, categories, source)
    return found


def trained(spark, folder, name: str):
    return bundle(spark, folder, name).model


#: Fits that run at the same time where a query needs several (one of boosted trees mostly keeps one core busy), and
#: the presets by the length of their fits.
FITS_AT_ONCE = 8
LONGEST_FIRST = ("gbt_deep", "gbt_leafy", "gbt_shallow", "random_forest", "adaboost", "decision_tree")


def all_trained(spark, folder) -> dict:
    """Every preset's model by name. Fits run side by side, so one's passes fill the cores that another leaves idle.

    A fit is the same alone and beside others: it reads the staged rows and keeps its own tables.
    """
    training(spark, folder)
    shared_dir(spark)
    return _fitted(spark, folder, LONGEST_FIRST, models.PRESETS)


def _fitted(spark, folder, names, order) -> dict:
    jobs = [lambda name=name: trained(spark, folder, name) for name in names]
    found = dict(zip(names, models.side_by_side(spark, jobs, FITS_AT_ONCE)))
    return {name: found[name] for name in order}


def training(spark, folder) -> tuple[DataFrame, list[str], dict[str, list[int]]]:
    """The training rows, written once a session, their feature columns and the categories behind those."""
    key = (spark.sparkContext.applicationId, input_state(spark, folder))
    with _staging:  # fits side by side ask for it at the same time
        if key not in _staged:
            tables = inputs(spark, folder)
            categories = features.learn_categories(tables, "train")
            final = features.final_dataset(tables, "train", categories)
            columns = features.feature_columns(final)
            _staged[key] = (prepare.staged_training_rows(final, columns), columns, categories)
    return _staged[key]


def _parts(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows, _, _ = training(spark, folder)
    return rows.filter(F.col("part") == "train"), rows.filter(F.col("part") == "test")


def _train(name: str) -> Query:
    def run(spark, folder):
        _, test = _parts(spark, folder)
        scored = evaluate.with_scores({name: trained(spark, folder, name)}, test).drop(prepare.FEATURES, prepare.RAW)
        return settle(evaluate.report(stage_table(scored, "scored"), {name: F.col(name)}))

    run.__name__ = f"train_{name}"
    run.__doc__ = f"Fits the {name} preset and reports its AUC and log-loss on the held-out part."
    return run


for _name in models.PRESETS:
    query(f"train_{_name}")(_train(_name))


@query("grid_search")
def grid_search(spark, folder):
    """Mean cross-validated accuracy of each depth; the best one is refitted on all folds."""
    train, _ = _parts(spark, folder)
    depths = [3, 5]
    found = models.grid_search("decision_tree", train, {"maxDepth": depths})
    best = found.best["maxDepth"]
    rows = [(d, float(a), d == best) for d, a in zip(depths, found.metrics)]
    return settle(spark.createDataFrame(rows, "max_depth int, accuracy double, refitted boolean"))


@query("score_model")
def score_model(spark, folder):
    _, test = _parts(spark, folder)
    scored = evaluate.with_scores({"score": trained(spark, folder, "decision_tree")}, test)
    return settle(scored.select("msno", "is_churn", "score"))


@query(
    "model_roundtrip",
    with_steps(
        {"train": VIEWS["train"]},
        f"""
SELECT model, count(*) AS rows, 0.0::DOUBLE AS largest_difference
FROM (SELECT is_churn, {_share_sql('42')} AS share FROM train)
JOIN (SELECT is_churn, quantile_cont({_share_sql('42')}, 0.2) AS cut FROM train GROUP BY is_churn) c
  USING (is_churn)
CROSS JOIN (VALUES ('adaboost'), ('gbt_shallow')) m(model)
WHERE share < cut
GROUP BY model""",
    ),
)
def model_roundtrip(spark, folder):
    """A saved and reloaded model gives every held-out row the score it had before."""
    _, test = _parts(spark, folder)
    compared = []
    for name in ("adaboost", "gbt_shallow"):
        model, path = trained(spark, folder, name), fresh_path(spark, name)
        models.save_model(model, path)
        both = evaluate.with_scores({"before": model, "after": models.load_model(name, path)}, test)
        compared.append(
            both.agg(
                F.lit(name).alias("model"),
                F.count("*").alias("rows"),
                F.max(F.abs(F.col("before") - F.col("after"))).alias("largest_difference"),
            )
        )
    return joins.union_by_name(*compared)


@query("model_report")
def model_report(spark, folder):
    """AUC and log-loss of all six models and their fifteen pairwise blends."""
    _, test = _parts(spark, folder)
    scored = evaluate.with_scores(all_trained(spark, folder), test).drop(prepare.FEATURES, prepare.RAW)
    return settle(evaluate.report(stage_table(scored, "scored"), evaluate.singles_and_pairs(SCORES)))


STACKED = ["gbt_deep", "gbt_leafy"]


def _stacked(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Stacked rows: out-of-fold scores for the training part, plain ones for the held-out part. Written once a session."""
    key = (spark.sparkContext.applicationId, input_state(spark, folder), "stacked")
    if key not in _staged:
        train, test = _parts(spark, folder)
        fair, plain = models.side_by_side(
            spark,
            [
                lambda: evaluate.out_of_fold_scores(STACKED, train, prepare.FOLDS, at_once=FITS_AT_ONCE - len(STACKED)),
                lambda: evaluate.with_scores(_fitted(spark, folder, STACKED, STACKED), test),
            ],
            2,
        )
        _staged[key] = stage_table(joins.union_by_name(fair, plain).drop(prepare.FEATURES, prepare.RAW), "stacked")
    rows = evaluate.stacked(_staged[key], STACKED)
    return rows.filter(F.col("part") == "train"), rows.filter(F.col("part") == "test")


@query("stack_features")
def stack_features(spark, folder):
    fair, plain = _stacked(spark, folder)
    both = joins.union_by_name(fair, plain)
    return settle(both.select("msno", "is_churn", "part", *STACKED))


@query("train_meta_lr")
def train_meta_lr(spark, folder):
    """The stacked meta-model's AUC and log-loss on both parts."""
    fair, plain = _stacked(spark, folder)
    meta = models.fit_meta(fair)
    reports = [
        evaluate.report(evaluate.with_scores({"meta": meta}, rows), {"meta": F.col("meta")}).withColumn(
            "part", F.lit(part)
        )
        for part, rows in (("train", fair), ("test", plain))
    ]
    return settle(reduce(DataFrame.unionByName, reports))


@query("meta_coefficients")
def meta_coefficients(spark, folder):
    """In-sample stacking, as the original study does it, and the weight of each base model."""
    train, _ = _parts(spark, folder)
    scored = evaluate.with_scores(_fitted(spark, folder, STACKED, STACKED), train).drop(prepare.FEATURES, prepare.RAW)
    meta = models.fit_meta(evaluate.stacked(stage_table(scored, "scored"), STACKED))
    return settle(evaluate.meta_coefficients(meta, STACKED, spark))


@query("importance_gain")
def importance_gain(spark, folder):
    deep = bundle(spark, folder, "gbt_deep")
    return settle(evaluate.gain_importance(deep.model, deep.columns, spark))


@query("importance_weight")
def importance_weight(spark, folder):
    deep = bundle(spark, folder, "gbt_deep")
    return settle(evaluate.split_importance(deep.model, deep.columns, spark))


@query("submission")
def submission(spark, folder):
    """Blended scores of the scoring split, written as CSV and read back."""
    fitted = models.side_by_side(spark, [lambda n=n: bundle(spark, folder, n) for n in STACKED], FITS_AT_ONCE)
    scored = bundles.score_inputs(fitted, inputs(spark, folder), "test")
    path = fresh_path(spark, "submission")
    files.write_csv(evaluate.submission(scored, *STACKED), path)
    return files.read_csv(spark, path, schemas.SUBMISSION)
