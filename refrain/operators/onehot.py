"""One-hot blocks: one named column per learned category, or a sparse vector per column for wide domains."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refrain.operators import ordering
from refrain.sources.storage import stage_table

MAX_CATEGORIES = 1000
#: An index of more categories is never broadcast.
WIDE = 20_000


def fit_categories(df: DataFrame, columns: list[str], limit: int = MAX_CATEGORIES) -> dict[str, list[int]]:
    """Distinct values of each column in ascending order.

    One aggregate over all columns; at most ``limit`` + 1 values per column reach the driver,
    and a wider column is refused, since it is no category.
    """
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("int").alias("value")) for c in columns]
    seen = df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL").distinct()
    rows = seen.limit(limit * len(columns) + 1).collect()
    categories = {c: sorted(r.value for r in rows if r.name == c) for c in columns}
    wide = [c for c, values in categories.items() if len(values) > limit]
    if wide or len(rows) > limit * len(columns):
        raise ValueError(f"more than {limit} categories in {wide or columns}")
    return categories


def one_hot(df: DataFrame, categories: dict[str, list[int]]) -> DataFrame:
    """Replaces each column by 0.0 / 1.0 columns ``{column}_{value}``."""
    block = [
        f"CASE WHEN CAST(`{c}` AS INT) = {v} THEN 1D ELSE 0D END AS `{c}_{v}`"
        for c, values in categories.items()
        for v in values
    ]
    return df.selectExpr(*[f"`{c}`" for c in df.columns if c not in categories], *block)


def one_hot_vectors(columns: list[str]) -> Pipeline:
    """The same encoding as sparse vectors ``{column}_vector``, for very wide domains."""
    indexed = [f"{c}_index" for c in columns]
    vectors = [f"{c}_vector" for c in columns]
    indexer = StringIndexer(inputCols=columns, outputCols=indexed, stringOrderType="alphabetAsc")
    return Pipeline(stages=[indexer, OneHotEncoder(inputCols=indexed, outputCols=vectors, dropLast=False)])


def category_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, index): the place of every category of numeric columns in ascending order, from 0.

    The places are running totals over the distinct values, so no column's domain passes through the driver
    or one task. The table is written once, as a fitted encoding has to be.
    """
    seen = ordering.value_counts(df, columns).select("column", "value", F.least("n", F.lit(1)).alias("one"))
    ranked = ordering.running_totals(seen, "column", "value", ["one"])
    return stage_table(ranked.select("column", "value", F.col("below_one").cast("int").alias("index")), "categories")


def one_hot_sparse(df: DataFrame, index: DataFrame, columns: list[str]) -> DataFrame:
    """Adds a sparse vector ``{column}_vector`` per column, of the size the column has in ``index``.

    A null or a category that was not learned gives a vector of zeros. The vector of a category is made once, in the
    index; no attribute per category is kept in the schema. The index meets the rows in a left join: up to ``WIDE``
    categories it is broadcast if its measured bytes allow it, a wider one is merged, and a frequent category is split
    on the side of the rows.
    """
    kept = df.columns
    sizes = {r.column: r.last + 1 for r in index.groupBy("column").agg(F.max("index").alias("last")).collect()}
    for c in columns:
        size, vector = sizes.get(c, 1), f"{c}_vector"
        part = index.filter(F.col("column") == c).select(F.col("value").alias(f"{c}_value"), _unit(F.col("index"), size).alias(vector))
        part = part.hint("merge") if size > WIDE else part
        df = df.join(part, F.col(c).cast("double") == F.col(f"{c}_value"), "left")
        found = F.coalesce(vector, _unit(None, size)).alias(vector, metadata={"ml_attr": {"num_attrs": size}})
        df = df.select(*[k for k in df.columns if k not in (vector, f"{c}_value")], found)
    return df.select(*kept, *[f"{c}_vector" for c in columns])


def _unit(place: Column | None, size: int) -> Column:
    """A sparse vector with 1 at one place, or at none."""
    at, one = (F.lit(""), "") if place is None else (place.cast("string"), "1.0")
    told = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},"indices":['), at, F.lit(f'],"values":[{one}]}}}}'))
    return F.from_json(told, StructType().add("v", VectorUDT()))["v"]


def vector_sums(df: DataFrame, vectors: list[str]) -> DataFrame:
    """(vector, index, total): the sum of each sparse vector column, one row per place that any row fills.

    Places are added up on the map side and meet by place, so no task holds a whole dense vector.
    """

    def places(name: str) -> Column:
        held = F.unwrap_udt(name)
        pairs = F.arrays_zip(held["indices"].alias("index"), held["values"].alias("value"))
        return F.transform(pairs, lambda p: F.struct(F.lit(name).alias("vector"), p["index"].alias("index"), p["value"].alias("value")))

    long = df.select(F.inline(F.concat(*map(places, vectors))))
    return long.groupBy("vector", "index").agg(F.sum("value").alias("total"))
