"""Mixing sources to target weights by systematic sampling, in DataFrame functions alone.

Every document of a source expects the same number of copies, ``target / source size``. Documents stand in the
order (size, id) of their source; the expected copies are added up along it, one random offset is added, and a
document is emitted once for each whole number that its step crosses. Since neighbours have about the same size,
the words taken stay within about one largest document of the target.

The running position needs no ordered pass over a source. It is the number of documents of smaller sizes, plus
those of the same size in earlier lanes, plus the place within the lane; each part is a window over counts or
over one lane, so a source that holds a third of all rows is spread over its sizes and lanes.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.common import WORD

#: Lanes into which the documents of one source and size are split.
LANES = 64
#: Most times that a source or a document is repeated.
MOST = 3


def n_words(text: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def offset(seed: int = 0) -> float:
    """The random offset of a seed, in (0, 1); few bits, so sums with it are exact."""
    return (2 * (int(hashlib.sha256(str(seed).encode()).hexdigest(), 16) % 512) + 1) / 1024


def source_targets(sizes: DataFrame, source: str = "source", most: int = MOST) -> DataFrame:
    """(rank, source, source_size, target): words to take from each source, from its words ``size``.

    Sources in code point order, null last, weigh 1, 2, 3, 1, .. and share all words; a target ends at ``most``
    times its source's size and the excess goes to the others by weight. That is a water level: the sources
    with the smallest size for their weight are full first, and the level of the rest is what is left over
    the weight left. One row per source, so the windows hold as many rows as there are sources.
    """
    ranked = Window.orderBy(F.col(source).asc_nulls_last())
    everything = Window.partitionBy()
    weighed = sizes.withColumn("place", F.row_number().over(ranked)).withColumn(
        "weight", ((F.col("place") - 1) % 3 + 1).cast("double")
    )
    filled = Window.orderBy(F.col("full") / F.col("weight"), "place")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        weighed.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.col("source_size") * F.lit(float(most)))
        .withColumn("used", F.coalesce(F.sum("full").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("all", F.sum("weight").over(everything))
        .withColumn("level", (F.col("total") - F.col("used")) / (F.col("all") - F.col("gone")))
        .withColumn("is_full", F.col("level") * F.col("weight") > F.col("full"))
    )
    # The level of those that are not full is the one of the first of them.
    level = F.first(F.when(~F.col("is_full"), F.col("level")), ignorenulls=True).over(
        filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levels.withColumn("water", level).select(
        source,
        "source_size",
        F.when(F.col("is_full"), F.col("full")).otherwise(F.col("water") * F.col("weight")).alias("target"),
    )


def mix_sources(docs: DataFrame, seed: int = 0, most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of ``docs(doc_id, text, source, ..)`` with size, source_size, target,
    copies and taken (= copies * size).

    Null texts have no words; null is a source of its own, after all others. A source without words has
    target 0 and gives no copies. Repeated rows are documents of their own. Reruns agree, however the rows are dealt:
    the order is (size, lane, doc_id, hash of the row), null ids are in lanes by that hash, and the offset comes from
    ``seed``. Columns of ``docs`` named like the new ones give way.
    """
    new = ("size", "source_size", "target", "copies", "taken")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    content = [F.col(c) for c in sorted({*keep, "doc_id", "text", "source"})]
    plain = docs.select(
        *[F.col(c).alias(f"_{c}") for c in keep],
        F.col("source"),
        F.col("doc_id"),
        n_words().alias("size"),
        F.xxhash64(*content, *[c.isNull() for c in content]).alias("mark"),
    )
    plain = plain.withColumn("lane", F.pmod(F.coalesce(F.col("doc_id").cast("long"), "mark"), F.lit(LANES)).cast("int"))
    lanes = plain.groupBy("source", "size", "lane").agg(F.count("*").alias("n"))
    by_size = lanes.groupBy("source", "size").agg(F.sum("n").alias("n_size"))
    targets = source_targets(by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n_size")).alias("source_size")), most=most)
    earlier = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.withColumn("smaller", F.coalesce(F.sum("n_size").over(earlier), F.lit(0)))
    earlier = Window.partitionBy("source", "size").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = lanes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    def same(*names: str) -> Column:
        out = F.lit(True)
        for n in names:
            out = out & F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
        return out

    starts = (
        lanes.alias("a")
        .join(by_size.alias("b"), same("source", "size"))
        .select("a.source", "a.size", "a.lane", (F.col("before") + F.col("smaller")).alias("start"))
    )
    starts = (
        starts.alias("a")
        .join(targets.alias("b"), same("source"))
        .select("a.*", "source_size", "target")
    )
    within = Window.partitionBy("source", "size", "lane").orderBy("doc_id", "mark")
    rows = plain.withColumn("place", F.row_number().over(within))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    at = F.col("start") + F.col("place")
    copies = F.floor(share * at + offset(seed)) - F.floor(share * (at - 1) + offset(seed))
    return (
        rows.alias("a")
        .join(starts.alias("b"), same("source", "size", "lane"))
        .select(
            *[F.col(f"a._{c}").alias(c) for c in keep],
            F.col("a.size").alias("size"),
            "source_size",
            "target",
            copies.alias("copies"),
            (copies * F.col("a.size")).alias("taken"),
        )
    )
