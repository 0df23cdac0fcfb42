"""MinHash near-duplicate groups with fast similarity sketching.

A document's set is its distinct k-word shingles. The sketch has ``COORDINATES`` places. In round i every
shingle is dropped into one hashed place with value (i, hash); a place keeps its smallest value. After
``COORDINATES`` such rounds, round ``COORDINATES + j`` drops every shingle into place j, so each place fills
for certain; the rounds end as soon as all are filled, for most documents after one or two. Two sets agree
in a place with a probability of their Jaccard similarity, and the places concentrate like independent ones.

Places are grouped in bands, as long as the wanted chance to miss a pair allows. Bands only propose pairs;
every link is confirmed on the full sets.

How groups stay splittable: documents with equal sets form a class with one representative, by a count
combined before its shuffle. Within a bucket, all members are first compared with the member that shares
most buckets with others, so a large group of near copies falls together with about one comparison each.
What a small bucket still holds in different groups is then compared across those groups. In large ones, two
members of different groups are compared if they share a shingle that few others have, or if one of their
rarest other shingles agrees and what follows it, in order of rarity, is still enough. Both are provable
bounds: far members of a large group, made of shingles of their own, drop out unseen, and no pair that could be
linked is left out. No bucket is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.common import slices, texts
from refrain.llm.components import components
from refrain.llm.words import hash_texts, mix, shingles, sorted_sets
from refrain.sources.storage import stage_table

COORDINATES = 256
#: Members up to which a bucket's groups are compared pair by pair; larger buckets meet on rare shingles.
PLAIN_BUCKET = 16
#: Members up to which a shingle of large buckets counts as rare.
FEW = 8


def band_rows(similarity: float, miss: float = 1e-5) -> int:
    """The longest band that misses a pair of just this similarity with at most this chance."""
    rows = 1
    while (1 - similarity ** (rows + 1)) ** (COORDINATES // (rows + 1)) <= miss:
        rows += 1
    return rows


def sketch(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of ``COORDINATES`` numbers for each set; a set without elements keeps the largest number."""
    t = COORDINATES
    out = np.full((len(sizes), t), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for turn in range(2 * t):
        if not len(values):
            break
        h = mix(values + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = (h & np.uint64(t - 1)).astype(np.int64) if turn < t else turn - t
        np.minimum.at(flat, owner * t + place, (np.uint64(turn) << np.uint64(52)) | (h >> np.uint64(12)))
        open_ = (out == np.iinfo(np.uint64).max).any(axis=1)
        going = open_[owner]
        if not going.all():
            values, owner = values[going], owner[going]
    return out


def bands(sketches: np.ndarray, rows: int) -> np.ndarray:
    """Bucket keys: one 64-bit number for each band of each sketch."""
    n = COORDINATES // rows
    out = np.zeros((len(sketches), n), np.uint64)
    for j in range(rows):
        out = mix(out * np.uint64(31) + sketches[:, j : n * rows : rows])
    return mix(out + np.arange(n, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def sets_of(batch: pa.RecordBatch, column: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = hash_texts([b.lower() for b in texts(batch, column)])
    return sorted_sets(*shingles(hashes, counts, k))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values.view(np.int64)))


def _sketched(shingle: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, sizes = sets_of(batch, "text", shingle)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            sums = np.zeros((2, len(sizes)), np.uint64)
            np.add.at(sums[0], owner, values)
            np.add.at(sums[1], owner, mix(values ^ np.uint64(0x5851F42D4C957F2D)))
            some = sizes > 0
            keys = bands(sketch(values, sizes)[some], rows)
            widths = np.where(some, keys.shape[1], 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    _lists(keys.reshape(-1), widths),
                ],
                ["doc_id", "n_shingles", "k1", "k2", "bands"],
            )

    return run


def _full_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, sizes = sets_of(batch, "text", shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(values, sizes)], ["rep", "items"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ..)``: doc_id, n_shingles, component_id, kept, class_size.

    Documents with 100 * shared >= percent * all shingles are linked; ``component_id`` is the smallest doc_id
    reachable. ``class_size`` counts the documents with the same set. Null or wordless texts have no shingles
    and are linked with nothing. Rows without a doc_id take no part: their component_id is null and they are
    kept. Rows that repeat a doc_id are the same document. Columns other than doc_id and text are not read.
    """
    rows = band_rows(percent / 100)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = stage_table(
        docs.mapInArrow(
            _sketched(shingle, rows), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"
        ),
        "sketches",
    )
    known = marked.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = known.groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("class_size"))
    classes = stage_table(classes, "classes")
    links = _links(docs, known, classes, shingle, percent)
    groups = components(links).withColumnsRenamed({"node": "rep"})
    labelled = classes.join(groups, "rep", "left").select(
        "n_shingles", "k1", "k2", "class_size", F.coalesce("component", "rep").alias("component")
    )
    return (
        marked.drop("bands")
        .join(labelled, ["n_shingles", "k1", "k2"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
            F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _links(docs: DataFrame, known: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that connect all linked representatives."""
    reps = known.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    spread = reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    members = stage_table(spread.join(shared, "bucket"), "members")
    sets = stage_table(
        docs.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(
            _full_sets(shingle), "rep long, items array<long>"
        ),
        "sets",
    )
    # The busiest member of each bucket is its centre; ties go by a mixed id, in the low bits.
    busy = members.groupBy("rep").agg(
        (F.shiftleft(F.sum("m"), 20) + F.pmod(F.xxhash64("rep"), F.lit(1 << 20))).alias("busy")
    )
    centres = members.join(busy, "rep").groupBy("bucket").agg(F.max_by(F.struct("rep", "n"), "busy").alias("c"))
    stars = members.join(centres, "bucket").select("rep", "n", F.col("c.rep").alias("to"), F.col("c.n").alias("to_n"))
    first = _confirmed(stars, sets, percent)
    groups = components(first).select(F.col("node").alias("rep"), "component")
    placed = members.join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = stage_table(_unsettled(placed, "bucket"), "unsettled")
    within = f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
    few = placed.filter(f"m <= {PLAIN_BUCKET}")
    crossing = few.alias("x").join(
        few.alias("y"), F.expr(f"x.bucket = y.bucket AND x.rep < y.rep AND x.component <> y.component AND {within}")
    )
    many = placed.filter(f"m > {PLAIN_BUCKET}").select("rep", "n", "component").distinct()
    items = _counted_items(many, sets)
    # Either two members share an item that few have ..
    few_have = items.filter(f"often BETWEEN 2 AND {FEW}")
    sharing = few_have.alias("x").join(
        few_have.alias("y"), F.expr(f"x.item = y.item AND x.rep < y.rep AND x.component <> y.component AND {within}")
    )
    # .. or at most what they have besides such items.
    # Only items after those count then, and the first one that two members share leaves room for what follows it.
    firsts = _rarest(items, percent).filter(f"often > {FEW}")
    # The largest group of an item is only compared with others, never with itself; other groups meet once.
    sizes = firsts.groupBy("item", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("item").agg(F.max_by("component", "size").alias("largest"), F.count("*").alias("groups"))
    others = firsts.join(largest.filter("groups > 1"), "item").filter("component <> largest")
    once = "(y.component = x.largest OR x.rep < y.rep)"
    room = f"{100 + percent} * (1 + least(x.n - x.place, y.n - y.place)) >= {percent} * (x.n + y.n)"
    meeting = others.alias("x").join(
        firsts.alias("y"), F.expr(f"x.item = y.item AND x.component <> y.component AND {once} AND {within} AND {room}")
    )
    pairs = [
        j.select("x.rep", "x.n", F.col("y.rep").alias("to"), F.col("y.n").alias("to_n"))
        for j in (crossing, sharing, meeting)
    ]
    return first.union(_confirmed(pairs[0].union(pairs[1]).union(pairs[2]), sets, percent))


def _counted_items(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The shingles of each member, with the number of members that have them."""
    items = members.join(sets, "rep").select("rep", "n", "component", F.explode("items").alias("item"))
    return stage_table(items.join(items.groupBy("item").agg(F.count("*").alias("often")), "item"), "items")


def _rarest(items: DataFrame, percent: int) -> DataFrame:
    """For each member, so many of its rarest shingles that two similar enough sets must share one of them."""
    ranked = items.withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("often", "item")))
    return ranked.filter(f"place <= n - ceil({percent} * n / 100) + 1").select("rep", "n", "component", "item", "often", "place")


def _unsettled(members: DataFrame, key: str) -> DataFrame:
    """Members of the buckets that still hold more than one group."""
    mixed = members.groupBy(key).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return members.join(mixed.filter("low <> high"), key, "left_semi")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct proposed pairs whose full sets are similar enough, written once."""
    likely = pairs.filter(f"rep <> to AND 100 * least(n, to_n) >= {percent} * greatest(n, to_n)")
    likely = likely.select(F.least("rep", "to").alias("a"), F.greatest("rep", "to").alias("b")).distinct()
    both = likely.join(sets.select(F.col("rep").alias("a"), F.col("items").alias("left")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("items").alias("right")), "b"
    )
    both = both.withColumn("shared", F.size(F.array_intersect("left", "right")))
    alike = both.filter(f"100 * shared >= {percent} * (size(left) + size(right) - shared)")
    return stage_table(alike.select("a", "b").distinct(), "confirmed")
