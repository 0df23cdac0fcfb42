"""Ranked lexical search with two trees: one over the items that ask, one over the documents that answer.

An item is a vector of term counts, a document a vector of term scores, none below 0; the score of the two is
their inner product. Both sides stand in trees whose nodes hold the largest value of each coordinate below
them. The product of two nodes' maxima is a bound on the score of every pair under them; if it is below the
weakest kth score of the node's items, the whole batch of pairs goes, exactly.

1. **Vectors.** Each document is read once: its terms that may be an item's (a bitmap of fixed size tells, so that most
   others never leave the task) with their counts, written as one row per document. Document frequencies are a
   grouped count over them; a join with the items' terms removes those that the bitmap let through by chance.
2. **Blocks of items.** Items go in blocks of a bounded number of terms; a block's tree is broadcast. Documents stay in
   their partitions: each task builds trees over some thousand documents at a time and walks both trees down.
3. **Thresholds.** A first search over a share of the documents gives each item a kth score that no later document
   of the top list can be below. Tasks start from these and raise them as they go.
4. **Lists.** A task's lists hold at most ``k`` rows of an item; the lists of all tasks are merged by a window.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.llm.common import slices, texts
from refrain.llm.words import ramp
from refrain.sources.storage import fresh_path, stage_table

#: Bits of the bitmap of item terms.
BITS = 1 << 23
#: Items and item terms of a block, on average.
ITEMS, ENTRIES = 1024, 1 << 16
#: Documents of a leaf, leaves of a node above, numbers of a tree's leaf maxima.
LEAF, FAN, MAXIMA = 16, 8, 1 << 21
#: Items of a leaf; document leaves that meet it at once.
ITEM_LEAF, AT_ONCE = 8, 32
#: One of so many documents gives the first thresholds.
SHARE = 64
#: Sums up to this size are exact in double precision.
_EXACT = float(1 << 53)
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(_TABLE).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows, terms, counts = [], [], []
        for row, text in enumerate(texts(batch, "text")):
            for term, n in Counter(terms_of(text)).items():
                rows.append(row)
                terms.append(term)
                counts.append(n)
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row").take(at), batch.column("item_id").take(at)]
            + [pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
            ["row", "item_id", "term", "q"],
        )


def _vectors(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """doc_id, number of terms, and the terms that may be an item's with their counts."""
    bits = shared.value
    for batch in slices(batches, "text", 1 << 20):
        wanted: dict[bytes, bool] = {}
        sizes, terms, counts, ends = [], [], [], [0]
        for text in texts(batch, "text"):
            words = terms_of(text)
            sizes.append(len(words))
            for term, n in Counter(words).items():
                hit = wanted.get(term)
                if hit is None:
                    place = zlib.crc32(term) % BITS
                    hit = wanted[term] = bool(int(bits[place >> 6]) >> (place & 63) & 1)
                if hit:
                    terms.append(term)
                    counts.append(n)
            ends.append(len(terms))
        offsets = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
            ],
            ["doc_id", "n", "terms", "counts"],
        )


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Bits of the terms' checksums: at most ``BITS`` / 64 rows reach the driver, whatever the number of terms."""
    place = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(BITS))
    words = terms.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
    got = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS INT))")).alias("bits")).toPandas()
    out = np.zeros(BITS >> 6, np.uint64)
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return out


@dataclass
class Node:
    """Items ``low`` to ``high`` of a block: the columns of their terms, the largest count of each, and the nodes below.

    A leaf has the counts themselves, a row per item.
    """

    low: int
    high: int
    columns: np.ndarray
    maxima: np.ndarray
    below: list[Node]
    counts: np.ndarray | None = None


@dataclass
class Block:
    """Items with their ids, terms with their weights, the tree, and the thresholds to start from."""

    rows: np.ndarray
    item_ids: list[int | None]
    terms: pa.Array
    weights: np.ndarray
    root: Node
    thresholds: np.ndarray


def build_block(rows: pa.Table) -> Block:
    """The block of a table (row, item_id, term, q, w). Items that share their most common terms stand together."""
    terms, columns = np.unique(rows.column("term").to_numpy(zero_copy_only=False), return_inverse=True)
    keys, first, items = np.unique(rows.column("row").to_numpy(), return_index=True, return_inverse=True)
    q, w = rows.column("q").to_numpy(), rows.column("w").to_numpy()
    weights = np.zeros(len(terms), np.int64)
    weights[columns] = w
    common = np.argsort(-np.bincount(columns), kind="stable")[:16]
    bits = np.zeros((len(keys), len(common)), bool)
    for i, c in enumerate(common):
        bits[items[columns == c], i] = True
    order = np.lexsort(bits.T[::-1])
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    items = place[items]
    level = []
    for low in range(0, len(keys), ITEM_LEAF):
        high = min(low + ITEM_LEAF, len(keys))
        mine = np.flatnonzero((items >= low) & (items < high))
        own, at = np.unique(columns[mine], return_inverse=True)
        counts = np.zeros((high - low, len(own)), np.int64)
        counts[items[mine] - low, at] = q[mine]
        level.append(Node(low, high, own, counts.max(0), [], counts))
    while len(level) > 1:
        level = [_above(level[i : i + FAN]) for i in range(0, len(level), FAN)]
    ids = rows.column("item_id").to_pylist()
    return Block(
        keys[order], [ids[i] for i in first[order]], pa.array(terms, pa.string()), weights, level[0], np.zeros(len(keys), np.int64)
    )


def _above(nodes: list[Node]) -> Node:
    own, at = np.unique(np.concatenate([n.columns for n in nodes]), return_inverse=True)
    maxima = np.zeros(len(own), np.int64)
    np.maximum.at(maxima, at, np.concatenate([n.maxima for n in nodes]))
    return Node(nodes[0].low, nodes[-1].high, own, maxima, nodes)


class Lists:
    """The best ``k`` documents of each item of a block so far."""

    def __init__(self, block: Block, k: int):
        self.k, self.least = k, np.maximum(block.thresholds, 1)
        none = np.zeros(0, np.int64)
        self.held = [(none, np.zeros(0, bool), none)] * len(block.rows)

    def add(self, item: int, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        enough = np.flatnonzero(scores >= self.least[item])
        if not len(enough):
            return
        new = [c[enough] for c in (scores, nulls, ids)]
        merged = [np.concatenate(c) for c in zip(self.held[item], new)]
        if len(merged[0]) > self.k:
            keep = np.lexsort((merged[2], merged[1], -merged[0]))[: self.k]
            merged = [c[keep] for c in merged]
            self.least[item] = max(self.least[item], merged[0][-1])
        elif len(merged[0]) == self.k:
            self.least[item] = max(self.least[item], merged[0].min())
        self.held[item] = tuple(merged)

    def batches(self, block: Block) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(self.held), 256):
            part = self.held[start : start + 256]
            sizes = [len(h[0]) for h in part]
            at = np.repeat(np.arange(start, start + len(part)), sizes)
            scores, nulls, ids = (np.concatenate(c) for c in zip(*part))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.rows[at]),
                    pa.array([block.item_ids[i] for i in at], pa.int64()),
                    pa.array(ids, pa.int64(), mask=nulls),
                    pa.array(scores.astype(np.int64)),
                ],
                ["row", "item_id", "doc_id", "score"],
            )


class Documents:
    """A tree over some documents: scores by document, and the maxima of leaves, of nodes above, and of all."""

    def __init__(self, batch: pa.RecordBatch, block: Block, n_docs: int, n_terms: int):
        lists = batch.column("terms")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        column = pc.index_in(lists.flatten(), value_set=block.terms)
        hit = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        column = column.to_numpy(zero_copy_only=False)[hit].astype(np.int64)
        owner = np.repeat(np.arange(batch.num_rows), sizes)[hit]
        tf = batch.column("counts").flatten().to_numpy()[hit]
        n = batch.column("n").to_numpy()
        m = 75 + (25 * n * n_docs) // max(n_terms, 1)
        score = block.weights[column] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[owner]))
        # Documents with the same strongest term stand together.
        strongest = np.full(batch.num_rows, -1)
        rising = np.argsort(score, kind="stable")
        strongest[owner[rising]] = column[rising]
        order = np.argsort(strongest, kind="stable")
        order = order[np.count_nonzero(strongest < 0) :]
        self.count = len(order)
        place = np.empty(batch.num_rows, np.int64)
        place[order] = np.arange(self.count)
        owner = place[owner]
        by_doc = np.argsort(owner, kind="stable")
        self.owner, self.column, self.score = owner[by_doc], column[by_doc], score[by_doc]
        self.starts = np.searchsorted(self.owner, np.arange(self.count + 1))
        ids = batch.column("doc_id")
        self.nulls = ids.is_null().to_numpy(zero_copy_only=False)[order]
        self.ids = pc.fill_null(ids, 0).to_numpy()[order]
        self.local = np.full(len(block.weights), -1)
        leaves = -(-self.count // LEAF)
        bottom = np.zeros((len(block.weights), leaves), np.int64)
        np.maximum.at(bottom, (self.column, self.owner // LEAF), self.score)
        self.levels = [bottom]
        while self.levels[0].shape[1] > 1:
            below = self.levels[0]
            wide = -(-below.shape[1] // FAN) * FAN
            padded = np.pad(below, ((0, 0), (0, wide - below.shape[1])))
            self.levels.insert(0, padded.reshape(len(below), -1, FAN).max(2))
        root = block.root
        bound = float(root.maxima.astype(float) @ self.levels[0][root.columns, 0].astype(float)) if leaves else 0.0
        #: Products are taken in double precision where that is exact.
        self.kind = np.float64 if bound < _EXACT / 2 else np.int64
        self.levels = [level.astype(self.kind) for level in self.levels]

    def dense(self, columns: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of some documents in some columns, a row per column."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        at = np.repeat(self.starts[docs], sizes) + ramp(sizes)
        column = self.column[at]
        self.local[columns] = np.arange(len(columns))
        where = self.local[column]
        self.local[columns] = -1
        mine = where >= 0
        out = np.zeros((len(columns), len(docs)), self.kind)
        out[where[mine], np.repeat(np.arange(len(docs)), sizes)[mine]] = self.score[at[mine]]
        return out


def search_trees(docs: Documents, node: Node, depth: int, nodes: np.ndarray, lists: Lists) -> None:
    """Walk both trees down from an item node and document nodes of one depth; pairs that cannot count are cut."""
    level = docs.levels[depth]
    bounds = node.maxima.astype(docs.kind) @ level[node.columns[:, None], nodes[None, :]]
    weakest = lists.least[node.low : node.high]
    nodes, bounds = nodes[bounds >= weakest.min()], bounds[bounds >= weakest.min()]
    if not len(nodes):
        return
    if depth + 1 < len(docs.levels):
        nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        nodes = nodes[nodes < docs.levels[depth + 1].shape[1]]
        for below in node.below or [node]:
            search_trees(docs, below, depth + 1, nodes, lists)
    elif node.below:
        for below in node.below:
            search_trees(docs, below, depth, nodes, lists)
    else:
        # The most promising leaves first: what they give may cut the others.
        order = np.argsort(-bounds, kind="stable")
        for start in range(0, len(order), AT_ONCE):
            part = order[start : start + AT_ONCE]
            part = nodes[part[bounds[part] >= weakest.min()]]
            if not len(part):
                return
            found = (part[:, None] * LEAF + np.arange(LEAF)).ravel()
            found = found[found < docs.count]
            scores = node.counts.astype(docs.kind) @ docs.dense(node.columns, found)
            for i in range(node.low, node.high):
                lists.add(i, scores[i - node.low].astype(np.int64), docs.nulls[found], docs.ids[found])


def _search(batches: Iterator[pa.RecordBatch], shared, k: int, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    block = shared.value
    lists = Lists(block, k)
    step = max(LEAF, MAXIMA // max(len(block.weights), 1) * LEAF)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            docs = Documents(batch.slice(start, step), block, n_docs, n_terms)
            if docs.count:
                search_trees(docs, block.root, 0, np.arange(1), lists)
    yield from lists.batches(block)


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` highest-scoring documents with a score above 0.

    ``docs(doc_id, text)`` and ``items(item_id, text)``; terms are ``terms_of`` the whole text, null has none. With N
    documents that have a term, L terms in all, n in the document, df documents with the term and tf of it
    here: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 75 + 25nN div L, and the score adds up, over the item's terms
    with repeats, w * (10^9 tf div (1000 tf + 12 m)). Equal scores go by doc_id, null last. Each row is a
    document of its own, repeated or not; items equal in id and text count once, an item id with several texts gets
    a list for each. Items without terms, or whose terms no document has, have no rows. Other columns are
    not read; scores are 64-bit integers.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = asked.dropDuplicates(["item_id", "text"]).withColumn("row", F.monotonically_increasing_id())
    entries = stage_table(asked.mapInArrow(_item_terms, "row long, item_id long, term string, q long"), "item-terms")
    bits = spark.sparkContext.broadcast(_bitmap(entries))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vectors = stage_table(
        plain.mapInArrow(partial(_vectors, shared=bits), "doc_id long, n long, terms array<string>, counts array<long>"),
        "term-vectors",
    )
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    weighed = stage_table(entries.join(held, "term").withColumn("w", weight).drop("df").filter("w > 0"), "weights")
    n_entries, n_items = weighed.agg(F.count("*"), F.count_distinct("row")).first()
    blocks = max(-(-n_entries // ENTRIES), -(-n_items // ITEMS))
    path, schema = fresh_path(spark, "lists"), "row long, item_id long, doc_id long, score long"
    empty = spark.createDataFrame([], schema)
    empty.write.parquet(path)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    rank = F.row_number().over(Window.partitionBy("row").orderBy(*order))
    sampled = vectors.filter(F.pmod(F.xxhash64("doc_id", "n", F.size("terms")), F.lit(SHARE)) == 0)
    for number in range(blocks):
        block = build_block(weighed.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).toArrow())

        def lists(rows: DataFrame) -> DataFrame:
            run = partial(_search, shared=spark.sparkContext.broadcast(block), k=k, n_docs=n_docs, n_terms=n_terms)
            return rows.mapInArrow(run, schema).withColumn("rank", rank).filter(F.col("rank") <= k)

        least = lists(sampled).filter(F.col("rank") == k).select("row", "score").toPandas()
        known = dict(zip(least["row"], least["score"]))
        block.thresholds = np.array([known.get(r, 0) for r in block.rows.tolist()], np.int64)
        lists(vectors).drop("rank").write.mode("append").parquet(path)
    merged = spark.read.schema(schema).parquet(path).withColumn("rank", rank)
    return merged.select("item_id", "rank", "doc_id", "score")
